"""Line dedup by a log-template tree, with DataFrame operations only.

Each line goes down a tree of fixed depth: the number of its tokens, then its
first LEADING tokens. Tokens are what stands between single spaces; one with a
digit becomes a wildcard first. In a leaf, a token at a place is constant when
at least MIN_DOCS of the leaf's lines have it there, and variable otherwise.
The template of a line is its tokens with variable ones as wildcards; if fewer
than CONSTANT of them stay constant, the line is its own template. A template
recurs when lines of it occur in at least MIN_DOCS documents. Every line of a
recurring template is dropped but the first (by document id, then text hash,
then place), so nothing disappears from the corpus altogether.

So that values of a variable field stay variable in leaves of any size, each line has a
second, wide template, whose constant tokens also need SHARE of the leaf's lines. Exact
lines of LONG tokens or more that stand in LONG_DOCS documents recur as well, and so do
exact lines of fewer than MIN_TOKENS tokens that stand in SHORT_DOCS. A line goes if any
of its templates recurs and it is not the first there; the first line of all that hang
together by templates is first in each of its own and stays. A template with less than
SHARE of a leaf that it shares with others is found by the first rule only.

Texts are split once, into a table of lines in the shared folder. Only hashes of lines
are shuffled to find leaves that recur; token rows are made for distinct lines of those
leaves alone. Counts are aggregated before each exchange, and rows that take a verdict
back from their template, leaf or token go to SALTS tasks for each of these, so a line
that stands in a third of all documents loads no single task.

Defined results: null texts count as empty; empty lines always stay; a document may lose all its lines and stays
as an empty text; rows that repeat id and text count as one document and get the
same result; an empty table gives an empty result; other columns pass through
only where asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, carried

LEADING = 3
MIN_TOKENS = 3
MIN_DOCS = 5
CONSTANT = 0.75
WILD = "<*>"
SHARE = 0.2
LONG, LONG_DOCS = 50, 2
SHORT_DOCS = 10
BROADCAST_LEAVES = 500_000
SALTS = 16


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, place of every line that may be a template; n, leaf, line_key and
    masked of one that goes into the tree; exact and least of one that counts as it stands."""
    text = _text()
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n", -1)).alias("place", "line"))
    n = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    rows = rows.select("*", n.alias("n"), F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", "[^ ]*[0-9][^ ]*", WILD)).otherwise(F.col("line")).alias("masked"))
    least = F.when(F.trim("line") == "", None).when(F.col("n") >= LONG, LONG_DOCS).when(F.col("n") < MIN_TOKENS, SHORT_DOCS)
    rows = rows.select("*", least.alias("least")).where((F.col("n") >= MIN_TOKENS) | F.col("least").isNotNull())
    tree = lambda c: F.when(F.col("n") >= MIN_TOKENS, c)
    return rows.select(
        "doc_id", "text_hash", "place", "n", tree(F.xxhash64("n", F.substring_index("masked", " ", LEADING))).alias("leaf"), tree(F.xxhash64("masked")).alias("line_key"),
        F.when(F.col("least").isNotNull(), F.xxhash64(F.lit("exact"), "line")).alias("exact"), "least", tree(F.col("masked")).alias("masked"),
    )


def _join_spread(many: DataFrame, once: DataFrame, key: list[str], by: list[str], how: str = "inner") -> DataFrame:
    """A join with a table that holds each key once; a key's many rows go to SALTS tasks."""
    spread = once.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return many.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int")).join(spread, [*key, "salt"], how).drop("salt")


def _templates(lines: DataFrame, min_docs: int, constant: float, share: float) -> DataFrame:
    """(leaf, line_key, template, wide) of the distinct lines of leaves with several; wide
    is the template in which tokens of less than a share of the leaf's lines are variable,
    too, null where there is none."""
    variants = lines.groupBy("leaf", "line_key").agg(F.count("*").alias("times"), F.first("masked").alias("masked"), F.first("n").alias("n"))
    tokens = variants.select("leaf", "line_key", "n", "times", F.posexplode(F.split("masked", " ", -1)).alias("at", "token"))
    support = tokens.groupBy("leaf", "at", "token").agg(F.sum("times").alias("support")).where((F.col("support") >= min_docs) & (F.col("token") != WILD))
    # every line has one token at the first place, so these sum to the leaf's lines
    sizes = variants.groupBy("leaf").agg(F.sum("times").alias("size"))
    support = support.join(sizes, "leaf").select("leaf", "at", "token", (F.col("support") >= F.lit(share) * F.col("size")).alias("common"))
    marked = _join_spread(tokens.select("leaf", "line_key", "n", "at", "token"), support, ["leaf", "at", "token"], ["line_key"], "left")
    one = F.struct("at", F.when(F.col("common").isNotNull(), F.col("token")).alias("narrow"), F.when(F.col("common"), F.col("token")).alias("wide"))
    merged = marked.groupBy("leaf", "line_key", "n").agg(F.count("common").alias("same"), F.count(F.when(F.col("common"), True)).alias("same_wide"), F.sort_array(F.collect_list(one)).alias("parts"))
    enough = F.ceil(F.col("n") * F.lit(constant))
    joined = lambda which: F.concat_ws(" ", F.transform("parts", lambda x: F.coalesce(x[which], F.lit(WILD))))
    narrow = F.when(F.col("same") >= enough, F.xxhash64("leaf", joined("narrow"))).otherwise(F.col("line_key"))
    wide = F.when(F.col("same_wide") >= enough, F.xxhash64(F.lit("wide"), "leaf", joined("wide")))
    return merged.select("leaf", "line_key", narrow.alias("template"), wide.alias("wide"))


def dropped_lines(docs: DataFrame, scratch: Scratch, min_docs: int = MIN_DOCS, constant: float = CONSTANT) -> DataFrame:
    """(doc_id, text_hash, places): the lines that each document loses."""
    lines = scratch.save(_lines(docs))
    leaves = lines.where("leaf is not null").groupBy("leaf").agg(F.count("*").alias("lines"), F.min("line_key").alias("low"), F.max("line_key").alias("high"))
    leaves = scratch.save(leaves.where(F.col("lines") >= min_docs).select("leaf", (F.col("low") != F.col("high")).alias("varied")))
    small = leaves.count() <= BROADCAST_LEAVES
    of_leaves = lambda rows, which: rows.join(F.broadcast(which), "leaf") if small else _join_spread(rows, which, ["leaf"], ["line_key", "place"])
    varied = of_leaves(lines.select("leaf", "line_key", "place", "n", "masked"), leaves.where("varied"))
    templates = scratch.save(_templates(varied, min_docs, constant, SHARE))
    recurring = of_leaves(lines.select("doc_id", "text_hash", "place", "leaf", "line_key"), leaves)
    named = _join_spread(recurring, templates, ["leaf", "line_key"], ["doc_id", "place"], "left")
    # one row for each template that a line has
    named = named.select("doc_id", "text_hash", "place", F.explode(F.array(F.coalesce("template", "line_key"), "wide")).alias("template"), F.lit(min_docs).alias("least")).where("template is not null")
    named = scratch.save(named.unionByName(lines.where("exact is not null").select("doc_id", "text_hash", "place", F.col("exact").alias("template"), "least")))
    firsts = named.groupBy("template", "doc_id").agg(F.min(F.struct("text_hash", "place")).alias("first"), F.min("least").alias("least"))
    firsts = firsts.groupBy("template").agg(F.count("*").alias("docs"), F.min("least").alias("least"), F.min(F.struct("doc_id", "first")).alias("first"))
    firsts = firsts.where(F.col("docs") >= F.col("least")).select("template", F.col("first.doc_id").alias("first_doc"), F.col("first.first.text_hash").alias("first_hash"), F.col("first.first.place").alias("first_place"))
    is_first = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("text_hash") == F.col("first_hash")) & (F.col("place") == F.col("first_place"))
    lost = _join_spread(named.select("doc_id", "text_hash", "place", "template"), firsts, ["template"], ["doc_id", "text_hash", "place"]).where(~is_first)
    return lost.groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("places"))


def dedup_lines(docs: DataFrame, extra: tuple[str, ...] = (), min_docs: int = MIN_DOCS, constant: float = CONSTANT) -> DataFrame:
    """doc_id, text without dropped lines, n_lines, n_dropped and the extra columns; an
    extra column with the name of one of these gives way to it."""
    scratch = Scratch(docs.sparkSession, "lines")
    lost = scratch.save(dropped_lines(docs, scratch, min_docs, constant))
    # one plan at every size: a broadcast where little is lost would make the growth
    # of shuffled bytes jump where it no longer fits
    others = carried(extra, "doc_id", "text", "n_lines", "n_dropped")
    rows = docs.select("doc_id", _text().alias("text"), F.xxhash64(_text()).alias("text_hash"), F.struct(F.lit(0).alias("_"), *others).alias("others"))
    same = [rows["doc_id"].eqNullSafe(lost["doc_id"]), rows["text_hash"] == lost["text_hash"]]
    found = rows.join(lost.hint("merge"), same, "left").select(rows["doc_id"], "text", "places", "others")
    parts: Column = F.split("text", "\n", -1)
    # a set difference and look-ups by place: time in proportion to the lines of a text
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), "places")
    kept = F.transform(F.array(parts), lambda p: F.array_join(F.transform(left, lambda at: F.get(p, at)), "\n"))[0]
    return found.select(
        "doc_id",
        F.when(F.col("places").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.size(parts).cast("long").alias("n_lines"),
        F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).cast("long").alias("n_dropped"),
        *(F.col("others")[c].alias(c) for c in others),
    )


# The same rules in DuckDB SQL; the text hash is the text itself there, so ties
# between rows of one doc_id with different texts may keep another first line.
ORACLE_SQL = f"""
WITH docs AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM docs),
lines AS (
  SELECT doc_id, text, unnest(range(len(parts))) AS place, unnest(parts) AS line FROM split),
masked AS (SELECT doc_id, text, place, line, regexp_replace(line, '[^ ]*[0-9][^ ]*', '{WILD}', 'g') AS masked FROM lines),
tok AS (SELECT *, string_split(masked, ' ') AS tokens FROM masked),
exact AS (
  SELECT doc_id, text, place, 'E' || line AS template, CASE WHEN len(tokens) >= {LONG} THEN {LONG_DOCS} ELSE {SHORT_DOCS} END AS least
  FROM tok WHERE trim(line, ' ') <> '' AND (len(tokens) >= {LONG} OR len(tokens) < {MIN_TOKENS})),
keyed AS (SELECT doc_id, text, place, masked, tokens, len(tokens) AS n,
  len(tokens) || '/' || array_to_string(tokens[1:{LEADING}], ' ') AS leaf FROM tok WHERE len(tokens) >= {MIN_TOKENS}),
leaves AS (SELECT leaf FROM keyed GROUP BY leaf HAVING count(*) >= {MIN_DOCS}),
recurring AS (SELECT * FROM keyed WHERE leaf IN (SELECT leaf FROM leaves)),
variants AS (SELECT leaf, masked, n, tokens, count(*) AS times FROM recurring GROUP BY ALL),
tokens AS (SELECT leaf, masked, n, times, unnest(range(n)) AS pos, unnest(tokens) AS token FROM variants),
sizes AS (SELECT leaf, sum(times) AS size FROM variants GROUP BY leaf HAVING count(*) > 1),
support AS (SELECT leaf, pos, token, sum(times) AS times FROM tokens GROUP BY ALL HAVING sum(times) >= {MIN_DOCS}),
marked AS (
  SELECT t.leaf, t.masked, t.n, t.pos, CASE WHEN s.token IS NOT NULL AND t.token <> '{WILD}' THEN t.token END AS token,
    CASE WHEN s.times >= {SHARE} * z.size AND t.token <> '{WILD}' THEN t.token END AS wide
  FROM tokens t LEFT JOIN support s ON t.leaf = s.leaf AND t.pos = s.pos AND t.token = s.token LEFT JOIN sizes z ON t.leaf = z.leaf),
named AS (
  SELECT leaf, masked, CASE WHEN count(token) >= ceil(any_value(n) * {CONSTANT})
    THEN 'T' || leaf || '|' || string_agg(coalesce(token, '{WILD}'), ' ' ORDER BY pos) ELSE 'L' || masked END AS template,
    CASE WHEN count(wide) >= ceil(any_value(n) * {CONSTANT}) THEN 'W' || leaf || '|' || string_agg(coalesce(wide, '{WILD}'), ' ' ORDER BY pos) END AS wide
  FROM marked GROUP BY leaf, masked),
occurrences AS (
  SELECT r.doc_id, r.text, r.place, m.template, {MIN_DOCS} AS least FROM recurring r JOIN named m ON r.leaf = m.leaf AND r.masked = m.masked
  UNION ALL SELECT r.doc_id, r.text, r.place, m.wide, {MIN_DOCS} FROM recurring r JOIN named m ON r.leaf = m.leaf AND r.masked = m.masked WHERE m.wide IS NOT NULL
  UNION ALL SELECT * FROM exact),
firsts AS (
  SELECT template, min(doc_id) AS first_doc FROM occurrences GROUP BY template HAVING count(DISTINCT doc_id) >= min(least)),
places AS (SELECT template, min(place) AS first_place FROM occurrences JOIN firsts USING (template) WHERE doc_id = first_doc GROUP BY template),
lost AS (
  SELECT o.doc_id, o.text, list(DISTINCT o.place) AS places FROM occurrences o JOIN firsts f USING (template) JOIN places p USING (template)
  WHERE NOT (o.doc_id = f.first_doc AND o.place = p.first_place) GROUP BY o.doc_id, o.text)
SELECT d.doc_id,
  CASE WHEN l.places IS NULL THEN coalesce(d.text, '') ELSE coalesce(array_to_string(list_filter(string_split(coalesce(d.text, ''), chr(10)), lambda x, i: NOT list_contains(l.places, i - 1)), chr(10)), '') END AS text,
  CAST(len(string_split(coalesce(d.text, ''), chr(10))) AS BIGINT) AS n_lines,
  CAST(coalesce(len(l.places), 0) AS BIGINT) AS n_dropped
FROM documents d LEFT JOIN lost l ON d.doc_id = l.doc_id AND coalesce(d.text, '') = l.text
"""
