"""Registered queries of the forecasting operators over the supplied tables, each
with DuckDB SQL of the same result where SQL can express it.

Doubles are rounded half to even on both sides, so the order of a sum's terms
doesn't show.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import scalars as S
from .operators import backtest, benchmark, calendar, drivers, engines, features, gate, governance, quality_checks, scoring, selection
from .plans import pipeline
from .plans.config import BUCKETS, HORIZONS, Run, dim_horizon, dim_technique
from .sources import tables
from .sources.shared import Scratch
from .sources.tables import DRIVER_SQL, GRID_SQL, PRICE_SQL

ANCHOR = "2000-09-01"
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _rounding(sql: str) -> str:
    """round_even(x, n) spelled out as the rounding rule of the engine."""
    at = sql.rfind("round_even(")
    while at >= 0:
        i, depth, comma = at + len("round_even("), 1, -1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[i], 0)
            comma = i if sql[i] == "," and depth == 1 else comma
            i += 1
        x, n = sql[at + len("round_even(") : comma], int(sql[comma + 1 : i - 1])
        done = f"(RINT(RINT(({x}) * 1e{n + 4}, 0) / 1e{n + 4} * 1e{n}, 0) / 1e{n})"
        sql = sql[:at] + done + sql[i:]
        at = sql.rfind("round_even(", 0, at)
    return sql.replace("RINT(", "round_even(")


def query(name: str, sql: str | None = None):
    def register(f):
        _QUERIES[name] = f
        if sql:
            _SQL[name] = _rounding(sql)
        return f

    return register


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to `places`, dates and booleans as they are, integers as long."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = S.round_to(c, places) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def rounds(*columns: str, places: int = 6) -> str:
    return ", ".join(f"round_even({c}, {places}) + 0.0 AS {c}" for c in columns)


def _prices(spark, sf_dir):
    return calendar.dense_grid(tables.fact_price(spark, sf_dir))


def _save(spark):
    return Scratch(spark, "queries").save


# --- sources, calendar, cleaning --------------------------------------------

@query("monthly_price", f"WITH {PRICE_SQL} SELECT series_id, ds, price FROM fact_price")
def monthly_price(spark, sf_dir):
    return tables.fact_price(spark, sf_dir)


@query("driver_long", f"WITH {DRIVER_SQL} SELECT series_id, driver, ds, {rounds('raw')} FROM fact_driver")
def driver_long(spark, sf_dir):
    return rounded(tables.fact_driver(spark, sf_dir).select("series_id", "driver", "ds", "raw"))


@query("dense_grid", f"WITH {GRID_SQL} SELECT series_id, ds, price FROM grid")
def dense_grid(spark, sf_dir):
    return _prices(spark, sf_dir)


HOLED = "(month(ds) + 3 * year(ds)) % 7 <> 0"


@query("missing_periods", f"WITH {GRID_SQL}, holed AS (SELECT * FROM fact_price WHERE {HOLED}), b AS (SELECT series_id, min(ds) AS a, max(ds) AS b FROM holed GROUP BY 1) SELECT m.series_id, m.ds FROM months m JOIN b USING (series_id) WHERE m.ds BETWEEN b.a AND b.b AND NOT EXISTS (SELECT 1 FROM holed h WHERE h.series_id = m.series_id AND h.ds = m.ds)")
def missing_periods(spark, sf_dir):
    return calendar.missing_periods(tables.fact_price(spark, sf_dir).where(HOLED))


@query("infer_frequency", f"""WITH {PRICE_SQL}, every AS (SELECT series_id, ds FROM fact_price UNION ALL SELECT series_id || ' q', ds FROM fact_price WHERE month(ds) % 3 = 1 UNION ALL SELECT series_id || ' y', ds FROM fact_price WHERE month(ds) = 1),
gaps AS (SELECT series_id, ds, date_diff('day', lag(ds) OVER (PARTITION BY series_id ORDER BY ds), ds) AS gap FROM every),
m AS (SELECT series_id, min(ds) AS start, quantile_cont(gap, 0.5) AS median_gap FROM gaps GROUP BY 1)
SELECT series_id, start, {rounds('median_gap')}, CASE WHEN median_gap <= 45 THEN 'monthly' WHEN median_gap <= 120 THEN 'quarterly' ELSE 'unknown' END AS frequency FROM m""")
def infer_frequency(spark, sf_dir):
    p = tables.fact_price(spark, sf_dir).select("series_id", "ds")
    q = p.where(F.month("ds") % 3 == 1).select(F.concat("series_id", F.lit(" q")).alias("series_id"), "ds")
    y = p.where(F.month("ds") == 1).select(F.concat("series_id", F.lit(" y")).alias("series_id"), "ds")
    return rounded(calendar.infer_frequency(p.unionByName(q).unionByName(y)))


@query("future_grid", f"WITH {PRICE_SQL}, l AS (SELECT series_id, max(ds) AS last FROM fact_price GROUP BY 1), s AS (SELECT series_id, last, unnest(range(1, 19)) AS step FROM l) SELECT series_id, step, CAST(last + to_months(CAST(step AS INTEGER)) AS DATE) AS ds FROM s")
def future_grid(spark, sf_dir):
    return rounded(calendar.future_grid(tables.fact_price(spark, sf_dir), 18))


TEXTS = ["1,234.50", " 12 ", "", "n/a", "-3", "1e3", "NaN", None]
NAMES = ["Price (USD/MT)", "  a   b  ", "x//y::z", "'quoted' \"name\"", "plain", "_edge_", "[one]{two}"]
DATES = ["2020-03-17", "Jan-20", "feb-99", "Mar-2021", "2020-13-01", "soon", None]


@query("clean_numbers", "SELECT i AS id, t AS raw, CASE WHEN NOT isnan(TRY_CAST(trim(replace(t, ',', '')) AS DOUBLE)) THEN TRY_CAST(trim(replace(t, ',', '')) AS DOUBLE) END AS value FROM (VALUES " + ", ".join(f"({i}, {'NULL' if t is None else repr(t)})" for i, t in enumerate(TEXTS)) + ") v(i, t)")
def clean_numbers(spark, sf_dir):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, raw string")
    return df.select("id", "raw", S.to_number("raw").alias("value"))


@query("clean_names", r"""SELECT item, regexp_replace(regexp_replace(regexp_replace(regexp_replace(item, '\s+', ' ', 'g'), '[/()\[\]{},:"'']+', '_', 'g'), '_+', '_', 'g'), '^[_ ]+|[_ ]+$', '', 'g') AS cleaned FROM (SELECT DISTINCT props AS item FROM events UNION SELECT DISTINCT p_name FROM part UNION SELECT DISTINCT url FROM pages)""")
def clean_names(spark, sf_dir):
    rows = tables.read(spark, sf_dir, "events").select(F.col("props").alias("item"))
    rows = rows.union(tables.read(spark, sf_dir, "part").select("p_name")).union(tables.read(spark, sf_dir, "pages").select("url")).distinct()
    return rows.select("item", S.clean_name("item").alias("cleaned"))


_CLEAN = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(item, '\s+', ' ', 'g'), '[/()\[\]{},:"'']+', '_', 'g'), '_+', '_', 'g'), '^[_ ]+|[_ ]+$', '', 'g')"""
_QUOTED = lambda t: "NULL" if t is None else "'" + t.replace("'", "''") + "'"


@query("clean_name_cases", f"SELECT item, {_CLEAN} AS cleaned FROM (VALUES {', '.join(f'({_QUOTED(n)})' for n in NAMES)}) v(item)")
def clean_name_cases(spark, sf_dir):
    return spark.createDataFrame([(n,) for n in NAMES], "item string").select("item", S.clean_name("item").alias("cleaned"))


@query("parse_months", f"""SELECT i AS id, t AS raw, CAST(date_trunc('month', CASE WHEN regexp_matches(trim(t), '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN try_strptime(trim(t)[1:10], '%Y-%m-%d')
 WHEN regexp_matches(trim(t), '^[A-Za-z]{{3}}-\\d{{2}}$') THEN try_strptime(trim(t)[1:4] || '20' || trim(t)[5:6], '%b-%Y') WHEN regexp_matches(trim(t), '^[A-Za-z]{{3}}-\\d{{4}}$') THEN try_strptime(trim(t), '%b-%Y') END) AS DATE) AS ds
 FROM (VALUES {', '.join(f'({i}, {_QUOTED(t)})' for i, t in enumerate(DATES))}) v(i, t)""")
def parse_months(spark, sf_dir):
    return spark.createDataFrame(list(enumerate(DATES)), "id int, raw string").select("id", "raw", S.parse_month("raw").alias("ds"))


# --- descriptive tables -------------------------------------------------------

P = "grid"
BY = "OVER (PARTITION BY series_id ORDER BY ds"


@query("summary_statistics", f"""WITH {GRID_SQL}, c AS (SELECT series_id, price, avg(price) OVER (PARTITION BY series_id) AS mu FROM grid WHERE price IS NOT NULL),
a AS (SELECT series_id, count(price) AS n, avg(price) AS mean, stddev_samp(price) AS std, min(price) AS min, max(price) AS max,
 avg(pow(price - mu, 3)) / nullif(pow(stddev_pop(price), 3), 0) AS skew, avg(pow(price - mu, 4)) / nullif(pow(stddev_pop(price), 4), 0) - 3 AS kurtosis,
 quantile_cont(price, 0.1) AS p10, quantile_cont(price, 0.25) AS p25, quantile_cont(price, 0.5) AS p50, quantile_cont(price, 0.75) AS p75, quantile_cont(price, 0.9) AS p90 FROM c GROUP BY 1)
SELECT series_id, n, {rounds('mean', 'std', 'min', 'max', 'skew', 'kurtosis', 'p10', 'p25', 'p50', 'p75', 'p90')} FROM a""")
def summary_statistics(spark, sf_dir):
    return rounded(quality_checks.summary_statistics(_prices(spark, sf_dir)))


@query("trend", f"""WITH {GRID_SQL}, t AS (SELECT series_id, ds, price, CASE WHEN count(price) {BY} ROWS 11 PRECEDING) >= 12 THEN avg(price) {BY} ROWS 11 PRECEDING) END AS rolling_mean,
CASE WHEN count(price) {BY} ROWS 11 PRECEDING) >= 12 THEN stddev_samp(price) {BY} ROWS 11 PRECEDING) END AS rolling_std FROM grid)
SELECT series_id, ds, price, {rounds('rolling_mean', 'rolling_std')} FROM t""")
def trend(spark, sf_dir):
    return rounded(quality_checks.trend(_prices(spark, sf_dir)))


RETURNS_SQL = f"""{GRID_SQL}, r0 AS (SELECT series_id, ds, price, lag(price) {BY}) AS last FROM grid),
r1 AS (SELECT series_id, ds, price, (price / nullif(last, 0) - 1) * 100 AS ret, price - last AS diff FROM r0),
r AS (SELECT *, CASE WHEN count(ret) {BY} ROWS 5 PRECEDING) >= 6 THEN stddev_samp(ret) {BY} ROWS 5 PRECEDING) END AS volatility FROM r1)"""


@query("returns", f"WITH {RETURNS_SQL} SELECT series_id, ds, price, {rounds('ret', 'diff', 'volatility')} FROM r")
def returns(spark, sf_dir):
    return rounded(quality_checks.returns(_prices(spark, sf_dir)))


@query("return_statistics", f"WITH {RETURNS_SQL}, a AS (SELECT series_id, avg(ret) AS mean_ret, stddev_samp(ret) AS std_ret, max(ret) AS max_ret, min(ret) AS min_ret, arg_max(ds, round_even(ret, 9)) AS max_ds, arg_min(ds, round_even(ret, 9)) AS min_ds FROM r WHERE ret IS NOT NULL GROUP BY 1) SELECT series_id, {rounds('mean_ret', 'std_ret', 'max_ret', 'min_ret')}, max_ds, min_ds FROM a")
def return_statistics(spark, sf_dir):
    return rounded(quality_checks.return_statistics(_prices(spark, sf_dir)))


_MONTHS = ", ".join(f"avg(price) FILTER (WHERE month(ds) = {m}) AS m{m}" for m in range(1, 13))


@query("month_year_means", f"WITH {GRID_SQL}, a AS (SELECT series_id, year(ds) AS year, {_MONTHS} FROM grid GROUP BY 1, 2) SELECT series_id, year, {rounds(*[f'm{m}' for m in range(1, 13)])} FROM a")
def month_year_means(spark, sf_dir):
    return rounded(quality_checks.month_year_means(_prices(spark, sf_dir)))


@query("month_boxes", f"WITH {GRID_SQL}, a AS (SELECT series_id, month(ds) AS month, min(price) AS low, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.75) AS q3, max(price) AS high, count(*) AS n FROM grid WHERE price IS NOT NULL GROUP BY 1, 2) SELECT series_id, month, n, {rounds('low', 'q1', 'median', 'q3', 'high')} FROM a")
def month_boxes(spark, sf_dir):
    return rounded(quality_checks.month_boxes(_prices(spark, sf_dir)))


@query("histogram", f"""WITH {GRID_SQL}, s AS (SELECT series_id, min(price) AS a, max(price) AS b, avg(price) AS mean, stddev_samp(price) AS sd, count(*) AS total FROM grid WHERE price IS NOT NULL GROUP BY 1 HAVING max(price) > min(price)),
c AS (SELECT g.series_id, CAST(least(19, floor((price - a) / (b - a) * 20)) AS INTEGER) AS bin, count(*) AS n FROM grid g JOIN s USING (series_id) WHERE price IS NOT NULL GROUP BY 1, 2),
g AS (SELECT *, unnest(range(20)) AS bin FROM s),
h AS (SELECT g.series_id, g.bin, a + g.bin * ((b - a) / 20) AS from_price, a + g.bin * ((b - a) / 20) + (b - a) / 20 AS to_price, coalesce(n, 0) AS n,
 total * ((b - a) / 20) / sd * exp(-pow((a + g.bin * ((b - a) / 20) + (b - a) / 20 / 2 - mean) / sd, 2) / 2) / sqrt(2.0 * pi()) AS normal FROM g LEFT JOIN c ON g.series_id = c.series_id AND g.bin = c.bin)
SELECT series_id, bin, n, {rounds('from_price', 'to_price', 'normal')} FROM h""")
def histogram(spark, sf_dir):
    return rounded(quality_checks.histogram(_prices(spark, sf_dir)))


@query("density", f"""WITH {GRID_SQL}, v AS (SELECT series_id, price FROM grid WHERE price IS NOT NULL), r AS (SELECT series_id, min(price) AS low, max(price) AS high, count(*) AS n, stddev_samp(price) * pow(count(*), -0.2) AS width FROM v GROUP BY 1 HAVING stddev_samp(price) > 0),
g AS (SELECT *, unnest(range(100)) AS point FROM r), p AS (SELECT *, low + (high - low) * point / 99 AS place FROM g)
SELECT p.series_id, p.point, round_even(place, 6) + 0.0 AS at, round_even(sum(exp(-pow((place - price) / width, 2) / 2)) / (any_value(n) * any_value(width) * sqrt(2 * pi())), 6) + 0.0 AS density FROM p JOIN v USING (series_id) GROUP BY 1, 2, place""")
def density(spark, sf_dir):
    return rounded(quality_checks.density(_prices(spark, sf_dir)))


@query("window_inputs", f"""WITH {GRID_SQL}, k AS (SELECT series_id, ds, price, month(ds) AS m, year(ds) AS year, min(price) FILTER (WHERE ds <= DATE '2000-12-01') OVER (PARTITION BY series_id) AS low, max(price) FILTER (WHERE ds <= DATE '2000-12-01') OVER (PARTITION BY series_id) AS high FROM grid)
SELECT series_id, ds, round_even(sin(m * 2 * pi() / 12), 6) + 0.0 AS month_sin, round_even(cos(m * 2 * pi() / 12), 6) + 0.0 AS month_cos, year, round_even(CASE WHEN high = low THEN 0.0 ELSE (price - low) / (high - low) END, 6) + 0.0 AS price_scaled FROM k""")
def window_inputs(spark, sf_dir):
    """Inputs of models that read whole windows, scaled by what is known at the end of 2000."""
    rows = features.min_max(features.window_features(_prices(spark, sf_dir)), ["price"], "2000-12-01")
    return rounded(rows.select("series_id", "ds", "month_sin", "month_cos", "year", "price_scaled"))


@query("autocorrelation", f"""WITH {GRID_SQL}, x AS (SELECT series_id, price - avg(price) OVER (PARTITION BY series_id) AS x, row_number() {BY}) AS pos FROM grid WHERE price IS NOT NULL),
l AS (SELECT *, unnest(range(13)) AS lag FROM x),
c AS (SELECT l.series_id, lag, sum(l.x * y.x) AS c FROM l JOIN x y ON l.series_id = y.series_id AND y.pos = l.pos - l.lag GROUP BY 1, 2),
t AS (SELECT series_id, lag, c / nullif(max(CASE WHEN lag = 0 THEN c END) OVER (PARTITION BY series_id), 0) AS acf FROM c)
SELECT series_id, lag, {rounds('acf')} FROM t""")
def autocorrelation(spark, sf_dir):
    return rounded(quality_checks.autocorrelation(_prices(spark, sf_dir)))


# Prices with planted trouble: a gap, repeated months, nulls, an outlier, negatives, a flat stretch.
DIRTY_SQL = """{grid}, kept AS (SELECT series_id, ds, price, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS pos FROM grid WHERE price IS NOT NULL),
dirty0 AS (SELECT series_id, ds, CASE WHEN pos = 9 THEN NULL WHEN pos = 20 THEN -price WHEN pos = 33 THEN price * 9.017 WHEN pos BETWEEN 40 AND 45 THEN 1500.0 ELSE price END AS price, pos FROM kept WHERE pos NOT IN (15, 16, 60)),
dirty AS (SELECT series_id, ds, price FROM dirty0 UNION ALL SELECT series_id, ds, price FROM dirty0 WHERE pos IN (5, 6))"""


def _dirty(spark, sf_dir):
    at = F.row_number().over(calendar.per_series())
    rows = _prices(spark, sf_dir).where("price is not null").withColumn("at", at).where("at not in (15, 16, 60)")
    price = F.when(F.col("at") == 9, None).when(F.col("at") == 20, -F.col("price")).when(F.col("at") == 33, F.col("price") * 9.017).when(F.col("at").between(40, 45), 1500.0).otherwise(F.col("price"))
    rows = rows.withColumn("price", price)
    return rows.unionByName(rows.where("at in (5, 6)")).select("series_id", "ds", "price")


@query("quality_flags", f"""WITH {DIRTY_SQL.format(grid=GRID_SQL)},
per AS (SELECT series_id, count(*) AS n, count(*) FILTER (WHERE price IS NULL) AS missing, count(*) - count(DISTINCT ds) AS repeats, count(*) FILTER (WHERE price < 0) AS negative FROM dirty GROUP BY 1),
bb AS (SELECT series_id, min(ds) AS a, max(ds) AS b FROM dirty GROUP BY 1),
mm AS (SELECT series_id, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS ds FROM bb),
gaps AS (SELECT series_id, ds, row_number() {BY}) AS pos FROM mm WHERE NOT EXISTS (SELECT 1 FROM dirty d WHERE d.series_id = mm.series_id AND d.ds = mm.ds)),
gapped AS (SELECT series_id, count(*) AS n, string_agg(strftime(ds, '%Y-%m'), ', ' ORDER BY ds) FILTER (WHERE pos <= 10) AS listed FROM gaps GROUP BY 1),
clean AS (SELECT * FROM dirty WHERE price IS NOT NULL),
z AS (SELECT *, (price - avg(price) OVER (PARTITION BY series_id)) / nullif(stddev_samp(price) OVER (PARTITION BY series_id), 0) AS z FROM clean),
far AS (SELECT series_id, count(*) AS n, string_agg(strftime(ds, '%Y-%m') || '=' || format('{{:.2f}}', price), ', ' ORDER BY ds, price) AS rows FROM z WHERE abs(z) > 3 GROUP BY 1),
ch AS (SELECT *, coalesce(CAST(price <> lag(price) {BY}) AS INTEGER), 1) AS changed FROM clean),
rn AS (SELECT *, sum(changed) {BY} RANGE UNBOUNDED PRECEDING) AS run FROM ch),
runs AS (SELECT series_id, run, count(*) AS length, max(ds) AS e FROM rn GROUP BY 1, 2 HAVING count(*) >= 4),
flat AS (SELECT series_id, length, e, row_number() OVER (PARTITION BY series_id ORDER BY length DESC, e) AS k FROM runs)
SELECT series_id, 'missing_or_non_numeric_price' AS "check", 'warning' AS severity, missing || ' of ' || n || ' price values are missing or non-numeric' AS detail FROM per WHERE missing > 0
UNION ALL SELECT series_id, 'duplicate_dates', 'error', repeats || ' duplicate date(s) in the price index' FROM per WHERE repeats > 0
UNION ALL SELECT series_id, 'negative_price', 'warning', negative || ' negative price value(s)' FROM per WHERE negative > 0
UNION ALL SELECT series_id, 'missing_calendar_periods', 'error', n || ' missing periods: ' || listed || CASE WHEN n > 10 THEN ' ...' ELSE '' END FROM gapped
UNION ALL SELECT series_id, 'price_outliers', 'warning', n || ' value(s) with |z-score| > 3: ' || rows FROM far
UNION ALL SELECT series_id, 'flat_stretch', 'info', length || ' consecutive identical price values ending ' || strftime(e, '%Y-%m') FROM flat WHERE k = 1""")
def quality_flags(spark, sf_dir):
    return quality_checks.quality_flags(_dirty(spark, sf_dir))


# --- features -----------------------------------------------------------------

def _features_sql(frequency: str = "monthly") -> str:
    z = features.sizes(frequency)
    lag = lambda k: f"lag(price, {k}) {BY})"
    roll = lambda fn, k, least=None: f"CASE WHEN count(price) {BY} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) >= {least or k} THEN {fn}(price) {BY} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) END"
    monthly = frequency == "monthly"
    base = [f"{lag(k)} AS lag_{k}" for k in z["lags"]] + [f"{lag(k)} AS l{k}" for k in sorted({1, 2, 3, 4, *(1 + k for k in z["cumulative"])})]
    base += [f"{roll(fn, k)} AS roll_{n}_{k}" for k in z["rolling"] for n, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))]
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    base += [f"avg(price) {BY} {before} AS expanding_mean", f"stddev_samp(price) {BY} {before} AS expanding_std", f"avg(price) OVER (PARTITION BY series_id, {'month' if monthly else 'quarter'}(ds) ORDER BY ds {before} AS same_mean"]
    k36, short, long = z["long"], z["rolling"][0], z["rolling"][-1]
    base += [f"{roll('avg', k36, z['long_least'])} AS rolling_mean_{k36}", f"{roll('stddev_samp', k36, z['long_least'])} AS rolling_std_{k36}", "min(year(ds)) OVER (PARTITION BY series_id) AS y0"]
    top = ["series_id", "ds", "price", *(f"lag_{k}" for k in z["lags"]), *(f"roll_{n}_{k}" for k in z["rolling"] for n in ("mean", "std", "min", "max"))]
    top += [f"coalesce((l1 - roll_mean_{k}) / CASE WHEN roll_std_{k} > 0 THEN roll_std_{k} END, 0.0) AS roll_zscore_{k}" for k in z["rolling"]]
    top += [f"roll_std_{k} / nullif(roll_mean_{k}, 0) AS coef_var_{k}" for k in z["rolling"]]
    ratio = lambda a, b: f"(l{a} / nullif(l{b}, 0) - 1) * 100"
    top += ["l1 - l2 AS mom_change", f"{ratio(1, 2)} AS mom_pct_change", f"{ratio(2, 3)} AS mom_pct_lag1", f"{ratio(3, 4)} AS mom_pct_lag2", *(f"{ratio(1, 1 + k)} AS cum_return_{k}p" for k in z["cumulative"])]
    top += [f"l1 / nullif(roll_mean_{long}, 0) AS price_to_ma_long", f"l1 / nullif(roll_mean_{short}, 0) AS price_to_ma_short", f"roll_mean_{short} / nullif(roll_mean_{long}, 0) AS ma_short_to_ma_long"]
    top += ["month(ds) AS month", "quarter(ds) AS quarter", "year(ds) AS year", *(f"{f}({x}(ds) * {n}) AS {x}_{f}" for x, n in (("month", 2 * 3.141592653589793 / 12), ("quarter", 2 * 3.141592653589793 / 4)) for f in ("sin", "cos")), "year(ds) - y0 AS years_since_start"]
    top += [f"CAST(quarter(ds) = {q} AS INTEGER) AS is_q{q}" for q in range(1, 5)] + [f"CAST(month(ds) = {i} AS INTEGER) AS is_{m}" for i, m in enumerate(features.MONTHS, 1) if monthly]
    top += ["expanding_mean", "expanding_std", "l1 / nullif(expanding_mean, 0) AS price_to_expanding_mean", "same_mean / nullif(expanding_mean, 0) AS seasonal_index", f"rolling_mean_{k36}", f"rolling_std_{k36}", f"price / nullif(rolling_mean_{k36}, 0) AS price_to_rolling_mean_{k36}"]
    grid = GRID_SQL if monthly else f"""{PRICE_SQL}, bounds AS (SELECT series_id, min(ds) AS a, max(ds) AS b FROM fact_price WHERE month(ds) % 3 = 1 GROUP BY 1),
quarters AS (SELECT series_id, CAST(unnest(generate_series(a, b, INTERVAL 3 MONTH)) AS DATE) AS ds FROM bounds), grid AS (SELECT q.series_id, q.ds, p.price FROM quarters q LEFT JOIN fact_price p ON p.series_id = q.series_id AND p.ds = q.ds)"""
    return f"WITH {grid}, base AS (SELECT series_id, ds, price, {', '.join(base)} FROM grid), feats AS (SELECT {', '.join(top)} FROM base)"


_INTEGERS = {"month", "quarter", "year", "years_since_start", *(f"is_q{q}" for q in range(1, 5)), *(f"is_{m}" for m in features.MONTHS)}
_FEATURES = [n for n, _, _ in features.feature_table()]
_ALL = ", ".join(n if n in _INTEGERS else f"round_even({n}, 6) + 0.0 AS {n}" for n in _FEATURES)
_COMPLETE = " AND ".join(f"{n} IS NOT NULL" for n in ["price", *_FEATURES])


@query("features", f"{_features_sql()} SELECT series_id, ds, price, {_ALL} FROM feats")
def feature_matrix(spark, sf_dir):
    return rounded(features.engineer(_prices(spark, sf_dir)))


@query("features_complete", f"{_features_sql()} SELECT series_id, ds, price, {_ALL} FROM feats WHERE {_COMPLETE}")
def features_complete(spark, sf_dir):
    return rounded(features.complete_cases(features.engineer(_prices(spark, sf_dir))))


@query("features_quarterly", f"{_features_sql('quarterly')} SELECT series_id, ds, price, {', '.join(n if n in _INTEGERS else f'round_even({n}, 6) + 0.0 AS {n}' for n, _, _ in features.feature_table('quarterly'))} FROM feats")
def features_quarterly(spark, sf_dir):
    q = tables.fact_price(spark, sf_dir).where(F.month("ds") % 3 == 1)
    return rounded(features.engineer(calendar.dense_grid(q, "quarterly"), "quarterly"))


@query("direct_target", f"{_features_sql()}, t AS (SELECT series_id, ds, price, lead(price, 3) {BY}) AS target FROM feats WHERE {_COMPLETE}) SELECT * FROM t")
def direct_target(spark, sf_dir):
    return features.direct_target(features.complete_cases(features.engineer(_prices(spark, sf_dir))), 3).select("series_id", "ds", "price", "target")


@query("safety_horizon", "SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{f}', {'NULL' if h is None else h})" for n, f, h in features.feature_table()) + ") v(feature, family, horizon)")
def safety_horizon(spark, sf_dir):
    return spark.createDataFrame(features.feature_table(), "feature string, family string, horizon long")


# --- drivers ------------------------------------------------------------------

_AVG_RANK = lambda v: f"rank() OVER (PARTITION BY series_id, driver, lag ORDER BY {v}) + (count(*) OVER (PARTITION BY series_id, driver, lag, {v}) - 1) / 2.0"
_CORR = lambda a, b: f"CASE WHEN count(*) > 1 AND max({a}) > min({a}) AND max({b}) > min({b}) THEN covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END"
LAG_SQL = f"""{DRIVER_SQL}, lagged AS (SELECT series_id, driver, lag, CAST(ds + to_months(CAST(lag AS INTEGER)) AS DATE) AS ds, raw AS value FROM fact_driver, (SELECT unnest(range(4)) AS lag)),
pairs AS (SELECT l.*, p.price FROM lagged l JOIN grid p ON l.series_id = p.series_id AND l.ds = p.ds AND p.price IS NOT NULL),
ranks AS (SELECT *, {_AVG_RANK('price')} AS pr, {_AVG_RANK('value')} AS vr FROM pairs),
scored0 AS (SELECT series_id, driver, lag, count(*) AS n_obs, CASE WHEN count(*) >= 5 THEN {_CORR('price', 'value')} END AS pearson, CASE WHEN count(*) >= 5 THEN {_CORR('pr', 'vr')} END AS spearman FROM ranks GROUP BY 1, 2, 3),
scored1 AS (SELECT *, abs(pearson) * 1.0 + abs(spearman) * 0.0 AS ensemble FROM scored0),
lag_score AS (SELECT *, row_number() OVER (PARTITION BY series_id, driver ORDER BY round_even(ensemble, 9) DESC NULLS LAST, lag) = 1 AND ensemble IS NOT NULL AS selected FROM scored1),
chosen AS (SELECT series_id, driver, lag FROM lag_score WHERE selected),
moved AS (SELECT d.series_id, d.driver, c.lag, CAST(d.ds + to_months(CAST(c.lag AS INTEGER)) AS DATE) AS ds, d.raw AS lagged FROM fact_driver d JOIN chosen c ON d.series_id = c.series_id AND d.driver = c.driver),
on_dates AS (SELECT g.series_id, c.driver, g.ds, m.lagged FROM grid g JOIN chosen c ON g.series_id = c.series_id LEFT JOIN moved m ON m.series_id = g.series_id AND m.driver = c.driver AND m.ds = g.ds),
gate AS (SELECT series_id, driver, count(*) AS n_rows, count(lagged) AS n_present, 100.0 * count(lagged) / count(*) AS coverage_pct,
  CASE WHEN 100.0 * count(lagged) / count(*) < 70 THEN 'excluded' WHEN count(lagged) < count(*) THEN 'imputed' ELSE 'included' END AS action FROM on_dates GROUP BY 1, 2),
gated AS (SELECT o.series_id, o.driver, o.ds, CASE WHEN g.action = 'included' THEN o.lagged ELSE coalesce(o.lagged, avg(o.lagged) OVER (PARTITION BY o.series_id, o.driver ORDER BY o.ds ROWS 2 PRECEDING)) END AS value
  FROM on_dates o JOIN gate g ON o.series_id = g.series_id AND o.driver = g.driver WHERE g.action <> 'excluded')"""


def _chosen(spark, sf_dir):
    prices, driver = _prices(spark, sf_dir), tables.fact_driver(spark, sf_dir)
    scores = drivers.lag_search(prices, driver)
    return prices, driver, scores, drivers.selected_lags(driver, scores)


@query("lag_search", f"WITH {LAG_SQL} SELECT series_id, driver, lag, n_obs, {rounds('pearson', 'spearman', 'ensemble')}, selected FROM lag_score")
def lag_search(spark, sf_dir):
    return rounded(drivers.lag_search(_prices(spark, sf_dir), tables.fact_driver(spark, sf_dir)))


@query("adequacy_gate", f"WITH {LAG_SQL} SELECT series_id, driver, n_rows, n_present, {rounds('coverage_pct')}, action FROM gate")
def adequacy_gate(spark, sf_dir):
    prices, _, _, chosen = _chosen(spark, sf_dir)
    return rounded(drivers.adequacy_gate(prices, chosen))


@query("gated_drivers", f"WITH {LAG_SQL} SELECT series_id, driver, ds, {rounds('value')} FROM gated")
def gated_drivers(spark, sf_dir):
    prices, _, _, chosen = _chosen(spark, sf_dir)
    return rounded(drivers.gated_drivers(prices, chosen))


_SIDE = "OVER (PARTITION BY series_id, driver ORDER BY ds ROWS BETWEEN"
_LINEAR = f"""{LAG_SQL}, placed0 AS (SELECT o.*, g.action, row_number() OVER (PARTITION BY o.series_id, o.driver ORDER BY o.ds) AS pos FROM on_dates o JOIN gate g ON o.series_id = g.series_id AND o.driver = g.driver WHERE g.action <> 'excluded'),
sides AS (SELECT *, CASE WHEN lagged IS NOT NULL THEN pos END AS own FROM placed0),
sided AS (SELECT *, last_value(own IGNORE NULLS) {_SIDE} UNBOUNDED PRECEDING AND CURRENT ROW) AS p0, last_value(lagged IGNORE NULLS) {_SIDE} UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
 first_value(own IGNORE NULLS) {_SIDE} CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1, first_value(lagged IGNORE NULLS) {_SIDE} CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1 FROM sides),
linear AS (SELECT series_id, driver, ds, CASE WHEN action = 'included' THEN lagged WHEN p0 IS NOT NULL THEN coalesce(lagged, v0 + (pos - p0) / nullif(CAST(p1 - p0 AS DOUBLE), 0) * (v1 - v0), v0) END AS value FROM sided)"""


@query("gated_drivers_linear", f"WITH {_LINEAR} SELECT series_id, driver, ds, {rounds('value')} FROM linear")
def gated_drivers_linear(spark, sf_dir):
    prices, _, _, chosen = _chosen(spark, sf_dir)
    return rounded(drivers.gated_drivers(prices, chosen, "linear"))


@query("assemble", f"""{_features_sql().replace(GRID_SQL, LAG_SQL)}, full0 AS (SELECT * FROM feats WHERE {_COMPLETE}),
nd AS (SELECT series_id, count(DISTINCT driver) AS k FROM gated GROUP BY 1),
have AS (SELECT series_id, ds, count(*) AS k, string_agg(driver || '=' || printf('%.4f', round_even(value, 4)), ';' ORDER BY driver) AS told FROM gated WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT f.series_id, f.ds, round_even(f.lag_1, 6) + 0.0 AS lag_1, h.told FROM full0 f LEFT JOIN have h ON f.series_id = h.series_id AND f.ds = h.ds LEFT JOIN nd ON f.series_id = nd.series_id WHERE coalesce(h.k, 0) >= coalesce(nd.k, 0)""")
def assemble(spark, sf_dir):
    prices, _, _, chosen = _chosen(spark, sf_dir)
    full = features.complete_cases(features.engineer(prices))
    out = drivers.assemble(full, drivers.gated_drivers(prices, chosen))
    told = F.array_join(F.transform(F.array_sort(F.map_entries("drivers")), lambda e: F.concat(e["key"], F.lit("="), F.format_string("%.4f", S.round_to(e["value"], 4)))), ";")
    return rounded(out.select("series_id", "ds", "lag_1", told.alias("told")))


WINDOW_SQL = f"""{{base}}, last0 AS (SELECT series_id, max(ds) AS last, count(*) FILTER (WHERE ds >= DATE '{ANCHOR}') AS n FROM grid WHERE price IS NOT NULL GROUP BY 1),
ends AS (SELECT series_id, last, n, unnest(range(1, n + 1)) AS window_no FROM last0 WHERE n > 0),
wins AS (SELECT series_id, window_no, CAST(last + to_months(CAST(window_no - n AS INTEGER)) AS DATE) AS train_end FROM ends)"""


@query("backtest_windows", f"WITH {WINDOW_SQL.format(base=GRID_SQL)} SELECT w.series_id, w.window_no, w.train_end, count(g.price) AS n_train FROM wins w LEFT JOIN grid g ON g.series_id = w.series_id AND g.ds <= w.train_end GROUP BY 1, 2, 3")
def backtest_windows(spark, sf_dir):
    return rounded(calendar.backtest_windows(_prices(spark, sf_dir), ANCHOR))


KNOWN_SQL = f"""{WINDOW_SQL.format(base=LAG_SQL)}, known AS (SELECT d.series_id, d.driver, w.window_no, w.train_end, arg_max(d.raw, d.ds) AS value, max(d.ds) AS known_at FROM fact_driver d JOIN wins w ON d.series_id = w.series_id AND d.ds <= w.train_end GROUP BY 1, 2, 3, 4)"""


@query("last_known", f"WITH {KNOWN_SQL} SELECT series_id, driver, window_no, {rounds('value')}, known_at FROM known")
def last_known(spark, sf_dir):
    prices = _prices(spark, sf_dir)
    return rounded(drivers.last_known(tables.fact_driver(spark, sf_dir), calendar.backtest_windows(prices, ANCHOR)))


@query("lagged_future", f"""WITH {KNOWN_SQL}, told AS (SELECT series_id, driver, window_no, CAST(known_at + to_months(CAST(k AS INTEGER)) AS DATE) AS source, value AS projected FROM known, (SELECT unnest(range(1, 19)) AS k)),
fut AS (SELECT w.series_id, w.window_no, w.train_end, s.step, CAST(w.train_end + to_months(CAST(s.step AS INTEGER)) AS DATE) AS ds, c.driver, CAST(w.train_end + to_months(CAST(s.step - c.lag AS INTEGER)) AS DATE) AS source FROM wins w, (SELECT unnest(range(1, 19)) AS step) s, chosen c WHERE c.series_id = w.series_id),
j AS (SELECT f.*, CASE WHEN f.source <= f.train_end THEN d.raw END AS real, t.projected FROM fut f LEFT JOIN fact_driver d ON d.series_id = f.series_id AND d.driver = f.driver AND d.ds = f.source LEFT JOIN told t ON t.series_id = f.series_id AND t.driver = f.driver AND t.window_no = f.window_no AND t.source = f.source)
SELECT series_id, driver, window_no, step, ds, source, round_even(coalesce(real, projected), 6) + 0.0 AS value, CASE WHEN real IS NOT NULL THEN 'real' WHEN projected IS NOT NULL THEN 'projected' ELSE 'none' END AS origin FROM j""")
def lagged_future(spark, sf_dir):
    prices, driver, scores, _ = _chosen(spark, sf_dir)
    windows = calendar.backtest_windows(prices, ANCHOR)
    told = drivers.project_flat(driver, windows, 18)
    return rounded(drivers.lagged_future(driver, scores.where("selected"), told, windows, 18))


# --- selection ----------------------------------------------------------------

PAIR_SQL = f"""{LAG_SQL}, pairc AS (SELECT a.series_id, a.driver AS a, b.driver AS b, {_CORR('a.raw', 'b.raw')} AS corr FROM fact_driver a JOIN fact_driver b ON a.series_id = b.series_id AND a.ds = b.ds AND a.driver < b.driver GROUP BY 1, 2, 3)"""
STRENGTH_SQL = PAIR_SQL + ", strength AS (SELECT series_id, driver AS name, abs(pearson) AS strength, pearson AS corr FROM lag_score WHERE selected)"


def _strength(spark, sf_dir):
    scores = drivers.lag_search(_prices(spark, sf_dir), tables.fact_driver(spark, sf_dir))
    return scores.where("selected").select("series_id", F.col("driver").alias("name"), F.abs("pearson").alias("strength"), F.col("pearson").alias("corr"))


@query("pair_correlations", f"WITH {PAIR_SQL} SELECT series_id, a, b, {rounds('corr')} FROM pairc")
def pair_correlations(spark, sf_dir):
    return rounded(selection.pair_correlations(tables.fact_driver(spark, sf_dir), "driver", "raw"))


@query("greedy_redundancy", f"""WITH RECURSIVE {STRENGTH_SQL}, placed AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY round_even(strength, 9) DESC NULLS LAST, name) AS place FROM strength),
walk AS (SELECT series_id, 1 AS place, [name] AS kept FROM placed WHERE place = 1
 UNION ALL SELECT p.series_id, p.place, CASE WHEN EXISTS (SELECT 1 FROM pairc c WHERE c.series_id = p.series_id AND abs(c.corr) > 0.5 AND ((c.a = p.name AND list_contains(w.kept, c.b)) OR (c.b = p.name AND list_contains(w.kept, c.a)))) THEN w.kept ELSE list_append(w.kept, p.name) END
 FROM walk w JOIN placed p ON p.series_id = w.series_id AND p.place = w.place + 1),
last_walk AS (SELECT series_id, arg_max(kept, place) AS kept FROM walk GROUP BY 1)
SELECT p.series_id, p.name, round_even(p.strength, 6) + 0.0 AS strength, p.place, list_contains(l.kept, p.name) AS kept FROM placed p JOIN last_walk l USING (series_id)""")
def greedy_redundancy(spark, sf_dir):
    pairs = selection.pair_correlations(tables.fact_driver(spark, sf_dir), "driver", "raw")
    return rounded(selection.greedy_redundancy(_strength(spark, sf_dir), pairs, 0.5))


_LONG_SQL = f"""{_features_sql().removeprefix('WITH ')}, full0 AS (SELECT * FROM feats WHERE {_COMPLETE}), wide0 AS (SELECT series_id, ds, price, {', '.join(f'CAST({n} AS DOUBLE) AS {n}' for n in _FEATURES)} FROM full0), long0 AS (UNPIVOT wide0 ON {', '.join(_FEATURES)} INTO NAME name VALUE value)"""


@query("feature_redundancy", f"""WITH RECURSIVE {_LONG_SQL}, pairc AS (SELECT a.series_id, a.name AS a, b.name AS b, {_CORR('a.value', 'b.value')} AS corr FROM long0 a JOIN long0 b ON a.series_id = b.series_id AND a.ds = b.ds AND a.name < b.name GROUP BY 1, 2, 3),
high AS MATERIALIZED (SELECT series_id, a, b FROM pairc WHERE abs(corr) > 0.7 UNION ALL SELECT series_id, b, a FROM pairc WHERE abs(corr) > 0.7),
clash AS MATERIALIZED (SELECT series_id, a AS name, list(b) AS others FROM high GROUP BY 1, 2),
strength AS (SELECT series_id, name, abs({_CORR('price', 'value')}) AS strength FROM long0 GROUP BY 1, 2),
placed AS MATERIALIZED (SELECT s.*, coalesce(c.others, []) AS others, row_number() OVER (PARTITION BY s.series_id ORDER BY round_even(strength, 9) DESC NULLS LAST, s.name) AS place FROM strength s LEFT JOIN clash c ON c.series_id = s.series_id AND c.name = s.name),
walk AS (SELECT series_id, 1 AS place, [name] AS kept FROM placed WHERE place = 1
 UNION ALL SELECT p.series_id, p.place, CASE WHEN p.strength IS NOT NULL AND list_has_any(w.kept, p.others) THEN w.kept ELSE list_append(w.kept, p.name) END FROM walk w JOIN placed p ON p.series_id = w.series_id AND p.place = w.place + 1),
last_walk AS (SELECT series_id, arg_max(kept, place) AS kept FROM walk GROUP BY 1)
SELECT p.series_id, p.name, round_even(p.strength, 6) + 0.0 AS strength, p.place, list_contains(l.kept, p.name) AS kept FROM placed p JOIN last_walk l USING (series_id)""")
def feature_redundancy(spark, sf_dir):
    full = features.complete_cases(features.engineer(_prices(spark, sf_dir)))
    long = full.select("series_id", "ds", "price", *(F.col(n).cast("double").alias(n) for n in _FEATURES)).unpivot(["series_id", "ds", "price"], _FEATURES, "name", "value")
    strength = long.groupBy("series_id", "name").agg(F.abs(selection.safe_corr("price", "value")).alias("strength"))
    return rounded(selection.greedy_redundancy(strength, selection.pair_correlations(long, "name", "value")))


_SHARES = STRENGTH_SQL + ", shares AS (SELECT series_id, name, corr, strength / nullif(sum(strength) OVER (PARTITION BY series_id), 0) AS score FROM strength)"


def _shares(spark, sf_dir):
    return selection.normalise(_strength(spark, sf_dir), "strength", "score").select("series_id", "name", "corr", "score")


@query("select_top_n", f"WITH {_SHARES} SELECT series_id, name, {rounds('corr', 'score')}, row_number() OVER (PARTITION BY series_id ORDER BY round_even(score, 9) DESC NULLS LAST, name) <= 3 AS chosen FROM shares")
def select_top_n(spark, sf_dir):
    return rounded(selection.select_by("top_n", _shares(spark, sf_dir), 3))


@query("select_threshold", f"WITH {_SHARES} SELECT series_id, name, {rounds('corr', 'score')}, coalesce(score >= 0.15, false) AS chosen FROM shares")
def select_threshold(spark, sf_dir):
    return rounded(selection.select_by("threshold", _shares(spark, sf_dir), 0.15))


@query("select_relative", f"WITH {_SHARES} SELECT series_id, name, {rounds('corr', 'score')}, coalesce(score >= 1.2 / count(*) OVER (PARTITION BY series_id), false) AS chosen FROM shares")
def select_relative(spark, sf_dir):
    return rounded(selection.select_by("relative_threshold", _shares(spark, sf_dir)))


@query("any_criterion", f"""WITH {_SHARES}, marked AS (SELECT series_id, name, 0 AS o, 'relative' AS label FROM (SELECT *, score >= 1.2 / count(*) OVER (PARTITION BY series_id) AS c FROM shares) WHERE c
 UNION ALL SELECT series_id, name, 1, 'correlation' FROM shares WHERE abs(corr) > 0.1 UNION ALL SELECT series_id, name, 2, 'top' FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY round_even(score, 9) DESC NULLS LAST, name) AS k FROM shares) WHERE k <= 1)
SELECT series_id, name, arg_min(label, o) AS criterion, count(DISTINCT o) AS n_criteria FROM marked GROUP BY 1, 2""")
def any_criterion(spark, sf_dir):
    shares = _shares(spark, sf_dir)
    return selection.any_criterion({"relative": selection.above_relative(shares), "correlation": selection.above_correlation(shares, 0.1), "top": selection.top_n(shares, 1)})


@query("overrides", f"""WITH {_SHARES}, picked AS (SELECT series_id, name FROM shares WHERE abs(corr) > 0.1),
flags AS (SELECT s.series_id, s.name, p.name IS NOT NULL AS picked, (s.series_id LIKE '%1' AND s.name = 'orders') OR s.series_id LIKE '%2' AS must, s.series_id LIKE '%3' AND s.name = 'tax' AS never FROM shares s LEFT JOIN picked p ON s.series_id = p.series_id AND s.name = p.name)
SELECT series_id, name, CASE WHEN picked THEN 'selected' ELSE 'manual' END AS origin FROM flags WHERE (picked OR must) AND NOT never""")
def overrides(spark, sf_dir):
    shares = _shares(spark, sf_dir)
    ends = lambda d: F.col("series_id").endswith(d)
    rules = shares.select("series_id").distinct().select("series_id", F.when(ends("1"), F.array(F.lit("orders"))).when(ends("2"), F.array(F.lit("ALL"))).alias("must_include"), F.when(ends("3"), F.array(F.lit("tax"))).alias("force_exclude"))
    return selection.apply_overrides(shares, shares.where("abs(corr) > 0.1"), rules)


@query("cumulative_cut", f"WITH {_SHARES}, c AS (SELECT series_id, name, score, sum(score) OVER (PARTITION BY series_id ORDER BY score DESC, name ROWS UNBOUNDED PRECEDING) AS cumulative FROM shares) SELECT series_id, name, {rounds('score', 'cumulative')}, coalesce(cumulative - score < 0.7, false) AS chosen FROM c")
def cumulative_cut(spark, sf_dir):
    return rounded(selection.cumulative_cut(_shares(spark, sf_dir).drop("corr")))


# --- backtest, score, recommendation ---------------------------------------

NAIVE_SQL = f"""{WINDOW_SQL.format(base=GRID_SQL)}, lastp AS (SELECT w.series_id, w.window_no, w.train_end, arg_max(g.price, g.ds) AS last, arg_min(g.price, g.ds) AS first, count(*) AS n FROM wins w JOIN grid g ON g.series_id = w.series_id AND g.ds <= w.train_end AND g.price IS NOT NULL GROUP BY 1, 2, 3),
steps AS (SELECT *, CAST(train_end + to_months(CAST(step AS INTEGER)) AS DATE) AS ds, CAST(train_end + to_months(CAST(step - 12 * ceil(step / 12.0) AS INTEGER)) AS DATE) AS source FROM (SELECT *, unnest(range(1, 19)) AS step FROM lastp)),
seas AS (SELECT s.*, g.price AS season_price FROM steps s LEFT JOIN grid g ON g.series_id = s.series_id AND g.ds = s.source),
fc0 AS (SELECT series_id, 'last_value' AS technique, window_no, train_end, step, ds, last AS predicted FROM seas UNION ALL SELECT series_id, 'seasonal_naive', window_no, train_end, step, ds, coalesce(season_price, last) FROM seas
 UNION ALL SELECT series_id, 'drift', window_no, train_end, step, ds, coalesce(last + step * (last - first) / nullif(n - 1, 0), last) FROM seas),
fc AS (SELECT * REPLACE (round_even(predicted, 6) AS predicted) FROM fc0)"""
_RANGE = "(VALUES ('short', 1, 3), ('medium', 4, 6), ('long', 7, 18)) hz(horizon, a, b)"
_HIT = lambda base: f"CASE WHEN actual IS NOT NULL AND {base} IS NOT NULL THEN CAST((actual > {base}) = (predicted > {base}) AS INTEGER) END"
DETAIL_SQL = f"""{NAIVE_SQL}, rows0 AS (SELECT f.*, hz.horizon, a.price AS actual, s.price AS anchor FROM fc f JOIN {_RANGE} ON f.step BETWEEN hz.a AND hz.b LEFT JOIN grid a ON a.series_id = f.series_id AND a.ds = f.ds LEFT JOIN grid s ON s.series_id = f.series_id AND s.ds = f.train_end WHERE predicted IS NOT NULL),
rows1 AS (SELECT *, coalesce(lag(predicted) OVER (PARTITION BY series_id, technique, horizon, window_no ORDER BY step), anchor) AS before FROM rows0),
detail AS (SELECT series_id, technique, horizon, window_no, train_end, CAST(train_end + INTERVAL 1 MONTH AS DATE) AS forecast_start, step, ds, predicted, actual, {_HIT('before')} AS da_mom, {_HIT('anchor')} AS da_abs,
 CASE WHEN actual IS NOT NULL THEN 'Actual' ELSE 'No Actual Yet' END AS flag, round_even(abs(actual - predicted), 4) AS abs_err, round_even(abs((actual - predicted) / nullif(actual, 0)) * 100, 4) AS ape,
 round_even(abs(actual - predicted), 4) AS mae, round_even(abs(actual - predicted) * abs(actual - predicted), 4) AS mse, round_even(abs(actual - predicted), 4) AS rmse,
 round_even(abs((actual - predicted) / nullif(actual, 0)) * 100, 4) AS mape, round_even((actual - predicted) / nullif(actual, 0) * 100, 4) AS mpe,
 CASE WHEN actual <> 0 THEN round_even(greatest(0.0, 100 - abs((actual - predicted) / actual) * 100), 4) END AS accuracy FROM rows1),
summary AS (SELECT series_id, technique, horizon, window_no, train_end, forecast_start, count(*) FILTER (WHERE flag = 'Actual') AS months_evaluated, avg(mae) AS mae, sqrt(avg(mse)) AS rmse, avg(mape) AS mape, avg(mpe) AS mpe, avg(accuracy) AS avg_accuracy, avg(da_mom) * 100 AS da, avg(da_abs) * 100 AS da_abs FROM detail GROUP BY ALL)"""


def _naive(spark, sf_dir):
    prices = _prices(spark, sf_dir)
    windows = calendar.backtest_windows(prices, ANCHOR)
    return prices, backtest.naive_forecasts(prices, windows, 18)


def _detail(spark, sf_dir):
    prices, made = _naive(spark, sf_dir)
    return prices, backtest.evaluate_all(made, prices, HORIZONS["monthly"])


@query("backtest_detail", f"WITH {DETAIL_SQL} SELECT * REPLACE (mse + 0.0 AS mse) FROM detail")
def backtest_detail(spark, sf_dir):
    return rounded(_detail(spark, sf_dir)[1])


@query("backtest_summary", f"WITH {DETAIL_SQL} SELECT series_id, technique, horizon, window_no, train_end, forecast_start, months_evaluated, {rounds('mae', 'rmse', 'mape', 'mpe', 'avg_accuracy', 'da', 'da_abs')} FROM summary")
def backtest_summary(spark, sf_dir):
    return rounded(backtest.summarise(_detail(spark, sf_dir)[1]))


_WIN = list(range(1, 5))


@query("vintage_matrix", f"""WITH {DETAIL_SQL}, d AS (SELECT * FROM detail WHERE technique = 'drift' AND horizon = 'short'), runs AS (SELECT DISTINCT series_id, technique, horizon, window_no, train_end FROM d),
v AS (SELECT r.series_id, r.technique, r.horizon, r.window_no, g.ds, g.price AS value FROM runs r JOIN grid g ON g.series_id = r.series_id AND g.ds <= r.train_end AND g.price IS NOT NULL UNION ALL SELECT series_id, technique, horizon, window_no, ds, predicted FROM d)
SELECT series_id, technique, horizon, ds, {', '.join(f'round_even(max(value) FILTER (WHERE window_no = {w}), 6) + 0.0 AS w{w}' for w in _WIN)}, strftime(ds, '%b-%Y') AS period FROM v GROUP BY 1, 2, 3, 4""")
def vintage_matrix(spark, sf_dir):
    prices, detail = _detail(spark, sf_dir)
    return rounded(backtest.vintage_matrix(detail.where("technique = 'drift' and horizon = 'short'"), prices, _WIN))


_K = "series_id, technique, horizon"
SCORE_SQL = f"""{DETAIL_SQL}, cyc AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY {_K} ORDER BY train_end DESC) <= 2 THEN 1.5 ELSE 1.0 END AS w, CASE WHEN horizon = 'long' THEN da_abs ELSE da END AS dir FROM summary WHERE months_evaluated > 0),
pc AS (SELECT {_K}, count(*) AS evaluated_cycles, avg(CASE WHEN dir IS NOT NULL THEN least(100.0, greatest(0.0, dir)) END) AS direction, avg(mpe) AS mean_mpe, sum(CASE WHEN mape IS NOT NULL THEN least(100.0, greatest(0.0, 100 - mape)) * w END) / sum(CASE WHEN mape IS NOT NULL THEN w END) AS recency FROM cyc GROUP BY ALL),
ra AS (SELECT {_K}, avg(accuracy) AS accuracy FROM detail GROUP BY ALL),
dw AS (SELECT {_K}, window_no, CASE WHEN count(predicted) >= 2 AND avg(predicted) <> 0 THEN stddev_samp(predicted) / abs(avg(predicted)) END AS cv_p, CASE WHEN count(actual) >= 2 AND avg(actual) <> 0 THEN stddev_samp(actual) / abs(avg(actual)) END AS cv_a, count(actual) AS na FROM detail GROUP BY ALL),
dy AS (SELECT {_K}, avg(CASE WHEN cv_a > 0 AND cv_p IS NOT NULL THEN least(100.0, greatest(0.0, 100 * (1 - abs(cv_p - cv_a) / cv_a))) END) AS dynamism, avg(cv_p * 100) AS pcv FROM dw WHERE na > 0 GROUP BY ALL),
bo AS (SELECT series_id, min(price) * 0.3 AS low, max(price) * 3.0 AS high FROM grid GROUP BY 1),
ou AS (SELECT {_K}, bool_or(predicted < low OR predicted > high) AS outlier FROM detail JOIN bo USING (series_id) WHERE (series_id, technique, horizon, window_no) IN (SELECT series_id, technique, horizon, window_no FROM cyc) GROUP BY ALL),
sc0 AS (SELECT r.*, coalesce(pc.evaluated_cycles, 0) AS evaluated_cycles, direction, mean_mpe, recency, accuracy, coalesce(dynamism, 0.0) AS dynamism, pcv, coalesce(outlier, false) AS outlier FROM (SELECT DISTINCT {_K} FROM summary) r LEFT JOIN pc USING ({_K}) LEFT JOIN ra USING ({_K}) LEFT JOIN dy USING ({_K}) LEFT JOIN ou USING ({_K})),
sc1 AS (SELECT *, evaluated_cycles < 3 AS insufficient_history, CASE WHEN horizon = 'long' AND pcv < 2 THEN -15.0 ELSE 0.0 END AS f, CASE WHEN outlier THEN -5.0 ELSE 0.0 END AS o, CASE WHEN abs(mean_mpe) > 10 THEN -10.0 ELSE 0.0 END AS b FROM sc0),
sc2 AS (SELECT *, NOT insufficient_history AND accuracy < 75 AND direction < 55 AS disqualified, greatest(0.0, (accuracy * 50 + direction * 25 + dynamism * 15 + recency * 10) / 100 + f + o + b) AS raw FROM sc1),
sc AS (SELECT {_K}, evaluated_cycles, insufficient_history, disqualified, CASE WHEN NOT insufficient_history THEN accuracy END AS accuracy, CASE WHEN NOT insufficient_history THEN direction END AS direction, CASE WHEN NOT insufficient_history THEN dynamism END AS dynamism, CASE WHEN NOT insufficient_history THEN recency END AS recency,
 CASE WHEN insufficient_history THEN 0.0 ELSE f END AS flat_penalty, CASE WHEN insufficient_history THEN 0.0 ELSE o END AS outlier_penalty, CASE WHEN insufficient_history THEN 0.0 ELSE b END AS bias_penalty, CASE WHEN NOT insufficient_history THEN mean_mpe END AS mean_mpe,
 CASE WHEN insufficient_history OR disqualified THEN 0.0 ELSE round_even(raw, 4) END AS composite,
 CASE WHEN disqualified THEN 'mape_accuracy_below_threshold; directional_accuracy_below_threshold' ELSE '' END AS reasons,
 CASE WHEN insufficient_history THEN 'insufficient_evaluated_cycles' ELSE concat_ws('; ', CASE WHEN accuracy < 85 THEN 'mape_accuracy_below_eligibility_threshold' END, CASE WHEN direction < 55 THEN 'directional_accuracy_below_eligibility_threshold' END) END AS soft FROM sc2),
scores AS (SELECT *, NOT disqualified AND soft = '' AS eligible, CASE WHEN disqualified OR insufficient_history THEN NULL WHEN composite >= 85 THEN 'HIGH' WHEN composite >= 75 THEN 'MEDIUM' ELSE 'LOW' END AS tier FROM sc),
ranks AS (SELECT *, row_number() OVER (PARTITION BY series_id, horizon ORDER BY composite DESC, technique) AS rank FROM scores)"""
_SCORED = "series_id, technique, horizon, evaluated_cycles, insufficient_history, disqualified, eligible, tier, reasons, soft, " + rounds("accuracy", "direction", "dynamism", "recency", "flat_penalty", "outlier_penalty", "bias_penalty", "mean_mpe", "composite", places=5)


def _scores(spark, sf_dir):
    prices, detail = _detail(spark, sf_dir)
    detail = _save(spark)(detail)
    return scoring.score(detail, backtest.summarise(detail), prices, dim_technique(spark))


def _ranks(spark, sf_dir):
    return scoring.ranked(_scores(spark, sf_dir), dim_technique(spark))


def _flat(df, *more):
    return rounded(df.select("series_id", "technique", "horizon", "evaluated_cycles", "insufficient_history", "disqualified", "eligible", "tier", F.array_join("disqualification_reasons", "; ").alias("reasons"), F.array_join("ineligibility_reasons", "; ").alias("soft"), "accuracy", "direction", "dynamism", "recency", "flat_penalty", "outlier_penalty", "bias_penalty", "mean_mpe", "composite", *more), 5)


@query("composite_score", f"WITH {SCORE_SQL} SELECT {_SCORED} FROM scores")
def composite_score(spark, sf_dir):
    return _flat(_scores(spark, sf_dir))


@query("technique_ranks", f"WITH {SCORE_SQL} SELECT {_SCORED}, rank FROM ranks")
def technique_ranks(spark, sf_dir):
    return _flat(_ranks(spark, sf_dir), "rank")


BEST_SQL = SCORE_SQL + """, pick AS (SELECT *, row_number() OVER (PARTITION BY series_id, horizon ORDER BY rank) AS k FROM ranks WHERE eligible),
spine AS (SELECT series_id, horizon, count(*) FILTER (WHERE eligible) AS n_eligible FROM ranks GROUP BY 1, 2)"""
_NUM = lambda e: f"printf('%.1f', {e})"
_SIGN = lambda e: f"CASE WHEN {e} < 0 THEN '-' ELSE '+' END || printf('%.0f', abs({e}))"
REASON_SQL = f"""CASE WHEN b.technique IS NULL THEN '{scoring.NO_TECHNIQUE}' ELSE concat_ws(' ',
 'Highest composite score (' || {_NUM('b.composite')} || ', ' || b.tier || ') among ' || s.n_eligible || CASE WHEN s.n_eligible = 1 THEN ' eligible technique.' ELSE ' eligible techniques.' END,
 'Driven by ' || nullif(concat_ws(', ', CASE WHEN b.accuracy >= 90 THEN 'strong MAPE accuracy (' || {_NUM('b.accuracy')} || '%)' END, CASE WHEN b.direction >= 70 THEN 'strong directional accuracy (' || {_NUM('b.direction')} || '%)' END, CASE WHEN b.dynamism >= 70 THEN 'healthy forecast dynamism (' || {_NUM('b.dynamism')} || ')' END), '') || '.',
 'Note: ' || nullif(concat_ws(', ', CASE WHEN b.flat_penalty <> 0 THEN 'flat-line penalty (' || {_SIGN('b.flat_penalty')} || ')' END, CASE WHEN b.outlier_penalty <> 0 THEN 'outlier-cap penalty (' || {_SIGN('b.outlier_penalty')} || ')' END, CASE WHEN b.bias_penalty <> 0 THEN 'normalized-bias penalty (' || {_SIGN('b.bias_penalty')} || ', mean MPE ' || {_NUM('b.mean_mpe')} || '%)' END), '') || ' applied.',
 'Runner-up (' || r.technique || ', ' || {_NUM('r.composite')} || ') trails by ' || {_NUM('b.composite - r.composite')} || ' points.') END"""


@query("recommendation", f"WITH {BEST_SQL} SELECT s.series_id, s.horizon, s.n_eligible, b.technique AS best, r.technique AS runner_up, {REASON_SQL} AS key_reason FROM spine s LEFT JOIN pick b ON b.series_id = s.series_id AND b.horizon = s.horizon AND b.k = 1 LEFT JOIN pick r ON r.series_id = s.series_id AND r.horizon = s.horizon AND r.k = 2")
def recommendation(spark, sf_dir):
    return scoring.recommend(_ranks(spark, sf_dir)).select("series_id", "horizon", "n_eligible", F.col("best.technique").alias("best"), F.col("runner_up.technique").alias("runner_up"), "key_reason")


# --- third-party vintages ---------------------------------------------------------

VINTAGE_SQL = f"""{GRID_SQL}, rp AS (SELECT * FROM grid WHERE price IS NOT NULL),
vm AS (SELECT v.series_id, v.ds AS vintage, round_even(avg(p.price), 4) AS value FROM rp v JOIN rp p ON p.series_id = v.series_id AND p.ds < v.ds AND p.ds >= CAST(v.ds - INTERVAL 12 MONTH AS DATE) GROUP BY 1, 2 HAVING count(*) = 12),
ahead AS (SELECT series_id, vintage, CAST(vintage + to_months(CAST(k AS INTEGER)) AS DATE) AS target, round_even(value * (1 + k * 0.001), 4) AS value FROM vm, (SELECT unnest(range(18)) AS k)),
vint AS (SELECT * FROM ahead UNION ALL SELECT l.series_id, l.vintage, p.ds, p.price FROM (SELECT series_id, max(vintage) AS vintage FROM vm GROUP BY 1) l JOIN rp p ON p.series_id = l.series_id AND p.ds < l.vintage),
fv AS (SELECT series_id, vintage, target, value AS predicted FROM vint WHERE target >= vintage AND value IS NOT NULL),
bd0 AS (SELECT f.*, a.price AS actual, b.price AS baseline FROM fv f JOIN rp b ON b.series_id = f.series_id AND CAST(b.ds + INTERVAL 1 MONTH AS DATE) = f.vintage JOIN rp a ON a.series_id = f.series_id AND a.ds = f.target WHERE f.target <= DATE '2001-11-01'),
bd1 AS (SELECT *, row_number() OVER w AS m_step, coalesce(lag(predicted) OVER w, baseline) AS before FROM bd0 WINDOW w AS (PARTITION BY series_id, vintage ORDER BY target)),
bd AS (SELECT series_id, dense_rank() OVER (PARTITION BY series_id ORDER BY vintage) AS sort_order, vintage, target, m_step, predicted, actual, {_HIT('before')} AS da_mom, {_HIT('baseline')} AS da_abs,
 round_even(abs(actual - predicted), 4) AS mae, round_even(abs(actual - predicted) * abs(actual - predicted), 4) AS mse, round_even(abs((actual - predicted) / nullif(actual, 0)) * 100, 4) AS mape, round_even((actual - predicted) / nullif(actual, 0) * 100, 4) AS mpe, CASE WHEN actual <> 0 THEN round_even(greatest(0.0, 100 - abs((actual - predicted) / actual) * 100), 4) END AS accuracy FROM bd1)"""


def _vendor(spark, sf_dir):
    prices = _prices(spark, sf_dir)
    vintages = benchmark.trailing_mean_vintages(prices)
    return prices, vintages, benchmark.benchmark_detail(benchmark.forecast_vintages(vintages), prices, "2001-11-01")


@query("settled_actuals", f"WITH {VINTAGE_SQL} SELECT v.series_id, v.target AS ds, v.value AS price FROM vint v JOIN (SELECT series_id, max(vintage) AS m FROM vint GROUP BY 1) l ON l.series_id = v.series_id AND l.m = v.vintage WHERE v.target < v.vintage AND v.value IS NOT NULL")
def settled_actuals(spark, sf_dir):
    return benchmark.settled_actuals(_vendor(spark, sf_dir)[1])


@query("forecast_vintages", f"WITH {VINTAGE_SQL} SELECT * FROM fv")
def forecast_vintages(spark, sf_dir):
    return benchmark.forecast_vintages(_vendor(spark, sf_dir)[1])


@query("benchmark_detail", f"WITH {VINTAGE_SQL} SELECT series_id, sort_order, vintage, target, m_step, predicted, actual, da_mom, da_abs, {rounds('mae', 'mse', 'mape', 'mpe', 'accuracy')} FROM bd")
def benchmark_detail(spark, sf_dir):
    return rounded(_vendor(spark, sf_dir)[2].drop("abs_err", "ape", "rmse"))


_RNG = "(VALUES ('M1-M3', 1, 3), ('M4-M6', 4, 6), ('M7-M18', 7, 18), ('M4-M18', 4, 18)) r(range, a, b)"


@query("cycle_averages", f"WITH {VINTAGE_SQL} SELECT series_id, r.range, vintage, count(*) AS months, {', '.join(f'round_even(avg({c}) * {k}, {p}) + 0.0 AS {n}' for c, k, p, n in (('accuracy', 1, 2, 'accuracy'), ('mape', 1, 2, 'mape'), ('da_mom', 100, 1, 'da'), ('da_abs', 100, 1, 'da_abs'), ('mae', 1, 2, 'mae'), ('mae', 1, 2, 'rmse')))} FROM bd JOIN {_RNG} ON m_step BETWEEN r.a AND r.b GROUP BY 1, 2, 3")
def cycle_averages(spark, sf_dir):
    return rounded(benchmark.cycle_averages(_vendor(spark, sf_dir)[2]))


@query("range_table_short", f"""WITH {VINTAGE_SQL} SELECT series_id, sort_order, vintage, count(*) || '/3M' AS "Months Available", {', '.join(f'''coalesce(max(strftime(target, '%b-%Y')) FILTER (WHERE m_step = {i}), '—') AS "M{i} Date", max(round_even(accuracy, 2)) FILTER (WHERE m_step = {i}) AS "M{i} Accuracy", max(round_even(mape, 2)) FILTER (WHERE m_step = {i}) AS "M{i} MAPE (%)", max(da_mom) FILTER (WHERE m_step = {i}) AS "M{i} DA", max(da_abs) FILTER (WHERE m_step = {i}) AS "M{i} Abs DA"''' for i in (1, 2, 3))},
 round_even(avg(accuracy), 2) AS "Avg Accuracy (%)", round_even(avg(mape), 2) AS "Avg MAPE (%)", round_even(avg(da_mom) * 100, 1) AS "Avg DA (%)", round_even(avg(da_abs) * 100, 1) AS "Avg Abs DA (%)", round_even(avg(mae), 2) AS "Avg MAE", round_even(avg(mae), 2) AS "Avg RMSE", strftime(vintage, '%b-%Y') AS "Predicted From" FROM bd WHERE m_step <= 3 GROUP BY 1, 2, 3""")
def range_table_short(spark, sf_dir):
    return rounded(benchmark.range_table(_vendor(spark, sf_dir)[2], "M1-M3"))


@query("range_table_long", f"""WITH {VINTAGE_SQL} SELECT series_id, sort_order, vintage, count(*) || '/12M' AS "Months Available", {', '.join(f'''coalesce(max(strftime(target, '%b-%Y')) FILTER (WHERE m_step = {i}), '—') AS "M{i} Date", max(round_even(accuracy, 2)) FILTER (WHERE m_step = {i}) AS "M{i} Accuracy", max(round_even(mape, 2)) FILTER (WHERE m_step = {i}) AS "M{i} MAPE (%)", max(da_mom) FILTER (WHERE m_step = {i}) AS "M{i} DA", max(da_abs) FILTER (WHERE m_step = {i}) AS "M{i} Abs DA"''' for i in range(7, 19))},
 round_even(avg(accuracy), 2) AS "Avg Accuracy (%)", round_even(avg(mape), 2) AS "Avg MAPE (%)", round_even(avg(da_mom) * 100, 1) AS "Avg DA (%)", round_even(avg(da_abs) * 100, 1) AS "Avg Abs DA (%)", round_even(avg(mae), 2) AS "Avg MAE", round_even(avg(mae), 2) AS "Avg RMSE", strftime(vintage, '%b-%Y') AS "Predicted From" FROM bd WHERE m_step BETWEEN 7 AND 18 GROUP BY 1, 2, 3""")
def range_table_long(spark, sf_dir):
    return rounded(benchmark.range_table(_vendor(spark, sf_dir)[2], "M7-M18"))


def _benchmark_scores(spark, sf_dir):
    prices, _, detail = _vendor(spark, sf_dir)
    rows = benchmark.as_backtest(detail)
    scores = scoring.score(rows, backtest.summarise(rows), prices, dim_technique(spark), disqualify=False)
    mean = rows.groupBy("series_id", "horizon").agg(F.avg("accuracy").alias("benchmark_accuracy"))
    return scores.join(mean, ["series_id", "horizon"], "left")


_SCORE_TAIL = SCORE_SQL.removeprefix(DETAIL_SQL)
_OWN = ("detail", "summary", "cyc", "pc", "ra", "dw", "dy", "bo", "ou", "sc0", "sc1", "sc2", "sc", "scores", "ranks")
# The same scorer over the vendor's rows, its tables under names of their own; its scores are not set to 0 by a disqualification.
BENCH_SQL = f"""bdetail AS (SELECT series_id, 'benchmark' AS technique, r.horizon, sort_order AS window_no, CAST(vintage - INTERVAL 1 MONTH AS DATE) AS train_end, vintage AS forecast_start, m_step AS step, target AS ds, predicted, actual, da_mom, da_abs, 'Actual' AS flag, mae, mse, mape, mpe, accuracy FROM bd JOIN {_RANGE.replace('hz(horizon, a, b)', 'r(horizon, a, b)')} ON m_step BETWEEN r.a AND r.b),
bsummary AS (SELECT series_id, technique, horizon, window_no, train_end, forecast_start, count(*) AS months_evaluated, avg(mape) AS mape, avg(mpe) AS mpe, avg(accuracy) AS avg_accuracy, avg(da_mom) * 100 AS da, avg(da_abs) * 100 AS da_abs FROM bdetail GROUP BY ALL)""" + re.sub(
    rf"\b({'|'.join(_OWN)})\b", r"b\1", _SCORE_TAIL
).replace("CASE WHEN insufficient_history OR disqualified THEN 0.0", "CASE WHEN insufficient_history THEN 0.0") + ", bmean AS (SELECT series_id, horizon, avg(accuracy) AS benchmark_accuracy FROM bdetail GROUP BY 1, 2)"


@query("benchmark_score", f"WITH {VINTAGE_SQL}, {BENCH_SQL} SELECT {_SCORED}, round_even(benchmark_accuracy, 5) + 0.0 AS benchmark_accuracy FROM bscores LEFT JOIN bmean USING (series_id, horizon)")
def benchmark_score(spark, sf_dir):
    return _flat(_benchmark_scores(spark, sf_dir), "benchmark_accuracy")


def _regions(spark, sf_dir):
    nation = tables.read(spark, sf_dir, "nation").select(F.concat(F.lit("Brand#"), (F.floor(F.col("n_nationkey") / 5) + 1).cast("string"), (F.col("n_nationkey") % 5 + 1).cast("string")).alias("series_id"), "n_regionkey")
    region = tables.read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    return nation.join(region, "n_regionkey").select("series_id", "region")


_SHOWN = "CASE {} WHEN 'short' THEN 'Short Term' WHEN 'medium' THEN 'Medium Term' WHEN 'long' THEN 'Long Term' ELSE {} END"
_REGION_SQL = "regions AS (SELECT 'Brand#' || (n_nationkey // 5 + 1) || (n_nationkey % 5 + 1) AS series_id, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey)"
_SHEET = (("accuracy", "MAPE Accuracy %"), ("direction", "Directional Accuracy %"), ("dynamism", "Forecast Dynamism"), ("recency", "Recency Score"), ("flat_penalty", "Flat-line Penalty"), ("outlier_penalty", "Outlier Penalty"), ("composite", "Composite Score"))


def _sheet_sql(technique, rank, eligible, why, known, source):
    yes = lambda c: f"CASE WHEN {known} THEN CASE WHEN {c} THEN 'Y' ELSE 'N' END END"
    numbers = ", ".join(f'round_even({c}, 4) + 0.0 AS "{n}"' for c, n in _SHEET)
    return f"""SELECT x.series_id AS "Commodity", region AS "Region", {_SHOWN.format('x.horizon', 'x.horizon')} AS "Horizon", {technique} AS "Technique", {yes('NOT disqualified')} AS "Eligible (Y/N)", CASE WHEN {known} THEN reasons END AS "Disqualification Reason", {numbers},
 CAST({rank} AS BIGINT) AS "Rank", {eligible} AS "Eligible For Recommendation (Y/N)", {why} AS "Ineligibility Reason", round_even(bias_penalty, 4) + 0.0 AS "Normalized Bias Penalty", round_even(mean_mpe, 4) + 0.0 AS "Mean MPE (%)", evaluated_cycles AS "Evaluated Cycles",
 {yes('insufficient_history')} AS "Insufficient History (Y/N)", round_even(benchmark_accuracy, 4) + 0.0 AS "Benchmark Accuracy (%)" FROM {source} LEFT JOIN bmean m ON m.series_id = x.series_id AND m.horizon = x.horizon LEFT JOIN regions g ON g.series_id = x.series_id"""


_VINTAGE_TAIL = VINTAGE_SQL.removeprefix(GRID_SQL)


@query("score_summary", f"WITH {SCORE_SQL}{_VINTAGE_TAIL}, {BENCH_SQL}, {_REGION_SQL}, spine AS (SELECT DISTINCT series_id, horizon FROM ranks) "
    + _sheet_sql("'Benchmark'", "0", "'N'", "'not_a_recommendable_technique'", "composite IS NOT NULL", "(SELECT s.series_id, s.horizon, b.* EXCLUDE (series_id, horizon) FROM spine s LEFT JOIN bscores b ON b.series_id = s.series_id AND b.horizon = s.horizon) x")
    + " UNION ALL " + _sheet_sql("technique", "rank", "CASE WHEN eligible THEN 'Y' ELSE 'N' END", "soft", "true", "ranks x"))
def score_summary(spark, sf_dir):
    return rounded(scoring.summary_table(_ranks(spark, sf_dir), _regions(spark, sf_dir), _benchmark_scores(spark, sf_dir)), 4)


_BLOCK = lambda prefix, t: f'{t}.technique AS "{prefix} Technique", ' + ", ".join(f'round_even({t}.{c}, 4) + 0.0 AS "{prefix} - {n}"' for c, n in _SHEET if "penalty" not in c)


@query("forecast_rows", f"""WITH {BEST_SQL} SELECT s.series_id AS "Commodity", {_SHOWN.format('s.horizon', 's.horizon')} AS "Horizon", {_BLOCK('Best', 'b')}, {_BLOCK('Runner-Up', 'r')}, b.tier AS "Confidence Tier", {REASON_SQL} AS "Key Reason",
 CASE WHEN b.technique IS NULL THEN 'Pending: no eligible technique to default to' ELSE 'Pending (auto-defaulted to top score; awaiting analyst review)' END AS "Decision Log Status"
 FROM spine s LEFT JOIN pick b ON b.series_id = s.series_id AND b.horizon = s.horizon AND b.k = 1 LEFT JOIN pick r ON r.series_id = s.series_id AND r.horizon = s.horizon AND r.k = 2""")
def forecast_rows(spark, sf_dir):
    return rounded(scoring.forecast_rows(scoring.recommend(_ranks(spark, sf_dir))), 4)


# --- governance -----------------------------------------------------------------

LOG_SQL = f"""{BEST_SQL}, bestof AS (SELECT s.series_id, s.horizon, b.technique AS best FROM spine s LEFT JOIN pick b ON b.series_id = s.series_id AND b.horizon = s.horizon AND b.k = 1),
log AS (SELECT series_id, horizon, 'Confirmed' AS action, best AS technique, 'ana' AS analyst, '' AS justification, TIMESTAMP '2024-01-10 00:00:00' AS ts FROM bestof WHERE best IS NOT NULL AND series_id LIKE '%1'
 UNION ALL SELECT series_id, horizon, 'Overridden', 'arima', 'bo', 'market view', TIMESTAMP '2024-02-03 00:00:00' FROM bestof WHERE horizon = 'long' AND (series_id LIKE '%1' OR series_id LIKE '%2')),
latest AS (SELECT series_id, horizon, arg_max(action, ts) AS action, arg_max(technique, ts) AS technique, arg_max(analyst, ts) AS analyst, max(ts) AS ts FROM log GROUP BY 1, 2),
current AS (SELECT b.series_id, b.horizon, coalesce(l.action, 'Pending') AS action, coalesce(l.technique, b.best) AS technique, l.analyst, coalesce(l.action || ' by ' || l.analyst || ' on ' || strftime(l.ts, '%d-%b-%Y'), CASE WHEN b.best IS NULL THEN 'Pending: no eligible technique to default to' ELSE 'Pending (auto-defaulted to top score; awaiting analyst review)' END) AS status FROM bestof b LEFT JOIN latest l ON l.series_id = b.series_id AND l.horizon = b.horizon)"""


def _decisions(spark, sf_dir):
    best = _save(spark)(scoring.recommend(_ranks(spark, sf_dir)))
    ends = lambda d: F.col("series_id").endswith(d)
    confirmed = best.where(ends("1") & F.col("best").isNotNull()).select("series_id", "horizon", F.lit("ana").alias("analyst"), F.lit("2024-01-10").cast("timestamp").alias("ts"))
    other = best.where((F.col("horizon") == "long") & (ends("1") | ends("2"))).select("series_id", "horizon", F.lit("arima").alias("technique"), F.lit("bo").alias("analyst"), F.lit("market view").alias("justification"), F.lit("2024-02-03").cast("timestamp").alias("ts"))
    log = governance.confirm(governance.empty_log(spark), best, confirmed)
    return best, governance.override(log, dim_technique(spark), other)


@query("current_decisions", f"WITH {LOG_SQL} SELECT series_id, horizon, action, technique, analyst, status FROM current")
def current_decisions(spark, sf_dir):
    best, log = _decisions(spark, sf_dir)
    return governance.current_decisions(log, best).select("series_id", "horizon", "action", "technique", "analyst", "status")


@query("selection_history", f"""WITH {LOG_SQL}, c AS (SELECT * FROM current WHERE technique IS NOT NULL), h1 AS (SELECT series_id, horizon, '2024-01' AS forecast_cycle, technique, action FROM c UNION ALL SELECT series_id, horizon, '2024-02', technique, action FROM c)
SELECT series_id, horizon, forecast_cycle, CASE WHEN forecast_cycle = '2024-02' AND horizon = 'short' THEN 'ets' ELSE technique END AS technique, CASE WHEN forecast_cycle = '2024-02' AND horizon = 'short' THEN 'Overridden' ELSE action END AS action FROM h1""")
def selection_history(spark, sf_dir):
    best, log = _decisions(spark, sf_dir)
    now = _save(spark)(governance.current_decisions(log, best).where("technique is not null"))
    regions = _regions(spark, sf_dir)
    history = governance.record_selection(governance.empty_history(spark), now, regions, "2024-01", "2024-01-31")
    history = governance.record_selection(history, now, regions, "2024-02", "2024-02-28")
    again = now.where("horizon = 'short'").withColumn("technique", F.lit("ets")).withColumn("action", F.lit("Overridden"))
    history = governance.record_selection(history, again, regions, "2024-02", "2024-02-29")
    return history.select("series_id", "horizon", "forecast_cycle", "technique", "action")


@query("final_forecast_rows", f"WITH {LOG_SQL} SELECT c.series_id, c.horizon, c.technique, round_even(r.composite, 4) AS composite, c.status FROM current c LEFT JOIN ranks r ON r.series_id = c.series_id AND r.horizon = c.horizon AND r.technique = c.technique WHERE c.technique IS NOT NULL")
def final_forecast_rows(spark, sf_dir):
    best, log = _decisions(spark, sf_dir)
    rows = governance.final_forecast_rows(best, governance.current_decisions(log, best), _ranks(spark, sf_dir))
    return rows.select("series_id", "horizon", F.col("best.technique").alias("technique"), S.round_to("best.composite", 4).alias("composite"), "status")


# --- model fits and tests (kernels: no SQL) -----------------------------------

TYPES = "p_type"  # six series: kernels are tried on these


def _fit_data(spark, sf_dir):
    return calendar.dense_grid(tables.fact_price(spark, sf_dir, TYPES)), tables.fact_driver(spark, sf_dir, TYPES)


def _tried(spark, sf_dir, names, told=False, limit=None, n_windows=None):
    """Every horizon's search over the technique's own number of parameter sets (or `limit`
    of them) on all windows since the anchor, and its forecasts, evaluated."""
    save = _save(spark)
    prices, raw = _fit_data(spark, sf_dir)
    prices = save(prices)
    windows = save(calendar.backtest_windows(prices, ANCHOR, n_windows=n_windows))
    gated = save(pipeline.prepare_drivers(prices, raw)[1]) if told else None
    made = []
    for bucket in BUCKETS:
        low, high = HORIZONS["monthly"][bucket]
        made.append(engines.run_technique_set(prices, windows, names, high, gated, limit, high - low + 1, save, first=low)[0])
    made = save(made[0].unionByName(made[1]).unionByName(made[2])).where("error is null").drop("seed", "error", "seconds")
    return rounded(backtest.summarise(pipeline.details(made, prices)), 4)


# Forests take seconds a fit in their whole spaces, so these two queries try fewer sets.
for _name, _members, _told, _limit, _n in (
    ("fit_arima_family", ["arima", "sarima", "arima_garch", "sarima_garch"], False, None, None), ("fit_ets", ["ets"], False, None, None), ("fit_trees", ["rf", "lgbm"], False, 2, 4), ("fit_markov", ["markov_switching"], False, None, None),
    ("fit_arimax_family", ["arimax", "sarimax"], True, None, None), ("fit_var_vecm", ["var", "vecm"], True, None, None), ("fit_direct_trees", ["rf_ext", "lgbm_ext"], True, 1, 3),
):
    query(_name)(lambda spark, sf_dir, m=_members, t=_told, k=_limit, n=_n: _tried(spark, sf_dir, m, t, k, n))


@query("stationarity")
def stationarity(spark, sf_dir):
    return rounded(engines.stationarity(_prices(spark, sf_dir)))


@query("driver_tests")
def driver_tests(spark, sf_dir):
    prices, raw = _fit_data(spark, sf_dir)
    return rounded(engines.driver_tests(prices, pipeline.prepare_drivers(prices, raw)[1]))


@query("driver_importance")
def driver_importance(spark, sf_dir):
    prices, raw = _fit_data(spark, sf_dir)
    gated = _save(spark)(pipeline.prepare_drivers(prices, raw)[1])
    return rounded(engines.combined_importance(engines.importance(prices, gated)))


@query("select_drivers")
def select_drivers(spark, sf_dir):
    prices, raw = _fit_data(spark, sf_dir)
    return pipeline.select_drivers(prices, raw, Run(), save=_save(spark))


@query("decomposition")
def decomposition(spark, sf_dir):
    return rounded(engines.decomposition(_prices(spark, sf_dir)))


@query("partial_autocorrelation")
def partial_autocorrelation(spark, sf_dir):
    return rounded(engines.partial_autocorrelations(_prices(spark, sf_dir)))


@query("project_drivers")
def project_drivers(spark, sf_dir):
    prices, raw = _fit_data(spark, sf_dir)
    return rounded(engines.project_drivers(raw, calendar.backtest_windows(prices, ANCHOR)), 4)


ABLATION_SQL = f"""{SCORE_SQL}, m AS (SELECT series_id, technique, avg(mape) AS mape FROM summary WHERE horizon = 'long' AND months_evaluated > 0 GROUP BY 1, 2),
named AS (SELECT series_id, CASE technique WHEN 'drift' THEN 'var' WHEN 'last_value' THEN 'arima' ELSE 'sarima' END AS technique, mape FROM m)
SELECT a.series_id, a.technique, round_even(a.mape, 6) + 0.0 AS mape, round_even(b.mape, 6) + 0.0 AS sibling_mape, coalesce(b.mape - a.mape > 1.5, false) AS ablation_passed FROM named a LEFT JOIN named b ON a.series_id = b.series_id AND b.technique = 'arima' WHERE a.technique = 'var'"""


@query("ablation", f"WITH {ABLATION_SQL}")
def ablation(spark, sf_dir):
    """The ablation rule on baselines that stand in for a model with drivers and its sibling."""
    detail = _detail(spark, sf_dir)[1]
    name = F.when(F.col("technique") == "drift", "var").when(F.col("technique") == "last_value", "arima").otherwise("sarima")
    out = gate.ablation(backtest.summarise(detail).withColumn("technique", name))
    return rounded(out.select("series_id", "technique", "mape", "sibling_mape", "ablation_passed"))


@query("permutation_test", f"""WITH {DETAIL_SQL}, w AS (SELECT series_id, window_no, mape FROM summary WHERE technique = 'drift' AND horizon = 'short' AND mape IS NOT NULL), r AS (SELECT series_id, round_even(avg(mape), 6) AS real FROM w GROUP BY 1)
SELECT r.series_id, 'var' AS technique, r.real + 0.0 AS real_mape, count(*) AS n_permutations, round_even((count(*) FILTER (WHERE round_even(w.mape, 6) <= r.real) + 1.0) / (count(*) + 1.0), 6) + 0.0 AS p_value, (count(*) FILTER (WHERE round_even(w.mape, 6) <= r.real) + 1.0) / (count(*) + 1.0) < 0.05 AS permutation_passed FROM r JOIN w ON r.series_id = w.series_id GROUP BY 1, 2, 3""")
def permutation_test(spark, sf_dir):
    """The smoothed p-value rule; windows stand in for shuffled runs."""
    rows = backtest.summarise(_detail(spark, sf_dir)[1]).where("technique = 'drift' and horizon = 'short' and mape is not null").withColumn("technique", F.lit("var"))
    real = rows.groupBy("series_id", "technique").agg(S.round_to(F.avg("mape"), 6).alias("mape"))
    return rounded(gate.permutation(real, rows.select("series_id", "technique", F.col("window_no").alias("seed"), S.round_to("mape", 6).alias("mape"))))


@query("feature_survival")
def feature_survival(spark, sf_dir):
    """Engineered features through both cuts, of series by part type."""
    prices, _ = _fit_data(spark, sf_dir)
    return rounded(pipeline.feature_survival(prices, Run(), None, _save(spark)))


@query("run_batch")
def run_batch(spark, sf_dir):
    """The whole run with the gate, over all windows, with the techniques that take less
    than a second a fit; two shuffles and three sets a search in place of 30 and all."""
    prices, raw = _fit_data(spark, sf_dir)
    run = replace(Run(anchor=ANCHOR).fast(), n_windows=None, grid_limit=3)
    out = pipeline.run_batch(_save(spark)(prices), _save(spark)(raw), run, ["arima", "sarima", "ets", "markov_switching", "arima_garch", "arimax", "sarimax", "var", "vecm"], _save(spark))
    return _flat(out["ranks"], "rank")


def _registered(spark, sf_dir, techniques):
    prices, raw = _fit_data(spark, sf_dir)
    prices = _save(spark)(prices)
    out = pipeline.run_batch(prices, raw, Run(anchor=ANCHOR).fast(), techniques, _save(spark))
    return prices, out, pipeline.model_registry(out["ranks"], out["best"], prices, "2024-01-01")


@query("registry_predictions")
def registry_predictions(spark, sf_dir):
    prices, _, registry = _registered(spark, sf_dir, ["arima", "ets"])
    return rounded(pipeline.predict(registry, prices, None), 4)


@query("volatility_paths")
def volatility_paths(spark, sf_dir):
    prices, _ = _fit_data(spark, sf_dir)
    windows = calendar.backtest_windows(prices, ANCHOR)
    _, best = engines.run_technique_set(prices, windows, ["arima_garch"], 3, None, None, 3, _save(spark))
    return rounded(engines.volatility_paths(prices, windows, best))


@query("dim_horizon", "SELECT * FROM (VALUES " + ", ".join(f"('{f}', '{b}', {lo}, {hi})" for f, by in HORIZONS.items() for b, (lo, hi) in by.items()) + ") v(frequency, bucket, m_start, m_end)")
def horizon_table(spark, sf_dir):
    return dim_horizon(spark)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)

