"""Connected components of a table of links, without collecting them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step on links u > v."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
    return small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node that has a link in edges (a, b): the
    smallest node reachable. Large-star and small-star steps repeat until the
    links stand still; each round is a table in the shared folder. Links to
    oneself and repeated links are allowed; an empty table gives an empty one."""
    now = scratch.save(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    state = _state(now)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        after = scratch.save(_stars(now))
        scratch.drop(now)
        now, before, state = after, state, _state(after)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
