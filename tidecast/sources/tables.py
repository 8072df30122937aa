"""Price and driver series out of the supplied order tables.

One long table covers all series: fact_price(series_id, ds, price) and
fact_driver(series_id, driver, ds, raw), by month. Sums run over decimals, so
they don't depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import round_to


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _exact(column: str):
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def _month(column: str):
    return F.trunc(F.col(column).cast("date"), "MM")


def line_months(spark: SparkSession, sf_dir: str, series: str = "p_brand") -> DataFrame:
    """Monthly sums of lineitem by a column of part. The part dimension is left to
    the planner: its size grows with the data."""
    line = read(spark, sf_dir, "lineitem").select("l_partkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate")
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col(series).alias("series_id"))
    return line.join(part, "l_partkey").groupBy("series_id", _month("l_shipdate").alias("ds")).agg(
        _exact("l_extendedprice").alias("value"), _exact("l_quantity").alias("volume"), _exact("l_discount").alias("discount"), _exact("l_tax").alias("tax"), F.count("*").alias("n")
    )


def fact_price(spark: SparkSession, sf_dir: str, series: str = "p_brand") -> DataFrame:
    return line_months(spark, sf_dir, series).select("series_id", "ds", round_to(F.col("value") / F.col("volume"), 4).alias("price"))


def fact_driver(spark: SparkSession, sf_dir: str, series: str = "p_brand") -> DataFrame:
    """Seven drivers a series: three of its own, two of all orders (which end
    earlier), one that starts late, and a constant one."""
    lines = line_months(spark, sf_dir, series)
    own = lines.select(
        "series_id", "ds",
        round_to(F.col("discount") / F.col("n"), 6).alias("discount"), round_to(F.col("tax") / F.col("n"), 6).alias("tax"), "volume",
        F.when(F.col("ds") >= F.lit("1999-01-01").cast("date"), round_to(F.col("volume") / F.col("n"), 6)).alias("late_size"), F.lit(1.0).alias("constant"),
    )
    orders = read(spark, sf_dir, "orders").groupBy(_month("o_orderdate").alias("ds")).agg(F.count("*").cast("double").alias("orders"), round_to(_exact("o_totalprice") / F.count("*"), 4).alias("order_value"))
    wide = own.join(orders, "ds", "left")
    names = ["discount", "tax", "volume", "late_size", "constant", "orders", "order_value"]
    return wide.unpivot(["series_id", "ds"], names, "driver", "raw").where("raw is not null")


# The same in SQL, as the first tables of the oracles.
PRICE_SQL = """
line_months AS (
  SELECT p_brand AS series_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS ds,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS volume,
    CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS discount, CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS tax, count(*) AS n
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
fact_price AS (SELECT series_id, ds, round_even(value / volume, 4) AS price FROM line_months)"""
GRID_SQL = PRICE_SQL + """,
bounds AS (SELECT series_id, min(ds) AS a, max(ds) AS b FROM fact_price GROUP BY series_id),
months AS (SELECT series_id, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS ds FROM bounds),
grid AS (SELECT m.series_id, m.ds, p.price FROM months m LEFT JOIN fact_price p ON p.series_id = m.series_id AND p.ds = m.ds)"""
DRIVER_SQL = GRID_SQL + """,
order_months AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS ds, CAST(count(*) AS DOUBLE) AS orders,
    round_even(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS order_value FROM orders GROUP BY 1),
wide AS (
  SELECT series_id, l.ds, round_even(discount / n, 6) AS discount, round_even(tax / n, 6) AS tax, volume,
    CASE WHEN l.ds >= DATE '1999-01-01' THEN round_even(volume / n, 6) END AS late_size, CAST(1.0 AS DOUBLE) AS constant, o.orders, o.order_value
  FROM line_months l LEFT JOIN order_months o ON l.ds = o.ds),
fact_driver AS (UNPIVOT wide ON discount, tax, volume, late_size, constant, orders, order_value INTO NAME driver VALUE raw)"""
