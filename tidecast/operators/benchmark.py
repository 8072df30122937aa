"""Third-party forecast vintages: settled actuals, row detail and range tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import direction_hit, month_label, round_to, row_metrics

# Label -> (offset, months, first M-step).
RANGES = {"M1-M3": (0, 3, 1), "M4-M6": (3, 3, 4), "M7-M18": (6, 12, 7), "M4-M18": (3, 15, 4)}
BUCKET_OF_RANGE = {"M1-M3": "short", "M4-M6": "medium", "M7-M18": "long"}


def unpivot_vintages(wide: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(series_id, vintage, target, value) from a sheet with one column for each vintage;
    columns: name of a column -> its ISO month."""
    cells = F.explode(F.array(*(F.struct(F.lit(m).cast("date").alias("vintage"), F.col(c).alias("value")) for c, m in columns.items())))
    return wide.select("series_id", "target", cells.alias("c")).select("series_id", "c.vintage", "target", F.col("c.value").alias("value"))


def settled_actuals(vintages: DataFrame) -> DataFrame:
    """(series_id, ds, price): the latest vintage's cells before its own month."""
    latest = vintages.groupBy("series_id").agg(F.max("vintage").alias("vintage"))
    rows = vintages.join(latest, ["series_id", "vintage"]).where("target < vintage and value is not null")
    return rows.select("series_id", F.col("target").alias("ds"), F.col("value").alias("price"))


def forecast_vintages(vintages: DataFrame) -> DataFrame:
    """(series_id, vintage, target, predicted): cells before a vintage's month are no forecasts."""
    return vintages.where("target >= vintage and value is not null").select("series_id", "vintage", "target", F.col("value").alias("predicted"))


def trailing_mean_vintages(prices: DataFrame, months: int = 12, targets: int = 18) -> DataFrame:
    """A stand-in vendor: each month's trailing mean, held for the months ahead, with
    the settled prices before it."""
    rows = prices.where("price is not null")
    past = rows.select("series_id", F.col("ds").alias("target"), "price")
    vintage = rows.select("series_id", F.col("ds").alias("vintage")).distinct()
    mean = vintage.join(past, "series_id").where((F.col("target") < F.col("vintage")) & (F.col("target") >= F.add_months("vintage", -months)))
    mean = mean.groupBy("series_id", "vintage").agg(round_to(F.avg("price"), 4).alias("value"), F.count("*").alias("n")).where(F.col("n") == months)
    ahead = mean.select("series_id", "vintage", F.explode(F.sequence(F.lit(0), F.lit(targets - 1))).alias("k"), "value").select("series_id", "vintage", F.add_months("vintage", F.col("k")).alias("target"), round_to(F.col("value") * (1 + F.col("k") * 0.001), 4).alias("value"))
    latest = mean.groupBy("series_id").agg(F.max("vintage").alias("vintage"))
    settled = latest.join(past, "series_id").where("target < vintage").select("series_id", "vintage", "target", F.col("price").alias("value"))
    return ahead.unionByName(settled)


def benchmark_detail(predicted: DataFrame, prices: DataFrame, cutoff) -> DataFrame:
    """Row detail of each vintage against prices up to the cutoff: m_step counts rows
    that have both values, so a gap shifts it. A vintage without a price in the
    month before it is left out. The rolling baseline is the row before."""
    actual = prices.where("price is not null").select("series_id", F.col("ds").alias("target"), F.col("price").alias("actual"))
    base = prices.where("price is not null").select("series_id", F.add_months("ds", 1).alias("vintage"), F.col("price").alias("baseline"))
    rows = predicted.where((F.col("target") >= F.col("vintage")) & (F.col("target") <= F.lit(cutoff).cast("date"))).join(base, ["series_id", "vintage"]).join(actual, ["series_id", "target"])
    per = Window.partitionBy("series_id", "vintage").orderBy("target")
    order = F.dense_rank().over(Window.partitionBy("series_id").orderBy("vintage"))
    before = F.coalesce(F.lag("predicted").over(per), F.col("baseline"))
    return rows.select(
        "series_id", order.alias("sort_order"), "vintage", "target", F.row_number().over(per).alias("m_step"), round_to("predicted", 4).alias("predicted"), round_to("actual", 4).alias("actual"),
        direction_hit("actual", "predicted", before).alias("da_mom"), direction_hit("actual", "predicted", "baseline").alias("da_abs"),
        *(c.alias(n) for n, c in row_metrics().items()),
    )


def range_detail(detail: DataFrame, label: str) -> DataFrame:
    """Rows of one range with its window number and step label."""
    offset, months, first = RANGES[label]
    rows = detail.where(F.col("m_step").between(offset + 1, offset + months))
    return rows.withColumn("range", F.lit(label)).withColumn("step_label", F.concat(F.lit("M"), (F.col("m_step") - offset + first - 1).cast("string")))


def all_ranges(detail: DataFrame) -> DataFrame:
    out = None
    for label in RANGES:
        part = range_detail(detail, label)
        out = part if out is None else out.unionByName(part)
    return out


def range_table(detail: DataFrame, label: str) -> DataFrame:
    """One row a vintage: date, accuracy, MAPE and both hits of each step, then averages."""
    offset, months, first = RANGES[label]
    rows = range_detail(detail, label)
    at = lambda i, c: F.max(F.when(F.col("m_step") == offset + 1 + i, c))
    steps = []
    for i in range(months):
        m = f"M{first + i}"
        steps += [
            F.coalesce(at(i, month_label("target")), F.lit("—")).alias(f"{m} Date"), at(i, round_to("accuracy", 2)).alias(f"{m} Accuracy"),
            at(i, round_to("mape", 2)).alias(f"{m} MAPE (%)"), at(i, F.col("da_mom")).alias(f"{m} DA"), at(i, F.col("da_abs")).alias(f"{m} Abs DA"),
        ]
    mean = lambda c, places, factor=1: round_to(F.avg(c) * factor, places)
    return rows.groupBy("series_id", "sort_order", "vintage").agg(
        F.concat(F.count("*").cast("string"), F.lit(f"/{months}M")).alias("Months Available"), *steps,
        mean("accuracy", 2).alias("Avg Accuracy (%)"), mean("mape", 2).alias("Avg MAPE (%)"), mean("da_mom", 1, 100).alias("Avg DA (%)"), mean("da_abs", 1, 100).alias("Avg Abs DA (%)"),
        mean("mae", 2).alias("Avg MAE"), mean("rmse", 2).alias("Avg RMSE"),
    ).withColumn("Predicted From", month_label("vintage"))


def cycle_averages(detail: DataFrame) -> DataFrame:
    """Long form of the averages of every range and vintage."""
    mean = lambda c, places, factor=1: round_to(F.avg(c) * factor, places)
    return all_ranges(detail).groupBy("series_id", "range", "vintage").agg(F.count("*").alias("months"), mean("accuracy", 2).alias("accuracy"), mean("mape", 2).alias("mape"), mean("da_mom", 1, 100).alias("da"), mean("da_abs", 1, 100).alias("da_abs"), mean("mae", 2).alias("mae"), mean("rmse", 2).alias("rmse"))


def as_backtest(detail: DataFrame) -> DataFrame:
    """The benchmark as detail rows of a technique, for the scorer."""
    rows = all_ranges(detail)
    bucket = F.coalesce(*(F.when(F.col("range") == r, b) for r, b in BUCKET_OF_RANGE.items()))
    return rows.withColumn("horizon", bucket).where("horizon is not null").select(
        "series_id", F.lit("benchmark").alias("technique"), "horizon", F.col("sort_order").alias("window_no"), F.add_months("vintage", -1).alias("train_end"), F.col("vintage").alias("forecast_start"),
        F.col("m_step").alias("step"), F.col("target").alias("ds"), "predicted", "actual", "da_mom", "da_abs", F.lit("Actual").alias("flag"), "abs_err", "ape", "mae", "mse", "rmse", "mape", "mpe", "accuracy",
    )
