"""Reports, discovery of workbooks, the command line's log, and scaling."""

import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_governance import workbook

from tidecast.operators import features, quality_checks, reports
from tidecast.plans import pipeline
from tidecast.sources import discovery


def test_driver_selection_report(spark):
    series = spark.createDataFrame([("a", "EU"), ("b", None)], "series_id string, region string")
    candidates = spark.createDataFrame([("a", 4, "gas"), ("a", 3, "oil"), ("b", 3, "fx")], "series_id string, column_no int, name string")
    selected = spark.createDataFrame([("a", "oil")], "series_id string, name string")
    survival = spark.createDataFrame([("a", "lag_1", True), ("a", "lag_2", False), ("a", "month", True), ("b", "lag_1", False)], "series_id string, name string, kept boolean")
    got = reports.driver_selection_report(series, candidates, selected, survival).toPandas().set_index("series_id")
    assert got.loc["a"].tolist() == ["EU", 2, "oil; gas", 1, "oil", 3, 2, "lag_1; month", 2, "lag_1; month"]
    assert got.loc["b"].tolist()[1:] == [1, "fx", 0, "", 1, 0, "", 0, ""]


def test_runtime_report_counts_a_fit_once(spark):
    rows = [("a", "short", "ets", w, step, 0.5) for w in (1, 2) for step in (1, 2, 3)]
    forecasts = spark.createDataFrame(rows, "series_id string, horizon string, technique string, window_no int, step int, seconds double")
    regions = spark.createDataFrame([("a", "EU")], "series_id string, region string")
    names = spark.createDataFrame([("ets", "ETS")], "technique string, display_name string")
    assert [tuple(r) for r in reports.runtime_report(forecasts, regions, names).collect()] == [("a", "EU", "short", "ETS", 2, 1.0)]


RANKS = "series_id string, horizon string, technique string, display_name string, eligible boolean, accuracy double, direction double, dynamism double, recency double, flat_penalty double, outlier_penalty double, composite double, rank int, tier string"


def test_final_output(spark):
    ranks = spark.createDataFrame([("a", "short", "ets", "ETS", True, 90.0, 60.0, 50.0, 80.0, 0.0, 0.0, 88.0, 1, "HIGH")], RANKS)
    forecast = spark.createDataFrame([("a", "short"), ("b", "short"), ("c", "long")], "series_id string, horizon string")
    decisions = spark.createDataFrame([("a", "short", "ets"), ("b", "short", "arima")], "series_id string, horizon string, technique string")
    rows, summary = reports.final_output(forecast, ranks, decisions, ranks.withColumn("technique", F.lit("benchmark")))
    assert sorted(r.series_id for r in rows.collect()) == ["a", "b"]
    got = summary.toPandas().sort_values(["series_id", "model"])
    assert got[["series_id", "model", "status"]].to_numpy().tolist() == [["a", "Benchmark", "Y"], ["a", "ETS", "Y"], ["b", "arima", "Not Scored"]]
    nothing = spark.createDataFrame([("a", "short", None)], "series_id string, horizon string, technique string")
    with pytest.raises(Exception, match="nothing decided"):
        reports.final_output(forecast, ranks, nothing)[1].collect()
    assert reports.scoring_report(ranks, forecast.withColumn("region", F.lit("EU"))).columns[:3] == ["Series", "Region", "Horizon"]


def test_log_and_consolidated_sheets(spark, tmp_path):
    reports.append_log([("run", "info", "begun"), ("run", "warning", "1 failed")], spark, f"{tmp_path}/log", "2025-01-01")
    reports.append_log([("run", "info", "again")], spark, f"{tmp_path}/log", "2025-01-02")
    assert spark.read.parquet(f"{tmp_path}/log").count() == 3
    sheet = lambda rows: spark.createDataFrame(rows, "series_id string, value int")
    reports.write_consolidated_reports({"drivers": sheet([("a", 1), ("b", 2)])}, str(tmp_path))
    reports.write_consolidated_reports({"drivers": sheet([("a", 3)])}, str(tmp_path))
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/consolidated/drivers").select("series_id", "value").collect())) == [("a", 3), ("b", 2)]
    with pytest.raises(ValueError):
        reports.write_consolidated_reports({"x": sheet([]).drop("series_id")}, str(tmp_path))
    summary = {r.stage: tuple(r)[1:] for r in reports.run_summary({"ranks": sheet([("a", 1), ("b", 1)]), "forecasts": sheet([("a", 1)]).withColumn("error", F.lit("bad"))}).collect()}
    assert summary == {"forecasts": (1, 1, 1), "ranks": (2, 2, 0)}


def test_choices_are_checked():
    pipeline.validate_choice(["short"], ["short", "long"], "horizon")
    with pytest.raises(ValueError, match="unknown horizon 'far'"):
        pipeline.validate_choice(["far"], ["short", "long"], "horizon")


def test_discovery(spark, tmp_path):
    months = [datetime.date(2020, m, 1) for m in range(1, 7)]
    head = [["", "Acetic Acid, EU", "Natural gas", "Feedstock"], ["Region", "Europe", "Henry Hub", "nan"], ["Grade/Index", "Price", "", ""], ["Unit", "USD/t", "USD/MMBtu", ""]]
    (tmp_path / "acetic_acid_ext_var.xlsx").write_bytes(workbook(head + [[m.isoformat(), 100 + i, 2, 3] for i, m in enumerate(months)]))
    (tmp_path / "zinc_ext_var.xlsx").write_bytes(workbook([["", "Price series", "x"], *[[m.isoformat(), 5, 6] for m in months]]))
    found, drivers = discovery.discover(spark, f"{tmp_path}/*.xlsx")
    got = found.toPandas().set_index("series_id")
    assert got.loc["acetic_acid"][["display_name", "region", "start_period", "frequency", "drivers_status"]].tolist() == ["Acetic Acid, EU", "Europe", "2020-01", "monthly", "candidates"]
    assert pd.isna(got.loc["acetic_acid"].grade) and got.loc["zinc"].display_name == "Zinc"
    labels = {(r.series_id, r.column_no): (r.label, r.unit) for r in drivers.collect()}
    assert labels[("acetic_acid", 3)] == ("Natural gas — Henry Hub", "USD/MMBtu") and labels[("acetic_acid", 4)] == ("Feedstock", "TBD") and labels[("zinc", 3)] == ("x", "TBD")
    old = spark.createDataFrame([("zinc", "My zinc", "G", "R", "monthly", "1999-01", "f", "selected"), ("tin", "Tin", None, None, "monthly", "2001-01", "t", "candidates")], found.schema)
    again, left = discovery.discover(spark, f"{tmp_path}/*.xlsx", old)
    kept = again.toPandas().set_index("series_id")
    assert kept.loc["zinc"].display_name == "My zinc" and kept.loc["zinc"].start_period == "1999-01" and kept.loc["tin"].display_name == "Tin" and len(kept) == 3
    assert {r.series_id for r in left.collect()} == {"acetic_acid"}


def test_density_and_scaling(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(10, 2, 200)
    prices = spark.createDataFrame([("a", datetime.date(2000 + i // 12, i % 12 + 1, 1), float(x)) for i, x in enumerate(v)] + [("b", datetime.date(2000, 1, 1), 1.0)], "series_id string, ds date, price double")
    got = quality_checks.density(prices, 50).toPandas().sort_values("point")
    width = v.std(ddof=1) * 200**-0.2
    want = [np.mean(np.exp(-(((x - v) / width) ** 2) / 2)) / (width * np.sqrt(2 * np.pi)) for x in got["at"]]
    assert len(got) == 50 and np.allclose(got.density, want)
    scaled = features.min_max(prices, ["price"], "2005-12-01").withColumn("back", features.min_max_inverse(F.col("price_scaled"), F.col("price_low"), F.col("price_range"))).toPandas()
    own = scaled[scaled.series_id == "a"].sort_values("ds")
    assert own.price_scaled.head(72).between(0, 1).all() and np.allclose(own.back, own.price) and scaled[scaled.series_id == "b"].price_scaled.tolist() == [0.0]
    assert features.window_features(prices).where("month_sin is null").count() == 0
