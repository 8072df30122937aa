"""Registered queries against their DuckDB SQL on the smallest tables, and kernels' invariants."""

import json
import os
from dataclasses import replace

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tidecast import queries as Q
from tidecast.functions import kernels as K
from tidecast.operators import backtest, calendar, engines
from tidecast.plans import pipeline
from tidecast.plans.config import Gate, Run
from tidecast.sources import tables
from tidecast.sources.shared import Scratch

COMPARED = [
    "clean_name_cases", "parse_months", "features_quarterly", "gated_drivers_linear", "feature_redundancy", "range_table_long", "benchmark_score", "score_summary", "forecast_rows", "final_forecast_rows", "density", "window_inputs", "selection_history",
    "monthly_price", "driver_long", "dense_grid", "infer_frequency", "clean_numbers", "clean_names", "summary_statistics", "returns", "histogram", "autocorrelation", "features_complete",
    "lag_search", "backtest_windows", "greedy_redundancy", "cumulative_cut", "backtest_summary", "vintage_matrix", "composite_score", "benchmark_detail", "cycle_averages", "safety_horizon",
]


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {t[:-8]} AS SELECT * FROM '{sf_dir}/{t}'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df:
        if df[c].map(lambda v: hasattr(v, "year")).any():
            df[c] = pd.to_datetime(df[c]).astype(str)
        elif pd.api.types.is_numeric_dtype(df[c]) and not pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype(float)
        else:
            df[c] = df[c].astype(object).where(df[c].notna(), "<null>").astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", COMPARED)
def test_matches_sql(spark, sf_dir, duck, name):
    got, want = normal(Q.queries()[name](spark, sf_dir).toPandas()), normal(duck.execute(Q.oracle_sql()[name]).df())
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=1e-9, atol=2e-6)
    assert len(got)


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry(spark):
    assert __spark_entry__.entry(spark).limit(1).count() == 1


def test_fits_match_their_kernel(spark, sf_dir):
    """Forecasts are those of the kernel on each window's history, with the grid row whose
    held-out error is least on average, and the summary's MAPE follows from them."""
    prices = calendar.dense_grid(tables.fact_price(spark, sf_dir, "p_type"))
    windows = calendar.backtest_windows(prices, Q.ANCHOR, n_windows=2)
    made, best = engines.run_technique_set(prices, windows, ["ets"], 3, None, 4)
    made, best = made.toPandas(), best.toPandas().set_index("series_id").params
    rows = prices.where("price is not null").toPandas().sort_values("ds")
    assert len(made) == 3 * windows.count() and made.error.isna().all()
    for (series, end), part in made.groupby(["series_id", "train_end"]):
        y = rows[(rows.series_id == series) & (rows.ds <= end)].price.to_numpy()
        held = {i: [] for i in range(4)}
        for end_of in windows.where(F.col("series_id") == series).toPandas().train_end:
            known = rows[(rows.series_id == series) & (rows.ds <= end_of)].price.to_numpy()
            for i, params in enumerate(engines.trials("ets", 4)):
                f = K.ets(known[:-3], params, 3)
                held[i].append(np.mean(np.abs((known[-3:] - f) / known[-3:])) * 100)
        assert json.loads(best[series]) == engines.trials("ets", 4)[min(held, key=lambda i: round(np.mean(held[i]), 6))]
        assert np.allclose(part.sort_values("step").predicted, K.ets(y, json.loads(best[series]), 3))
    detail = backtest.evaluate(spark.createDataFrame(made.drop(columns=["error", "seed"])), prices, "short", 1, 3)
    summary = backtest.summarise(detail).toPandas()
    actual = rows.set_index(["series_id", "ds"]).price
    for row in summary.itertuples():
        own = made[(made.series_id == row.series_id) & (made.window_no == row.window_no)]
        errors = [abs((a - f) / a) * 100 for s, d, f in zip(own.series_id, own.ds, own.predicted) if pd.notna(a := actual.get((s, d), np.nan))]
        assert (np.isnan(row.mape) and not errors) or abs(row.mape - np.mean(errors)) < 1e-3


def test_stationarity_forms(spark, sf_dir):
    assert {"level", "difference"} == set(Q.queries()["stationarity"](spark, sf_dir).toPandas().form)


def test_gated_run(spark, sf_dir):
    """The whole run with driver models: ablation, then permutations of those that pass."""
    prices = calendar.dense_grid(tables.fact_price(spark, sf_dir, "p_type"))
    raw = tables.fact_driver(spark, sf_dir, "p_type")
    run = replace(Run(anchor="2000-04-01").fast(), n_windows=None, grid_limit=1, gate=Gate(min_mape_drop=-1e9))
    out = pipeline.run_batch(prices, raw, run, ["arima", "var", "arimax"], Scratch(spark, "t").save)
    assert set(out["ranks"].toPandas().technique) == {"arima", "var", "arimax"}
    gate = out["gate"].toPandas()
    assert set(gate.technique) == {"var", "arimax"} and gate.ablation_passed.any()
    tested = gate[gate.ablation_passed]
    assert tested.p_value.between(1 / 3 - 1e-9, 1).all() and not gate[~gate.ablation_passed].passed.any()
