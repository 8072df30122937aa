"""Scalar functions, calendars and features against plain Python and pandas."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidecast.functions import scalars as S
from tidecast.functions.feature_rows import feature_row
from tidecast.operators import calendar, drivers, features, quality_checks
from tidecast.plans.config import resolve_horizon


def series(spark, values, start="2020-01-01", name="a"):
    days = pd.date_range(start, periods=len(values), freq="MS")
    return spark.createDataFrame([(name, d.date(), v) for d, v in zip(days, values)], "series_id string, ds date, price double")


def test_numbers_names_and_dates(spark):
    row = spark.createDataFrame([("1,234.5", "Price (USD/MT)", "Jan-20"), (" x ", "  a   b_", "2020-03-17"), (None, None, "soon")], "n string, t string, d string")
    got = row.select(S.to_number("n"), S.clean_name("t"), S.parse_month("d")).collect()
    assert [tuple(r) for r in got] == [(1234.5, "Price _USD_MT", dt.date(2020, 1, 1)), (None, "a b", dt.date(2020, 3, 1)), (None, None, None)]


def test_row_metrics_and_directions(spark):
    df = spark.createDataFrame([(100.0, 90.0, 95.0), (0.0, 5.0, 1.0), (10.0, 40.0, 10.0), (None, 1.0, 1.0)], "actual double, predicted double, base double")
    m = S.row_metrics()
    got = df.select(m["ape"], m["mpe"], m["accuracy"], S.direction_hit("actual", "predicted", "base")).collect()
    assert tuple(got[0]) == (10.0, 10.0, 90.0, 0)
    assert tuple(got[1])[:3] == (None, None, None)
    assert tuple(got[2]) == (300.0, -300.0, 0.0, 0)
    assert tuple(got[3]) == (None, None, None, None)


def test_periods():
    assert [S.scale_periods(m, "quarterly") for m in (1, 3, 6, 12, 36)] == [1, 1, 2, 4, 12]
    assert resolve_horizon(6, 12) == (7, 18, "M7-M18")
    assert len(features.feature_table()) == 63 and len(features.feature_table("quarterly")) == 43


def test_features_match_pandas(spark):
    rng = np.random.default_rng(3)
    prices = (1000 + rng.normal(0, 50, 60).cumsum()).round(3)
    got = features.engineer(series(spark, prices.tolist())).toPandas().sort_values("ds").reset_index(drop=True)
    p = pd.Series(prices)
    last = p.shift(1)
    assert np.allclose(got.roll_std_6, last.rolling(6).std(), equal_nan=True)
    assert np.allclose(got.rolling_mean_36, last.rolling(36, min_periods=12).mean(), equal_nan=True)
    assert np.allclose(got.cum_return_6p, (p.shift(1) / p.shift(7) - 1) * 100, equal_nan=True)
    assert np.allclose(got.expanding_std, last.expanding(2).std(), equal_nan=True)
    z = ((last - last.rolling(3).mean()) / last.rolling(3).std()).fillna(0)
    assert np.allclose(got.roll_zscore_3, z)
    months = np.array([d.month for d in got.ds])
    f = feature_row(prices[:50], months[:50], got.ds[50].year, got.ds[50].month, got.ds[0].year)
    for name, value in f.items():
        if name != "price_to_rolling_mean_36":
            assert np.isclose(float(got[name][50]), value), name


def test_windows_grow_from_the_anchor(spark):
    rows = series(spark, [float(i) for i in range(1, 25)])
    got = calendar.backtest_windows(rows, "2021-10-01").orderBy("window_no").collect()
    assert [(r.window_no, r.train_end, r.n_train) for r in got] == [(1, dt.date(2021, 10, 1), 22), (2, dt.date(2021, 11, 1), 23), (3, dt.date(2021, 12, 1), 24)]


def test_imputation(spark):
    rows = spark.createDataFrame([("a", "d", dt.date(2020, m, 1), v) for m, v in enumerate([None, 1.0, None, 3.0, None, None, None, None], 1)], "series_id string, driver string, ds date, lagged double")
    by = lambda f: [r.lagged for r in f(rows).orderBy("ds").collect()]
    assert by(drivers.impute_moving_average) == [None, 1.0, 1.0, 3.0, 3.0, 3.0, None, None]
    assert by(drivers.impute_linear) == [None, 1.0, 2.0, 3.0, 3.0, 3.0, 3.0, 3.0]


def test_quality_flags(spark):
    values = [10.0, None, 11.0, 12.0, 12.0, 12.0, 12.0, -1.0] + [11.0 + 0.1 * (i % 3) for i in range(20)] + [500.0]
    rows = series(spark, values).where(F.col("ds") != F.lit("2020-03-01").cast("date"))
    rows = rows.unionByName(rows.where(F.col("ds") == F.lit("2020-01-01").cast("date")))
    flags = {r.check: (r.severity, r.detail) for r in quality_checks.quality_flags(rows).collect()}
    assert set(flags) == {"missing_or_non_numeric_price", "missing_calendar_periods", "duplicate_dates", "price_outliers", "negative_price", "flat_stretch"}
    assert flags["flat_stretch"] == ("info", "4 consecutive identical price values ending 2020-07")
    assert flags["missing_calendar_periods"] == ("error", "1 missing periods: 2020-03")
