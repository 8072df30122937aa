"""Fitting engines: every (series, technique, window, trial) is one row of a task
table, and rows are fitted in Arrow batches by the numpy kernels.

A task carries its series' history as arrays, whose length is bounded by the
number of months. A fit that fails gives a row with an error and no forecast, and
never stops the rest. Results hold only forecasts; metrics are relational.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..functions.feature_rows import CALENDAR, feature_matrix, feature_row, warmup
from ..plans.spaces import trials
from .backtest import search_best
from .features import feature_table, safe_features

PERIOD_MONTHS = {"monthly": 1, "quarterly": 3}


@dataclass(frozen=True)
class History:
    """What is known of a series at a window's end. names are the engineered features
    that its models may use (None: all)."""

    y: np.ndarray
    years: np.ndarray
    months: np.ndarray
    drivers: np.ndarray
    frequency: str = "monthly"
    names: tuple[str, ...] | None = None
    orders: dict | None = None

    @property
    def season(self) -> int:
        return 12 // PERIOD_MONTHS[self.frequency]

    def first(self, n: int) -> History:
        return replace(self, y=self.y[:n], years=self.years[:n], months=self.months[:n], drivers=self.drivers[:n])

    def when(self, step: int) -> tuple[int, int]:
        """Year and month of a period after the last."""
        at = int(self.years[-1]) * 12 + int(self.months[-1]) - 1 + step * PERIOD_MONTHS[self.frequency]
        return at // 12, at % 12 + 1

    def features(self) -> list[str]:
        every = [n for n, _, _ in feature_table(self.frequency)]
        return every if self.names is None else [n for n in every if n in set(self.names)]


Fit = Callable[[History, dict, int], np.ndarray]


@dataclass(frozen=True)
class Technique:
    """fit gives forecasts 1..steps after a history's end. search tells how parameter
    sets are compared: "held" refits without the last rows and forecasts them, "rows"
    predicts the last rows from their own features, "steps" searches for each step."""

    fit: Fit
    min_train: int
    search: str = "held"


def _columns(h: History, matrix: np.ndarray) -> np.ndarray:
    keep = set(h.features())
    return matrix[:, [i for i, (n, _, _) in enumerate(feature_table(h.frequency)) if n in keep]]


def _learner(technique: str, params: dict, x, y, held: int = 0):
    return K.LEARNERS[technique](x, y, **params, held=held)


def _recursive(technique: str) -> Fit:
    def fit(h: History, params: dict, steps: int) -> np.ndarray:
        x, target = _columns(h, feature_matrix(h.y, h.years, h.months, h.frequency)), h.y[warmup(h.frequency) :]
        model = _learner(technique, params, x, target, params.get("held", 3))
        past, when, out = list(h.y), list(h.months), []
        for step in range(1, steps + 1):
            year, month = h.when(step)
            f = feature_row(np.array(past), np.array(when), year, month, int(h.years[0]), h.frequency)
            out.append(float(model.predict(np.array([[f[n] for n in h.features()]]))[0]))
            past.append(out[-1])
            when.append(month)
        return np.array(out)

    return fit


def held_out_rows(technique: str, h: History, params: dict, held: int) -> float:
    """MAPE on the last rows from their own features, fitted on the rows before them;
    these rows stop boosting, too."""
    x, target = _columns(h, feature_matrix(h.y, h.years, h.months, h.frequency)), h.y[warmup(h.frequency) :]
    if len(target) - held < 10:
        raise ValueError("fewer than 10 rows to learn from")
    rows = len(target) if technique == "lgbm" else len(target) - held
    made = _learner(technique, params, x[:rows], target[:rows], held).predict(x[-held:])
    some = target[-held:] != 0
    return float(np.mean(np.abs((target[-held:] - made)[some] / target[-held:][some])) * 100)


EXPANDING = ("expanding_mean", "expanding_std", "price_to_expanding_mean", "seasonal_index")


class DirectRows:
    """Training rows and the row to predict for each step of a direct model: labels lie in
    the past, features are safe at the step, drivers are frozen at the last known row."""

    def __init__(self, h: History):
        self.h, self.matrix = h, feature_matrix(h.y, h.years, h.months, h.frequency)
        self.every, self.own = [n for n, _, _ in feature_table(h.frequency)], set(h.features())

    def at(self, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, first = self.h, warmup(self.h.frequency)
        safe = set(safe_features(step, h.frequency)) & self.own
        keep = [i for i, n in enumerate(self.every) if n in safe]
        x = np.column_stack([self.matrix[: len(self.matrix) - step][:, keep], h.drivers[first : len(h.y) - step]])
        target = h.y[first + step :]
        ok = ~np.isnan(x).any(1)
        if ok.sum() < 5:
            raise ValueError("too few complete rows")
        row, (year, month) = self.matrix[-1].copy(), h.when(step)
        now = feature_row(h.y, h.months, year, month, int(h.years[0]), h.frequency)
        for i, n in enumerate(self.every):
            if n in CALENDAR or n in EXPANDING:
                row[i] = now[n]
        known = h.drivers[~np.isnan(h.drivers).any(1)]
        return x[ok], target[ok], np.concatenate([row[keep], known[-1]])[None]


def _direct(technique: str) -> Fit:
    def fit(h: History, params: dict, steps: int) -> np.ndarray:
        _with_drivers(h)
        rows, by = DirectRows(h), params.get("by_step", {})
        out = []
        for step in range(1, steps + 1):
            if by and str(step) not in by and "or" not in params:
                out.append(np.nan)  # a step that was not searched for
                continue
            x, y, row = rows.at(step)
            own = by.get(str(step), params.get("or", params) if by else params)
            out.append(float(_learner(technique, own, x, y).predict(row)[0]))
        return np.array(out)

    return fit


def _with_drivers(h: History) -> None:
    if not h.drivers.shape[1]:
        raise ValueError("this technique needs drivers")


def _project(x: np.ndarray, steps: int, season: int) -> np.ndarray:
    return np.column_stack([K.project_driver(c[~np.isnan(c)], steps, season)[0] if (~np.isnan(c)).any() else np.full(steps, np.nan) for c in x.T])


def _exogenous(h: History, params: dict, steps: int) -> np.ndarray:
    _with_drivers(h)
    ok = ~np.isnan(h.drivers).any(1)
    if ok.sum() < 12:
        raise ValueError("too few rows with drivers")
    s = h.season if params.get("seasonal") else 1
    order = {k: v for k, v in params.items() if k != "seasonal"}
    return K.arimax(h.y[ok], {**order, "s": s}, steps, h.drivers[ok], _project(h.drivers, steps, h.season))


def _joint(forecast) -> Fit:
    def fit(h: History, params: dict, steps: int) -> np.ndarray:
        _with_drivers(h)
        ok = ~np.isnan(h.drivers).any(1)
        frame = np.column_stack([h.y[ok], h.drivers[ok]])
        return forecast(frame[:, [True, *(np.ptp(frame[:, 1:], axis=0) > 0)]], params, steps)

    return fit


def _arima(h: History, params: dict, steps: int) -> np.ndarray:
    return K.arima(h.y, {**params, "s": h.season}, steps)


def _ets(h: History, params: dict, steps: int) -> np.ndarray:
    return K.ets(h.y, {**params, "s": h.season}, steps)


def _markov(h: History, params: dict, steps: int) -> np.ndarray:
    return K.markov_switching(h.y, params, steps)


# The least number of training rows of each technique.
TECHNIQUES: dict[str, Technique] = {
    "arima": Technique(_arima, 15), "sarima": Technique(_arima, 24), "ets": Technique(_ets, 24), "markov_switching": Technique(_markov, 30),
    "rf": Technique(_recursive("rf"), 20, "rows"), "lgbm": Technique(_recursive("lgbm"), 20, "rows"), "arima_garch": Technique(_arima, 30), "sarima_garch": Technique(_arima, 30),
    "arimax": Technique(_exogenous, 12), "sarimax": Technique(_exogenous, 12), "var": Technique(_joint(K.var_forecast), 24), "vecm": Technique(_joint(K.vecm_forecast), 24),
    "rf_ext": Technique(_direct("rf"), 5, "steps"), "lgbm_ext": Technique(_direct("lgbm"), 5, "steps"),
}


def register(name: str, technique: Technique) -> None:
    """Adds a technique, or puts another in the place of one; tasks carry the table of
    techniques with them, so executors know it, too."""
    TECHNIQUES[name] = technique


def fit_forecast(technique: str, params: dict, h: History, steps: int, known: dict[str, Technique] | None = None) -> np.ndarray:
    """Forecasts 1..steps after the end of a history."""
    t = (known or TECHNIQUES).get(technique)
    if t is None:
        raise ValueError(f"no technique {technique!r}")
    if len(h.y) < t.min_train:
        raise ValueError(f"{technique} needs {t.min_train} rows, has {len(h.y)}")
    return t.fit(h, params, steps)


def histories(prices: DataFrame, drivers: DataFrame | None = None, features: DataFrame | None = None) -> DataFrame:
    """(series_id, names, features, ds, price, drivers): a series' periods as sorted arrays;
    drivers holds one array a period with a value for each name, in order of names.
    features: (series_id, name) of the engineered features that models may use; null
    features stand for all."""
    rows = prices.where("price is not null").select("series_id", "ds", "price")
    if drivers is None:
        rows = rows.withColumn("values", F.array().cast("array<double>"))
        names = rows.select("series_id").distinct().withColumn("names", F.array().cast("array<string>"))
    else:
        names = drivers.groupBy("series_id").agg(F.sort_array(F.collect_set("driver")).alias("names"))
        wide = drivers.where("value is not null").groupBy("series_id", "ds").agg(F.map_from_entries(F.collect_list(F.struct("driver", "value"))).alias("m"))
        rows = rows.join(wide, ["series_id", "ds"], "left").join(names, "series_id").withColumn("values", F.transform("names", lambda n: F.coalesce(F.col("m")[n], F.lit(float("nan")))))
    packed = rows.groupBy("series_id").agg(F.sort_array(F.collect_list(F.struct("ds", "price", "values"))).alias("h"))
    packed = packed.join(names, "series_id")
    if features is None:
        packed = packed.withColumn("features", F.lit(None).cast("array<string>"))
    else:
        packed = packed.join(features.groupBy("series_id").agg(F.sort_array(F.collect_set("name")).alias("features")), "series_id", "left")
    return packed.select("series_id", "names", "features", F.col("h.ds").alias("ds"), F.col("h.price").alias("price"), F.col("h.values").alias("drivers"))


def task_table(history: DataFrame, windows: DataFrame, grids: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row for each series, window and grid row (technique, trial, params). The grid is
    a list of the driver's own, of a size that the search spaces fix."""
    tasks = windows.select("series_id", "window_no", "train_end").crossJoin(F.broadcast(grids)) if "series_id" not in grids.columns else windows.select("series_id", "window_no", "train_end").join(grids, "series_id")
    n = partitions or int(history.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # small rows are dealt to tasks, then meet their history
    return tasks.repartition(n, "series_id", "technique", "window_no", "trial").join(history, "series_id")


def grid_frame(spark, techniques: list[str], limit: int | None = None, long: bool = False) -> DataFrame:
    rows = [(t, i, json.dumps(p, sort_keys=True)) for t in techniques for i, p in enumerate(trials(t, limit, long))]
    return spark.createDataFrame(rows, "technique string, trial int, params string")


def _tasks(batches: Iterator[pd.DataFrame], frequency: str):
    """(task, history up to the window's end, periods and prices of the whole series)."""
    held: dict[str, tuple] = {}  # the arrays of some series
    for batch in batches:
        for task in batch.itertuples(index=False):
            if task.series_id not in held:
                if len(held) >= 64:
                    held.clear()
                ds = np.array([str(d)[:10] for d in task.ds], "datetime64[D]")
                month = ds.astype("datetime64[M]").astype(int)
                held[task.series_id] = ds, 1970 + month // 12, month % 12 + 1, np.asarray(task.price, float), np.array([np.asarray(v, float) for v in task.drivers]).reshape(len(ds), -1)
            ds, years, months, price, every = held[task.series_id]
            n = int((ds <= np.datetime64(str(task.train_end)[:10])).sum())
            drivers = every[:n]
            if task.seed >= 0 and drivers.shape[1]:
                rng = np.random.default_rng(task.seed)
                drivers = np.column_stack([rng.permutation(c) for c in drivers.T])
            yield task, History(price[:n], years[:n], months[:n], drivers, frequency, None if task.features is None else tuple(task.features)), ds, price


def _search_losses(t: Technique, task, h: History, ds: np.ndarray, price: np.ndarray, held_out: int, steps: tuple[int, int], weight: float, mode: str):
    """(step, loss) pairs of one parameter set on one window; step 0 stands for all steps."""
    params = json.loads(task.params)
    if t.search == "rows":
        yield 0, held_out_rows(task.technique, h, params, held_out)
    elif t.search == "held":
        cut = len(h.y) - held_out
        if cut < t.min_train:
            raise ValueError("too few rows")
        f = t.fit(h.first(cut), params, held_out)
        some = h.y[cut:] != 0
        yield 0, float(np.mean(np.abs((h.y[cut:] - f)[some] / h.y[cut:][some])) * 100)
    else:
        _with_drivers(h)
        rows, learner = DirectRows(h), task.technique.removesuffix("_ext")
        for step in range(steps[0], steps[1] + 1):
            due = np.datetime64(str(task.train_end)[:7], "M") + step * PERIOD_MONTHS[h.frequency]
            at = np.flatnonzero(ds == due.astype("datetime64[D]"))
            if len(at):
                x, y, row = rows.at(step)
                f = _learner(learner, params, x, y).predict(row)
                yield step, K.composite_loss(price[at], f, float(h.y[-1 - step] if len(h.y) > step else h.y[0]), weight, mode)


def run_search(tasks: DataFrame, held_out: int, steps: tuple[int, int] = (1, 18), frequency: str = "monthly", da_weight: float = 0.0, da_mode: str = "mom") -> DataFrame:
    """(series_id, technique, trial, params, window_no, step, error): the loss of each
    parameter set on each window. Step 0 is the MAPE on the last held_out rows of a training
    set; direct techniques have a row for each step instead, with the composite loss of the
    forecast that falls on it. Sets that can't be fitted have a null error."""
    known = dict(TECHNIQUES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        columns = ["series_id", "technique", "trial", "params", "window_no", "step", "error"]
        frame = lambda: pd.DataFrame(out, columns=columns).astype({"step": "int32", "error": "float64"})
        for task, h, ds, price in _tasks(batches, frequency):
            try:
                found = list(_search_losses(known[task.technique], task, h, ds, price, held_out, steps, da_weight, da_mode))
            except Exception:  # one fit never stops the rest
                found = [(0, None)]
            out += [(task.series_id, task.technique, task.trial, task.params, task.window_no, step, e if e is not None and np.isfinite(e) else None) for step, e in found]
            if len(out) >= 500:
                yield frame()
                out.clear()
        if out:
            yield frame()

    return tasks.withColumn("seed", F.lit(-1)).mapInPandas(run, "series_id string, technique string, trial int, params string, window_no int, step int, error double")


def run_forecasts(tasks: DataFrame, steps: int, frequency: str = "monthly") -> DataFrame:
    """(series_id, technique, window_no, train_end, step, ds, predicted, seed, error, seconds). A
    task with a seed of 0 or more has its training drivers shuffled by column; seconds is
    the time that the fit took, on each of its rows."""
    if "seed" not in tasks.columns:
        tasks = tasks.withColumn("seed", F.lit(-1))
    known = dict(TECHNIQUES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        columns = ["series_id", "technique", "window_no", "train_end", "step", "predicted", "seed", "error", "seconds"]
        for task, h, _, _ in _tasks(batches, frequency):
            began, error, f = time.perf_counter(), None, [None]
            try:
                f = fit_forecast(task.technique, json.loads(task.params), h, steps, known)
                if np.isinf(f).any() or np.isnan(f).all() or (np.isnan(f).any() and known[task.technique].search != "steps"):
                    error, f = "the forecast is not finite", [None]
            except Exception as e:  # one fit never stops the rest
                error = f"{type(e).__name__}: {e}"
            took = time.perf_counter() - began
            made = [(i + 1, float(v)) for i, v in enumerate(f) if not np.isnan(v)] if error is None else [(0, None)]
            out += [(task.series_id, task.technique, task.window_no, task.train_end, step, v, task.seed, error, took) for step, v in made]
            if len(out) >= 2000:
                yield pd.DataFrame(out, columns=columns).astype({"predicted": "float64"})
                out.clear()
        if out:
            yield pd.DataFrame(out, columns=columns).astype({"predicted": "float64"})

    made = tasks.mapInPandas(run, "series_id string, technique string, window_no int, train_end date, step int, predicted double, seed int, error string, seconds double")
    return made.withColumn("ds", F.add_months("train_end", F.col("step") * PERIOD_MONTHS[frequency]))


def best_parameters(losses: DataFrame) -> DataFrame:
    """(series_id, technique, trial, params, loss): one set for each series and technique, that
    of least mean loss over windows. Techniques searched by step have the best set of
    each step in one, under by_step, and the first step's beside them for steps that were
    not searched for."""
    best = search_best(losses)
    whole = best.where("step = 0").select("series_id", "technique", "trial", "params", "loss")
    inner = F.concat_ws(", ", F.transform(F.sort_array(F.collect_list(F.struct("step", "params"))), lambda x: F.concat(F.lit('"'), x["step"].cast("string"), F.lit('": '), x["params"])))
    joined = F.concat(F.lit('{"by_step": {'), inner, F.lit('}, "or": '), F.min_by("params", "step"), F.lit("}"))
    steps = best.where("step > 0").groupBy("series_id", "technique").agg(F.min("trial").alias("trial"), joined.alias("params"), F.avg("loss").alias("loss"))
    return whole.unionByName(steps)


def run_technique_set(
    prices: DataFrame, windows: DataFrame, techniques: list[str], steps: int, drivers: DataFrame | None = None, grid_limit: int | None = None, held_out: int = 3, scratch=None,
    features: DataFrame | None = None, frequency: str = "monthly", first: int = 1, fixed: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(forecasts, best parameters) of several techniques for steps first..steps: search,
    one parameter set a series and technique (or one a step), then the forecasts with it.
    fixed: (series_id, technique, trial, params) that are taken as they are, without a search."""
    history = histories(prices, drivers, features)
    best = fixed
    if best is None:
        grids = grid_frame(prices.sparkSession, techniques, grid_limit, first > 1)
        losses = run_search(task_table(history, windows, grids), held_out, (first, steps), frequency)
        best = best_parameters(scratch(losses) if scratch else losses)
        best = scratch(best) if scratch else best
    made = run_forecasts(task_table(history, windows, best.select("series_id", "technique", "trial", "params")), steps, frequency)
    return made.where(F.col("error").isNotNull() | (F.col("step") >= first)), best


def volatility_paths(prices: DataFrame, windows: DataFrame, best: DataFrame, steps: int = 18, frequency: str = "monthly") -> DataFrame:
    """(series_id, technique, window_no, step, variance): the variance path that the GARCH part
    of a technique gives for its residuals; a diagnostic beside the point forecasts."""
    chosen = best.where(F.col("technique").endswith("_garch")).select("series_id", "technique", "trial", "params")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for task, h, _, _ in _tasks(batches, frequency):
            params = json.loads(task.params)
            try:
                v = K.garch_variance(K.arima_residuals(h.y, {**params, "s": h.season}), steps, params["garch_p"], params["garch_q"])
            except Exception:  # one fit never stops the rest
                continue
            yield pd.DataFrame({"series_id": task.series_id, "technique": task.technique, "window_no": task.window_no, "step": np.arange(1, steps + 1, dtype="int32"), "variance": v})

    tasks = task_table(histories(prices), windows, chosen).withColumn("seed", F.lit(-1))
    return tasks.mapInPandas(run, "series_id string, technique string, window_no int, step int, variance double")


def stationarity(prices: DataFrame) -> DataFrame:
    """(series_id, form, adf, adf_p, adf_stationary, kpss, kpss_p, kpss_stationary) of levels and first differences."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                y = np.asarray(row.price, float)
                for form, v in (("level", y), ("difference", np.diff(y))):
                    try:
                        (a, ap, _), (k, kp) = K.adf(v), K.kpss(v)
                        out.append((row.series_id, form, a, ap, ap < 0.05, k, kp, kp > 0.05))
                    except ValueError:
                        out.append((row.series_id, form, None, None, None, None, None, None))
            yield pd.DataFrame(out, columns=["series_id", "form", "adf", "adf_p", "adf_stationary", "kpss", "kpss_p", "kpss_stationary"])

    return histories(prices).mapInPandas(run, "series_id string, form string, adf double, adf_p double, adf_stationary boolean, kpss double, kpss_p double, kpss_stationary boolean")


def driver_tests(prices: DataFrame, drivers: DataFrame) -> DataFrame:
    """(series_id, driver, granger_f, granger_p, granger, trace, trace_95, johansen): whether a
    driver's changes lead the price's, and whether both, each with a unit root, share a trend."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                y, x = np.asarray(row.price, float), np.array([np.asarray(v, float) for v in row.drivers]).reshape(len(row.price), -1)
                for j, name in enumerate(row.names):
                    ok = ~np.isnan(x[:, j])
                    a, b = y[ok], x[ok, j]
                    g = j_ = (None, None)
                    leads = shares = False
                    try:
                        g = K.granger(a, b)
                        leads = g[1] < 0.05
                    except (ValueError, np.linalg.LinAlgError):
                        pass
                    try:
                        if len(a) > 15 and K.adf(a)[1] >= 0.05 and K.adf(b)[1] >= 0.05:
                            trace, crit, _ = K.johansen(np.column_stack([a, b]))
                            j_, shares = (float(trace[0]), float(crit[0])), bool(trace[0] > crit[0])
                    except (ValueError, np.linalg.LinAlgError):
                        pass
                    out.append((row.series_id, name, g[0], g[1], leads, j_[0], j_[1], shares))
            yield pd.DataFrame(out, columns=["series_id", "driver", "granger_f", "granger_p", "granger", "trace", "trace_95", "johansen"]).astype({"granger_f": "float64", "granger_p": "float64", "trace": "float64", "trace_95": "float64"})

    return histories(prices, drivers).mapInPandas(run, "series_id string, driver string, granger_f double, granger_p double, granger boolean, trace double, trace_95 double, johansen boolean")


def importance(prices: DataFrame, drivers: DataFrame, seeds: int = 10, trees: int = 200) -> DataFrame:
    """(series_id, driver, seed, rf, gbm, effect, rank_rf, rank_gbm): shares of split gain for
    each driver and seed, and of Shapley values (effect, of the first seed's two models,
    else null); fits run by (series, seed). A series with fewer than 10 rows that hold
    all drivers is an error of the search and has no rows."""
    history = histories(prices, drivers).withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(seeds - 1)))).repartition("series_id", "seed")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                y, x = np.asarray(row.price, float), np.array([np.asarray(v, float) for v in row.drivers]).reshape(len(row.price), -1)
                ok = ~np.isnan(x).any(1)
                if ok.sum() >= 10 and x.shape[1]:
                    yield _shares(row.series_id, list(row.names), x[ok], y[ok], row.seed, trees, row.seed == 0).rename(columns={"name": "driver"})

    return history.mapInPandas(run, "series_id string, driver string, seed int, rf double, gbm double, effect double, rank_rf double, rank_gbm double")


def _shares(series: str, names: list[str], x: np.ndarray, y: np.ndarray, seed: int, trees: int, shapley: bool) -> pd.DataFrame:
    share = lambda v: v / v.sum() if np.sum(v) > 0 else np.zeros(x.shape[1])
    rank = lambda v: pd.Series(-v).rank(method="average").to_numpy()
    a, b = K.Forest(x, y, trees=trees, seed=seed), K.Boosting(x, y, trees=trees, seed=seed)
    effect = share(K.shapley_shares(a, x) + K.shapley_shares(b, x)) if shapley else np.full(len(names), np.nan)
    rf, gbm = share(a.importance), share(b.importance)
    return pd.DataFrame({"series_id": series, "name": names, "seed": seed, "rf": rf, "gbm": gbm, "effect": pd.array([None if np.isnan(v) else v for v in effect], "Float64").astype("float64"), "rank_rf": rank(rf), "rank_gbm": rank(gbm)})


def feature_importance(long: DataFrame, kept: DataFrame, seeds: int = 10, trees: int = 200) -> DataFrame:
    """(series_id, name, score): mean of the normalised forest and boosting shares over the
    seeds, of the kept features (series_id, name) alone. long: series_id, ds, price, name,
    value on complete rows."""
    rows = long.join(kept.select("series_id", "name"), ["series_id", "name"], "left_semi")
    packed = rows.groupBy("series_id", "ds").agg(F.first("price").alias("price"), F.sort_array(F.collect_list(F.struct("name", "value"))).alias("v"))
    packed = packed.groupBy("series_id").agg(F.sort_array(F.collect_list(F.struct("ds", "price", "v"))).alias("h"))
    tasks = packed.select("series_id", F.col("h.price").alias("price"), F.col("h")[0]["v"]["name"].alias("names"), F.transform("h", lambda r: r["v"]["value"]).alias("x"), F.explode(F.sequence(F.lit(0), F.lit(seeds - 1))).alias("seed")).repartition("series_id", "seed")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                x = np.array([np.asarray(v, float) for v in row.x])
                yield _shares(row.series_id, list(row.names), x, np.asarray(row.price, float), row.seed, trees, False)[["series_id", "name", "seed", "rf", "gbm"]]

    made = tasks.mapInPandas(run, "series_id string, name string, seed int, rf double, gbm double")
    return made.groupBy("series_id", "name").agg(((F.avg("rf") + F.avg("gbm")) / 2).alias("score"))


def combined_importance(rows: DataFrame) -> DataFrame:
    """(series_id, name, rf, gbm, effect, score, stability) over seeds; effect is the share
    of Shapley values."""
    spread = lambda c: F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - F.stddev_pop(c) / F.first("n")))
    n = rows.groupBy("series_id").agg(F.count_distinct("driver").alias("n"))
    out = rows.join(n, "series_id").groupBy("series_id", F.col("driver").alias("name")).agg(F.avg("rf").alias("rf"), F.avg("gbm").alias("gbm"), F.avg("effect").alias("effect"), ((spread("rank_rf") + spread("rank_gbm")) / 2).alias("stability"))
    return out.withColumn("score", (F.col("rf") + F.col("gbm") + F.col("effect")) / 3)


def decomposition(prices: DataFrame) -> DataFrame:
    """(series_id, ds, price, trend, seasonal, resid, trend_strength, seasonal_strength)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                y = np.asarray(row.price, float)
                parts = K.decompose(y)
                yield pd.DataFrame({"series_id": row.series_id, "ds": list(row.ds), "price": y, **parts, "trend_strength": K.strength(parts["trend"], parts["resid"]), "seasonal_strength": K.strength(parts["seasonal"], parts["resid"])})

    return histories(prices).mapInPandas(run, "series_id string, ds date, price double, trend double, seasonal double, resid double, trend_strength double, seasonal_strength double")


def partial_autocorrelations(prices: DataFrame, lags: int = 12) -> DataFrame:
    """(series_id, form, lag, pacf) of levels and first differences; at most a third of the rows as lags."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                y = np.asarray(row.price, float)
                for form, v in (("level", y), ("difference", np.diff(y))):
                    k = min(lags, len(v) // 3)
                    if k >= 1 and np.ptp(v) > 0:
                        out += [(row.series_id, form, i, float(p)) for i, p in enumerate(K.partial_autocorrelation(v, k))]
            yield pd.DataFrame(out, columns=["series_id", "form", "lag", "pacf"])

    return histories(prices).mapInPandas(run, "series_id string, form string, lag int, pacf double")


def project_drivers(drivers: DataFrame, as_of: DataFrame, periods: int = 18) -> DataFrame:
    """(series_id, driver, window_no, ds, projected, method): damped-trend smoothing of raw
    driver values known at each window's end."""
    rows = drivers.where("raw is not null").groupBy("series_id", "driver").agg(F.sort_array(F.collect_list(F.struct("ds", "raw"))).alias("h"))
    tasks = rows.join(as_of.select("series_id", "window_no", "train_end"), "series_id").select("series_id", "driver", "window_no", F.filter("h", lambda x: x["ds"] <= F.col("train_end")).alias("h")).where(F.size("h") > 0)
    tasks = tasks.select("series_id", "driver", "window_no", F.element_at("h", -1)["ds"].alias("last"), F.transform("h", lambda x: x["raw"]).alias("raw"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                f, method = K.project_driver(np.asarray(row.raw, float), periods)
                yield pd.DataFrame({"series_id": row.series_id, "driver": row.driver, "window_no": row.window_no, "last": row.last, "step": np.arange(1, periods + 1), "projected": f, "method": method})

    made = tasks.mapInPandas(run, "series_id string, driver string, window_no int, last date, step int, projected double, method string")
    return made.select("series_id", "driver", "window_no", F.add_months("last", F.col("step")).alias("ds"), "projected", "method")
