"""The whole run as one plan over all series and horizons.

run_batch takes price and driver tables and returns lazily built tables; barriers
(search before fit, ablation before permutation) are tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import backtest, calendar, drivers, engines, features, gate, governance, scoring, selection
from .config import BUCKETS, GATE_SIBLINGS, HORIZONS, Run, dim_technique

UNIVARIATE = ["arima", "sarima", "ets", "rf", "lgbm", "markov_switching", "arima_garch", "sarima_garch"]
WITH_DRIVERS = ["rf_ext", "lgbm_ext", "arimax", "sarimax", "var", "vecm"]
MIN_STABILITY = 0.5


def prepare_drivers(prices: DataFrame, raw: DataFrame, low: int = 0, high: int = 3, method: str = "moving_average") -> tuple[DataFrame, DataFrame]:
    """(lag scores, gated and imputed lagged drivers)."""
    scores = drivers.lag_search(prices, raw, low, high)
    return scores, drivers.gated_drivers(prices, drivers.selected_lags(raw, scores), method)


def select_drivers(prices: DataFrame, raw: DataFrame, run: Run = Run(), overrides: DataFrame | None = None, min_corr: float = 0.4, save: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(series_id, name, origin, criterion): any of four criteria on adequate drivers
    (relative importance among stable ones, correlation, Granger, Johansen), then
    overrides, redundancy on raw series, and the exchange-rate net. A series without an
    adequate driver has no rows. save writes a table to the shared folder, so that lag
    search, gating, forests and tests run once."""
    scores = save(drivers.lag_search(prices, raw, 0, 3))
    gated = save(drivers.gated_drivers(prices, drivers.selected_lags(raw, scores)))
    strength = scores.where("selected").select("series_id", F.col("driver").alias("name"), F.abs("pearson").alias("strength"), F.col("pearson").alias("corr"))
    pool = gated.select("series_id", F.col("driver").alias("name")).distinct()
    strength = strength.join(pool, ["series_id", "name"], "left_semi")
    shares = save(engines.combined_importance(engines.importance(prices, gated, run.stability_runs, run.importance_trees)))
    tests = save(engines.driver_tests(prices, gated)).select("series_id", F.col("driver").alias("name"), "granger", "johansen")
    stable = shares.where(F.col("stability") >= MIN_STABILITY)
    picked = selection.any_criterion({
        "importance": selection.above_relative(stable), "correlation": selection.above_correlation(strength, min_corr),
        "granger": tests.withColumn("chosen", F.col("granger")), "johansen": tests.withColumn("chosen", F.col("johansen")),
    })
    if overrides is None:
        overrides = pool.select("series_id").distinct().select("series_id", F.lit(None).cast("array<string>").alias("must_include"), F.lit(None).cast("array<string>").alias("force_exclude"))
    picked = save(picked)
    chosen = save(selection.apply_overrides(pool, picked, overrides))
    pairs = selection.pair_correlations(raw, "driver", "raw")
    kept = selection.greedy_redundancy(chosen.join(strength, ["series_id", "name"], "left"), pairs).where("kept").select("series_id", "name")
    final = selection.exchange_rate_net(chosen.join(kept, ["series_id", "name"], "left_semi"), strength)
    return final.join(picked.select("series_id", "name", "criterion"), ["series_id", "name"], "left")


def feature_survival(prices: DataFrame, run: Run = Run(), gated: DataFrame | None = None, save: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(series_id, name, strength, place, redundant, score, cumulative, kept) of every engineered
    feature: redundant ones go first, then the fewest whose importance adds up to
    run.feature_share stay. With gated drivers, the rows are those that hold them all;
    drivers themselves are never ranked here."""
    full = features.complete_cases(features.engineer(prices, run.frequency))
    if gated is not None:
        names = gated.groupBy("series_id").agg(F.count_distinct("driver").alias("n"))
        whole = gated.where("value is not null").groupBy("series_id", "ds").agg(F.count("*").alias("have")).join(names, "series_id").where("have = n").select("series_id", "ds")
        full = full.join(whole, ["series_id", "ds"], "left_semi")
    names = [n for n, _, _ in features.feature_table(run.frequency)]
    long = save(full.select("series_id", "ds", "price", *(F.col(n).cast("double").alias(n) for n in names)).unpivot(["series_id", "ds", "price"], names, "name", "value"))
    strength = long.groupBy("series_id", "name").agg(F.abs(selection.safe_corr("price", "value")).alias("strength"))
    placed = save(selection.greedy_redundancy(strength, selection.pair_correlations(long, "name", "value")))
    scores = save(engines.feature_importance(long, placed.where("kept"), run.stability_runs, run.importance_trees))
    cut = selection.cumulative_cut(scores, run.feature_share if run.feature_share is not None else 1e9)
    out = placed.join(cut.select("series_id", "name", "score", "cumulative", "chosen"), ["series_id", "name"], "left")
    return out.select("series_id", "name", "strength", "place", (~F.col("kept")).alias("redundant"), "score", "cumulative", F.coalesce("chosen", F.lit(False)).alias("kept"))


def details(forecasts: DataFrame, prices: DataFrame, frequency: str = "monthly") -> DataFrame:
    """Forecast steps dealt to the three horizons and evaluated."""
    return backtest.evaluate_all(forecasts, prices, HORIZONS[frequency])


def permutation_mapes(prices, windows, gated, best, span: tuple[int, int], seeds: int, survival: DataFrame | None = None, frequency: str = "monthly") -> DataFrame:
    """(series_id, technique, seed, mape) of long-horizon refits with shuffled training drivers."""
    history = engines.histories(prices, gated, survival)
    tasks = engines.task_table(history, windows, best.select("series_id", "technique", "trial", "params"))
    tasks = tasks.withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(seeds - 1)))).repartition("series_id", "technique", "window_no", "seed")
    made = engines.run_forecasts(tasks, span[1], frequency).where("error is null")
    long = made.where(F.col("step").between(*span)).join(prices.where("price <> 0").select("series_id", "ds", "price"), ["series_id", "ds"])
    per = long.groupBy("series_id", "technique", "seed", "window_no").agg(F.avg(F.abs((F.col("price") - F.col("predicted")) / F.col("price")) * 100).alias("m"))
    return per.groupBy("series_id", "technique", "seed").agg(F.avg("m").alias("mape"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def run_batch(
    prices: DataFrame, raw_drivers: DataFrame | None, run: Run = Run(), techniques: list[str] | None = None, save: Callable[[DataFrame], DataFrame] = lambda df: df,
    overrides: DataFrame | None = None, fixed: DataFrame | None = None,
) -> dict[str, DataFrame | None]:
    """Tables windows, selected, survival, survival_ext, forecasts, best, errors, volatility,
    detail, summary, gate, scores, ranks, recommended of all series and horizons. Drivers
    are selected first; every horizon has a search of its own, held out as many steps as
    it spans. fixed: (series_id, technique, horizon, trial, params) in place of searches.
    save writes a table to the shared folder and reads it again."""
    spark = prices.sparkSession
    techniques = techniques or UNIVARIATE + (WITH_DRIVERS if raw_drivers is not None else [])
    validate_choice(techniques, list(engines.TECHNIQUES), "technique")
    validate_choice(run.buckets, BUCKETS, "horizon")
    windows = save(calendar.backtest_windows(prices, run.anchor, run.frequency, run.n_windows))
    plain, told = [t for t in techniques if t not in WITH_DRIVERS], [t for t in techniques if t in WITH_DRIVERS]
    gated = selected = survival = survival_ext = None
    if told:
        gated = save(prepare_drivers(prices, raw_drivers)[1])
        if run.choose_drivers:
            selected = save(select_drivers(prices, raw_drivers, run, overrides, save=save))
            gated = save(gated.join(selected.select("series_id", F.col("name").alias("driver")), ["series_id", "driver"], "left_semi"))
    if run.feature_share is not None:
        if any(engines.TECHNIQUES[t].search == "rows" for t in plain):
            survival = save(feature_survival(prices, run, None, save))
        if any(engines.TECHNIQUES[t].search == "steps" for t in told):
            survival_ext = save(feature_survival(prices, run, gated, save))
    kept = lambda df: None if df is None else df.where("kept").select("series_id", "name")
    made, found = [], []
    for bucket in run.buckets:
        low, high = HORIZONS[run.frequency][bucket]
        for names, drivers_, features_ in ((plain, None, kept(survival)), (told, gated, kept(survival_ext))):
            if names:
                own = None if fixed is None else fixed.where((F.col("horizon") == bucket) & F.col("technique").isin(names)).drop("horizon")
                f, b = engines.run_technique_set(prices, windows, names, high, drivers_, run.grid_limit, high - low + 1, save, features_, run.frequency, low, own)
                made.append(f.withColumn("horizon", F.lit(bucket)))
                found.append(b.select("series_id", "technique", F.lit(bucket).alias("horizon"), "trial", "params"))
    forecasts, best = save(_union(made)), save(_union(found))
    detail = save(details(forecasts.where("error is null").drop("seed", "error", "seconds", "horizon"), prices, run.frequency))
    summary = save(backtest.summarise(detail))
    passed = None
    if gated is not None and "long" in run.buckets:
        ablated = save(gate.ablation(summary, run.gate))
        through = best.where("horizon = 'long'").join(ablated.where("ablation_passed").select("series_id", "technique"), ["series_id", "technique"], "left_semi")
        shuffled = permutation_mapes(prices, windows, gated, through.where(F.col("technique").isin(list(GATE_SIBLINGS))), HORIZONS[run.frequency]["long"], run.permutations, kept(survival_ext), run.frequency)
        passed = save(gate.combined(ablated, gate.permutation(ablated, shuffled, run.gate)))
    order = dim_technique(spark)
    scores = scoring.score(detail, summary, prices, order, passed, run.scoring)
    ranks = save(scoring.ranked(scores, order))
    noisy = best.where(F.col("technique").endswith("_garch") & (F.col("horizon") == run.buckets[-1]))
    return {
        "windows": windows, "selected": selected, "survival": survival, "survival_ext": survival_ext, "forecasts": forecasts, "errors": forecasts.where("error is not null"), "best": best,
        "volatility": engines.volatility_paths(prices, windows, noisy, HORIZONS[run.frequency][run.buckets[-1]][1], run.frequency), "detail": detail, "summary": summary,
        "gate": passed, "scores": scores, "ranks": ranks, "recommended": scoring.recommend(ranks),
    }


def validate_choice(given, allowed, what: str) -> None:
    """An error that names what is not among the allowed values."""
    unknown = sorted(set(given) - set(allowed))
    if unknown:
        raise ValueError(f"unknown {what} {', '.join(map(repr, unknown))}: one of {', '.join(allowed)}")


def model_registry(ranks: DataFrame, best: DataFrame, prices: DataFrame, saved_at: str, top: int = 3) -> DataFrame:
    """(series_id, horizon, rank, technique, composite, trained_through, saved_at, params):
    parameters instead of pickles; a model is fitted again from them, a direct one with
    those of each step."""
    rows = governance.savable_models(ranks, ["benchmark"], top).select("series_id", "horizon", F.col("saved_rank").alias("rank"), "technique", "composite")
    last = prices.where("price is not null").groupBy("series_id").agg(F.max("ds").alias("trained_through"))
    return rows.join(best.select("series_id", "technique", "horizon", "params"), ["series_id", "technique", "horizon"]).join(last, "series_id").withColumn("saved_at", F.lit(saved_at).cast("timestamp"))


def predict(registry: DataFrame, prices: DataFrame, gated: DataFrame | None, frequency: str = "monthly", buckets: tuple[str, ...] = BUCKETS, ranks: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(series_id, horizon, rank, technique, composite, trained_through, step, ds, predicted) of the
    newest model of each rank, fitted on history up to trained_through and cut to
    the steps of its horizon. Horizons and ranks that don't exist are an error."""
    validate_choice(buckets, BUCKETS, "horizon")
    validate_choice(map(str, ranks), ("1", "2", "3"), "rank")
    newest = governance.latest_models(registry).where(F.col("rank").isin(list(ranks)))
    out = []
    for bucket in buckets:
        low, high = HORIZONS[frequency][bucket]
        own = newest.where(F.col("horizon") == bucket)
        ends = own.select("series_id", F.lit(0).alias("window_no"), F.col("trained_through").alias("train_end")).distinct()
        models = own.select("series_id", "technique", F.lit(0).alias("trial"), "params").distinct()
        made = []
        for told, drivers_ in ((False, None), (True, gated)):
            if not told or gated is not None:
                some = models.where(F.col("technique").isin(WITH_DRIVERS) == told)
                made.append(engines.run_forecasts(engines.task_table(engines.histories(prices, drivers_), ends, some), high, frequency))
        steps = _union(made).where(F.col("error").isNull() & (F.col("step") >= low)).select("series_id", "technique", "step", "ds", "predicted")
        out.append(own.join(steps, ["series_id", "technique"]).select("series_id", "horizon", "rank", "technique", "composite", "trained_through", "step", "ds", "predicted"))
    return _union(out)
