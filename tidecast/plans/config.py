"""Dimension tables and thresholds. All thresholds are parameters of the operators;
these are the defaults."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

# Horizon ranges in steps by frequency.
HORIZONS = {
    "monthly": {"short": (1, 3), "medium": (4, 6), "long": (7, 18)},
    "quarterly": {"short": (1, 1), "medium": (2, 2), "long": (3, 6)},
}
# Techniques with eligibility (short, medium, long), in order of execution.
TECHNIQUES = [
    ("arima", "ARIMA", "univariate", "yes", "yes", "yes"),
    ("sarima", "SARIMA", "univariate", "yes", "yes", "yes"),
    ("ets", "ETS (Exponential Smoothing)", "univariate", "yes", "yes", "yes"),
    ("rf", "Random Forest (RF)", "univariate", "yes", "yes", "yes"),
    ("lgbm", "LightGBM (LGBM)", "univariate", "yes", "yes", "yes"),
    ("markov_switching", "Markov-Switching", "univariate", "yes", "yes", "yes"),
    ("arima_garch", "ARIMA + GARCH", "univariate", "yes", "yes", "yes"),
    ("sarima_garch", "SARIMA + GARCH", "univariate", "yes", "yes", "yes"),
    ("rf_ext", "RF + External Drivers", "multivariate", "yes", "yes", "gated"),
    ("lgbm_ext", "LGBM + External Drivers", "multivariate", "yes", "yes", "gated"),
    ("arimax", "ARIMAX", "multivariate", "yes", "yes", "gated"),
    ("sarimax", "SARIMAX", "multivariate", "yes", "yes", "gated"),
    ("var", "VAR", "multivariate", "yes", "yes", "gated"),
    ("vecm", "VECM", "multivariate", "yes", "yes", "gated"),
    ("lstm", "LSTM", "univariate", "no", "no", "no"),
    ("tst", "TST (Time Series Transformer)", "univariate", "no", "no", "no"),
    ("tft", "TFT", "univariate", "no", "no", "no"),
    ("tst_ext", "TST + External Drivers", "multivariate", "no", "no", "no"),
    ("tft_ext", "TFT + External Drivers", "multivariate", "no", "no", "no"),
    ("benchmark", "Benchmark", "benchmark", "yes", "yes", "yes"),
]
# The technique without drivers that a gated one must beat.
GATE_SIBLINGS = {"rf_ext": "rf", "lgbm_ext": "lgbm", "arimax": "arima", "sarimax": "sarima", "var": "arima", "vecm": "arima"}
BUCKETS = ("short", "medium", "long")
HORIZON_DISPLAY = {"short": "Short Term", "medium": "Medium Term", "long": "Long Term"}


@dataclass(frozen=True)
class Scoring:
    """Weights, thresholds and penalties of the composite score."""

    accuracy_weight: float = 50
    direction_weight: float = 25
    dynamism_weight: float = 15
    recency_weight: float = 10
    min_cycles: int = 3
    eligible_accuracy: float = 85
    eligible_direction: float = 55
    fail_accuracy: float = 75
    fail_direction: float = 55
    flat_points: float = -15
    flat_cv_pct: float = 2
    outlier_points: float = -5
    outlier_low: float = 0.3
    outlier_high: float = 3.0
    bias_points: float = -10
    bias_pct: float = 10
    recent_cycles: int = 2
    recent_weight: float = 1.5
    floor: float = 0
    tier_high: float = 85
    tier_medium: float = 75
    strong_accuracy: float = 90
    strong_direction: float = 70
    strong_dynamism: float = 70


@dataclass(frozen=True)
class Gate:
    """The least gain over the sibling, the largest p-value, the shuffles."""

    min_mape_drop: float = 1.5
    max_p_value: float = 0.05
    permutations: int = 30


@dataclass(frozen=True)
class Run:
    """Parameters of a run, with fixed values as defaults; fast() is the reduced form
    for tries. grid_limit is the number of parameter sets tried for a technique (None:
    the number that each has of its own)."""

    anchor: str = "2025-03-01"
    frequency: str = "monthly"
    n_windows: int | None = None
    permutations: int = 30
    stability_runs: int = 10
    importance_trees: int = 200
    grid_limit: int | None = None
    feature_share: float | None = 0.7  # of importance that engineered features are kept for; None keeps all
    choose_drivers: bool = True  # the prerequisite pass of driver selection
    buckets: tuple[str, ...] = BUCKETS
    scoring: Scoring = field(default_factory=Scoring)
    gate: Gate = field(default_factory=Gate)

    def fast(self) -> Run:
        return replace(self, n_windows=4, permutations=2, stability_runs=2, importance_trees=20, grid_limit=2)


def dim_horizon(spark: SparkSession) -> DataFrame:
    rows = [(f, b, lo, hi) for f, by in HORIZONS.items() for b, (lo, hi) in by.items()]
    return spark.createDataFrame(rows, "frequency string, bucket string, m_start int, m_end int")


def dim_technique(spark: SparkSession) -> DataFrame:
    """(technique, display_name, category, exec_order, bucket, eligibility)."""
    rows = [(t, name, kind, i, bucket, e[k]) for i, (t, name, kind, *e) in enumerate(TECHNIQUES) for k, bucket in enumerate(BUCKETS)]
    return spark.createDataFrame(rows, "technique string, display_name string, category string, exec_order int, bucket string, eligibility string")


def resolve_horizon(warmup: int, forecast: int, label: str | None = None) -> tuple[int, int, str]:
    if warmup < 0 or forecast < 1:
        raise ValueError("warmup must be at least 0 and forecast at least 1")
    low, high = warmup + 1, warmup + forecast
    return low, high, label or f"M{low}-M{high}"
