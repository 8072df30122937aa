"""Search spaces of the techniques and the parameter sets that a search tries."""

from __future__ import annotations

import itertools
import math
from functools import lru_cache

import numpy as np

ORDER_TOTAL = 5
SEED = 42

# Ranges (lists are choices, ("int", low, high, step), ("float", low, high),
# ("log", low, high)), and the number of sets that a search tries.
_ARIMA = {"p": [1, 2, 3], "d": [0, 1, 2], "q": [0, 1, 2, 3]}
_GARCH = {"garch_p": [1, 2], "garch_q": [1, 2]}
_SEASONAL = {"P": [1, 2], "D": [0, 1], "Q": [0, 1, 2]}
_FEATURES = ["sqrt", "log2", None]
SPACES: dict[str, tuple[dict, int]] = {
    "arima": (_ARIMA, 50),
    "sarima": (_ARIMA | _SEASONAL, 20),
    "ets": ({"trend": ["add", "mul", None], "seasonal": ["add", "mul", None], "damped": [True, False], "start": ["estimated", "heuristic"]}, 50),
    "rf": ({"trees": ("int", 100, 1000, 50), "depth": ("int", 3, 15, 1), "leaf": ("int", 1, 10, 1), "split": ("int", 2, 10, 1), "features": _FEATURES}, 50),
    "rf_long": ({"trees": ("int", 20, 200, 5), "depth": ("int", 3, 15, 1), "leaf": ("int", 3, 10, 1), "split": ("int", 2, 10, 1), "features": _FEATURES}, 50),
    "lgbm": ({"trees": ("int", 50, 1000, 50), "depth": ("int", 3, 7, 1), "rate": ("log", 0.005, 0.07), "leaves": ("int", 3, 25, 1), "leaf": ("int", 5, 20, 1), "ridge": ("float", 1.0, 10.0)}, 50),
    "lgbm_long": ({"trees": ("int", 20, 200, 5), "depth": ("int", 4, 6, 1), "rate": ("log", 0.005, 0.07), "leaves": ("int", 6, 7, 1), "leaf": ("int", 25, 40, 1), "ridge": ("float", 6.0, 12.0)}, 50),
    "markov_switching": ({"regimes": [2, 3], "order": [1, 2, 3, 4], "trend": ["c", "n"], "switching_variance": [True, False]}, 30),
    "arima_garch": (_ARIMA | _GARCH, 50),
    "sarima_garch": (_ARIMA | _SEASONAL | _GARCH, 20),
    "arimax": ({}, 1),
    "sarimax": ({"seasonal": [True]}, 1),
    "var": ({"lags": [1, 2, 3, 4, 5, 6]}, 30),
    "vecm": ({"k_ar_diff": [1, 2, 3, 4, 5, 6], "deterministic": ["n", "co", "ci", "lo", "li"]}, 30),
    "rf_ext": ({"trees": ("int", 50, 300, 1), "depth": ("int", 2, 6, 1), "split": ("int", 2, 10, 1), "features": ("float", 0.4, 1.0), "leaf": ("int", 1, 5, 1)}, 25),
    "lgbm_ext": ({"trees": ("int", 50, 200, 1), "depth": ("int", 2, 4, 1), "leaves": ("int", 4, 15, 1), "leaf": ("int", 5, 20, 1), "rows": ("float", 0.6, 1.0), "columns": ("float", 0.6, 1.0), "rate": ("log", 0.01, 0.1)}, 25),
}
#: What every fit of a technique takes besides what is searched for.
FIXED = {"lgbm": {"stop": 20, "rows": 1.0, "columns": 1.0}}


def valid(params: dict) -> bool:
    """Whether a set may be fitted: orders add up to ORDER_TOTAL at most, no double
    differencing in both parts, damping only with a trend, no more leaves than a depth holds."""
    if "p" in params and params["p"] + params["d"] + params["q"] > ORDER_TOTAL:
        return False
    if "P" in params and (params["P"] + params["D"] + params["Q"] > ORDER_TOTAL or params["d"] == 2 and params["D"] == 1):
        return False
    if params.get("damped") and params.get("trend") is None:
        return False
    return not ("leaves" in params and "depth" in params and params["leaves"] > 2 ** params["depth"])


def _draw(rng: np.random.Generator, spec) -> object:
    if isinstance(spec, list):
        return spec[int(rng.integers(len(spec)))]
    kind, low, high, *step = spec
    if kind == "int":
        return low + step[0] * int(rng.integers((high - low) // step[0] + 1))
    if kind == "log":
        return round(math.exp(rng.uniform(math.log(low), math.log(high))), 6)
    return round(float(rng.uniform(low, high)), 6)


def whole_space(technique: str) -> list[dict] | None:
    """Every valid set, or None where a range is not a list."""
    space = SPACES[technique][0]
    if not all(isinstance(v, list) for v in space.values()):
        return None
    sets = (dict(zip(space, values)) for values in itertools.product(*space.values()))
    return [s for s in sets if valid(s)]


@lru_cache(maxsize=64)
def _trials(technique: str) -> tuple:
    space, n = SPACES[technique]
    rng, every = np.random.default_rng(SEED), whole_space(technique)
    if every is not None:
        return tuple(tuple(every[i].items()) for i in rng.permutation(len(every))[:n])
    out: dict[tuple, None] = {}
    while len(out) < n:
        one = {k: _draw(rng, v) for k, v in space.items()}
        if valid(one):
            out[tuple(one.items())] = None
    return tuple(out)


def trials(technique: str, limit: int | None = None, long: bool = False) -> list[dict]:
    """The sets that a search tries: as many as the technique's own number, drawn without
    repeats from a fixed seed (all, where the space holds no more), or the first `limit`
    of them. long takes the space for horizons that start later, where there is one."""
    name = f"{technique}_long" if long and f"{technique}_long" in SPACES else technique
    return [dict(t) | FIXED.get(technique, {}) for t in _trials(name)[:limit]]
