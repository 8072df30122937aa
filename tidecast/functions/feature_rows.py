"""The engineered features of one month from a plain history, for models that build
their own future rows. Frames that the history can't fill use what is there."""

from __future__ import annotations

import math

import numpy as np

from ..operators.features import MONTHS, feature_table, sizes

CALENDAR = [n for n, family, _ in feature_table() if family == "calendar"]


def calendar_row(year: int, month: int, first_year: int) -> dict[str, float]:
    quarter = (month - 1) // 3 + 1
    m, q = 2 * math.pi * month / 12, 2 * math.pi * quarter / 4
    out = {"month": month, "quarter": quarter, "year": year, "month_sin": math.sin(m), "month_cos": math.cos(m), "quarter_sin": math.sin(q), "quarter_cos": math.cos(q), "years_since_start": year - first_year}
    return out | {f"is_q{i}": float(quarter == i) for i in range(1, 5)} | {f"is_{n}": float(month == i) for i, n in enumerate(MONTHS, 1)}


def _div(a: float, b: float) -> float:
    return a / b if b else 0.0


def feature_row(past: np.ndarray, past_months: np.ndarray, year: int, month: int, first_year: int, frequency: str = "monthly") -> dict[str, float]:
    """Features of the period after `past`; past_months are 1..12 of its rows."""
    s, n = sizes(frequency), len(past)
    back = lambda k: float(past[-min(k, n)])
    spread = lambda v: float(v.std(ddof=1)) if len(v) > 1 else 0.0
    one = back(1)
    out = {f"lag_{k}": back(k) for k in s["lags"]}
    mean = {}
    for k in s["rolling"]:
        v = past[-k:]
        mean[k], sd = float(v.mean()), spread(v)
        out |= {f"roll_mean_{k}": mean[k], f"roll_std_{k}": sd, f"roll_min_{k}": float(v.min()), f"roll_max_{k}": float(v.max())}
        out |= {f"roll_zscore_{k}": _div(one - mean[k], sd), f"coef_var_{k}": _div(sd, mean[k])}
    change = lambda a, b: (_div(back(a), back(b)) - 1) * 100
    out |= {"mom_change": one - back(2), "mom_pct_change": change(1, 2), "mom_pct_lag1": change(2, 3), "mom_pct_lag2": change(3, 4)}
    out |= {f"cum_return_{k}p": change(1, 1 + k) for k in s["cumulative"]}
    short, long = s["rolling"][0], s["rolling"][-1]
    out |= {"price_to_ma_long": _div(one, mean[long]), "price_to_ma_short": _div(one, mean[short]), "ma_short_to_ma_long": _div(mean[short], mean[long])}
    all_mean = float(past.mean())
    same = past[past_months == month] if frequency == "monthly" else past[(past_months - 1) // 3 == (month - 1) // 3]
    out |= {"expanding_mean": all_mean, "expanding_std": spread(past), "price_to_expanding_mean": _div(one, all_mean), "seasonal_index": _div(float(same.mean()) if len(same) else all_mean, all_mean)}
    k = s["long"]
    v = past[-k:]
    out |= {f"rolling_mean_{k}": float(v.mean()), f"rolling_std_{k}": spread(v), f"price_to_rolling_mean_{k}": _div(one, float(v.mean()))}
    return out | calendar_row(year, month, first_year)


def warmup(frequency: str = "monthly") -> int:
    """Rows before the first whose longest lag and its change are known."""
    return sizes(frequency)["lags"][-1] + 1


def feature_matrix(prices: np.ndarray, years: np.ndarray, months: np.ndarray, frequency: str = "monthly") -> np.ndarray:
    """The features from row warmup on, in the order of feature_table."""
    names = [n for n, _, _ in feature_table(frequency)]
    rows = []
    for t in range(warmup(frequency), len(prices)):
        f = feature_row(prices[:t], months[:t], int(years[t]), int(months[t]), int(years[0]), frequency)
        rows.append([f[n] for n in names])
    return np.array(rows).reshape(len(rows), len(names))
