"""Numpy kernels for what columns can't express: statistical tests and model fits.

Written from published methods: OLS, Hannan-Rissanen for ARMA terms, additive and
multiplicative exponential smoothing, CART forests and boosting, Hamilton's
filter with EM, VAR and reduced-rank VECM, MacKinnon's response surface for
unit-root tests, Johansen's trace test. Each forecaster takes (y, params, steps)
with y oldest first and returns an array, or raises.
"""

from __future__ import annotations

import heapq
import itertools
import math

import numpy as np


def ols(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """(coefficients, sum of squared residuals, standard errors)."""
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    rest = y - x @ beta
    ssr = float(rest @ rest)
    spread = ssr / max(1, len(y) - x.shape[1])
    return beta, ssr, np.sqrt(np.maximum(0, np.diag(np.linalg.pinv(x.T @ x)) * spread))


def natural_spline(v: np.ndarray, order: int = 3) -> np.ndarray:
    """Fills NaN between values by a natural cubic spline (order 3 and four values or
    more), else by lines; repeats the last value; leaves leading NaN."""
    at, out = np.arange(len(v), dtype=float), v.copy()
    known = np.flatnonzero(~np.isnan(v))
    if len(known) < 2:
        return np.where(np.isnan(v) & (at > known[0]), v[known[0]], v) if len(known) else out
    x, y = at[known], v[known]
    inside = np.isnan(v) & (at > x[0]) & (at < x[-1])
    if order >= 3 and len(known) >= 4:
        h = np.diff(x)
        a = np.eye(len(x))
        b = np.zeros(len(x))
        for i in range(1, len(x) - 1):
            a[i, i - 1 : i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
            b[i] = 6 * ((y[i + 1] - y[i]) / h[i] - (y[i] - y[i - 1]) / h[i - 1])
        m = np.linalg.solve(a, b)
        i = np.clip(np.searchsorted(x, at[inside]) - 1, 0, len(h) - 1)
        left, right = at[inside] - x[i], x[i + 1] - at[inside]
        out[inside] = (m[i] * right**3 + m[i + 1] * left**3) / (6 * h[i]) + (y[i] / h[i] - m[i] * h[i] / 6) * right + (y[i + 1] / h[i] - m[i + 1] * h[i] / 6) * left
    else:
        out[inside] = np.interp(at[inside], x, y)
    out[np.isnan(v) & (at > x[-1])] = y[-1]
    return out


# --- distributions and tests ---------------------------------------------------


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 300):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 + top * d, 1 + top / c
            d, c = 1 / (d if abs(d) > tiny else tiny), (c if abs(c) > tiny else tiny)
            total *= d * c
        if abs(d * c - 1) < 1e-12:
            break
    return front * total / a


def f_tail(f: float, k: int, n: int) -> float:
    """P(F > f) with k and n degrees of freedom."""
    return 1.0 if f <= 0 else incomplete_beta(n / 2, k / 2, n / (n + k * f))


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


# Published response-surface coefficients of the unit-root test with a
# constant (one variable): tau range, then polynomials for small and large p.
ADF_MAX, ADF_MIN, ADF_STAR = 2.74, -18.83, -1.61
ADF_SMALL = (2.1659, 1.4412, 0.038269)
ADF_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
# Published critical values of the level-stationarity test.
KPSS_VALUES, KPSS_P = (0.347, 0.463, 0.574, 0.739), (0.10, 0.05, 0.025, 0.01)
# Published 95 % trace values with a constant, by variables less rank.
TRACE_95 = (3.8415, 15.4943, 29.7961, 47.8545, 69.8189, 95.7542, 125.6185, 159.5290, 197.3772, 239.2468, 285.1402, 334.9795)


def adf(y: np.ndarray, max_lag: int | None = None) -> tuple[float, float, int]:
    """(statistic, p, lags): augmented Dickey-Fuller with a constant, lags by AIC."""
    n = len(y)
    if n < 8 or np.ptp(y) == 0:
        raise ValueError("too short or constant")
    top = min(n // 2 - 3, math.ceil(12 * (n / 100) ** 0.25)) if max_lag is None else max_lag
    dy, best = np.diff(y), None

    def fit(k: int, start: int):
        rows = np.arange(start, len(dy))
        x = np.column_stack([y[rows], *(dy[rows - i] for i in range(1, k + 1)), np.ones(len(rows))])
        beta, ssr, se = ols(x, dy[rows])
        return beta[0] / max(se[0], 1e-300), len(rows) * math.log(max(ssr, 1e-300) / len(rows)) + 2 * x.shape[1]

    for k in range(max(0, top) + 1):
        aic = fit(k, max(0, top))[1]
        if best is None or aic < best[0]:
            best = (aic, k)
    stat = fit(best[1], best[1])[0]
    if stat > ADF_MAX:
        return stat, 1.0, best[1]
    if stat < ADF_MIN:
        return stat, 0.0, best[1]
    poly = ADF_SMALL if stat <= ADF_STAR else ADF_LARGE
    return stat, normal_cdf(sum(c * stat**i for i, c in enumerate(poly))), best[1]


def kpss(y: np.ndarray) -> tuple[float, float]:
    """(statistic, p clipped to 0.01..0.10): stationarity about a level, automatic bandwidth."""
    n, e = len(y), y - y.mean()
    lags = int(math.ceil(12 * (n / 100) ** 0.25))
    s = float(e @ e) / n
    s += 2 * sum((1 - k / (lags + 1)) * float(e[k:] @ e[:-k]) / n for k in range(1, min(lags, n - 1) + 1))
    if s <= 0:
        raise ValueError("no variance")
    stat = float((np.cumsum(e) ** 2).sum()) / (n * n * s)
    return stat, float(np.interp(stat, KPSS_VALUES, KPSS_P))


def granger(y: np.ndarray, x: np.ndarray, lag: int = 1) -> tuple[float, float]:
    """(F, p): whether past first differences of x help to explain those of y."""
    dy, dx = np.diff(y), np.diff(x)
    if len(dy) <= 10:
        raise ValueError("too short")
    rows = np.arange(lag, len(dy))
    own = [np.ones(len(rows)), *(dy[rows - i] for i in range(1, lag + 1))]
    small, full = np.column_stack(own), np.column_stack([*own, *(dx[rows - i] for i in range(1, lag + 1))])
    _, a, _ = ols(small, dy[rows])
    _, b, _ = ols(full, dy[rows])
    free = len(rows) - full.shape[1]
    f = (a - b) / lag / max(b / free, 1e-300)
    return f, f_tail(f, lag, free)


def johansen(x: np.ndarray, lags: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
    """(trace statistics, their 95 % values, rank) of a frame with `lags` differences and a constant."""
    dx, level = np.diff(x, axis=0), x[lags:-1]
    rows = np.arange(lags, len(dx))
    z = np.column_stack([np.ones(len(rows)), *(dx[rows - i] for i in range(1, lags + 1))])
    r0, r1 = (m - z @ np.linalg.lstsq(z, m, rcond=None)[0] for m in (dx[rows], level))
    n = len(rows)
    s00, s11, s01 = r0.T @ r0 / n, r1.T @ r1 / n, r0.T @ r1 / n
    values = np.sort(np.real(np.linalg.eigvals(np.linalg.pinv(s11) @ s01.T @ np.linalg.pinv(s00) @ s01)))[::-1]
    values = np.clip(values, 0, 1 - 1e-12)
    trace = np.array([-n * np.log(1 - values[i:]).sum() for i in range(len(values))])
    crit = np.array([TRACE_95[min(len(values) - i, len(TRACE_95)) - 1] for i in range(len(values))])
    rank = next((i for i in range(len(values)) if trace[i] <= crit[i]), len(values))
    return trace, crit, rank


def partial_autocorrelation(y: np.ndarray, lags: int) -> np.ndarray:
    """PACF by Durbin-Levinson from the usual autocorrelations."""
    e = y - y.mean()
    c = np.array([float(e[k:] @ e[: len(e) - k]) for k in range(lags + 1)])
    r = c / c[0]
    out, phi = [1.0], np.zeros(0)
    for k in range(1, lags + 1):
        a = (r[k] - phi @ r[k - 1 : 0 : -1][: len(phi)]) / (1 - phi @ r[1:k]) if k > 1 else r[1]
        phi = np.append(phi - a * phi[::-1], a)
        out.append(float(a))
    return np.array(out)


def loess(t: np.ndarray, y: np.ndarray, at: np.ndarray, window: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Locally weighted linear fits of y over t, at given places, with tricube weights over
    the nearest `window` points (stretched where there are fewer)."""
    gap = np.abs(at[:, None] - t[None])
    k = min(window, len(t))
    reach = np.partition(gap, k - 1, axis=1)[:, k - 1] * (window / k if window > k else 1.0)
    w = np.clip(1 - (gap / np.maximum(reach * (1 + 1e-9), 1e-9)[:, None]) ** 3, 0, 1) ** 3 + 1e-300
    if weights is not None:
        w = w * weights[None]
    total = np.maximum(w.sum(1), 1e-300)
    mid, mean = (w @ t) / total, (w @ y) / total
    square = (w * (t[None] - mid[:, None]) ** 2).sum(1)
    slope = (w * (t[None] - mid[:, None])) @ y / np.where(square > 1e-9 * total, square, np.inf)
    return mean + slope * (at - mid)


def decompose(y: np.ndarray, season: int = 12, seasonal_window: int = 7, rounds: int = 2, robust: int = 1) -> dict[str, np.ndarray]:
    """Trend, seasonal and rest by STL: each phase is smoothed over the years by LOESS, what
    moving averages keep of that is taken off, and the deseasonalised rows are smoothed
    for the trend; `robust` times more with weights that outliers lose."""
    n, t = len(y), np.arange(len(y), dtype=float)
    if n < 2 * season:
        raise ValueError("two seasons at least")
    odd = lambda v: int(v) | 1
    trend_window = odd(math.ceil(1.5 * season / (1 - 1.5 / seasonal_window)))
    mean = lambda v, k: np.convolve(v, np.ones(k) / k, "valid")
    trend, seasonal, weight = np.zeros(n), np.zeros(n), np.ones(n)
    for outer in range(robust + 1):
        for _ in range(rounds):
            rest, wide = y - trend, np.zeros(n + 2 * season)
            for phase in range(season):
                own = np.arange(phase, n, season)
                place = np.arange(len(own), dtype=float)
                smooth = loess(place, rest[own], np.arange(-1.0, len(own) + 1), seasonal_window, weight[own])
                wide[phase : phase + season * len(smooth) : season] = smooth
            low = mean(mean(mean(wide, season), season), 3)
            seasonal = wide[season : season + n] - loess(t, low, t, odd(season))
            trend = loess(t, y - seasonal, t, trend_window, weight)
        rest = y - trend - seasonal
        if outer < robust:
            top = 6 * np.median(np.abs(rest)) + 1e-12
            weight = np.clip(1 - (rest / top) ** 2, 0, 1) ** 2
    return {"trend": trend, "seasonal": seasonal, "resid": y - trend - seasonal}


def strength(part: np.ndarray, rest: np.ndarray) -> float:
    total = np.var(part + rest)
    return float(max(0.0, 1 - np.var(rest) / total)) if total > 0 else 0.0


# --- forecasters ------------------------------------------------------------------


def _difference(y: np.ndarray, d: int, seasonal: int, s: int) -> tuple[np.ndarray, list[np.ndarray]]:
    kept = []
    for step in [s] * seasonal + [1] * d:
        kept.append(y[-step:])
        y = y[step:] - y[:-step]
    return y, kept


def _integrate(f: np.ndarray, kept: list[np.ndarray]) -> np.ndarray:
    for tail in reversed(kept):
        full = list(tail)
        for v in f:
            full.append(v + full[-len(tail)])
        f = np.array(full[len(tail) :])
    return f


def _damp(coef: np.ndarray, lags: list[int], limit: float = 0.97) -> np.ndarray:
    """Coefficients drawn in until every root of their polynomial is inside the limit."""
    if not len(lags):
        return coef
    poly = np.zeros(max(lags) + 1)
    poly[0] = 1.0
    for c, k in zip(coef, lags):
        poly[k] -= c
    radius = np.abs(np.roots(poly)).max(initial=0.0)
    return coef if radius <= limit else coef * (limit / radius) ** np.array(lags)


def fit_arma(w: np.ndarray, ar: list[int], ma: list[int]) -> tuple[np.ndarray, np.ndarray, float]:
    """(coefficients with the constant first, residuals, AIC) by two regressions."""
    long = min(max([*ar, *ma, 1]) + 2, max(1, len(w) // 4))
    e = np.zeros(len(w))
    if ma:
        rows = np.arange(long, len(w))
        x = np.column_stack([np.ones(len(rows)), *(w[rows - i] for i in range(1, long + 1))])
        beta, *_ = ols(x, w[rows])
        e[rows] = w[rows] - x @ beta
    first = max([*ar, *(m + long for m in ma), 0])
    rows = np.arange(first, len(w))
    if len(rows) < len(ar) + len(ma) + 3:
        raise ValueError("too short for this order")
    x = np.column_stack([np.ones(len(rows)), *(w[rows - i] for i in ar), *(e[rows - i] for i in ma)])
    beta, ssr, _ = ols(x, w[rows])
    mean = float(w.mean())
    beta[1 : 1 + len(ar)] = _damp(beta[1 : 1 + len(ar)], ar)
    beta[1 + len(ar) :] = -_damp(-beta[1 + len(ar) :], ma)
    beta[0] = mean * (1 - beta[1 : 1 + len(ar)].sum())
    rest = np.zeros(len(w))
    for t in range(max([*ar, *ma, 0]), len(w)):
        rest[t] = np.clip(w[t] - beta @ np.concatenate([[1.0], [w[t - i] for i in ar], [rest[t - i] for i in ma]]), -1e9, 1e9)
    return beta, rest, len(rows) * math.log(max(ssr, 1e-300) / len(rows)) + 2 * len(beta)


def _lags(p: int, seasonal: int, s: int) -> list[int]:
    own = list(range(1, p + 1))
    return sorted({*own, *(s * k for k in range(1, seasonal + 1)), *(s * k + i for k in range(1, seasonal + 1) for i in own)})


def arima(y: np.ndarray, params: dict, steps: int) -> np.ndarray:
    """(Seasonal) ARIMA: p, d, q and optionally P, D, Q, s."""
    s = params.get("s", 12)
    w, kept = _difference(y, params["d"], params.get("D", 0), s)
    ar, ma = _lags(params["p"], params.get("P", 0), s), _lags(params["q"], params.get("Q", 0), s)
    beta, e, _ = fit_arma(w, ar, ma)
    values, rest = list(w), list(e)
    top = 10 * (np.abs(w).max() + 1e-12)
    for _ in range(steps):
        x = np.concatenate([[1.0], [values[-i] for i in ar], [rest[-i] for i in ma]])
        values.append(float(np.clip(beta @ x, -top, top)))
        rest.append(0.0)
    return _integrate(np.array(values[len(w) :]), kept)


def arimax(y: np.ndarray, params: dict, steps: int, x: np.ndarray, future: np.ndarray) -> np.ndarray:
    """Regression on drivers with ARMA errors. Missing future rows repeat the last one;
    without an order, it is searched for stepwise."""
    scale, mid = x.std(0), x.mean(0)
    use = scale > 0
    z = lambda m: (m[:, use] - mid[use]) / scale[use]
    rows = np.where(np.isnan(future), np.vstack([x[-1:]] * len(future)), future)
    design = np.column_stack([np.ones(len(y)), z(x)])
    gram = design.T @ design + 1e-3 * np.eye(design.shape[1])
    beta = np.linalg.solve(gram, design.T @ y)
    rest = y - design @ beta
    order = params if "p" in params else stepwise_order(rest, params.get("s", 1))
    return np.column_stack([np.ones(steps), z(rows[:steps])]) @ beta + arima(rest, order, steps)


def stepwise_order(y: np.ndarray, season: int = 1, top: tuple[int, int, int] = (3, 2, 3), least: int = 24) -> dict:
    """Order of least AIC found step by step: differences until KPSS accepts a level as
    stationary (at most top d), then p and q (and, with a season, P and Q up to 1) from
    four starts to the best neighbour until none is better. (1, 1, 1) for fewer rows
    than `least`, or where nothing fits."""
    default = {"p": 1, "d": 1, "q": 1}
    if len(y) < least:
        return default
    d, w = 0, y
    while d < top[1] and np.ptp(w) > 0 and kpss(w)[1] < 0.05:
        d, w = d + 1, np.diff(w)
    tried: dict[tuple, float] = {}

    def aic(o: tuple) -> float:
        if o not in tried:
            p, q, a, b = o
            try:
                if p + q + a + b == 0 or not (0 <= p <= top[0] and 0 <= q <= top[2] and 0 <= a <= int(season > 1) and 0 <= b <= int(season > 1)):
                    raise ValueError("outside the range")
                tried[o] = fit_arma(w, _lags(p, a, season), _lags(q, b, season))[2] / len(w)
            except (ValueError, np.linalg.LinAlgError):
                tried[o] = math.inf
        return tried[o]

    at = min([(2, 2, 0, 0), (1, 0, 0, 0), (0, 1, 0, 0), (1, 1, int(season > 1), 0)], key=aic)
    while True:
        near = [tuple(v + (i == k) * move for i, v in enumerate(at)) for k in range(4) for move in (-1, 1)]
        near += [(at[0] + m, at[1] + m, at[2], at[3]) for m in (-1, 1)]
        nearest = min(near, key=aic)
        if not aic(nearest) < aic(at) - 1e-12:
            break
        at = nearest
    if math.isinf(aic(at)):
        return default
    seasonal = {"P": at[2], "D": 0, "Q": at[3], "s": season} if season > 1 else {}
    return {"p": at[0], "d": d, "q": at[1], **seasonal}


def ets(y: np.ndarray, params: dict, steps: int) -> np.ndarray:
    """Exponential smoothing: trend and seasonal each "add", "mul" or None, damped. The first
    states come from the first season ("heuristic"), or the best of a few shifts of its
    level and slope is taken with the weights ("estimated")."""
    trend, seasonal, damped, s = params.get("trend"), params.get("seasonal"), params.get("damped", False), params.get("s", 12)
    if seasonal and len(y) < 2 * s:
        seasonal = None
    if "mul" in (trend, seasonal) and y.min() <= 0:
        raise ValueError("multiplicative parts need positive values")
    grid = itertools.product((0.1, 0.3, 0.6, 0.9), (0.05, 0.2) if trend else (0.0,), (0.05, 0.3) if seasonal else (0.0,), (0.9, 0.98) if damped and trend else (1.0,))
    starts = [(0.0, 1.0)] if params.get("start", "heuristic") == "heuristic" else [(0.0, 1.0), (0.0, 0.0), (-0.5, 1.0), (0.5, 1.0)]
    # all sets of weights and starts at once, one entry of each array a set
    sets = np.array([(*g, *st) for g in grid for st in starts]).T
    with np.errstate(all="ignore"):
        sse, levels, slopes, seasons = _smooth(y, trend, seasonal, s, *sets)
    won = int(np.argmin(np.where(np.isfinite(sse), sse, np.inf)))
    level, slope, season, phi = float(levels[won]), float(slopes[won]), seasons[:, won], float(sets[3, won])
    out, k = [], 0.0
    for h in range(1, steps + 1):
        k += phi**h
        base = level + k * slope if trend != "mul" else level * slope**k
        f = season[(len(y) + h - 1) % s] if seasonal else 0.0
        out.append(base + f if seasonal == "add" else base * f if seasonal == "mul" else base)
    return np.array(out)


def _smooth(y, trend, seasonal, s, a, b, g, phi, shift, steep):
    """(sum of squared errors, level, slope, season) of each set of weights after the last row."""
    n0, one = s if seasonal else min(4, len(y) - 1), np.ones(len(a))
    far, level = min(len(y) - 1, 2 * n0 - 1), y[:n0].mean()
    slope = 0.0 * one if trend is None else one if trend == "mul" else (y[far] - y[0]) / max(1, far) * steep
    season = np.outer((y[:s] - level if seasonal == "add" else y[:s] / level) if seasonal else np.full(s, float(seasonal == "mul")), one)
    level = level + shift * y[:n0].std()
    sse = np.zeros(len(a))
    for t, v in enumerate(y):
        base = level + phi * slope if trend == "add" else level * slope**phi if trend == "mul" else level
        c = season[t % s].copy()
        sse += (v - (base + c if seasonal == "add" else base * c if seasonal == "mul" else base)) ** 2
        clean = v - c if seasonal == "add" else v / c if seasonal == "mul" else v
        before, level = level, a * clean + (1 - a) * base
        if trend == "add":
            slope = b * (level - before) + (1 - b) * phi * slope
        elif trend == "mul":
            slope = b * level / before + (1 - b) * slope**phi
        if seasonal == "add":
            season[t % s] = g * (v - level) + (1 - g) * c
        elif seasonal == "mul":
            season[t % s] = g * v / level + (1 - g) * c
    return sse, level, slope, season


def project_driver(y: np.ndarray, steps: int, season: int = 12) -> tuple[np.ndarray, str]:
    """Damped-trend smoothing, seasonal with two full cycles; flat below 8 values or on failure."""
    if len(y) >= 8:
        try:
            f = ets(y, {"trend": "add", "damped": True, "seasonal": "add" if len(y) >= 2 * season else None, "s": season}, steps)
            if np.isfinite(f).all():
                return f, "ets"
        except (ValueError, FloatingPointError):
            pass
    return np.full(steps, y[-1]), "flat"


class Tree:
    """A regression tree over exact splits, kept as flat arrays; the split with most gain
    is made first, until there are `leaves` leaves (None: as many as the rest allows)."""

    def __init__(self, x, y, depth, leaf, n_features, rng, leaves=None, split=2, ridge=0.0):
        self.nodes, self.cover, self.gain = [], [], np.zeros(x.shape[1])
        waiting: list[tuple] = []

        def open_node(rows, left_depth):
            at, t = len(self.nodes), y[rows]
            self.nodes.append((-1, 0.0, -1, -1, float(t.sum() / (len(t) + ridge))))
            self.cover.append(len(rows))
            if left_depth > 0 and len(rows) >= max(split, 2 * leaf) and np.ptp(t) > 0:
                found = self._best(x[rows], t, leaf, n_features, rng, ridge)
                if found:
                    heapq.heappush(waiting, (-found[0], at, rows, left_depth, *found[1:]))
            return at

        open_node(np.arange(len(y)), depth if depth is not None else 1 << 30)
        grown = 1
        while waiting and (leaves is None or grown < leaves):
            gain, at, rows, left_depth, j, cut = heapq.heappop(waiting)
            self.gain[j] -= gain
            low = x[rows, j] <= cut
            self.nodes[at] = (j, cut, open_node(rows[low], left_depth - 1), open_node(rows[~low], left_depth - 1), self.nodes[at][4])
            grown += 1

    @staticmethod
    def _best(x, y, leaf, n_features, rng, ridge):
        """(gain, feature, cut) of the best split, or None."""
        n = len(y)
        some = rng.choice(x.shape[1], n_features, replace=False) if n_features < x.shape[1] else np.arange(x.shape[1])
        order = np.argsort(x[:, some], axis=0, kind="stable")
        v, t = np.take_along_axis(x[:, some], order, 0), np.cumsum(y[order], axis=0)
        k = np.arange(leaf, n - leaf + 1)[:, None]
        low, total = t[k[:, 0] - 1], t[-1]
        score = low**2 / (k + ridge) + (total - low) ** 2 / np.maximum(n - k + ridge, 1e-12) - total**2 / (n + ridge)
        score[v[k[:, 0] - 1] >= v[np.minimum(k[:, 0], n - 1)]] = -np.inf
        i, c = np.unravel_index(int(score.argmax()), score.shape)
        if not score[i, c] > 1e-12:
            return None
        below, above = float(v[k[i, 0] - 1, c]), float(v[k[i, 0], c])
        middle = (below + above) / 2
        return float(score[i, c]), int(some[c]), middle if middle < above else below

    def predict(self, x: np.ndarray) -> np.ndarray:
        out, todo = np.empty(len(x)), [(0, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            j, cut, a, b, mean = self.nodes[at]
            if j < 0:
                out[rows] = mean
                continue
            left = x[rows, j] <= cut
            todo += [(a, rows[left]), (b, rows[~left])]
        return out

    def shapley(self, x: np.ndarray) -> np.ndarray:
        """Exact Shapley values of each row's prediction, a feature left out being averaged
        over by the training rows of each branch. A leaf's value counts for a set of known
        features as a product over its path: 1 or 0 for a known one, the branches' shares
        for an unknown one. These products are polynomials in the size of the set."""
        out = np.zeros(x.shape)
        todo: list[tuple[int, dict[int, tuple[float, float, float]]]] = [(0, {})]
        while todo:
            at, path = todo.pop()
            j, cut, a, b, value = self.nodes[at]
            if j >= 0:
                low, high, share = path.get(j, (-np.inf, np.inf, 1.0))
                todo.append((a, {**path, j: (low, min(high, cut), share * self.cover[a] / self.cover[at])}))
                todo.append((b, {**path, j: (max(low, cut), high, share * self.cover[b] / self.cover[at])}))
                continue
            d = len(path)
            inside = {f: ((x[:, f] > low) & (x[:, f] <= high)).astype(float) for f, (low, high, _) in path.items()}
            weight = np.array([math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)])
            for f in path:
                poly = np.zeros((d, len(x)))
                poly[0] = 1.0
                for n, other in enumerate(o for o in path if o != f):
                    moved = poly[: n + 1] * inside[other]
                    poly[: n + 1] *= path[other][2]
                    poly[1 : n + 2] += moved
                out[:, f] += value * (inside[f] - path[f][2]) * (weight @ poly)
        return out


class Forest:
    def __init__(self, x, y, trees=60, depth=6, leaf=2, split=2, features=1 / 3, seed=42, **_):
        rng, n = np.random.default_rng(seed), x.shape[1]
        k = {"sqrt": math.isqrt(n), "log2": int(math.log2(max(1, n))), None: n}[features] if features is None or isinstance(features, str) else int(n * features)
        self.trees = []
        for _i in range(trees):
            rows = rng.integers(0, len(y), len(y))
            self.trees.append(Tree(x[rows], y[rows], depth, leaf, min(n, max(1, k)), rng, split=split))

    def predict(self, x):
        return np.mean([t.predict(x) for t in self.trees], 0)

    def shapley(self, x):
        return np.mean([t.shapley(x) for t in self.trees], 0)

    @property
    def importance(self):
        return sum(t.gain for t in self.trees)


class Boosting:
    """Least-squares boosting. The last `held` rows stop it after `stop` rounds without
    gain, where at least 10 others remain."""

    def __init__(self, x, y, trees=80, depth=3, leaf=3, leaves=None, rate=0.1, ridge=0.0, rows=0.8, columns=0.8, seed=42, stop=0, held=0, **_):
        rng, self.rate = np.random.default_rng(seed), rate
        cut = len(y) - held if stop and held and len(y) - held >= 10 else len(y)
        self.start, self.trees = float(y[:cut].mean()), []
        fit, ahead = np.full(cut, self.start), np.full(len(y) - cut, self.start)
        best, since, kept = np.inf, 0, 0
        for i in range(trees):
            some = rng.permutation(cut)[: max(4, int(cut * rows))] if rows < 1 else np.arange(cut)
            tree = Tree(x[some], (y[:cut] - fit)[some], depth, leaf, max(1, int(x.shape[1] * columns)), rng, leaves, ridge=ridge)
            self.trees.append(tree)
            fit = fit + rate * tree.predict(x[:cut])
            if cut < len(y):
                ahead = ahead + rate * tree.predict(x[cut:])
                loss = float(np.mean((y[cut:] - ahead) ** 2))
                best, since, kept = (loss, 0, i + 1) if loss < best else (best, since + 1, kept)
                if since >= stop:
                    break
        if cut < len(y):
            self.trees = self.trees[:kept]

    def predict(self, x):
        return self.start + self.rate * sum((t.predict(x) for t in self.trees), np.zeros(len(x)))

    def shapley(self, x):
        return self.rate * sum((t.shapley(x) for t in self.trees), np.zeros(x.shape))

    @property
    def importance(self):
        return sum((t.gain for t in self.trees), 0.0)


LEARNERS = {"rf": Forest, "lgbm": Boosting}


def shapley_shares(model, x: np.ndarray) -> np.ndarray:
    """Mean absolute Shapley value of each column, as shares of their sum."""
    effect = np.abs(model.shapley(x)).mean(0)
    return effect / effect.sum() if effect.sum() > 0 else effect


def composite_loss(actual: np.ndarray, predicted: np.ndarray, baseline: float, weight: float = 0.0, mode: str = "mom") -> float:
    """MAPE over non-zero actuals plus weight times the share of wrong directions in
    percent (50 where there is none); directions from step to step or from the baseline."""
    if mode not in ("mom", "absolute"):
        raise ValueError(f"mode is 'mom' or 'absolute', not {mode!r}")
    some = actual != 0
    if not some.any():
        return math.inf
    mape = float(np.mean(np.abs((actual[some] - predicted[some]) / actual[some])) * 100)
    if weight == 0:
        return mape
    moves = lambda v: np.sign(np.diff(v, prepend=baseline) if mode == "mom" else v - baseline)
    return mape + weight * float((1 - np.mean(moves(actual) == moves(predicted))) * 100)


def markov_switching(y: np.ndarray, params: dict, steps: int) -> np.ndarray:
    """Autoregression of returns whose constant (and variance) switches: EM over Hamilton's filter."""
    k, p, drift = params.get("regimes", 2), params.get("order", 1), params.get("trend", "c") == "c"
    if (y <= 0).any():
        r, back = np.diff(y), lambda f: y[-1] + np.cumsum(f)
    else:
        r, back = np.diff(np.log(y)), lambda f: y[-1] * np.exp(np.cumsum(f))
    rows = np.arange(p, len(r))
    x = np.column_stack([r[rows - i] for i in range(1, p + 1)])
    t = r[rows]
    beta = np.linalg.lstsq(np.column_stack([np.ones(len(t)), x]), t, rcond=None)[0]
    # without a trend, regimes differ by their variance alone
    const, phi = np.quantile(t - x @ beta[1:], (np.arange(k) + 0.5) / k) * drift, beta[1:]
    var, move = (t.var() + 1e-12) * (np.ones(k) if drift else np.linspace(0.5, 1.5, k)), np.full((k, k), 0.1 / max(1, k - 1)) + np.eye(k) * (0.9 - 0.1 / max(1, k - 1))
    before = -math.inf
    for _ in range(30):
        dens = np.exp(-0.5 * (t[:, None] - const - (x @ phi)[:, None]) ** 2 / var) / np.sqrt(2 * np.pi * var) + 1e-300
        filt, ahead = np.empty((len(t), k)), np.empty((len(t), k))
        state = np.full(k, 1 / k)
        for i in range(len(t)):
            ahead[i] = state @ move
            state = ahead[i] * dens[i]
            state = filt[i] = state / state.sum()
        like = float(np.log((ahead * dens).sum(1)).sum())
        if like - before < 1e-3:
            break
        before = like
        smooth, joint = filt.copy(), np.zeros((k, k))
        for i in range(len(t) - 2, -1, -1):
            pair = filt[i][:, None] * move * (smooth[i + 1] / ahead[i + 1])[None]
            joint += pair
            smooth[i] = pair.sum(1)
        move = joint / np.maximum(joint.sum(1, keepdims=True), 1e-12)
        weight = smooth.sum(0)
        const = (smooth * (t - x @ phi)[:, None]).sum(0) / np.maximum(weight, 1e-9) * drift
        phi = np.linalg.lstsq(x, t - smooth @ const, rcond=None)[0]
        square = (t[:, None] - const - (x @ phi)[:, None]) ** 2
        var = np.maximum((smooth * square).sum(0) / np.maximum(weight, 1e-9) if params.get("switching_variance") else np.full(k, (smooth * square).sum() / len(t)), 1e-10)
    if np.abs(np.roots(np.concatenate([[1.0], -phi]))).max(initial=0) >= 1.05:
        raise ValueError("explosive fit")
    past, out = list(r), []
    for _ in range(steps):
        state = state @ move
        out.append(float(state @ const + phi @ np.array([past[-i] for i in range(1, p + 1)])))
        past.append(out[-1])
    return back(np.array(out))


def garch_variance(e: np.ndarray, steps: int, p: int = 1, q: int = 1) -> np.ndarray:
    """Variance path of GARCH(p, q): p lags of the variance, q of squared residuals,
    with the likeliest of a grid of total weights that are dealt to the lags as 1, 1/2,
    and the long-run variance at the residuals' own. Point forecasts do not use it."""
    total, best = float(np.var(e)) + 1e-12, None
    deal = lambda n: (1 / np.arange(1, n + 1)) / (1 / np.arange(1, n + 1)).sum()
    square, wide = e**2, max(p, q)
    for a, b in itertools.product((0.03, 0.08, 0.15, 0.3), (0.4, 0.6, 0.75, 0.85, 0.92)):
        if a + b >= 0.99:
            continue
        news, memory, h = a * deal(q), b * deal(p), [total] * wide
        seen = [total] * wide + square.tolist()
        for t in range(wide, len(seen)):
            h.append(total * (1 - a - b) + float(news @ seen[t - 1 : t - 1 - q : -1] if t > q else news @ seen[t - 1 :: -1][:q]) + float(memory @ h[-1 : -1 - p : -1]))
        variance = np.array(h[wide:])
        like = float((np.log(variance) + square / variance).sum())
        if best is None or like < best[0]:
            best = (like, news, memory, h, seen, a + b)
    _, news, memory, h, seen, keep = best
    out = []
    for _ in range(steps):
        out.append(total * (1 - keep) + float(news @ seen[-1 : -1 - q : -1]) + float(memory @ h[-1 : -1 - p : -1]))
        h.append(out[-1])
        seen.append(out[-1])
    return np.array(out)


def arima_residuals(y: np.ndarray, params: dict) -> np.ndarray:
    """One-step errors of a (seasonal) ARIMA on the differenced scale."""
    s = params.get("s", 12)
    w, _ = _difference(y, params["d"], params.get("D", 0), s)
    ar, ma = _lags(params["p"], params.get("P", 0), s), _lags(params["q"], params.get("Q", 0), s)
    return fit_arma(w, ar, ma)[1][max([*ar, *ma, 0]) :]


def var_forecast(x: np.ndarray, params: dict, steps: int) -> np.ndarray:
    """Vector autoregression by OLS with a constant; the first column's forecast."""
    p = params.get("lags", 1)
    rows = np.arange(p, len(x))
    z = np.column_stack([np.ones(len(rows)), *(x[rows - i] for i in range(1, p + 1))])
    if len(rows) <= z.shape[1]:
        raise ValueError("too short for this order")
    beta = np.linalg.lstsq(z, x[rows], rcond=None)[0]
    past, top = [*x], 20 * np.abs(x).max(0)
    for _ in range(steps):
        past.append(np.clip(np.concatenate([[1.0], *(past[-i] for i in range(1, p + 1))]) @ beta, -top, top))
    return np.array(past[len(x) :])[:, 0]


def vecm_forecast(x: np.ndarray, params: dict, steps: int) -> np.ndarray:
    """Reduced-rank vector error correction of the Johansen rank; raises at rank 0.
    deterministic: n none, co a constant outside the cointegration relation, ci inside,
    lo and li a linear trend (with a constant) outside and inside."""
    k, kind = params.get("k_ar_diff", 1), params.get("deterministic", "co")
    rank = min(johansen(x, 1)[2], x.shape[1] - 1)
    if rank < 1:
        raise ValueError("no cointegration")
    dx = np.diff(x, axis=0)
    rows = np.arange(k, len(dx))
    clock = lambda t: np.asarray(t, float)[:, None]
    outside = lambda t: np.column_stack([np.zeros((len(t), 0)), *([np.ones(len(t))] if kind in ("co", "lo", "li") else []), *([clock(t)] if kind == "lo" else [])])
    inside = lambda t: np.column_stack([np.zeros((len(t), 0)), *([np.ones(len(t))] if kind == "ci" else []), *([clock(t)] if kind == "li" else [])])
    z = np.column_stack([outside(rows), *(dx[rows - i] for i in range(1, k + 1))])
    if len(rows) <= z.shape[1] + rank:
        raise ValueError("too short for this order")
    level = np.column_stack([x[rows], inside(rows)])
    r0, r1 = (m - z @ np.linalg.lstsq(z, m, rcond=None)[0] for m in (dx[rows], level))
    s00, s11, s01 = r0.T @ r0, r1.T @ r1, r0.T @ r1
    values, vectors = np.linalg.eig(np.linalg.pinv(s11) @ s01.T @ np.linalg.pinv(s00) @ s01)
    beta = np.real(vectors[:, np.argsort(-np.real(values))[:rank]])
    coef = np.linalg.lstsq(np.column_stack([level @ beta, z]), dx[rows], rcond=None)[0]
    past, moves, top = [*x], [*dx], 5 * np.abs(dx).max(0)
    for h in range(steps):
        now = np.array([len(dx) + h])
        step = np.concatenate([np.concatenate([past[-1], inside(now)[0]]) @ beta, outside(now)[0], *(moves[-i] for i in range(1, k + 1))]) @ coef
        moves.append(np.clip(step, -top, top))
        past.append(past[-1] + moves[-1])
    return np.array(past[len(x) :])[:, 0]
