"""Numpy kernels on series with known answers."""

import itertools
import math

import numpy as np
import pytest

from tidecast.functions import kernels as K
from tidecast.operators.engines import TECHNIQUES, History, Technique, fit_forecast, held_out_rows, register
from tidecast.plans.spaces import SPACES, trials, valid, whole_space


@pytest.fixture(scope="module")
def y():
    t = np.arange(90)
    return 2000 + 5 * t + 100 * np.sin(2 * np.pi * t / 12) + np.random.default_rng(1).normal(0, 20, 90)


TRUTH = 2000 + 5 * (90 + np.arange(18)) + 100 * np.sin(2 * np.pi * (90 + np.arange(18)) / 12)
MONTHS = np.arange(90) % 12 + 1
YEARS = 2000 + np.arange(90) // 12


@pytest.mark.parametrize("technique", sorted(TECHNIQUES))
def test_every_technique_forecasts(y, technique):
    rng = np.random.default_rng(2)
    walk = np.column_stack([y * 0.5 + rng.normal(0, 5, 90), np.sin(2 * np.pi * np.arange(90) / 12)])
    params = trials(technique, 1)[0]
    params |= {"trees": 15, "rate": 0.2, "leaves": 8, "depth": 4} if "trees" in params else {}
    steps = 3 if technique.startswith(("rf", "lgbm")) else 18
    f = fit_forecast(technique, params, History(y, YEARS, MONTHS, walk), steps)
    assert f.shape == (steps,) and np.isfinite(f).all() and np.abs(f / TRUTH[:steps] - 1).mean() < 0.2


def test_seasonal_fits_are_close(y):
    for f in (K.ets(y, {"trend": "add", "seasonal": "add"}, 18), K.arima(y, {"p": 1, "d": 0, "q": 0, "P": 1, "D": 1, "Q": 0, "s": 12}, 18)):
        assert np.abs(f / TRUTH - 1).mean() < 0.02


def test_unit_root_tests():
    rng = np.random.default_rng(4)
    walk, noise = rng.normal(size=300).cumsum(), rng.normal(size=300)
    assert K.adf(walk)[1] > 0.05 > K.adf(noise)[1]
    assert K.kpss(noise)[1] > 0.05 > K.kpss(np.arange(300.0) + noise)[1]
    lead = np.r_[0.0, walk[:-1]] * 0.8 + rng.normal(0, 0.3, 300)
    assert K.granger(lead, walk)[1] < 1e-6 and K.granger(walk, lead)[1] > 0.01
    assert K.johansen(np.column_stack([walk, walk * 0.5 + noise * 0.1]))[2] >= 1


def test_f_distribution_table_values():
    for f, k, n in ((4.171, 1, 30), (3.316, 2, 30), (2.534, 5, 30)):
        assert abs(K.f_tail(f, k, n) - 0.05) < 2e-4


def test_spline_and_decomposition(y):
    v = np.sin(np.arange(20) / 3)
    holed = v.copy()
    holed[[5, 6, 12]] = np.nan
    assert np.abs(K.natural_spline(holed) - v).max() < 0.02
    parts = K.decompose(y)
    assert np.allclose(sum(parts.values()), y) and K.strength(parts["seasonal"], parts["resid"]) > 0.8


def test_trees_find_the_signal():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 4))
    t = 3 * x[:, 1] + rng.normal(0, 0.1, 120)
    for model in (K.Forest(x, t, 20), K.Boosting(x, t, 30, stop=10, held=10)):
        assert model.importance.argmax() == 1 and np.corrcoef(model.predict(x), t)[0, 1] > 0.9
        assert K.shapley_shares(model, x).argmax() == 1


def known_value(tree, row, known, at=0):
    """A tree's mean over training rows that share the known features of a row."""
    j, cut, a, b, value = tree.nodes[at]
    if j < 0:
        return value
    if j in known:
        return known_value(tree, row, known, a if row[j] <= cut else b)
    return (tree.cover[a] * known_value(tree, row, known, a) + tree.cover[b] * known_value(tree, row, known, b)) / tree.cover[at]


def test_shapley_values_match_all_subsets():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 5))
    y = 2 * x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=60) * 0.1
    tree = K.Tree(x, y, 4, 2, 5, rng)
    got = tree.shapley(x[:5])
    for r, f in itertools.product(range(5), range(5)):
        rest = [g for g in range(5) if g != f]
        want = sum(math.factorial(k) * math.factorial(4 - k) / math.factorial(5) * (known_value(tree, x[r], {*s, f}) - known_value(tree, x[r], set(s))) for k in range(5) for s in itertools.combinations(rest, k))
        assert abs(got[r, f] - want) < 1e-9
    for model in (K.Forest(x, y, 20), K.Boosting(x, y, 20)):
        spread = model.shapley(x).sum(1) - model.predict(x)
        assert np.ptp(spread) < 1e-9


def test_trees_keep_their_limits():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(80, 3)), rng.normal(size=80)
    tree = K.Tree(x, y, None, 4, 3, rng, leaves=5)
    leaves = [c for (j, *_), c in zip(tree.nodes, tree.cover) if j < 0]
    assert len(leaves) == 5 and min(leaves) >= 4 and sum(leaves) == 80
    assert abs(K.Tree(x, y, 0, 1, 3, rng, ridge=20.0).predict(x)[0] - y.sum() / 100) < 1e-12


def test_spaces_hold_valid_sets():
    sizes = {t: len(whole_space(t)) for t in SPACES if whole_space(t) is not None}
    assert sizes["sarima"] == 276 and sizes["ets"] == 30 and sizes["markov_switching"] == 32 and sizes["vecm"] == 30
    for t, (_, n) in SPACES.items():
        sets = trials(t)
        assert sets == trials(t) and all(map(valid, sets)) and len({str(s) for s in sets}) == len(sets) == min(n, sizes.get(t, n))


def test_composite_loss():
    a, p = np.array([10.0, 12.0, 0.0]), np.array([11.0, 11.0, 1.0])
    assert abs(K.composite_loss(a, p, 9.0) - np.mean([10, 100 / 12])) < 1e-9
    assert abs(K.composite_loss(a, p, 9.0, 0.5, "mom") - np.mean([10, 100 / 12]) - 0.5 * 100 / 3) < 1e-9
    assert K.composite_loss(a, p, 9.0, 0.5, "absolute") == K.composite_loss(a, p, 9.0)
    assert K.composite_loss(np.zeros(2), a[:2], 1.0) == math.inf
    with pytest.raises(ValueError):
        K.composite_loss(a, p, 1.0, 1.0, "other")


def test_garch_variance_follows_the_shocks():
    rng = np.random.default_rng(3)
    calm = rng.normal(0, 1, 300)
    shaken = np.concatenate([calm, rng.normal(0, 6, 15)])
    for p, q in itertools.product((1, 2), (1, 2)):
        v = K.garch_variance(shaken, 12, p, q)
        assert v.shape == (12,) and (v > 0).all() and v[0] > v[-1] > np.var(shaken) * 0.5


def test_stepwise_orders():
    rng = np.random.default_rng(4)
    walk = np.cumsum(rng.normal(size=200))
    assert K.stepwise_order(walk)["d"] >= 1 and K.stepwise_order(walk[:10]) == {"p": 1, "d": 1, "q": 1}
    ar = np.zeros(300)
    for t in range(2, 300):
        ar[t] = 0.6 * ar[t - 1] + 0.3 * ar[t - 2] + rng.normal()
    assert K.stepwise_order(ar)["p"] >= 1


def test_quarterly_histories(y):
    months, years = np.arange(60) % 4 * 3 + 1, 2000 + np.arange(60) // 4
    t = np.arange(78)
    truth = 500 + 2 * t + 40 * np.sin(2 * np.pi * t / 4)
    h = History(truth[:60], years, months, np.zeros((60, 0)), "quarterly")
    assert h.season == 4 and h.when(1) == (2015, 1) and h.when(6) == (2016, 4)
    for technique, params in (("ets", {"trend": "add", "seasonal": "add"}), ("sarima", {"p": 1, "d": 0, "q": 0, "P": 1, "D": 1, "Q": 0}), ("rf", {"trees": 20})):
        f = fit_forecast(technique, params, h, 6)
        assert np.abs(f / truth[60:66] - 1).mean() < 0.15, technique
    assert held_out_rows("lgbm", h, trials("lgbm", 1)[0] | {"trees": 20}, 3) < 60


def test_registered_techniques(y):
    register("mean_of_all", Technique(lambda h, params, steps: np.full(steps, h.y.mean()), 5))
    try:
        h = History(y, YEARS, MONTHS, np.zeros((90, 0)))
        assert fit_forecast("mean_of_all", {}, h, 3).tolist() == [y.mean()] * 3
        with pytest.raises(ValueError):
            fit_forecast("mean_of_all", {}, h.first(3), 3)
        with pytest.raises(ValueError):
            fit_forecast("none such", {}, h, 3)
    finally:
        TECHNIQUES.pop("mean_of_all")


def test_stl_finds_trend_and_season(y):
    parts = K.decompose(y)
    t = np.arange(90)
    assert np.allclose(parts["trend"] + parts["seasonal"] + parts["resid"], y)
    assert np.abs(parts["trend"] - (2000 + 5 * t)).max() < 40
    assert np.abs(parts["seasonal"] - 100 * np.sin(2 * np.pi * t / 12)).max() < 45
    spoilt = y.copy()
    spoilt[40] += 2000
    again = K.decompose(spoilt)
    assert abs(again["resid"][40]) > 1700 and np.abs(again["trend"] - parts["trend"]).max() < 60
    line = K.loess(t.astype(float), 3.0 * t + 1, t.astype(float), 15)
    assert np.allclose(line, 3 * t + 1)
