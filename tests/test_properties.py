"""Property tests of the pieces the one-pass tuning relies on."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lumenreg import config as C
from lumenreg.operators import ridge as R


def _moments(x: np.ndarray) -> R.Moments:
    n = float(len(x))
    mean = x.mean(axis=0)
    centred = x - mean
    return R.Moments(n, mean, centred.T @ centred)


@settings(max_examples=60, deadline=None)
@given(st.integers(min_value=2, max_value=60), st.integers(min_value=1, max_value=6),
       st.integers(min_value=0, max_value=10_000))
def test_merge_of_any_grouping_equals_whole(n, groups, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(loc=rng.uniform(-1e3, 1e3, 4), scale=rng.uniform(0.1, 50, 4), size=(n, 4))
    labels = rng.integers(0, groups, n)
    parts = [_moments(x[labels == g]) for g in range(groups) if (labels == g).any()]
    merged = R.Moments.combine(parts)
    whole = _moments(x)
    assert merged.n == whole.n
    np.testing.assert_allclose(merged.mean, whole.mean, rtol=1e-10, atol=1e-9)
    np.testing.assert_allclose(merged.comom, whole.comom, rtol=1e-8, atol=1e-6)


@settings(max_examples=40, deadline=None)
@given(st.integers(min_value=0, max_value=10_000), st.floats(min_value=0.0, max_value=5.0))
def test_ridge_solution_satisfies_normal_equations(seed, reg):
    rng = np.random.default_rng(seed)
    n, p = 80, 3
    x = rng.normal(size=(n, p)) * rng.uniform(0.5, 20, p) + rng.uniform(-50, 50, p)
    y = x @ rng.normal(size=p) + rng.normal(scale=3.0, size=n) + 7.0
    m = _moments(np.column_stack([x, y]))
    fit = R.fit_ridge(m, reg, features=["a", "b", "c"])
    # standardised objective gradient is zero at the solution
    sd = np.sqrt(np.diag(m.comom) / n)
    xs = (x - x.mean(axis=0)) / sd[:p]
    ys = (y - y.mean()) / sd[p]
    w = fit.coefficients * sd[:p] / sd[p]
    grad = xs.T @ (xs @ w - ys) / n + (reg / sd[p]) * w
    np.testing.assert_allclose(grad, 0.0, atol=1e-8)
    expected = y.mean() - fit.coefficients @ x.mean(axis=0)
    assert abs(fit.intercept - expected) <= 1e-9 * max(1.0, abs(expected))


def test_group_sse_matches_direct_residuals():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 3)) * 10 + 100
    y = x @ np.array([1.5, -2.0, 0.3]) + rng.normal(size=50)
    m = _moments(np.column_stack([x, y]))
    fit = R.RidgeFit(np.array([1.4, -1.9, 0.35]), 2.5, ["a", "b", "c"])
    direct = float(((y - (fit.intercept + x @ fit.coefficients)) ** 2).sum())
    assert abs(R.group_sse(m, fit) - direct) < 1e-7 * direct


def test_view_names_are_distinct_per_workflow():
    assert len(set(C.VIEW_NAMES.values())) == len(C.VIEW_NAMES)
