"""Recursive indicators against plain loops and hand-computed values."""

import math

import numpy as np
import pytest

from tickloom.operators import kernels as K


def walk(n=250, seed=42):
    rng = np.random.default_rng(seed)
    return np.maximum(43000 + np.cumsum(rng.normal(0, 500, n)), 1000)


def candles(n=120):
    c = walk(n)
    rng = np.random.default_rng(1)
    return c + rng.uniform(0, 300, n), c - rng.uniform(0, 300, n), c


def test_ema_is_seeded_by_the_first_price():
    x, e = walk(), None
    out = K.ema(x, 12)
    for i, v in enumerate(x):
        e = v if e is None else 2 / 13 * v + (1 - 2 / 13) * e
        assert math.isnan(out[i]) if i < 11 else out[i] == pytest.approx(e, rel=1e-12)


@pytest.mark.parametrize("p", [7, 14])
def test_rsi_loop(p):
    x = walk()
    d = np.diff(x)
    g, l = np.maximum(d, 0)[:p].mean(), np.maximum(-d, 0)[:p].mean()  # noqa: E741
    out = K.rsi(x, p)
    assert np.isnan(out[: p + 1]).all()
    for i in range(p, len(d)):
        g, l = (g * (p - 1) + max(d[i], 0)) / p, (l * (p - 1) + max(-d[i], 0)) / p  # noqa: E741
        assert out[i + 1] == pytest.approx(100 - 100 / (1 + g / l), rel=1e-9)
    assert ((out[p + 1 :] >= 0) & (out[p + 1 :] <= 100)).all()


def test_rsi_edges():
    assert np.isnan(K.rsi(walk(8), 7)).all()  # n = p + 1
    up = K.rsi(np.arange(1.0, 40), 7)
    assert (up[8:] == 100).all()
    assert (K.rsi(np.full(30, 100.0), 7)[8:] == 100).all()


def test_atr_and_short_series():
    h, l, c = candles()  # noqa: E741
    t = K.tr(h, l, c)
    assert t[0] == h[0] - l[0]
    out, a = K.wilder(t, 14), t[:14].mean()
    assert np.isnan(out[:13]).all() and out[13] == pytest.approx(a)
    for i in range(14, len(t)):
        a = (a * 13 + t[i]) / 14
        assert out[i] == pytest.approx(a, rel=1e-12)
    assert np.isnan(K.wilder(t[:13], 14)).all()


def test_adx_starts_as_dx_and_flat_input_poisons():
    h, l, c = candles()  # noqa: E741
    a, p, m = K.adx(h, l, c, 14)
    assert np.isnan(a[:13]).all()
    assert a[13] == pytest.approx(100 * abs(p[13] - m[13]) / (p[13] + m[13]))
    flat = np.full(60, 100.0)
    assert np.isnan(K.adx(flat + 1, flat - 1, flat, 14)[0]).all()


def test_supertrend_warm_up_and_loop():
    h, l, c = candles()  # noqa: E741
    line, way, upper, lower = K.supertrend(h, l, c, 10, 3.0)
    assert (way[:9] == 0).all() and np.isnan(line[:9]).all() and np.isnan(upper[:9]).all()
    assert set(way[9:]) <= {1, -1}
    assert np.array_equal(line[9:], np.where(way[9:] == 1, lower[9:], upper[9:]))


def test_rank_excludes_the_current_row():
    x = np.array([3.0, 1.0, 2.0, 2.5, 0.5, np.nan, 9.0])
    out = K.rolling_rank(x, 3)
    assert np.isnan(out[:3]).all() and np.isnan(out[5])
    assert out[3] == pytest.approx(100 * 2 / 3) and out[4] == 0 and out[6] == 100


def test_grouped_map_keeps_groups_apart(spark):
    rows = [("a", float(i), float(i)) for i in range(20)] + [("b", float(i), 5.0) for i in range(20)]
    df = spark.createDataFrame(rows, "symbol string, t double, close double").selectExpr("symbol", "timestamp_seconds(t * 60) as ts", "close")
    got = {(r.symbol, r.ts.minute): r.ema_5 for r in K.add_ema(df, [5]).collect()}
    assert got["b", 10] == 5.0 and got["a", 3] is None and got["a", 10] is not None
