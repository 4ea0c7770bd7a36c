"""Indicators with ordered state, as grouped Arrow kernels: a symbol's bars are one group.

A group's size is bounded by the calendar, not by the data: ten years of one-minute bars are 5 million rows. All periods of
an indicator are computed in one pass over a group, and only the columns needed are sent.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Columns = dict[str, np.ndarray]


def grouped(bars: DataFrame, inputs: list[str], outputs: dict[str, str], compute: Callable[[Columns], Columns], key: str = "symbol", ts: str = "ts") -> DataFrame:
    """key, ts, inputs and outputs: `compute` gets a group's inputs in order of ts and returns its outputs (NaN means NULL)."""
    from tickloom.sources.session import python_ready

    python_ready(bars.sparkSession)
    slim = bars.select(key, ts, *inputs)
    kinds = dict(slim.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in slim.columns] + [f"`{c}` {k}" for c, k in outputs.items()])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(ts)
        found = compute({c: table.column(c).to_numpy(zero_copy_only=False) for c in inputs})
        for c, kind in outputs.items():
            values = found[c]
            arrow = pa.float64() if kind == "double" else pa.int16() if kind == "short" else pa.int64()
            table = table.append_column(c, pa.array(values, arrow, from_pandas=True))
        return table

    return slim.groupBy(key).applyInArrow(run, schema)


def ewm(x: np.ndarray, alpha: float) -> np.ndarray:
    """y[0] = x[0], y[i] = alpha x[i] + (1 - alpha) y[i - 1]."""
    return pd.Series(x).ewm(alpha=alpha, adjust=False).mean().to_numpy()


def ema(x: np.ndarray, p: int, masked: bool = True) -> np.ndarray:
    """Seeded by the first value; masked: NULL until p rows."""
    y = ewm(x, 2 / (p + 1)).copy()
    if masked:
        y[: p - 1] = np.nan
    return y


def wilder(x: np.ndarray, p: int) -> np.ndarray:
    """Mean of the first p (without NaN) at row p - 1, then (before * (p - 1) + x) / p. A later NaN makes all after it NaN."""
    out = np.full(len(x), np.nan)
    if len(x) < p:
        return out
    head = x[:p][~np.isnan(x[:p])]
    if not len(head):
        return out
    tail = x[p:]
    bad = np.flatnonzero(np.isnan(tail))
    n = bad[0] if len(bad) else len(tail)
    out[p - 1 : p + n] = ewm(np.concatenate([[head.mean()], tail[:n]]), 1 / p)
    return out


def rsi(close: np.ndarray, p: int) -> np.ndarray:
    """Wilder's; the first value is on 0-based row p + 1; 100 where there are no losses."""
    out = np.full(len(close), np.nan)
    delta = np.diff(close)
    if len(delta) <= p:
        return out
    gain, loss = np.maximum(delta, 0), np.maximum(-delta, 0)
    g = ewm(np.concatenate([[gain[:p].mean()], gain[p:]]), 1 / p)[1:]
    l = ewm(np.concatenate([[loss[:p].mean()], loss[p:]]), 1 / p)[1:]  # noqa: E741
    out[p + 1 :] = np.where(l == 0, 100.0, 100 - 100 / (1 + g / np.where(l == 0, 1, l)))
    return out


def tr(high: np.ndarray, low: np.ndarray, close: np.ndarray) -> np.ndarray:
    before = np.concatenate([[np.nan], close[:-1]])
    return np.fmax(high - low, np.fmax(np.abs(high - before), np.abs(low - before)))


def adx(high: np.ndarray, low: np.ndarray, close: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ADX, +DI, -DI. DX is NaN where both DI are 0, and then so is every later ADX; ADX starts on row p - 1 as DX."""
    up, down = np.diff(high, prepend=high[:1]), -np.diff(low, prepend=low[:1])
    plus, minus = np.where((up > down) & (up > 0), up, 0.0), np.where((down > up) & (down > 0), down, 0.0)
    t = wilder(tr(high, low, close), p)
    with np.errstate(divide="ignore", invalid="ignore"):
        pdi, mdi = 100 * wilder(plus, p) / t, 100 * wilder(minus, p) / t
        dx = np.where(pdi + mdi > 0, 100 * np.abs(pdi - mdi) / (pdi + mdi), np.nan)
    return wilder(dx, p), pdi, mdi


def supertrend(high: np.ndarray, low: np.ndarray, close: np.ndarray, p: int, k: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Line, direction (0 in the warm-up), upper and lower final band."""
    n = len(close)
    line, upper, lower, way = np.full(n, np.nan), np.full(n, np.nan), np.full(n, np.nan), np.zeros(n, np.int16)
    if n < p:
        return line, way, upper, lower
    half = k * wilder(tr(high, low, close), p)
    mid = (high + low) / 2
    ub, lb, c = (mid + half).tolist(), (mid - half).tolist(), close.tolist()
    u, v, d = ub[p - 1], lb[p - 1], -1 if c[p - 1] <= ub[p - 1] else 1
    for i in range(p - 1, n):
        if i >= p:
            u = ub[i] if ub[i] < u or c[i - 1] > u else u
            v = lb[i] if lb[i] > v or c[i - 1] < v else v
            d = (1 if c[i] > u else -1) if d == -1 else (-1 if c[i] < v else 1)
        upper[i], lower[i], way[i], line[i] = u, v, d, v if d == 1 else u
    return line, way, upper, lower


def rolling_rank(x: np.ndarray, length: int) -> np.ndarray:
    """Per cent of the previous `length` values below each value; a sorted window is kept, so a row costs log(length)."""
    out, held = np.full(len(x), np.nan), []
    for i, v in enumerate(x.tolist()):
        if i >= length and v == v:
            out[i] = 100.0 * bisect_left(held, v) / len(held) if held else np.nan
        if v == v:
            insort(held, v)
        if i >= length and (old := float(x[i - length])) == old:
            del held[bisect_left(held, old)]
    return out


def rank_in_window(x: np.ndarray, length: int, least: int) -> np.ndarray:
    """Per cent of the last `length` values, this one included, below each value; NULL under `least` values or with a NULL.

    Blocks of rows are compared with their windows at once, so memory is a block times a window.
    """
    out = np.full(len(x), np.nan)
    padded = np.concatenate([np.full(length - 1, np.inf), x])
    seen = np.minimum(np.arange(1, len(x) + 1), length)
    bad = np.convolve(np.isnan(x), np.ones(length))[: len(x)] > 0.5 if len(x) else np.zeros(0, bool)
    for at in range(0, len(x), 1024):
        stop = min(at + 1024, len(x))
        windows = np.lib.stride_tricks.sliding_window_view(padded[at : stop + length - 1], length)
        out[at:stop] = 100.0 * (windows < x[at:stop, None]).sum(1) / seen[at:stop]
    out[(seen < least) | bad] = np.nan
    return out


def add_rank(bars: DataFrame, c: str, windows: dict[str, tuple[int, int]]) -> DataFrame:
    """Columns by name of (length, least): the percentile of c in a window that ends with the row."""
    return grouped(bars, [c], {n: "double" for n in windows}, lambda v: {n: rank_in_window(v[c].astype(float), *w) for n, w in windows.items()})


def add_ema(bars: DataFrame, periods: list[int], of: str = "close") -> DataFrame:
    return grouped(bars, [of], {f"ema_{p}": "double" for p in periods}, lambda c: {f"ema_{p}": ema(c[of], p) for p in periods})


def resume_ema(bars: DataFrame, state: DataFrame, period: int) -> DataFrame:
    """bars after a checkpoint continue the stored value: state has symbol and ema. New symbols start with their first price."""
    met = bars.join(state.select("symbol", F.col("ema").alias("_e")), "symbol", "left")

    def run(c: Columns) -> Columns:
        first = c["_e"][0] if len(c["_e"]) and not np.isnan(np.float64(c["_e"][0] if c["_e"][0] is not None else np.nan)) else None
        x = c["close"]
        return {f"ema_{period}": ewm(x, 2 / (period + 1)) if first is None else ewm(np.concatenate([[first], x]), 2 / (period + 1))[1:]}

    return grouped(met, ["close", "_e"], {f"ema_{period}": "double"}, run).drop("_e")


def add_macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    name = f"macd_{fast}_{slow}_{signal}"

    def run(c: Columns) -> Columns:
        line = ema(c["close"], fast, False) - ema(c["close"], slow, False)
        sig = ema(line, signal, False)
        return {f"{name}_line": line, f"{name}_signal": sig, f"{name}_histogram": line - sig}

    return grouped(bars, ["close"], {f"{name}_{x}": "double" for x in ("line", "signal", "histogram")}, run)


def add_rsi(bars: DataFrame, periods: list[int]) -> DataFrame:
    return grouped(bars, ["close"], {f"rsi_{p}": "double" for p in periods}, lambda c: {f"rsi_{p}": rsi(c["close"], p) for p in periods})


def add_atr(bars: DataFrame, periods: list[int]) -> DataFrame:
    """ATR and NATR (per cent of the close; NULL where the close is not positive)."""

    def run(c: Columns) -> Columns:
        t = tr(c["high"], c["low"], c["close"])
        out = {f"atr_{p}": wilder(t, p) for p in periods}
        with np.errstate(divide="ignore", invalid="ignore"):
            return out | {f"natr_{p}": np.where(c["close"] > 0, out[f"atr_{p}"] / c["close"] * 100, np.nan) for p in periods}

    return grouped(bars, ["high", "low", "close"], {f"{n}_{p}": "double" for p in periods for n in ("atr", "natr")}, run)


def add_adx(bars: DataFrame, periods: list[int]) -> DataFrame:
    def run(c: Columns) -> Columns:
        out = {}
        for p in periods:
            out[f"adx_{p}"], out[f"adx_{p}_plus_di"], out[f"adx_{p}_minus_di"] = adx(c["high"], c["low"], c["close"], p)
        return out

    return grouped(bars, ["high", "low", "close"], {f"adx_{p}{x}": "double" for p in periods for x in ("", "_plus_di", "_minus_di")}, run)


def add_supertrend(bars: DataFrame, configs: list[tuple[int, float]]) -> DataFrame:
    name = lambda p, k: f"supertrend_p{p}_m{int(k * 10)}"

    def run(c: Columns) -> Columns:
        out = {}
        for p, k in configs:
            n = name(p, k)
            out[n], out[f"{n}_dir"], out[f"{n}_upper"], out[f"{n}_lower"] = supertrend(c["high"], c["low"], c["close"], p, k)
        return out

    kinds = {f"{name(p, k)}{x}": "short" if x == "_dir" else "double" for p, k in configs for x in ("", "_dir", "_upper", "_lower")}
    return grouped(bars, ["high", "low", "close"], kinds, run)


def add_percentile(bars: DataFrame, c: str, length: int, name: str) -> DataFrame:
    return grouped(bars, [c], {name: "double"}, lambda x: {name: rolling_rank(x[c].astype(float), length)})
