"""Bars of any timeframe from ticks or finer bars. A bar's timestamp is the start of its period."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNITS = {"m": 1, "h": 60, "d": 1440, "w": 10080}


def minutes(timeframe: str) -> int:
    """Minutes of a timeframe such as 15m, 4h, 1d or 1w."""
    found = re.fullmatch(r"(\d+)([mhdw])", timeframe)
    if not found or not int(found[1]):
        raise ValueError(f"not a timeframe: {timeframe!r}")
    return int(found[1]) * _UNITS[found[2]]


def bucket(ts: str | Column, timeframe: str) -> Column:
    """The start of the period that holds ts; days and shorter periods are aligned to midnight UTC."""
    return F.window(ts, f"{minutes(timeframe)} minutes")["start"]


def from_ticks(ticks: DataFrame, timeframe: str, order: list[str] | None = None) -> DataFrame:
    """ticks: symbol, ts, price, volume. Returns symbol, ts, open, high, low, close, volume, trades; empty periods have no bar.

    order: columns that break ties of ts for open and close. One hash aggregate: a partial bar of each task is merged.
    """
    at = F.struct("ts", *(order or []))
    return ticks.groupBy("symbol", bucket("ts", timeframe).alias("_start")).agg(
        F.min_by("price", at).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", at).alias("close"),
        F.sum("volume").alias("volume"),
        F.count(F.lit(1)).alias("trades"),
    ).withColumnRenamed("_start", "ts")


def resample(bars: DataFrame, timeframe: str) -> DataFrame:
    """Coarser bars from finer ones: first open, highest high, lowest low, last close, summed volume."""
    return bars.groupBy("symbol", bucket("ts", timeframe).alias("_start")).agg(
        F.min_by("open", "ts").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "ts").alias("close"),
        F.sum("volume").alias("volume"),
    ).withColumnRenamed("_start", "ts")


def complete(bars: DataFrame, timeframe: str, now: Column) -> DataFrame:
    """Bars whose period has ended by `now`; the one still forming is left out."""
    return bars.where(F.col("ts") + F.expr(f"interval {minutes(timeframe)} minutes") <= now)


def valid(candles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candles that pass the checks (all fields, prices over 0, high at least low, volume not negative), and the others."""
    fields = ["symbol", "ts", "open", "high", "low", "close", "volume"]
    good = F.lit(True)
    for c in fields:
        good = good & F.col(c).isNotNull()
    for c in ("open", "high", "low", "close"):
        good = good & (F.col(c) > 0)
    good = F.coalesce(good & (F.col("high") >= F.col("low")) & (F.col("volume") >= 0), F.lit(False))
    return candles.where(good), candles.where(~good)
