"""Gaps, coverage and validation of bar tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def missing_periods(bars: DataFrame, step: str) -> DataFrame:
    """symbol, ts of periods without a bar between each symbol's first and last one."""
    ends = bars.groupBy("symbol").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    grid = ends.select("symbol", F.explode(F.expr(f"sequence(a, b, interval {step})")).alias("ts"))
    return grid.join(bars.select("symbol", "ts"), ["symbol", "ts"], "left_anti")


def islands(points: DataFrame, seconds: int) -> DataFrame:
    """symbol, start, stop, periods: runs of consecutive points."""
    w = Window.partitionBy("symbol").orderBy("ts")
    run = F.unix_timestamp(F.col("ts").cast("timestamp")) - F.row_number().over(w) * seconds
    return points.withColumn("_run", run).groupBy("symbol", "_run").agg(F.min("ts").alias("start"), F.max("ts").alias("stop"), F.count(F.lit(1)).alias("periods")).drop("_run")


def gaps(bars: DataFrame, seconds: int, tolerance: int = 1) -> DataFrame:
    """symbol, start, stop, missing: between consecutive bars more than tolerance periods apart."""
    w = Window.partitionBy("symbol").orderBy("ts")
    far = bars.select("symbol", "ts", F.lead("ts").over(w).alias("_next"))
    between = F.unix_timestamp(F.col("_next").cast("timestamp")) - F.unix_timestamp(F.col("ts").cast("timestamp"))
    far = far.withColumn("_s", between).where(F.col("_s") > seconds * tolerance)
    step = F.expr(f"interval {seconds} seconds")
    return far.select("symbol", (F.col("ts") + step).alias("start"), (F.col("_next") - step).alias("stop"), (F.floor(F.col("_s") / seconds) - 1).cast("long").alias("missing"))


def coverage(bars: DataFrame, seconds: int) -> DataFrame:
    """symbol, n, expected, coverage (per cent of periods between the first and last bar)."""
    span = F.unix_timestamp(F.max("ts").cast("timestamp")) - F.unix_timestamp(F.min("ts").cast("timestamp"))
    found = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), (F.floor(span / seconds) + 1).cast("long").alias("expected"))
    return found.withColumn("coverage", 100.0 * F.col("n") / F.col("expected"))


def staleness(bars: DataFrame, now, fresh: int = 2, late: int = 10) -> DataFrame:
    """symbol, minutes since the last bar, and fresh, late or stale."""
    age = (F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(F.max("ts").cast("timestamp"))) / 60
    return bars.groupBy("symbol").agg(age.alias("minutes")).withColumn("status", F.when(F.col("minutes") <= fresh, "fresh").when(F.col("minutes") <= late, "late").otherwise("stale"))


def nulls_after_warmup(values: DataFrame, column: str, lookback: int) -> DataFrame:
    """Rows whose column is NULL although the symbol has had `lookback` rows before them."""
    w = Window.partitionBy("symbol").orderBy("ts")
    return values.withColumn("_n", F.row_number().over(w)).where((F.col("_n") > lookback) & F.col(column).isNull()).drop("_n")


def mismatches(stored: DataFrame, computed: DataFrame, column: str, tolerance: float) -> DataFrame:
    """symbol, ts, stored, computed where both are there and differ by more than the tolerance, or one is missing."""
    a = stored.select("symbol", "ts", F.col(column).alias("stored"))
    b = computed.select("symbol", "ts", F.col(column).alias("computed"))
    met = a.join(b, ["symbol", "ts"], "full_outer")
    differs = F.abs(F.col("stored") - F.col("computed")) > tolerance
    return met.where(differs | (F.col("stored").isNull() != F.col("computed").isNull()))


def outside(rows: DataFrame, known: list[tuple[str, str]]) -> DataFrame:
    """Rows whose ts is in none of the known ranges (start, stop), stop exclusive."""
    for start, stop in known:
        rows = rows.where(~((F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(stop).cast("timestamp_ntz"))))
    return rows


def request_plan(ranges: DataFrame, per_request: int, seconds: int) -> DataFrame:
    """symbol, start, stop of the requests that fetch each range (symbol, start, stop), at most per_request periods each."""
    span = per_request * seconds
    begun = ranges.withColumn("_at", F.explode(F.expr(f"sequence(start, stop, interval {span} seconds)")))
    return begun.select("symbol", F.col("_at").alias("start"), F.least("stop", F.col("_at") + F.expr(f"interval {span - seconds} seconds")).alias("stop"))


def days(ranges: DataFrame) -> DataFrame:
    """symbol, start, stop: ranges cut at UTC midnights; each piece ends a second before the next."""
    day = F.col("_day").cast("timestamp_ntz")
    cut = ranges.withColumn("_day", F.explode(F.sequence(F.to_date("start"), F.to_date("stop"))))
    return cut.select("symbol", F.greatest("start", day).alias("start"), F.least("stop", day + F.expr("interval 86399 seconds")).alias("stop"))
