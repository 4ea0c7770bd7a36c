"""Joins that Spark has no operator for: intervals and as-of."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def interval_join(points: DataFrame, spans: DataFrame, key: str, at: str, start: str, stop: str, width: str) -> DataFrame:
    """points with every span of the same key that contains them (start <= at < stop); spans keep their own columns.

    Time is cut into buckets of `width`, spans are repeated for each bucket they touch, and the join is an equi-join on key
    and bucket, so it hashes and can be split where skewed, instead of comparing all with all. Choose the width near the
    usual span.
    """
    last = F.col(stop) - F.expr("interval 1 microsecond")
    laid = spans.where(F.col(start) < F.col(stop)).withColumn("_cell", F.explode(F.sequence(cut_of(start, width), cut_of(last, width), F.expr(f"interval {width}"))))
    celled = points.withColumn("_cell", cut_of(at, width))
    met = celled.join(laid, [key, "_cell"])
    return met.where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(stop))).drop("_cell")


def cut_of(c, width: str):
    """The start of the bucket of a timestamp: whole multiples of the width since the epoch."""
    n, unit = width.split()
    seconds = int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_seconds(F.floor(F.unix_timestamp(c.cast("timestamp")) / seconds) * seconds).cast("timestamp_ntz")


def asof_join(left: DataFrame, right: DataFrame, key: str, ts: str, values: list[str], strict: bool = False) -> DataFrame:
    """left with the values of the latest right row of the same key at or before (strict: before) its time; NULL if none.

    One union and one window (last non-null in order of time), so one shuffle on the key and no pairs.
    """
    struct = F.struct(*values)
    both = left.withColumns({"_right": F.lit(1 if not strict else 0), "_v": F.lit(None).cast(right.select(struct).schema[0].dataType)})
    theirs = right.select(key, ts, *[F.lit(None).cast(t).alias(c) for c, t in left.dtypes if c not in (key, ts)], F.lit(0 if not strict else 1).alias("_right"), struct.alias("_v"))
    mine = both.withColumn("_mine", F.lit(True))
    line = mine.unionByName(theirs.withColumn("_mine", F.lit(False)))
    # At equal times right rows come first (strict: last), so that they are seen (or not).
    w = Window.partitionBy(key).orderBy(ts, "_right").rowsBetween(Window.unboundedPreceding, 0)
    found = line.withColumn("_v", F.last("_v", ignorenulls=True).over(w)).where("_mine")
    return found.select(*left.columns, *[F.col(f"_v.{c}").alias(c) for c in values])
