"""Series that come with derivatives and sentiment: funding, premium, ratios, open interest, sentiment by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def next_funding_time(ts: str | Column) -> Column:
    """The first of 0, 8 and 16 o'clock UTC strictly after ts."""
    return F.window(ts, "8 hours")["end"]


def next_funding(bars: DataFrame, funding: DataFrame) -> DataFrame:
    """Add funding_time_next and funding_rate_next: the rate settled at each bar's next funding time, NULL if unknown.

    funding: symbol, ts (settlement), rate.
    """
    rates = funding.select("symbol", F.col("ts").alias("funding_time_next"), F.col("rate").alias("funding_rate_next"))
    timed = bars.withColumn("_end", next_funding_time("ts")).withColumnRenamed("_end", "funding_time_next")
    return timed.join(rates, ["symbol", "funding_time_next"], "left")


def exact(bars: DataFrame, series: DataFrame, value: str, name: str) -> DataFrame:
    """Add a series' value at exactly each bar's time (premium index, open interest)."""
    return bars.join(series.select("symbol", "ts", F.col(value).alias(name)), ["symbol", "ts"], "left")


def long_short(ratios: DataFrame) -> DataFrame:
    """buy / sell, NULL where sell is not positive."""
    return ratios.withColumn("long_short_ratio", F.when(F.col("sell") > 0, F.try_divide("buy", "sell")))


def by_day(bars: DataFrame, daily: DataFrame, value: str) -> DataFrame:
    """Add a daily value by UTC date. daily has one row a day, so its size is bounded by the calendar and it is broadcast."""
    return bars.withColumn("day", F.to_date("ts")).join(F.broadcast(daily.select("day", value)), "day", "left")


def interpolate_days(daily: DataFrame, value: str) -> DataFrame:
    """Add days missing between two days that are there, one apart, with the mean of both, halves to even."""
    w = Window.partitionBy(F.lit(0)).orderBy("day")
    gaps = daily.select("day", value, F.lead("day").over(w).alias("_next"), F.lead(value).over(w).alias("_v"))
    gaps = gaps.where(F.datediff("_next", "day") == 2)
    new = gaps.select(F.date_add("day", 1).alias("day"), F.bround((F.col(value) + F.col("_v")) / 2).cast(daily.schema[value].dataType).alias(value), F.lit(True).alias("interpolated"))
    return daily.select("day", value, F.lit(False).alias("interpolated")).unionByName(new)


def sentiment_class(value: str | Column) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v <= 25, "Extreme Fear").when(v <= 45, "Fear").when(v <= 55, "Neutral").when(v <= 75, "Greed").when(v.isNotNull(), "Extreme Greed")


def inconsistent_days(frames: dict[str, DataFrame], value: str) -> DataFrame:
    """Days on which a daily value is not one and the same in all timeframes. frames: timeframe -> (ts, value)."""
    union = None
    for name, df in frames.items():
        part = df.select(F.to_date("ts").alias("day"), F.col(value).alias("v"), F.lit(name).alias("timeframe"))
        union = part if union is None else union.unionByName(part)
    found = union.groupBy("day").agg(F.count_distinct("v").alias("values"), F.count_distinct("timeframe").alias("timeframes"))
    return found.where(F.col("values") > 1)
