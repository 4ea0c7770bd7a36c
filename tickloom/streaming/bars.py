"""Structured Streaming: bars of a tick stream, the last state of each instrument, refills, upserting sinks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.operators.bars import minutes
from tickloom.sources.session import python_ready


def stream_bars(ticks: DataFrame, timeframe: str, late: str = "2 minutes") -> DataFrame:
    """Bars of a stream of (symbol, ts, price, volume); a bar is final when the watermark passes its end.

    ts is a timestamp. Ticks that come later than `late` are dropped from the stream; a batch refill repairs their bars.
    """
    at = F.struct("ts", "volume")
    return (
        ticks.withWatermark("ts", late)
        .groupBy("symbol", F.window("ts", f"{minutes(timeframe)} minutes").alias("w"))
        .agg(F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("trades"))
        .select("symbol", F.col("w.start").alias("ts"), "open", "high", "low", "close", "volume", "trades")
    )


def active_snapshots(messages: DataFrame, every: str, value: Column, late: str = "2 minutes") -> DataFrame:
    """The last message of each instrument in each period, stamped with its start: only instruments active in the period."""
    newest = F.max_by(value, "ts")
    windowed = messages.withWatermark("ts", late).groupBy("instrument", F.window("ts", every).alias("w"))
    return windowed.agg(newest.alias("value")).select("instrument", F.col("w.start").alias("ts"), "value")


class CarryForward(StatefulProcessor):
    """The last value of each instrument, returned at every period end until the instrument is removed.

    Input rows: instrument, ts, value, removed (boolean). Output: instrument, ts (period start), value. State is one row an
    instrument; a message emits the period ends since the one before, and a timer those that the watermark passes, so quiet
    instruments are carried forward. A message older than the state of its instrument changes nothing.
    """

    def __init__(self, period_ms: int):
        self.period = period_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "ts long, value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        at, value = self.last.get() if self.last.exists() else (-1, None)
        ends: list[tuple[int, float]] = []
        new = sorted((int(ts.timestamp() * 1000), v, bool(gone)) for part in rows for ts, v, gone in zip(part["ts"], part["value"], part["removed"], strict=True))
        for ms, v, gone in new:
            if at >= 0:  # period ends between the last message and this one still have the last value
                ends += [(end, value) for end in range((at // self.period + 1) * self.period, ms + 1, self.period)]
            if ms >= at:
                at, value = (-1, None) if gone else (ms, v)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if at < 0:
            self.last.clear()
        else:
            self.last.update((at, value))
            self.handle.registerTimer((at // self.period + 1) * self.period)
        yield self._rows(key, ends)

    def _rows(self, key, ends: list[tuple[int, float]]) -> pd.DataFrame:
        starts = pd.to_datetime(pd.Series([end - self.period for end, _ in ends], dtype="int64"), unit="ms")
        return pd.DataFrame({"instrument": pd.Series([key[0]] * len(ends), dtype="str"), "ts": starts.astype("datetime64[us]"), "value": pd.Series([v for _, v in ends], dtype="float64")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        if self.last.exists():
            _, value = self.last.get()
            self.last.update((end, value))
            self.handle.registerTimer(end + self.period)
            yield self._rows(key, [(end, value)])

    def close(self) -> None:
        pass


def carried_snapshots(messages: DataFrame, period_ms: int, late: str = "2 minutes") -> DataFrame:
    """Snapshots of all known instruments at every period end, in event time (see CarryForward). Needs the RocksDB store."""
    python_ready(messages.sparkSession)
    stream = messages.withWatermark("ts", late).groupBy("instrument")
    return stream.transformWithStateInPandas(CarryForward(period_ms), "instrument string, ts timestamp, value double", "append", "eventTime")


def write_bars(bars: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Append final bars to Parquet by symbol; with available_now the query takes what is there and ends."""
    writer = bars.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("symbol").outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def upsert_batches(rows: DataFrame, merge, checkpoint: str):
    """Give every micro-batch to merge(batch, epoch): an idempotent upsert makes the sink exactly-once."""
    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start()
