"""Scans: Parquet and JDBC tables by key and time, zipped archives, paged services, configuration."""

from __future__ import annotations

import datetime as dt
import io
import json
import re
import time
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def scan(spark: SparkSession, path: str, symbols: list[str] | None = None, start: str | None = None, stop: str | None = None, inclusive: bool = False) -> DataFrame:
    """Parquet rows of some symbols in [start, stop) or [start, stop]; the filters reach the scan."""
    df = spark.read.parquet(path)
    kind = df.schema["ts"].dataType
    if symbols is not None:
        df = df.where(F.col("symbol").isin(*symbols))
    if start is not None:
        df = df.where(F.col("ts") >= F.lit(start).cast(kind))
    if stop is not None:
        end = F.lit(stop).cast(kind)
        df = df.where(F.col("ts") <= end if inclusive else F.col("ts") < end)
    return df


def jdbc(spark: SparkSession, url: str, table: str, options: dict[str, str], column: str, bounds: tuple[str, str], partitions: int) -> DataFrame:
    """A table over JDBC, read in parallel by ranges of a column. Credentials come with the options, from the caller."""
    split = {"partitionColumn": column, "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": str(partitions)}
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options, **split).load()


def _unzipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
            with zipfile.ZipFile(io.BytesIO(content)) as z, z.open(z.namelist()[0]) as f:
                lines: list[str] = []
                for line in io.TextIOWrapper(f, "utf-8", "replace"):
                    lines.append(line.rstrip("\r\n"))
                    if len(lines) == 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array([path] * len(lines)), pa.array(lines)], ["path", "value"])
                        lines = []
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(lines), pa.string()), pa.array(lines, pa.string())], ["path", "value"])


def zipped_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, value: the lines of the inner file of each zip archive, streamed; one archive is one row of a partition."""
    from tickloom.sources.session import python_ready

    python_ready(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")
    return files.mapInArrow(_unzipped, "path string, value string")


def book_messages(spark: SparkSession, path: str, symbol: str) -> DataFrame:
    """Messages of zipped JSON lines {ts, type, data: {b, a}} for book.replay; broken lines and lines without ts are skipped."""
    shape = "ts long, type string, data struct<b: array<array<string>>, a: array<array<string>>>"
    rows = zipped_lines(spark, path).select(F.from_json("value", shape).alias("m"), F.monotonically_increasing_id().alias("seq"))
    side = lambda c: F.expr(f"transform(m.data.{c}, x -> struct(try_cast(x[0] as double) as p, try_cast(x[1] as double) as v))")
    rows = rows.where("m.ts is not null").select(F.lit(symbol).alias("symbol"), F.timestamp_millis("m.ts").cast("timestamp_ntz").alias("ts"), "seq", "m.type", side("b").alias("b"), side("a").alias("a"))
    return rows


def zipped_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Typed rows of zipped CSV files with a header; lines that do not fit the schema are dropped."""
    lines = zipped_lines(spark, path)
    names = [c.split()[0] for c in schema.split(",")]
    header = F.regexp_replace("value", '[ "]', "") == ",".join(names)
    got = lines.where(~header & ~F.col("value").startswith(names[0] + ",")).select(F.from_csv("value", schema, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")
    return got.where(F.col(names[0]).isNotNull())


def listed(html: str, pattern: str) -> list[tuple[str, str]]:
    """(date, href) of a directory listing's links, sorted; the pattern's first group is the date."""
    links = re.findall(r'href="([^"]+)"', html)
    return sorted((m[1], x) for x in links if (m := re.search(pattern, x)))


def time_chunks(start: dt.datetime, stop: dt.datetime, seconds: int, most: int) -> list[tuple[dt.datetime, dt.datetime]]:
    """Request windows of at most `most` periods each, the next beginning one period after the last's end."""
    out, step = [], dt.timedelta(seconds=seconds)
    while start <= stop:
        end = min(stop, start + step * (most - 1))
        out.append((start, end))
        start = end + step
    return out


@dataclass
class _Chunk(InputPartition):
    symbol: str
    start: dt.datetime
    stop: dt.datetime

    def __init__(self, symbol: str, start: dt.datetime, stop: dt.datetime):
        super().__init__((symbol, start, stop))
        self.symbol, self.start, self.stop = symbol, start, stop


class _PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str], fetch: Callable):
        self.options, self.fetch = options, fetch

    def partitions(self) -> list[InputPartition]:
        o = self.options
        spans = time_chunks(dt.datetime.fromisoformat(o["start"]), dt.datetime.fromisoformat(o["stop"]), int(o.get("seconds", "60")), int(o.get("page", "1000")))
        return [_Chunk(s, a, b) for s in o["symbols"].split(",") for a, b in spans]

    def read(self, partition: _Chunk) -> Iterator[tuple]:
        wait = 1.0
        for attempt in range(6):
            try:
                rows = self.fetch(partition.symbol, partition.start, partition.stop)
                break
            except OSError:
                if attempt == 5:
                    raise
                time.sleep(wait)
                wait *= 2
        for row in sorted(rows):
            yield (partition.symbol, *row)


def paged_source(name: str, schema: str, fetch: Callable[[str, dt.datetime, dt.datetime], list[tuple]]) -> type[DataSource]:
    """A batch source `name` over a paged service: one partition a request, retried with doubling waits.

    fetch(symbol, start, stop) returns rows without the symbol, in any order (newest first is usual); they come out sorted.
    Register the class with spark.dataSource.register and read with options symbols, start, stop, seconds, page.
    """

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return _PagedReader(dict(self.options), fetch)

    return Paged


def all_pages(fetch: Callable[[str | None], tuple[list[dict], str | None]], most: int = 500) -> list[dict]:
    """Rows of a service that pages by cursor, continuation token or oldest time: fetch(cursor) returns rows and the next one.

    Rows gather on the driver, so this is for lists such as instruments. More than `most` pages are an error, not cut off.
    """
    rows, cursor = [], None
    for _ in range(most):
        part, cursor = fetch(cursor)
        rows += part
        if not part or cursor is None:
            return rows
    raise ValueError(f"more than {most} pages")


def daily_series(spark: SparkSession, payload: str, path: str = "data") -> DataFrame:
    """day, value, label of a daily index service: epoch seconds and numbers as strings; of one day the last entry wins."""
    shape = f"{path} array<struct<timestamp: string, value: string, value_classification: string>>"
    one = spark.createDataFrame([(payload,)], "j string").select(F.posexplode(F.from_json("j", shape)[path]).alias("i", "e"))
    rows = one.select(F.to_date(F.timestamp_seconds(F.expr("try_cast(e.timestamp as bigint)"))).alias("day"), F.expr("try_cast(e.value as int)").alias("value"), F.col("e.value_classification").alias("label"), "i")
    return rows.where("day is not null").groupBy("day").agg(F.max_by("value", "i").alias("value"), F.max_by("label", "i").alias("label"))


def ratio_series(spark: SparkSession, payload: str) -> DataFrame:
    """ts, buy, sell of a ratio service's answer {retCode, result: {list: [{timestamp ms, buyRatio, sellRatio}]}}; errors give no rows."""
    shape = "retCode int, result struct<list: array<struct<timestamp: string, buyRatio: string, sellRatio: string>>>"
    one = spark.createDataFrame([(payload,)], "j string").select(F.from_json("j", shape).alias("r")).where("r.retCode = 0")
    rows = one.select(F.explode("r.result.list").alias("e"))
    return rows.select(F.timestamp_millis(F.expr("try_cast(e.timestamp as bigint)")).cast("timestamp_ntz").alias("ts"), F.expr("try_cast(e.buyRatio as double)").alias("buy"), F.expr("try_cast(e.sellRatio as double)").alias("sell"))


@dataclass
class Config:
    """What is computed: symbols, timeframes, and periods or settings by indicator."""

    symbols: list[str]
    timeframes: list[str] = field(default_factory=lambda: ["1m", "15m", "1h", "4h", "1d"])
    indicators: dict[str, dict] = field(default_factory=dict)

    @classmethod
    def parse(cls, text: str) -> Config:
        """From JSON."""
        from tickloom.operators.bars import minutes

        got = cls(**json.loads(text))
        if not got.symbols:
            raise ValueError("no symbols")
        for timeframe in got.timeframes:
            minutes(timeframe)
        return got


def log_events(spark: SparkSession, path: str) -> DataFrame:
    """level, symbol, message of log lines such as `2024-01-01 00:00:00 - INFO - [BTC] message`."""
    shape = r"^(\S+ \S+) - (\w+) - (?:\[(\w+)\] )?(.*)$"
    part = lambda i: F.regexp_extract("value", shape, i)
    return spark.read.text(path).where(F.col("value").rlike(shape)).select(F.expr("try_cast(regexp_extract(value, '^(\\\\S+ \\\\S+)', 1) as timestamp_ntz)").alias("ts"), part(2).alias("level"), F.nullif(part(3), F.lit("")).alias("symbol"), part(4).alias("message"))
