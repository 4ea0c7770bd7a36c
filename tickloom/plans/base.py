"""The registry, and candles, ticks and chains derived from the synthetic tables, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import bars as B

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        key = name or f.__name__
        assert key not in QUERIES, key
        QUERIES[key] = f
        if oracle:
            ORACLES[key] = oracle
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to six places: rolling sums differ in the last bits between engines."""
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as ticks: one symbol for each event type, unit volume."""
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), "ts", F.col("value").alias("price"), F.lit(1.0).alias("volume"), "event_id")


def hourly(spark: SparkSession, sf_dir: str, timeframe: str = "1h") -> DataFrame:
    return B.from_ticks(ticks(spark, sf_dir), timeframe, ["event_id"])


#: SQL of hourly().
TICKS = "ticks as (select event_type as symbol, ts, value as price, 1.0::double as volume, event_id from events)"


def bars_sql(start: str = "date_trunc('hour', ts)", name: str = "bars") -> str:
    return f"""{TICKS}, {name} as (
  select symbol, {start} as ts, arg_min(price, (ts, event_id)) as open, max(price) as high, min(price) as low,
    arg_max(price, (ts, event_id)) as close, sum(volume) as volume, count(*) as trades
  from ticks group by 1, 2)"""


BARS = bars_sql()
