"""Writes: bar tables by symbol, idempotent partition overwrites, views, state as JSON, JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bars(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet by symbol, sorted by time in each file, so range scans prune partitions and row groups.

    Rows are dealt by symbol and day, so one symbol's rows do not pass through one task.
    """
    dealt = df.repartition("symbol", F.to_date("ts")).sortWithinPartitions("symbol", "ts")
    dealt.write.mode(mode).partitionBy("symbol").parquet(path)


def overwrite_symbols(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Replace only the partitions of the symbols in df; a repeated run gives the same table."""
    dealt = df.repartition("symbol", F.to_date("ts")).sortWithinPartitions("symbol", "ts")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("symbol").parquet(path)


def add_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns that are not there yet, NULL, of the given types: a table's schema grows with its indicators."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def ordered_view(df: DataFrame, name: str, first: list[str]) -> None:
    """A view with some columns first and the others by name."""
    rest = sorted(c for c in df.columns if c not in first)
    df.select(*first, *rest).createOrReplaceTempView(name)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_jdbc(df: DataFrame, url: str, table: str, options: dict[str, str], batch: int = 1000) -> None:
    """Append over JDBC in batches; credentials come with the options, from the caller."""
    df.write.format("jdbc").mode("append").options(url=url, dbtable=table, batchsize=str(batch), **options).save()
