"""Upserts as pure functions of a target and a source: each returns the new target. Keys are joined once, by hash.

Of several source rows with one key one is taken (which, is not defined), so no target row is multiplied or inserted twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def append_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Insert rows whose key is not there; do nothing for others."""
    return target.unionByName(source.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti"))


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Insert or replace whole rows."""
    source = source.dropDuplicates(keys)
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source.select(*target.columns))


def _matched(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], how: str) -> DataFrame:
    new = source.dropDuplicates(keys).select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    return target.join(new, keys, how)


def upsert_columns(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Insert rows, or change only the columns of one group in rows that are there."""
    met = _matched(target, source, keys, columns, "full_outer")
    return met.select(*[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def fill_null(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Insert rows, or fill columns only where they are NULL."""
    met = _matched(target, source, keys, columns, "full_outer")
    return met.select(*[F.coalesce(F.col(c), F.col(f"_new_{c}")).alias(c) if c in columns else F.col(c) for c in target.columns])


def update(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], only_null: bool = False) -> DataFrame:
    """Change columns of rows that are there (only where NULL, if so asked); never insert."""
    met = _matched(target, source, keys, columns, "left")
    new = lambda c: F.coalesce(F.col(c), F.col(f"_new_{c}")) if only_null else F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c))
    return met.select(*[new(c).alias(c) if c in columns else F.col(c) for c in target.columns])


def set_for_day(target: DataFrame, daily: DataFrame, column: str, only_null: bool = False) -> DataFrame:
    """Set a column for all rows of each UTC day in daily (day, value); daily is bounded by the calendar and broadcast."""
    met = target.withColumn("_day", F.to_date("ts")).join(F.broadcast(daily.select(F.col("day").alias("_day"), F.col("value").alias("_new"), F.lit(True).alias("_hit"))), "_day", "left")
    value: Column = F.coalesce(F.col(column), F.col("_new")) if only_null else F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column))
    return met.withColumn(column, value).select(*target.columns)


def clear(target: DataFrame, columns: list[str]) -> DataFrame:
    """Set columns to NULL."""
    return target.withColumns({c: F.lit(None).cast(target.schema[c].dataType) for c in columns})


def archive(live: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that stay and rows that move to the archive; a NULL condition stays."""
    moves = F.coalesce(condition, F.lit(False))
    return live.where(~moves), live.where(moves)
