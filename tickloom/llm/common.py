"""What the corpus operators share: written intermediate tables, ranks without a single task, size-checked joins."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one bucket of a distributed rank.
RANK_ROWS = 8192
#: A side with at most this many rows is broadcast; beyond it joins shuffle.
BROADCAST_ROWS = 50_000
#: Rows of one file of a written table whose size has a known bound.
FILE_ROWS = 50_000
#: Rows of one hot key that meet in one task.
SALT_ROWS = 2048
#: Bits that a Bloom filter has for each of its keys, and at most (4 MB).
BLOOM_BITS, BLOOM_MOST = 16, 2**25

_own: dict[str, str] = {}
_shipped: set[str] = set()
_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; in local mode, where none is set, one of our own.

    That is spark.checkpoint.dir, else the folder given to setCheckpointDir. A cluster without either is an error: any other
    folder might be on one machine only.
    """
    sc = spark.sparkContext
    if found := sc.getConf().get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    given = sc._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return str(given.get()).rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if sc.applicationId not in _own:
        _own[sc.applicationId] = tempfile.mkdtemp(prefix="tickloom-")
        atexit.register(shutil.rmtree, _own[sc.applicationId], ignore_errors=True)
    return "file://" + _own[sc.applicationId]


def materialize(df: DataFrame, name: str, most: int | None = None, rows: int = FILE_ROWS) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: lineage ends there, and lost executors lose nothing.

    most: a bound on its rows, where one is known. A small table then has few files, one for each `rows` of the bound,
    however many partitions its last shuffle has; for a large one that changes nothing.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    few = df if most is None else df.coalesce(max(1, math.ceil(most / rows)))
    few.write.parquet(path)
    for scope in _scopes:
        scope.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables that materialize wrote and no later plan reads; each by its own exact path."""
    for table in tables:
        _delete(spark, table.written_to)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Tables written inside are deleted at the end, but for those put into the list that is given."""
    paths: list[str] = []
    kept: list[DataFrame] = []
    _scopes.append(paths)
    try:
        yield kept
    finally:
        _scopes.remove(paths)
        for path in set(paths) - {t.written_to for t in kept}:
            _delete(spark, path)


def python_ready(spark: SparkSession) -> None:
    """Give the package to Python workers, wherever they are; small Arrow batches bound their memory.

    The batch size is left alone where the caller has set one.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        _shipped.add(sc.applicationId)
        root = Path(__file__).resolve().parents[2]
        folder = tempfile.mkdtemp(prefix="tickloom-package-")  # on the driver, which serves it
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        package = f"{folder}/tickloom-package.zip"
        with zipfile.ZipFile(package, "w") as z:
            for f in sorted((root / "tickloom").rglob("*.py")):
                z.write(f, f.relative_to(root))
        sc.addPyFile(package)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str, rows: int, by: Column | None = None) -> DataFrame:
    """Add a gapless rank from 0 inside keys.

    Each key's rows are dealt by hash into buckets of about RANK_ROWS, ranked there, and shifted by what earlier buckets
    hold, so that no key, however hot, is sorted by one task. by: what the bucket hashes (order by default).
    """
    buckets = max(1, math.ceil(rows / RANK_ROWS))
    spread = F.pmod(by if by is not None else F.xxhash64(*order), F.lit(buckets)).cast("int")
    dealt = df.withColumn("_bucket", spread)
    counts = dealt.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return dealt.withColumn("_row", F.row_number().over(within)).join(counts, [*keys, "_bucket"]).withColumn(name, F.col("_before") + F.col("_row") - 1).drop("_bucket", "_row", "_before")


def attach(df: DataFrame, table: DataFrame, key: Column, name: str, spread: Column, how: str = "left") -> DataFrame:
    """Join df to a table with one row a key in its column `name`; hot keys never meet in one task.

    A table of at most BROADCAST_ROWS rows is broadcast; a larger one is repeated per salt and joined by shuffle. spread:
    what deals the rows of a key to its salts, such as the document id.
    """
    df = df.withColumn(name, key)
    if table.count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(table), name, how)
    salts = 64
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).join(salted, [name, "_salt"], how).drop("_salt")


def hottest(df: DataFrame, key: str) -> int:
    """How many rows the most frequent key has."""
    return df.groupBy(key).count().agg(F.max("count")).first()[0] or 0


def join_counts(df: DataFrame, counts: DataFrame, key: str, size: str, spread: Column, how: str = "inner") -> DataFrame:
    """df joined (inner or left) with counts: one row a key, whose column `size` says how many rows of df have the key.

    Keys with more than SALT_ROWS rows are few (at most rows / SALT_ROWS) and joined by attach; the others by shuffle on the
    key. So no hot key meets in one task. counts is read several times and should be a written table.
    """
    if (counts.agg(F.max(size)).first()[0] or 0) <= SALT_ROWS:
        return df.join(counts, key, how)
    columns = [c for c in counts.columns if c != key]
    hot = materialize(counts.where(F.col(size) > SALT_ROWS).select(key, F.struct(*columns).alias("_hot")), "hot")
    marked = attach(df, hot, F.col(key), key, spread)
    warm = marked.where("_hot is not null").select(*df.columns, *[F.col(f"_hot.{c}").alias(c) for c in columns])
    cold = marked.where("_hot is null").drop("_hot").join(counts.where(F.col(size) <= SALT_ROWS), key, how)
    return warm.unionByName(cold.select(*df.columns, *columns))


def sift(df: DataFrame, key: str, wanted: DataFrame, most: int) -> DataFrame:
    """The rows of df whose key may be in the one column of wanted: all that are in it, and 1.4 % of the others.

    A Bloom filter of two hashes, so that rows which a join would drop are not shuffled for it. It never loses a row, but the
    join must follow. most: a bound on the keys, which sets its size; at BLOOM_MOST bits it passes more of the others.
    """
    spark = df.sparkSession
    bits = min(BLOOM_MOST, 1 << max(6, math.ceil(math.log2(max(1, BLOOM_BITS * most)))))

    def cells(of: Column) -> list[Column]:
        return [of.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(of, 32).bitwiseAND(F.lit(bits - 1))]

    held = wanted.select(F.explode(F.array(*cells(F.xxhash64(wanted.columns[0])))).alias("cell"))
    held = held.groupBy(F.shiftright("cell", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(cell & 63 as int)))").alias("mask")).toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[held["word"].to_numpy()] = held["mask"].to_numpy()
    bloom = spark.createDataFrame(pa.table({"_bloom": pa.array([words], pa.list_(pa.int64()))}))
    met = df.withColumn("_hash", F.xxhash64(key)).crossJoin(F.broadcast(bloom))
    for cell in cells(F.col("_hash")):
        word = F.col("_bloom")[F.shiftright(cell, 6).cast("int")]
        met = met.where(F.call_function("shiftrightunsigned", word, cell.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1)
    return met.drop("_hash", "_bloom")
