"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import SALT_ROWS, hottest, join_counts, materialize, release, scratch


def _contract(links: DataFrame, large: bool, most: int) -> DataFrame:
    """One star operation on written (u, v) with u > v: neighbours are tied to the smallest of the neighbourhood.

    The minimum is a partial aggregate, and a hub's links are salted for the join back, so no hub is gathered in one task.
    """
    both = links.union(links.select(F.col("v"), F.col("u"))) if large else links
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    least = least.select("u", F.least("u", "m").alias("m"), "n")
    if hottest(both, "u") > SALT_ROWS:
        least = materialize(least, "least", most)
        met = join_counts(both, least, "u", "n", F.col("v"))
    else:
        met = both.join(least, "u")
    tied = met.where("v > u" if large else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        tied = tied.union(least.select("u", F.col("m").alias("v")))
    return materialize(tied.where("u <> v").distinct(), "links", most)


def components(links: DataFrame) -> DataFrame:
    """links: (u long, v long), any order, loops and repeats allowed. Returns (id, component): the smallest id reachable.

    Only ids that occur in a link between two different ids are returned. Ends when a pair of contractions changes nothing.
    """
    spark = links.sparkSession
    now = materialize(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")

    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()

    was = None
    while (seen := mark(now)) != was:
        was = seen
        before = now
        with scratch(spark) as kept:
            now = _contract(_contract(before, True, 2 * seen[0]), False, 4 * seen[0])
            kept.append(now)
        release(spark, before)
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
