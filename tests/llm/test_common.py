"""Ranks, joins and components that the corpus operators share."""

import collections

import pytest
from pyspark.sql import functions as F

from tickloom.llm import common
from tickloom.llm.graph import components


def test_ranks_are_gapless(spark, monkeypatch):
    monkeypatch.setattr(common, "RANK_ROWS", 50)
    df = spark.range(1000).withColumn("k", F.when(F.col("id") < 700, "hot").otherwise((F.col("id") % 5).cast("string")))
    got = collections.defaultdict(list)
    for r in common.ranked(df, ["k"], [F.col("id")], "rank", 1000).collect():
        got[r.k].append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in got.values()) and len(got["hot"]) == 700


@pytest.mark.parametrize("broadcast", [0, 50_000])
def test_skewed_joins_lose_nothing(spark, monkeypatch, broadcast):
    monkeypatch.setattr(common, "SALT_ROWS", 30)
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast)
    df = spark.range(500).select("id", F.when(F.col("id") < 200, -1).otherwise(F.col("id") % 40).alias("k"))
    counts = common.materialize(df.groupBy("k").agg(F.count(F.lit(1)).alias("size"), F.max("id").alias("most")), "counts")
    got = common.join_counts(df, counts, "k", "size", F.col("id"))
    want = df.join(counts, "k").select("id", "k", "size", "most")
    assert sorted(map(tuple, got.select("id", "k", "size", "most").collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("most", [64, 2**25])
def test_sifting_loses_nothing(spark, monkeypatch, most):
    monkeypatch.setattr(common, "BLOOM_MOST", most)
    wanted = spark.range(0, 20_000, 40)
    got = {r.id for r in common.sift(spark.range(20_000), "id", wanted, 500).collect()}
    assert got >= set(range(0, 20_000, 40)) and (len(got) < 500 + 0.03 * 20_000 or most == 64)
    assert common.sift(spark.range(100), "id", wanted.where("id < 0"), 0).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 200), (300, 200), (7, 7)] + [(1000, 1000 + i) for i in range(1, 30)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[300] == got[200] == got[100] == 100 and all(got[1000 + i] == 1000 for i in range(30))
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
