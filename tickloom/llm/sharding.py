"""Balanced label propagation: linked documents move to the shard that most of their neighbours have, under quotas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import SALT_ROWS, join_counts, materialize, ranked, release

SHARDS = 16
ROUNDS = 3


def quotas(rows: int, shards: int) -> list[int]:
    """How many rows each shard takes in the end: counts differ by one at most."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def flows(wanted: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """The largest part of the wanted moves (by shard pair) that leaves no shard with more than its room.

    Inflows of an overfull shard shrink in proportion until none is overfull; this only ever takes away, so it ends.
    """
    x = dict(wanted)
    while True:
        changed = False
        for j, free in enumerate(room):
            into = [k for k in x if k[1] == j and x[k]]
            over = sum(x[k] for k in into) - sum(v for k, v in x.items() if k[0] == j) - free
            if over <= 0 or not into:
                continue
            total, left = sum(x[k] for k in into), over
            for k in sorted(into, key=lambda k: -x[k]):
                cut = min(x[k], -(-over * x[k] // total), left)
                x[k] -= cut
                left -= cut
            changed = True
        if not changed:
            return {k: v for k, v in x.items() if v}


def balanced_labels(rows: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Put every row into one of `shards` shards, keeping linked rows together as far as even counts allow.

    rows: (rid long), unique. links: (rid long, link binary), a row for each group that a row belongs to; rows of a group
    are neighbours of each other. Returns (rid, shard int), with counts that differ by one at most.

    Each round tallies every group's rows by shard; a row's votes are the sums over its groups; it wants the shard with
    most votes (ties by a hash of group and shard, so that a group agrees). A group larger than a shard has as many homes as
    it fills, those with most of its rows; its rows elsewhere want one of them by hash. Of the moves wanted between two
    shards as many happen as quotas allow, whole groups first. Linked rows never exceed a shard's quota; rows without links
    fill what is left. Tallies are partial sums, and a hot group's rows are salted. Empty tables give no rows.
    """
    spark = rows.sparkSession
    n = rows.count()
    quota = quotas(n, shards)
    sizes = materialize(links.groupBy("link").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shard-sizes")
    links = join_counts(links, sizes, "link", "size", F.col("rid"))
    salts = F.ceil(F.col("size") / SALT_ROWS).cast("int")
    links = links.select("rid", "link", F.pmod(F.xxhash64("rid"), salts).cast("int").alias("salt"), salts.alias("salts"))
    linked = links.groupBy("rid").agg(F.min(F.struct(F.xxhash64("link", "salt").alias("hash"), F.col("link"))).alias("first"))
    linked = linked.select("rid", F.col("first.hash").alias("near"), F.xxhash64("first.link").alias("lead"))
    several = materialize(links, "shard-links")
    held = materialize(linked, "shard-linked")
    m = held.count()
    place = ranked(held, [], [F.col("near"), F.col("rid")], "_rank", m, F.col("near")) if m else held.withColumn("_rank", F.lit(0).cast("long"))
    place = materialize(place.select("rid", "near", F.pmod("_rank", F.lit(shards)).cast("int").alias("shard")), "shard-place")
    for turn in range(rounds if m else 0):
        now = several.join(place.select("rid", "shard"), "rid")
        tally = now.groupBy("link", "shard", "salts").agg(F.count(F.lit(1)).alias("n"))
        each = tally.groupBy("link", "salts").agg(F.sum("n").alias("all"), F.sort_array(F.collect_list(F.struct("n", F.xxhash64("link", "shard").alias("tie"), F.col("shard").alias("to"))), asc=False).alias("votes"))
        each = each.withColumn("homes", F.ceil(F.col("all") / quota[0]).cast("int")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        cast = now.join(each.drop("salts"), ["link", "salt"]).select("rid", "shard", "all", "homes", F.posexplode("votes").alias("place", "v"))
        home = (F.col("homes") == 1) | (F.col("place") < F.col("homes"))
        weight = F.when((F.col("homes") == 1) | ~home, F.col("v.n")).when(F.col("v.to") == F.col("shard"), F.col("all") + 1).otherwise(F.col("all"))
        tie = F.when(F.col("homes") == 1, F.col("v.tie")).otherwise(F.xxhash64("rid", "v.to", F.lit(turn)))
        cast = cast.where(home | (F.col("v.to") == F.col("shard"))).select("rid", "shard", F.col("v.to").alias("to"), weight.alias("n"), tie.alias("tie"))
        cast = cast.groupBy("rid", "shard", "to").agg(F.sum("n").alias("n"), F.max("tie").alias("tie"))
        best = cast.groupBy("rid", "shard").agg(F.max(F.struct("n", "tie", "to")).alias("best"))
        moves = best.where("best.to != shard").select("rid", "shard", F.col("best.to").alias("to"))
        moves = materialize(moves.join(place.select("rid", "near"), "rid"), "shard-moves")
        wanted = {(r[0], r[1]): r[2] for r in moves.groupBy("shard", "to").count().collect()}  # at most shards squared
        if not wanted:
            release(spark, moves)
            break
        there = {r[0]: r[1] for r in place.groupBy("shard").count().collect()}
        allowed = flows(wanted, [q - there.get(s, 0) for s, q in enumerate(quota)])
        limit = F.lit(0)
        for (i, j), k in allowed.items():
            limit = F.when((F.col("shard") == i) & (F.col("to") == j), F.lit(k)).otherwise(limit)
        most = ranked(moves, ["shard", "to"], [F.col("near"), F.col("rid")], "_rank", max(wanted.values()), F.col("near"))
        moved = most.where(F.col("_rank") < limit).select("rid", "to")
        after = place.join(moved, "rid", "left").select("rid", "near", F.coalesce("to", "shard").alias("shard"))
        before, place = place, materialize(after, "shard-place")
        release(spark, before, moves)
    taken = {r[0]: r[1] for r in place.groupBy("shard").count().collect()}
    free = rows.join(place.select("rid"), "rid", "left_anti")
    free = ranked(free, [], [F.xxhash64("rid"), F.col("rid")], "_rank", max(n - m, 1))
    start, shard = 0, F.lit(shards - 1)
    ends = []
    for s, q in enumerate(quota):
        start += q - taken.get(s, 0)
        ends.append(start)
    for s in reversed(range(shards)):
        shard = F.when(F.col("_rank") < ends[s], F.lit(s)).otherwise(shard)
    return place.select("rid", "shard").unionByName(free.select("rid", shard.cast("int").alias("shard")))


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Put documents into shards with counts that differ by one at most, equal texts together where quotas allow.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32, law ('rows'), shard, slot (gapless from 0 in the shard),
    grown_shard (null under this law). A null text has size 1 and CRC 0 and is linked
    with nothing; empty texts are equal texts; repeated rows are rows of their own; other columns are left out.
    """
    text = F.col("text")
    base = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("link"),
    )
    base = materialize(base, "shard-base")
    links = base.where("link is not null").select("rid", "link")
    placed = materialize(balanced_labels(base.select("rid"), links, shards, rounds), "shard-labels")
    out = base.join(placed, "rid").select("rid", "doc_id", "size", "text_crc32", "shard")
    out = ranked(out, ["shard"], [F.xxhash64("rid"), F.col("rid")], "slot", max(1, base.count() // shards))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
