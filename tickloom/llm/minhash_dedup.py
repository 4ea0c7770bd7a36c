"""Near duplicates by circulant MinHash, banding and exact Jaccard verification.

A set of shingles is placed in a universe of 2^32 positions by a first permutation. A second permutation, shifted
circularly by k, gives signature coordinate k: the smallest value of the set under it. So two permutations make all
coordinates. Bands of equal coordinates propose pairs, and each proposed pair is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import SALT_ROWS, join_counts, materialize, python_ready, scratch, sift
from tickloom.llm.graph import components

WORDS = 5
#: Similarity in per cent: 100 * intersection >= SIMILAR * union.
SIMILAR = 85
#: At similarity 0.85 all bands miss a pair with probability (1 - 0.85^4)^20 = 4e-7.
BANDS, BAND = 20, 4
#: Elements hashed at a time for all coordinates.
BLOCK = 4096
#: A group of more members than this gets leads of its own, so often one after the other.
FEW, LEADS = 32, 2
#: Comparisons of one file.
COMPARED = 2048
#: Rows of one side of a group that meet the other side in one task.
MEET = 256
#: 64-bit words of a sketch: one for each 64 elements of the lead's set, but at least and at most so many.
SKETCH = 2, 16

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _rng.integers(1, 2**63, 4096, dtype=np.uint64) | np.uint64(1)
_MIX = _rng.integers(1, 2**63, 16, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SHIFT = np.arange(BANDS * BAND, dtype=np.uint32)[:, None]


def _mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z lower-cased; words are parted by the six ASCII white-space characters."""
    b = np.frombuffer(text.encode("utf-8").lower(), np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64)
    space = _SPACE[b]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64)
    at = np.zeros(len(b), np.int64)
    at[starts] = starts
    at = np.arange(len(b)) - np.maximum.accumulate(at)
    value = _BYTE[b] * _PLACE[at & 4095]
    value ^= value >> np.uint64(29)
    value += (at.astype(np.uint64) >> np.uint64(12)) * _MIX[15]
    value[space] = 0
    return _mix64(np.add.reduceat(value, starts))


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of all five-word shingles; of the whole sequence where there are fewer words."""
    w = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(w):
        return w
    n = min(len(w), WORDS)
    out = np.full(len(w) - n + 1, np.uint64(n))
    for i in range(n):
        out = _mix64(out * _MIX[i] + w[i : len(w) - n + 1 + i])
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The circulant MinHash coordinates of a non-empty set."""
    place = ((shingles >> np.uint64(32)) ^ (shingles & np.uint64(0xFFFFFFFF))).astype(np.uint32)
    out = np.full(BANDS * BAND, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(place), BLOCK):
        x = place[None, i : i + BLOCK] + _SHIFT
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x7FEB352D)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x846CA68B)
        x ^= x >> np.uint32(16)
        np.minimum(out, x.min(1), out)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(BANDS, BAND).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for i in range(BAND):
        key = _mix64(key * _MIX[5 + i] + rows[:, i])
    return key.view(np.int64)


def set_key(shingles: np.ndarray) -> bytes | None:
    return blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, bands = [], [], []
        for text in batch.column("text"):
            s = shingle_set(text.as_py())
            sizes.append(len(s))
            keys.append(set_key(s))
            bands.append(band_keys(signature(s)) if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "row", "n_shingles", "set_key", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(text.as_py()) for text in batch.column("text")]
        keys, blobs = pa.array([set_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.large_binary()).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("row"), keys, blobs], ["row", "own_key", "shingles"])


def sketch(elements: np.ndarray, words: int) -> np.ndarray:
    """Which of 64 * words cells hold an odd number of the elements.

    The sketches of two sets differ in at most as many bits as the sets differ in elements: what both hold cancels out.
    """
    odd = np.bincount((elements % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each pair's exact comparison. Rows come sorted: a lead's own set, then the sets of its pairs; one lead set is held.

    The members of a lead's group that differ from it are described by the difference to it, elements of their own first,
    then those they lack, each by hash: `tokens` is as much of its beginning as near_duplicates needs.
    """
    at, held = None, None
    for batch in batches:
        rows = []
        for lead, salt, other, crowd, weight, blob in zip(*(batch.column(c).to_pylist() for c in ("lead", "salt", "other", "crowd", "weight", "shingles")), strict=True):
            s = np.frombuffer(blob, np.uint64)
            if other is None:
                at, held = (lead, salt), s
                continue
            if at != (lead, salt):
                continue
            i = np.searchsorted(held, s)
            i[i == len(held)] = 0
            shared = held[i] == s
            both = int(shared.sum())
            d = len(s) + len(held) - 2 * both
            linked = 100 * both >= SIMILAR * (len(s) + len(held) - both)
            tokens, short, cells = None, 0, None
            if crowd:
                away = (100 - SIMILAR) * len(s) // SIMILAR  # at most so many elements are in only one of two similar sets
                lacking = np.ones(len(held), bool)
                lacking[i[shared]] = False
                order = np.concatenate([s[~shared], held[lacking]])
                short = min(d, away + 1, d - -(-d * SIMILAR // (100 + SIMILAR)) + 1) if d else 0
                tokens = order[: short if linked else min(d, away + 1)].view(np.int64)
                cells = sketch(order, min(max(SKETCH[0], -(-len(held) // 64)), SKETCH[1]))
            rows.append((lead, other, weight, len(s), d, linked, tokens, short, cells))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.int32(), pa.list_(pa.int64())]
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lead", "other", "weight", "n", "d", "linked", "tokens", "short", "sketch"])


def _against_leads(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Compare and write the written (lead, other, crowd, weight) on their full sets. A lead's set goes once to each of its salts."""
    spread = F.ceil(F.count(F.lit(1)).cast("double") / SALT_ROWS).cast("int")
    most = pairs.count()
    leads = materialize(pairs.groupBy("lead").agg(spread.alias("salts"), F.count(F.lit(1)).alias("n")), "leads", most)
    none = F.lit(None).cast("long")
    own = leads.join(sets, leads.lead == sets.rep).select("lead", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), none.alias("other"), F.lit(False).alias("crowd"), none.alias("weight"), "shingles")
    salted = join_counts(pairs, leads, "lead", "n", F.col("other")).select("lead", F.pmod(F.xxhash64("other"), F.col("salts")).cast("int").alias("salt"), "other", "crowd", "weight")
    theirs = salted.join(sets, salted.other == sets.rep).select("lead", "salt", "other", "crowd", "weight", "shingles")
    rows = own.union(theirs).repartition("lead", "salt").sortWithinPartitions("lead", "salt", F.col("other").asc_nulls_first())
    compared = rows.mapInArrow(_compared, "lead long, other long, weight long, n long, d long, linked boolean, tokens array<long>, short int, sketch array<long>")
    return materialize(compared, "compared", most, COMPARED)


def _again(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """_against_leads for pairs of some of the sets: only those are shuffled."""
    ids = pairs.select("lead").union(pairs.select("other"))
    return _against_leads(pairs, sift(sets, "rep", ids, 2 * pairs.count()))


def _led(large: DataFrame, sets: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Give groups leads of their own: large (spot, many, other, weight, ...) with class, and the comparisons made.

    LEADS times, the heaviest member that has no class yet leads a group, if more than FEW have none, and every such member is
    compared with it: those linked to it are a class. So each time is linear in the members.
    """
    large, compared = large.withColumn("class", F.lit(None).cast("int")), []
    most = large.count()
    for turn in range(LEADS):
        heads = large.where("class is null").groupBy("spot").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("weight", (-F.col("other")).alias("minus"))).alias("best"), F.first("many").alias("rows"))
        heads = materialize(heads.where(F.col("n") > FEW).select("spot", "rows", (-F.col("best.minus")).alias("head")), "heads", most // FEW)
        if heads.isEmpty():
            break
        names = [c for c in large.columns if c != "class"]
        met = join_counts(large, heads, "spot", "rows", F.col("other"), "left")
        pairs = met.where("head is not null and class is null and head <> other").select(F.col("head").alias("lead"), "other").distinct()
        pairs = materialize(pairs.withColumns({"crowd": F.lit(False), "weight": F.lit(0).cast("long")}), "pairs", most)
        compared.append(_again(pairs, sets))
        hits = compared[-1].where("linked").select(F.col("lead").alias("head"), "other", F.lit(True).alias("hit"))
        known = F.when(F.col("class").isNull() & (F.coalesce("hit", F.lit(False)) | F.coalesce(F.col("head") == F.col("other"), F.lit(False))), turn).otherwise(F.col("class"))
        large = materialize(met.join(hits, ["head", "other"], "left").select(*names, known.alias("class")), "classed")
    return large, compared


def _further(rows: DataFrame, sets: DataFrame) -> list[DataFrame]:
    """Compare the members of the leads' groups as far as linked() asks for.

    rows: the comparisons with the leads. Members are dealt by (lead, token). Those of a group that are not of one class (see
    _led) are paired and filtered by what overlap is still possible and by their sketches; a large group's pairs are salted.
    """
    crowd = rows.where("tokens is not null")
    crowds = crowd.groupBy("lead").agg(F.count(F.lit(1)).alias("size"), F.min("linked").alias("whole"))
    crowds = materialize(crowds.where("size > 1 and not whole").select("lead", "size"), "crowds", rows.count())
    if crowds.isEmpty():
        return []
    members = join_counts(crowd, crowds, "lead", "size", F.col("other"))
    most = members.agg(F.sum(F.size("tokens"))).first()[0] or 0
    places = members.select("lead", "other", "weight", "n", "d", (~F.col("linked")).alias("far"), "short", "sketch", F.posexplode("tokens").alias("i", "token"))
    places = places.select(F.xxhash64("lead", "token").alias("spot"), "other", "weight", "n", "d", "sketch", "i", "far", (F.col("i") < F.col("short")).alias("near"))
    spots = places.groupBy("spot").agg(F.count(F.lit(1)).alias("many"), F.count_if("far").alias("fars"), F.count_if("near").alias("nears"))
    spots = materialize(spots.where("many > 1 and fars > 0 and nears > 0").select("spot", "many"), "spots", most // 2)
    likely = sift(places, "spot", spots.select("spot"), spots.count())
    at = materialize(join_counts(likely, spots, "spot", "many", F.col("other")), "meets", most)
    large, compared = _led(at.where(F.col("many") > FEW), sets)
    classes = large.groupBy("spot").agg(F.first("many").alias("many"), (F.coalesce(F.min("class") == F.max("class"), F.lit(False)) & (F.count("class") == F.count(F.lit(1)))).alias("one"))
    mixed = materialize(classes.where("not one").select("spot", "many"), "mixed", most // FEW)
    rest = join_counts(large.drop("many"), mixed, "spot", "many", F.col("other"))
    every = rest.unionByName(at.where(F.col("many") <= FEW).withColumn("class", F.lit(None).cast("int")))
    salts = F.ceil(F.col("many") / MEET).cast("int")
    one = every.where("far").select("spot", F.pmod(F.xxhash64("other"), salts).cast("int").alias("salt"), F.col("other").alias("x"), F.col("n").alias("nx"), F.col("d").alias("dx"), F.col("sketch").alias("sx"), "i", F.col("class").alias("cx"))
    two = every.where("near").select("spot", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.col("other").alias("y"), F.col("n").alias("ny"), F.col("d").alias("dy"), F.col("sketch").alias("sy"), F.col("i").alias("j"), F.col("class").alias("cy"))
    least, most = 100 - SIMILAR, 100 + SIMILAR
    apart = "aggregate(zip_with(sx, sy, (a, b) -> bit_count(a ^ b)), 0, (sum, n) -> sum + n)"  # or more: see sketch
    enough = F.expr(f"x <> y and coalesce(cx <> cy, true) and 100 * least(nx, ny) >= {SIMILAR} * greatest(nx, ny) and {2 * most} * least(dx - i, dy - j) >= {most} * (dx + dy) - {least} * (nx + ny) and {most} * {apart} <= {least} * (nx + ny)")
    near = one.join(two, ["spot", "salt"]).where(enough).select(F.least("x", "y").alias("lead"), F.greatest("x", "y").alias("other")).distinct()
    pairs = materialize(near.withColumns({"crowd": F.lit(False), "weight": F.lit(0).cast("long")}), "pairs")
    return [*compared, _again(pairs, sets)]


def row_key() -> Column:
    """A 128-bit key of a row's doc_id and text, either of which may be null: equal in equal rows only."""
    return F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.when(F.col("text").isNull(), "n").otherwise("t"), "text")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Link documents with similar shingle sets and give each document its component.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable) and kept (doc_id = component_id), a row for each
    row of docs. Documents without words link with nothing. Rows that repeat a doc_id are rows of their own. Where all ids of
    a component are null, component_id is null and all its rows are kept. Other columns are left out.
    """
    component = F.coalesce("component_id", "doc_id")
    return linked(docs).select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def first_rows(docs: DataFrame) -> DataFrame:
    """The row_key (as _row) of one row of each component, that of the smallest doc_id (null last), and of all rows without words."""
    rows = materialize(linked(docs).select("doc_id", "row", "root"), "rows")
    first = rows.where("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    return first.select(F.col("first.row").alias("_row")).union(rows.where("root is null").select("row"))


def linked(docs: DataFrame) -> DataFrame:
    """doc_id, row (its row_key), n_shingles, root (a vertex that names the component, null without words) and component_id (its
    smallest doc_id, null if it has none), a row for each row of docs.

    Equal sets are one vertex with a number of its own, so copies are never paired and ids may be null or repeat.

    In each bucket of a band every member x is compared with a lead l: the member that shares most buckets with others, which
    in a group of edited copies is the original. Two members x, y of a bucket that are both linked to its lead are in one
    component anyway. Any other similar pair differs from the lead in similar ways, so it is found by a prefix filter on the
    differences dx = x ^ l and dy = y ^ l (symmetric differences), which are short where sets are alike and hold mostly
    elements of one member only. With c = 15/185, x ~ y means |x ^ y| = |dx ^ dy| <= c (|x| + |y|). If x is not linked to l:
    - dx and dy must share more than |dy| * (1 - c) / 2 elements, so the first |dy| * (1 + c) / 2 + 1 of dy must meet dx;
    - at most 15/85 |x| elements of dx are outside dy, so the first 15/85 |x| + 1 of dx must meet those of dy;
    - at the first shared element, what remains of both must suffice for the overlap that is required.
    - the sketches of dx and dy differ in at most |x ^ y| bits.
    All four hold for every similar pair, so x and y meet at some (lead, token). A large group there, such as a cluster of
    copies that is unlike the lead, gets leads of its own; members linked to one of them are in one component, and only the
    others are paired. So none is lost, and a cluster is compared with its lead, not with itself.
    """
    spark = docs.sparkSession
    python_ready(spark)
    texts = docs.select("doc_id", row_key().alias("row"), "text")
    base = materialize(texts.mapInArrow(_sign, "doc_id long, row binary, n_shingles long, set_key binary, bands array<long>"), "signatures")
    with scratch(spark) as kept:
        ends = _ends(texts, base)
        kept.append(ends)
    out = join_counts(base.select("doc_id", "row", "n_shingles", "set_key"), ends, "set_key", "copies", F.xxhash64("doc_id", "row"), "left")
    return out.select("doc_id", "row", "n_shingles", "root", "component_id")


def _ends(texts: DataFrame, base: DataFrame) -> DataFrame:
    """set_key, copies, root and component_id of each set with words, written."""
    reps = base.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("least"), F.min("row").alias("row"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("copies"))
    reps = materialize(reps.withColumn("rep", F.monotonically_increasing_id()), "sets")
    spots = reps.select("rep", F.explode("bands").alias("bucket"))
    most = reps.count()
    shared = materialize(spots.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets", BANDS * most // 2)
    weight = F.sum("size").over(Window.partitionBy("rep"))  # of at most BANDS rows
    members = materialize(join_counts(spots, shared, "bucket", "size", F.col("rep")).withColumn("weight", weight), "members", BANDS * most)
    lead = members.groupBy("bucket").agg(F.max(F.struct(F.col("weight"), (-F.col("rep")).alias("minus"))).alias("best"), F.first("size").alias("size"))
    lead = materialize(lead.select("bucket", (-F.col("best.minus")).alias("lead"), "size"), "bucket-leads", shared.count())
    met = join_counts(members.select("rep", "bucket", "weight"), lead, "bucket", "size", F.col("rep")).where("rep <> lead")
    pairs = met.groupBy("lead", F.col("rep").alias("other")).agg(F.max(F.col("size") > 2).alias("crowd"), F.max("weight").alias("weight"))
    pairs = materialize(pairs, "pairs", members.count())
    wanted = members.select("rep").distinct().join(reps.select("rep", "set_key", "row", "copies"), "rep")
    wanted = materialize(wanted, "wanted", most)  # a row occurs at most as often as its set
    likely = sift(texts.select("row", "text"), "row", wanted.select("row"), most).mapInArrow(_sets, "row binary, own_key binary, shingles binary")
    sets = join_counts(likely, wanted, "row", "copies", F.xxhash64("row")).where("own_key = set_key")
    sets = materialize(sets.dropDuplicates(["row", "own_key"]).select("rep", "shingles"), "shingles")
    compared = _against_leads(pairs, sets)
    links = None
    for part in [compared, *_further(compared, sets)]:
        part = part.where("linked").select(F.col("lead").alias("u"), F.col("other").alias("v"))
        links = part if links is None else links.union(part)
    labels = components(links).withColumnRenamed("id", "rep")
    least = labels.join(reps.select("rep", "least"), "rep").groupBy("component").agg(F.min("least").alias("label"), F.count(F.lit(1)).alias("n"))
    labels = join_counts(labels, materialize(least, "labels", most), "component", "n", F.col("rep"))
    component_id = F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("label"))
    ends = reps.select("rep", "set_key", "copies", "least").join(labels, "rep", "left")
    return materialize(ends.select("set_key", "copies", F.coalesce("component", "rep").alias("root"), component_id.alias("component_id")), "ends", most)


ORACLE = r"""
with recursive low as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
), words as (
  select doc_id, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from low
), shingled as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
  from words
), classed as (
  select doc_id, len(s) as n, min(doc_id) over (partition by list_sort(s)) as class, s from shingled
), sets as (
  select doc_id as class, n, s from classed where doc_id = class and n > 0
), items as (
  select class, n, unnest(s) as x from sets
), pairs as (
  select a.class as u, b.class as v, a.n as n, b.n as m, count(*) as both_in
  from items a join items b on a.x = b.x and a.class < b.class group by all
), links as (
  select u, v from pairs where 100 * both_in >= 85 * (n + m - both_in)
), edges as (
  select u, v from links union select v, u from links
), reach(id, root) as (
  select class, class from sets
  union
  select e.v, r.root from reach r join edges e on e.u = r.id
), best as (
  select id, min(root) as component_id from reach group by id
)
select c.doc_id, c.n as n_shingles,
  case when c.n = 0 then c.doc_id else coalesce(b.component_id, c.class) end as component_id,
  c.doc_id = case when c.n = 0 then c.doc_id else coalesce(b.component_id, c.class) end as kept
from classed c left join best b on b.id = c.class
"""
