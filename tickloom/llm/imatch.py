"""I-Match fingerprints, in DataFrame functions only.

The lexicon holds the terms whose document frequency lies in a band (not too rare, not too common). A document's fingerprint
is a list of hashes, one for each of several randomised subsets of the lexicon: of its distinct terms that are in the subset,
sorted and joined. Documents that differ in few terms still agree on the subsets that lack those terms.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import hottest, materialize

#: The band: at least LEAST and at most MOST of all documents have a term (and at least two do).
LEAST, MOST = 0.002, 0.15
SUBSETS = 8
#: Terms are in one of 16 parts, by the first digit of their MD5. Each subset leaves out this many.
LEFT_OUT = 5
#: Rows that a bucket of neighbours holds on average; quantiles of ids that are constants of the plan.
NEIGHBOURS, CUTS = 1000, 1000
#: Up to this many buckets, a table of two numbers for each is broadcast; beyond, it is joined by shuffle.
BROADCAST_HEADS = 1_000_000
#: Places of the lexicon's hash table.
TABLE = 1 << 15


def terms(text: str) -> str:
    """SQL: the distinct lower-cased runs of other than ASCII non-alphanumerics of a text; an empty one may be among them."""
    return rf"array_distinct(split(lower({text}), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'))"


def left_out(subset: int) -> list[str]:
    """The parts of the lexicon that a subset lacks."""
    return sorted(f"{(subset * 7 + j * 3) % 16:x}" for j in range(LEFT_OUT))


def band(n: int, least: float = LEAST, most: float = MOST) -> tuple[int, int]:
    return max(2, math.ceil(least * n)), max(2, math.floor(most * n))


def lexicon(docs: DataFrame, least: float = LEAST, most: float = MOST) -> Column:
    """The band's terms as a hash table: an array of TABLE arrays of 64-bit term hashes, a constant in the plan.

    docs: (text). Counts are partial sums over all documents; no term's documents are gathered. At most (terms of a document
    on average) / least terms are in the band, whatever the corpus, so the table's size is bounded.
    """
    low, high = band(docs.count(), least, most)
    df = docs.select(F.explode(F.expr(terms("text"))).alias("term")).where("term <> ''").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    table: list[list[int]] = [[] for _ in range(TABLE)]
    for (h,) in df.where((F.col("df") >= low) & (F.col("df") <= high)).select(F.xxhash64("term")).collect():
        table[h % TABLE].append(h)
    return F.from_json(F.lit(json.dumps(table, separators=(",", ":"))), "array<array<bigint>>")


def fingerprint(docs: DataFrame, text: str, lex: Column, name: str) -> DataFrame:
    """Add `name`: an array with a hash for each subset.

    A subset in which a text has no term gets a hash of all the text's terms, so that poor texts agree only where they are
    alike. All in one row: terms are looked up in the constant table.
    """
    every = docs.withColumn("_terms", F.expr(terms(text))).withColumn("_lex", lex)
    known = every.withColumn("_found", F.expr(f"array_sort(transform(filter(_terms, t -> array_contains(_lex[cast(pmod(xxhash64(t), {TABLE}) as int)], xxhash64(t))), t -> struct(t as term, substring(md5(t), 1, 1) as part)))"))
    known = known.withColumn("_whole", F.md5(F.array_join(F.sort_array("_terms"), " ")))

    def one(i: int) -> Column:
        out = ", ".join(f"'{p}'" for p in left_out(i))
        return F.expr(f"coalesce(md5(nullif(array_join(transform(filter(_found, x -> x.part not in ({out})), x -> x.term), ' '), '')), _whole)")

    return known.withColumn(name, F.array(*[F.substring(one(i), 1, 16) for i in range(SUBSETS)])).drop("_terms", "_lex", "_found", "_whole")


def likeness(a: str, b: str) -> Column:
    """The share of subsets on which two fingerprints agree."""
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> if(x = y, 1, 0)), 0, (s, x) -> s + x) / {SUBSETS}.0D")


def _range_number(column: str, cuts: list[float]) -> Column:
    """How many of the sorted cuts are at most the column: first among every so-manieth, then among those between."""
    wide = max(1, math.isqrt(len(cuts)))
    blocks = [cuts[i : i + wide] for i in range(0, len(cuts), wide)]
    first = f"from_json('{json.dumps([b[0] for b in blocks])}', 'array<double>')"
    each = f"from_json('{json.dumps(blocks)}', 'array<array<double>>')"
    block = f"(size(filter({first}, c -> c <= {column})) - 1)"
    return F.expr(f"if({column} < {cuts[0]!r}D, 0, {block} * {wide} + size(filter({each}[greatest({block}, 0)], c -> c <= {column})))")


def _bucketed(rows: DataFrame) -> tuple[DataFrame, int]:
    """rows with position (a number that does not fall as the order rises) and bucket (likewise), and how many buckets.

    Quantiles of the position cut ranges, at most CUTS + 1 however many the rows; each range is cut evenly into as many parts
    as leave about NEIGHBOURS rows in one. Where an id has more rows than that, its position moves up to 1 with the text's
    hash, so that its rows are cut as well.
    """
    ids = rows.select("doc_id")
    ends = ids.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    low = float(ends["low"] or 0) - 1
    position = F.coalesce(F.col("doc_id").cast("double"), F.lit(low))
    if hottest(ids, "doc_id") > NEIGHBOURS:
        position = position + (F.xxhash64("text").cast("double") / float(2**64) + 0.5)
    placed = rows.withColumn("position", position)
    buckets = max(1, math.ceil(ends["n"] / NEIGHBOURS))
    ranges = min(CUTS + 1, buckets)
    cuts = []
    if ranges > 1:
        found = placed.agg(F.percentile_approx("position", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0]
        cuts = sorted({float(c) for c in found or []})
    parts = math.ceil(buckets / (len(cuts) + 1))
    number = _range_number("position", cuts) if cuts else F.lit(0)
    placed = placed.withColumn("_range", number)
    edges = json.dumps([low, *cuts, float(ends["high"] or 0) + 2])
    edge = lambda i: f"from_json('{edges}', 'array<double>')[_range + {i}]"
    part = F.expr(f"greatest(0L, least({parts - 1}L, cast(floor((position - {edge(0)}) / ({edge(1)} - {edge(0)}) * {parts}) as bigint)))")
    bucket = F.col("_range").cast("long") * parts + (part if parts > 1 else F.lit(0).cast("long"))
    return placed.withColumn("bucket", bucket).drop("_range"), parts * (len(cuts) + 1)


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """rows with next_<column> of the next row in descending doc_id, the first following the last.

    Rows are dealt into buckets by ranges of doc_id; the first row of each bucket also goes to the bucket before it, as a
    guest. So neighbours meet without a global sort, and each row is shuffled once. Rows of one id follow in the order of their
    texts' hashes, then of the texts; a null doc_id comes last. Rows equal in id and text stay in one bucket.
    """
    placed, buckets = _bucketed(rows)
    heads = _bucketed(rows.select("doc_id", "text"))[0].groupBy("bucket").agg(F.max("position").alias("head"))  # a row for each bucket
    line = Window.orderBy(F.col("bucket").desc())  # two numbers for each NEIGHBOURS rows
    heads = heads.select("bucket", "head", F.coalesce(F.lag("bucket").over(line), F.min("bucket").over(Window.partitionBy())).alias("before"))
    heads = materialize(heads, "heads")
    met = placed.join(F.broadcast(heads) if buckets <= BROADCAST_HEADS else heads, "bucket")
    own, guest = (F.struct(F.col(c).alias("at"), F.lit(g).alias("guest")) for c, g in (("bucket", 0), ("before", 1)))
    sent = met.withColumn("_to", F.explode(F.when(F.col("position") == F.col("head"), F.array(own, guest)).otherwise(F.array(own))))
    w = Window.partitionBy("_to.at").orderBy("_to.guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc(), "text")
    out = sent.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns])
    return out.where("_to.guest = 0").drop("_to", "bucket", "head", "before", "position")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are.

    The edited text has its last half (rounded down) replaced by the first as many code points of the next document, in
    descending doc_id. Null texts are empty; equal texts have equal fingerprints; repeated rows are rows of their own; other
    columns are left out. A single document is its own next one; an empty table gives no rows.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lex = lexicon(texts.select("text"))
    rows = with_next(fingerprint(texts, "text", lex, "print"), ["text", "print"])
    half = "cast(floor(length(text) / 2) as int)"
    rows = rows.withColumn("edited", F.expr(f"concat(substring(text, 1, length(text) - {half}), substring(next_text, 1, {half}))")).drop("next_text")
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).drop("text")
    rows = fingerprint(rows, "edited", lex, "edited_print")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join("print", ",").alias("fingerprint"),
        F.array_join("edited_print", ",").alias("edited_fingerprint"),
        likeness("print", "edited_print").alias("near_edited"),
        likeness("print", "next_print").alias("near_next"),
    )


def _oracle() -> str:
    def prints(table: str) -> str:
        one = ", ".join(f"substr(coalesce(md5(nullif(string_agg(term, ' ' order by term) filter (where part not in ({', '.join(repr(p) for p in left_out(i))}) and inside), '')), md5(string_agg(term, ' ' order by term))), 1, 16)" for i in range(SUBSETS))
        return f"select doc_id, [{one}] as print from (select t.doc_id, t.term, substr(md5(t.term), 1, 1) as part, l.term is not null as inside from (select distinct doc_id, unnest(regexp_split_to_array(lower(text), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as term from {table}) t left join lex l on l.term = t.term) group by doc_id"

    return rf"""
with docs as (
  select doc_id, coalesce(text, '') as text from documents
), nexts as (
  select doc_id, text, coalesce(lead(text) over (order by doc_id desc), first_value(text) over (order by doc_id desc)) as next_text,
    coalesce(lead(doc_id) over (order by doc_id desc), first_value(doc_id) over (order by doc_id desc)) as next_id
  from docs
), edits as (
  select doc_id, substr(text, 1, length(text) - length(text) // 2) || substr(next_text, 1, length(text) // 2) as text from nexts
), freq as (
  select term, count(*) as df from (select distinct doc_id, unnest(regexp_split_to_array(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as term from docs) where term <> '' group by term
), lex as (
  select term from freq, (select count(*) as n from docs) where df >= greatest(2, ceil({LEAST}::double * n)) and df <= greatest(2, floor({MOST}::double * n))
), own as ({prints("docs")}), edited as ({prints("edits")})
select x.doc_id, length(x.text)::bigint as n_chars, sha256(e.text) as edited_sha256, array_to_string(o.print, ',') as fingerprint,
  array_to_string(d.print, ',') as edited_fingerprint,
  len(list_filter(range(1, {SUBSETS + 1}), lambda i: o.print[i] = d.print[i])) / {SUBSETS}.0::double as near_edited,
  len(list_filter(range(1, {SUBSETS + 1}), lambda i: o.print[i] = n.print[i])) / {SUBSETS}.0::double as near_next
from nexts x join edits e using (doc_id) join own o using (doc_id) join edited d using (doc_id) join own n on n.doc_id = x.next_id
"""


ORACLE = _oracle()
