"""Quality rules with thresholds that adapt to each language and source.

Whole-number metrics of every document go into mergeable quantile sketches, one for each language, source and metric: counts
of logarithmic buckets, exact below 64 and within 1/32 above. Sums of such counts merge in any order and give the same
result. A far-out fence, upper quartile plus a multiple of the interquartile range, replaces fixed cutoffs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import attach, materialize, python_ready

GRAM = 8
#: Multiples of the interquartile range beyond the quartiles.
FENCE = 6
#: metric: numerator, denominator, the smallest room above the upper quartile, all in thousandths.
METRICS = {
    "symbol_rate": ("n_symbols", "n_words", 150),
    "dup_line_rate": ("n_dup_lines", "n_lines", 500),
    "repeat_rate": ("n_repeat_words", "n_words", 200),
    "word_length": ("word_chars", "n_words", 2000),
}
#: The smallest room of word_length below the lower quartile, in thousandths.
BELOW = 1500
#: Each group's sketch also has its language's, weighted as this many documents, so that thresholds of small groups lean on it.
PRIOR = 50

_MIX = np.random.default_rng(90210).integers(1, 2**63, GRAM, dtype=np.uint64) | np.uint64(1)
_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\v\f\r"


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (with a word) of a whole text."""
    raw = (text or "").encode("utf-8")
    words = raw.split()
    n = len(words)
    if not n:
        return 0, 0, 0, 0, 0, 0
    chars = len(text) - (len(raw) - len(raw.translate(None, _SPACES)))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip(_SPACES)]
    repeats = 0
    if n > GRAM:
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
        h = np.zeros(n - GRAM + 1, np.uint64)
        for i in range(GRAM):
            h = (h ^ ids[i : n - GRAM + 1 + i]) * _MIX[i]
            h ^= h >> np.uint64(31)
        _, back, many = np.unique(h, return_inverse=True, return_counts=True)
        at = np.flatnonzero(many[back] > 1)
        if len(at):
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + GRAM, -1)
            repeats = int((np.cumsum(edge)[:n] > 0).sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeats, len(lines)


_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measure(t) for t in batch.column("text").to_pylist()]
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(len(_FIELDS)))], [*kept, *_FIELDS])


def _bucket(v: Column) -> Column:
    """The smallest value of v's bucket: v's six highest binary digits, the rest 0."""
    low = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, low), low)


def sketches(rows: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, metric, value, n): mergeable bucket counts of the metrics, from rows with one column for each metric."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), _bucket(F.col(m)).alias("value")) for m in METRICS])
    return rows.select(*groups, F.explode(pairs).alias("p")).groupBy(*groups, "p.metric", "p.value").agg(F.count(F.lit(1)).alias("n"))


def quantiles(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, metric, n, q1, q3): quartiles of each sketch, the smallest bucket that reaches a quarter of the count."""
    w = Window.partitionBy(*groups, "metric")
    run = sketch.withColumn("upto", F.sum("n").over(w.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))).withColumn("all", F.sum("n").over(w))
    return run.groupBy(*groups, "metric").agg(F.max("all").alias("n"), F.min(F.when(4 * F.col("upto") >= F.col("all"), F.col("value"))).alias("q1"), F.min(F.when(4 * F.col("upto") >= 3 * F.col("all"), F.col("value"))).alias("q3"))


def leaning(fine: DataFrame) -> DataFrame:
    """The sketches of (lang, source), each merged with its language's at the weight of PRIOR documents.

    Counts are multiplied by the language's documents instead of divided, so they stay whole numbers. The same rule holds for
    groups of every size.
    """
    whole = "decimal(38,0)"
    wide = fine.groupBy("lang", "metric", "value").agg(F.sum("n").alias("w"))
    sizes = fine.where(F.col("metric") == next(iter(METRICS))).groupBy("lang").agg(F.sum("n").cast("decimal(18,0)").alias("size"))
    key = lambda df, *more: df.withColumn("_lang", F.struct("lang")).drop("lang", *more)  # noqa: E731
    own = fine.withColumn("_lang", F.struct("lang")).join(key(sizes), "_lang").select("lang", "source", "metric", "value", (F.col("n").cast("decimal(18,0)") * F.col("size")).cast(whole).alias("n"))
    groups = fine.select("lang", "source").distinct().withColumn("_lang", F.struct("lang"))
    lent = groups.join(key(wide), "_lang").select("lang", "source", "metric", "value", (F.col("w").cast("decimal(18,0)") * PRIOR).cast(whole).alias("n"))
    return own.unionByName(lent).groupBy("lang", "source", "metric", "value").agg(F.sum("n").cast(whole).alias("n"))


def judge(docs: DataFrame) -> DataFrame:
    """Metrics, base_failed and kept for each document.

    A document fails the base rules with fewer than 20 words or over 30 % of words in repeated 8-word windows. Of the others
    it fails if a metric is beyond its group's fence: q3 + max(room, FENCE * (q3 - q1)), for word length also below
    q1 - max(BELOW, FENCE * (q3 - q1)). Quartiles come from documents that pass the base rules, those of the group and, at a
    weight of PRIOR documents, those of its language.
    Null and empty texts have 0 words and fail. Null languages and sources are groups. Every row counts, repeated ones too.
    Other columns of docs than doc_id are left out.
    """
    python_ready(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang", "source").mapInArrow(_measured, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in _FIELDS))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rate = lambda a, b: F.expr(f"if({b} = 0, 0L, 1000 * {a} div {b})")  # noqa: E731
    rows = rows.withColumn("base_failed", failed).withColumns({m: rate(a, b) for m, (a, b, _) in METRICS.items()})
    rows = materialize(rows, "metrics")
    good = rows.where("not base_failed")
    fine = materialize(sketches(good, ["lang", "source"]), "sketches")
    met = quantiles(leaning(fine), ["lang", "source"])
    room = F.lit(0)
    for m, (_, _, least) in METRICS.items():
        room = F.when(F.col("metric") == m, F.lit(least)).otherwise(room)
    spread = F.greatest(room, FENCE * (F.col("q3") - F.col("q1")))
    below = F.greatest(F.lit(BELOW), FENCE * (F.col("q3") - F.col("q1")))
    limits = met.groupBy("lang", "source").agg(*[F.max(F.when(F.col("metric") == m, F.col("q3") + spread)).alias(f"most_{m}") for m in METRICS], F.max(F.when(F.col("metric") == "word_length", F.col("q1") - below)).alias("least_word_length"))
    limits = materialize(limits.select(F.struct("lang", "source").alias("_group"), *[c for c in limits.columns if c not in ("lang", "source")]), "limits")
    joined = attach(rows, limits, F.struct("lang", "source"), "_group", F.col("doc_id"))
    beyond = F.col("word_length") < F.col("least_word_length")
    for m in METRICS:
        beyond = beyond | (F.col(m) > F.col(f"most_{m}"))
    kept = ~F.col("base_failed") & ~F.coalesce(beyond, F.lit(False))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))


def _oracle() -> str:
    split = lambda x: f"list_filter(regexp_split_to_array({x}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"  # noqa: E731
    rates = " union all ".join(f"select doc_id, lang, source, '{m}' as metric, case when {b} = 0 then 0 else 1000 * {a} // {b} end as v from good" for m, (a, b, _) in METRICS.items())
    room = " ".join(f"when '{m}' then {least}" for m, (_, _, least) in METRICS.items())
    over = " or ".join(f"case when {b} = 0 then 0 else 1000 * {a} // {b} end > most_{m}" for m, (a, b, _) in METRICS.items())
    limits = ", ".join(f"max(q3 + spread) filter (where metric = '{m}') as most_{m}" for m in METRICS)
    same = "{0}.lang is not distinct from {1}.lang and {0}.source is not distinct from {1}.source"
    return rf"""
with base as (
  select doc_id, lang, source, coalesce(text, '') as t, {split("coalesce(text, '')")} as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ 	-]')) as lines from documents
), grams as (
  select doc_id, i, array_to_string(w[i:i + {GRAM - 1}], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - {GRAM - 2})) as i from base where len(w) > {GRAM})
), hit as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + {GRAM})) as p from (select doc_id, i, count(*) over (partition by doc_id, g) as many from grams) where many > 1) group by 1
), rows as (
  select b.doc_id, lang, source, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(hit.n, 0)::bigint as n_repeat_words, len(lines)::bigint as n_lines from base b left join hit on hit.doc_id = b.doc_id
), judged as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from rows
), good as (
  select * from judged where not base_failed
), rates as ({rates}), fine as (
  select lang, source, metric, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) as value, count(*)::hugeint as n from rates group by all
), sizes as (
  select lang, count(*)::hugeint as size from good group by 1
), both_parts as (
  select f.lang, f.source, f.metric, f.value, f.n * s.size as n from fine f join sizes s on s.lang is not distinct from f.lang
  union all
  select g.lang, g.source, f.metric, f.value, f.n * {PRIOR} from (select distinct lang, source from fine) g join fine f on f.lang is not distinct from g.lang
), merged as (
  select lang, source, metric, value, sum(n) as n from both_parts group by all
), run as (
  select *, sum(n) over (partition by lang, source, metric order by value) as upto, sum(n) over (partition by lang, source, metric) as whole from merged
), quart as (
  select lang, source, metric, min(value) filter (where 4 * upto >= whole) as q1, min(value) filter (where 4 * upto >= 3 * whole) as q3 from run group by all
), fences as (
  select *, greatest(case metric {room} end, {FENCE} * (q3 - q1)) as spread, greatest({BELOW}, {FENCE} * (q3 - q1)) as below from quart
), limits as (
  select lang, source, {limits}, max(q1 - below) filter (where metric = 'word_length') as least_word from fences group by all
)
select j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not coalesce(case when n_words = 0 then 0 else 1000 * word_chars // n_words end < least_word or {over}, false) as kept
from judged j left join limits l on {same.format("l", "j")}
"""


ORACLE = _oracle()
