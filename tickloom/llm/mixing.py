"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source with target share w of a mixture of B bytes and b bytes of its own is repeated at the mean rate w * B / b. Each
document's count is the Poisson quantile, at that rate, of a uniform number that a hash of the seed, its id and text gives. A
rate over PART is dealt to equal parts with a number each, whose quantiles are added: the sum is Poisson at the whole rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import attach, materialize

SEED = "mix-1"
#: The largest rate that one quantile table serves, so tables have at most some 130 entries.
PART = 32
#: Target weights are bytes to this power: 1 keeps the corpus's shares, 0 makes sources equal.
TEMPERATURE = 0.7
#: Bytes of the mixture over bytes of the corpus.
EPOCHS = 1.0


def uniform(seed: str, *parts: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of an MD5."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *[p.cast("string") for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE, epochs: float = EPOCHS) -> DataFrame:
    """A row for each source: source, n_docs, bytes, weight (summing to 1), rate (mean copies of a document).

    weights: target weights by source (those not named get 0); without them, bytes ** temperature. A null source is a source.
    Documents count one byte more than their text so that a source of empty texts has a rate too.
    """
    sums = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1).cast("long")).alias("bytes"))
    if weights is None:
        raw = F.pow(F.col("bytes").cast("double"), F.lit(temperature))
    else:
        raw = F.lit(0.0)
        for source, weight in weights.items():
            raw = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(weight))).otherwise(raw)
    sums = materialize(sums.withColumn("raw", raw), "sources")
    total = sums.agg(F.sum("raw").alias("raws"), F.sum("bytes").alias("all"))  # one row
    sums = sums.crossJoin(F.broadcast(total))
    share = F.try_divide("raw", "raws")
    return sums.select("source", "n_docs", "bytes", share.alias("weight"), (share * epochs * F.col("all") / F.col("bytes")).alias("rate"))


def poisson_quantiles(rates: DataFrame) -> DataFrame:
    """Add parts, and cdf: P(count <= k) at rate / parts, for k from 0 to far beyond the mean."""
    rates = rates.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.coalesce("rate", F.lit(0.0)) / PART)).cast("int"))
    rates = rates.withColumn("_part", F.col("rate") / F.col("parts"))
    last = F.ceil(F.col("_part") + 12 * F.sqrt("_part") + 30).cast("int")
    start = F.struct(F.lit(0.0).alias("log"), F.exp(-F.col("_part")).alias("sum"), F.array(F.exp(-F.col("_part"))).alias("cdf"))

    def step(s, k):
        log = s["log"] + F.log(F.col("_part") / k)
        p = s["sum"] + F.exp(log - F.col("_part"))
        return F.struct(log.alias("log"), p.alias("sum"), F.concat(s["cdf"], F.array(p)).alias("cdf"))

    steps = F.aggregate(F.sequence(F.lit(1), last), start, step)["cdf"]
    return rates.withColumn("cdf", F.when(F.col("rate") > 0, steps).otherwise(F.array(F.lit(1.0)))).drop("_part")


def replicate(docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE, epochs: float = EPOCHS, seed: str = SEED) -> DataFrame:
    """Repeat every document as often as its source's rate asks and deal all copies out in random order.

    Returns the columns of docs, then copy (from 0), rate and shuffle_key (uniform; partitions are sorted by it). Columns of
    docs with those names are replaced. Counts and keys follow from id and text, so rows that are equal in both have equal
    ones; partitions are dealt by row number as well, so that such rows, however many, spread. Null ids and texts count as
    empty, null sources are a source; an empty table gives no rows.
    """
    names = [c for c in docs.columns if c not in ("copy", "rate", "shuffle_key")]
    rates = poisson_quantiles(source_rates(docs, weights, temperature, epochs))
    table = materialize(rates.select(F.struct("source").alias("_source"), "rate", "parts", "cdf"), "rates")
    own = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit(""))))
    keyed = docs.select(*names, own.alias("_own"), F.monotonically_increasing_id().alias("_at"))
    met = attach(keyed, table, F.struct("source"), "_source", F.col("_at"))
    count = F.size(F.filter("cdf", lambda p: p < uniform(seed, F.col("_own"))))
    more = F.aggregate(F.sequence(F.lit(1), F.col("parts") - 1), F.lit(0), lambda n, j: n + F.size(F.filter("cdf", lambda p: p < uniform(f"{seed}-part", F.col("_own"), j))))
    copies = met.withColumn("_count", count + F.when(F.col("parts") > 1, more).otherwise(0)).where("_count > 0")
    copies = copies.select(*names, "_own", "_at", F.explode(F.sequence(F.lit(0), F.col("_count") - 1)).alias("copy"), "rate")
    copies = copies.withColumn("shuffle_key", uniform(f"{seed}-order", F.col("_own"), F.col("copy")))
    dealt = copies.repartition(F.col("shuffle_key"), F.col("_at")).sortWithinPartitions("shuffle_key", "doc_id", "copy")
    return dealt.drop("_own", "_at")


def mix_sources(docs: DataFrame) -> DataFrame:
    """The mixture at the production parameters, whole documents; rate and key to nine places."""
    out = replicate(docs.select("doc_id", "text", "lang", "source"))
    return out.select("doc_id", "text", "lang", "source", F.col("copy").cast("long").alias("copy"), F.round("rate", 9).alias("rate"), F.round("shuffle_key", 9).alias("shuffle_key"))


ORACLE = f"""
with sums as (
  select source, sum(coalesce(strlen(text), 0) + 1)::double as bytes from documents group by source
), rates as (
  select source, pow(bytes, {TEMPERATURE}) / sum(pow(bytes, {TEMPERATURE})) over () * {EPOCHS} * sum(bytes) over () / bytes as rate from sums
), ks as (
  select source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::bigint + 1)) as k from rates
), cdf as (
  select source, rate, k, sum(exp(k * ln(rate) - lgamma(k + 1) - rate)) over (partition by source order by k) as p from ks
), drawn as (
  select doc_id, text, lang, source, own, (('0x' || substr(md5('{SEED}:' || own), 1, 13))::bigint + 0.5) / 4503599627370496.0 as u
  from (select *, coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, '')) as own from documents)
), counted as (
  select d.doc_id, d.text, d.lang, d.source, d.own, c.rate, count(*) filter (where c.p < d.u) as n
  from drawn d join cdf c on c.source is not distinct from d.source group by all
), copies as (
  select doc_id, text, lang, source, own, rate, unnest(range(0, n)) as copy from counted
)
select doc_id, text, lang, source, copy, round(rate, 9) as rate,
  round((('0x' || substr(md5('{SEED}-order:' || own || ':' || copy), 1, 13))::bigint + 0.5) / 4503599627370496.0, 9) as shuffle_key
from copies
"""
