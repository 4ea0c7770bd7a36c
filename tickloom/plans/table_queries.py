"""External series, upserts and data-quality operators over derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import derivatives as D
from tickloom.operators import indicators as I
from tickloom.operators import merge as M
from tickloom.operators import quality as Q
from tickloom.plans.base import BARS, hourly, query, rounded, table

# Derivatives and sentiment. Funding: the last close before each 8-hour mark, for all symbols but 'error'.
_FUNDING = f"{BARS}, funding as (select symbol, time_bucket(interval '8 hours', ts) as ts, arg_max(close, ts) / 10000 as rate from bars where symbol <> 'error' group by 1, 2)"


@query(f"with {_FUNDING} select b.symbol, b.ts, time_bucket(interval '8 hours', b.ts) + interval '8 hours' as funding_time_next, round(f.rate, 8) as funding_rate_next from bars b left join funding f on f.symbol = b.symbol and f.ts = time_bucket(interval '8 hours', b.ts) + interval '8 hours'")
def funding_next(spark, d):
    bars = hourly(spark, d).select("symbol", "ts", "close")
    funding = bars.where("symbol <> 'error'").groupBy("symbol", F.window("ts", "8 hours").start.alias("_s")).agg((F.max_by("close", "ts") / 10000).alias("rate")).withColumnRenamed("_s", "ts")
    return rounded(D.next_funding(bars, funding).select("symbol", "ts", "funding_time_next", "funding_rate_next"), 8)


@query(f"with {BARS}, p as (select symbol, ts, open - close as premium from bars where volume > 2) select b.symbol, b.ts, round(p.premium, 6) as premium_index from bars b left join p on p.symbol = b.symbol and p.ts = b.ts")
def premium_index(spark, d):
    bars = hourly(spark, d)
    series = bars.where("volume > 2").select("symbol", "ts", (F.col("open") - F.col("close")).alias("premium"))
    return rounded(D.exact(bars.select("symbol", "ts"), series, "premium", "premium_index"))


@query(f"with {BARS} select symbol, ts, round(case when volume > 2 then trades::double end, 6) as open_interest from bars where symbol in ('click', 'view')")
def open_interest(spark, d):
    bars = hourly(spark, d)
    series = bars.where("volume > 2").select("symbol", "ts", F.col("trades").cast("double").alias("oi"))
    return rounded(D.exact(bars.where(F.col("symbol").isin("click", "view")).select("symbol", "ts"), series, "oi", "open_interest"))


@query("with r as (select date_trunc('hour', ts) as ts, count(*) filter (where event_type = 'view')::double as buy, count(*) filter (where event_type = 'click')::double as sell from events group by 1) select ts, buy, sell, round(case when sell > 0 then buy / sell end, 6) as long_short_ratio from r")
def long_short_ratio(spark, d):
    n = lambda k: F.count_if(F.col("event_type") == k).cast("double")
    r = table(spark, d, "events").groupBy(F.window("ts", "1 hour").start.alias("_s")).agg(n("view").alias("buy"), n("click").alias("sell")).withColumnRenamed("_s", "ts")
    return rounded(D.long_short(r))


_MOOD = "mood as (select cast(o_orderdate as date) + 9000 as day, cast(count(*) * 4 + 11 as bigint) as value from orders where o_orderdate >= timestamp '1999-01-01' and o_orderdate < timestamp '1999-12-31' group by 1)"


def _mood(spark, d):
    o = table(spark, d, "orders").where("o_orderdate >= '1999-01-01' and o_orderdate < '1999-12-31'")
    return o.groupBy(F.date_add(F.to_date("o_orderdate"), 9000).alias("day")).agg((F.count(F.lit(1)) * 4 + 11).cast("long").alias("value"))


@query(f"with {BARS}, {_MOOD} select b.symbol, b.ts, m.value, case when m.value <= 25 then 'Extreme Fear' when m.value <= 45 then 'Fear' when m.value <= 55 then 'Neutral' when m.value <= 75 then 'Greed' when m.value is not null then 'Extreme Greed' end as class from bars b left join mood m on m.day = b.ts::date")
def sentiment_by_day(spark, d):
    return D.by_day(hourly(spark, d), _mood(spark, d), "value").select("symbol", "ts", "value", D.sentiment_class("value").alias("class"))


@query(f"""with {_MOOD}, m as (select * from mood where extract(day from day) % 5 <> 0),
  g as (select day, value, lead(day) over (order by day) as nd, lead(value) over (order by day) as nv from m)
select day, value, false as interpolated from m union all
select day + 1, (case when (value + nv) % 2 = 0 then (value + nv) // 2 when ((value + nv) // 2) % 2 = 0 then (value + nv) // 2 else (value + nv) // 2 + 1 end)::bigint, true from g where nd - day = 2""")
def sentiment_interpolation(spark, d):
    return D.interpolate_days(_mood(spark, d).where(F.dayofmonth("day") % 5 != 0), "value")


@query(f"with {BARS} select b.ts::date as day, count(distinct b.symbol) as values, 2::bigint as timeframes from bars b where b.volume > 6 group by 1 having count(distinct b.symbol) > 1 and count(*) filter (where extract(hour from b.ts) % 4 = 0) > 0 and count(*) filter (where extract(hour from b.ts) % 4 <> 0) > 0")
def inconsistent_days(spark, d):
    busy = hourly(spark, d).where("volume > 6").select("ts", "symbol")
    found = D.inconsistent_days({"4h": busy.where(F.hour("ts") % 4 == 0), "1h": busy.where(F.hour("ts") % 4 != 0)}, "symbol")
    return found.where("timeframes = 2")


# Upserts: the target is part of the hourly bars, the source another part with changed closes.
_PARTS = f"{BARS}, t as (select symbol, ts, close, case when volume > 3 then volume end as volume from bars where extract(hour from ts) < 16), s as (select symbol, ts, close + 1 as close, volume * 2 as volume from bars where extract(hour from ts) >= 8)"
_KEY = "s.symbol = t.symbol and s.ts = t.ts"


def _target(spark, d):
    return hourly(spark, d).where(F.hour("ts") < 16).select("symbol", "ts", "close", F.when(F.col("volume") > 3, F.col("volume")).alias("volume"))


def _source(spark, d):
    return hourly(spark, d).where(F.hour("ts") >= 8).select("symbol", "ts", (F.col("close") + 1).alias("close"), (F.col("volume") * 2).alias("volume"))


KEYS = ["symbol", "ts"]
_OUT = "symbol, ts, round(close, 6) as close, round(volume, 6) as volume"


@query(f"with {_PARTS} select {_OUT} from t union all select {_OUT} from s where not exists (select 1 from t where {_KEY})")
def upsert_do_nothing(spark, d):
    return rounded(M.append_absent(_target(spark, d), _source(spark, d), KEYS))


@query(f"with {_PARTS} select {_OUT} from s union all select {_OUT} from t where not exists (select 1 from s where {_KEY})")
def upsert_full_row(spark, d):
    return rounded(M.upsert(_target(spark, d), _source(spark, d), KEYS))


def _joined(kind: str, close: str, volume: str) -> str:
    return f"with {_PARTS} select coalesce(t.symbol, s.symbol) as symbol, coalesce(t.ts, s.ts) as ts, round({close}, 6) as close, round({volume}, 6) as volume from t {kind} join s on {_KEY}"


@query(_joined("full", "t.close", "case when s.symbol is not null then s.volume else t.volume end"))
def upsert_column_group(spark, d):
    return rounded(M.upsert_columns(_target(spark, d), _source(spark, d), KEYS, ["volume"]))


@query(_joined("full", "t.close", "coalesce(t.volume, s.volume)"))
def upsert_fill_null(spark, d):
    return rounded(M.fill_null(_target(spark, d), _source(spark, d), KEYS, ["volume"]))


@query(_joined("left", "case when s.symbol is not null then s.close else t.close end", "t.volume"))
def update_existing(spark, d):
    return rounded(M.update(_target(spark, d), _source(spark, d), KEYS, ["close"]))


@query(_joined("left", "t.close", "coalesce(t.volume, s.volume)"))
def update_if_null(spark, d):
    return rounded(M.update(_target(spark, d), _source(spark, d), KEYS, ["volume"], only_null=True))


@query(f"with {_PARTS}, {_MOOD} select symbol, ts, round(close, 6) as close, round(coalesce(t.volume, m.value), 6) as volume from t left join mood m on m.day = t.ts::date")
def set_constant_for_day(spark, d):
    daily = _mood(spark, d).select("day", F.col("value").cast("double").alias("value"))
    return rounded(M.set_for_day(_target(spark, d), daily, "volume", only_null=True))


@query(f"with {_PARTS} select symbol, ts, round(close, 6) as close, null::double as volume from t")
def clear_column(spark, d):
    return rounded(M.clear(_target(spark, d), ["volume"]))


@query("select o_orderkey, o_orderstatus, case when o_orderstatus = 'F' then 'archive' else 'live' end as place from orders")
def archive_and_delete(spark, d):
    stay, move = M.archive(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), F.col("o_orderstatus") == "F")
    return stay.withColumn("place", F.lit("live")).unionByName(move.withColumn("place", F.lit("archive")))


# Quality.
_GRID = f"{BARS}, grid as (select symbol, unnest(generate_series(min(ts), max(ts), interval '1 hour')) as ts from bars group by symbol), missing as (select g.* from grid g left join bars b on b.symbol = g.symbol and b.ts = g.ts where b.symbol is null)"


@query(f"with {_GRID} select symbol, ts from missing")
def missing_periods(spark, d):
    return Q.missing_periods(hourly(spark, d), "1 hour")


@query(f"with {_GRID}, r as (select *, epoch(ts) - 3600 * row_number() over (partition by symbol order by ts) as run from missing) select symbol, min(ts) as start, max(ts) as stop, count(*) as periods from r group by symbol, run")
def gap_islands(spark, d):
    return Q.islands(Q.missing_periods(hourly(spark, d), "1 hour"), 3600)


@query(f"with {BARS}, n as (select symbol, ts, lead(ts) over (partition by symbol order by ts) as nx from bars) select symbol, ts + interval '1 hour' as start, nx - interval '1 hour' as stop, ((epoch(nx) - epoch(ts)) / 3600 - 1)::bigint as missing from n where epoch(nx) - epoch(ts) > 3600")
def gap_list(spark, d):
    return Q.gaps(hourly(spark, d), 3600)


@query(f"with {BARS}, n as (select symbol, ts, lead(ts) over (partition by symbol order by ts) as nx from bars) select symbol, ts + interval '1 hour' as start, nx - interval '1 hour' as stop, ((epoch(nx) - epoch(ts)) / 3600 - 1)::bigint as missing from n where epoch(nx) - epoch(ts) > 7200")
def gap_list_tolerant(spark, d):
    return Q.gaps(hourly(spark, d), 3600, tolerance=2)


@query(f"with {BARS} select symbol, count(*) as n, ((epoch(max(ts)) - epoch(min(ts))) / 3600 + 1)::bigint as expected, round(100.0 * count(*) / ((epoch(max(ts)) - epoch(min(ts))) / 3600 + 1), 6) as coverage from bars group by symbol")
def coverage(spark, d):
    return rounded(Q.coverage(hourly(spark, d), 3600))


@query(f"with {BARS} select symbol, round((epoch(timestamp '2024-01-31 00:05:00') - epoch(max(ts))) / 60, 6) as minutes, case when (epoch(timestamp '2024-01-31 00:05:00') - epoch(max(ts))) / 60 <= 60 then 'fresh' when (epoch(timestamp '2024-01-31 00:05:00') - epoch(max(ts))) / 60 <= 120 then 'late' else 'stale' end as status from bars group by symbol")
def staleness(spark, d):
    return rounded(Q.staleness(hourly(spark, d), F.lit("2024-01-31 00:05:00").cast("timestamp_ntz"), 60, 120))


_SMA = "case when count(close) over (partition by symbol order by ts rows between 19 preceding and current row) >= 20 then avg(close) over (partition by symbol order by ts rows between 19 preceding and current row) end"


@query(f"with {BARS}, v as (select symbol, ts, case when extract(hour from ts) <> 5 then {_SMA} end as sma_20, row_number() over (partition by symbol order by ts) as n from bars) select symbol, ts from v where n > 19 and sma_20 is null")
def nulls_after_warmup(spark, d):
    values = I.sma(hourly(spark, d), [20]).withColumn("sma_20", F.when(F.hour("ts") != 5, F.col("sma_20")))
    return Q.nulls_after_warmup(values, "sma_20", 19).select("symbol", "ts")


@query(f"with {BARS}, c as (select symbol, ts, {_SMA} as computed from bars), s as (select symbol, ts, case when extract(hour from ts) = 3 then computed + 0.5 when extract(hour from ts) = 4 then null else computed end as stored from c) select symbol, ts, round(stored, 6) as stored, round(computed, 6) as computed from c join s using (symbol, ts) where abs(stored - computed) > 0.01 or (stored is null) <> (computed is null)")
def recompute_and_compare(spark, d):
    computed = I.sma(hourly(spark, d), [20]).select("symbol", "ts", "sma_20")
    stored = computed.withColumn("sma_20", F.when(F.hour("ts") == 3, F.col("sma_20") + 0.5).when(F.hour("ts") != 4, F.col("sma_20")))
    return rounded(Q.mismatches(stored, computed, "sma_20", 0.01))


@query(f"with {_GRID} select symbol, ts from missing where not (ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-08') and not (ts >= timestamp '2024-01-20' and ts < timestamp '2024-01-21')")
def known_gap_exclusion(spark, d):
    return Q.outside(Q.missing_periods(hourly(spark, d), "1 hour"), [("2024-01-05", "2024-01-08"), ("2024-01-20", "2024-01-21")])


_RANGES = f"{BARS}, r as (select symbol, min(ts) as start, max(ts) as stop from bars group by symbol)"


def _ranges(spark, d):
    return hourly(spark, d).groupBy("symbol").agg(F.min("ts").alias("start"), F.max("ts").alias("stop"))


@query(f"with {_RANGES}, x as (select symbol, stop, unnest(generate_series(start, stop, interval '100 hours')) as s from r) select symbol, s as start, least(stop, s + interval '99 hours') as stop from x")
def request_plan(spark, d):
    return Q.request_plan(_ranges(spark, d), 100, 3600)


@query(f"with {_RANGES}, x as (select symbol, start, stop, unnest(generate_series(start::date::timestamp, stop, interval '1 day')) as day from r) select symbol, greatest(start, day) as start, least(stop, day + interval '86399 seconds') as stop from x")
def day_pieces(spark, d):
    return Q.days(_ranges(spark, d))
