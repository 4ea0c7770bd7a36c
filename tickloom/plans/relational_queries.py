"""The documented query surface over bars: joins, aggregates, windows, signals. Where the dialects agree, one SQL text serves
both engines: `bars` (hourly) and `ticks` are views in Spark and common table expressions in the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.joins import asof_join, interval_join
from tickloom.plans.base import BARS, hourly, query, rounded, table, ticks

TABLES = "region nation customer supplier part orders lineitem events".split()


def run_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    for t in TABLES:
        if t in text:
            table(spark, sf_dir, t).createOrReplaceTempView(t)
    if "bars" in text:
        hourly(spark, sf_dir).createOrReplaceTempView("bars")
    if "ticks" in text:
        ticks(spark, sf_dir).createOrReplaceTempView("ticks")
    return spark.sql(text)


def both(name: str, select: str, ctes: str = "") -> None:
    """Register one text for both engines."""
    ours = f"with {ctes} {select}" if ctes else select
    theirs = f"with {BARS}{', ' + ctes if ctes else ''} {select}"
    query(theirs, name)(lambda spark, d: run_sql(spark, d, ours))


_W20 = "over (partition by symbol order by ts rows between 19 preceding and current row)"
_L = "over (partition by symbol order by ts)"
IND = f"""ind as (select symbol, ts, close, high, low, volume,
  case when count(close) {_W20} >= 20 then avg(close) {_W20} end as sma_20,
  case when count(close) over (partition by symbol order by ts rows between 49 preceding and current row) >= 50 then avg(close) over (partition by symbol order by ts rows between 49 preceding and current row) end as sma_50,
  case when count(volume) {_W20} >= 20 then avg(volume) {_W20} end as vma_20 from bars)"""

# Joins.
both("join_inner_keys", "select b.symbol, b.ts, round(b.close, 6) as close, round(i.sma_20, 6) as sma_20 from bars b join ind i on b.symbol = i.symbol and b.ts = i.ts where i.sma_20 is not null", IND)
both("join_aggregate", "select b.symbol, b.ts, round(b.close - s.avg_close, 6) as excess from bars b join stats s on b.symbol = s.symbol where b.close > s.avg_close", "stats as (select symbol, avg(close) as avg_close from bars group by symbol)")
both("join_left_indicators", "select b.symbol, b.ts, round(b.close, 6) as close, round(i.sma_20, 6) as sma_20 from bars b left join (select * from ind where sma_20 > sma_50) i on b.symbol = i.symbol and b.ts = i.ts", IND)
both("anti_left_null", "select c.c_custkey, c.c_name from customer c left join (select * from orders where o_totalprice > 280000) o on o.o_custkey = c.c_custkey where o.o_orderkey is null")


@query("select p_partkey, p_name from part where p_partkey not in (select l_partkey from lineitem where l_quantity > 45)")
def anti_not_in(spark, d):
    """Keys without NULLs: an anti join that shuffles or is broadcast by size, where NOT IN would always be broadcast."""
    large = table(spark, d, "lineitem").where("l_quantity > 45 and l_partkey is not null").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, d, "part").join(large, "p_partkey", "left_anti").select("p_partkey", "p_name")


both("anti_not_exists", "select o.o_orderkey, o.o_custkey from orders o where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l.l_returnflag = 'R')")
both("semi_membership", "select symbol, ts, round(close, 6) as close from bars where ts in (select ts from bars where symbol = 'purchase' and close > 100)")
both("multi_timeframe", "select h.symbol, h.ts, round(h.close, 6) as close, round(d.day_close, 6) as day_close, case when h.close > d.day_close then 'above' else 'below' end as side from bars h join daily d on h.symbol = d.symbol and cast(h.ts as date) = d.day", "daily as (select symbol, cast(ts as date) as day, avg(close) as day_close from bars group by symbol, cast(ts as date))")
both("join_shifted_self", "select a.symbol, a.ts, round(b.close - a.close, 6) as next_hour_change from bars a join bars b on a.symbol = b.symbol and b.ts = a.ts + interval '1' hour")
both("cross_scalar", "select b.symbol, b.ts, round(b.close / nullif(g.overall, 0), 6) as relative from bars b cross join (select avg(close) as overall from bars) g where b.volume > 5")
both("join_four_way", "select a.ts, round(a.close, 6) as click, round(b.close, 6) as view, round(c.close, 6) as signup, round(d.close, 6) as purchase from bars a join bars b on a.ts = b.ts and b.symbol = 'view' join bars c on a.ts = c.ts and c.symbol = 'signup' join bars d on a.ts = d.ts and d.symbol = 'purchase' where a.symbol = 'click'")
both("scalar_subquery_latest", "select symbol, ts, round(close, 6) as close from bars where ts = (select max(ts) from bars)")
both("correlated_neighbours", "select d.symbol, d.day, round(d.value, 6) as value, round((select max(p.value) from daily p where p.symbol = d.symbol and p.day = d.day - interval '1' day), 6) as before, round((select max(n.value) from daily n where n.symbol = d.symbol and n.day = d.day + interval '1' day), 6) as after from daily d", "daily as (select symbol, cast(ts as date) as day, avg(close) as value from bars group by symbol, cast(ts as date))")
both("dict_lookup_by_date", "select b.symbol, b.ts, v.n as day_orders from bars b left join (select cast(o_orderdate as date) + interval '9000' day as day, count(*) as n from orders group by 1) v on cast(b.ts as date) = cast(v.day as date)")

# Aggregates.
both("agg_per_symbol", "select symbol, count(*) as n, min(ts) as first_ts, max(ts) as last_ts, round(min(low), 6) as low, round(max(high), 6) as high from bars group by symbol")
both("agg_filtered", "select symbol, count(*) filter (where sma_20 is not null) as have, min(ts) filter (where sma_20 is not null) as first_ts, max(ts) filter (where sma_20 > sma_50) as last_up from ind group by symbol", IND)
both("fill_counts", "select symbol, count(*) as n, count(sma_20) as sma_20, count(sma_50) as sma_50, count(vma_20) as vma_20, round(cast(100 as double) * count(sma_50) / count(*), 2) as filled from ind group by symbol", IND)
both("count_distinct_ts", "select count(distinct ts) as n, count(distinct cast(ts as date)) as days from bars")
both("distinct_days", "select distinct symbol, cast(ts as date) as day from bars")
both("win_rate", "select o_orderpriority as strategy, count(*) as trades, sum(case when o_totalprice > 150000 then 1 else 0 end) as wins, round(100.0 * sum(case when o_totalprice > 150000 then 1 else 0 end) / nullif(count(*), 0), 2) as win_rate, round(sum(o_totalprice), 2) as pnl from orders group by o_orderpriority".replace("sum(case when o_totalprice > 150000 then 1 else 0 end) as wins", "count(case when o_totalprice > 150000 then 1 end) as wins").replace("100.0 * sum(case when o_totalprice > 150000 then 1 else 0 end)", "cast(100 as double) * count(case when o_totalprice > 150000 then 1 end)"))
both("daily_stats", "select symbol, cast(ts as date) as day, round(avg(close), 6) as mean, round(min(close), 6) as low, round(max(close), 6) as high, round(stddev_samp(close), 6) as dev from bars group by symbol, cast(ts as date)")
both("monthly_by_symbol", "select symbol, cast(extract(year from ts) as int) as year, cast(extract(month from ts) as int) as month, count(*) as n, round(avg(close), 6) as mean from bars group by 1, 2, 3")
both("share_of_total", "select regime, count(*) as n, round(cast(100 as double) * count(*) / sum(count(*)) over (), 4) as share from (select case when close > sma_20 then 'up' when close < sma_20 then 'down' else 'none' end as regime from ind) group by regime", IND)
both("cumulative_daily", "select day, round(total, 2) as total, round(sum(total) over (order by day), 2) as running from (select cast(o_orderdate as date) as day, sum(o_totalprice) as total from orders group by 1)")
both("having_duplicates", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by l_orderkey, l_linenumber having count(*) > 1")
both("union_checkpoints", "select 'bars' as source, max(ts) as last_ts from bars union all select 'ticks', max(ts) from ticks union all select 'orders', max(o_orderdate) from orders")
both("histogram_counts", "select p_brand, cast(floor(p_retailprice / 100) as bigint) as bin, count(*) as n from part group by 1, 2")
both("latest_per_symbol", "select symbol, ts, round(close, 6) as close from (select *, row_number() over (partition by symbol order by ts desc) as rn from bars) where rn = 1")
both("top_n_in_group", "select symbol, ts, round(volume, 6) as volume, cast(rn as bigint) as rn from (select symbol, ts, volume, row_number() over (partition by symbol order by volume desc, ts) as rn from bars) where rn <= 5")
both("top_k", "select symbol, ts, round(high - low, 6) as span from bars order by high - low desc, symbol, ts limit 25")

# Windows.
both("lags", "select symbol, ts, " + ", ".join(f"round(lag(close, {n}) {_L}, 6) as lag_{n}" for n in (1, 2, 5, 7, 10)) + " from bars")
both("forward_returns", "select symbol, ts, " + ", ".join(f"round((lead(close, {n}) {_L} / nullif(close, 0) - 1) * 100, 6) as forward_{n}" for n in (24, 168, 720)) + " from bars")
both("forward_return_after_signal", "select symbol, ts, round(forward_24, 6) as forward_24 from (select *, (lead(close, 24) over (partition by symbol order by ts) / nullif(close, 0) - 1) * 100 as forward_24 from ind) where close < sma_20 * 0.5", IND)
both("rolling_frames", "select symbol, ts, count(*) over w as n, round(max(high) over w, 6) as high_24, round(stddev_samp(close) over w, 6) as dev_24 from bars window w as (partition by symbol order by ts rows between 23 preceding and current row)")
both("null_edges", "select symbol, ts from (select symbol, ts, sma_20, lag(sma_20) over (partition by symbol order by ts) as before, row_number() over (partition by symbol order by ts) as rn from ind) where sma_20 is not null and before is null", IND)
both("running_total", f"select symbol, ts, round(sum(volume) over (partition by symbol order by ts rows between unbounded preceding and current row), 6) as total from bars")

# Projections, predicates, signals.
both("classify_trend", "select symbol, ts, case when close > sma_20 and sma_20 > sma_50 then 'strong up' when close > sma_20 then 'up' when close < sma_20 and sma_20 < sma_50 then 'strong down' when close < sma_20 then 'down' else 'flat' end as trend from ind where sma_50 is not null", IND)
both("predicates", "select o_orderkey, o_orderpriority from orders where o_totalprice between 50000 and 60000 and o_orderstatus in ('O', 'F') and o_orderpriority like '1-%' and o_custkey is not null")
both("band_alignment", "select symbol, ts from ind where close > sma_20 and sma_20 > sma_50 and volume > vma_20", IND)
both("golden_death_cross", "select symbol, ts, case when sma_20 > sma_50 then 'golden' else 'death' end as kind from (select *, lag(sma_20) over (partition by symbol order by ts) as p20, lag(sma_50) over (partition by symbol order by ts) as p50 from ind) where (sma_20 > sma_50 and p20 <= p50) or (sma_20 < sma_50 and p20 >= p50)", IND)
both("divergence", "select symbol, ts, case when close > pc and volume < pv then 'bearish' else 'bullish' end as kind from (select *, lag(close, 5) over (partition by symbol order by ts) as pc, lag(vma_20, 5) over (partition by symbol order by ts) as pv from ind) where (close > pc and volume < pv) or (close < pc and volume > pv)", IND)
both("consensus_score", "select symbol, ts, (case when close > sma_20 then 1 else -1 end + case when sma_20 > sma_50 then 1 else -1 end + case when volume > vma_20 then 1 else -1 end) as score from ind where sma_50 is not null", IND)
both("stop_levels", "select symbol, ts, round(close - 2 * (high - low), 6) as stop, round(close + 3 * (high - low), 6) as target, concat(symbol, ': ', case when close > 100 then 'wide' else 'tight' end) as note from bars")
both("deviation_alerts", "select symbol, ts, round((close - sma_20) / nullif(sma_20, 0) * 100, 6) as deviation from ind where abs((close - sma_20) / nullif(sma_20, 0) * 100) > 50", IND)
both("weighted_ranking", "select symbol, ts, round(0.5 * close + 0.3 * volume + 0.2 * (high - low), 6) as score from bars where 0.5 * close + 0.3 * volume + 0.2 * (high - low) > 150")
both("set_difference", "select distinct o_custkey as id from orders where o_totalprice > 300000 except select distinct o_custkey from orders where o_orderstatus = 'F'")
both("set_intersection", "select ts from bars where symbol = 'click' intersect select ts from bars where symbol = 'purchase'")
both("set_union_nulls", "select symbol, ts from ind where sma_20 is null union select symbol, ts from ind where vma_20 is null", IND)
both("scalar_functions", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(abs(l_discount - l_tax), 6) as gap, round(ln(l_quantity), 6) as log_qty, round(sqrt(l_quantity), 6) as root, greatest(l_quantity, 10.0) as least_10, upper(l_returnflag) as flag, cast(extract(day from l_shipdate) as int) as day from lineitem".replace("greatest(l_quantity, 10.0)", "greatest(l_quantity, cast(10 as double))"))


@query(f"with {BARS}, spans as (select symbol, ts as start, ts + interval '90 minutes' as stop, high from bars where high > 150) select t.event_id, s.start, round(s.high, 6) as high from ticks t join spans s on t.symbol = s.symbol and t.ts >= s.start and t.ts < s.stop")
def interval_containment(spark, d):
    bars = hourly(spark, d).where("high > 150")
    spans = bars.select("symbol", F.col("ts").alias("start"), (F.col("ts") + F.expr("interval 90 minutes")).alias("stop"), "high")
    return rounded(interval_join(ticks(spark, d).select("symbol", "ts", "event_id"), spans, "symbol", "ts", "start", "stop", "2 hours").select("event_id", "start", "high"))


@query(f"with {BARS}, late as (select symbol, ts + interval '25 minutes' as ts, close from bars) select t.event_id, round(l.close, 6) as close from ticks t asof left join late l on t.symbol = l.symbol and t.ts >= l.ts")
def asof_backward(spark, d):
    late = hourly(spark, d).select("symbol", (F.col("ts") + F.expr("interval 25 minutes")).alias("ts"), "close")
    return rounded(asof_join(ticks(spark, d).select("symbol", "ts", "event_id"), late, "symbol", "ts", ["close"]).select("event_id", "close"))


@query("select event_id, event_type, cast(json_extract(props, '$.k') as integer) as k, cast(json_extract(props, '$.k') as integer) * 2 as twice from events where cast(json_extract(props, '$.k') as integer) > 50")
def json_fields(spark, d):
    got = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return got.where("k > 50").select("event_id", "event_type", "k", (F.col("k") * 2).alias("twice"))


@query("select o_orderkey, unnest(string_split(o_orderpriority, '-')) as part, unnest(range(1, len(string_split(o_orderpriority, '-')) + 1)) as ordinality from orders")
def array_with_ordinality(spark, d):
    parts = table(spark, d, "orders").select("o_orderkey", F.posexplode(F.split("o_orderpriority", "-")).alias("pos", "part"))
    return parts.select("o_orderkey", "part", (F.col("pos") + 1).cast("long").alias("ordinality"))


@query("select unnest(generate_series(timestamp '2024-01-01', timestamp '2024-01-31', interval '6 hours')) as ts")
def generated_series(spark, d):
    return spark.range(1).select(F.explode(F.expr("sequence(timestamp_ntz'2024-01-01', timestamp_ntz'2024-01-31', interval 6 hours)")).alias("ts"))


@query("select c_custkey, rtrim(rtrim(cast(cast(c_acctbal as decimal(12,2)) as varchar), '0'), '.') as balance, split_part(c_name, '#', 2) as number, regexp_extract('15m', '([0-9]+)([mhdw])', 1) as period from customer")
def string_functions(spark, d):
    c = table(spark, d, "customer")
    balance = F.expr("rtrim('.', rtrim('0', cast(cast(c_acctbal as decimal(12,2)) as string)))")
    return c.select("c_custkey", balance.alias("balance"), F.split_part("c_name", F.lit("#"), F.lit(2)).alias("number"), F.regexp_extract(F.lit("15m"), "([0-9]+)([mhdw])", 1).alias("period"))
