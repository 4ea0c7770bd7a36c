"""Order-book operators over derived tables: orders as books, events as quotes and messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import book as B
from tickloom.plans.base import query, rounded, table

_LEVELS = """levels as (select l_orderkey as book, case when l_linestatus = 'O' then 'bid' else 'ask' end as side,
  cast(floor(l_extendedprice / l_quantity) as double) / 100 + case when l_linestatus = 'O' then 0 else 25 end as p, sum(l_quantity) as v from lineitem group by 1, 2, 3),
  best as (select book, max(p) filter (where side = 'bid') as bb, min(p) filter (where side = 'ask') as ba from levels group by 1 having max(p) filter (where side = 'bid') is not null and min(p) filter (where side = 'ask') is not null)"""


def _levels(spark, d):
    side = F.when(F.col("l_linestatus") == "O", "bid").otherwise("ask")
    price = F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("double") / 100 + F.when(F.col("l_linestatus") == "O", 0).otherwise(25)
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("book"), side.alias("side"), price.alias("p")).agg(F.sum("l_quantity").alias("v"))


def _metrics(spark, d):
    return B.metrics(B.from_levels(_levels(spark, d), ["book"]))


@query(f"""with {_LEVELS}, m as (select l.*, bb, ba, (bb + ba) / 2 as mid from levels l join best using (book)),
  s as (select book, any_value(bb) as best_bid, any_value(ba) as best_ask, any_value(mid) as mid_price, sum(v) filter (where p = bb and side = 'bid') as bv, sum(v) filter (where p = ba and side = 'ask') as av,
    coalesce(sum(v) filter (where side = 'bid'), 0) as bid_vol_total, coalesce(sum(v) filter (where side = 'ask'), 0) as ask_vol_total,
    sum(p * v) filter (where side = 'bid') as bpv, sum(p * v) filter (where side = 'ask') as apv from m group by 1)
select book, round(best_bid, 6) as best_bid, round(best_ask, 6) as best_ask, round(mid_price, 6) as mid_price, round(best_ask - best_bid, 6) as spread, round((best_ask - best_bid) / mid_price * 100, 6) as spread_pct,
  round((best_bid * av + best_ask * bv) / (bv + av), 6) as microprice, floor(bpv / bid_vol_total * 1e6 + 0.3) / 1e6 as bid_vwap, floor(apv / ask_vol_total * 1e6 + 0.3) / 1e6 as ask_vwap, bid_vol_total, ask_vol_total,
  round((bid_vol_total - ask_vol_total) / (bid_vol_total + ask_vol_total), 6) as imbalance, (bid_vol_total + ask_vol_total) / 2 as liquidity from s""")
def book_prices(spark, d):
    found = _metrics(spark, d).select("book", "best_bid", "best_ask", "mid_price", "spread", "spread_pct", "microprice", "bid_vwap", "ask_vwap", "bid_vol_total", "ask_vol_total", "imbalance", "liquidity")
    # Quotients by whole numbers may end on a half of a sixth place, where engines round either way: these go up from seven tenths.
    cut = {c: F.floor(F.col(c) * 1e6 + 0.3) / 1e6 for c in ("bid_vwap", "ask_vwap")}
    return found.select(*[cut.get(c, F.round(c, 6)).alias(c) if t == "double" else c for c, t in found.dtypes])


_NEAR = " , ".join(f"coalesce(sum(v) filter (where side = '{s}' and abs(p - mid) <= mid * {pct}::double / 100), 0) as {s}_vol_{n}" for s in ("bid", "ask") for n, pct in (("01pct", 0.1), ("05pct", 0.5), ("1pct", 1.0)))


@query(f"with {_LEVELS}, m as (select l.*, bb, ba, (bb + ba) / 2 as mid from levels l join best using (book)), v as (select book, {_NEAR} from m group by 1) select *, round(case when bid_vol_01pct + ask_vol_01pct > 0 then (bid_vol_01pct - ask_vol_01pct) / (bid_vol_01pct + ask_vol_01pct) else 0.0 end, 6) as imbalance_01pct, round(case when ask_vol_01pct > 0 then bid_vol_01pct / ask_vol_01pct else 0.0 end, 6) as buy_pressure, round(case when ask_vol_1pct > 0 then bid_vol_1pct / ask_vol_1pct else 0.0 end, 6) as depth_ratio from v")
def book_near_volume(spark, d):
    return rounded(_metrics(spark, d).select("book", *[f"{s}_vol_{n}" for s in ("bid", "ask") for n in ("01pct", "05pct", "1pct")], "imbalance_01pct", "buy_pressure", "depth_ratio"))


@query(f"""with {_LEVELS}, m as (select l.*, (bb + ba) / 2 as mid from levels l join best using (book)),
  t as (select book, side, list_sum(list_reverse_sort(list(v))[1:3]) / sum(v) as c from m group by 1, 2)
select m.book, round(arg_max(p, (v, p)) filter (where side = 'bid'), 6) as bid_wall_price, max(v) filter (where side = 'bid') as bid_wall_volume, round(arg_max(p, (v, -p)) filter (where side = 'ask'), 6) as ask_wall_price, max(v) filter (where side = 'ask') as ask_wall_volume,
  round(abs(any_value(mid) - arg_max(p, (v, p)) filter (where side = 'bid')) / any_value(mid) * 100, 6) as bid_wall_distance, round((select c from t where t.book = m.book and t.side = 'bid'), 6) as bid_concentration, round((select c from t where t.book = m.book and t.side = 'ask'), 6) as ask_concentration from m group by 1""")
def book_walls(spark, d):
    return rounded(_metrics(spark, d).select("book", "bid_wall_price", "bid_wall_volume", "ask_wall_price", "ask_wall_volume", "bid_wall_distance", "bid_concentration", "ask_concentration"))


def _slip_sql(side: str, order: str, amounts: tuple[int, ...]) -> str:
    cols = ", ".join(f"abs(sum(least(pv, greatest({n} - before, 0))) / nullif(sum(least(pv, greatest({n} - before, 0)) / p), 0) - any_value(best)) as s{n}" for n in amounts)
    return f"(select book, {cols} from (select book, p, p * v * 10 as pv, coalesce(sum(p * v * 10) over (partition by book order by p {order} rows between unbounded preceding and 1 preceding), 0) as before, first_value(p) over (partition by book order by p {order}) as best from levels where side = '{side}') group by book)"


@query(f"with {_LEVELS} select b.book, round(a.s10000, 9) as slippage_buy_10k, round(a.s50000, 9) as slippage_buy_50k, round(a.s100000, 9) as slippage_buy_100k, round(x.s10000, 9) as slippage_sell_10k, round(x.s50000, 9) as slippage_sell_50k, round(x.s100000, 9) as slippage_sell_100k from best b join {_slip_sql('ask', 'asc', (10_000, 50_000, 100_000))} a on a.book = b.book join {_slip_sql('bid', 'desc', (10_000, 50_000, 100_000))} x on x.book = b.book")
def book_slippage(spark, d):
    levels = _levels(spark, d).withColumn("v", F.col("v") * 10)
    names = [f"slippage_{w}_{n}k" for w in ("buy", "sell") for n in (10, 50, 100)]
    return rounded(B.metrics(B.from_levels(levels, ["book"])).select("book", *names), 9)


@query(f"""with {_LEVELS} select b.book, '[' || string_agg('{{"p":' || round(p, 2)::varchar || ',"v":' || round(v, 8)::varchar || '}}', ',' order by p desc) || ']' as bid_levels, count(*)::int as bid_level_count, any_value(ask_levels) as ask_levels, any_value(ask_level_count) as ask_level_count from best b join levels l on l.book = b.book and l.side = 'bid' join (select book, '[' || string_agg('{{"p":' || round(p, 2)::varchar || ',"v":' || round(v, 8)::varchar || '}}', ',' order by p) || ']' as ask_levels, count(*)::int as ask_level_count from levels where side = 'ask' group by 1) k on k.book = b.book group by 1""")
def book_levels_json(spark, d):
    return _metrics(spark, d).select("book", "bid_levels", "bid_level_count", "ask_levels", "ask_level_count")


def _messages(spark, d):
    """events as messages: a snapshot for each 7th id, deltas of one level on one side otherwise."""
    e = table(spark, d, "events")
    level = lambda p, v: F.array(F.struct(p.cast("double").alias("p"), v.cast("double").alias("v")))
    snap = F.col("event_id") % 7 == 0
    off = (F.col("user_id") % 40).cast("double") / 10
    bid, ask = F.lit(100.0) - off, F.lit(100.5) + off
    size = F.col("event_id") % 4
    return e.select(
        F.lit("X").alias("symbol"), "ts", F.col("event_id").alias("seq"), F.when(snap, "snapshot").when(F.col("event_id") % 11 == 0, "other").otherwise("delta").alias("type"),
        F.when(snap, F.concat(level(bid, F.lit(5)), level(bid - 1, F.lit(3)))).when(F.col("event_id") % 2 == 0, level(bid, size)).alias("b"),
        F.when(snap, F.concat(level(ask, F.lit(4)), level(ask + 1, F.lit(2)))).when(F.col("event_id") % 2 == 1, level(ask, size)).alias("a"),
    )


@query()
def book_replay(spark, d):
    minutes = B.replay(_messages(spark, d))
    return rounded(B.metrics(minutes))


_DEPTH = "depth as (select event_type as symbol, ts, case when user_id % 2 = 0 then '-' else '' end || ['0.20', '1.00', '2.00', '3.00', '4.00', '5.00'][(event_id % 6 + 1)::int] as percentage, value as depth, value * 100 as notional, date_trunc('minute', ts) as minute from events)"


@query(f"""with {_DEPTH}, l as (select *, max(ts) over (partition by symbol, minute) as last_ts from depth), w as (select symbol, minute,
  {", ".join(f"max(depth) filter (where percentage = '{'-' if s == 'bid' else ''}{p}') as {s}_depth_{n}" for s in ("bid", "ask") for p, n in (("0.20", "02pct"), ("1.00", "1pct"), ("2.00", "2pct"), ("3.00", "3pct"), ("4.00", "4pct"), ("5.00", "5pct")))},
  max(notional) filter (where percentage = '-5.00') as bid_notional_5pct, max(notional) filter (where percentage = '5.00') as ask_notional_5pct from l where ts = last_ts group by 1, 2),
  c as (select symbol, minute, count(distinct ts) as snapshot_count from depth group by 1, 2)
select w.*, snapshot_count, {", ".join(f"round((coalesce(bid_depth_{p}pct, 0) - coalesce(ask_depth_{p}pct, 0)) / nullif(coalesce(bid_depth_{p}pct, 0) + coalesce(ask_depth_{p}pct, 0), 0), 6) as imbalance_{p}pct" for p in "1235")},
  round(case when ask_depth_5pct > 0 then least(coalesce(bid_depth_5pct, 0) / ask_depth_5pct, 9999) end, 6) as depth_ratio, round(case when ask_depth_1pct > 0 then least(coalesce(bid_depth_1pct, 0) / ask_depth_1pct, 9999) end, 6) as buy_pressure,
  round(coalesce(bid_notional_5pct, 0) + coalesce(ask_notional_5pct, 0), 6) as liquidity_score from w join c on c.symbol = w.symbol and c.minute = w.minute""".replace("select w.*,", "select w.* replace (round(bid_notional_5pct, 6) as bid_notional_5pct, round(ask_notional_5pct, 6) as ask_notional_5pct),"))
def depth_minutes(spark, d):
    return rounded(B.depth_minutes(_depth(spark, d)))


def _depth(spark, d):
    pct = F.array(*[F.lit(x) for x in ("0.20", "1.00", "2.00", "3.00", "4.00", "5.00")])[(F.col("event_id") % 6).cast("int")]
    return table(spark, d, "events").select(F.col("event_type").alias("symbol"), "ts", F.concat(F.when(F.col("user_id") % 2 == 0, "-").otherwise(""), pct).alias("percentage"), F.col("value").alias("depth"), (F.col("value") * 100).alias("notional"))


_QUOTES = "quotes as (select event_type as symbol, ts, event_id as update_id, value as b, value + 0.5 + user_id % 10 as a, (user_id % 7)::double as bq, (user_id % 5)::double as aq, date_trunc('hour', ts) as minute from events)"


def _quotes(spark, d, symbol: str = "event_type"):
    return table(spark, d, "events").select(F.col(symbol).alias("symbol"), "ts", F.col("event_id").alias("update_id"), F.col("value").alias("best_bid_price"), (F.col("user_id") % 7).cast("double").alias("best_bid_qty"), (F.col("value") + 0.5 + F.col("user_id") % 10).alias("best_ask_price"), (F.col("user_id") % 5).cast("double").alias("best_ask_qty"))


_TICKER = f"""{_QUOTES.replace("'hour'", "'minute'")}, q as (select *, (a + b) / 2 as mid, a - b as sp, coalesce((b <> lag(b) over w)::bigint, 0) as cb, coalesce((a <> lag(a) over w)::bigint, 0) as ca from quotes window w as (partition by symbol, ts::date order by ts, update_id)),
  m as (select symbol, minute, arg_max(b, (ts, update_id)) as best_bid, arg_max(a, (ts, update_id)) as best_ask, arg_max(bq, (ts, update_id)) as best_bid_qty, arg_max(aq, (ts, update_id)) as best_ask_qty, arg_max(mid, (ts, update_id)) as mid_price, arg_max(sp, (ts, update_id)) as spread, arg_max(struct_pack(v := sp / nullif(mid, 0) * 100), (ts, update_id)).v as spread_pct,
    min(sp) as spread_min, max(sp) as spread_max, avg(sp) as spread_avg, stddev_samp(sp) as spread_std, max(mid) - min(mid) as mid_price_range, stddev_samp(mid) as mid_price_std, arg_min(mid, (ts, update_id)) as f, sum(cb)::bigint as best_bid_changes, sum(ca)::bigint as best_ask_changes,
    count(*) as tick_count, avg(bq) as best_bid_qty_avg, max(bq) as best_bid_qty_max, avg(aq) as best_ask_qty_avg, max(aq) as best_ask_qty_max from q group by 1, 2)"""
_TCOLS = ("best_bid", "best_ask", "best_bid_qty", "best_ask_qty", "mid_price", "spread", "spread_pct", "spread_min", "spread_max", "spread_avg", "spread_std", "mid_price_range", "mid_price_std", "best_bid_qty_avg", "best_bid_qty_max", "best_ask_qty_avg", "best_ask_qty_max")
_TSEL = ", ".join(f"round({c}, 6) as {c}" for c in _TCOLS) + ", best_bid_changes, best_ask_changes, tick_count, round(case when f > 0 then (mid_price - f) / f else 0.0 end, 6) as price_momentum, round(case when best_bid_qty + best_ask_qty > 0 then (best_bid * best_ask_qty + best_ask * best_bid_qty) / (best_bid_qty + best_ask_qty) else mid_price end, 6) as microprice"


@query(f"with {_TICKER} select symbol, minute, {_TSEL} from m")
def ticker_minutes(spark, d):
    return rounded(B.ticker_minutes(_quotes(spark, d)))


@query(f"with {_DEPTH}, {_TICKER}, dm as (select distinct symbol, minute from depth where value_ok), z as (select symbol, minute, mid_price, tick_count from m where tick_count > 1) select dm.symbol, dm.minute, z.minute is not null as has_ticker, round(z.mid_price, 6) as mid_price, z.tick_count from dm left join z on z.symbol = dm.symbol and z.minute = dm.minute".replace("depth where value_ok", "depth"))
def depth_with_ticker(spark, d):
    ticker = B.ticker_minutes(_quotes(spark, d)).where("tick_count > 1")
    return rounded(B.combined(B.depth_minutes(_depth(spark, d)), ticker).select("symbol", "minute", F.col("tick_count").isNotNull().alias("has_ticker"), "mid_price", "tick_count"))


@query(f"with {_DEPTH} select distinct symbol, minute::date as day, strftime(minute, '%Y-%m') as month from (select symbol, minute, count(*) filter (where percentage = '-5.00' and ts = l) as n, count(*) filter (where percentage = '5.00' and ts = l) as k from (select *, max(ts) over (partition by symbol, minute) as l from depth) group by 1, 2) where n = 0 and k > 0")
def depth_days_missing(spark, d):
    return B.days_missing(B.depth_minutes(_depth(spark, d)), "ask_depth_5pct", "bid_depth_5pct")
