"""Option-chain metrics over a chain derived from lineitem: a monthly snapshot for each return flag."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import options as O
from tickloom.plans.base import query, rounded
from tickloom.plans.relational_queries import run_sql

_CHAIN = """select l_returnflag as currency, make_date(cast(extract(year from l_shipdate) as int), cast(extract(month from l_shipdate) as int), 1) as day,
  concat(cast(l_orderkey as varchar(20)), '-', cast(l_linenumber as varchar(20)), '-', cast(l_partkey as varchar(20)), '-', cast(l_suppkey as varchar(20))) as instrument,
  cast(l_partkey % 5 * 9 + l_partkey % 3 as int) as days, cast(50 + l_suppkey % 20 * 5 as double) as strike,
  case when l_linestatus = 'O' then 'call' else 'put' end as option_type, 20 + l_discount * 300 + cast(l_partkey % 97 as double) / 10 as mark_iv,
  (case when l_linestatus = 'O' then 1 else -1 end) * (0.02 + cast(l_partkey % 89 as double) / 100) as delta, 0.001 + l_discount / 10 as gamma, l_tax + 0.01 as vega,
  l_quantity as open_interest, l_quantity * 2 + l_linenumber as volume_24h, l_discount - 0.01 as best_bid_price, l_discount + l_tax as best_ask_price,
  95 + cast(extract(month from l_shipdate) as double) as underlying_price from lineitem"""
_FIELDS = "currency, {ts} as ts, instrument, {exp} as expiration, strike, option_type, mark_iv, delta, gamma, vega, open_interest, volume_24h, best_bid_price, best_ask_price, underlying_price"
CHAIN = f"chain as (select {_FIELDS.format(ts='day::timestamp', exp='day + days')} from ({_CHAIN}) x), u as (select currency, ts, arg_min(underlying_price, instrument) as S from chain group by 1, 2)"
_K = "currency, ts"


def chain(spark, d):
    return run_sql(spark, d, f"select {_FIELDS.format(ts='cast(day as timestamp_ntz)', exp='date_add(day, days)')} from ({_CHAIN}) x")


@query("select s as instrument, split_part(s, '-', 1) as currency, strptime(lpad(split_part(s, '-', 2), 7, '0'), '%d%b%y')::date as expiration, split_part(s, '-', 3)::double as strike, case when split_part(s, '-', 4) = 'C' then 'call' when split_part(s, '-', 4) = 'P' then 'put' end as option_type from (select distinct case when l_linestatus = 'O' then 'BTC' else 'ETH' end || '-' || (1 + l_partkey % 28)::varchar || (case when l_suppkey % 2 = 0 then 'MAR' else 'DEC' end) || '26-' || (l_suppkey * 1000)::varchar || (case when l_tax > 0.04 then '-C' else '-P' end) as s from lineitem) x")
def instrument_parser(spark, d):
    names = run_sql(spark, d, "select distinct concat(case when l_linestatus = 'O' then 'BTC' else 'ETH' end, '-', cast(1 + l_partkey % 28 as string), case when l_suppkey % 2 = 0 then 'MAR' else 'DEC' end, '26-', cast(l_suppkey * 1000 as string), case when l_tax > 0.04 then '-C' else '-P' end) as s from lineitem")
    return names.select(F.col("s").alias("instrument"), *[c.alias(n) for n, c in O.parse_instrument("s").items()])


_C, _P = "filter (where option_type = 'call')", "filter (where option_type = 'put')"
_VOL = f"{CHAIN}, v as (select {_K}, coalesce(sum(volume_24h) {_C}, 0) as volume_calls, coalesce(sum(volume_24h) {_P}, 0) as volume_puts, coalesce(sum(open_interest) {_C}, 0) as oi_calls, coalesce(sum(open_interest) {_P}, 0) as oi_puts from chain group by 1, 2)"


@query(f"with {_VOL} select *, volume_calls + volume_puts as volume_total, oi_calls + oi_puts as oi_total, round(case when volume_calls > 0 then volume_puts / volume_calls end, 6) as put_call_volume, round(case when oi_calls > 0 then oi_puts / oi_calls end, 6) as put_call_oi from v")
def option_volume(spark, d):
    return rounded(O.volume(chain(spark, d)))


_DAILY = "snaps as (select o_orderpriority as currency, date_trunc('day', o_orderdate) + interval '1 hour' * (count(*) % 3) as ts, sum(o_totalprice) as oi from orders group by o_orderpriority, date_trunc('day', o_orderdate))"


@query(f"with {_DAILY} select s.currency, s.ts, round(s.oi, 2) as oi, round((select arg_max(p.oi, p.ts) from snaps p where p.currency = s.currency and p.ts <= s.ts - interval '24 hours' and p.ts >= date_trunc('day', s.ts) - interval '24 hours'), 2) as oi_prev from snaps s")
def option_change_24h(spark, d):
    day = F.window("o_orderdate", "1 day").start
    from tickloom.plans.base import table

    snaps = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("currency"), day.alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("oi"))
    snaps = snaps.select("currency", (F.col("day") + F.make_dt_interval(F.lit(0), (F.col("n") % 3).cast("int"))).alias("ts"), "oi")
    return rounded(O.change_24h(snaps, "oi"), 2)


def _atm_sql(by: str) -> str:
    return f"(select {by}, avg(mark_iv) as atm_iv from (select c.*, row_number() over (partition by {', '.join('c.' + b.strip() for b in by.split(','))} order by abs(strike - S), strike, instrument) as n from chain c join u on u.currency = c.currency and u.ts = c.ts where mark_iv > 0) where n <= 2 group by {by})"


_E = f"{_K}, expiration"


@query(f"with {CHAIN} select {_E}, round(atm_iv, 6) as atm_iv from {_atm_sql(_E)}")
def option_atm_iv(spark, d):
    return rounded(O.atm_iv(chain(spark, d), [*O.SNAPSHOT, "expiration"]))


def _delta_sql(target: float) -> str:
    side = "call" if target > 0 else "put"
    return f"""(select {_E}, case when count(*) >= 2 then coalesce(arg_min(v, i) filter (where v is not null), arg_min(mark_iv, (abs(delta - {target}), i))) end as iv from (
  select *, case when delta <= {target} and d2 >= {target} then case when abs(d2 - delta) < 1e-10 then mark_iv else mark_iv + ({target} - delta) / (d2 - delta) * (v2 - mark_iv) end end as v from (
    select *, lead(delta) over w as d2, lead(mark_iv) over w as v2, row_number() over w as i from chain where option_type = '{side}' and mark_iv > 0 window w as (partition by {_E} order by delta, instrument))) group by {_E})"""


@query(f"with {CHAIN} select {_E}, round(iv, 6) as iv_25 from {_delta_sql(0.25)}")
def option_delta_iv(spark, d):
    return rounded(O.delta_iv(chain(spark, d), 0.25, [*O.SNAPSHOT, "expiration"], "iv_25"))


def _cm_sql(source: str, value: str, days: int) -> str:
    return f"""(select {_K}, case when v1 is not null and v2 is not null then (t2 - {days})::double / (t2 - t1) * v1 + (1 - (t2 - {days})::double / (t2 - t1)) * v2 else coalesce(v1, v2) end as v from (
  select {_K}, max(l) filter (where l <= {days}) as t1, (arg_max(struct_pack(v := {value}), l) filter (where l <= {days})).v as v1, min(l) filter (where l > {days}) as t2, (arg_min(struct_pack(v := {value}), l) filter (where l > {days})).v as v2
  from (select *, expiration - ts::date as l from {source}) where l >= 1 group by 1, 2))"""


_ATM_E = _atm_sql(_E)


@query(f"with {CHAIN} select a.currency, a.ts, round(a.v, 6) as atm_iv_30d, round(p.v - c.v, 6) as skew_25d_30d, round((p.v + c.v) / 2 - a.v, 6) as butterfly_30d from {_cm_sql(_ATM_E, 'atm_iv', 30)} a left join {_cm_sql(_delta_sql(0.25), 'iv', 30)} c on c.currency = a.currency and c.ts = a.ts left join {_cm_sql(_delta_sql(-0.25), 'iv', 30)} p on p.currency = a.currency and p.ts = a.ts")
def option_smile(spark, d):
    return rounded(O.smile(chain(spark, d), 30))


@query(f"with {CHAIN} select a.currency, a.ts, round(a.v - b.v, 6) as term_structure from {_cm_sql(_ATM_E, 'atm_iv', 7)} a join {_cm_sql(_ATM_E, 'atm_iv', 30)} b on b.currency = a.currency and b.ts = a.ts")
def option_term_structure(spark, d):
    return rounded(O.term_structure(chain(spark, d)))


@query(f"""with {CHAIN}, k as (select distinct {_E}, strike as K from chain),
  pain as (select k.currency, k.ts, k.expiration, K, round(sum(case when option_type = 'call' then open_interest * greatest(0, K - strike) else open_interest * greatest(0, strike - K) end), 6) as pain from k join chain c on c.currency = k.currency and c.ts = k.ts and c.expiration = k.expiration group by 1, 2, 3, 4),
  n as (select {_E}, count(*) {_C} as nc, count(*) {_P} as np from chain group by 1, 2, 3)
select p.currency, p.ts, p.expiration, case when max(nc) > 0 and max(np) > 0 then arg_min(K, (pain, K)) end as max_pain from pain p join n on n.currency = p.currency and n.ts = p.ts and n.expiration = p.expiration group by 1, 2, 3""")
def max_pain(spark, d):
    return O.max_pain(chain(spark, d))


@query("with dd as (select distinct o_orderdate::date as day from orders) select day, extract(dow from day) = 5 and extract(month from day + 7) <> extract(month from day) as monthly from dd")
def monthly_expiry(spark, d):
    from tickloom.plans.base import table

    return table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct().select("day", O.monthly_expiry("day").alias("monthly"))


@query(f"with {CHAIN} select c.currency, c.ts, round(sum(case when option_type = 'call' then 1.0 else -1.0 end * gamma * open_interest * S * S * 0.01), 7) as gex, round(sum(case when option_type = 'call' then delta else -abs(delta) end * open_interest), 7) as net_delta, round(sum(gamma * open_interest), 7) as net_gamma, round(sum(vega * open_interest), 7) as vega_exposure from chain c join u on u.currency = c.currency and u.ts = c.ts group by 1, 2")
def option_greeks(spark, d):
    return rounded(O.greeks(chain(spark, d)), 7)


@query(f"with {CHAIN} select {_K}, min(case when expiration - ts::date >= 1 then expiration - ts::date end)::double as days_to_expiry_nearest, round(coalesce(sum(case when expiration - ts::date between 0 and 7 then open_interest * strike end), 0.0), 6) as notional_expiring_7d from chain group by 1, 2")
def option_expiry(spark, d):
    return rounded(O.expiry(chain(spark, d)))


@query(f"with {CHAIN}, s as (select c.currency, c.ts, avg(case when strike between S - S * 0.05 and S + S * 0.05 and best_bid_price > 0 and best_ask_price > 0 then best_ask_price - best_bid_price end) as sp from chain c join u on u.currency = c.currency and u.ts = c.ts group by 1, 2), o as (select {_K}, strike, sum(open_interest) as oi from chain group by 1, 2, 3) select s.currency, s.ts, round(any_value(sp), 6) as bid_ask_spread_avg_atm, arg_max(strike, (oi, -strike)) as max_oi_strike from s join o on o.currency = s.currency and o.ts = s.ts group by 1, 2")
def option_liquidity(spark, d):
    return rounded(O.liquidity(chain(spark, d)))


@query(f"""with {CHAIN}, g as (select {_K}, strike, sum(case when option_type = 'call' then gamma * open_interest else -gamma * open_interest end) * strike * strike * 0.01 as net from chain group by 1, 2, 3),
  p as (select *, lag(strike) over w as k0, lag(net) over w as n0 from g window w as (partition by {_K} order by strike)),
  f as (select p.currency, p.ts, strike, k0 + abs(n0) / abs(net - n0) * (strike - k0) as flip, S from p join u on u.currency = p.currency and u.ts = p.ts where n0 * net < 0)
select u.currency, u.ts, round(arg_min(flip, (abs(flip - f.S), strike)), 6) as gamma_flip_level from u left join f on f.currency = u.currency and f.ts = u.ts group by 1, 2""")
def gamma_flip(spark, d):
    return rounded(O.gamma_flip(chain(spark, d)))


@query(f"with {CHAIN} select c.currency, c.ts, round(arg_min(mark_iv, ((expiration - c.ts::date) * 0.01::double + abs(strike - S) / S, instrument)), 6) as live_atm_iv, round(sum(open_interest), 6) as oi_total from chain c join u on u.currency = c.currency and u.ts = c.ts group by 1, 2")
def option_live_summary(spark, d):
    return rounded(O.live_summary(chain(spark, d)))


@query(f"with {CHAIN}, stored as (select {_K}, case when extract(year from ts) < 1998 then 1.0 end as gex from chain group by 1, 2), last as (select currency, max(ts) as l from stored where gex is not null group by 1) select c.currency, c.ts, count(*) as contracts from chain c left join last on last.currency = c.currency where l is null or c.ts > l group by 1, 2")
def option_pending_group(spark, d):
    rows = chain(spark, d)
    stored = rows.select(*O.SNAPSHOT).distinct().withColumn("gex", F.when(F.year("ts") < 1998, 1.0))
    return O.pending(rows, stored, ["gex"]).groupBy(*O.SNAPSHOT).agg(F.count(F.lit(1)).alias("contracts"))
