"""Resampling and the indicators, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import bars as B
from tickloom.operators import indicators as I
from tickloom.operators import kernels as K
from tickloom.plans.base import BARS, TICKS, bars_sql, hourly, query, rounded, table, ticks

FIELDS = ["symbol", "ts", "open", "high", "low", "close", "volume", "trades"]


def _bars_oracle(start: str) -> str:
    return f"with {bars_sql(start)} select symbol, ts, round(open, 6) as open, round(high, 6) as high, round(low, 6) as low, round(close, 6) as close, round(volume, 6) as volume, trades from bars"


def _add_bars(name: str, timeframe: str, start: str) -> None:
    query(_bars_oracle(start), name)(lambda spark, d: rounded(hourly(spark, d, timeframe).select(*FIELDS)))


_add_bars("bars_1h", "1h", "date_trunc('hour', ts)")
_add_bars("bars_1d", "1d", "date_trunc('day', ts)")
_add_bars("bars_4h", "4h", "date_trunc('day', ts) + interval '4 hours' * (extract(hour from ts)::int // 4)")
_add_bars("bars_15m", "15m", "date_trunc('hour', ts) + interval '15 minutes' * (extract(minute from ts)::int // 15)")


@query(f"with {BARS} select symbol, date_trunc('day', ts) as ts, arg_min(open, ts) as open, max(high) as high, min(low) as low, arg_max(close, ts) as close, round(sum(volume), 6) as volume from bars group by 1, 2")
def resample_1h_to_1d(spark, d):
    return rounded(B.resample(hourly(spark, d), "1d").select(*FIELDS[:-1]))


@query("select l_returnflag as symbol, date_trunc('day', l_shipdate) as ts, round(arg_max(l_extendedprice / l_quantity, (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey)), 9) as close, round(sum(l_quantity), 6) as volume from lineitem group by 1, 2")
def bars_close_volume(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("symbol"), F.col("l_shipdate").alias("ts"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").alias("volume"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return rounded(B.from_ticks(rows, "1d", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]).select("symbol", "ts", "close", "volume"), 9)


@query(f"with {BARS} select symbol, ts, close from bars where ts + interval '1 hour' <= (select max(ts) from ticks)")
def last_complete(spark, d):
    now = ticks(spark, d).agg(F.max("ts").alias("now"))
    return B.complete(hourly(spark, d).crossJoin(F.broadcast(now)), "1h", F.col("now")).select("symbol", "ts", "close")


@query(f"""with {BARS}, marked as (
  select *, close is not null and open > 0 and high > 0 and low > 0 and close > 1 and high >= low and volume >= 0 and trades > 1 as ok from bars)
select symbol, count(*) filter (where ok) as valid, count(*) filter (where not ok) as rejected from marked group by symbol""")
def candle_validation(spark, d):
    bars = hourly(spark, d).withColumn("close", F.when((F.col("close") > 1) & (F.col("trades") > 1), F.col("close")))
    good, bad = B.valid(bars)
    both = good.select("symbol", F.lit(1).alias("v"), F.lit(0).alias("r")).unionByName(bad.select("symbol", F.lit(0).alias("v"), F.lit(1).alias("r")))
    return both.groupBy("symbol").agg(F.sum("v").alias("valid"), F.sum("r").alias("rejected"))


def _w(n: int) -> str:
    return f"over (partition by symbol order by ts rows between {n - 1} preceding and current row)"


def _f(fn: str, c: str, n: int) -> str:
    """A guarded rolling value."""
    return f"case when count({c}) {_w(n)} >= {n} then {fn}({c}) {_w(n)} end"


LAG = "over (partition by symbol order by ts)"


@query(f"with {BARS} select symbol, ts, " + ", ".join(f"round({_f('avg', 'close', p)}, 6) as sma_{p}" for p in (10, 30, 50, 100, 200)) + " from bars")
def sma(spark, d):
    return rounded(I.sma(hourly(spark, d), [10, 30, 50, 100, 200]).select("symbol", "ts", *[f"sma_{p}" for p in (10, 30, 50, 100, 200)]))


@query(f"with {BARS} select symbol, ts, " + ", ".join(f"round({_f('avg', 'volume', p)}, 6) as vma_{p}" for p in (10, 20, 50)) + " from bars")
def vma(spark, d):
    return rounded(I.vma(hourly(spark, d), [10, 20, 50]).select("symbol", "ts", "vma_10", "vma_20", "vma_50"))


_BB = "bollinger_bands_sma_20_2_0"


def _bands_sql(base: str, p: str, m: str = "m", s: str = "s", k: str = "2.0") -> str:
    return f"""select symbol, ts, round({m} + {k} * {s}, 6) as {p}_upper, round({m}, 6) as {p}_middle, round({m} - {k} * {s}, 6) as {p}_lower,
  round((close - ({m} - {k} * {s})) / nullif(2 * {k} * {s}, 0), 6) as {p}_percent_b, round(2 * {k} * {s} / nullif({m}, 0) * 100, 6) as {p}_bandwidth,
  2 * {k} * {s} / nullif({m}, 0) * 100 < 5.0 as {p}_squeeze from {base}"""


@query(f"with {BARS}, x as (select *, {_f('avg', 'close', 20)} as m, {_f('stddev_samp', 'close', 20)} as s from bars) " + _bands_sql("x", _BB))
def bollinger_1h(spark, d):
    return rounded(I.bollinger(hourly(spark, d), 20, 2.0).select("symbol", "ts", *[f"{_BB}_{x}" for x in ("upper", "middle", "lower", "percent_b", "bandwidth", "squeeze")]))


@query(f"""with {BARS}, x as (select symbol, ts, (close - {_f('min', 'low', 14)}) / nullif({_f('max', 'high', 14)} - {_f('min', 'low', 14)}, 0) * 100 as raw from bars),
  k as (select symbol, ts, {_f('avg', 'raw', 3)} as k from x)
select symbol, ts, round(k, 6) as stoch_14_3_3_k, round({_f('avg', 'k', 3)}, 6) as stoch_14_3_3_d from k""")
def stochastic(spark, d):
    return rounded(I.stochastic(hourly(spark, d), 14, 3, 3).select("symbol", "ts", "stoch_14_3_3_k", "stoch_14_3_3_d"))


@query(f"with {BARS} select symbol, ts, " + ", ".join(f"round((close - {_f('max', 'high', p)}) / nullif({_f('max', 'high', p)} - {_f('min', 'low', p)}, 0) * 100, 6) as williamsr_{p}" for p in (6, 10, 14, 20, 30)) + " from bars")
def williams_r(spark, d):
    return rounded(I.williams_r(hourly(spark, d), [6, 10, 14, 20, 30]).select("symbol", "ts", *[f"williamsr_{p}" for p in (6, 10, 14, 20, 30)]))


_ICH = "ichimoku_base"


@query(f"""with {BARS}, a as (select symbol, ts, close, {"".join(f"({_f('max', 'high', p)} + {_f('min', 'low', p)}) / 2 as {n}, " for p, n in ((9, 't'), (26, 'k'), (52, 'sb')))} 0 as z from bars),
  b as (select *, lag(t) {LAG} as pt, lag(k) {LAG} as pk, lag((t + k) / 2, 26) {LAG} as ca, lag(sb, 26) {LAG} as cb from a)
select symbol, ts, round(t, 6) as {_ICH}_tenkan, round(k, 6) as {_ICH}_kijun, round(ca, 6) as {_ICH}_senkou_a, round(cb, 6) as {_ICH}_senkou_b, round(close, 6) as {_ICH}_chikou,
  round(abs(ca - cb) / nullif(close, 0) * 100, 6) as {_ICH}_cloud_thick,
  (case when close > greatest(ca, cb) then 1 when close < least(ca, cb) then -1 else 0 end)::smallint as {_ICH}_price_cloud,
  (case when t > k and pt <= pk then 1 when t < k and pt >= pk then -1 else 0 end)::smallint as {_ICH}_tk_cross from b""")
def ichimoku(spark, d):
    cols = ("tenkan", "kijun", "senkou_a", "senkou_b", "chikou", "cloud_thick", "price_cloud", "tk_cross")
    return rounded(I.ichimoku(hourly(spark, d), name="base").select("symbol", "ts", *[f"{_ICH}_{c}" for c in cols]))


@query(f"""with {BARS}, a as (select *, (high + low + close) / 3 as tp from bars), b as (select *, tp - lag(tp) {LAG} as dt from a),
  c as (select symbol, ts, case when dt > 0 then tp * volume else 0.0 end as pos, case when dt < 0 then tp * volume else 0.0 end as neg from b),
  e as (select symbol, ts, {", ".join(f"{_f('sum', 'pos', p)} as p{p}, {_f('sum', 'neg', p)} as n{p}" for p in (7, 14, 25))} from c)
select symbol, ts, {", ".join(f"round(case when p{p} = 0 and n{p} = 0 then null when n{p} = 0 then 100.0 when p{p} = 0 then 0.0 else 100 - 100 / (1 + p{p} / n{p}) end, 6) as mfi_{p}" for p in (7, 14, 25))} from e""")
def mfi(spark, d):
    return rounded(I.mfi(hourly(spark, d), [7, 14, 25]).select("symbol", "ts", "mfi_7", "mfi_14", "mfi_25"))


@query(f"""with {BARS}, a as (select *, (high + low + close) / 3 as tp from bars)
select symbol, ts, round(case when volume > 0 then sum(case when volume > 0 then tp * volume end) w / nullif(sum(case when volume > 0 then volume end) w, 0) end, 6) as vwap_daily
from a window w as (partition by symbol, ts::date order by ts rows between unbounded preceding and current row)""".replace("end) w", "end) over w"))
def vwap_daily(spark, d):
    return rounded(I.vwap_daily(hourly(spark, d)).select("symbol", "ts", "vwap_daily"))


@query(f"with {BARS}, a as (select *, (high + low + close) / 3 * volume as pv from bars) select symbol, ts, " + ", ".join(f"round(({_f('sum', 'pv', n)}) / nullif({_f('sum', 'volume', n)}, 0), 8) as vwap_{n}" for n in (10, 14, 50, 100)) + " from a")
def vwap_rolling(spark, d):
    return rounded(I.vwap_rolling(hourly(spark, d), [10, 14, 50, 100]).select("symbol", "ts", "vwap_10", "vwap_14", "vwap_50", "vwap_100"), 8)


_HV = f"{BARS}, r as (select symbol, ts, ln(close / nullif(lag(close) {LAG}, 0)) as r from bars), hv as (select symbol, ts, " + ", ".join(f"({_f('stddev_samp', 'r', p)}) * sqrt(8760.0) * 100 as hv_{p}" for p in (7, 14, 30, 60)) + " from r)"


@query(f"with {_HV} select symbol, ts, " + ", ".join(f"round(hv_{p}, 6) as hv_{p}" for p in (7, 14, 30, 60)) + ", round(hv_7 / nullif(hv_30, 0), 6) as hv_ratio_7_30 from hv")
def historical_volatility(spark, d):
    return rounded(I.historical_volatility(hourly(spark, d), [7, 14, 30, 60], "1h").select("symbol", "ts", "hv_7", "hv_14", "hv_30", "hv_60", "hv_ratio_7_30"))


_BEFORE = "partition by symbol order by ts rows between 168 preceding and 1 preceding"


@query(f"""with {_HV}, s as (select symbol, ts, round(hv_30, 6) as hv_30 from hv), a as (select symbol, ts, hv_30, list(hv_30) over ({_BEFORE}) as seen, row_number() {LAG} as rn from s)
select symbol, ts, round(case when rn > 168 and hv_30 is not null then 100.0 * len(list_filter(seen, lambda x: x < hv_30)) / nullif(len(list_filter(seen, lambda x: x is not null)), 0) end, 6) as hv_percentile_7d from a""")
def hv_percentile(spark, d):
    hv = rounded(I.historical_volatility(hourly(spark, d), [30], "1h").select("symbol", "ts", "hv_30"))
    return rounded(K.add_percentile(hv, "hv_30", 168, "hv_percentile_7d").select("symbol", "ts", "hv_percentile_7d"))


@query(f"""with {BARS}, a as (select symbol, ts, close, list(close) {_w(100)} as seen from bars)
select symbol, ts, round(case when len(seen) >= 24 then 100.0 * len(list_filter(seen, lambda x: x < close)) / len(seen) end, 6) as rank_100 from a""")
def rolling_percentile(spark, d):
    return rounded(I.percentile_in_window(hourly(spark, d), "close", 100, 24, "rank_100").select("symbol", "ts", "rank_100"))


@query(f"with {BARS} select symbol, ts, round((close - {_f('avg', 'close', 72)}) / nullif({_f('stddev_samp', 'close', 72)}, 0), 6) as z_72 from bars")
def z_score(spark, d):
    return rounded(I.z_score(hourly(spark, d), "close", 72, "z_72").select("symbol", "ts", "z_72"))


@query(f"with {BARS} select symbol, ts, round(close - lag(close, 24) {LAG}, 6) as change_24, round((close / nullif(lag(close, 24) {LAG}, 0) - 1) * 100, 6) as roc_24 from bars")
def momentum(spark, d):
    return rounded(I.momentum(hourly(spark, d)).select("symbol", "ts", "change_24", "roc_24"))


@query(f"""with {BARS}, m as (select a.ts, a.close as a, b.close as b from bars a join bars b on a.ts = b.ts and a.symbol = 'click' and b.symbol = 'view')
select ts, round(a, 6) as a, round(b, 6) as b, round(b - a, 6) as spread, round(b / nullif(a, 0), 6) as ratio,
  round(case when count(*) over w >= 24 then corr(a, b) over w end, 6) as corr from m window w as (order by ts rows between 23 preceding and current row)""")
def cross_series(spark, d):
    bars = hourly(spark, d).select("symbol", "ts", F.col("close").alias("x"))
    return rounded(I.cross_series(bars.where("symbol = 'click'"), bars.where("symbol = 'view'")))


@query(f"""with {_HV}, iv as (select symbol, ts, close as iv from bars where symbol in ('click', 'view'))
select i.symbol, i.ts, round(iv - hv_30, 6) as iv_hv_spread, round(iv / nullif(hv_30, 0), 6) as iv_hv_ratio from iv i left join hv on hv.symbol = i.symbol and hv.ts = i.ts""")
def iv_hv_spread(spark, d):
    bars = hourly(spark, d)
    hv = I.historical_volatility(bars, [30], "1h").select("symbol", "ts", "hv_30")
    iv = bars.where(F.col("symbol").isin("click", "view")).select("symbol", "ts", F.col("close").alias("iv"))
    return rounded(iv.join(hv, ["symbol", "ts"], "left").select("symbol", "ts", (F.col("iv") - F.col("hv_30")).alias("iv_hv_spread"), F.try_divide("iv", "hv_30").alias("iv_hv_ratio")))


_TR = f"case when lag(close) {LAG} is null then high - low else greatest(high - low, abs(high - lag(close) {LAG}), abs(low - lag(close) {LAG})) end"


@query(f"with {BARS} select symbol, ts, round({_TR}, 6) as tr from bars")
def true_range(spark, d):
    return rounded(I.true_range(hourly(spark, d)).select("symbol", "ts", "tr"))


@query(f"""with {BARS}, a as (select symbol, ts, high - lag(high) {LAG} as u, lag(low) {LAG} - low as v from bars)
select symbol, ts, round(case when u > v and u > 0 then u else 0.0 end, 6) as plus_dm, round(case when v > u and v > 0 then v else 0.0 end, 6) as minus_dm from a""")
def directional_movement(spark, d):
    return rounded(I.directional_movement(hourly(spark, d)).select("symbol", "ts", "plus_dm", "minus_dm"))


@query(f"with {BARS}, a as (select symbol, ts, coalesce(sign(close - lag(close) {LAG}), 0) * volume as s from bars) select symbol, ts, round(sum(s) over (partition by symbol order by ts rows between unbounded preceding and current row), 6) as obv from a")
def obv(spark, d):
    return rounded(I.obv(hourly(spark, d)).select("symbol", "ts", "obv"))


# Recursive indicators: the SQL walks each symbol's rows by number.
_N = f"{BARS}, n as (select *, row_number() {LAG} as rn, count(*) over (partition by symbol) as cnt from bars)"


def _walk(columns: str, first: str, step: str) -> str:
    """A recursive walk e(symbol, rn, columns...) from each symbol's first row; step refers to n and e."""
    return f"e(symbol, rn, {columns}) as (select symbol, rn, {first} from n where rn = 1 union all select n.symbol, n.rn, {step} from e join n on n.symbol = e.symbol and n.rn = e.rn + 1)"


def _ema_sql(p: int, x: str, e: str) -> str:
    return f"2.0 / ({p} + 1) * {x} + (1 - 2.0 / ({p} + 1)) * {e}"


_EMAS = (9, 12, 26, 50)


@query(f"with recursive {_N}, {_walk(', '.join(f'e{p}' for p in _EMAS), ', '.join('close' for _ in _EMAS), ', '.join(_ema_sql(p, 'n.close', f'e.e{p}') for p in _EMAS))} select n.symbol, n.ts, " + ", ".join(f"round(case when n.rn >= {p} then e{p} end, 6) as ema_{p}" for p in _EMAS) + " from e join n on n.symbol = e.symbol and n.rn = e.rn")
def ema(spark, d):
    return rounded(K.add_ema(hourly(spark, d), list(_EMAS)).drop("close"))


@query(f"with recursive {_N}, {_walk('e12', 'close', _ema_sql(12, 'n.close', 'e.e12'))} select n.symbol, n.ts, round(e12, 6) as ema_12 from e join n on n.symbol = e.symbol and n.rn = e.rn where n.rn > 100")
def ema_from_checkpoint(spark, d):
    from pyspark.sql import Window

    bars = hourly(spark, d).withColumn("rn", F.row_number().over(Window.partitionBy("symbol").orderBy("ts")))
    old = K.grouped(bars.where("rn <= 100"), ["close"], {"ema": "double"}, lambda c: {"ema": K.ema(c["close"], 12, False)})
    state = old.groupBy("symbol").agg(F.max_by("ema", "ts").alias("ema"))
    return rounded(K.resume_ema(bars.where("rn > 100"), state, 12).drop("close"))


@query(f"with recursive {_N}, {_walk('f, s, g', 'close, close, 0.0::double', _ema_sql(12, 'n.close', 'e.f') + ', ' + _ema_sql(26, 'n.close', 'e.s') + ', ' + _ema_sql(9, '((' + _ema_sql(12, 'n.close', 'e.f') + ') - (' + _ema_sql(26, 'n.close', 'e.s') + '))', 'e.g'))} select n.symbol, n.ts, round(f - s, 6) as macd_12_26_9_line, round(g, 6) as macd_12_26_9_signal, round(f - s - g, 6) as macd_12_26_9_histogram from e join n on n.symbol = e.symbol and n.rn = e.rn")
def macd(spark, d):
    return rounded(K.add_macd(hourly(spark, d)).drop("close"))


_BBE = "bollinger_bands_ema_20_2_0"


@query(f"with recursive {_N}, {_walk('m', 'close', _ema_sql(20, 'n.close', 'e.m'))}, y as (select n.symbol, n.ts, n.close, {_f('stddev_samp', 'n.close', 20).replace('partition by symbol order by ts', 'partition by n.symbol order by n.ts')} as s, e.m as m0 from e join n on n.symbol = e.symbol and n.rn = e.rn), x as (select *, case when s is not null then m0 end as m from y) " + _bands_sql("x", _BBE))
def bollinger_ema(spark, d):
    close = I.bands
    bars = hourly(spark, d)
    base = K.grouped(bars, ["close"], {"_m": "double"}, lambda c: {"_m": K.ema(c["close"], 20, False)})
    from tickloom.functions import rolling as r

    base = base.withColumn("_s", r.std("close", 20))
    cols = close(F.col("_m"), F.col("_s"), F.col("close"), 2.0)
    return rounded(base.select("symbol", "ts", *[c.alias(f"{_BBE}_{n}") for n, c in cols.items()]))


_RSI = f"""{_N}, g as (select symbol, ts, rn, cnt, greatest(close - lag(close) {LAG}, 0) as up, greatest(lag(close) {LAG} - close, 0) as dn from n),
  seed as (select symbol, avg(up) as au, avg(dn) as ad from g where rn between 2 and 15 group by symbol),
  e(symbol, rn, au, ad) as (select s.symbol, 15::bigint, au, ad from seed s union all select g.symbol, g.rn, (e.au * 13 + g.up) / 14, (e.ad * 13 + g.dn) / 14 from e join g on g.symbol = e.symbol and g.rn = e.rn + 1),
  v as (select symbol, rn, case when ad = 0 then 100 else 100 - 100 / (1 + au / ad) end as rsi from e where rn > 15),
  o as (select g.symbol, g.ts, v.rsi from g left join v on v.symbol = g.symbol and v.rn = g.rn)"""


@query(f"with recursive {_RSI} select symbol, ts, round(rsi, 6) as rsi_14 from o")
def rsi(spark, d):
    return rounded(K.add_rsi(hourly(spark, d), [14]).drop("close"))


@query(f"with recursive {_RSI} select symbol, ts, round({_f('avg', 'rsi', 10)}, 6) as rsi_14_sma_10 from o")
def rsi_smoothed(spark, d):
    from tickloom.functions import rolling as r

    return rounded(K.add_rsi(hourly(spark, d), [14]).select("symbol", "ts", r.mean("rsi_14", 10).alias("rsi_14_sma_10")))


_ATR = f"""{_N}, t as (select symbol, ts, rn, close, high, low, {_TR} as tr from n),
  seed as (select symbol, avg(tr) as a from t where rn <= 14 group by symbol having count(*) = 14),
  e(symbol, rn, a) as (select symbol, 14::bigint, a from seed union all select t.symbol, t.rn, (e.a * 13 + t.tr) / 14 from e join t on t.symbol = e.symbol and t.rn = e.rn + 1)"""


@query(f"with recursive {_ATR} select t.symbol, t.ts, round(a, 6) as atr_14, round(case when close > 0 then a / close * 100 end, 6) as natr_14 from t left join e on e.symbol = t.symbol and e.rn = t.rn")
def atr(spark, d):
    return rounded(K.add_atr(hourly(spark, d), [14]).drop("high", "low", "close"))


@query(f"""with recursive {_N}, t as (select symbol, ts, rn, {_TR} as tr, high - lag(high) {LAG} as u, lag(low) {LAG} - low as v from n),
  m as (select symbol, ts, rn, tr, case when u > v and u > 0 then u else 0.0 end as p, case when v > u and v > 0 then v else 0.0 end as q from t),
  e(symbol, rn, t, p, q) as (select symbol, 14::bigint, avg(tr), avg(p), avg(q) from m where rn <= 14 group by symbol having count(*) = 14
    union all select m.symbol, m.rn, (e.t * 13 + m.tr) / 14, (e.p * 13 + m.p) / 14, (e.q * 13 + m.q) / 14 from e join m on m.symbol = e.symbol and m.rn = e.rn + 1),
  di as (select symbol, rn, 100 * p / nullif(t, 0) as pdi, 100 * q / nullif(t, 0) as mdi from e),
  dx as (select symbol, rn, pdi, mdi, case when pdi + mdi > 0 then 100 * abs(pdi - mdi) / (pdi + mdi) end as dx from di),
  a(symbol, rn, adx) as (select symbol, rn, dx from dx where rn = 14 union all select dx.symbol, dx.rn, (a.adx * 13 + dx.dx) / 14 from a join dx on dx.symbol = a.symbol and dx.rn = a.rn + 1)
select m.symbol, m.ts, round(a.adx, 6) as adx_14, round(pdi, 6) as adx_14_plus_di, round(mdi, 6) as adx_14_minus_di
from m left join dx on dx.symbol = m.symbol and dx.rn = m.rn left join a on a.symbol = m.symbol and a.rn = m.rn""")
def adx(spark, d):
    return rounded(K.add_adx(hourly(spark, d), [14]).drop("high", "low", "close"))


@query(f"""with recursive {_ATR}, b as (select t.symbol, t.ts, t.rn, t.close, lag(t.close) over (partition by t.symbol order by t.ts) as pc, (high + low) / 2 + 2.5 * a as ub, (high + low) / 2 - 2.5 * a as lb from t join e on e.symbol = t.symbol and e.rn = t.rn),
  s(symbol, rn, u, v, dir) as (select symbol, rn, ub, lb, case when close <= ub then -1 else 1 end from b where rn = 14
    union all select symbol, rn, u, v, case when pd = -1 then case when close > u then 1 else -1 end else case when close < v then -1 else 1 end end from (
      select b.symbol, b.rn, b.close, s.dir as pd, case when b.ub < s.u or b.pc > s.u then b.ub else s.u end as u, case when b.lb > s.v or b.pc < s.v then b.lb else s.v end as v
      from s join b on b.symbol = s.symbol and b.rn = s.rn + 1))
select t.symbol, t.ts, round(case when dir = 1 then v when dir = -1 then u end, 6) as supertrend_p14_m25, coalesce(dir, 0)::smallint as supertrend_p14_m25_dir, round(u, 6) as supertrend_p14_m25_upper, round(v, 6) as supertrend_p14_m25_lower
from t left join s on s.symbol = t.symbol and s.rn = t.rn""")
def supertrend(spark, d):
    return rounded(K.add_supertrend(hourly(spark, d), [(14, 2.5)]).drop("high", "low", "close"))


# More configurations, and the set of a volatility index (here of quarter-hour bars).
#: Period and deviations of the band settings on a simple mean.
BANDS = [(3, 2.0), (5, 2.0), (10, 1.5), (14, 2.0), (20, 1.0), (20, 1.618), (20, 2.0), (20, 3.0), (21, 2.0), (34, 2.0), (89, 2.0)]


def _band(p: int, k: float) -> str:
    return f"bollinger_bands_sma_{p}_{str(k).replace('.', '_')}"


def _band_columns(p: int, k: float) -> str:
    m, s, n = f"m{p}", f"s{p}", _band(p, k)
    return f"""round({m} + {k} * {s}, 6) as {n}_upper, round({m} - {k} * {s}, 6) as {n}_lower, round(2 * {k} * {s} / nullif({m}, 0) * 100, 6) as {n}_bandwidth, 2 * {k} * {s} / nullif({m}, 0) * 100 < 5.0 as {n}_squeeze"""


@query(f"with {BARS}, x as (select *, {', '.join(f'{_f("avg", "close", p)} as m{p}, {_f("stddev_samp", "close", p)} as s{p}' for p in sorted({p for p, _ in BANDS}))} from bars) select symbol, ts, {', '.join(_band_columns(p, k) for p, k in BANDS)} from x")
def bollinger_settings(spark, d):
    bars = hourly(spark, d)
    for p, k in BANDS:
        bars = I.bollinger(bars, p, k)
    return rounded(bars.select("symbol", "ts", *[f"{_band(p, k)}_{x}" for p, k in BANDS for x in ("upper", "lower", "bandwidth", "squeeze")]))


@query(f"""with {BARS}, x as (select *, {_f('avg', 'close', 5)} as m, {_f('stddev_samp', 'close', 5)} as s from bars), b as (select *, 4.0 * s / nullif(m, 0) * 100 as w, m + 2.0 * s as u, m - 2.0 * s as l from x),
  n as (select *, row_number() over (partition by symbol order by ts desc) as n from b where w < 5.0 * 8 and ts >= timestamp '2024-01-10') select symbol, ts, round(close, 6) as close, round(w, 6) as bandwidth, round(u, 6) as upper, round(l, 6) as lower from n where n <= 20""")
def squeeze_events(spark, d):
    name = _band(5, 2.0)
    banded = I.bollinger(hourly(spark, d), 5, 2.0).withColumn(f"{name}_squeeze", F.col(f"{name}_bandwidth") < 40.0)
    return rounded(I.squeeze_events(banded, name, F.lit("2024-01-10").cast("timestamp_ntz")))


@query(f"""with {BARS}, a as (select symbol, ts, high - low as v, open as p, close as m from bars) select symbol, ts, case when v < 25 then 'Weak/Absent trend (sideways)' when v < 50 then 'Strong trend' when v < 75 then 'Very strong trend' else 'Extremely strong trend (possible exhaustion)' end as strength,
  case when p > m then 'Bullish' else 'Bearish' end as direction, case when abs(p - m) < 5 then 'Weak direction' when abs(p - m) < 15 then 'Moderate direction' when abs(p - m) < 30 then 'Strong direction' else 'Very strong direction' end as direction_strength from a""")
def adx_texts(spark, d):
    a = hourly(spark, d).select("symbol", "ts", (F.col("high") - F.col("low")).alias("v"), F.col("open").alias("p"), F.col("close").alias("m"))
    return a.select("symbol", "ts", I.adx_strength("v").alias("strength"), *[c.alias(n) for n, c in I.trend_direction("p", "m").items()])


_QUARTERS = bars_sql("date_trunc('hour', ts) + interval '15 minutes' * (extract(minute from ts)::int // 15)")


def _rank_sql(n: int, least: int) -> str:
    return f"case when len(list(close) {_w(n)}) >= {least} then 100.0 * len(list_filter(list(close) {_w(n)}, lambda x: x < close)) / len(list(close) {_w(n)}) end"


@query(f"""with {_QUARTERS}, x as (select symbol, ts, close, {_f('avg', 'close', 24)} as sma_24, {_f('avg', 'close', 168)} as sma_168, lag(close, 24) {LAG} as p24, {_f('avg', 'close', 720)} as m, {_f('stddev_samp', 'close', 720)} as s,
  {_f('avg', 'close', 20)} as bm, {_f('stddev_samp', 'close', 20)} as bs, {_rank_sql(720, 168)} as r30, {_rank_sql(2160, 720)} as r90 from bars)
select symbol, ts, round(sma_24, 6) as sma_24, round(sma_168, 6) as sma_168, round(close - p24, 6) as change_24, round((close / nullif(p24, 0) - 1) * 100, 6) as roc_24, round((close - m) / nullif(s, 0), 6) as zscore_30d,
  round(bm + 2.0 * bs, 6) as bb_upper, round(bm - 2.0 * bs, 6) as bb_lower, round((close - (bm - 2.0 * bs)) / nullif(4.0 * bs, 0), 6) as bb_pct_b, round(r30, 6) as percentile_30d, round(r90, 6) as percentile_90d from x""")
def volatility_index(spark, d):
    bars = hourly(spark, d, "15m")
    ranks = K.add_rank(bars, "close", {"percentile_30d": (720, 168), "percentile_90d": (2160, 720)}).drop("close")
    name = _band(20, 2.0)
    out = I.bollinger(I.z_score(I.momentum(I.sma(bars, [24, 168])), "close", 720, "zscore_30d"), 20, 2.0)
    out = out.select("symbol", "ts", "sma_24", "sma_168", "change_24", "roc_24", "zscore_30d", *[F.col(f"{name}_{a}").alias(b) for a, b in (("upper", "bb_upper"), ("lower", "bb_lower"), ("percent_b", "bb_pct_b"))])
    return rounded(out.join(ranks, ["symbol", "ts"]))
