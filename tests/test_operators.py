"""Golden sequences and edge fixtures of window indicators, bars, merges and quality."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.operators import bars as B
from tickloom.operators import book as K
from tickloom.operators import derivatives as D
from tickloom.operators import indicators as I
from tickloom.operators import merge as M
from tickloom.operators import options as O
from tickloom.operators import quality as Q
from tickloom.operators.joins import asof_join, interval_join


def frame(spark, **columns):
    n = len(next(iter(columns.values())))
    base = dt.datetime(2024, 1, 1)
    rows = [("s", base + dt.timedelta(minutes=i), *[float(v[i]) for v in columns.values()]) for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, " + ", ".join(f"{c} double" for c in columns))


def values(df, c):
    return [r[0] for r in df.orderBy("ts").select(c).collect()]


def test_sma(spark):
    df = I.sma(frame(spark, close=[10, 20, 30, 40, 50]), [3])
    assert values(df, "sma_3") == [None, None, 20, 30, 40]


def test_obv(spark):
    df = frame(spark, close=[100, 105, 103, 103, 108, 102, 106], volume=[1000, 1500, 800, 1200, 2000, 900, 1100])
    assert values(I.obv(df), "obv") == [0, 1500, 700, 700, 2700, 1800, 2900]


def test_constant_prices(spark):
    flat = frame(spark, open=[100] * 30, high=[100] * 30, low=[100] * 30, close=[100] * 30, volume=[0] * 30)
    b = I.bollinger(flat).orderBy(F.desc("ts")).first()
    n = "bollinger_bands_sma_20_2_0"
    assert b[f"{n}_upper"] == b[f"{n}_lower"] == 100 and b[f"{n}_percent_b"] is None and b[f"{n}_bandwidth"] == 0 and b[f"{n}_squeeze"]
    assert values(I.stochastic(flat), "stoch_14_3_3_k") == [None] * 30
    assert values(I.williams_r(flat, [14]), "williamsr_14") == [None] * 30
    assert values(I.mfi(flat, [14]), "mfi_14") == [None] * 30
    assert values(I.vwap_daily(flat), "vwap_daily") == [None] * 30
    assert values(I.vwap_rolling(flat, [5]), "vwap_5") == [None] * 30


def test_k_and_r_add_to_100(spark):
    df = frame(spark, high=[5, 7, 6, 9, 8, 10], low=[1, 2, 3, 2, 4, 5], close=[3, 6, 4, 8, 5, 9])
    both = I.williams_r(I.stochastic(df, 3, 1, 2), [3]).orderBy("ts").collect()
    assert all(r["stoch_3_1_2_k"] - r["williamsr_3"] == pytest.approx(100) for r in both[2:])


def test_vwap_resets_at_midnight(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("s", base + dt.timedelta(hours=i), 102.0 + i % 24, 98.0 + i % 24, 100.0 + i % 24, 1000.0 + 50 * (i % 24)) for i in range(72)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, high double, low double, close double, volume double")
    got = values(I.vwap_daily(df), "vwap_daily")
    assert got[0] == got[24] == got[48] == 100.0 and got[25] > 100


def test_ichimoku_before_the_cloud(spark):
    df = frame(spark, high=list(range(60)), low=list(range(60)), close=list(range(60)))
    r = I.ichimoku(df, name="x").orderBy("ts").collect()[30]
    assert r.ichimoku_x_senkou_a is None and r.ichimoku_x_price_cloud == 0 and r.ichimoku_x_tk_cross == 0


def test_timeframes():
    assert [B.minutes(t) for t in ("1m", "5m", "15m", "1h", "4h", "1d", "1w")] == [1, 5, 15, 60, 240, 1440, 10080]
    for bad in ("", "h", "0m", "1x", "1h2"):
        with pytest.raises(ValueError):
            B.minutes(bad)


def test_buckets(spark):
    rows = [("s", dt.datetime(2024, 1, 1, 23, 59, 59, 999000), 1.0, 1.0), ("s", dt.datetime(2024, 1, 2), 2.0, 1.0)]
    ticks = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, price double, volume double")
    assert B.from_ticks(ticks, "1d").count() == 2
    assert {r.ts.hour for r in B.from_ticks(ticks, "4h").collect()} == {20, 0}


def test_funding_times(spark):
    rows = [(dt.datetime(2024, 1, 1, 7, 59),), (dt.datetime(2024, 1, 1, 8),), (dt.datetime(2024, 1, 1, 16),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz").select("ts", D.next_funding_time("ts").alias("n")).orderBy("ts")
    assert [r.n for r in df.collect()] == [dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 1, 16), dt.datetime(2024, 1, 2)]


def test_sentiment_gap(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 20), (dt.date(2024, 1, 3), 25), (dt.date(2024, 1, 7), 30)], "day date, value int")
    new = D.interpolate_days(df, "value").where("interpolated").collect()
    assert [(r.day.day, r.value) for r in new] == [(2, 22)]
    assert spark.range(1).select(D.sentiment_class(F.lit(22))).first()[0] == "Extreme Fear"


def test_gaps(spark):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("s", base + dt.timedelta(minutes=i)) for i in (0, 1, 5, 6)], "symbol string, ts timestamp_ntz")
    want = [("s", base + dt.timedelta(minutes=2), base + dt.timedelta(minutes=4), 3)]
    assert [tuple(r) for r in Q.gaps(df, 60).collect()] == want
    assert [tuple(r) for r in Q.islands(Q.missing_periods(df, "1 minute"), 60).select("symbol", "start", "stop", "periods").collect()] == want


def test_merges(spark):
    t = spark.createDataFrame([(1, 1, None), (2, 2, 2)], "k int, a int, b int")
    s = spark.createDataFrame([(2, 9, 9), (3, 3, 3)], "k int, a int, b int")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(M.append_absent(t, s, ["k"])) == [(1, 1, None), (2, 2, 2), (3, 3, 3)]
    assert rows(M.upsert(t, s, ["k"])) == [(1, 1, None), (2, 9, 9), (3, 3, 3)]
    assert rows(M.upsert_columns(t, s, ["k"], ["b"])) == [(1, 1, None), (2, 2, 9), (3, None, 3)]
    assert rows(M.fill_null(t, s, ["k"], ["b"])) == [(1, 1, None), (2, 2, 2), (3, None, 3)]
    assert rows(M.update(t, s, ["k"], ["a"])) == [(1, 1, None), (2, 9, 2)]


def test_joins(spark):
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    left = spark.createDataFrame([("s", at(m)) for m in (0, 5, 10, 200)], "symbol string, ts timestamp_ntz")
    right = spark.createDataFrame([("s", at(5), 1.0), ("s", at(9), 2.0)], "symbol string, ts timestamp_ntz, v double")
    assert values(asof_join(left, right, "symbol", "ts", ["v"]), "v") == [None, 1.0, 2.0, 2.0]
    assert values(asof_join(left, right, "symbol", "ts", ["v"], strict=True), "v") == [None, None, 2.0, 2.0]
    spans = spark.createDataFrame([("s", at(0), at(190), 1), ("s", at(10), at(11), 2), ("s", at(4), at(4), 3)], "symbol string, a timestamp_ntz, b timestamp_ntz, n int")
    got = interval_join(left, spans, "symbol", "ts", "a", "b", "1 hour")
    assert sorted((r.ts.minute, r.n) for r in got.collect()) == [(0, 1), (5, 1), (10, 1), (10, 2)]


def test_book_replay_and_crossed_books(spark):
    side = lambda *x: [{"p": float(p), "v": float(v)} for p, v in x]
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    rows = [
        ("s", at(0), 0, "snapshot", side((100, 1), (99, 2)), side((101, 1), (102, 3))),
        ("s", at(1), 1, "delta", side((100, 0)), None),
        ("s", at(2), 2, "delta", side((103, 5)), None),  # crossed
        ("s", at(3), 3, "noise", side((1, 1)), None),
        ("s", at(4), 4, "delta", side((103, 0), (100.5, 4)), side((101, 2))),
    ]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, seq long, type string, b array<struct<p:double,v:double>>, a array<struct<p:double,v:double>>")
    r = K.metrics(K.replay(df)).first()
    assert r.messages == 3 and r.best_bid == 100.5 and r.best_ask == 101 and r.bid_changes == 2 and r.ask_changes == 0
    assert r.bid_vol_total == 6 and r.bid_wall_price == 100.5 and r.slippage_buy_10k > 0
    assert r.bid_levels.startswith('[{"p":100.5,"v":4.0}')


def test_slippage_beyond_depth(spark):
    levels = spark.createDataFrame([(1, "bid", 99.0, 1.0), (1, "ask", 100.0, 1.0), (1, "ask", 110.0, 1.0)], "book int, side string, p double, v double")
    r = K.metrics(K.from_levels(levels, ["book"])).first()
    assert r.slippage_buy_100k == pytest.approx(210 / 2 - 100)


def chain(spark, rows):
    fields = "strike double, option_type string, gamma double, open_interest double"
    df = spark.createDataFrame(rows, fields)
    return df.selectExpr("'X' as currency", "timestamp_ntz'2024-01-01' as ts", "concat(strike, option_type) as instrument", "date'2024-01-12' as expiration", "*", "50D as mark_iv", "0.3D as delta", "1D as vega", "1D as volume_24h", "1D as best_bid_price", "2D as best_ask_price", "100D as underlying_price")


def test_max_pain_ties_and_gamma_flip(spark):
    tie = chain(spark, [(90.0, "call", 0.1, 1.0), (110.0, "put", 0.1, 1.0)])
    assert O.max_pain(tie).first().max_pain == 90.0
    same_sign = chain(spark, [(90.0, "call", 0.1, 1.0), (110.0, "call", 0.1, 1.0)])
    assert O.max_pain(same_sign).first().max_pain is None and O.gamma_flip(same_sign).first().gamma_flip_level is None
    flips = O.gamma_flip(chain(spark, [(90.0, "put", 0.1, 1.0), (110.0, "call", 0.1, 1.0)])).first()
    assert 90 < flips.gamma_flip_level < 110
    assert O.term_structure(tie).first().term_structure == 0  # one expiration serves both maturities


def test_instrument_and_expiry(spark):
    r = spark.range(1).select(*[c.alias(n) for n, c in O.parse_instrument(F.lit("BTC-7MAR26-100000-C")).items()], O.monthly_expiry(F.lit("2024-03-29").cast("date")).alias("m")).first()
    assert tuple(r) == ("BTC", dt.date(2026, 3, 7), 100000.0, "call", True)


def test_plan_has_one_exchange_and_pushed_filters(spark, small, tmp_path):
    from tickloom.plans.base import hourly
    from tickloom.sources import readers, sinks

    bars = hourly(spark, small).drop("trades")
    sinks.write_bars(bars, str(tmp_path / "bars"))
    df = readers.scan(spark, str(tmp_path / "bars"), ["click"], "2024-01-05", "2024-01-06")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "GreaterThanOrEqual(ts" in plan
    many = I.mfi(I.bollinger(I.sma(df, [10, 20])), [14])._jdf.queryExecution().executedPlan().toString()
    assert many.count("Exchange hashpartitioning") == 1
