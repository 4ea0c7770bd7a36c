"""Indicators without recursion, as window expressions: each adds columns to bars (symbol, ts, open, high, low, close, volume).

All of one call share a partitioning and an order, so a plan has one exchange and one sort however many are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import rolling as r

#: Periods in a year of a timeframe, for annualised volatility.
YEAR = {"15m": 365 * 96, "1h": 365 * 24, "4h": 365 * 6, "1d": 365, "1m": 365 * 1440}


def sma(bars: DataFrame, periods: list[int], of: str = "close", prefix: str = "sma") -> DataFrame:
    return bars.withColumns({f"{prefix}_{p}": r.mean(of, p) for p in periods})


def vma(bars: DataFrame, periods: list[int]) -> DataFrame:
    return sma(bars, periods, "volume", "vma")


def bands(middle: Column, deviation: Column, close: Column, k: float, squeeze: float = 5.0) -> dict[str, Column]:
    """Bollinger columns around a middle line. percent_b is NULL at zero range, bandwidth at a zero middle."""
    upper, lower = middle + k * deviation, middle - k * deviation
    width = r.ratio(upper - lower, middle) * 100
    return {"upper": upper, "middle": F.when(deviation.isNotNull(), middle), "lower": lower, "percent_b": r.ratio(close - lower, upper - lower), "bandwidth": width, "squeeze": width < squeeze}


def bollinger(bars: DataFrame, period: int = 20, k: float = 2.0) -> DataFrame:
    name = f"bollinger_bands_sma_{period}_{str(k).replace('.', '_')}"
    close = F.col("close")
    base = bars.withColumns({"_m": r.mean("close", period), "_s": r.std("close", period)})
    return base.withColumns({f"{name}_{n}": c for n, c in bands(F.col("_m"), F.col("_s"), close, k).items()}).drop("_m", "_s")


def stochastic(bars: DataFrame, k: int = 14, smooth: int = 3, d: int = 3) -> DataFrame:
    """%K and %D; NULL at zero range, and wherever a NULL is in a smoothing window."""
    name = f"stoch_{k}_{smooth}_{d}"
    hh, ll = r.highest("high", k), r.lowest("low", k)
    raw = bars.withColumn("_raw", r.ratio(F.col("close") - ll, hh - ll) * 100)
    fast = raw.withColumn(f"{name}_k", r.mean("_raw", smooth) if smooth > 1 else F.col("_raw"))
    return fast.withColumn(f"{name}_d", r.mean(f"{name}_k", d)).drop("_raw")


def williams_r(bars: DataFrame, periods: list[int]) -> DataFrame:
    out = {}
    for p in periods:
        hh, ll = r.highest("high", p), r.lowest("low", p)
        out[f"williamsr_{p}"] = r.ratio(F.col("close") - hh, hh - ll) * 100
    return bars.withColumns(out)


def ichimoku(bars: DataFrame, tenkan: int = 9, kijun: int = 26, senkou: int = 52, name: str | None = None) -> DataFrame:
    """Eight columns. The cloud is shifted ahead by kijun rows; before it exists price_cloud is 0."""
    n = f"ichimoku_{name or f'{tenkan}_{kijun}_{senkou}'}"
    mid = lambda p: (r.highest("high", p) + r.lowest("low", p)) / 2
    one = bars.withColumns({f"{n}_tenkan": mid(tenkan), f"{n}_kijun": mid(kijun), "_b": mid(senkou)})
    one = one.withColumn("_a", (F.col(f"{n}_tenkan") + F.col(f"{n}_kijun")) / 2)
    t, k = f"{n}_tenkan", f"{n}_kijun"
    two = one.withColumns({f"{n}_senkou_a": r.prev("_a", kijun), f"{n}_senkou_b": r.prev("_b", kijun), f"{n}_chikou": F.col("close"), "_cross": F.when(r.crosses_above(t, k), 1).when(r.crosses_below(t, k), -1).otherwise(0)})
    a, b, c = F.col(f"{n}_senkou_a"), F.col(f"{n}_senkou_b"), F.col("close")
    top, bottom = F.greatest(a, b), F.least(a, b)
    return two.withColumns(
        {f"{n}_cloud_thick": r.ratio(F.abs(a - b), c) * 100, f"{n}_price_cloud": F.when(c > top, 1).when(c < bottom, -1).otherwise(0).cast("short"), f"{n}_tk_cross": F.col("_cross").cast("short")}
    ).drop("_a", "_b", "_cross")


def mfi(bars: DataFrame, periods: list[int]) -> DataFrame:
    """Money flow index: 100 without negative flow, 0 without positive, NULL without either."""
    flow = bars.withColumn("_tp", (F.col("high") + F.col("low") + F.col("close")) / 3)
    flow = flow.withColumn("_d", F.col("_tp") - r.prev("_tp"))
    money = F.col("_tp") * F.col("volume")
    flow = flow.withColumns({"_pos": F.when(F.col("_d") > 0, money).otherwise(0.0), "_neg": F.when(F.col("_d") < 0, money).otherwise(0.0)})
    out = {}
    for p in periods:
        pos, neg = r.total("_pos", p), r.total("_neg", p)
        out[f"mfi_{p}"] = F.when((pos == 0) & (neg == 0), None).when(neg == 0, 100.0).when(pos == 0, 0.0).otherwise(100 - 100 / (1 + r.ratio(pos, neg)))
    return flow.withColumns(out).drop("_tp", "_d", "_pos", "_neg")


def vwap_daily(bars: DataFrame) -> DataFrame:
    """Cumulative in the UTC day over rows with volume; NULL on rows without."""
    day = Window.partitionBy("symbol", F.to_date("ts")).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    traded = F.col("volume") > 0
    tp = (F.col("high") + F.col("low") + F.col("close")) / 3
    value = r.ratio(F.sum(F.when(traded, tp * F.col("volume"))).over(day), F.sum(F.when(traded, F.col("volume"))).over(day))
    return bars.withColumn("vwap_daily", F.when(traded, value))


def vwap_rolling(bars: DataFrame, lengths: list[int]) -> DataFrame:
    tp = (F.col("high") + F.col("low") + F.col("close")) / 3
    base = bars.withColumn("_pv", tp * F.col("volume"))
    return base.withColumns({f"vwap_{n}": F.when(r.total("volume", n) > 0, r.ratio(r.total("_pv", n), r.total("volume", n))) for n in lengths}).drop("_pv")


def historical_volatility(bars: DataFrame, periods: list[int], timeframe: str) -> DataFrame:
    """Annualised standard deviation of log returns in per cent, first on 0-based row p; with the 7/30 ratio if both are asked."""
    base = bars.withColumn("_r", F.ln(r.ratio(F.col("close"), r.prev("close"))))
    out = base.withColumns({f"hv_{p}": r.std("_r", p) * F.sqrt(F.lit(float(YEAR[timeframe]))) * 100 for p in periods}).drop("_r")
    return out.withColumn("hv_ratio_7_30", r.ratio(F.col("hv_7"), F.col("hv_30"))) if {7, 30} <= set(periods) else out


def percentile_of_previous(bars: DataFrame, c: str, length: int, name: str) -> DataFrame:
    """Share of the previous `length` rows (this one excluded) that are below this row's value, in per cent.

    For long windows use kernels.rolling_rank, which keeps a sorted window; here each frame is compared as a whole.
    """
    before = r.ordered().rowsBetween(-length, -1)
    seen = F.collect_list(c).over(before)
    enough = F.row_number().over(r.ordered()) > length
    below = F.size(F.filter(seen, lambda x: x < F.col(c)))
    return bars.withColumn(name, F.when(enough & F.col(c).isNotNull(), r.ratio(100.0 * below, F.size(seen).cast("double"))))


def percentile_in_window(bars: DataFrame, c: str, length: int, least: int, name: str) -> DataFrame:
    """Share of the window that ends with this row that is below its value, in per cent; the window may be short of `length`."""
    seen = F.collect_list(c).over(r.last_rows(length))
    return bars.withColumn(name, F.when((F.size(seen) >= least) & F.col(c).isNotNull(), 100.0 * F.size(F.filter(seen, lambda x: x < F.col(c))) / F.size(seen)))


def z_score(bars: DataFrame, c: str, length: int, name: str) -> DataFrame:
    return bars.withColumn(name, r.ratio(F.col(c) - r.mean(c, length), r.std(c, length)))


def momentum(bars: DataFrame, c: str = "close", n: int = 24) -> DataFrame:
    past = r.prev(c, n)
    return bars.withColumns({f"change_{n}": F.col(c) - past, f"roc_{n}": (r.ratio(F.col(c), past) - 1) * 100})


def true_range(bars: DataFrame, name: str = "tr") -> DataFrame:
    """greatest() skips NULLs, so the first row is high - low."""
    before = r.prev("close")
    return bars.withColumn(name, F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before)))


def directional_movement(bars: DataFrame) -> DataFrame:
    up, down = F.col("high") - r.prev("high"), r.prev("low") - F.col("low")
    return bars.withColumns({"plus_dm": F.when((up > down) & (up > 0), up).otherwise(0.0), "minus_dm": F.when((down > up) & (down > 0), down).otherwise(0.0)})


def adx_strength(value: str | Column) -> Column:
    """What an ADX says of the trend, in words; NULL stays NULL."""
    v = F.col(value) if isinstance(value, str) else value
    # The limits and the words.
    return F.when(v < 25, "Weak/Absent trend (sideways)").when(v < 50, "Strong trend").when(v < 75, "Very strong trend").when(v.isNotNull(), "Extremely strong trend (possible exhaustion)")


def trend_direction(plus: str, minus: str) -> dict[str, Column]:
    """The direction that the two DI give (equal ones are bearish), and how clear it is; NULL where one is."""
    p, m = F.col(plus), F.col(minus)
    away = F.abs(p - m)
    # The limits and the words.
    strength = F.when(away < 5, "Weak direction").when(away < 15, "Moderate direction").when(away < 30, "Strong direction").when(away.isNotNull(), "Very strong direction")
    return {"direction": F.when(p > m, "Bullish").when(away.isNotNull(), "Bearish"), "direction_strength": strength}


def squeeze_events(banded: DataFrame, name: str, since: Column, most: int = 20) -> DataFrame:
    """symbol, ts, close, bandwidth, upper, lower of the latest `most` squeezes of each symbol from `since` on."""
    hits = banded.where((F.col("ts") >= since) & F.col(f"{name}_squeeze"))
    newest = Window.partitionBy("symbol").orderBy(F.col("ts").desc())
    return hits.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= most).select("symbol", "ts", "close", *[F.col(f"{name}_{c}").alias(c) for c in ("bandwidth", "upper", "lower")])


def obv(bars: DataFrame) -> DataFrame:
    signed = bars.withColumn("_s", F.coalesce(F.signum(F.col("close") - r.prev("close")), F.lit(0.0)) * F.col("volume"))
    return signed.withColumn("obv", F.sum("_s").over(r.so_far())).drop("_s")


def cross_series(a: DataFrame, b: DataFrame, length: int = 24) -> DataFrame:
    """a, b: (ts, x). On their common timestamps: spread b - a, ratio b / a and rolling correlation. All rows in one order."""
    met = a.select("ts", F.col("x").alias("a")).join(b.select("ts", F.col("x").alias("b")), "ts")
    w = Window.partitionBy(F.lit(0)).orderBy("ts").rowsBetween(-(length - 1), 0)
    return met.select("ts", "a", "b", (F.col("b") - F.col("a")).alias("spread"), r.ratio(F.col("b"), F.col("a")).alias("ratio"), F.when(F.count("a").over(w) >= length, F.corr("a", "b").over(w)).alias("corr"))
