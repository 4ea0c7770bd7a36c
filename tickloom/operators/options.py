"""Metrics of option chains. A snapshot is all contracts of (currency, ts); every metric is aggregates and joins inside it.

chain: currency, ts, instrument, expiration (date), strike, option_type ('call', 'put'), mark_iv, delta, gamma, vega,
open_interest, volume_24h, best_bid_price, best_ask_price, underlying_price.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SNAPSHOT = ["currency", "ts"]


def _call() -> Column:
    return F.col("option_type") == "call"


def _put() -> Column:
    return F.col("option_type") == "put"


def parse_instrument(name: str | Column) -> dict[str, Column]:
    """BTC-27MAR26-100000-C: currency, expiration, strike, option_type."""
    parts = F.split(F.col(name) if isinstance(name, str) else name, "-")
    day = F.lpad(parts[1], 7, "0")
    date = F.concat(F.substring(day, 1, 2), F.initcap(F.lower(F.substring(day, 3, 3))), F.substring(day, 6, 2))
    return {"currency": parts[0], "expiration": F.to_date(date, "ddMMMyy"), "strike": parts[2].cast("double"), "option_type": F.when(parts[3] == "C", "call").when(parts[3] == "P", "put")}


def _sum(value: str, of: Column) -> Column:
    return F.coalesce(F.sum(F.when(of, F.col(value))), F.lit(0.0))


def _keyed(df: DataFrame, underlying: DataFrame) -> DataFrame:
    return df.join(underlying, SNAPSHOT)


def underlying(chain: DataFrame) -> DataFrame:
    """The underlying price of each snapshot: of the first instrument by name."""
    return chain.groupBy(*SNAPSHOT).agg(F.min_by("underlying_price", "instrument").alias("S"))


def volume(chain: DataFrame) -> DataFrame:
    """Volumes, open interest and put/call ratios (NULL where the calls' side is not positive)."""
    sums = chain.groupBy(*SNAPSHOT).agg(*[_sum(c, t).alias(f"{n}_{k}") for c, n in (("volume_24h", "volume"), ("open_interest", "oi")) for t, k in ((_call(), "calls"), (_put(), "puts"))])
    out = {f"{n}_total": F.col(f"{n}_calls") + F.col(f"{n}_puts") for n in ("volume", "oi")}
    out |= {f"put_call_{n}": F.when(F.col(f"{n}_calls") > 0, F.try_divide(f"{n}_puts", f"{n}_calls")) for n in ("volume", "oi")}
    return sums.withColumns(out)


def change_24h(snapshots: DataFrame, value: str) -> DataFrame:
    """Add <value>_prev: of the latest snapshot at least 24 hours before, and of the UTC day before at the earliest.

    One window, no self-join.
    """
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    w = Window.partitionBy("currency").orderBy("_t").rangeBetween(-172800, -86400)
    first = F.unix_timestamp(F.date_sub(F.to_date("ts"), 1).cast("timestamp"))
    return snapshots.withColumn("_t", seconds).withColumn(f"{value}_prev", F.when(F.max("_t").over(w) >= first, F.max_by(value, "_t").over(w))).drop("_t")


def atm_iv(chain: DataFrame, by: list[str]) -> DataFrame:
    """Mean IV of the two contracts nearest to the underlying (ties by strike, then name) in each group."""
    near = Window.partitionBy(*by).orderBy(F.abs(F.col("strike") - F.col("S")), "strike", "instrument")
    ranked = _keyed(chain.where("mark_iv > 0"), underlying(chain)).withColumn("_n", F.row_number().over(near))
    return ranked.where("_n <= 2").groupBy(*by).agg(F.avg("mark_iv").alias("atm_iv"))


def delta_iv(chain: DataFrame, target: float, by: list[str], name: str) -> DataFrame:
    """IV at a delta: between the first two neighbours by delta that bracket it, else that of the nearest; NULL under two.

    target over 0 looks at calls, under 0 at puts.
    """
    side = chain.where((_call() if target > 0 else _put()) & (F.col("mark_iv") > 0))
    w = Window.partitionBy(*by).orderBy("delta", "instrument")
    pairs = side.withColumns({"_d": F.lead("delta").over(w), "_v": F.lead("mark_iv").over(w), "_i": F.row_number().over(w)})
    inside = (F.col("delta") <= target) & (F.col("_d") >= target)
    width = F.col("_d") - F.col("delta")
    value = F.when(F.abs(width) < 1e-10, F.col("mark_iv")).otherwise(F.col("mark_iv") + (target - F.col("delta")) / F.nullif(width, F.lit(0.0)) * (F.col("_v") - F.col("mark_iv")))
    found = pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min_by(F.when(inside, value), F.when(inside, F.col("_i"))).alias("_in"), F.min_by("mark_iv", F.struct(F.abs(F.col("delta") - target), F.col("_i"))).alias("_near"))
    return found.select(*by, F.when(F.col("_n") >= 2, F.coalesce("_in", "_near")).alias(name))


def constant_maturity(values: DataFrame, value: str, days: int, name: str) -> DataFrame:
    """values: currency, ts, expiration, value. Linear in days between the expirations around `days`; one side alone counts.

    Only expirations at least a day away; a side whose value is NULL is as if absent.
    """
    left = F.datediff("expiration", F.to_date("ts"))
    rows = values.withColumn("_left", left).where("_left >= 1")
    below, above = F.col("_left") <= days, F.col("_left") > days
    sides = rows.groupBy(*SNAPSHOT).agg(
        F.max(F.when(below, F.col("_left"))).alias("t1"), F.max_by(value, F.when(below, F.col("_left"))).alias("v1"),
        F.min(F.when(above, F.col("_left"))).alias("t2"), F.min_by(value, F.when(above, F.col("_left"))).alias("v2"),
    )
    w = (F.col("t2") - days) / (F.col("t2") - F.col("t1"))
    both = F.col("v1").isNotNull() & F.col("v2").isNotNull()
    return sides.select(*SNAPSHOT, F.when(both, w * F.col("v1") + (1 - w) * F.col("v2")).otherwise(F.coalesce("v1", "v2")).alias(name))


def smile(chain: DataFrame, days: int) -> DataFrame:
    """ATM IV, 25-delta skew (put - call) and butterfly ((put + call) / 2 - ATM) at a constant maturity."""
    by = [*SNAPSHOT, "expiration"]
    parts = {"atm": constant_maturity(atm_iv(chain, by), "atm_iv", days, "atm"), "call": constant_maturity(delta_iv(chain, 0.25, by, "iv"), "iv", days, "call"), "put": constant_maturity(delta_iv(chain, -0.25, by, "iv"), "iv", days, "put")}
    met = parts["atm"].join(parts["call"], SNAPSHOT, "full_outer").join(parts["put"], SNAPSHOT, "full_outer")
    return met.select(*SNAPSHOT, F.col("atm").alias(f"atm_iv_{days}d"), (F.col("put") - F.col("call")).alias(f"skew_25d_{days}d"), ((F.col("put") + F.col("call")) / 2 - F.col("atm")).alias(f"butterfly_{days}d"))


def term_structure(chain: DataFrame) -> DataFrame:
    """7-day less 30-day ATM IV."""
    each = atm_iv(chain, [*SNAPSHOT, "expiration"])
    met = constant_maturity(each, "atm_iv", 7, "a").join(constant_maturity(each, "atm_iv", 30, "b"), SNAPSHOT)
    return met.select(*SNAPSHOT, (F.col("a") - F.col("b")).alias("term_structure"))


def max_pain(chain: DataFrame) -> DataFrame:
    """For each expiration the strike at which option holders gain least; ties go to the lowest. NULL without both types.

    Pain is piecewise linear, so running sums over the strikes replace the join of all strikes with all: for strike K the
    calls below give K * (their OI) - (their OI * strike), the puts above likewise.
    """
    by = [*SNAPSHOT, "expiration"]
    at = chain.groupBy(*by, "strike").agg(_sum("open_interest", _call()).alias("c"), _sum("open_interest", _put()).alias("p"), F.count_if(_call()).alias("nc"), F.count_if(_put()).alias("np"))
    up = Window.partitionBy(*by).orderBy("strike").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*by).orderBy(F.col("strike").desc()).rowsBetween(Window.unboundedPreceding, 0)
    k = F.col("strike")
    pain = k * F.sum("c").over(up) - F.sum(F.col("c") * k).over(up) + F.sum(F.col("p") * k).over(down) - k * F.sum("p").over(down)
    found = at.withColumn("pain", F.round(pain, 6)).groupBy(*by).agg(F.min_by("strike", F.struct("pain", "strike")).alias("k"), F.sum("nc").alias("nc"), F.sum("np").alias("np"))
    return found.select(*by, F.when((F.col("nc") > 0) & (F.col("np") > 0), F.col("k")).alias("max_pain"))


def monthly_expiry(day: str | Column) -> Column:
    """Whether a date is the last Friday of its month."""
    return F.date_sub(F.next_day(F.last_day(day), "FRI"), 7) == (F.col(day) if isinstance(day, str) else day)


def greeks(chain: DataFrame) -> DataFrame:
    met = _keyed(chain, underlying(chain))
    gamma = F.col("gamma") * F.col("open_interest")
    dollar = gamma * F.col("S") * F.col("S") * 0.01
    sign = F.when(_call(), 1.0).when(_put(), -1.0).otherwise(0.0)
    return met.groupBy(*SNAPSHOT).agg(F.sum(sign * dollar).alias("gex"), F.sum(F.when(_call(), F.col("delta") * F.col("open_interest")).when(_put(), -F.abs("delta") * F.col("open_interest"))).alias("net_delta"), F.sum(gamma).alias("net_gamma"), F.sum(F.col("vega") * F.col("open_interest")).alias("vega_exposure"))


def expiry(chain: DataFrame) -> DataFrame:
    left = F.datediff("expiration", F.to_date("ts"))
    return chain.groupBy(*SNAPSHOT).agg(F.min(F.when(left >= 1, left)).cast("double").alias("days_to_expiry_nearest"), F.coalesce(F.sum(F.when(left.between(0, 7), F.col("open_interest") * F.col("strike"))), F.lit(0.0)).alias("notional_expiring_7d"))


def liquidity(chain: DataFrame) -> DataFrame:
    """Mean quoted spread within 5 % of the underlying, and the strike with most open interest (the lowest on ties)."""
    met = _keyed(chain, underlying(chain))
    near = F.col("strike").between(F.col("S") - F.col("S") * 0.05, F.col("S") + F.col("S") * 0.05) & (F.col("best_bid_price") > 0) & (F.col("best_ask_price") > 0)
    spread = met.groupBy(*SNAPSHOT).agg(F.avg(F.when(near, F.col("best_ask_price") - F.col("best_bid_price"))).alias("bid_ask_spread_avg_atm"))
    strikes = chain.groupBy(*SNAPSHOT, "strike").agg(F.sum("open_interest").alias("oi"))
    return spread.join(strikes.groupBy(*SNAPSHOT).agg(F.max_by("strike", F.struct("oi", -F.col("strike"))).alias("max_oi_strike")), SNAPSHOT)


def gamma_flip(chain: DataFrame) -> DataFrame:
    """Where net gamma changes sign between neighbouring strikes, by linear interpolation, nearest to the underlying."""
    net = F.sum(F.when(_call(), F.col("gamma") * F.col("open_interest")).when(_put(), -F.col("gamma") * F.col("open_interest")).otherwise(0.0))
    at = chain.groupBy(*SNAPSHOT, "strike").agg(net.alias("_g")).withColumn("net", F.col("_g") * F.col("strike") * F.col("strike") * 0.01)
    w = Window.partitionBy(*SNAPSHOT).orderBy("strike")
    pairs = at.withColumns({"_k": F.lag("strike").over(w), "_n": F.lag("net").over(w)}).where(F.col("_n") * F.col("net") < 0)
    flip = F.col("_k") + F.abs("_n") / F.abs(F.col("net") - F.col("_n")) * (F.col("strike") - F.col("_k"))
    found = _keyed(pairs.withColumn("flip", flip), underlying(chain)).groupBy(*SNAPSHOT).agg(F.min_by("flip", F.struct(F.abs(F.col("flip") - F.col("S")), F.col("strike"))).alias("gamma_flip_level"))
    return chain.select(*SNAPSHOT).distinct().join(found, SNAPSHOT, "left")


def live_summary(chain: DataFrame) -> DataFrame:
    """IV of the contract with the least days * 0.01 + relative strike distance, and total open interest."""
    met = _keyed(chain, underlying(chain))
    score = F.datediff("expiration", F.to_date("ts")) * 0.01 + F.abs(F.col("strike") - F.col("S")) / F.col("S")
    return met.groupBy(*SNAPSHOT).agg(F.min_by("mark_iv", F.struct(F.when(F.col("mark_iv") > 0, score).isNull().alias("none"), score.alias("score"), F.col("instrument"))).alias("live_atm_iv"), F.sum("open_interest").alias("oi_total"))


#: The metric groups: name -> function of a chain. Each is computed and stored by itself.
GROUPS = {"volume": volume, "greeks": greeks, "expiry": expiry, "liquidity": liquidity, "positioning": gamma_flip, "term": term_structure}


def pending(chain: DataFrame, stored: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of snapshots after the last stored one that has all of a group's columns, for each currency."""
    complete = stored.dropna(subset=columns).groupBy("currency").agg(F.max("ts").alias("_last"))
    return chain.join(complete, "currency", "left").where(F.col("_last").isNull() | (F.col("ts") > F.col("_last"))).drop("_last")
