"""Order books: replay of snapshots and deltas, metrics of a book, minute statistics, depth and ticker tables.

A book is two arrays of (p, v): bids from the highest price, asks from the lowest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIDE = "array<struct<p:double,v:double>>"
TOP = 50
DEPTHS = ["0.2", "1", "2", "3", "4", "5"]


def from_levels(levels: DataFrame, keys: list[str]) -> DataFrame:
    """Books of (keys, side 'bid' or 'ask', p, v) with one row a price. A book's levels are bounded by its depth."""
    side = lambda s: F.collect_list(F.when(F.col("side") == s, F.struct("p", "v")))
    books = levels.groupBy(*keys).agg(F.sort_array(side("bid"), asc=False).alias("bids"), F.sort_array(side("ask")).alias("asks"))
    return books.where((F.size("bids") > 0) & (F.size("asks") > 0))


def _sum(side: str, value: str = "x.v", keep: str = "true") -> str:
    return f"aggregate(filter({side}, x -> {keep}), 0D, (s, x) -> s + {value})"


def _slippage(side: str, amount: int) -> str:
    """Mean price less best price (absolute) of filling an amount level by level; what there is, if it is not enough."""
    walk = f"aggregate({side}, struct({amount}D as left, 0D as paid, 0D as qty), (s, x) -> if(s.left <= 0, s, if(x.p * x.v >= s.left, struct(0D as left, s.paid + s.left as paid, s.qty + s.left / x.p as qty), struct(s.left - x.p * x.v as left, s.paid + x.p * x.v as paid, s.qty + x.v as qty))), s -> try_divide(s.paid, s.qty))"
    return f"coalesce(abs({walk} - {side}[0].p), 0D)"


def _part(a: str, b: str) -> Column:
    return F.expr(f"if({a} + {b} > 0, ({a} - {b}) / ({a} + {b}), 0D)")


def metrics(books: DataFrame) -> DataFrame:
    """Prices, volumes, walls, slippage and concentration of each book; the arrays cut to the best 50 levels as JSON."""
    b = books.withColumns({"best_bid": F.col("bids")[0]["p"], "best_ask": F.col("asks")[0]["p"], "_bv": F.col("bids")[0]["v"], "_av": F.col("asks")[0]["v"]})
    b = b.withColumn("mid_price", (F.col("best_bid") + F.col("best_ask")) / 2)
    b = b.withColumns(
        {
            "spread": F.col("best_ask") - F.col("best_bid"),
            "microprice": F.expr("if(_bv + _av > 0, (best_bid * _av + best_ask * _bv) / (_bv + _av), mid_price)"),
            **{f"{s[:3]}_vwap": F.expr(f"coalesce(try_divide({_sum(s, 'x.p * x.v')}, {_sum(s)}), 0D)") for s in ("bids", "asks")},
            **{f"{s[:3]}_vol_{n}": F.expr(_sum(s, keep=f"abs(x.p - mid_price) <= mid_price * {pct}D / 100")) for s in ("bids", "asks") for n, pct in (("01pct", 0.1), ("05pct", 0.5), ("1pct", 1.0))},
            **{f"{s[:3]}_vol_total": F.expr(_sum(s)) for s in ("bids", "asks")},
        }
    )
    b = b.withColumns(
        {
            "spread_pct": F.expr("if(mid_price > 0, spread / mid_price * 100, 0D)"),
            "imbalance": _part("bid_vol_total", "ask_vol_total"),
            "imbalance_01pct": _part("bid_vol_01pct", "ask_vol_01pct"),
            "buy_pressure": F.expr("if(ask_vol_01pct > 0, bid_vol_01pct / ask_vol_01pct, 0D)"),
            "depth_ratio": F.expr("if(ask_vol_1pct > 0, bid_vol_1pct / ask_vol_1pct, 0D)"),
            "liquidity": (F.col("bid_vol_total") + F.col("ask_vol_total")) / 2,
        }
    )
    for s in ("bids", "asks"):
        # The largest level; of equal ones the best price, which is the first in order.
        wall = F.expr(f"aggregate({s}, {s}[0], (w, x) -> if(x.v > w.v, x, w))")
        b = b.withColumn("_w", wall).withColumns({f"{s[:3]}_wall_price": F.col("_w.p"), f"{s[:3]}_wall_volume": F.col("_w.v"), f"{s[:3]}_wall_distance": F.expr("if(mid_price > 0, abs(mid_price - _w.p) / mid_price * 100, 0D)")})
    slips = {f"slippage_{way}_{n // 1000}k": F.expr(_slippage(s, n)) for way, s in (("buy", "asks"), ("sell", "bids")) for n in (10_000, 50_000, 100_000)}
    top3 = lambda s: F.expr(f"coalesce(try_divide(aggregate(slice(sort_array(transform({s}, x -> x.v), false), 1, 3), 0D, (s, x) -> s + x), {_sum(s)}), 0D)")
    level = lambda s: F.to_json(F.expr(f"transform(slice({s}, 1, {TOP}), x -> struct(round(x.p, 2) as p, round(x.v, 8) as v))"))
    b = b.withColumns(slips | {f"{s[:3]}_concentration": top3(s) for s in ("bids", "asks")} | {f"{s[:3]}_level_count": F.size(s) for s in ("bids", "asks")} | {f"{s[:3]}_levels": level(s) for s in ("bids", "asks")})
    return b.drop("_bv", "_av", "_w", "bids", "asks")


_STATS = ("spread", "imbalance", "bid_volume", "ask_volume", "mid")
REPLAYED = ", ".join(["symbol string", "minute timestamp_ntz", f"bids {SIDE}", f"asks {SIDE}", "messages long", "bid_changes long", "ask_changes long", "momentum double", *[f"{s}_{k} double" for s in _STATS for k in ("min", "max", "avg", "std")]])


def _replay(table: pa.Table) -> pa.Table:
    table = table.sort_by([("ts", "ascending"), ("seq", "ascending")])
    symbol = table.column("symbol")[0].as_py()
    bids: dict[float, float] = {}
    asks: dict[float, float] = {}
    out, seen, minute, before = [], [], None, None
    changes = [0, 0]

    def close() -> None:
        if not seen or not bids or not asks:
            return
        a = np.array(seen)
        first, last = a[0, 4], a[-1, 4]
        stats = {f"{s}_{k}": float(f(a[:, i])) for i, s in enumerate(_STATS) for k, f in (("min", np.min), ("max", np.max), ("avg", np.mean), ("std", lambda x: x.std(ddof=1) if len(x) > 1 else 0.0))}
        side = lambda d, r: [{"p": p, "v": d[p]} for p in sorted(d, reverse=r)]
        out.append({"symbol": symbol, "minute": minute, "bids": side(bids, True), "asks": side(asks, False), "messages": len(seen), "bid_changes": changes[0], "ask_changes": changes[1], "momentum": float((last - first) / first) if first > 0 else 0.0, **stats})

    for ts, kind, b, a in zip(*(table.column(c).to_pylist() for c in ("ts", "type", "b", "a")), strict=True):
        at = ts.replace(second=0, microsecond=0)
        if at != minute:
            close()
            minute, seen, changes[:] = at, [], (0, 0)
        if kind == "snapshot":
            bids = {x["p"]: x["v"] for x in b or [] if x["v"]}
            asks = {x["p"]: x["v"] for x in a or [] if x["v"]}
        elif kind == "delta":
            for book, rows in ((bids, b), (asks, a)):
                for x in rows or []:
                    if x["v"]:
                        book[x["p"]] = x["v"]
                    else:
                        book.pop(x["p"], None)
        else:
            continue
        if not bids or not asks:
            continue
        best = max(bids), min(asks)
        if best[0] >= best[1]:
            continue
        bv, av = sum(bids.values()), sum(asks.values())
        seen.append((best[1] - best[0], (bv - av) / (bv + av) if bv + av > 0 else 0.0, bv, av, (best[0] + best[1]) / 2))
        if before:
            changes[0] += best[0] != before[0]
            changes[1] += best[1] != before[1]
        before = best
    close()
    kinds = pa.schema([("symbol", pa.string()), ("minute", pa.timestamp("us")), *[(s, pa.list_(pa.struct([("p", pa.float64()), ("v", pa.float64())]))) for s in ("bids", "asks")], *[(c, pa.int64()) for c in ("messages", "bid_changes", "ask_changes")], ("momentum", pa.float64()), *[(f"{s}_{k}", pa.float64()) for s in _STATS for k in ("min", "max", "avg", "std")]])
    return pa.Table.from_pylist(out, kinds)


def replay(messages: DataFrame) -> DataFrame:
    """Minute rows of books from messages: symbol, ts, seq, type ('snapshot' or 'delta'), b and a (arrays of (p, v)).

    A snapshot replaces the book, a delta sets levels, volume 0 deletes one, other types are skipped. Crossed books stay but
    are not counted. A minute is returned if it has a counted message and both sides at its end. Each (symbol, UTC day)
    starts empty, as its archive does, and is one group: its size is bounded by a day's messages.
    """
    from tickloom.sources.session import python_ready

    python_ready(messages.sparkSession)
    rows = messages.where("ts is not null").select("symbol", F.to_date("ts").alias("_day"), "ts", "seq", "type", F.col("b").cast(SIDE), F.col("a").cast(SIDE))
    return rows.groupBy("symbol", "_day").applyInArrow(_replay, REPLAYED)


def depth_minutes(depth: DataFrame) -> DataFrame:
    """symbol, minute and depth columns from (symbol, ts, percentage, depth, notional): the last snapshot of each minute.

    A negative percentage is a bid. Ratios are cut at 9999 and NULL where they would divide by 0.
    """
    minute = F.window("ts", "1 minute")["start"]
    rows = depth.withColumn("_m", minute).withColumnRenamed("_m", "minute")
    last = rows.withColumn("_last", F.max("ts").over(Window.partitionBy("symbol", "minute"))).where("ts = _last")
    level = F.rtrim(F.rtrim(F.regexp_replace(F.trim("percentage"), "^-", ""), F.lit("0")), F.lit("."))
    last = last.withColumns({"_side": F.when(F.trim("percentage").startswith("-"), "bid").otherwise("ask"), "_level": F.when(F.col("percentage").contains("."), level).otherwise(F.regexp_replace(F.trim("percentage"), "^-", ""))})
    pick = lambda s, p, c: F.max(F.when((F.col("_side") == s) & (F.col("_level") == p), F.col(c)))
    wide = last.groupBy("symbol", "minute").agg(*[pick(s, p, "depth").alias(f"{s}_depth_{p.replace('.', '')}pct") for s in ("bid", "ask") for p in DEPTHS], *[pick(s, "5", "notional").alias(f"{s}_notional_5pct") for s in ("bid", "ask")])
    counts = rows.groupBy("symbol", "minute").agg(F.count_distinct("ts").alias("snapshot_count"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    out = {f"imbalance_{p}pct": F.try_divide(z(f"bid_depth_{p}pct") - z(f"ask_depth_{p}pct"), F.when(z(f"bid_depth_{p}pct") + z(f"ask_depth_{p}pct") > 0, z(f"bid_depth_{p}pct") + z(f"ask_depth_{p}pct"))) for p in ("1", "2", "3", "5")}
    cut = lambda a, b: F.when(z(b) > 0, F.least(z(a) / F.nullif(z(b), F.lit(0.0)), F.lit(9999.0)))
    out |= {"depth_ratio": cut("bid_depth_5pct", "ask_depth_5pct"), "buy_pressure": cut("bid_depth_1pct", "ask_depth_1pct"), "liquidity_score": z("bid_notional_5pct") + z("ask_notional_5pct")}
    return wide.join(counts, ["symbol", "minute"]).withColumns(out)


def ticker_minutes(quotes: DataFrame) -> DataFrame:
    """Minute statistics of (symbol, ts, update_id, best_bid_price, best_bid_qty, best_ask_price, best_ask_qty).

    Changes are counted against the quote before, also across minutes, in order of ts and update_id. Each (symbol, UTC day)
    starts anew, as its archive does: its first quote is no change, and a task sorts one day at most.
    """
    w = Window.partitionBy("symbol", F.to_date("ts")).orderBy("ts", "update_id")
    b, a = F.col("best_bid_price"), F.col("best_ask_price")
    changed = lambda c: F.coalesce((c != F.lag(c).over(w)).cast("long"), F.lit(0))
    q = quotes.withColumns({"mid": (b + a) / 2, "sp": a - b, "_b": changed(b), "_a": changed(a), "_m": F.window("ts", "1 minute")["start"]})
    at = F.struct("ts", "update_id")
    last = lambda c: F.max_by(c, at)
    m = q.groupBy("symbol", F.col("_m").alias("minute")).agg(
        last("best_bid_price").alias("best_bid"), last("best_ask_price").alias("best_ask"), last("best_bid_qty").alias("best_bid_qty"), last("best_ask_qty").alias("best_ask_qty"),
        last("mid").alias("mid_price"), last("sp").alias("spread"), last(F.try_divide("sp", "mid") * 100).alias("spread_pct"), F.min("sp").alias("spread_min"), F.max("sp").alias("spread_max"), F.avg("sp").alias("spread_avg"), F.stddev_samp("sp").alias("spread_std"),
        (F.max("mid") - F.min("mid")).alias("mid_price_range"), F.stddev_samp("mid").alias("mid_price_std"), F.min_by("mid", at).alias("_first"), F.sum("_b").alias("best_bid_changes"), F.sum("_a").alias("best_ask_changes"),
        F.count(F.lit(1)).alias("tick_count"), F.avg("best_bid_qty").alias("best_bid_qty_avg"), F.max("best_bid_qty").alias("best_bid_qty_max"), F.avg("best_ask_qty").alias("best_ask_qty_avg"), F.max("best_ask_qty").alias("best_ask_qty_max"),
    )
    total = F.col("best_bid_qty") + F.col("best_ask_qty")
    return m.withColumns({"price_momentum": F.when(F.col("_first") > 0, (F.col("mid_price") - F.col("_first")) / F.nullif(F.col("_first"), F.lit(0.0))).otherwise(0.0), "microprice": F.when(total > 0, (F.col("best_bid") * F.col("best_ask_qty") + F.col("best_ask") * F.col("best_bid_qty")) / F.nullif(total, F.lit(0.0))).otherwise(F.col("mid_price"))}).drop("_first")


def combined(depth: DataFrame, ticker: DataFrame) -> DataFrame:
    """Depth minutes with the ticker's columns where it has the minute."""
    return depth.join(ticker, ["symbol", "minute"], "left")


def days_missing(minutes: DataFrame, have: str | None, lack: str) -> DataFrame:
    """symbol, day, month of days with a minute that lacks a column (though it has another, if named)."""
    rows = minutes.where(F.col(lack).isNull())
    rows = rows.where(F.col(have).isNotNull()) if have else rows
    return rows.select("symbol", F.to_date("minute").alias("day")).distinct().withColumn("month", F.date_format("day", "yyyy-MM"))
