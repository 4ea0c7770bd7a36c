"""Archives, services, payloads, sinks and streams."""

import datetime as dt
import json
import time
import zipfile

from pyspark.sql import functions as F

from tickloom.operators import book
from tickloom.sources import readers as R
from tickloom.sources import sinks as S
from tickloom.streaming import bars as T


def test_book_archive(spark, tmp_path):
    lines = [json.dumps({"ts": 1704067200000 + i * 1000, "type": "snapshot", "data": {"b": [["100", "1"]], "a": [["101", "2"]]}}) for i in range(70)] + ["broken", json.dumps({"type": "delta"})]
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("x.data", "\n".join(lines))
    got = book.metrics(book.replay(R.book_messages(spark, str(tmp_path), "S"))).orderBy("minute").collect()
    assert [(r.messages, r.best_bid) for r in got] == [(60, 100.0), (10, 100.0)]


def test_csv_archive(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("x.csv", "timestamp,percentage,depth,notional\n2024-01-01 00:00:01,-1.00,5,500\n2024-01-01 00:00:01,1.00,4,400\nbad\n")
    rows = R.zipped_csv(spark, str(tmp_path), "timestamp timestamp_ntz, percentage string, depth double, notional double")
    got = book.depth_minutes(rows.select(F.lit("S").alias("symbol"), F.col("timestamp").alias("ts"), "percentage", "depth", "notional")).first()
    assert got.bid_depth_1pct == 5 and got.ask_depth_1pct == 4 and got.buy_pressure == 1.25


def fetch(symbol, start, stop):
    n = int((stop - start).total_seconds() // 60) + 1
    return [(start + dt.timedelta(minutes=i), float(i)) for i in reversed(range(n))]


def test_paged_source(spark):
    spark.dataSource.register(R.paged_source("pages", "symbol string, ts timestamp_ntz, close double", fetch))
    df = spark.read.format("pages").options(symbols="a,b", start="2024-01-01T00:00:00", stop="2024-01-01T04:59:00", page="100").load()
    assert df.count() == 600 and df.select("symbol", "ts").distinct().count() == 600
    assert df.rdd.getNumPartitions() == 6


def test_pages_payloads_and_listing(spark):
    payload = json.dumps({"data": [{"timestamp": "1704067200", "value": "20", "value_classification": "Fear"}, {"timestamp": "1704070000", "value": "30", "value_classification": "Fear"}, {"timestamp": "x", "value": "1"}]})
    assert [(r.day, r.value) for r in R.daily_series(spark, payload).collect()] == [(dt.date(2024, 1, 1), 30)]
    ratio = json.dumps({"retCode": 0, "result": {"list": [{"timestamp": "1704067200000", "buyRatio": "0.6", "sellRatio": "0.4"}]}})
    assert R.ratio_series(spark, ratio).first().buy == 0.6
    assert R.ratio_series(spark, json.dumps({"retCode": 5})).count() == 0
    assert R.listed('<a href="S2024-01-02.zip"><a href="S2024-01-01.zip"><a href="x">', r"(\d{4}-\d\d-\d\d)")[0][0] == "2024-01-01"


def test_config_and_sinks(spark, tmp_path):
    assert R.Config.parse('{"symbols": ["a"], "timeframes": ["1h"]}').timeframes == ["1h"]
    rows = lambda v: spark.createDataFrame([(s, dt.datetime(2024, 1, 1), v) for s in ("a", "b")], "symbol string, ts timestamp_ntz, close double")
    path = str(tmp_path / "t")
    S.write_bars(rows(1.0), path)
    S.overwrite_symbols(spark, rows(2.0).where("symbol = 'b'"), path)
    assert sorted((r.symbol, r.close) for r in spark.read.parquet(path).collect()) == [("a", 1.0), ("b", 2.0)]
    assert S.add_columns(rows(1.0), {"ema_9": "double", "close": "double"}).columns == ["symbol", "ts", "close", "ema_9"]


def test_stream_bars_match_batch(spark, tmp_path):
    rows = [("s", dt.datetime(2024, 1, 1, 0, m, 30), float(m), 1.0) for m in range(60)] + [("s", dt.datetime(2024, 1, 1, 3), 0.0, 1.0)]
    src = str(tmp_path / "in")
    shape = "symbol string, ts timestamp, price double, volume double"
    spark.createDataFrame(rows, shape).coalesce(1).write.parquet(src)
    q = T.write_bars(T.stream_bars(spark.readStream.schema(shape).parquet(src), "15m"), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = sorted((r.open, r.close, r.trades) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(0.0, 14.0, 15), (15.0, 29.0, 15), (30.0, 44.0, 15), (45.0, 59.0, 15)]


def test_foreach_batch_upsert(spark, tmp_path):
    src, seen = str(tmp_path / "in"), []
    spark.range(10).write.parquet(src)
    q = T.upsert_batches(spark.readStream.schema("id long").parquet(src), lambda batch, epoch: seen.append(batch.count()), str(tmp_path / "ck"))
    q.awaitTermination(60)
    assert sum(seen) == 10


def test_carried_snapshots(spark, tmp_path):
    src, shape = str(tmp_path / "in"), "instrument string, ts timestamp, value double, removed boolean"
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    for part in ([("a", at(1), 1.0, False), ("b", at(2), 5.0, False)], [("a", at(40), 2.0, False), ("c", at(59), 9.0, False)], [("b", at(50), 5.0, True), ("c", at(59), 9.0, False)]):
        spark.createDataFrame(part, shape).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(src)
    q = T.carried_snapshots(stream, 15 * 60 * 1000).writeStream.format("memory").queryName("carried").option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted((r.instrument, r.ts.minute, r.value) for r in spark.sql("select * from carried").collect())
    assert got == [("a", 0, 1.0), ("a", 15, 1.0), ("a", 30, 2.0), ("b", 0, 5.0), ("b", 15, 5.0), ("b", 30, 5.0)]
