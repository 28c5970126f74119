"""Rolling tables: stream and late rows together are the batch; replays, merges, changing lookups."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from apronlake.operators import windows as Wn
from apronlake.sources import commits as Co
from apronlake.streaming import rolling as Ro

SCHEMA = "id long, ts timestamp_ntz, kind string, value double"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


def at(day, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour)


#: Files in the order in which they come; the second and the fourth hold rows far behind.
BATCHES = [
    [(1, at(0, 1), "a", 1.0), (2, at(5, 1), "b", 2.0)],
    [(3, at(5, 3), "a", 4.0), (4, at(0, 2), "a", 8.0), (5, at(4), "b", 16.0)],
    [(6, at(9), "a", 32.0), (7, None, "a", 64.0)],
    [(8, at(1), "b", 128.0), (9, at(1, 3), "b", 256.0), (10, at(8), "a", 512.0)],
    [],
    [(11, at(20), "a", 1024.0)],
    [(12, at(9), "b", 2048.0)],
]
#: Rows behind the greatest time of earlier files less two days.
LATE = {4, 8, 9, 12}


def feed(spark, table, tmp_path, batches=BATCHES):
    src = str(tmp_path / "src")
    for b in batches:
        spark.createDataFrame(b, SCHEMA).write.mode("append").parquet(src)
        table.start(spark.readStream.schema(SCHEMA).parquet(src), str(tmp_path / "ck")).awaitTermination()


def test_sums_and_late_rows_are_the_batch(spark, tmp_path):
    table = Ro.rolling_sums(str(tmp_path / "t"), "ts", ["kind"], "value", "1 day", "2 DAYS")
    feed(spark, table, tmp_path)
    flat = [r for b in BATCHES for r in b]
    on_time = spark.createDataFrame([r for r in flat if r[0] not in LATE and r[1]], SCHEMA)
    late = spark.createDataFrame([r for r in flat if r[0] in LATE], SCHEMA)
    window = F.window("ts", "1 day").start.alias("window_start")
    assert rows(table.read(spark)) == rows(on_time.groupBy(window, "kind").agg(F.count("*").alias("n"), F.sum("value").alias("sum_value")))
    assert rows(table.late(spark)) == rows(late.groupBy(window, "kind").agg(F.count("*").alias("n")))
    assert table.watermark(spark) == "2024-01-19 00:00:00"
    n = Co.Log(spark, table.path).latest()
    entry = Co.Log(spark, table.path).entry(n)
    assert n == 7 and max(level for _, level in entry["parts"]) == 1 and len(entry["parts"]) == 4  # four folders were merged
    before = rows(table.read(spark))
    assert Ro.forget(spark, table) > 0 and rows(table.read(spark)) == before


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path, monkeypatch):
    table = Ro.rolling_sums(str(tmp_path / "t"), "ts", ["kind"], "value", "1 day", "2 DAYS")
    one, two = (spark.createDataFrame(b, SCHEMA) for b in BATCHES[:2])
    table.take(one, 0)
    before = rows(table.read(spark)), rows(table.late(spark))
    table.take(one, 0)
    with monkeypatch.context() as m:
        m.setattr(Co.Log, "complete", lambda *_: (_ for _ in ()).throw(OSError("died before the entry")))
        with pytest.raises(OSError):
            table.take(two, 1)
    assert (rows(table.read(spark)), rows(table.late(spark))) == before == (before[0], [])
    table.take(two, 1)
    assert sum(r[-2] for r in rows(table.read(spark))) == 4 and rows(table.late(spark), "n") == [(1,)]


def order():
    return {"kind": Wn.prefer(F.col("kind"), ["b", "a"]), "ts": F.col("ts"), "id": F.col("id")}


def test_best_rows_equal_the_batch(spark, tmp_path):
    batches = [[(i, at(i % 5, (i * 7) % 3), "ab"[(i * i + j) % 2], float(i)) for i in range(j, 60, 3)] for j in (2, 0, 1)]
    table = Ro.rolling_best(str(tmp_path / "t"), "ts", ["station"], order(), "1 day", "99 DAYS")
    src = str(tmp_path / "src")
    with_key = lambda df: df.withColumn("station", F.when(F.col("id") % 4 != 0, F.col("id") % 4))
    for b in batches:
        with_key(spark.createDataFrame(b, SCHEMA)).write.mode("append").parquet(src)
        table.start(spark.readStream.schema(f"{SCHEMA}, station long").parquet(src), str(tmp_path / "ck")).awaitTermination()
    batch = spark.read.schema(f"{SCHEMA}, station long").parquet(src).withColumn("day", F.to_date("ts"))
    want = Wn.dedup(batch, ["station", "day"], list(order().values()))
    assert rows(table.read(spark), "station", "id", "kind", "value") == rows(want, "station", "id", "kind", "value")
    assert table.late(spark).count() == 0


def test_state_of_the_engine_gives_the_best_when_the_watermark_has_passed(spark, tmp_path):
    src = str(tmp_path / "src")
    batches = [[(1, at(0, 5), "a", 1.0), (2, at(1, 1), "a", 1.0)], [(3, at(0, 7), "b", 1.0), (4, at(1, 3), "b", 1.0)], [(5, at(9), "a", 1.0)]]
    for k, b in enumerate(batches):
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(SCHEMA).parquet(src).withColumn("station", F.lit("s"))
        best = Ro.stream_best(stream, "ts", ["station"], order(), "1 day", "2 days")
        best.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert rows(out, "id", "kind") == [(3, "b"), (4, "b")]  # day 9 is still open


def test_scoring_takes_the_last_lookup_without_a_restart(spark, tmp_path):
    lookup, src, out = (str(tmp_path / x) for x in ("lookup", "src", "out"))
    rates = lambda r: spark.createDataFrame([("a", r), ("b", 0.5)], "kind string, rate double")
    Co.land(rates(0.1), lookup, ["kind"])
    spark.createDataFrame([(1, at(0), "a", 1.0), (2, at(0), "z", 1.0)], SCHEMA).write.parquet(src)
    q = Ro.score_stream(spark.readStream.schema(SCHEMA).parquet(src), lookup, "kind", out, str(tmp_path / "ck"), processingTime="0 seconds")
    try:
        q.processAllAvailable()
        Co.land(rates(0.9), lookup, ["kind"])
        spark.createDataFrame([(3, at(1), "a", 1.0), (4, at(1), "b", 1.0)], SCHEMA).write.mode("append").parquet(src)
        q.processAllAvailable()
    finally:
        q.stop()
    assert rows(spark.read.parquet(out), "id", "rate", "lookup_version") == [(1, 0.1, 1), (2, None, 1), (3, 0.9, 2), (4, 0.5, 2)]
