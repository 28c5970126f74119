import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apronlake.sources import landing as L
from apronlake.streaming import streams as St


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*(cols or df.columns)).collect())


def test_header_rules():
    assert L.clean_header(["Year", "", "A"], {"Year": "Year_file"}) == ["Year_file", "trailing_empty", "A"]
    with pytest.raises(ValueError):
        L.clean_header(["a", "A"], {})


def test_raw_csv_and_jsonl(spark, tmp_path):
    p = tmp_path / "csv" / "year=2024" / "month=3"
    p.mkdir(parents=True)
    (p / "a.csv").write_text("Year,X,\n2024,007,\n2024,,z\n")
    df = L.read_raw_csv(spark, str(tmp_path / "csv"), ["Year", "X", ""], {"Year": "Year_file"})
    assert df.columns == ["Year_file", "X", "trailing_empty", "year", "month"]
    assert rows(df.where("X IS NOT NULL"), "X", "month") == [("007", 3)]
    j = tmp_path / "j" / "year=2024"
    j.mkdir(parents=True)
    (j / "a.json").write_text(json.dumps({"A": "1", "odd": 3}) + "\n")
    assert rows(L.read_raw_jsonl(spark, str(tmp_path / "j"), ["A", "B"])) == [("1", None, 2024)]


def test_heterogeneous_csv(spark, tmp_path):
    (tmp_path / "s1.csv").write_text("A,B\n1,2\n")
    (tmp_path / "s2.csv").write_text("B,C,A\n5,6,4\n")
    (tmp_path / "s3.csv").write_text("C\n9\n")
    df = L.conform_heterogeneous_csv(spark, [str(tmp_path / f"s{i}.csv") for i in (1, 2, 3)], ["A", "B"])
    assert sorted(map(str, rows(df))) == sorted(map(str, [("s1", "1", "2"), ("s2", "4", "5"), ("s3", None, None)]))


def test_landing_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "p int, v string")
    assert rows(L.land_partitions(a, path, ["p"])) == [(1, "landed"), (2, "landed")]
    assert rows(L.land_partitions(a, path, ["p"])) == [(1, "skipped"), (2, "skipped")]
    b = a.withColumn("v", F.when(F.col("p") == 2, F.lit("new")).otherwise(F.col("v")))
    assert rows(L.land_partitions(b, path, ["p"])) == [(1, "skipped"), (2, "landed")]
    assert rows(spark.read.parquet(path + "/data"), "p", "v") == [(1, "x"), (1, "y"), (2, "new")]
    assert rows(L.land_partitions(b, path, ["p"], force=True)) == [(1, "landed"), (2, "landed")]


def test_validation_and_parity(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "part string, m int")
    got = rows(L.validate_landing(df, ["part", "q"], F.col("m") == 1, "part", 2, 5), "problem", "n")
    assert got == [("missing column q", 1), ("rows of another partition", 1), ("too few rows", 1)]
    man = spark.createDataFrame([("a", 2), ("c", 1)], "part string, rows long")
    assert L.check_row_parity(df, man, "part").count() == 2
    months = spark.createDataFrame([("2024-01-01",), ("2024-03-01",)], "m string").select(F.col("m").cast("date").alias("month_start"))
    assert [str(r[0]) for r in L.missing_months(months, "2024-01-01", "2024-03-01").collect()] == ["2024-02-01"]


def test_airports(spark):
    raw = spark.createDataFrame([(2, "AAA", "US", "airport", None), (1, "AAA", "US", "airport", None), (3, "BBB", "XX", "airport", None), (4, "C", "US", "airport", None)], "id int, iata string, country string, type string, tz string")
    more = spark.createDataFrame([(9, "AAA"), (8, "DDD")], "id int, iata string")
    got = rows(L.build_airports(raw, {"AAA": "UTC"}, more, ["US"], least=2), "id", "iata", "tz")
    assert got == [(1, "AAA", "UTC"), (8, "DDD", None)]
    with pytest.raises(ValueError):
        L.build_airports(raw, {}, more, ["US"], least=3)


def test_partitioned_table_is_pruned(spark, tmp_path):
    df = spark.range(90).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"), (F.col("id") % 3).alias("k"))
    L.write_table(df, str(tmp_path / "t"), "d", ["k"])
    x = L.read_table(spark, str(tmp_path / "t"), "d", "2024-02-03", "2024-02-05")
    assert x.count() == 3
    plan = x._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p_month" in plan
    assert L.freshness(spark, {"t": str(tmp_path / "t")}).first().newest is not None


def test_streams_equal_batch(spark, sf_dir, tmp_path):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    src = tmp_path / "src"
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(3).write.parquet(str(src))
    dst, ck = str(tmp_path / "dst"), str(tmp_path / "ck")
    for _ in range(2):  # a second run finds nothing new
        St.land_incremental(spark, str(src), dst, ck, schema).awaitTermination()
    batch = spark.read.parquet(str(src))
    assert spark.read.schema(schema).parquet(dst).count() == batch.count()
    stream = spark.readStream.schema(schema).parquet(str(src)).withColumn("ts", F.col("ts").cast("timestamp"))
    q = St.stream_additive(stream, "ts", ["event_type"], "1 day", "60 days").writeStream.format("memory").queryName("mart").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    want = batch.groupBy(F.to_date("ts").alias("d"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    assert rows(spark.table("mart").select(F.to_date("window_start").alias("d"), "event_type", "n")) == rows(want)
    doubled = stream.union(stream)
    q = St.stream_dedup(doubled, ["event_id"], "ts", "60 days").writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once").count() == batch.count()
    rates = spark.createDataFrame([("view", 0.25)], "key string, rate double")
    q = St.stream_score(stream, rates, "event_type").writeStream.format("memory").queryName("scored").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("scored").where("rate IS NOT NULL").count() == batch.where("event_type = 'view'").count()
