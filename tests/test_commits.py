"""Landing in commits, files of differing headers, ordered and clustered tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from apronlake.sources import commits as Co
from apronlake.sources import headers as H
from apronlake.sources import ordered as O
from apronlake.sources import tables as Ta


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


@pytest.fixture()
def first(spark):
    return spark.createDataFrame([("01", 1, "x"), ("01", 2, None), ("2", 3, "z"), (None, 4, "n")], "p string, i long, v string")


def test_landing_skips_replaces_and_reports(spark, first, tmp_path):
    path = str(tmp_path / "t")
    assert rows(Co.land(first, path, ["p"])) == [("01", "landed"), ("2", "landed"), (None, "landed")]
    assert rows(Co.read_landed(spark, path)) == rows(first)  # "01" stays a string
    assert {s for _, s in rows(Co.land(first.repartition(3), path, ["p"]))} == {"skipped"}
    assert Co.Log(spark, path).latest() == 1
    second = first.withColumn("v", F.when(F.col("p") == "2", "new").otherwise(F.col("v"))).where("p IS NOT NULL").unionByName(spark.createDataFrame([("bad", 9, "?")], first.schema))
    got = rows(Co.land(second, path, ["p"], valid=F.coalesce("v", F.lit("")) != "?"))
    assert got == [("01", "skipped"), ("2", "landed"), ("bad", "failed")]
    assert rows(Co.read_landed(spark, path)) == [("01", 1, "x"), ("01", 2, None), ("2", 3, "new"), (None, 4, "n")]
    assert rows(Co.read_landed(spark, path, 1)) == rows(first)  # an earlier commit is still there
    assert rows(Co.land(first.where("p = '01'"), path, ["p"], force=True)) == [("01", "landed")]
    assert Co.vacuum(spark, path) == 0 and rows(Co.read_landed(spark, path), "i") == [(1,), (2,), (3,), (4,)]
    Co.land(first, path, ["p"], force=True)
    assert Co.vacuum(spark, path) == 3 and rows(Co.read_landed(spark, path)) == rows(first)


def test_a_failed_part_keeps_what_was_live(spark, first, tmp_path):
    path = str(tmp_path / "t")
    Co.land(first, path, ["p"])
    worse = first.withColumn("v", F.when(F.col("p") == "01", "?").otherwise("better"))
    assert ("01", "failed") in rows(Co.land(worse, path, ["p"], valid=F.col("v") != "?"))
    assert rows(Co.read_landed(spark, path).where("p = '01'")) == rows(first.where("p = '01'"))


@pytest.mark.parametrize("where", ["manifest", "log"])
def test_a_failure_between_data_and_log_leaves_the_old_state(spark, first, tmp_path, monkeypatch, where):
    path = str(tmp_path / "t")
    Co.land(first, path, ["p"])
    changed = first.withColumn("v", F.lit("changed"))
    with monkeypatch.context() as m:

        def fail(*_):
            raise OSError("storage is away")

        if where == "log":
            m.setattr(Co.Log, "complete", fail)
        else:
            from pyspark.sql.readwriter import DataFrameWriter

            write = DataFrameWriter.parquet
            m.setattr(DataFrameWriter, "parquet", lambda self, to, *a, **k: fail() if "/manifests/" in to else write(self, to, *a, **k))
        with pytest.raises(OSError):
            Co.land(changed, path, ["p"])
    assert rows(Co.read_landed(spark, path)) == rows(first)
    assert {s for _, s in rows(Co.land(changed, path, ["p"]))} == {"landed"}
    assert rows(Co.read_landed(spark, path)) == rows(changed)


def test_two_writers_of_one_commit(spark, first, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    Co.land(first, path, ["p"])
    Co.Log(spark, path).complete(2, {"manifest": Co.Log(spark, path).entry(1)["manifest"], "keys": ["p"], "schema": first.schema.jsonValue()})
    monkeypatch.setattr(Co.Log, "latest", lambda self: 1)  # this writer began before the other was done
    with pytest.raises(Co.Conflict):
        Co.land(first.withColumn("v", F.lit("lost")), path, ["p"])
    monkeypatch.undo()
    assert rows(Co.read_landed(spark, path)) == rows(first)


def test_known_versions_spare_the_read(spark, tmp_path):
    src, path = str(tmp_path / "src"), str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (2, "b")], "p int, v string").write.partitionBy("p").parquet(src)
    read = lambda: spark.read.parquet(src)
    versions = Co.file_versions(read(), ["p"])
    assert rows(Co.land(read(), path, ["p"], known=versions)) == [(1, "landed"), (2, "landed")]
    spark.createDataFrame([("c",)], "v string").write.mode("overwrite").parquet(f"{src}/p=2")
    got = Co.land(read(), path, ["p"], known=Co.file_versions(read(), ["p"]))
    assert rows(got) == [(1, "skipped"), (2, "landed")]
    assert rows(Co.read_landed(spark, path), "p", "v") == [(1, "a"), (2, "c")]


def test_nothing_landed(spark, first, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        Co.read_landed(spark, path)
    assert Co.land(first.where("i < 0"), path, ["p"]).collect() == [] and Co.live(spark, path) is None


def test_headers_are_read_from_the_first_bytes(spark, tmp_path):
    (tmp_path / "s 1+a.csv").write_text('"A, first","B ""q"""\n1,2\n"x,\ny",4\n')
    (tmp_path / "s2.csv").write_text("B \"q\",C,\"A, first\"\n" + "5,6,4\n" * 200_000)
    (tmp_path / "s3.csv").write_text("C\n9\n")
    (tmp_path / "s4.csv").write_text('"a\nb","A, first","' + "wide" * 2000 + '"\nx,7,\n')
    heads = {r.path.rsplit("/", 1)[1]: r for r in H.read_headers(spark, str(tmp_path)).collect()}
    assert heads["s2.csv"].names == ['B "q"', "C", "A, first"] and heads["s2.csv"].bytes == H.FIRST_BYTES
    assert heads["s4.csv"].names[:2] == ["a\nb", "A, first"] and heads["s4.csv"].bytes <= 4 * H.FIRST_BYTES
    df = H.conform(spark, str(tmp_path), ["A, first", 'B "q"'])
    few = df.where("_station_id <> 's2'")
    assert rows(few) == sorted([("s 1+a", "1", "2"), ("s 1+a", "x,\ny", "4"), ("s3", None, None), ("s4", "7", None)], key=repr)
    assert rows(df.where("_station_id = 's2'").distinct()) == [("s2", "4", "5")] and df.where("_station_id = 's2'").count() == 200_000
    assert rows(H.conform(spark, [str(tmp_path / "s2.csv"), str(tmp_path / "s3.csv")], ["C"], split=True).groupBy("C").count()) == [("6", 200_000), ("9", 1)]


def test_canonical_order(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 613).alias("k"), F.when(F.col("id") % 5 != 0, F.col("id") % 17).alias("n"), "id")
    O.write_ordered(df, str(tmp_path / "t"), ["k", "n"], files=6)
    m = O.read_manifest(spark, str(tmp_path / "t"))
    assert m.count() > 1 and O.overlaps(m).count() == 0 and O.disorder(spark, str(tmp_path / "t")).count() == 0
    want = sorted(map(tuple, df.collect()), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
    got = sorted((r.position, (r.k, r.n, r.id)) for r in O.positions(spark, str(tmp_path / "t")).collect())
    assert got == list(enumerate(want, 1))
    files = [r.file for r in m.orderBy("first").collect()]
    early = m.where(F.col("file") == files[0]).select(F.col("first").alias("_f"))
    moved = m.crossJoin(early).withColumn("first", F.when(F.col("file") == files[2], F.col("_f")).otherwise(F.col("first"))).drop("_f")
    assert O.overlaps(moved).count() > 0


def test_clustered_reads_are_pruned(spark, tmp_path):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int"))
    df = spark.range(300_000).select(day.alias("d"), F.concat(F.lit("o"), (F.col("id") / 90).cast("int") % 40).alias("origin"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    path = str(tmp_path / "t")
    Ta.write_clustered(df, path, "d", ["origin"], files=16)
    whole = Ta.bytes_read(spark.read.parquet(path))
    one = Ta.read_clustered(spark, path, "d", "2024-02-01", "2024-02-29", origin="o7")
    assert rows(one.agg(F.count("*"), F.min("d"), F.max("d"))) == [(df.where("origin = 'o7' AND month(d) = 2").count(), dt.date(2024, 2, 1), dt.date(2024, 2, 29))]
    assert whole > 15 * Ta.bytes_read(one)
    assert Ta.read_clustered(spark, path, "d").count() == 300_000
    assert Ta.read_clustered(spark, path, "d", origin=["o1", "o2"], payload=None).count() == df.where("origin IN ('o1', 'o2')").count()
