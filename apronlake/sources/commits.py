"""Landing in commits: readers see the last complete one, whatever fails in between.

A table is a folder:

    data/commit=<n>/<keys>/...   partitions that commit n landed
    manifests/<n>-<attempt>/     all live partitions after it: keys, rows, version, commit
    log/<n>                      one small file that makes commit n valid, put there by a rename

A commit is complete when its file is in the log. Data or manifests of a writer that died
before that are never read, and the next writer takes the same number with a new attempt.
Of two writers of one number the second fails at the rename and leaves the table as it is.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apronlake.operators.joins import small

HASH = "_row_hash"
ABOUT = ("rows", "version", "commit")


class Conflict(RuntimeError):
    """Another writer completed a commit of the same number."""


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system of ``path``, path -> Hadoop path)."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


@dataclass
class Log:
    """The log of a table; ``latest`` is 0 where nothing was committed."""

    spark: SparkSession
    path: str

    def numbers(self) -> list[int]:
        fs, make = file_system(self.spark, self.path)
        where = make(f"{self.path}/log")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(where) if s.getPath().getName().isdigit()) if fs.exists(where) else []

    def latest(self) -> int:
        return max(self.numbers(), default=0)

    def entry(self, n: int) -> dict:
        """What commit n said of itself."""
        fs, make = file_system(self.spark, self.path)
        stream = fs.open(make(f"{self.path}/log/{n:08d}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def complete(self, n: int, about: dict) -> None:
        """Make commit n valid; Conflict if it is taken."""
        fs, make = file_system(self.spark, self.path)
        jvm = self.spark._jvm
        own, final = make(f"{self.path}/log/.{n:08d}-{uuid.uuid4().hex}"), make(f"{self.path}/log/{n:08d}")
        fs.mkdirs(make(f"{self.path}/log"))
        out = fs.create(own, False)
        try:
            out.write(bytearray(json.dumps(about).encode()))
        finally:
            out.close()
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(own, final, none)
        except Exception as e:
            fs.delete(own, False)
            if fs.exists(final):
                raise Conflict(f"commit {n} of {self.path} is another writer's") from e
            raise


def live(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The manifest of a commit (the last one by default); None where there is none."""
    log = Log(spark, path)
    n = version or log.latest()
    if not n:
        return None
    about = log.entry(n)
    keys = [f for f in T.StructType.fromJson(about["schema"]) if f.name in about["keys"]]
    kinds = T.StructType([*keys, *T.StructType.fromDDL("rows long, version string, commit long")])
    return spark.read.schema(kinds).parquet(f"{path}/{about['manifest']}")


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in keys))


def read_landed(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of the table as of a commit (the last one by default).

    Folders of commits that own no live partition are pruned; the rest meets the manifest.
    """
    log = Log(spark, path)
    n = version or log.latest()
    if not n:
        raise FileNotFoundError(f"nothing was committed to {path}")
    about, manifest = log.entry(n), live(spark, path, n)
    keys, schema = about["keys"], T.StructType.fromJson(about["schema"])
    stored = T.StructType([f for f in schema if f.name not in keys] + [T.StructField("commit", T.LongType())] + [f for f in schema if f.name in keys])
    owners = [r[0] for r in manifest.select("commit").distinct().collect()]  # commits with live partitions
    rows = spark.read.schema(stored).parquet(f"{path}/data").where(F.col("commit").isin(owners))
    owned = small(manifest.select(*keys, "commit"))
    return rows.join(owned, _same(rows, owned, [*keys, "commit"]), "left_semi").select(*schema.names)


def land(df: DataFrame, path: str, keys: list[str], known: DataFrame | None = None, valid: Column | None = None, force: bool = False) -> DataFrame:
    """Land the partitions of ``df`` (by ``keys``) in one commit; (keys, status), one row a partition.

    The input is read once: it is written with a hash of each row, and rows and versions
    are counted from that column of what was written. ``skipped``: the live partition has the same rows and version
    (unless ``force``). ``failed``: a row is not ``valid``; what was live before stays so. ``landed``: replaced whole.
    ``known`` has (keys, version) of the source where versions are known without reading,
    such as those of files; partitions live in that version are then not even read.
    """
    spark = df.sparkSession
    log = Log(spark, path)
    before, n = live(spark, path), log.latest() + 1
    if before is None:
        before = spark.createDataFrame([], T.StructType([*(f for f in df.schema if f.name in keys), *T.StructType.fromDDL("rows long, version string, commit long")]))
    unread = None
    if known is not None and not force:
        at = _same(known, before, [*keys, "version"])
        unread = known.join(before, at, "left_semi").select(*keys)
        wanted = small(known.join(before, at, "left_anti").select(*keys))
        df = df.join(wanted, _same(df, wanted, keys), "left_semi")
    attempt = f"{n}-{uuid.uuid4().hex}"
    folder = f"{path}/data/commit={n}"
    fs, make = file_system(spark, path)
    fs.delete(make(folder), True)  # of a writer that died before its commit was complete
    content = F.xxhash64(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
    good = F.coalesce(valid, F.lit(False)) if valid is not None else F.lit(True)
    df.withColumns({HASH: content, "_good": good}).write.partitionBy(*keys).parquet(folder)
    stored = T.StructType([T.StructField(HASH, T.LongType()), T.StructField("_good", T.BooleanType()), *(f for f in df.schema if f.name in keys)])
    written = spark.read.schema(stored).parquet(folder)
    came = written.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(HASH).cast("decimal(38,0)")).cast("string").alias("version"), F.bool_and("_good").alias("_good"))
    if known is not None:
        came = came.drop("version").join(known.select(*(F.col(k).alias(f"_k_{k}") for k in keys), "version"), reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys))).drop(*(f"_k_{k}" for k in keys))
    old = before.select(*(F.col(k).alias(f"_o_{k}") for k in keys), *(F.col(c).alias(f"_o_{c}") for c in ABOUT))
    joined = came.join(old, reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys)), "left")
    same = (F.col("rows") == F.col("_o_rows")) & (F.col("version") == F.col("_o_version")) if not force else F.lit(False)
    status = F.when(~F.col("_good"), "failed").when(F.coalesce(same, F.lit(False)), "skipped").otherwise("landed")
    judged = joined.select(*keys, "rows", "version", status.alias("status"))
    landed = judged.where("status = 'landed'")
    if landed.limit(1).count():
        kept = before.join(landed, _same(before, landed, keys), "left_anti")
        manifest = kept.unionByName(landed.select(*keys, "rows", "version", F.lit(n).cast("long").alias("commit")))
        manifest.write.parquet(f"{path}/manifests/{attempt}")
        log.complete(n, {"manifest": f"manifests/{attempt}", "keys": keys, "schema": df.schema.jsonValue()})
    out = judged.select(*keys, "status")
    return out if unread is None else out.unionByName(unread.withColumn("status", F.lit("skipped")))


def file_versions(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, version) of a file source by its partitions' files: names, sizes and times; no column is read."""
    m = F.col("_metadata")
    one = F.xxhash64(m.file_path, m.file_size, m.file_modification_time).cast("decimal(38,0)")
    files = df.select(*keys, one.alias("_f")).distinct()
    return files.groupBy(*keys).agg(F.sum("_f").cast("string").alias("version"))


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove data that none of the last ``keep`` commits owns; the number of folders removed."""
    log = Log(spark, path)
    numbers = log.numbers()
    fs, make = file_system(spark, path)
    owners = {r[0] for n in numbers[-keep:] for r in live(spark, path, n).select("commit").distinct().collect()}
    folders = [s.getPath() for s in fs.listStatus(make(f"{path}/data"))] if numbers else []
    dead = [p for p in folders if p.getName().startswith("commit=") and int(p.getName()[7:]) not in owners]
    for p in dead:
        fs.delete(p, True)
    for n in numbers[:-keep]:
        manifest = log.entry(n)["manifest"]
        fs.delete(make(f"{path}/log/{n:08d}"), False)
        fs.delete(make(f"{path}/{manifest}"), True)
    return len(dead)
