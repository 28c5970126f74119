"""Tables in a canonical total order: files hold consecutive ranges of the key, and a manifest says which.

``write_ordered`` range-partitions and sorts by the key, then by all other columns, so that
rows of one key have an order too. The manifest has a row a file: its rows, first and last
key, and the rows of all files before it; the order of the whole table can be checked from it
alone, and a row's place is its file's base plus its place in the file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _file():
    return F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file")


def write_ordered(df: DataFrame, path: str, keys: list[str], files: int | None = None) -> None:
    """Write ``df`` in order to ``path``/data, and the manifest beside it; orderable columns only."""
    spark = df.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [*keys, *(c for c in df.columns if c not in keys)]
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).write.parquet(f"{path}/data")
    rows = spark.read.schema(df.schema).parquet(f"{path}/data").select(F.struct(*order).alias("_k"), _file())
    ranges = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.min("_k").alias("first"), F.max("_k").alias("last"))
    ranges.write.parquet(f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows, first, last, base), a row a file; ``base`` is the rows of all files before it."""
    m = spark.read.parquet(f"{path}/manifest")
    before = W.orderBy("first").rowsBetween(W.unboundedPreceding, -1)
    return m.withColumn("base", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def overlaps(manifest: DataFrame) -> DataFrame:
    """Files that begin before the one before them ends."""
    return manifest.withColumn("_before", F.lag("last").over(W.orderBy("first"))).where("first < _before").drop("_before")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    # A file of this writer has less rows than a task can take, so its rows have one place each.
    return spark.read.parquet(f"{path}/data").select("*", _file(), F.col("_metadata.row_index").alias("_at"))


def disorder(spark: SparkSession, path: str) -> DataFrame:
    """Rows that are less than the row before them in their file; (file, _at)."""
    first = spark.read.parquet(f"{path}/manifest").schema["first"].dataType.names
    x = _rows(spark, path).select("file", "_at", F.struct(*first).alias("_k"))
    return x.withColumn("_before", F.lag("_k").over(W.partitionBy("file").orderBy("_at"))).where("_k < _before").select("file", "_at")


def positions(spark: SparkSession, path: str) -> DataFrame:
    """All rows with their place in the order, from 1 on."""
    bases = F.broadcast(read_manifest(spark, path).select("file", "base"))  # a row a file
    return _rows(spark, path).join(bases, "file").withColumn("position", F.col("base") + F.col("_at") + 1).drop("file", "base", "_at")
