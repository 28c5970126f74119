"""Tables written on the way, in the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``.

    Only where all of Spark runs on one machine (tests) may that setting be missing.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = tempfile.mkdtemp(prefix="apronlake-")
        base = _OWN[app]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def until_end(spark: SparkSession, path: str) -> str:
    """``path``, which exists and goes when the application ends."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the shared folder, read back: plans above it read it once for each use.

    The table is removed when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(until_end(spark, path))
