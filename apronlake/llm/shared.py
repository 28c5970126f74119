"""Scratch tables in the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null doc_id in keys.
NO_ID = -(1 << 63)
_OWN: dict[str, str] = {}
#: For each distil() under way, the scratch tables written since it began.
_OPEN: list[list[str]] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path below ``spark.checkpoint.dir``.

    Only where all of Spark runs on one machine (tests) that setting may be missing; one
    temporary folder per application takes its place then.
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


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts the lineage: later stages never recompute what lies before, and a
    lost executor costs only the tasks that read the files again.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path, compression="zstd")
    if _OPEN:
        _OPEN[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of a bucket of settle_by(), where there are more than a bucket a shuffle partition.
BUCKET_BYTES = 256 << 20


def settle_by(df: DataFrame, key: str, name: str, extra: DataFrame, title: str, size: int) -> DataFrame:
    """``df``, joined with ``extra`` on ``key`` (left), as a bucketed table in the shared folder.

    Its rows, of about ``size`` bytes, move once, here; later joins on ``key`` leave them where they
    are. The catalog knows the table as ``title`` until the caller drops it.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    dealt = df.repartition(n, key).join(extra.hint("merge"), key, "left")
    dealt.write.bucketBy(n, key).option("path", path).option("compression", "zstd").saveAsTable(title, format="parquet")
    if _OPEN:
        _OPEN[-1].append(path)
    return spark.table(title)


def distil(build: Callable[[], DataFrame], spark: SparkSession, name: str) -> DataFrame:
    """Settle what ``build`` returns and remove the scratch tables that it took to get there."""
    _OPEN.append([])
    try:
        out = settle(build(), name)
    finally:
        made = _OPEN.pop()
    *spent, kept = made
    for path in spent:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    if _OPEN:
        _OPEN[-1].append(kept)
    return out


def with_key(docs: DataFrame) -> DataFrame:
    """``docs`` with (_at, _digest): its id, null or not, and its text's digest name a row's content."""
    return docs.withColumns({"_at": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "_digest": F.md5(F.coalesce("text", F.lit("")))})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
