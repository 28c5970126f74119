"""Month partitions with clustered rows, pruned reads, and what a read really took.

Rows are placed by ranges of (month, cluster columns) and sorted within files, so a filter
on a cluster column skips whole files and row groups by their statistics. Filters are given
as values, and become predicates on the partitions as well.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a row group: small, so that statistics of a cluster column are worth reading.
ROW_GROUP = 1 << 20


def write_clustered(df: DataFrame, path: str, date: str, cluster_by: list[str], files: int | None = None) -> None:
    """Write ``df`` by month of ``date``; a large month spans several files, each with a range of the cluster columns."""
    out = df.withColumn("p_month", F.trunc(date, "month"))
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = out.repartitionByRange(n, "p_month", *cluster_by).sortWithinPartitions("p_month", *cluster_by)
    placed.write.partitionBy("p_month").option("parquet.block.size", ROW_GROUP).option("parquet.page.size", ROW_GROUP // 16).parquet(path)


def read_clustered(spark: SparkSession, path: str, date: str, lo: str | None = None, hi: str | None = None, **equal) -> DataFrame:
    """Rows of days lo to hi (both in it) with ``column=value`` or a list of values; what is None does not filter."""
    x = spark.read.parquet(path)
    day = lambda d: F.lit(d).cast("date")
    if lo:
        x = x.where((F.col("p_month") >= F.trunc(day(lo), "month")) & (F.col(date) >= day(lo)))
    if hi:
        x = x.where((F.col("p_month") <= F.trunc(day(hi), "month")) & (F.col(date) <= day(hi)))
    for c, v in equal.items():
        if v is not None:
            x = x.where(F.col(c).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(c) == v)
    return x.drop("p_month")


def bytes_read(df: DataFrame) -> int:
    """Bytes that tasks read from storage to make all rows of ``df``; runs it.

    Vectored reads, which other threads do, are not in the tasks' counts; they are off meanwhile.
    """
    sc = df.sparkSession.sparkContext
    group = uuid.uuid4().hex
    sc.setJobGroup(group, "bytes_read")
    conf, vectored = sc._jsc.hadoopConfiguration(), "parquet.hadoop.vectored.io.enabled"
    before = conf.get(vectored)
    conf.set(vectored, "false")
    try:
        df.write.format("noop").mode("overwrite").save()
        jobs = sc.statusTracker().getJobIdsForGroup(group)
        jvm = sc._jsc.sc()
        jvm.listenerBus().waitUntilEmpty(30_000)
        stages = {s for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds}
        return sum(jvm.statusStore().lastStageAttempt(s).inputBytes() for s in stages)
    finally:
        conf.set(vectored, before) if before is not None else conf.unset(vectored)
        sc.setLocalProperty("spark.jobGroup.id", None)
