"""Deterministic samples, picks and cut curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .windows import global_rank


def fingerprint(keys: list[str]) -> Column:
    return F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in keys)))


def det_sample(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The n rows of lowest fingerprint (a top-n: each task keeps n rows at most)."""
    return df.orderBy(fingerprint(keys), *keys).limit(n)


def det_fraction(df: DataFrame, keys: list[str], fraction: float) -> DataFrame:
    """Rows whose fingerprint is below a threshold; no sort, no shuffle."""
    return df.where(F.conv(F.substring(fingerprint(keys), 1, 8), 16, 10).cast("bigint") < int(fraction * 2**32))


def stratified_examples(df: DataFrame, band: Column, k: int, keys: list[str]) -> DataFrame:
    x = df.withColumn("band", band).withColumn("_f", fingerprint(keys))
    return x.withColumn("_rn", F.row_number().over(W.partitionBy("band").orderBy("_f", *keys))).where(F.col("_rn") <= k).drop("_rn", "_f")


def cut_curve(df: DataFrame, score: str, label: str, key: str, cuts: list[int]) -> DataFrame:
    """Actual rate among the top n of each cut and the top decile."""
    known = df.where(F.col(label).isNotNull())
    ranked = global_rank(known.select(key, score, label), [F.col(score).desc(), F.col(key)], "_rank")
    n = known.agg(F.count(F.lit(1)).alias("_n"))
    y = F.col(label).cast("int")
    sizes = F.array(*(F.struct(F.lit(str(c)).alias("cut"), F.lit(c).cast("bigint").alias("top")) for c in cuts), F.struct(F.lit("decile").alias("cut"), F.floor(F.col("_n") / 10).cast("bigint").alias("top")))
    x = ranked.crossJoin(F.broadcast(n)).select("_rank", y.alias("y"), F.explode(sizes).alias("c")).where(F.col("_rank") <= F.col("c.top"))
    return x.groupBy(F.col("c.cut").alias("cut")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("y"), 6).alias("actual_rate"))
