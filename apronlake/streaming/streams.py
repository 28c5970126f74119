"""Structured Streaming forms of landing, dedup, the additive mart and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from apronlake.operators.joins import small


def land_incremental(spark: SparkSession, src: str, dst: str, checkpoint: str, schema: T.StructType) -> StreamingQuery:
    """Take new files of ``src`` exactly once to Parquet in ``dst``, then stop."""
    return spark.readStream.schema(schema).parquet(src).writeStream.format("parquet").option("path", dst).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_dedup(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """The first row of each key within the watermark (``rolling.stream_best`` keeps the best, not the first)."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def stream_additive(stream: DataFrame, ts: str, keys: list[str], window: str, delay: str) -> DataFrame:
    """Additive counts and sums per tumbling window; state is dropped behind the watermark (``rolling.rolling_sums`` counts late rows)."""
    of = stream.withWatermark(ts, delay).groupBy(F.window(ts, window).alias("w"), *keys)
    return of.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("sum_value")).select(F.col("w.start").alias("window_start"), *keys, "n", "sum_value")


def stream_score(stream: DataFrame, rates: DataFrame, key: str) -> DataFrame:
    """Each row with its key's rate from a static table; unseen keys get NULL (see ``rolling.score_stream`` for tables that change)."""
    return stream.join(small(rates.select(F.col("key").alias("_key"), "rate")), F.col(key) == F.col("_key"), "left").drop("_key")
