"""Measure blocks: aggregates over legs, and rates over their sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def additive_measures() -> list[Column]:
    """Counts, sums and each outcome's own denominator; nothing that cannot be summed again."""
    n = lambda c: F.count_if(c).cast("bigint")
    return [
        F.count(F.lit(1)).alias("n_flights"),
        n(F.col("arr_delay_min").isNotNull()).alias("n_with_arr_outcome"),
        n(F.col("arr_del15")).alias("n_arr_del15"),
        n(F.col("cancelled")).alias("n_cancelled"),
        n(F.col("diverted")).alias("n_diverted"),
        F.coalesce(F.sum("arr_delay_min"), F.lit(0)).cast("bigint").alias("sum_arr_delay"),
    ]


ADDITIVE = ("n_flights", "n_with_arr_outcome", "n_arr_del15", "n_cancelled", "n_diverted", "sum_arr_delay")


def delay_measures() -> list[Column]:
    """Counts and rates with their own denominators, mean and 90th percentile of delay."""
    outcome = F.count("arr_delay_min")
    rate = lambda a, b: F.round(F.try_divide(a, b), 6)
    return [
        F.count(F.lit(1)).alias("n_flights"),
        rate(F.count_if("arr_del15"), outcome).alias("delay_rate"),
        rate(F.count_if("cancelled"), F.count(F.lit(1))).alias("cancel_rate"),
        rate(F.sum("arr_delay_min"), outcome).alias("avg_delay"),
        F.expr("cast(percentile_disc(0.9) WITHIN GROUP (ORDER BY arr_delay_min) AS bigint)").alias("p90_delay"),
    ]


def rates() -> dict[str, Column]:
    """Rates over additive sums; a zero denominator gives NULL."""
    of = lambda a, b: F.round(F.try_divide(F.col(a), F.col(b)), 6)
    return {
        "delay_rate": of("n_arr_del15", "n_with_arr_outcome"),
        "cancel_rate": of("n_cancelled", "n_flights"),
        "divert_rate": of("n_diverted", "n_flights"),
        "avg_delay": of("sum_arr_delay", "n_with_arr_outcome"),
    }
