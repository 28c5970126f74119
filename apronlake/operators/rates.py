"""Cutoff-bounded historical rates, smoothing, and rollups of additive marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from apronlake.functions.measures import ADDITIVE, rates

#: Level: key column.
GRAINS = {"route": "route", "carrier": "carrier", "airport": "origin", "turnaround_band": "band", "rotation_position": "pos_key"}


def completed(df: DataFrame) -> DataFrame:
    return df.where("NOT cancelled AND NOT diverted")


def historical_rates(df: DataFrame, grains: dict[str, str], cutoff: str) -> DataFrame:
    """(level, key, n, rate, avg_delay) of completed legs before the cutoff, in one pass for all grains.

    Each leg is listed under its key of each grain; NULL keys are left out.
    """
    keys = F.array(*(F.struct(F.lit(g).alias("level"), F.col(c).cast("string").alias("key")) for g, c in grains.items()))
    x = completed(df).where(F.col("leg_date") < F.lit(cutoff).cast("date")).select(F.explode(keys).alias("_k"), "arr_del15", "arr_delay_min")
    x = x.select("_k.level", "_k.key", "arr_del15", "arr_delay_min").where("key IS NOT NULL")
    n = F.count(F.lit(1))
    return x.groupBy("level", "key").agg(n.alias("n"), (F.count_if("arr_del15") / n).alias("rate"), (F.sum("arr_delay_min") / n).alias("avg_delay"))


def global_prior(rates_: DataFrame, level: str = "carrier") -> DataFrame:
    """One row (g_rate, g_delay): means over one grain that covers every leg once.

    Other grains are left out inside the sums and not by a filter, so that the rates'
    exchange is the same here and where the rates are used, and is made once.
    """
    of = F.col("level") == level
    mean = lambda c: F.sum(F.when(of, F.col("n") * F.col(c))) / F.sum(F.when(of, F.col("n")))
    return rates_.agg(mean("rate").alias("g_rate"), mean("avg_delay").alias("g_delay"))


def smooth(n: Column, p: Column, g: Column, m: float = 50.0) -> Column:
    """(n p + m g) / (n + m); NULL for a key that was never seen."""
    return F.when(n.isNotNull(), (n * p + m * g) / (n + m))


def smoothed_rates(df: DataFrame, grains: dict[str, str], cutoff: str, m: float = 50.0) -> DataFrame:
    """Smoothed rates; the raw ones serve as rows and as the prior, by one exchange."""
    raw = historical_rates(df, grains, cutoff)
    x = raw.crossJoin(F.broadcast(global_prior(raw)))
    return x.select("level", "key", "n", smooth(F.col("n"), F.col("rate"), F.col("g_rate"), m).alias("rate"), smooth(F.col("n"), F.col("avg_delay"), F.col("g_delay"), m).alias("avg_delay"))


def rollup(mart: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of an additive mart at any grain, then rates over the sums."""
    return mart.groupBy(*keys).agg(*(F.sum(c).cast("bigint").alias(c) for c in ADDITIVE)).withColumns(rates())


def share_of(df: DataFrame, col: str) -> Column:
    """Share of the total over a small rolled-up frame; NULL if the total is 0."""
    return F.try_divide(F.col(col), F.sum(col).over(W.partitionBy(F.lit(1))))


def mix_adjusted(mart: DataFrame, entity: str, stratum: str, num: str = "n_arr_del15", den: str = "n_with_arr_outcome") -> DataFrame:
    """Actual over expected events of each entity, expected at its strata's overall rates."""
    cells = mart.groupBy(entity, stratum).agg(F.sum(num).alias("a"), F.sum(den).alias("d"))
    overall = cells.groupBy(stratum).agg(F.try_divide(F.sum("a"), F.sum("d")).alias("r"))
    of = cells.join(overall, stratum).groupBy(entity).agg(F.sum("a").alias("a"), F.sum("d").alias("d"), F.sum(F.col("d") * F.col("r")).alias("e"))
    six = lambda a, b: F.round(F.try_divide(a, b), 6)
    return of.select(entity, six(F.col("a"), F.col("d")).alias("rate"), six(F.col("e"), F.col("d")).alias("expected_rate"), six(F.col("a"), F.col("e")).alias("mix_index"))


def pb_moments(df: DataFrame, keys: list[str], p: str = "score", y: str = "arr_del15") -> DataFrame:
    """Expected count, its deviation, actual count and z of independent events."""
    actual = F.sum(F.coalesce(F.col(y).cast("bigint"), F.lit(0)))
    x = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("expected"), F.sqrt(F.sum(F.col(p) * (1 - F.col(p)))).alias("sd"), actual.alias("actual"))
    return x.withColumn("z", F.try_divide(F.col("actual") - F.col("expected"), F.col("sd")))


def hourly_banks(df: DataFrame, keys: list[str]) -> DataFrame:
    """Departures of each hour: expected delays, tight share, legs that depend on them."""
    left = F.greatest(F.coalesce(F.col("legs_today") - F.col("position"), F.lit(0)), F.lit(0))
    tight = F.coalesce(F.col("is_tight"), F.lit(False)).cast("int")
    return df.withColumn("_left", left).groupBy(*keys, "dep_hour").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("score").alias("expected"),
        F.sqrt(F.sum(F.col("score") * (1 - F.col("score")))).alias("sd"),
        F.avg(tight).alias("tight_share"),
        F.sum("_left").alias("downstream"),
        F.sum(F.col("score") * F.col("_left")).alias("expected_downstream"),
    )
