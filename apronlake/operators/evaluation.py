"""Evaluation of scores: ranking, calibration, exceedance, typical days; no single-task sorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .joins import connections
from .rates import pb_moments
from .windows import running_totals

#: Delay thresholds in minutes, and the bands of the replay report (right-closed).
THRESHOLDS = (15, 30, 60, 90, 120, 180, 240)
REPLAY_EDGES = (0.1, 0.2, 0.3, 0.5, 0.7)


def _by_score(df: DataFrame, score: str, label: str) -> DataFrame:
    y = F.col(label).cast("int")
    return df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).alias("s")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def roc_auc(df: DataFrame, score: str = "score", label: str = "arr_del15") -> DataFrame:
    """One row (roc_auc): the Mann-Whitney form, ties counted half."""
    x = running_totals(_by_score(df, score, label), "s", ["neg"])
    a = F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / 2)) / (F.sum("pos") * F.sum("neg"))
    return x.agg(F.round(a, 6).alias("roc_auc"))


def average_precision(df: DataFrame, score: str = "score", label: str = "arr_del15") -> DataFrame:
    """One row (average_precision): the sum of recall steps times precision, best score first."""
    x = running_totals(_by_score(df, score, label), "s", ["pos", "neg"], descending=True)
    tp, fp = F.col("before_pos") + F.col("pos"), F.col("before_neg") + F.col("neg")
    return x.agg(F.round(F.sum(F.col("pos") * tp / (tp + fp)) / F.sum("pos"), 6).alias("average_precision"))


def point_metrics(df: DataFrame, score: str, label: str, predicted: str, actual: str, at: float = 0.5) -> DataFrame:
    p, y, e = F.col(score), F.col(label).cast("int"), F.col(predicted) - F.col(actual)
    return df.where(F.col(label).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(((p >= at).cast("int") == y).cast("int")), 6).alias("accuracy"),
        F.round(F.avg((p - y) * (p - y)), 6).alias("brier"),
        F.round(F.sqrt(F.avg(e * e)), 6).alias("rmse"),
        F.round(F.avg(F.abs(e)), 6).alias("mae"),
    )


def slice_metrics(df: DataFrame, slices: dict[str, Column], score: str = "score", label: str = "arr_del15") -> DataFrame:
    """Base rate, AUC and average precision of overlapping slices; the ranking is done within each slice, by ranges of scores."""
    names = F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in slices.items())), lambda x: x.isNotNull())
    y = F.col(label).cast("int")
    return metrics_by_slice(df.where(F.col(label).isNotNull()).select(F.explode(names).alias("slice"), F.col(score).alias("s"), y.alias("y")))


def metrics_by_slice(rows: DataFrame) -> DataFrame:
    """The same of rows (slice, s, y) that name their slice: one ranking for all slices, whatever they are."""
    x = rows.groupBy("slice", "s").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    x = running_totals(x, "s", ["pos", "neg"], by=("slice",))
    whole = x.groupBy("slice").agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    x = x.join(F.broadcast(whole), "slice").withColumns({"below": F.col("before_neg"), "tp": F.col("_pos") - F.col("before_pos"), "fp": F.col("_neg") - F.col("before_neg")})
    base = F.sum("pos") / F.sum(F.col("pos") + F.col("neg"))
    ap = F.try_divide(F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))), F.sum("pos"))
    auc = F.try_divide(F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)), F.sum("pos") * F.sum("neg"))
    return x.groupBy("slice").agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n"), F.round(base, 6).alias("base_rate"), F.round(auc, 6).alias("roc_auc"), F.round(ap, 6).alias("average_precision"), F.round(F.try_divide(ap, base), 6).alias("lift")
    )


def delay_bucket(c: Column) -> Column:
    return F.when(c <= 0, "on_time_0").when(c <= 15, "1_15").when(c <= 60, "15_60").when(c <= 180, "60_180").when(c > 180, "180_plus")


def mae_by_bucket(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    x = df.where(F.col(actual).isNotNull()).groupBy(delay_bucket(F.col(actual)).alias("bucket"))
    return x.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.abs(F.col(predicted) - F.col(actual))), 6).alias("mae"))


def equal_bin(p: Column, bins: int = 10) -> Column:
    """Number of interior edges at or below p, edges as the doubles i / bins."""
    out = F.lit(0)
    for i in range(1, bins):
        out = out + (p >= F.lit(i / bins)).cast("int")
    return out


def reliability(df: DataFrame, score: str = "score", label: str = "arr_del15", bins: int = 10) -> DataFrame:
    x = df.where(F.col(label).isNotNull()).groupBy(equal_bin(F.col(score), bins).alias("bin"))
    return x.agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_pred"), F.avg(F.col(label).cast("int")).alias("frac_pos"))


def calibration_metrics(df: DataFrame, score: str = "score", label: str = "arr_del15", bins: int = 10) -> DataFrame:
    """One row (ece, mce) over the non-empty bins."""
    gap = F.abs(F.col("mean_pred") - F.col("frac_pos"))
    return reliability(df, score, label, bins).agg(F.round(F.sum(F.col("n") * gap) / F.sum("n"), 6).alias("ece"), F.round(F.max(gap), 6).alias("mce"))


def exceedance(df: DataFrame, delay: str = "arr_delay_min", score: str = "score", bins: int = 10) -> DataFrame:
    """P(delay >= t) of each band of predicted probability; all bands are kept."""
    known = df.where(F.col(delay).isNotNull()).withColumn("bin", equal_bin(F.col(score), bins))
    x = known.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), *(F.round(F.avg((F.col(delay) >= t).cast("int")), 6).alias(f"p_ge_{t}") for t in THRESHOLDS))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(x), "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def day_typicality(df: DataFrame, day: str, lo: float = 0.1, hi: float = 0.9) -> DataFrame:
    """z of each day, its share of days below, and whether it is within the central band."""
    days = pb_moments(df.where(F.col("arr_del15").isNotNull()), [day])
    band = days.agg(F.percentile("z", F.lit(lo)).alias("lo"), F.percentile("z", F.lit(hi)).alias("hi"), F.stddev_samp("z").alias("z_sd"), F.count(F.lit(1)).alias("days"))
    x = days.crossJoin(F.broadcast(band))
    below = F.percent_rank().over(W.orderBy("z")) * (F.col("days") - 1) / F.col("days")
    return x.select(day, F.col("n"), "actual", F.round("expected", 6).alias("expected"), F.round("z", 6).alias("z"), F.round(below, 6).alias("share_below"), F.col("z").between(F.col("lo"), F.col("hi")).alias("typical"))


def replay_band(p: Column) -> Column:
    out = F.lit(0)
    for e in REPLAY_EDGES:
        out = out + (p > e).cast("int")
    return out


def replay_report(df: DataFrame, score: str = "score", label: str = "arr_del15") -> DataFrame:
    x = df.where(F.col(label).isNotNull()).groupBy(replay_band(F.col(score)).alias("band"))
    return x.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(score), 6).alias("mean_pred"), F.round(F.avg(F.col(label).cast("int")), 6).alias("actual_rate"))


def rank_blend(df: DataFrame, key: str, scores: list[str]) -> DataFrame:
    """Mean of the scores' ranks over n, ties at their average rank; by counts of distinct scores."""
    out = df
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    for s in scores:
        counts = df.groupBy(F.col(s).alias(f"_s_{s}")).agg(F.count(F.lit(1)).alias("c"))
        ranks = running_totals(counts, f"_s_{s}", ["c"]).select(f"_s_{s}", (F.col("before_c") + (F.col("c") + 1) / 2).alias(f"_r_{s}"))
        out = out.join(ranks, out[s] == F.col(f"_s_{s}"), "left")
    mean = sum((F.col(f"_r_{s}") for s in scores[1:]), F.col(f"_r_{scores[0]}")) / len(scores)
    return out.crossJoin(F.broadcast(n)).select(key, F.round(mean / F.col("_n"), 6).alias("blend"))


def connection_risk(board: DataFrame, table: DataFrame, wait: int = 30) -> DataFrame:
    """P(first leg is later than the slack of its connection) from a measured exceedance table.

    ``board`` has legs with a score; the slack is rounded down to a measured threshold. Below the
    least threshold the value is a lower bound, beyond the greatest an upper bound. The table
    meets first legs by the bin of their score, before pairs are made.
    """
    x = connections(board.withColumn("bin", equal_bin(F.col("score"))), wait, keep=("bin",), lookup=table.select("bin", *(f"p_ge_{t}" for t in THRESHOLDS)))
    x = x.withColumn("slack", F.col("layover") - wait)
    fits = F.lit(THRESHOLDS[0])
    for t in THRESHOLDS[1:]:
        fits = F.when(F.col("slack") >= t, t).otherwise(fits)
    x = x.withColumn("at", F.when(F.col("slack") > 0, fits))
    p = F.lit(None).cast("double")
    for t in THRESHOLDS:
        p = F.when(F.col("at") == t, F.col(f"p_ge_{t}")).otherwise(p)
    bound = F.when(F.col("slack") <= 0, "inside connection time").when(F.col("slack") < THRESHOLDS[0], "lower").when((F.col("at") == THRESHOLDS[-1]) & (F.col("slack") > F.col("at")), "upper").otherwise("measured")
    return x.select("first_id", "second_id", "slack", F.col("at").cast("bigint").alias("threshold"), p.alias("p_miss"), bound.alias("bound"))
