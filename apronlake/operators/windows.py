"""Window operators: dedup, chains of an entity's legs, positions, ranks without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from apronlake.functions import cleaning as C

from .scratch import written


def dedup(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order."""
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def prefer(c: Column, ranking: list[str]) -> Column:
    """Place of a value in a ranking; unlisted values come last."""
    out = F.lit(len(ranking))
    for i, v in reversed(list(enumerate(ranking))):
        out = F.when(c == v, i).otherwise(out)
    return out


def group_count(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows of each row's group, by aggregate and join (a partial sum before the shuffle, safe for hot keys)."""
    n = df.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.count(F.lit(1)).alias(name))
    on = [df[k].eqNullSafe(F.col(f"_{k}")) for k in keys]
    return df.join(n, on, "left").drop(*(f"_{k}" for k in keys))


def append_null_rows(df: DataFrame, rest: DataFrame) -> DataFrame:
    """``df`` and rows of ``rest``, whose columns ``df`` has too; its others are NULL of their type there.

    For rows of no known entity, which need not enter a window or join that is keyed by it.
    """
    more = [c for c in rest.columns if c not in df.columns]
    if more:
        raise ValueError(f"columns {more} are not in the frame")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.unionByName(rest.select(*(F.col(c) if c in rest.columns else F.lit(None).cast(kinds[c]).alias(c) for c in df.columns)))


#: Longest scheduled turnaround of a clean link, and the least comfortable one, in minutes.
LONGEST, TIGHT = 840, 35


def rotation(legs: DataFrame) -> DataFrame:
    """Chain the legs of each tail by scheduled time and class each link.

    Class a: the prior leg arrives where this one leaves, 0 to 840 minutes before, and the
    prior leg did not itself overlap its predecessor. Class b: no prior leg, or a longer
    clean gap. Class c: all else; what depends on the chain is NULL there. Legs without a
    tail never enter the window and get NULLs. Density counts all legs of an origin, date
    and hour.
    """
    legs = group_count(legs, ["origin", "leg_date", "dep_hour"], "density")
    order = [F.col("dep_ts"), F.col("carrier"), F.col("flight_number").asc_nulls_first(), F.col("origin"), F.col("dest")]
    chain = W.partitionBy("tail").orderBy(*order)
    day = W.partitionBy("tail", "leg_date")
    known = legs.where("tail IS NOT NULL").withColumn("_arr", C.plus_minutes(F.col("dep_ts"), F.col("elapsed_min")))
    x = known.withColumns({f"_p_{c}": F.lag(c).over(chain) for c in ("_arr", "dest", "distance", "elapsed_min")})
    x = x.withColumn("_gap", F.timestamp_diff("MINUTE", F.col("_p__arr").cast("timestamp"), F.col("dep_ts").cast("timestamp")))
    x = x.withColumn("_ovl", F.coalesce(F.lag(F.col("_gap") < 0).over(chain), F.lit(False)))
    x = x.withColumns({"_pos": F.row_number().over(day.orderBy(*order)).cast("bigint"), "_legs": F.count(F.lit(1)).over(day)})
    clean = (F.col("_p_dest") == F.col("origin")) & ~F.col("_ovl")
    link = F.when(F.col("_p_dest").isNull(), "b").when(F.col("_gap").between(0, LONGEST) & clean, "a").when((F.col("_gap") > LONGEST) & clean, "b").otherwise("c")
    x = x.withColumn("link_class", link)
    in_a, not_c = F.col("link_class") == "a", F.col("link_class") != "c"
    gap = F.when(in_a, F.col("_gap"))
    inbound = F.when(not_c, in_a)
    out = {
        "has_inbound": inbound,
        "position": F.when(not_c, F.col("_pos")),
        "legs_today": F.when(not_c, F.col("_legs")),
        "turnaround": gap,
        "slack": gap - TIGHT,
        "is_tight": F.when(not_c, F.coalesce(gap < TIGHT, F.lit(False))),
        "inbound_distance": F.when(in_a, F.col("_p_distance")),
        "inbound_elapsed": F.when(in_a, F.col("_p_elapsed_min")),
        "band": C.turnaround_band(inbound, gap),
        "pos_key": C.position_key(F.when(not_c, F.col("_pos"))),
    }
    chained = x.withColumns(out).select(*legs.columns, "link_class", *out)
    return append_null_rows(chained, legs.where("tail IS NULL"))


def global_rank(df: DataFrame, order: list[Column], name: str, parts: int = 0) -> DataFrame:
    """1, 2, 3, ... in a total order, in two passes.

    A range partitioning puts the rows in order over tasks; counts of the partitions, one
    row each, give the offsets. No task ever sees all rows. The partitions are written, so
    that offsets and rows agree on them even if a lost executor's part is made anew.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(df.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id()), "ranges")
    counts = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("_p", "_before")
    local = F.row_number().over(W.partitionBy("_p").orderBy(*order))
    return placed.join(F.broadcast(before), "_p").withColumn(name, local + F.col("_before")).drop("_p", "_before")


def running_totals(df: DataFrame, key: str, values: list[str], descending: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Sums of ``values`` over all rows before each row in the order of a unique key, as before_<value>.

    Two passes as in ``global_rank``: sums within ranges, and sums of earlier ranges. With
    ``by`` (few groups, not NULL) the order is that of each group; a large group spans many ranges.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.col(key).desc() if descending else F.col(key).asc()
    placed = written(df.repartitionByRange(n, *by, order).withColumn("_p", F.spark_partition_id()), "ranges")
    totals = placed.groupBy("_p", *by).agg(*(F.sum(v).alias(f"_t_{v}") for v in values))
    earlier = W.partitionBy(*by).orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("_p", *by, *(F.coalesce(F.sum(f"_t_{v}").over(earlier), F.lit(0)).alias(f"_o_{v}") for v in values))
    inside = W.partitionBy("_p", *by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    out = placed.join(F.broadcast(offsets), ["_p", *by])
    out = out.withColumns({f"before_{v}": F.coalesce(F.sum(v).over(inside), F.lit(0)) + F.col(f"_o_{v}") for v in values})
    return out.drop("_p", *(f"_o_{v}" for v in values))


def latest_per(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Rows of the greatest time of each key (NULL keys too), by aggregate and join: safe for hot keys."""
    last = df.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.max(ts).alias("_last"))
    on = [df[k].eqNullSafe(F.col(f"_{k}")) for k in keys] + [df[ts] == F.col("_last")]
    return df.join(last, on).select(*(df[c] for c in df.columns))


def one_per_group(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row of each key: the least by ``order``, then by all other columns; a struct is aggregated, no window."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_b"))
    return best.select(*(F.col(c) if c in keys else F.col(f"_b.{c}").alias(c) for c in df.columns))
