"""Data-quality guards; each returns violations, so an empty frame means pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .windows import LONGEST, TIGHT


def q_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, n_null) of columns that hold NULLs, in one pass."""
    one = df.agg(*(F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols))
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in cols)))
    return one.select(pairs.alias("x")).select("x.*").where("n_null > 0")


def q_unique(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def q_accepted(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(values))


def q_range(df: DataFrame, col: str, lo, hi, severity: str = "error") -> DataFrame:
    return df.where((F.col(col) < lo) | (F.col(col) > hi)).withColumn("severity", F.lit(severity))


def q_schema_allowlist(df: DataFrame, allowed: list[str]) -> DataFrame:
    """(column, problem): columns that are not allowed, and allowed ones that are missing."""
    rows = [(c, "not_allowed") for c in df.columns if c not in allowed] + [(c, "missing") for c in allowed if c not in df.columns]
    return df.sparkSession.createDataFrame(rows, "column string, problem string")


def audit_registry(df: DataFrame, features: list[str], labels: list[str], excluded: list[str]) -> DataFrame:
    """(column, problem) of features that are labels, look like labels, are excluded, or are not in the frame."""
    rows = [(c, "is_label") for c in features if c in labels]
    rows += [(c, "label_like") for c in features if c.startswith("label_") or c.startswith("arr_")]
    rows += [(c, "excluded") for c in features if c in excluded]
    rows += [(c, "absent") for c in features if c not in df.columns]
    return df.sparkSession.createDataFrame(rows, "column string, problem string")


def q_asof(features: DataFrame, dep: str, obs: str, flag: str, hours: int, most_missing: float = 0.05, scheduled: tuple[str, str] | None = None) -> DataFrame:
    """(rule, n) of broken rules of an as-of join: future, stale, flag against value, too many missing.

    With ``scheduled`` (day, minute of day) departures are counted anew from these, and rows
    whose departure is another are a broken rule too.
    """
    own = F.col(dep)
    if scheduled:
        day, minute = scheduled
        own = F.timestamp_add("MINUTE", F.col(minute).cast("int"), F.col(day).cast("timestamp_ntz"))
    late = F.col(obs) > own
    stale = F.col(obs) <= own - F.expr(f"INTERVAL {hours} HOURS")
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False))).cast("bigint")
    arms = {
        "after_departure": n(late),
        "outside_lookback": n(stale),
        "flag_without_obs": n(F.col(flag) & F.col(obs).isNull()),
        "obs_without_flag": n(~F.col(flag) & F.col(obs).isNotNull()),
        "unverifiable": n(F.col(obs).isNotNull() & own.isNull()),
        "degraded": F.when(F.avg(F.col(obs).isNull().cast("int")) > most_missing, n(F.col(obs).isNull())).otherwise(F.lit(0)).cast("bigint"),
    }
    if scheduled:
        arms["departure_moved"] = n(~own.eqNullSafe(F.col(dep)))
    return _by_rule(features.agg(*(c.alias(r) for r, c in arms.items())))


def _by_rule(one: DataFrame) -> DataFrame:
    """One row of counts as (rule, n)."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("rule"), F.col(c).alias("n")) for c in one.columns)))
    return one.select(pairs.alias("x")).select("x.*")


#: Upper edges of the turnaround bands and their labels, for the audit.
BAND_EDGES, BANDS = (35, 60, 120), ("lt_35", "35_60", "60_120", "ge_120")


def _relinked(legs: DataFrame) -> DataFrame:
    """Rotation columns made another way than the chain that they audit.

    Each tail's legs are numbered and joined with their predecessors; times are minutes since
    an epoch, from day and minute of day; positions come from the least number of a day.
    """
    at = F.datediff("leg_date", F.lit("1970-01-01").cast("date")).cast("bigint") * 1440 + F.col("dep_min")
    order = ["leg_date", "dep_min", "carrier", F.col("flight_number").asc_nulls_first(), "origin", "dest"]
    k = legs.where("tail IS NOT NULL").select("leg_id", "tail", "leg_date", "origin", "dest", "distance", "elapsed_min", at.alias("_at"), F.row_number().over(W.partitionBy("tail").orderBy(*order)).alias("_i"))
    before = k.select("tail", (F.col("_i") + 1).alias("_i"), F.col("dest").alias("_from"), F.col("distance").alias("_far"), F.col("elapsed_min").alias("_long"), (F.col("_at") + F.col("elapsed_min")).alias("_free"))
    j = k.join(before, ["tail", "_i"], "left").withColumn("_gap", F.col("_at") - F.col("_free"))
    overlap = j.where("_gap < 0").select("tail", (F.col("_i") + 1).alias("_i"), F.lit(True).alias("_overlapped"))
    days = k.groupBy("tail", "leg_date").agg(F.min("_i").alias("_first"), F.max("_i").alias("_last"))
    j = j.join(overlap, ["tail", "_i"], "left").join(days, ["tail", "leg_date"])
    sound = (F.col("_from") == F.col("origin")) & F.col("_overlapped").isNull() & (F.col("_gap") >= 0)
    j = j.withColumn("link_class", F.when(F.col("_from").isNull(), "b").when(~sound, "c").when(F.col("_gap") > LONGEST, "b").otherwise("a"))
    linked, gap = F.col("link_class") == "a", F.col("_gap")
    place = F.when(F.col("link_class") != "c", (F.col("_i") - F.col("_first") + 1).cast("bigint"))
    edges = sum(((gap >= e).cast("int") for e in BAND_EDGES), F.lit(1))
    return j.select(
        "leg_id",
        "link_class",
        F.when(linked, gap).alias("turnaround"),
        F.when(linked, F.col("_far")).alias("inbound_distance"),
        F.when(linked, F.col("_long")).alias("inbound_elapsed"),
        place.alias("position"),
        F.when(place.isNotNull(), (F.col("_last") - F.col("_first") + 1).cast("bigint")).alias("legs_today"),
        F.when(place.isNotNull(), linked & (gap < TIGHT)).alias("is_tight"),
        F.when(place.isNotNull(), linked).alias("has_inbound"),
        F.when(linked, F.element_at(F.array(*map(F.lit, BANDS)), edges)).when(F.col("link_class") == "b", "no_inbound").alias("band"),
        F.when(place > 6, "6").otherwise(place.cast("string")).alias("pos_key"),
    )


def q_chain(mart: DataFrame, legs: DataFrame) -> DataFrame:
    """(rule, n): a mart's rotation columns against an independent rebuild from the legs, and its own rules."""
    cols = ["link_class", "turnaround", "inbound_distance", "inbound_elapsed", "position", "legs_today", "is_tight", "has_inbound", "band", "pos_key"]
    fresh = legs.select("leg_id").join(_relinked(legs), "leg_id", "left").select(F.col("leg_id").alias("_leg_id"), *(F.col(c).alias(f"_{c}") for c in cols))
    x = mart.join(fresh, F.col("leg_id") == F.col("_leg_id"), "full")
    both = F.col("leg_id").isNotNull() & F.col("_leg_id").isNotNull()
    differ = lambda *cs: both & reduce(lambda a, b: a | b, (~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cs))
    chain_values = F.coalesce("turnaround", "inbound_distance", "position").isNotNull()
    inbound = F.coalesce("has_inbound", F.lit(False))
    arms = {
        "turnaround_mismatch": differ("turnaround"),
        "inbound_attr_mismatch": differ("inbound_distance", "inbound_elapsed"),
        "position_or_day_mismatch": differ("position", "legs_today"),
        "flag_mismatch": differ("is_tight", "has_inbound"),
        "band_relabeled": differ("band"),
        "position_relabeled": differ("pos_key"),
        "class_mismatch": differ("link_class"),
        "unclear_link_not_nulled": (F.col("_link_class") == "c") & chain_values,
        "inbound_attrs_without_inbound": ~inbound & F.col("inbound_distance").isNotNull(),
        "inbound_without_attrs": inbound & (F.col("turnaround").isNull() | F.col("inbound_distance").isNull() | F.col("inbound_elapsed").isNull()),
        "tail_null_not_nulled": F.col("tail").isNull() & chain_values,
        "join_miss": F.col("_leg_id").isNull(),
        "leg_not_in_mart": F.col("leg_id").isNull(),
    }
    return _by_rule(x.agg(*(F.count_if(F.coalesce(c, F.lit(False))).cast("bigint").alias(n) for n, c in arms.items())))


def q_attribute_present(ref: DataFrame, used: DataFrame, key: str, attribute: str) -> DataFrame:
    """Keys in use whose reference row or attribute is missing."""
    known = ref.where(F.col(attribute).isNotNull()).select(key)
    return used.select(key).where(F.col(key).isNotNull()).distinct().join(known, key, "left_anti")


def q_constant_within(df: DataFrame, levels: dict[str, str], cols: list[str]) -> DataFrame:
    """(level, key, column) where a column takes two values within an entity; NULLs do not count."""
    keys = F.array(*(F.struct(F.lit(g).alias("level"), F.col(c).cast("string").alias("key")) for g, c in levels.items()))
    x = df.select(F.explode(keys).alias("_k"), *cols).select("_k.*", *cols).where("key IS NOT NULL")
    bounds = x.groupBy("level", "key").agg(*(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in cols))
    wrong = F.filter(F.array(*(F.when(F.col(f"{c}.lo") != F.col(f"{c}.hi"), F.lit(c)) for c in cols)), lambda v: v.isNotNull())
    return bounds.select("level", "key", F.explode(wrong).alias("column"))


def q_singleton(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).where("n <> 1")


def q_reconcile(app: DataFrame, truth: DataFrame, keys: list[str], value: str, tolerance: float) -> DataFrame:
    """Keys whose value differs between two frames, or is in one only."""
    t = truth.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col(value).alias("_v"))
    on = reduce(lambda a, b: a & b, (app[k].eqNullSafe(F.col(f"_{k}")) for k in keys))
    x = app.select(*keys, value).join(t, on, "full")
    differ = (F.abs(F.col(value) - F.col("_v")) > tolerance) | (F.col(value).isNull() != F.col("_v").isNull())
    return x.where(differ).select(*(F.coalesce(k, f"_{k}").alias(k) for k in keys), F.col(value).alias("got"), F.col("_v").alias("want"))


def q_view_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(position, want, got) of columns that break a view's contract of names, types and order."""
    want = [f"{f.name}:{f.dataType.simpleString()}" for f in schema]
    got = [f"{f.name}:{f.dataType.simpleString()}" for f in df.schema]
    size = max(len(want), len(got))
    pad = lambda xs: xs + [None] * (size - len(xs))
    rows = [(i, w, g) for i, (w, g) in enumerate(zip(pad(want), pad(got))) if w != g]
    return df.sparkSession.createDataFrame(rows, "position int, want string, got string")


def split_report(df: DataFrame, date: str, training: str) -> DataFrame:
    """One row: sizes and bounds of both sides of a split, and whether they are in order."""
    t = F.col(training)
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(t).cast("bigint").alias("n_train"),
        F.count_if(~t).cast("bigint").alias("n_test"),
        F.max(F.when(t, F.col(date))).alias("train_max"),
        F.min(F.when(~t, F.col(date))).alias("test_min"),
    )
    return one.withColumn("ok", (F.col("n") == F.col("n_train") + F.col("n_test")) & (F.col("train_max") < F.col("test_min")))


def carve(df: DataFrame, date: str, val_start: str, test_start: str) -> DataFrame:
    """fit, val or test by date."""
    d = F.col(date)
    return df.withColumn("part", F.when(d < F.lit(val_start).cast("date"), "fit").when(d < F.lit(test_start).cast("date"), "val").otherwise("test"))


def frame_parity(a: DataFrame, b: DataFrame, keys: list[str], may_move: tuple[str, ...] = ()) -> DataFrame:
    """(keys, column, a, b) of cells that differ, NULL-safe; columns that may move are left out."""
    cols = [c for c in a.columns if c not in keys and c not in may_move and c in b.columns]
    r = b.select(*(F.col(k).alias(f"_k_{k}") for k in keys), *(F.col(c).alias(f"_b_{c}") for c in cols))
    x = a.join(r, [a[k].eqNullSafe(F.col(f"_k_{k}")) for k in keys], "full")
    cell = lambda c: F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("a"), F.col(f"_b_{c}").cast("string").alias("b"))
    moved = F.filter(F.array(*(F.when(~F.col(c).eqNullSafe(F.col(f"_b_{c}")), cell(c)) for c in cols)), lambda v: v.isNotNull())
    return x.select(*(F.coalesce(k, f"_k_{k}").alias(k) for k in keys), F.explode(moved).alias("x")).select(*keys, "x.*")


def validate_requests(df: DataFrame) -> DataFrame:
    """Scoring requests with all reject reasons, joined by ';' in a fixed order, and whether they pass."""
    c = {n: F.col(n) for n in df.columns}
    pos, legs, turn, dist, elapsed, dens = c["position"], c["legs_today"], c["turnaround"], c["inbound_distance"], c["inbound_elapsed"], c["density"]
    some = lambda *xs: reduce(lambda a, b: a | b, (x.isNotNull() for x in xs))
    every = lambda *xs: reduce(lambda a, b: a & b, (x.isNotNull() for x in xs))
    reasons = {
        "distance_range": (c["distance"] <= 0) | (c["distance"] >= 20000),
        "position_range": ~pos.between(1, 30),
        "legs_range": ~legs.between(1, 30),
        "turnaround_range": ~turn.between(0, 840),
        "inbound_distance_range": (dist <= 0) | (dist >= 20000),
        "inbound_elapsed_range": (elapsed <= 0) | (elapsed > 900),
        "density_range": (dens <= 0) | (dens > 500),
        "rotation_without_position": pos.isNull() & some(legs, turn, dist, elapsed),
        "position_without_legs": pos.isNotNull() & legs.isNull(),
        "legs_below_position": legs < pos,
        "inbound_incomplete": some(turn, dist, elapsed) & ~every(turn, dist, elapsed),
        "inbound_missing": (pos >= 2) & ~every(turn, dist, elapsed),
    }
    found = F.array_join(F.array_compact(F.array(*(F.when(F.coalesce(v, F.lit(False)), F.lit(n)) for n, v in reasons.items()))), ";")
    return df.withColumn("reasons", found).withColumn("accepted", F.col("reasons") == "")


def q_held_out(df: DataFrame, day: str, floor: str) -> DataFrame:
    """Rows of a replay from before the first held-out day: none may be there."""
    return df.where(F.col(day).isNull() | (F.col(day) < F.lit(floor).cast("date")))


def gate_schema(df: DataFrame, registry: dict[str, str]) -> DataFrame:
    """``df`` with the registered columns in their order and types; raises if one is missing or of another kind."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wrong = [f"{c}: {found.get(c, 'missing')} instead of {t}" for c, t in registry.items() if found.get(c) != t]
    if wrong:
        raise ValueError("; ".join(wrong))
    return df.select(*registry)
