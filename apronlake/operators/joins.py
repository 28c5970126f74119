"""Join operators: dimension lookups, as-of, nearest neighbour, intervals, connections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import written

#: A side is broadcast only if it has no more rows than this.
BROADCAST_ROWS = 200_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count up to the bound allows it, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def enrich(df: DataFrame, dim: DataFrame, key: str, prefix: str) -> DataFrame:
    """Left join on a unique key of ``dim`` (its first column); its other columns get a prefix."""
    of, *rest = dim.columns
    named = dim.select(F.col(of).alias(f"_{prefix}"), *(F.col(c).alias(f"{prefix}_{c}") for c in rest))
    return df.join(named, df[key] == F.col(f"_{prefix}"), "left").drop(f"_{prefix}")


def nk_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Null-safe join on a natural key; the keys come from the left."""
    named = right.select(*(F.col(k).alias(f"_r_{k}") for k in keys), *(c for c in right.columns if c not in keys))
    on = reduce(lambda a, b: a & b, (left[k].eqNullSafe(F.col(f"_r_{k}")) for k in keys))
    return left.join(named, on, how).drop(*(f"_r_{k}" for k in keys))


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Columns of a one-row frame on every row."""
    return df.crossJoin(F.broadcast(one_row.limit(1)))


def join_levels(df: DataFrame, rates: DataFrame, levels: dict[str, tuple[str, str]], values: list[str]) -> DataFrame:
    """Look up one (level, key) table once for each prefix: {prefix: (level, key column)}."""
    for prefix, (level, key) in levels.items():
        of = rates.where(F.col("level") == level).select(F.col("key").alias(f"_{prefix}"), *(F.col(v).alias(f"{prefix}_{v}") for v in values))
        df = df.join(of, df[key] == F.col(f"_{prefix}"), "left").drop(f"_{prefix}")
    return df


def asof_backward(left: DataFrame, right: DataFrame, by: tuple[str, str], lts: str, rts: str, hours: int) -> DataFrame:
    """Latest right row of the key in (lts - hours, lts]; left rows without one are kept.

    ``right`` has one row for a key and time. Distinct (key, time) pairs of the left meet the
    last right time of each earlier hour of their range, then of each earlier minute of their
    own hour, then the right times of their own minute: equi-joins of a bounded number of rows
    a pair, however many rows a key has an hour. Only times are joined and aggregated; the
    payload is joined after.
    """
    lby, rby = by
    cut = lambda unit, c: F.date_trunc(unit, c).cast("timestamp_ntz")
    at, last = F.col("_at"), F.col("_seen")
    back = at - F.expr(f"INTERVAL {hours} HOURS")
    times = left.select(F.col(lby).alias("_by"), F.col(lts).alias("_at")).where("_by IS NOT NULL AND _at IS NOT NULL").distinct()
    times = times.withColumns({"_hour": cut("hour", at), "_minute": cut("minute", at)})
    seen = right.select(F.col(rby).alias("_by"), F.col(rts).alias("_seen")).where("_by IS NOT NULL AND _seen IS NOT NULL")
    minutes = seen.groupBy("_by", cut("minute", last).alias("_of")).agg(F.max("_seen").alias("_seen")).withColumn("_hour", cut("hour", F.col("_of")))
    ends = minutes.groupBy("_by", "_hour").agg(F.max("_seen").alias("_seen"))
    earlier = times.withColumn("_hour", F.explode(F.sequence(cut("hour", back), F.col("_hour") - F.expr("INTERVAL 1 HOUR"), F.expr("INTERVAL 1 HOUR")))).join(ends, ["_by", "_hour"])
    own_hour = times.join(minutes, ["_by", "_hour"]).where("_of < _minute")
    own_minute = times.join(seen.withColumn("_minute", cut("minute", last)), ["_by", "_minute"])
    met = reduce(DataFrame.unionByName, (x.select("_by", "_at", "_seen") for x in (earlier, own_hour, own_minute)))
    found = met.where((last > back) & (last <= at)).groupBy("_by", "_at").agg(F.max("_seen").alias("_seen"))
    payload = right.select(F.col(rby).alias("_by"), F.col(rts).alias("_seen"), *(c for c in right.columns if c != rby))
    of = found.join(payload, ["_by", "_seen"]).drop("_seen").withColumnsRenamed({"_by": "_rby", "_at": "_rat"})
    return left.join(of, (left[lby] == F.col("_rby")) & (left[lts] == F.col("_rat")), "left").drop("_rby", "_rat")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = 6371.01) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def nearest(left: DataFrame, right: DataFrame, left_id: str, right_id: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """(left id, right id, distance_km) of the nearest right place; ties go to the smaller id.

    Both have lat and lon; rows without them are left out. The left side (places) is broadcast
    if it has ``rows`` rows at most, so each task keeps only the best of its right rows and one
    row a place moves; else both sides meet by grid cells.
    """
    l = left.where("lat IS NOT NULL AND lon IS NOT NULL").select(left_id, F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    r = right.where("lat IS NOT NULL AND lon IS NOT NULL").select(right_id, "lat", "lon")
    if l.limit(rows + 1).count() > rows:
        best = _nearest_by_cells(l, r, left_id, right_id)
    else:
        best = r.crossJoin(F.broadcast(l)).withColumn("_d", _distance()).groupBy(left_id).agg(F.min(F.struct("_d", right_id)).alias("_b"))
    return best.select(left_id, F.col(f"_b.{right_id}").alias(right_id), F.round("_b._d", 2).alias("distance_km"))


def _distance() -> Column:
    return haversine_km(F.col("_lat"), F.col("_lon"), F.col("lat"), F.col("lon"))


def _cells(lat: str, lon: str, edge: float) -> list[Column]:
    """Cell of a place in a grid of cubes around the unit sphere; poles and the date line are no edges there."""
    la, lo = F.radians(F.col(lat)), F.radians(F.col(lon))
    at = (F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la))
    return [F.floor(c / edge).cast("int").alias(f"_c{i}") for i, c in enumerate(at)]


def _nearest_by_cells(l: DataFrame, r: DataFrame, left_id: str, right_id: str, edge: float = 0.02) -> DataFrame:
    """Nearest by equi-joins on cells: a place meets the right rows of its cell and the 26 around it.

    Whatever is within one edge (as a chord) is in these cells, so a best distance below it is
    final; places without one go on with edges twice as long, until the cells hold the sphere.
    """
    steps, done = F.array(*(F.lit(i) for i in (-1, 0, 1))), None
    while True:
        around = l
        for i, c in enumerate(_cells("_lat", "_lon", edge)):
            around = around.withColumn(f"_s{i}", F.explode(steps)).withColumn(f"_c{i}", c + F.col(f"_s{i}"))
        met = around.join(r.select("*", *_cells("lat", "lon", edge)), ["_c0", "_c1", "_c2"])
        best = met.withColumn("_d", _distance()).groupBy(left_id).agg(F.min(F.struct("_d", right_id)).alias("_b"))
        last = edge >= 2
        near = best if last else best.where(2 * F.sin(F.col("_b._d") / (2 * 6371.01)) < 0.999 * edge)
        near = written(near, "nearest")
        done = near if done is None else done.unionByName(near)
        if last:
            return done
        l = written(l.join(near.select(left_id), left_id, "left_anti"), "places")
        edge *= 2


def interval_lookup(points: DataFrame, intervals: DataFrame, by: str, at: str, start: str, minutes: str, value: str) -> DataFrame:
    """The value of the interval [start, start + minutes) of the key that holds each point.

    Intervals are listed under the hours they touch; of several, the one that starts first
    (then the smallest value) counts. Points without one are kept. Intervals of one start and
    end are one before they meet points, and the aggregates keep no structs, so they need no sort.
    """
    least = F.when(~F.bool_or(F.col("_value").isNull()), F.min("_value")).alias("_value")  # NULL is the smallest value
    i = intervals.select(F.col(by).alias("_by"), F.col(start).alias("_start"), F.timestamp_add("MINUTE", F.col(minutes).cast("int"), F.col(start)).alias("_end"), F.col(value).alias("_value"))
    i = i.groupBy("_by", "_start", "_end").agg(least)
    i = i.withColumn("_hour", F.explode(F.transform(F.sequence(F.lit(0), F.timestamp_diff("HOUR", F.date_trunc("hour", F.col("_start")), F.col("_end").cast("timestamp")).cast("int")), lambda h: F.timestamp_add("HOUR", h, F.date_trunc("hour", F.col("_start")).cast("timestamp_ntz")))))
    p = points.select(F.col(by).alias("_pby"), F.col(at).alias("_at")).distinct().withColumn("_phour", F.date_trunc("hour", F.col("_at")).cast("timestamp_ntz"))
    met = p.join(i, (F.col("_pby") == F.col("_by")) & (F.col("_phour") == F.col("_hour"))).where("_start <= _at AND _at < _end")
    first = met.groupBy("_pby", "_at", "_start").agg(least).groupBy("_pby", "_at").agg(F.min_by("_value", "_start").alias(value))
    return points.join(first, (points[by] == F.col("_pby")) & (points[at] == F.col("_at")), "left").drop("_pby", "_at")


#: Connections are made by so many tasks that each has about so many legs; more only where Spark's own setting says so.
LEGS_A_TASK = 10_000
#: Legs in a run of first legs, and of second ones: whole bytes of ids in what is written.
FIRST_LEGS, SECOND_LEGS = 128, 128


def _runs(legs: DataFrame, key: list[str], order: list[str], most: int, name: str) -> DataFrame:
    """Runs of ``most`` legs of a key at most, in order: ``name`` is an array of the other columns, those of ``order`` first."""
    rest = [c for c in legs.columns if c not in key and c not in order]
    number = F.row_number().over(W.partitionBy(*key).orderBy(*order))
    numbered = legs.withColumn("_run", F.floor((number - 1) / most))
    return numbered.groupBy(*key, "_run").agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias(name)).drop("_run")


def connections(board: DataFrame, wait: int = 30, most: int = 240, keep: tuple[str, ...] = (), lookup: DataFrame | None = None) -> DataFrame:
    """Pairs of legs at one airport and date: the second leaves ``wait`` to ``most`` minutes after the first arrives.

    Legs that come from one place, or go to one, meet as runs in order of time: arrays, joined by
    (airport, date, hour) and dealt by that key to as many tasks as the legs need. Pairs are made
    from two runs at a time, so no task holds more than those, each second leg of a run beside
    each first: the result repeats itself in what is written, and the ids of a file stay few.
    Columns in ``keep`` come along from the first leg, and those of ``lookup`` (small, by its
    first column, which is one of them) meet each first leg of two runs, not each pair.
    """
    n = max(int(board.sparkSession.conf.get("spark.sql.shuffle.partitions")), board.count() // LEGS_A_TASK)
    key, hour = ["_d", "_at", "_h"], lambda minute: F.floor(minute / 60)
    arrival = F.col("dep_min") + F.col("elapsed_min")
    a = board.select(F.col("leg_id").alias("first_id"), F.col("leg_date").alias("_d"), F.col("dest").alias("_at"), F.col("origin").alias("_from"), arrival.alias("arr_min"), *keep).where("arr_min <= 1439")
    a = _runs(a.withColumn("_h", hour(F.col("arr_min"))), [*key, "_from"], ["arr_min", "first_id"], FIRST_LEGS, "_first")
    a = a.withColumn("_since", F.col("_first")[0]["arr_min"] + wait).withColumn("_until", F.element_at("_first", -1)["arr_min"] + most)
    a = a.withColumn("_h", F.explode(F.sequence(hour(F.col("_since")), F.least(hour(F.col("_until")), F.lit(23)))))
    b = board.select(F.col("leg_id").alias("second_id"), F.col("leg_date").alias("_d"), F.col("origin").alias("_at"), F.col("dest").alias("_to"), "dep_min", hour(F.col("dep_min")).alias("_h"))
    b = _runs(b, [*key, "_to"], ["dep_min", "second_id"], SECOND_LEGS, "_second")
    reach = (F.element_at("_second", -1)["dep_min"] >= F.col("_since")) & (F.col("_second")[0]["dep_min"] <= F.col("_until"))
    met = a.repartition(n, *key).hint("merge").join(b.repartition(n, *key), key).where(reach & (F.col("_from") != F.col("_to")))
    # Compiled apart from the join, which else holds all pairs of a run of first legs at once.
    firsts = met.select("_d", "_at", "_first", "_second").coalesce(n).select("_d", "_at", "_second", F.inline("_first"))
    if lookup is not None:
        firsts = firsts.join(F.broadcast(lookup), lookup.columns[0], "left")
    gap, along = F.col("dep_min") - F.col("arr_min"), [c for c in firsts.columns if c not in ("_d", "_at", "_second", "first_id", "arr_min")]
    pairs = firsts.select("_d", "_at", "first_id", "arr_min", *along, F.inline("_second")).where((gap >= wait) & (gap <= most))
    return pairs.select("first_id", "second_id", F.col("_d").alias("leg_date"), F.col("_at").alias("airport"), gap.alias("layover"), *along)


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is not in the parent; NULL keys are not orphans."""
    p = parent.select(F.col(parent_key).alias("_p"))
    return child.where(F.col(key).isNotNull()).join(p, child[key] == F.col("_p"), "left_anti")


def nearest_covered(left: DataFrame, right: DataFrame, coverage: DataFrame, left_id: str, right_id: str, least_days: int) -> DataFrame:
    """nearest() among right places with at least ``least_days`` days in ``coverage`` (right id, days)."""
    good = coverage.where(F.col("days") >= least_days).select(F.col(right_id).alias("_good"))
    return nearest(left, right.join(good, right[right_id] == F.col("_good"), "left_semi"), left_id, right_id)


def with_coordinates(view: DataFrame, places: DataFrame, key: str, place: str) -> DataFrame:
    """Rows of a view whose place has coordinates, with them."""
    at = places.where("lat IS NOT NULL AND lon IS NOT NULL").select(F.col(place).alias("_at"), "lat", "lon")
    return view.join(small(at), view[key] == F.col("_at")).drop("_at")


def mask_unseen(df: DataFrame, seen: dict[str, DataFrame]) -> DataFrame:
    """``df`` with NULL for categories that are not in a column's vocabulary (one column, distinct),
    and ``<column>_unseen`` for each."""
    for c, vocabulary in seen.items():
        v = vocabulary.select(F.col(vocabulary.columns[0]).alias("_v")).where("_v IS NOT NULL").distinct()
        df = df.join(small(v), df[c] == F.col("_v"), "left").withColumn(f"{c}_unseen", F.col(c).isNotNull() & F.col("_v").isNull())
        df = df.withColumn(c, F.col("_v")).drop("_v")
    return df


def apply_hist(df: DataFrame, hist: DataFrame, levels: dict[str, tuple[str, str]], values: list[str]) -> DataFrame:
    """Overwrite ``<prefix>_<value>`` columns of a feature frame with those of another lookup."""
    old = {f"{p}_{v}" for p in levels for v in values}
    return join_levels(df.drop(*old), hist, levels, values)


def collapse(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """One row a key with its constant attributes; ``varying`` names those that are none, and these are NULL.

    NULLs do not count: an attribute that is missing in some rows is still constant.
    """
    of = df.groupBy(key).agg(*(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(f"_{c}") for c in cols), F.count(F.lit(1)).alias("n"))
    same = lambda c: F.col(f"_{c}.lo").eqNullSafe(F.col(f"_{c}.hi"))
    varying = F.array_join(F.array_compact(F.array(*(F.when(~same(c), F.lit(c)) for c in cols))), ",")
    return of.select(key, *(F.when(same(c), F.col(f"_{c}.lo")).alias(c) for c in cols), varying.alias("varying"), "n")
