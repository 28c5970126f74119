"""Queries of landing in commits, files of differing headers, rolling tables and canonical order, with their DuckDB SQL.

Each derives its files or streams from the given tables, whole, in the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from apronlake.operators import windows as Wn
from apronlake.operators.scratch import scratch_path, until_end
from apronlake.sources import commits as Co
from apronlake.sources import headers as H
from apronlake.sources import ordered as O
from apronlake.streaming import rolling as Ro
from apronlake.streaming import streams as St

from . import fixtures as X
from .oracles import _LEGS

#: Slices in which events arrive, by event_id: each spans all days, so that many rows are late.
SLICES, DELAY = 4, "12 DAYS"


def landing_statuses(spark, d):
    """Orders by month, landed twice: the second time some months have changed, and some hold rows of no known status."""
    o = X.read(spark, d, "orders").withColumn("month_start", F.trunc("o_orderdate", "month"))
    path = scratch_path(spark, "landed")
    Co.land(o, path, ["month_start"])
    until_end(spark, path)
    month = F.month("month_start")
    changed = o.withColumn("o_totalprice", F.when(month % 3 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))).withColumn("o_orderstatus", F.when((month == 5) & (F.col("o_orderkey") % 2 == 0), "?").otherwise(F.col("o_orderstatus")))
    status = Co.land(changed, path, ["month_start"], valid=F.col("o_orderstatus") != "?")
    now = Co.read_landed(spark, path).groupBy("month_start").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return status.join(now, "month_start").select("month_start", "status", "n", "total")


def conformed_csv(spark, d):
    """Customers from CSV files of three layouts; a layout lacks what the others have."""
    c = X.read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.concat(F.lit('Say "'), "c_name", F.lit('", twice')).alias("name"), F.col("c_mktsegment").alias("segment"))
    path = scratch_path(spark, "layouts")
    layouts = (["key", "name", "segment"], ["segment", "key"], ["name", "key"])
    for i, columns in enumerate(layouts):
        part = c.where(F.col("key").cast("long") % len(layouts) == i)
        part.select(*(F.col(x).alias(f"{x}, given") for x in columns)).write.options(header=True, escape='"').csv(f"{path}/{i}")
    until_end(spark, path)
    x = H.conform(spark, [f"{path}/{i}" for i in range(len(layouts))], [f"{x}, given" for x in layouts[0]])
    return x.select(F.col("key, given").cast("long").alias("key"), F.col("name, given").alias("name"), F.col("segment, given").alias("segment"))


def _fed(spark, d, table: Ro.Rolling) -> Ro.Rolling:
    """``table`` after all events came in as many micro-batches as there are slices."""
    events = X.read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    source = scratch_path(spark, "arrived")
    for i in range(SLICES):
        events.where(F.col("event_id") % SLICES == i).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        table.start(stream, f"{table.path}/checkpoint").awaitTermination()
    until_end(spark, source)
    until_end(spark, table.path)
    return table


def rolling_mart(spark, d):
    """Events and value by day and type as they came in, and the late ones among them, which no sum holds."""
    table = _fed(spark, d, Ro.rolling_sums(scratch_path(spark, "rolling"), "ts", ["event_type"], "value", "1 day", DELAY))
    late = table.late(spark).withColumnRenamed("n", "n_late")
    x = table.read(spark).join(late, ["window_start", "event_type"], "full")
    none = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return x.select(F.col("window_start").cast("date").alias("day"), "event_type", none("n"), none("n_late"), F.round("sum_value", 4).alias("sum_value"))


def rolling_best(spark, d):
    """The best event of each user and hour as they came in, purchases before clicks before others."""
    order = {"kind": Wn.prefer(F.col("event_type"), ["purchase", "click"]), "ts": F.col("ts"), "id": F.col("event_id")}
    table = _fed(spark, d, Ro.rolling_best(scratch_path(spark, "best"), "ts", ["user_id"], order, "1 hour", "60 DAYS"))
    return table.read(spark).select("user_id", F.col("window_start").alias("hour"), "event_id", "event_type")


def scored_stream(spark, d):
    """Events landed as they came and scored with rates that change halfway; an unknown type gets no rate."""
    events = X.read(spark, d, "events").select("event_id", "event_type").withColumnRenamed("event_type", "kind")
    source, landed, lookup, out = (scratch_path(spark, n) for n in ("arrived", "stream-landed", "lookup", "scored"))
    kinds = events.select("kind").distinct()
    for i in range(SLICES):
        if i % 2 == 0:  # a new version before the first and the third slice
            rate = F.length("kind") / 10 + i
            Co.land(kinds.where("kind <> 'error'" if i == 0 else "true").withColumn("rate", rate), lookup, ["kind"])
        events.where(F.col("event_id") % SLICES == i).write.mode("append").parquet(source)
        St.land_incremental(spark, source, landed, f"{landed}-checkpoint", events.schema).awaitTermination()
        stream = spark.readStream.schema(events.schema).parquet(landed)
        Ro.score_stream(stream, lookup, "kind", out, f"{out}-checkpoint").awaitTermination()
    for path in (source, landed, lookup, out, f"{landed}-checkpoint", f"{out}-checkpoint"):
        until_end(spark, path)
    return spark.read.parquet(out).select("event_id", "kind", F.round("rate", 6).alias("rate"), F.col("lookup_version").cast("long").alias("lookup_version"))


def canonical_positions(spark, d):
    """The place of each leg in the order of its natural key, from files in that order and their manifest."""
    path = scratch_path(spark, "ordered")
    legs = X.legs(spark, d).select("leg_date", "carrier", "flight_number", "origin", "dest", "dep_min", "leg_id")
    O.write_ordered(legs, path, ["leg_date", "carrier", "flight_number", "origin", "dest", "dep_min"])
    until_end(spark, path)
    return O.positions(spark, path).select("leg_id", "position")


def canonical_manifest(spark, d):
    """What the files in order hold together: rows, ends, and how many files or rows are out of order."""
    path = scratch_path(spark, "ordered")
    legs = X.legs(spark, d).select("leg_date", "dep_min", "leg_id")
    O.write_ordered(legs, path, ["leg_date", "dep_min", "leg_id"])
    m = O.read_manifest(spark, until_end(spark, path))
    ends = m.agg(F.sum("rows").alias("n"), F.min("first").alias("a"), F.max("last").alias("b"))
    ends = ends.select("n", F.col("a.leg_date").alias("first_day"), F.col("a.leg_id").alias("first_id"), F.col("b.leg_date").alias("last_day"), F.col("b.leg_id").alias("last_id"))
    bad = O.overlaps(m).agg(F.count(F.lit(1)).alias("n_overlaps"))
    return ends.crossJoin(F.broadcast(bad)).crossJoin(F.broadcast(O.disorder(spark, path).agg(F.count(F.lit(1)).alias("n_out_of_order"))))


QUERIES = {f.__name__: f for f in (landing_statuses, conformed_csv, rolling_mart, rolling_best, scored_stream, canonical_positions, canonical_manifest)}

_ARRIVED = """e AS (SELECT *, event_id % 4 AS s FROM events), w AS (SELECT s, max(ts) AS m FROM e GROUP BY s),
mark AS (SELECT a.s, max(b.m) - INTERVAL 12 DAY AS mark FROM w a JOIN w b ON b.s < a.s GROUP BY a.s),
f AS (SELECT e.*, coalesce(ts < mark, false) AS late FROM e LEFT JOIN mark USING (s))"""

ORACLES = {
    "landing_statuses": "WITH o AS (SELECT date_trunc('month', o_orderdate)::DATE AS month_start, month(o_orderdate) AS m, o_orderkey, o_totalprice FROM orders), "
    "g AS (SELECT month_start, any_value(m) AS m, count(*) AS n, sum(o_totalprice) AS t, bool_or(m = 5 AND o_orderkey % 2 = 0) AS bad FROM o GROUP BY month_start) "
    "SELECT month_start, CASE WHEN bad THEN 'failed' WHEN m % 3 = 0 THEN 'landed' ELSE 'skipped' END AS status, n, round(CASE WHEN m % 3 = 0 THEN t + n ELSE t END, 2) AS total FROM g",
    "conformed_csv": "SELECT c_custkey::BIGINT AS key, CASE WHEN c_custkey % 3 <> 1 THEN 'Say \"' || c_name || '\", twice' END AS name, CASE WHEN c_custkey % 3 <> 2 THEN c_mktsegment END AS segment FROM customer",
    "rolling_mart": f"WITH {_ARRIVED} SELECT ts::DATE AS day, event_type, count(*) FILTER (NOT late) AS n, count(*) FILTER (late) AS n_late, round(sum(value) FILTER (NOT late), 4) AS sum_value FROM f GROUP BY ALL",
    "rolling_best": "SELECT user_id, hour, event_id, event_type FROM (SELECT *, date_trunc('hour', ts) AS hour, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 ELSE 2 END, ts, event_id) AS rn FROM events) WHERE rn = 1",
    "scored_stream": "SELECT event_id, event_type AS kind, CASE WHEN event_id % 4 >= 2 THEN round(length(event_type) / 10 + 2, 6) WHEN event_type <> 'error' THEN round(length(event_type) / 10, 6) END AS rate, CASE WHEN event_id % 4 >= 2 THEN 2 ELSE 1 END::BIGINT AS lookup_version FROM events",
    "canonical_positions": f"WITH {_LEGS} SELECT leg_id, row_number() OVER (ORDER BY leg_date, carrier, flight_number NULLS FIRST, origin, dest, dep_min, leg_id) AS position FROM legs",
    "canonical_manifest": f"WITH {_LEGS}, s AS (SELECT leg_date, leg_id, row_number() OVER (ORDER BY leg_date, dep_min, leg_id) AS i, count(*) OVER () AS n FROM legs) "
    "SELECT max(n) AS n, max(leg_date) FILTER (i = 1) AS first_day, max(leg_id) FILTER (i = 1) AS first_id, max(leg_date) FILTER (i = n) AS last_day, max(leg_id) FILTER (i = n) AS last_id, 0::BIGINT AS n_overlaps, 0::BIGINT AS n_out_of_order FROM s",
}
