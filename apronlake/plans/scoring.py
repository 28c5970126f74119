"""Queries of batch scoring and of operators on maps, reports and held-out rows, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apronlake.operators import joins as J
from apronlake.operators import model as Mo
from apronlake.operators import quality as Q
from apronlake.operators import rates as R
from apronlake.operators import windows as Wn

from . import fixtures as X
from . import marts as M
from . import staging as Sg
from .catalog import _features, six
from .oracles import _ADD, _AIR, _BASIS, _BIG, _FEAT, _FIVE, _HIST_COLS, _LEGS, _REQ, _ROT, _hist_joins, _rates

AS_OF = "2024-02-05T12:00:00"
#: Columns and types that a scorer takes.
SCORED = {"request_id": "bigint", "origin": "string", "dep_min": "bigint", "route_hist_rate": "double", "carrier_hist_rate": "double", "forecast_temp_f": "double"}
#: A linear model and its calibration, as a training run would hand them over.
WEIGHTS, INTERCEPT, PLATT = {"dep_min": 0.0005, "route_hist_rate": 2.0, "carrier_hist_rate": 1.5, "forecast_temp_f": -0.002}, -2.0, (0.9, 0.1)
#: Days of shipments that a station needs to stand for an airport.
COVERED_DAYS = 530


def _forecast(spark, d) -> DataFrame:
    grid = X.forecast_hours(M.decoded_observations(X.observations(spark, d)), AS_OF)
    return M.forecast_join(X.requests(spark, d), X.request_zones(spark, d), grid)


def forecast_weather(spark, d):
    """Forecast of the departure hour of each request, NULL where there is none."""
    return _forecast(spark, d).select("request_id", "has_weather", six(F.col("forecast_temp_f")).alias("forecast_temp_f"))


def batch_scores(spark, d):
    """Requests through the schema gate to raw, calibrated and baseline scores."""
    hist = R.smoothed_rates(M.rotation_mart(spark, d), R.GRAINS, X.CUTOFF)
    levels = {p: M.FEATURE_RATES[p] for p in ("route_hist", "carrier_hist")}
    x = J.join_levels(_forecast(spark, d).withColumn("route", F.concat("origin", F.lit("-"), "dest")), hist, levels, ["rate"])
    scored = Mo.score_linear(Q.gate_schema(x.select(*(F.col(c).cast(t).alias(c) for c, t in SCORED.items())), SCORED), WEIGHTS, INTERCEPT, PLATT, "carrier_hist_rate")
    return scored.select("request_id", six(F.col("raw_score")).alias("raw_score"), six(F.col("score")).alias("score"), six(F.col("carrier_hist_rate")).alias("baseline"), six(F.col("lift")).alias("lift"))


def proxy_day_scores(spark, d):
    """The board of each origin's last day, set to a day four weeks on and scored from lookups."""
    legs = X.legs(spark, d)
    board = Wn.latest_per(legs, ["origin"], "leg_date").select("leg_id", "origin", F.date_add("leg_date", 28).alias("target_day"), "route", "carrier", "dep_min", F.lit(None).cast("double").alias("forecast_temp_f"))
    hist = R.smoothed_rates(M.rotation_mart(spark, d), R.GRAINS, X.CUTOFF)
    x = J.join_levels(board, hist, {p: M.FEATURE_RATES[p] for p in ("route_hist", "carrier_hist")}, ["rate"])
    return Mo.score_linear(x, WEIGHTS, INTERCEPT, PLATT, "carrier_hist_rate").select("leg_id", "origin", "target_day", six(F.col("score")).alias("score"))


def masked_categories(spark, d):
    """Requests by column whose category was not seen in the first day, after masking."""
    early = X.legs(spark, d).where(F.col("leg_date") < "2024-01-02")
    r = X.requests(spark, d).withColumn("route", F.concat("origin", F.lit("-"), "dest"))
    x = J.mask_unseen(r, {"route": early.select("route"), "carrier": early.where("carrier <> 'error'").select("carrier")})
    n = lambda c: F.count_if(c).cast("long")
    return x.agg(n(F.col("route_unseen")).alias("route_unseen"), n(F.col("carrier_unseen")).alias("carrier_unseen"), F.count("carrier").alias("carrier_kept"))


def overwritten_hist(spark, d):
    """Feature rows whose rates are those of an earlier cutoff."""
    hist = R.smoothed_rates(M.rotation_mart(spark, d), R.GRAINS, "2024-01-17")
    x = J.apply_hist(_features(spark, d), hist, M.FEATURE_RATES, ["n", "rate", "avg_delay"])
    return x.select("leg_id", *(six(F.col(f"{p}_rate")).alias(f"{p}_rate") for p in M.FEATURE_RATES))


def verify_recompute(spark, d):
    """Counts, rates and mean delays on the feature rows (destinations too) against those counted anew from the rows' own labels."""
    f = _features(spark, d)
    said = F.array(*(F.struct(F.lit(level).alias("level"), F.col(c).cast("string").alias("key"), F.col(f"{p}_n").alias("n"), F.col(f"{p}_rate").alias("rate"), F.col(f"{p}_avg_delay").alias("mean")) for p, (level, c) in M.FEATURE_RATES.items()))
    given = f.select(F.explode(said).alias("k")).select("k.*").where("key IS NOT NULL")
    given = given.groupBy("level", "key").agg(*(g(c).alias(f"{n}_{c}") for c in ("n", "rate", "mean") for n, g in (("lo", F.min), ("hi", F.max))))
    own = F.array(*(F.struct(F.lit(level).alias("level"), F.col(c).cast("string").alias("key")) for level, c in R.GRAINS.items()))
    again = f.where("is_training_row").select(F.explode(own).alias("k"), "arr_del15", "arr_delay_min").select("k.*", "arr_del15", "arr_delay_min").where("key IS NOT NULL")
    again = again.groupBy("level", "key").agg(F.count(F.lit(1)).alias("n1"), F.count_if("arr_del15").alias("late"), F.sum("arr_delay_min").alias("minutes"))
    of = F.col("level") == "carrier"
    share = lambda c: F.sum(F.when(of, F.col(c))) / F.sum(F.when(of, F.col("n1")))
    prior = again.agg(share("late").alias("g"), share("minutes").alias("gd"))
    t = J.with_scalar(again.join(given, ["level", "key"], "full"), prior)
    smooth = lambda total, g: (F.col(total) + 50 * F.col(g)) / (F.col("n1") + 50)
    gap = lambda c, v: F.greatest(F.abs(F.col(f"lo_{c}") - v), F.abs(F.col(f"hi_{c}") - v))
    same = F.col("lo_n").eqNullSafe(F.col("n1")) & F.col("hi_n").eqNullSafe(F.col("n1"))
    return t.agg(F.count("n1").alias("n"), F.count_if(same & F.col("n1").isNotNull()).cast("long").alias("n_same"), F.count_if(~same).cast("long").alias("n_other"), six(F.max(gap("rate", smooth("late", "g")))).alias("max_diff"), six(F.max(gap("mean", smooth("minutes", "gd")))).alias("max_delay_diff"))


def airport_station_map(spark, d):
    """Nearest station with enough days of shipments to each airport."""
    days = X.read(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("station")).agg(F.countDistinct("l_shipdate").alias("days"))
    return J.nearest_covered(X.airports(spark, d), X.stations(spark, d), days, "airport", "station", COVERED_DAYS)


def map_points(spark, d):
    """Flights and delay counts of each origin with its coordinates."""
    mart = M.additive_mart(X.legs_big(spark, d), {"origin": F.col("origin")})
    return J.with_coordinates(mart, X.airports(spark, d), "origin", "airport").select("origin", "lat", "lon", "n_flights", "n_arr_del15")


def preferred_reports(spark, d):
    """One event of a user and hour, purchases before clicks before others."""
    e = X.read(spark, d, "events").withColumn("hour", F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz"))
    x = Wn.dedup(e, ["user_id", "hour"], [Wn.prefer(F.col("event_type"), ["purchase", "click"]), F.col("ts"), F.col("event_id")])
    return x.select("user_id", "hour", "event_id", "event_type")


def latest_reports(spark, d):
    """Latest event of each user."""
    return Wn.latest_per(X.read(spark, d, "events"), ["user_id"], "ts").select("user_id", "event_id", "event_type")


def one_leg_per_route(spark, d):
    """The earliest leg of each route, all columns from one row."""
    x = X.legs(spark, d).select("route", "leg_date", "dep_min", "leg_id", "carrier")
    return Wn.one_per_group(x, ["route"], ["leg_date", "dep_min", "leg_id"])


def holdout_guard(spark, d):
    """Legs of a replay by whether they are held out."""
    x = X.legs(spark, d)
    return Q.q_held_out(x, "leg_date", X.CUTOFF).groupBy("carrier").agg(F.count(F.lit(1)).alias("n_not_held_out"))


def hourly_reports(spark, d):
    """Events as reports without daily summaries and unreadable times, per type."""
    i = F.col("event_id")
    kind = F.when(i % 11 == 0, "SOD").when(i % 13 == 0, "SOM").when(i % 7 != 0, "FM-15")
    at = F.when(i % 17 == 0, "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    x = X.read(spark, d, "events").select("event_type", kind.alias("kind"), at.alias("at"))
    return Sg.drop_summaries(x, "kind", "at").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count("kind").alias("n_kind"))


def display_labels(spark, d):
    """Labels of nations as airports and of their customers' segments as carriers."""
    c = X.read(spark, d, "customer")
    k = F.col("c_custkey")
    name, city = F.when(k % 3 == 0, F.col("c_name")), F.when(k % 5 != 0, F.col("c_mktsegment")).otherwise(F.lit(" "))
    return c.select(k.alias("c_custkey"), Sg.airport_label(name, city, k.cast("string")).alias("airport_label"), Sg.carrier_label(city, k.cast("string"), F.when(k % 4 != 0, k % 2 == 0)).alias("carrier_label"))


_TWO = "LEFT JOIN sm h0 ON h0.level = 'route' AND h0.key = {t}.route LEFT JOIN sm h1 ON h1.level = 'carrier' AND h1.key = {t}.carrier"
_Z = "(-2.0 + 0.0005 * dep_min + 2.0 * coalesce(h0.rate, 0) + 1.5 * coalesce(h1.rate, 0) - 0.002 * coalesce(temp, 0))"
_GRID = "gr AS (SELECT station, date_trunc('hour', obs_ts + INTERVAL 28 DAY) AS gh, avg(temp_f) AS temp FROM obs WHERE temp_f IS NOT NULL AND obs_ts + INTERVAL 28 DAY < TIMESTAMP '2024-02-12 12:00:00' GROUP BY ALL), fw AS (SELECT ba2.*, origin || '-' || dest AS route, gh IS NOT NULL AS has_weather, temp FROM ba2 LEFT JOIN gr ON gr.station = origin AND gh = date_trunc('hour', dep))"
_FORM = "round(1 / (1 + exp(-{z})), 6)"

QUERIES = {
    f.__name__: f
    for f in (
        forecast_weather, batch_scores, proxy_day_scores, masked_categories, overwritten_hist, verify_recompute, airport_station_map, map_points,
        preferred_reports, latest_reports, one_leg_per_route, holdout_guard, hourly_reports, display_labels,
    )
}

ORACLES = {
    "forecast_weather": f"WITH {_BASIS}, {_GRID} SELECT request_id, has_weather, round(temp, 6) AS forecast_temp_f FROM fw",
    "batch_scores": f"WITH {_BASIS}, {_GRID}, {_ROT}, {_rates('rot', _FIVE, '2024-01-24')}, z AS (SELECT request_id, {_Z} AS z, h1.rate AS b FROM fw {_TWO.format(t='fw')}) "
    f"SELECT request_id, {_FORM.format(z='z')} AS raw_score, {_FORM.format(z='(0.9 * z + 0.1)')} AS score, round(b, 6) AS baseline, round(1 / (1 + exp(-(0.9 * z + 0.1))) - b, 6) AS lift FROM z",
    "proxy_day_scores": f"WITH {_LEGS}, {_ROT}, {_rates('rot', _FIVE, '2024-01-24')}, bd AS (SELECT *, NULL::DOUBLE AS temp FROM (SELECT *, max(leg_date) OVER (PARTITION BY origin) AS ld FROM legs) WHERE leg_date = ld), "
    f"z AS (SELECT leg_id, origin, leg_date + 28 AS target_day, {_Z} AS z FROM bd {_TWO.format(t='bd')}) SELECT leg_id, origin, target_day, {_FORM.format(z='(0.9 * z + 0.1)')} AS score FROM z",
    "masked_categories": f"WITH {_REQ}, s AS (SELECT DISTINCT route FROM legs WHERE leg_date < DATE '2024-01-02'), c AS (SELECT DISTINCT carrier FROM legs WHERE leg_date < DATE '2024-01-02' AND carrier <> 'error') "
    "SELECT count(*) FILTER (origin || '-' || dest NOT IN (FROM s)) AS route_unseen, count(*) FILTER (carrier NOT IN (FROM c)) AS carrier_unseen, count(*) FILTER (carrier IN (FROM c)) AS carrier_kept FROM req",
    "overwritten_hist": f"WITH {_FEAT.replace('2024-01-24', '2024-01-17')} SELECT leg_id, {_HIST_COLS} FROM f3 {_hist_joins('f3')}",
    "verify_recompute": f"WITH {_LEGS}, {_ROT}, {_rates('rot', _FIVE, '2024-01-24')}, tr AS (SELECT * FROM rot WHERE NOT cancelled AND NOT diverted AND leg_date < DATE '2024-01-24'), "
    "rc AS (" + " UNION ALL ".join(f"SELECT '{g}' AS level, {c}::VARCHAR AS key, count(*) AS n1, sum(arr_del15::INT) AS late, sum(arr_delay_min) AS mins FROM tr WHERE {c} IS NOT NULL GROUP BY {c}" for g, c in _FIVE.items()) + "), "
    "pr AS (SELECT avg(arr_del15::INT) AS g, avg(arr_delay_min) AS gd FROM tr), j AS (SELECT * FROM rc FULL JOIN sm USING (level, key), pr) "
    "SELECT count(n1) AS n, count(*) FILTER (n = n1) AS n_same, count(*) FILTER (n IS DISTINCT FROM n1) AS n_other, round(max(abs(rate - (late + 50 * g) / (n1 + 50))), 6) AS max_diff, round(max(abs(avg_delay - (mins + 50 * gd) / (n1 + 50))), 6) AS max_delay_diff FROM j",
    "airport_station_map": f"WITH {_AIR}, cov AS (SELECT l_suppkey FROM lineitem GROUP BY l_suppkey HAVING count(DISTINCT l_shipdate) >= 530), "
    "st AS (SELECT s_suppkey AS station, (-60 + (s_suppkey * 29) % 120)::DOUBLE AS la, (-180 + (s_suppkey * 73) % 360)::DOUBLE AS lo FROM supplier WHERE s_suppkey IN (FROM cov)), "
    "p AS (SELECT airport, station, 2 * 6371.01 * asin(sqrt(least(pow(sin(radians(la - lat) / 2), 2) + cos(radians(lat)) * cos(radians(la)) * pow(sin(radians(lo - lon) / 2), 2), 1.0))) AS d FROM air, st) "
    "SELECT airport, first(station ORDER BY d, station) AS station, round(min(d), 2) AS distance_km FROM p GROUP BY airport",
    "map_points": f"WITH {_BIG}, {_AIR}, m AS (SELECT origin, {_ADD} FROM big GROUP BY origin) SELECT origin, lat, lon, n_flights, n_arr_del15 FROM m JOIN air ON airport = origin",
    "preferred_reports": "SELECT user_id, hour, event_id, event_type FROM (SELECT *, date_trunc('hour', ts) AS hour, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 ELSE 2 END, ts, event_id) AS rn FROM events) WHERE rn = 1",
    "latest_reports": "SELECT user_id, event_id, event_type FROM (SELECT *, max(ts) OVER (PARTITION BY user_id) AS last FROM events) WHERE ts = last",
    "one_leg_per_route": f"WITH {_LEGS} SELECT route, leg_date, dep_min, leg_id, carrier FROM (SELECT *, row_number() OVER (PARTITION BY route ORDER BY leg_date, dep_min, leg_id) AS rn FROM legs) WHERE rn = 1",
    "holdout_guard": f"WITH {_LEGS} SELECT carrier, count(*) AS n_not_held_out FROM legs WHERE leg_date < DATE '2024-01-24' GROUP BY carrier",
    "hourly_reports": "SELECT event_type, count(*) AS n, count(*) FILTER (event_id % 7 <> 0) AS n_kind FROM events WHERE event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0 GROUP BY event_type",
    "display_labels": "WITH l AS (SELECT c_custkey, c_custkey::VARCHAR AS k, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS s, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment ELSE c_custkey::VARCHAR END AS c FROM customer) "
    "SELECT c_custkey, CASE WHEN s IS NOT NULL THEN s || ' (' || k || ')' ELSE k END AS airport_label, CASE WHEN c_custkey % 4 <> 0 AND c_custkey % 2 = 0 THEN c || ' (regional)' ELSE c END AS carrier_label FROM l",
}
