"""Dashboard views over the marts and full hourly observations, with their DuckDB SQL.

A view is a thin projection: labels by joins with small dimensions, and rates over sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apronlake.functions import cleaning as C
from apronlake.operators import joins as J
from apronlake.operators import rates as R

from . import fixtures as X
from . import marts as M
from . import staging as Sg
from .oracles import _ADD, _AIR, _BIG, _SEASON, _entity

ENTITY = ("n_flights", "delay_rate", "on_time_rate", "cancel_rate", "avg_delay", "p90_delay", "hist_rate")


def _on_time(df: DataFrame) -> DataFrame:
    return df.withColumn("on_time_rate", F.round(1 - F.col("delay_rate"), 6))


def _mart(spark, d, entity: str, level: str) -> DataFrame:
    legs = X.legs_big(spark, d)
    hist = R.historical_rates(legs, {"route": "route", "carrier": "carrier", "airport": "origin"}, X.BIG_CUTOFF)
    return _on_time(M.entity_mart(legs, entity, hist, level))


def _zones(spark, d) -> DataFrame:
    return X.airports(spark, d).select("airport", "tz")


def view_airport_reliability(spark, d):
    """Measures of each origin with its time zone."""
    return J.enrich(_mart(spark, d, "origin", "airport"), _zones(spark, d), "origin", "airport").select("origin", "airport_tz", *ENTITY)


def view_carrier_reliability(spark, d):
    """Measures of each carrier with its display name."""
    names = X.read(spark, d, "customer").select(F.col("c_mktsegment").alias("code"), F.initcap("c_mktsegment").alias("name"), (F.length("c_mktsegment") > 9).alias("is_regional")).distinct()
    return J.enrich(_mart(spark, d, "carrier", "carrier"), J.small(names), "carrier", "carrier").select("carrier", "carrier_name", "carrier_is_regional", *ENTITY)


def view_route_drilldown(spark, d):
    """Measures of each route with the zones of both its ends."""
    ends = F.split("route", "-")
    x = _mart(spark, d, "route", "route").withColumns({"origin": ends[0], "dest": ends[1]})
    x = J.enrich(J.enrich(x, _zones(spark, d), "origin", "origin"), _zones(spark, d), "dest", "dest")
    return x.select("route", "origin", "origin_tz", "dest", "dest_tz", *ENTITY)


def view_delays_by_time(spark, d):
    """Additive measures by month, weekday and hour with calendar labels."""
    keys = {"year_no": F.year("leg_date"), "month_no": F.month("leg_date"), "weekday": F.weekday("leg_date") + 1, "dep_hour": F.col("dep_hour")}
    mart = M.additive_mart(X.legs_big(spark, d), keys)
    return mart.withColumns({"month_name": _month("month_no"), "season": C.season(F.col("month_no")), "season_order": C.season_order(F.col("month_no")), "day_name": _day("weekday")})


def view_monthly_trend(spark, d):
    """Additive measures of each month with its labels."""
    mart = M.additive_mart(X.legs_big(spark, d), {"month_start": M.month_of("leg_date")})
    return mart.withColumns({"year_no": F.year("month_start"), "month_no": F.month("month_start"), "month_name": F.date_format("month_start", "MMM")})


def view_route_carrier(spark, d):
    """Additive measures and rates of each carrier on each route."""
    return _on_time(M.route_carrier_mart(X.legs_big(spark, d)).withColumns(R.rates())).select("route", "carrier", "n_flights", "delay_rate", "on_time_rate", "cancel_rate", "avg_delay")


def view_airport_hour_baseline(spark, d):
    """Training legs of each origin, weekday and hour, with zone and day's name."""
    mart = M.airport_hour_mart(X.legs_big(spark, d), X.BIG_CUTOFF)
    return J.enrich(mart, _zones(spark, d), "origin", "airport").withColumn("day_name", _day("weekday"))


def _day(c: str):
    """Mon to Sun of 1 to 7."""
    return F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col(c) - 1), "EEE")


def _month(c: str):
    return F.date_format(F.make_date(F.lit(2024), F.col(c), F.lit(1)), "MMM")


def hourly_observations(spark, d):
    """Packed hourly reports of every event, decoded: one for a station and hour, routine reports first.

    Summaries and unreadable times go; several depth and weather groups a report.
    """
    i = F.col("event_id")
    e = X.read(spark, d, "events")
    tenth = F.lpad((i % 400).cast("string"), 4, "0")
    quality = (i % 8).cast("string")
    packed = lambda *parts: F.concat_ws(",", *parts)
    raw = e.select(
        F.concat(F.lit("S"), F.col("user_id") % 50).alias("station"),
        F.when(i % 17 == 0, "?").otherwise(F.date_format(F.date_trunc("hour", F.col("ts")), "yyyy-MM-dd'T'HH:mm:ss")).alias("at"),
        F.element_at(F.array(*map(F.lit, ("FM-15", "FM-16", "FM-12", "SY-MT", "SOD"))), (i % 5 + 1).cast("int")).alias("kind"),
        i.alias("report"),
        packed(F.when(i % 10 == 0, F.lit("+9999")).otherwise(F.concat(F.lit("-"), tenth)), quality).alias("tmp"),
        packed(F.concat(F.lit("+"), tenth), quality).alias("dew"),
        packed(F.lit("180"), F.lit("1"), F.lit("N"), F.when(i % 9 == 0, F.lit("9999")).otherwise(tenth), F.lit("1")).alias("wnd"),
        packed(F.when(i % 6 == 0, F.lit("999999")).otherwise(F.lpad((i % 16000).cast("string"), 6, "0")), F.lit("1")).alias("vis"),
        F.when(i % 3 == 0, packed(tenth, F.lit("1"))).alias("oc1"),
        F.when(i % 2 == 0, packed(F.lit("06"), tenth, F.lit("9"), F.lit("1"))).alias("aa1"),
        F.when(i % 4 == 0, packed(F.lit("01"), tenth, F.lit("9"), quality)).alias("aa2"),
        packed((i % 100).cast("string"), F.lit("1")).alias("mw1"),
        F.when(i % 5 == 0, packed(F.lit("42"), quality)).alias("mw2"),
        packed(((i * 7) % 100).cast("string"), F.lit("5")).alias("aw1"),
    )
    x = Sg.hourly(raw, ["aa1", "aa2"], ["mw1", "mw2"], ["aw1"])
    return x.withColumns({c: F.round(c, 4) for c in ("temp_f", "dewpoint_f", "wind_kn", "visibility_mi", "gust_kn", "precip_in")})


QUERIES = {
    f.__name__: f
    for f in (view_airport_reliability, view_carrier_reliability, view_route_drilldown, view_delays_by_time, view_monthly_trend, view_route_carrier, view_airport_hour_baseline, hourly_observations)
}

_COLS = "n_flights, delay_rate, round(1 - delay_rate, 6) AS on_time_rate, cancel_rate, avg_delay, p90_delay, hist_rate"
_MON = "strftime({d}, '%b')"
_BAD = "(2, 3, 6, 7)"


def _in(c: str, *ranges: tuple[int, int]) -> str:
    return "(" + " OR ".join(f"{c} BETWEEN {a} AND {b}" for a, b in ranges) + ")"


def _flag(manual: tuple, automatic: tuple) -> str:
    return f"({_in('m1', *manual)} OR coalesce({_in('m2', *manual)}, false) OR {_in('a1', *automatic)})"


ORACLES = {
    "view_airport_reliability": f"WITH {_AIR}, m AS ({_entity('origin', 'airport')}) SELECT origin, tz AS airport_tz, {_COLS} FROM m LEFT JOIN air ON airport = origin",
    "view_carrier_reliability": f"WITH m AS ({_entity('carrier', 'carrier')}) SELECT carrier, upper(left(carrier, 1)) || lower(substr(carrier, 2)) AS carrier_name, length(carrier) > 9 AS carrier_is_regional, {_COLS} FROM m",
    "view_route_drilldown": f"WITH {_AIR}, m AS ({_entity('route', 'route')}) SELECT route, a.airport AS origin, a.tz AS origin_tz, b.airport AS dest, b.tz AS dest_tz, {_COLS} FROM m JOIN air a ON split_part(route, '-', 1) = a.airport JOIN air b ON split_part(route, '-', 2) = b.airport",
    "view_delays_by_time": f"WITH {_BIG}, m AS (SELECT year(leg_date)::INT AS year_no, month(leg_date)::INT AS month_no, isodow(leg_date)::INT AS weekday, dep_hour, min(leg_date) AS f, {_ADD} FROM big GROUP BY 1, 2, 3, 4) "
    f"SELECT * EXCLUDE f, {_MON.format(d='f')} AS month_name, {_SEASON.format(d='f')} AS season, ((month_no % 12) // 3 + 1)::INT AS season_order, strftime(f, '%a') AS day_name FROM m",
    "view_monthly_trend": f"WITH {_BIG}, m AS (SELECT date_trunc('month', leg_date)::DATE AS month_start, {_ADD} FROM big GROUP BY 1) SELECT *, year(month_start)::INT AS year_no, month(month_start)::INT AS month_no, {_MON.format(d='month_start')} AS month_name FROM m",
    "view_route_carrier": f"WITH {_BIG}, m AS (SELECT route, carrier, {_ADD} FROM big GROUP BY ALL), r AS (SELECT *, round(n_arr_del15 / nullif(n_with_arr_outcome, 0), 6) AS delay_rate FROM m) "
    "SELECT route, carrier, n_flights, delay_rate, round(1 - delay_rate, 6) AS on_time_rate, round(n_cancelled / n_flights, 6) AS cancel_rate, round(sum_arr_delay / nullif(n_with_arr_outcome, 0), 6) AS avg_delay FROM r",
    "view_airport_hour_baseline": f"WITH {_BIG}, {_AIR}, m AS (SELECT origin, isodow(leg_date)::INT AS weekday, dep_hour, min(leg_date) AS f, {_ADD} FROM big WHERE leg_date < DATE '2000-01-01' GROUP BY 1, 2, 3) SELECT m.* EXCLUDE f, tz AS airport_tz, strftime(f, '%a') AS day_name FROM m LEFT JOIN air ON airport = origin",
    "hourly_observations": f"""WITH e AS (SELECT event_id AS i, 'S' || (user_id % 50) AS station, date_trunc('hour', ts)::TIMESTAMP AS obs_ts, event_id % 400 AS t, event_id % 8 AS q FROM events WHERE event_id % 17 <> 0 AND event_id % 5 <> 4),
      r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station, obs_ts ORDER BY i % 5, i) AS rn FROM e) WHERE rn = 1),
      c AS (SELECT *, i % 100 AS m1, CASE WHEN i % 5 = 0 AND q NOT IN {_BAD} THEN 42 END AS m2, (i * 7) % 100 AS a1 FROM r)
      SELECT station, obs_ts, i AS report, CASE WHEN i % 10 <> 0 AND q NOT IN {_BAD} THEN round(-t::DOUBLE / 10 * 9 / 5 + 32, 4) END AS temp_f, CASE WHEN q NOT IN {_BAD} THEN round(t::DOUBLE / 10 * 9 / 5 + 32, 4) END AS dewpoint_f,
      CASE WHEN i % 9 <> 0 THEN round(t::DOUBLE / 10 * 1.9438445::DOUBLE, 4) END AS wind_kn, CASE WHEN i % 6 <> 0 THEN round((i % 16000)::DOUBLE / 1609.344::DOUBLE, 4) END AS visibility_mi, CASE WHEN i % 3 = 0 THEN round(t::DOUBLE / 10 * 1.9438445::DOUBLE, 4) END AS gust_kn, i % 3 = 0 AS gust_reported,
      CASE WHEN i % 4 = 0 AND q NOT IN {_BAD} THEN round(t::DOUBLE / 254, 4) WHEN i % 2 <> 0 THEN 0.0::DOUBLE END AS precip_in,
      {_flag(((10, 12), (40, 49)), ((10, 10), (30, 35)))} AS is_fog, {_flag(((50, 69), (80, 84)), ((40, 44), (47, 48), (50, 58), (60, 68), (80, 84)))} AS is_rain,
      {_flag(((68, 79), (83, 88)), ((45, 46), (67, 68), (70, 78), (85, 87)))} AS is_snow, {_flag(((17, 17), (95, 99)), ((90, 96),))} AS is_thunder FROM c""",
}
