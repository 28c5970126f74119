"""DuckDB SQL for the queries of the catalog, written on its own: no text is shared with Spark."""

from __future__ import annotations

_LEGS = r"""
ev AS (SELECT *, regexp_extract(props, '([0-9]+)', 1)::BIGINT AS k FROM events),
lg AS (SELECT event_id AS leg_id, ts::DATE AS leg_date, (hour(ts) * 60 + minute(ts))::BIGINT AS dep_min, date_trunc('minute', ts)::TIMESTAMP AS dep_ts,
  event_type AS carrier, CASE WHEN event_id % 997 <> 0 THEN event_id % 1000 END AS flight_number, 'S' || (event_id % 3) AS origin,
  'S' || ((event_id * 5 + user_id) % 3) AS dest, CASE WHEN event_id % 101 <> 0 THEN user_id END AS tail, 100 + (event_id * 37) % 2400 AS distance,
  20 + (event_id * 13) % 400 AS elapsed_min, event_id % 50 = 0 AS cancelled, event_id % 333 = 0 AS diverted, k,
  (((event_id * 7919 + k * 31) % 1000)::DOUBLE + 0.5::DOUBLE) / 1000::DOUBLE AS score FROM ev),
legs AS (SELECT *, origin || '-' || dest AS route, dep_min // 60 AS dep_hour,
  CASE WHEN NOT cancelled AND NOT diverted THEN greatest(0, k - 60) END AS arr_delay_min,
  CASE WHEN NOT cancelled AND NOT diverted THEN greatest(0, k - 60) >= 15 END AS arr_del15 FROM lg)"""

_BIG = r"""
bl AS (SELECT l_orderkey AS order_key, l_linenumber::BIGINT AS line, l_shipdate::DATE AS leg_date, c_mktsegment AS carrier, sn.n_name AS origin, cn.n_name AS dest,
  sn.n_name || '-' || cn.n_name AS route, l_suppkey AS tail, (l_orderkey * 37 + l_linenumber::BIGINT * 61) % 1440 AS dep_min, l_orderkey % 97 = 0 AS cancelled,
  false AS diverted, (l_partkey * 13 + l_linenumber::BIGINT * 29) % 120 - 40 AS raw
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey),
big AS MATERIALIZED (SELECT * EXCLUDE raw, dep_min // 60 AS dep_hour, CASE WHEN NOT cancelled THEN greatest(0, raw) END AS arr_delay_min,
  CASE WHEN NOT cancelled THEN greatest(0, raw) >= 15 END AS arr_del15 FROM bl)"""

_OBS = r"""
oe AS (SELECT *, regexp_extract(props, '([0-9]+)', 1)::BIGINT AS k FROM events WHERE event_type IN ('view', 'click')),
ob AS (SELECT 'S' || (user_id % 3) AS station, ts AS obs_ts, event_id AS obs_id, k, floor(value * 10)::BIGINT AS tenth FROM oe),
obs1 AS (SELECT station, obs_ts, obs_id,
  CASE WHEN k % 25 = 0 OR lpad(tenth::VARCHAR, 4, '0') = '9999' OR k % 10 IN (2, 3, 6, 7) THEN NULL ELSE round(left(lpad(tenth::VARCHAR, 4, '0'), 4)::DOUBLE / 10 * 9 / 5 + 32, 6) END AS temp_f,
  CASE WHEN k % 4 <> 0 THEN 0.0::DOUBLE WHEN k % 3 = 1 AND k % 10 NOT IN (2, 3, 6, 7) AND lpad(tenth::VARCHAR, 4, '0') <> '9999' THEN round(lpad(tenth::VARCHAR, 4, '0')::DOUBLE / 254, 6) END AS precip_in,
  k % 100 AS m, (k * 7) % 100 AS a FROM ob),
obs AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY station, obs_ts ORDER BY obs_id) AS rn FROM obs1) WHERE rn = 1)"""

_ROT = r"""
dens AS (SELECT origin, leg_date, dep_hour, count(*) AS density FROM legs GROUP BY ALL),
c1 AS (SELECT *, dep_ts + to_minutes(elapsed_min) AS arr_ts FROM legs WHERE tail IS NOT NULL),
c2 AS (SELECT *, lag(arr_ts) OVER w AS p_arr, lag(dest) OVER w AS p_dest, lag(distance) OVER w AS p_dist, lag(elapsed_min) OVER w AS p_el,
  row_number() OVER (PARTITION BY tail, leg_date ORDER BY dep_ts, carrier, flight_number NULLS FIRST, origin, dest) AS pos,
  count(*) OVER (PARTITION BY tail, leg_date) AS nl FROM c1
  WINDOW w AS (PARTITION BY tail ORDER BY dep_ts, carrier, flight_number NULLS FIRST, origin, dest)),
c3 AS (SELECT *, date_sub('minute', p_arr, dep_ts) AS gap FROM c2),
c4 AS (SELECT *, coalesce(lag(gap < 0) OVER (PARTITION BY tail ORDER BY dep_ts, carrier, flight_number NULLS FIRST, origin, dest), false) AS ovl FROM c3),
c5 AS (SELECT *, CASE WHEN p_dest IS NULL THEN 'b' WHEN gap BETWEEN 0 AND 840 AND p_dest = origin AND NOT ovl THEN 'a' WHEN gap > 840 AND p_dest = origin AND NOT ovl THEN 'b' ELSE 'c' END AS link_class FROM c4),
c6 AS (SELECT leg_id, link_class, CASE link_class WHEN 'a' THEN true WHEN 'b' THEN false END AS has_inbound, CASE WHEN link_class <> 'c' THEN pos END AS position,
  CASE WHEN link_class <> 'c' THEN nl END AS legs_today, CASE WHEN link_class = 'a' THEN gap END AS turnaround, CASE WHEN link_class = 'a' THEN gap - 35 END AS slack,
  CASE WHEN link_class = 'a' THEN gap < 35 WHEN link_class = 'b' THEN false END AS is_tight, CASE WHEN link_class = 'a' THEN p_dist END AS inbound_distance,
  CASE WHEN link_class = 'a' THEN p_el END AS inbound_elapsed,
  CASE WHEN link_class = 'b' THEN 'no_inbound' WHEN link_class = 'a' THEN CASE WHEN gap < 35 THEN 'lt_35' WHEN gap < 60 THEN '35_60' WHEN gap < 120 THEN '60_120' ELSE 'ge_120' END END AS band,
  CASE WHEN link_class <> 'c' THEN least(pos, 6)::VARCHAR END AS pos_key FROM c5),
rot AS (SELECT legs.*, c6.* EXCLUDE leg_id, dens.density FROM legs JOIN dens USING (origin, leg_date, dep_hour) LEFT JOIN c6 USING (leg_id))"""


def _rates(source: str, grains: dict[str, str], cutoff: str) -> str:
    arms = " UNION ALL ".join(
        f"SELECT '{g}' AS level, {c}::VARCHAR AS key, count(*) AS n, count(*) FILTER (arr_del15) / count(*) AS rate, sum(arr_delay_min) / count(*) AS avg_delay "
        f"FROM {source} WHERE NOT cancelled AND NOT diverted AND leg_date < DATE '{cutoff}' AND {c} IS NOT NULL GROUP BY {c}"
        for g, c in grains.items()
    )
    return (
        f"hr AS MATERIALIZED ({arms}), gp AS (SELECT sum(n * rate) / sum(n) AS g, sum(n * avg_delay) / sum(n) AS gd FROM hr WHERE level = 'carrier'), "
        "sm AS (SELECT level, key, n, (n * rate + 50 * g) / (n + 50) AS rate, (n * avg_delay + 50 * gd) / (n + 50) AS avg_delay FROM hr, gp)"
    )


_FIVE = {"route": "route", "carrier": "carrier", "airport": "origin", "turnaround_band": "band", "rotation_position": "pos_key"}
_THREE = {"route": "route", "carrier": "carrier", "airport": "origin"}
_ADD = (
    "count(*) AS n_flights, count(arr_delay_min) AS n_with_arr_outcome, count(*) FILTER (arr_del15) AS n_arr_del15, count(*) FILTER (cancelled) AS n_cancelled, "
    "count(*) FILTER (diverted) AS n_diverted, coalesce(sum(arr_delay_min), 0)::BIGINT AS sum_arr_delay"
)
_DELAY = "round(n_arr_del15 / nullif(n_with_arr_outcome, 0), 6) AS delay_rate"
_CANCEL = "round(n_cancelled / nullif(n_flights, 0), 6) AS cancel_rate"
_DIVERT = "round(n_diverted / nullif(n_flights, 0), 6) AS divert_rate"
_AVG = "round(sum_arr_delay / nullif(n_with_arr_outcome, 0), 6) AS avg_delay"


def _entity(col: str, level: str) -> str:
    return (
        f"WITH {_BIG}, {_rates('big', _THREE, '2000-01-01')} SELECT e.*, round(hr.rate, 6) AS hist_rate FROM (SELECT {col}, count(*) AS n_flights, "
        "round(count(*) FILTER (arr_del15) / nullif(count(arr_delay_min), 0), 6) AS delay_rate, round(count(*) FILTER (cancelled) / count(*), 6) AS cancel_rate, "
        "round(sum(arr_delay_min) / nullif(count(arr_delay_min), 0), 6) AS avg_delay, quantile_disc(arr_delay_min, 0.9)::BIGINT AS p90_delay "
        f"FROM big GROUP BY {col}) e LEFT JOIN hr ON hr.level = '{level}' AND hr.key = e.{col}"
    )


_AIR = (
    "air AS (SELECT n_name AS airport, (-60 + (n_nationkey * 17) % 120)::DOUBLE AS lat, (-180 + (n_nationkey * 41) % 360)::DOUBLE AS lon, "
    "(['America/New_York', 'America/Chicago', 'America/Denver', 'America/Los_Angeles'])[n_nationkey % 4 + 1] AS tz, n_nationkey::BIGINT AS nation_key, n_regionkey FROM nation)"
)
_SCORED = f"{_LEGS}, sc AS (SELECT *, arr_del15::INT AS y, score * 40 AS expected_delay FROM legs WHERE arr_del15 IS NOT NULL)"
_BIN = "(" + " + ".join(f"(score >= {i}::DOUBLE / 10)::INT" for i in range(1, 10)) + ")::BIGINT"
_BAND = "((score > 0.1::DOUBLE)::INT + (score > 0.2::DOUBLE)::INT + (score > 0.3::DOUBLE)::INT + (score > 0.5::DOUBLE)::INT + (score > 0.7::DOUBLE)::INT)::BIGINT"
_GE = (15, 30, 60, 90, 120, 180, 240)
_EXC = (
    "exb AS (SELECT " + _BIN + " AS bin, arr_delay_min FROM legs WHERE arr_delay_min IS NOT NULL), exc AS (SELECT g.bin, count(arr_delay_min) AS n, "
    + ", ".join(f"round(avg(CASE WHEN arr_delay_min >= {t} THEN 1 WHEN arr_delay_min IS NOT NULL THEN 0 END), 6) AS p_ge_{t}" for t in _GE)
    + " FROM range(10) g(bin) LEFT JOIN exb ON exb.bin = g.bin GROUP BY g.bin)"
)
_AUC = "sum(pos * (below + neg / 2)) / nullif(sum(pos) * sum(neg), 0)"
_AP = "sum(pos * tp / (tp + fp)) / nullif(sum(pos), 0)"
_REQ = f"""{_LEGS}, req AS (SELECT leg_id AS request_id, leg_date + 28 AS leg_date, dep_min, carrier, origin, dest, CASE WHEN leg_id % 3 = 0 THEN distance * 10 END AS distance,
  CASE WHEN leg_id % 2 = 0 THEN leg_id % 9 END AS position, CASE WHEN leg_id % 2 = 0 AND leg_id % 7 <> 0 THEN leg_id % 9 + 1 WHEN leg_id % 7 = 0 THEN 2 END AS legs_today,
  CASE WHEN leg_id % 2 = 0 AND leg_id % 9 > 1 THEN (leg_id * 11) % 900 END AS turnaround,
  CASE WHEN leg_id % 2 = 0 AND leg_id % 9 > 1 AND leg_id % 7 <> 0 THEN distance END AS inbound_distance,
  CASE WHEN leg_id % 2 = 0 AND leg_id % 9 > 1 THEN elapsed_min END AS inbound_elapsed, CASE WHEN leg_id % 3 = 0 THEN leg_id % 50 - 5 END AS density
  FROM legs)"""
_BASIS = f"""{_REQ}, {_OBS}, grid AS (SELECT DISTINCT station, date_trunc('hour', obs_ts + INTERVAL 28 DAY) AS h FROM obs WHERE temp_f IS NOT NULL AND obs_ts + INTERVAL 28 DAY < TIMESTAMP '2024-02-12 12:00:00'),
ba1 AS (SELECT *, CASE origin WHEN 'S0' THEN 'America/New_York' WHEN 'S1' THEN 'America/Chicago' END AS tz FROM req),
ba2 AS (SELECT *, CASE WHEN tz IS NOT NULL THEN timezone('UTC', (leg_date::TIMESTAMP + to_minutes(dep_min)) AT TIME ZONE coalesce(tz, 'UTC')) END AS dep FROM ba1),
ba AS (SELECT request_id, coalesce(dep <= TIMESTAMP '2024-02-05 12:00:00', false) AS flight_in_past,
  CASE WHEN dep IS NULL THEN 'unavailable' WHEN dep <= TIMESTAMP '2024-02-05 12:00:00' THEN 'past' WHEN h IS NOT NULL THEN 'forecast' ELSE 'beyond_horizon' END AS weather_horizon,
  CASE WHEN position IS NOT NULL THEN 'provided' ELSE 'typical_estimate' END AS rotation_context, CASE WHEN density > 0 THEN 'provided' ELSE 'estimated' END AS origin_density_source
  FROM ba2 LEFT JOIN grid ON station = origin AND h = date_trunc('hour', dep))"""
_CONN = """cn AS (SELECT a.leg_id AS first_id, b.leg_id AS second_id, a.leg_date, a.dest AS airport, b.dep_min - (a.dep_min + a.elapsed_min) AS layover, a.score
  FROM legs a JOIN legs b ON a.leg_date = b.leg_date AND a.dest = b.origin AND b.dep_min - (a.dep_min + a.elapsed_min) BETWEEN 30 AND 240 AND a.origin <> b.dest
  WHERE a.dep_min + a.elapsed_min <= 1439 AND NOT a.cancelled AND NOT b.cancelled)"""
_ASOF = f"""{_LEGS}, {_OBS}, ao AS (SELECT l.*, o.obs_ts, o.obs_id, o.temp_f, o.precip_in FROM legs l LEFT JOIN LATERAL
  (SELECT * FROM obs WHERE obs.station = l.origin AND obs.obs_ts <= l.dep_ts AND obs.obs_ts > l.dep_ts - INTERVAL 3 HOURS ORDER BY obs.obs_ts DESC LIMIT 1) o ON true)"""
_FEAT = f"""{_LEGS}, {_OBS}, {_ROT}, {_rates('rot', _FIVE, '2024-01-24')},
  ft AS (SELECT r.*, o.obs_ts, o.temp_f, o.precip_in FROM rot r ASOF LEFT JOIN obs o ON r.origin = o.station AND r.dep_ts >= o.obs_ts WHERE NOT r.cancelled AND NOT r.diverted),
  f2 AS (SELECT * REPLACE (CASE WHEN obs_ts > dep_ts - INTERVAL 3 HOURS THEN obs_ts END AS obs_ts), obs_ts > dep_ts - INTERVAL 3 HOURS AS fresh FROM ft),
  f3 AS (SELECT * REPLACE (CASE WHEN fresh THEN temp_f END AS temp_f, CASE WHEN fresh THEN precip_in END AS precip_in) FROM f2)"""
_HIST_OF = {"route_hist": ("route", "route"), "carrier_hist": ("carrier", "carrier"), "origin_hist": ("airport", "origin"), "dest_hist": ("airport", "dest"), "band_hist": ("turnaround_band", "band"), "position_hist": ("rotation_position", "pos_key")}
_HIST_COLS = ", ".join(f"round(h{i}.rate, 6) AS {p}_rate" for i, p in enumerate(_HIST_OF))


def _hist_joins(t: str) -> str:
    return " ".join(f"LEFT JOIN sm h{i} ON h{i}.level = '{lv}' AND h{i}.key = {t}.{c}" for i, (lv, c) in enumerate(_HIST_OF.values()))


_BANKS = f"""{_LEGS}, {_ROT}, bk AS (SELECT origin, leg_date, dep_hour, count(*) AS n, round(sum(score), 6) AS expected, round(sqrt(sum(score * (1 - score))), 6) AS sd,
  round(avg(coalesce(is_tight, false)::INT), 6) AS tight_share, sum(greatest(coalesce(legs_today - position, 0), 0))::BIGINT AS downstream,
  round(sum(score * greatest(coalesce(legs_today - position, 0), 0)), 6) AS expected_downstream FROM rot GROUP BY ALL)"""
_SEASON = "(['Winter', 'Spring', 'Summer', 'Autumn'])[(month({d}) % 12) // 3 + 1]"


def _holidays(first: int, last: int) -> str:
    """Holidays with observed shifts and n-th weekdays, for years around a range."""
    return f"""yy AS (SELECT y FROM range({first - 1}, {last + 2}) t(y)),
  fx AS (SELECT make_date(y, m, d) AS d FROM yy, (VALUES (1, 1), (6, 19), (7, 4), (11, 11), (12, 25)) v(m, d) WHERE m <> 6 OR y >= 2021),
  fo AS (SELECT CASE isodow(d) WHEN 6 THEN d - 1 WHEN 7 THEN d + 1 ELSE d END AS d FROM fx),
  fl AS (SELECT make_date(y, m, 1) AS f, w, nth FROM yy, (VALUES (1, 1, 3), (2, 1, 3), (9, 1, 1), (10, 1, 2), (11, 4, 4)) v(m, w, nth)),
  me AS (SELECT last_day(make_date(y, 5, 1)) AS l FROM yy),
  hd AS (SELECT d FROM fo UNION SELECT (f + ((w - isodow(f) + 7) % 7 + 7 * (nth - 1))::INT)::DATE FROM fl UNION SELECT (l - (isodow(l) - 1)::INT)::DATE FROM me)"""


_CAL = "year(leg_date)::INT AS year_no, quarter(leg_date)::INT AS quarter_no, month(leg_date)::INT AS month_no, day(leg_date)::INT AS day_no, isodow(leg_date)::INT AS weekday, " + _SEASON.format(d="leg_date") + " AS season, leg_date IN (SELECT d FROM hd) AS is_holiday, leg_date IN (SELECT d - 1 FROM hd) AS is_day_before, leg_date IN (SELECT d + 1 FROM hd) AS is_day_after"


ORACLES: dict[str, str] = {
    "delay_rate_by_hour": f"WITH {_BIG} SELECT *, {_DELAY}, {_CANCEL}, {_DIVERT}, {_AVG} FROM (SELECT dep_hour, {_ADD} FROM big GROUP BY dep_hour)",
    "additive_schedule": f"WITH {_BIG} SELECT isodow(leg_date)::INT AS weekday, dep_hour, {_ADD} FROM big GROUP BY 1, 2",
    "additive_monthly": f"WITH {_BIG} SELECT date_trunc('month', leg_date)::DATE AS month_start, carrier, {_ADD} FROM big GROUP BY 1, 2",
    "time_slice_filtered": f"WITH {_BIG}, m AS (SELECT origin, carrier, month(leg_date)::INT AS month_no, isodow(leg_date)::INT AS weekday, dep_hour, {_ADD} FROM big WHERE origin = 'NATION_3' AND carrier = 'BUILDING' GROUP BY ALL) "
    f"SELECT origin, carrier, month_no, weekday, dep_hour, n_flights, n_with_arr_outcome, n_arr_del15, n_cancelled, (['Winter', 'Spring', 'Summer', 'Autumn'])[(month_no % 12) // 3 + 1] AS season, round(1 - n_arr_del15 / nullif(n_with_arr_outcome, 0), 6) AS on_time_rate, {_DELAY}, {_CANCEL}, {_AVG} FROM m",
    "route_carrier": f"WITH {_BIG} SELECT route, carrier, {_ADD} FROM big GROUP BY ALL",
    "airport_hour_training": f"WITH {_BIG} SELECT origin, isodow(leg_date)::INT AS weekday, dep_hour, {_ADD} FROM big WHERE leg_date < DATE '2000-01-01' GROUP BY ALL",
    "mart_airport_p90": _entity("origin", "airport"),
    "mart_carrier": _entity("carrier", "carrier"),
    "mart_route": _entity("route", "route"),
    "drilldown_ranking": f"WITH {_BIG} SELECT carrier, n_flights, {_DELAY}, {_AVG} FROM (SELECT carrier, {_ADD} FROM big WHERE origin = 'NATION_3' AND leg_date >= DATE '1998-06-01' AND leg_date < DATE '1998-07-01' GROUP BY carrier)",
    "dim_date": f"WITH {_LEGS}, {_holidays(2023, 2024)}, s AS (SELECT unnest(generate_series(min(leg_date)::TIMESTAMP, max(leg_date)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date_day FROM legs) "
    f"SELECT date_day, year(date_day)::INT AS year_no, quarter(date_day)::INT AS quarter_no, month(date_day)::INT AS month_no, monthname(date_day) AS month_name, isodow(date_day)::INT AS weekday, dayname(date_day) AS day_name, {_SEASON.format(d='date_day')} AS season, "
    "date_day IN (SELECT d FROM hd) AS is_holiday, date_day IN (SELECT d - 1 FROM hd) AS is_day_before, date_day IN (SELECT d + 1 FROM hd) AS is_day_after FROM s",
    "dim_carrier": f"WITH {_LEGS} SELECT carrier, min(leg_date) AS first_day, max(leg_date) AS last_day, count(*) AS n_flights, CASE WHEN carrier <> 'error' THEN upper(left(carrier, 1)) || substr(carrier, 2) END AS carrier_name, carrier <> 'error' AND length(carrier) > 5 AS is_regional FROM legs GROUP BY carrier",
    "dim_airport": f"WITH {_AIR} SELECT airport, lat, lon, tz, n_regionkey AS region_key FROM air",
    "fact": f"WITH {_LEGS} SELECT leg_id, leg_date, carrier, flight_number, origin, dest, dep_min, cancelled, diverted, arr_delay_min, arr_del15 FROM legs",
    "enrich_legs": f"WITH {_BIG}, {_AIR} SELECT o.tz AS origin_tz, d.tz AS dest_tz, count(*) AS n FROM big LEFT JOIN air o ON o.airport = big.origin LEFT JOIN air d ON d.airport = big.dest GROUP BY 1, 2",
    "rollup_totals": f"WITH {_BIG} SELECT carrier, n_flights, {_DELAY}, {_CANCEL}, {_AVG}, round(n_flights / sum(n_flights) OVER (), 6) AS share FROM (SELECT carrier, {_ADD} FROM big GROUP BY carrier)",
    "mix_adjusted": f"WITH {_BIG}, cells AS (SELECT carrier, route, count(*) FILTER (arr_del15) AS a, count(arr_delay_min) AS d FROM big GROUP BY ALL), ov AS (SELECT route, sum(a) / nullif(sum(d), 0) AS r FROM cells GROUP BY route) "
    "SELECT carrier, round(sum(a) / nullif(sum(d), 0), 6) AS rate, round(sum(d * r) / nullif(sum(d), 0), 6) AS expected_rate, round(sum(a) / nullif(sum(d * r), 0), 6) AS mix_index FROM cells JOIN ov USING (route) GROUP BY carrier",
    "yoy": f"WITH {_BIG}, y AS (SELECT year(leg_date)::INT AS year_no, round(count(*) FILTER (arr_del15) / nullif(count(arr_delay_min), 0), 6) AS delay_rate FROM big GROUP BY 1) SELECT year_no, delay_rate, round(delay_rate - lag(delay_rate) OVER (ORDER BY year_no), 6) AS delta FROM y",
    "pivot_day_hour": f"WITH {_BIG} SELECT isodow(leg_date)::INT AS weekday, "
    + ", ".join(f"round(count(*) FILTER (arr_del15 AND dep_hour = {h}) / nullif(count(arr_delay_min) FILTER (dep_hour = {h}), 0), 6) AS h{h}" for h in range(24))
    + " FROM big GROUP BY 1",
    "peak_hour": f"WITH {_BIG}, h AS (SELECT isodow(leg_date)::INT AS weekday, dep_hour, round(count(*) FILTER (arr_del15) / nullif(count(arr_delay_min), 0), 6) AS r FROM big GROUP BY 1, 2) "
    "SELECT weekday, first(dep_hour ORDER BY r DESC, dep_hour) AS worst_hour, first(dep_hour ORDER BY r, dep_hour) AS best_hour FROM h GROUP BY weekday",
    "top_airports": f"WITH {_BIG} SELECT origin, n_flights, {_DELAY} FROM (SELECT origin, {_ADD} FROM big GROUP BY origin) WHERE n_flights >= 100 ORDER BY delay_rate DESC, origin LIMIT 5",
    "history_implied": f"WITH {_BIG}, b AS (SELECT isodow(leg_date)::INT AS weekday, dep_hour, round(count(*) FILTER (arr_del15) / nullif(count(arr_delay_min), 0), 6) AS r FROM big WHERE leg_date < DATE '2000-01-01' GROUP BY 1, 2), "
    "l AS (SELECT isodow(leg_date)::INT AS weekday, dep_hour, count(*) AS n FROM big WHERE leg_date >= DATE '2000-01-01' GROUP BY 1, 2) SELECT l.weekday, l.dep_hour, n, round(n * r, 6) AS implied FROM l LEFT JOIN b USING (weekday, dep_hour)",
    "weighted_mean_rate": f"WITH {_BIG}, r AS (SELECT route, count(arr_delay_min) AS n, round(count(*) FILTER (arr_del15) / nullif(count(arr_delay_min), 0), 6) AS d FROM big GROUP BY route) SELECT round(sum(d * n) / sum(n), 6) AS mean_rate, count(*) AS routes FROM r WHERE n > 0",
    "selected_routes": f"WITH {_BIG}, t AS (SELECT route FROM big GROUP BY route ORDER BY count(*) DESC, route LIMIT 10) SELECT route, carrier, count(*) AS n_flights, round(count(*) FILTER (arr_del15) / nullif(count(arr_delay_min), 0), 6) AS delay_rate FROM big WHERE route IN (FROM t) GROUP BY ALL",
    "flown_places": f"WITH {_BIG} SELECT origin AS airport FROM big UNION SELECT dest FROM big",
    "view_health": f"WITH {_BIG} SELECT 'schedule' AS view, count(*) AS n FROM (SELECT DISTINCT isodow(leg_date), dep_hour FROM big) UNION ALL SELECT 'monthly', count(*) FROM (SELECT DISTINCT date_trunc('month', leg_date), carrier FROM big) UNION ALL SELECT 'route_carrier', count(*) FROM (SELECT DISTINCT route, carrier FROM big)",
    "dedup_latest": "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) = 1",
    "scalar_cleaning": "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN upper(event_type) END AS name, CASE WHEN event_id % 7 <> 0 THEN event_id % 100 + 1 END AS whole, CASE WHEN event_id % 7 <> 0 THEN (event_id % 100 || '.6')::DOUBLE END AS number, "
    "CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS flag, TRY_CAST('2024-' || lpad((event_id % 14)::VARCHAR, 2, '0') || '-' || lpad((event_id % 31)::VARCHAR, 2, '0') AS DATE) AS day, "
    "CASE WHEN event_id % 5 = 0 THEN '  ' ELSE ' ' || event_type || ' ' END || '-' || event_id AS row_key FROM events",
    "hhmm_parse": "SELECT event_id, m AS minutes, m // 60 AS hour FROM (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 0 WHEN event_id % 41 = 0 OR event_id % 43 = 0 THEN NULL ELSE event_id % 24 * 60 + event_id % 60 END AS m FROM events)",
    "sentinel_null": "SELECT event_id, CASE WHEN event_id % 9 <> 0 AND value NOT IN (9999.9::DOUBLE, 99.99::DOUBLE) THEN value END AS value FROM events",
    "pressure_decode": "SELECT event_id, CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN NULL WHEN event_id % 2 = 0 THEN (event_id % 100 + 1000)::DOUBLE ELSE (900 + event_id % 100)::DOUBLE END AS pressure FROM events",
    "packed_decode": f"WITH {_OBS} SELECT station, obs_ts, temp_f FROM obs",
    "precip_rule": f"WITH {_OBS} SELECT obs_id, precip_in FROM obs",
    "code_flags": f"WITH {_OBS} SELECT obs_id, m BETWEEN 10 AND 12 OR m BETWEEN 40 AND 49 OR a = 10 OR a BETWEEN 30 AND 35 AS is_fog, "
    "m BETWEEN 50 AND 69 OR m BETWEEN 80 AND 84 OR a BETWEEN 40 AND 44 OR a IN (47, 48) OR a BETWEEN 50 AND 58 OR a BETWEEN 60 AND 68 OR a BETWEEN 80 AND 84 AS is_rain, "
    "m BETWEEN 68 AND 79 OR m BETWEEN 83 AND 88 OR a IN (45, 46, 67, 68) OR a BETWEEN 70 AND 78 OR a BETWEEN 85 AND 87 AS is_snow, m = 17 OR m BETWEEN 95 AND 99 OR a BETWEEN 90 AND 96 AS is_thunder FROM obs",
    # The hour that a change of clocks repeats counts as its first pass: one hour earlier, plus one hour.
    "local_to_utc": f"WITH {_BIG}, {_AIR}, l AS (SELECT tz, leg_date::TIMESTAMP + to_minutes(dep_min) AS t, (dep_min // 60 = 1)::INT AS early FROM big JOIN air ON air.airport = big.origin) SELECT tz, hour(timezone('UTC', (t - to_hours(early)) AT TIME ZONE tz) + to_hours(early))::BIGINT AS utc_hour, count(*) AS n FROM l GROUP BY 1, 2",
    "calendar_labels": f"WITH {_BIG} SELECT leg_date, count(*) AS n, monthname(leg_date) AS month_name, dayname(leg_date) AS day_name, {_SEASON.format(d='leg_date')} AS season FROM big GROUP BY leg_date",
    "probability_labels": f"WITH {_LEGS}, b AS (SELECT avg(score) AS base FROM legs) SELECT leg_id, CASE WHEN score <= 0 THEN 0 WHEN score >= 1 THEN 10 ELSE least(greatest(round_even(score * 10, 0), 1), 9) END::BIGINT AS k_in_10, "
    "CASE WHEN score / base < 0.6 THEN 'well below usual' WHEN score / base < 0.85 THEN 'below usual' WHEN score / base <= 1.15 THEN 'about usual' WHEN score / base <= 1.6 THEN 'above usual' WHEN score / base <= 2.5 THEN 'well above usual' ELSE 'far above usual' END AS against_base FROM legs, b",
    "station_coverage": f"WITH {_OBS} SELECT station, count(DISTINCT obs_ts::DATE) AS days, count(*) AS n FROM ob GROUP BY station",
    "nearest_station": f"WITH {_AIR}, st AS (SELECT s_suppkey AS station, (-60 + (s_suppkey * 29) % 120)::DOUBLE AS la, (-180 + (s_suppkey * 73) % 360)::DOUBLE AS lo FROM supplier), "
    "p AS (SELECT airport, station, 2 * 6371.01 * asin(sqrt(least(pow(sin(radians(la - lat) / 2), 2) + cos(radians(lat)) * cos(radians(la)) * pow(sin(radians(lo - lon) / 2), 2), 1.0))) AS d FROM air, st) "
    "SELECT airport, first(station ORDER BY d, station) AS station, round(min(d), 2) AS distance_km FROM p GROUP BY airport",
    "asof_weather": f"WITH {_ASOF} SELECT leg_id, obs_ts, obs_id, temp_f FROM ao",
    "asof_guard": f"WITH {_ASOF}, m AS (SELECT count(*) FILTER (obs_id IS NULL) AS miss, count(*) AS n FROM ao) SELECT rule, n FROM (SELECT unnest(['after_departure', 'outside_lookback', 'flag_without_obs', 'obs_without_flag', 'unverifiable', 'degraded', 'departure_moved']) AS rule, unnest([0, 0, 0, 0, 0, CASE WHEN miss > 0.05 * n THEN miss ELSE 0 END, 0])::BIGINT AS n FROM m)",
    "interval_lookup": f"WITH {_LEGS}, iv AS (SELECT 'S' || (user_id % 3) AS s, date_trunc('hour', ts)::TIMESTAMP AS a, date_trunc('hour', ts)::TIMESTAMP + to_minutes(30 + event_id % 100) AS b, event_id AS f FROM events WHERE event_type IN ('view', 'click')), "
    "m AS (SELECT leg_id, first(f ORDER BY a, f) AS forecast FROM legs JOIN iv ON s = origin AND a <= dep_ts AND dep_ts < b GROUP BY leg_id) SELECT leg_id, forecast FROM legs LEFT JOIN m USING (leg_id)",
    "null_safe_join": f"WITH {_LEGS} SELECT l.leg_id, r.arr_delay_min FROM legs l JOIN legs r ON l.leg_date = r.leg_date AND l.carrier = r.carrier AND l.flight_number IS NOT DISTINCT FROM r.flight_number AND l.origin = r.origin AND l.dest = r.dest AND l.dep_min = r.dep_min",
    "connections": f"WITH {_LEGS}, {_CONN} SELECT first_id, second_id, leg_date, airport, layover FROM cn",
    "connection_risk": f"WITH {_LEGS}, {_CONN}, {_EXC}, x AS (SELECT *, layover - 30 AS slack, {_BIN} AS bin FROM cn), "
    "y AS (SELECT x.*, CASE WHEN slack > 0 THEN coalesce(list_max(list_filter([15, 30, 60, 90, 120, 180, 240], lambda t: t <= slack)), 15) END AS thr FROM x) "
    "SELECT first_id, second_id, slack, thr::BIGINT AS threshold, CASE thr " + " ".join(f"WHEN {t} THEN p_ge_{t}" for t in _GE) + " END AS p_miss, "
    "CASE WHEN slack <= 0 THEN 'inside connection time' WHEN slack < 15 THEN 'lower' WHEN thr = 240 AND slack > 240 THEN 'upper' ELSE 'measured' END AS bound FROM y LEFT JOIN exc USING (bin)",
    "orphan_guard": "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20) GROUP BY o_orderpriority",
    "flown_without_tz": f"WITH {_BIG} SELECT DISTINCT dest AS airport FROM big JOIN nation ON n_name = dest WHERE n_nationkey % 6 = 0",
    "chain": f"WITH {_LEGS}, {_ROT} SELECT leg_id, link_class, has_inbound, position, legs_today, turnaround, slack, is_tight, inbound_distance, inbound_elapsed, band, pos_key, density FROM rot",
    "chain_classes": f"WITH {_LEGS}, {_ROT} SELECT link_class, count(*) AS n, count(turnaround) AS n_turnaround FROM rot GROUP BY link_class",
    "chain_guard": "SELECT unnest(['turnaround_mismatch', 'inbound_attr_mismatch', 'position_or_day_mismatch', 'flag_mismatch', 'band_relabeled', 'position_relabeled', 'class_mismatch', 'unclear_link_not_nulled', 'inbound_attrs_without_inbound', 'inbound_without_attrs', 'tail_null_not_nulled', 'join_miss', 'leg_not_in_mart']) AS rule, 0::BIGINT AS n",
    "chain_guard_moved": f"WITH {_LEGS}, {_ROT}, t AS (SELECT count(*) FILTER (leg_id % 89 <> 0 AND turnaround IS NOT NULL AND leg_id % 10 = 3) AS a, count(*) FILTER (leg_id % 89 <> 0 AND leg_id % 31 = 4 AND has_inbound IS DISTINCT FROM false) AS f, "
    "count(*) FILTER (leg_id % 89 <> 0 AND leg_id % 31 = 4 AND has_inbound) AS b, count(*) FILTER (leg_id % 89 = 0) AS l FROM rot) SELECT unnest(['turnaround_mismatch', 'inbound_attr_mismatch', 'position_or_day_mismatch', 'flag_mismatch', 'band_relabeled', 'position_relabeled', 'class_mismatch', "
    "'unclear_link_not_nulled', 'inbound_attrs_without_inbound', 'inbound_without_attrs', 'tail_null_not_nulled', 'join_miss', 'leg_not_in_mart']) AS rule, unnest([a, 0, 0, f, 0, 0, 0, 0, b, 0, 0, 0, l]) AS n FROM t",
    "density_hour": f"WITH {_BIG}, g AS (SELECT count(*) AS density FROM big GROUP BY origin, leg_date, dep_hour) SELECT density, sum(density)::BIGINT AS n FROM g GROUP BY density",
    "hist_rates": f"WITH {_LEGS}, {_ROT}, {_rates('rot', _FIVE, '2024-01-24')} SELECT level, key, n, round(rate, 6) AS rate, round(avg_delay, 6) AS avg_delay FROM hr",
    "smoothed_rates": f"WITH {_BIG}, {_rates('big', _THREE, '2000-01-01')} SELECT level, key, n, round(rate, 6) AS rate, round(avg_delay, 6) AS avg_delay FROM sm",
    "fit_window_hist": f"WITH {_LEGS}, {_ROT}, {_rates('rot', _FIVE, '2024-01-17')} SELECT level, key, n, round(rate, 6) AS rate FROM sm",
    "ml_features": f"WITH {_FEAT}, {_holidays(2023, 2024)}, zn AS (SELECT * FROM (VALUES ('S0', 'America/New_York'), ('S1', 'America/Chicago')) z(airport, tz)) SELECT leg_id, {_CAL}, hour(timezone('UTC', (leg_date::TIMESTAMP + to_minutes(dep_min)) AT TIME ZONE coalesce(zn.tz, 'UTC'))) * CASE WHEN zn.tz IS NOT NULL THEN 1 END AS utc_hour, leg_date < DATE '2024-01-24' AS is_training_row, obs_ts IS NOT NULL AS has_origin_weather, temp_f, CASE WHEN obs_ts IS NOT NULL THEN coalesce(precip_in, 0.0) END AS precip_or_zero, "
    f"CASE WHEN slack IS NOT NULL THEN least(slack::DOUBLE, 120.0) END AS slack_capped, coalesce(is_tight, false) AS is_tight, density, {_HIST_COLS}, arr_del15 AS label_arr_del15 FROM f3 LEFT JOIN zn ON zn.airport = f3.origin {_hist_joins('f3')}",
    "split_report": f"WITH {_LEGS}, c AS (SELECT *, leg_date < DATE '2024-01-24' AS t FROM legs WHERE NOT cancelled AND NOT diverted) SELECT count(*) AS n, count(*) FILTER (t) AS n_train, count(*) FILTER (NOT t) AS n_test, max(leg_date) FILTER (t) AS train_max, min(leg_date) FILTER (NOT t) AS test_min, max(leg_date) FILTER (t) < min(leg_date) FILTER (NOT t) AS ok FROM c",
    "carve_parts": f"WITH {_LEGS} SELECT CASE WHEN leg_date < DATE '2024-01-17' THEN 'fit' WHEN leg_date < DATE '2024-01-24' THEN 'val' ELSE 'test' END AS part, count(*) AS n, min(leg_date) AS first_day, max(leg_date) AS last_day FROM legs WHERE NOT cancelled AND NOT diverted GROUP BY 1",
    "entity_profile": f"WITH {_LEGS} " + " UNION ALL ".join(f"SELECT '{g}' AS level, {c} AS key, min(distance) AS min_distance, min(leg_date) AS first_day, max(leg_date) AS last_day, count(*) AS n FROM legs GROUP BY {c}" for g, c in _THREE.items()),
    "density_profile": f"WITH {_LEGS}, {_ROT}, h AS (SELECT DISTINCT origin, leg_date, dep_hour, density FROM rot WHERE leg_date < DATE '2024-01-24') SELECT origin, dep_hour, isodow(leg_date)::INT AS weekday, quantile_disc(density, 0.5)::BIGINT AS median_density, count(*) AS n_hours FROM h GROUP BY 1, 2, 3",
    "typical_rotation": f"WITH {_LEGS}, {_ROT} SELECT " + ", ".join(f"quantile_disc({c}, 0.5)::BIGINT AS typical_{c}" for c in ("turnaround", "inbound_distance", "inbound_elapsed", "position", "legs_today", "density")) + " FROM rot WHERE leg_date < DATE '2024-01-24'",
    "entity_constancy_guard": f"WITH {_LEGS}, g AS (" + " UNION ALL ".join(f"SELECT '{g}' AS level, {c}::VARCHAR AS key, count(DISTINCT leg_id % 2) AS a, count(DISTINCT distance) AS b, count(DISTINCT dep_hour) AS c FROM legs WHERE {c} IS NOT NULL GROUP BY {c}" for g, c in (("carrier", "carrier"), ("flight", "flight_number"), ("route", "route"), ("airport", "origin"), ("dest", "dest"), ("tail", "tail")))
    + ") SELECT level, key, 'parity' AS column FROM g WHERE a > 1 UNION ALL SELECT level, key, 'distance' FROM g WHERE b > 1 UNION ALL SELECT level, key, 'dep_hour' FROM g WHERE c > 1",
    "batch_features": f"WITH {_REQ}, {_ROT}, {_holidays(2023, 2024)}, {_rates('rot', _FIVE, '2024-01-24')}, ty AS (SELECT " + ", ".join(f"quantile_disc({c}, 0.5)::BIGINT AS t_{c}" for c in ("turnaround", "position", "legs_today", "density")) + " FROM rot WHERE leg_date < DATE '2024-01-24'), "
    "h AS (SELECT DISTINCT origin, leg_date, dep_hour, density FROM rot WHERE leg_date < DATE '2024-01-24'), dp AS (SELECT origin, dep_hour, isodow(leg_date) AS wd, quantile_disc(density, 0.5)::BIGINT AS med FROM h GROUP BY 1, 2, 3), "
    "rt AS (SELECT route, min(distance) AS md FROM legs GROUP BY route), "
    "x AS (SELECT r.*, r.origin || '-' || r.dest AS route, r.dep_min // 60 AS dep_hour, position IS NOT NULL AS given, ty.* FROM req r, ty), "
    "y AS (SELECT *, coalesce(position, t_position) AS pos_used, CASE WHEN given THEN greatest(coalesce(legs_today, t_legs_today), position) ELSE t_legs_today END AS legs_used, CASE WHEN given THEN CASE WHEN turnaround BETWEEN 0 AND 840 THEN turnaround END ELSE t_turnaround END AS turn_used, CASE WHEN given THEN coalesce(turnaround BETWEEN 0 AND 840, false) ELSE true END AS inb FROM x), "
    "z AS (SELECT *, CASE WHEN NOT inb THEN 'no_inbound' WHEN turn_used < 35 THEN 'lt_35' WHEN turn_used < 60 THEN '35_60' WHEN turn_used < 120 THEN '60_120' WHEN turn_used IS NOT NULL THEN 'ge_120' END AS band, least(pos_used, 6)::VARCHAR AS pos_key FROM y) "
    + "SELECT request_id, " + _CAL.replace("leg_date", "z.leg_date") + ", CASE WHEN given THEN 'provided' ELSE 'typical' END AS context, pos_used, legs_used, turn_used, z.band, z.pos_key, coalesce(CASE WHEN z.distance > 0 THEN z.distance END, rt.md) AS distance_used, "
    "coalesce(CASE WHEN z.density > 0 THEN z.density END, dp.med, t_density) AS density_used, CASE WHEN z.density > 0 THEN 'supplied' WHEN dp.med IS NOT NULL THEN 'profile' ELSE 'typical' END AS density_source, "
    f"{_HIST_COLS} FROM z LEFT JOIN rt ON rt.route = z.route LEFT JOIN dp ON dp.origin = z.origin AND dp.dep_hour = z.dep_hour AND dp.wd = isodow(z.leg_date) {_hist_joins('z')}",
    "basis_columns": f"WITH {_BASIS} SELECT * FROM ba",
    "request_validation": f"WITH {_REQ}, r AS (SELECT request_id, list_filter([CASE WHEN distance <= 0 OR distance >= 20000 THEN 'distance_range' END, CASE WHEN position NOT BETWEEN 1 AND 30 THEN 'position_range' END, CASE WHEN legs_today NOT BETWEEN 1 AND 30 THEN 'legs_range' END, "
    "CASE WHEN turnaround NOT BETWEEN 0 AND 840 THEN 'turnaround_range' END, CASE WHEN inbound_distance <= 0 OR inbound_distance >= 20000 THEN 'inbound_distance_range' END, CASE WHEN inbound_elapsed <= 0 OR inbound_elapsed > 900 THEN 'inbound_elapsed_range' END, "
    "CASE WHEN density <= 0 OR density > 500 THEN 'density_range' END, CASE WHEN position IS NULL AND (legs_today IS NOT NULL OR turnaround IS NOT NULL OR inbound_distance IS NOT NULL OR inbound_elapsed IS NOT NULL) THEN 'rotation_without_position' END, "
    "CASE WHEN position IS NOT NULL AND legs_today IS NULL THEN 'position_without_legs' END, CASE WHEN legs_today < position THEN 'legs_below_position' END, "
    "CASE WHEN (turnaround IS NULL)::INT + (inbound_distance IS NULL)::INT + (inbound_elapsed IS NULL)::INT IN (1, 2) THEN 'inbound_incomplete' END, "
    "CASE WHEN position >= 2 AND (turnaround IS NULL OR inbound_distance IS NULL OR inbound_elapsed IS NULL) THEN 'inbound_missing' END], lambda v: v IS NOT NULL) AS l FROM req) SELECT request_id, coalesce(array_to_string(l, ';'), '') AS reasons, len(l) = 0 AS accepted FROM r",
    "unseen_categories": f"WITH {_REQ}, s AS (SELECT DISTINCT route FROM legs WHERE leg_date < DATE '2024-01-02') SELECT count(*) AS n, count(*) FILTER (origin || '-' || dest NOT IN (FROM s)) AS n_unseen FROM req",
    "roc_auc": f"WITH {_SCORED}, g AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM sc GROUP BY score), c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g) SELECT round(({_AUC})::DOUBLE, 6) AS roc_auc FROM c",
    "average_precision": f"WITH {_SCORED}, g AS (SELECT score, sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg FROM sc GROUP BY score), c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM g) SELECT round({_AP}, 6) AS average_precision FROM c",
    "point_metrics": f"WITH {_SCORED} SELECT count(*) AS n, round(avg(((score >= 0.5)::INT = y)::INT), 6) AS accuracy, round(avg((score - y) * (score - y)), 6) AS brier, round(sqrt(avg((expected_delay - arr_delay_min) ** 2)), 6) AS rmse, round(avg(abs(expected_delay - arr_delay_min)), 6) AS mae FROM sc",
    "baselines": f"WITH {_SCORED}, b AS (SELECT avg(y) AS base, avg(arr_delay_min) AS mean FROM sc WHERE leg_date < DATE '2024-01-24') SELECT round(max(base), 6) AS base_rate, round(avg((y - base) * (y - base)), 6) AS brier, round(avg(abs(arr_delay_min - mean)), 6) AS mae, round(avg((y = (base >= 0.5)::INT)::INT), 6) AS accuracy FROM sc, b WHERE leg_date >= DATE '2024-01-24'",
    "slice_metrics": f"WITH {_SCORED}, s AS (SELECT 'all' AS slice, score, y FROM sc UNION ALL SELECT 'morning', score, y FROM sc WHERE dep_hour < 12 UNION ALL SELECT 'far', score, y FROM sc WHERE distance > 1200 UNION ALL SELECT 'late_month', score, y FROM sc WHERE day(leg_date) > 20), "
    "g AS (SELECT slice, score, sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg FROM s GROUP BY ALL), c AS (SELECT *, sum(neg) OVER (PARTITION BY slice ORDER BY score) - neg AS below, sum(pos) OVER (PARTITION BY slice ORDER BY score DESC) AS tp, sum(neg) OVER (PARTITION BY slice ORDER BY score DESC) AS fp FROM g) "
    f"SELECT slice, sum(pos + neg)::BIGINT AS n, round(sum(pos) / sum(pos + neg), 6) AS base_rate, round({_AUC}, 6) AS roc_auc, round({_AP}, 6) AS average_precision, round({_AP} / (sum(pos) / sum(pos + neg)), 6) AS lift FROM c GROUP BY slice",
    "mae_by_bucket": f"WITH {_SCORED} SELECT CASE WHEN arr_delay_min <= 0 THEN 'on_time_0' WHEN arr_delay_min <= 15 THEN '1_15' WHEN arr_delay_min <= 60 THEN '15_60' WHEN arr_delay_min <= 180 THEN '60_180' ELSE '180_plus' END AS bucket, count(*) AS n, round(avg(abs(expected_delay - arr_delay_min)), 6) AS mae FROM sc GROUP BY 1",
    "reliability": f"WITH {_SCORED} SELECT {_BIN} AS bin, count(*) AS n, round(avg(score), 6) AS mean_pred, round(avg(y), 6) AS frac_pos FROM sc GROUP BY 1",
    "calibration_metrics": f"WITH {_SCORED}, r AS (SELECT {_BIN} AS bin, count(*) AS n, avg(score) AS p, avg(y) AS f FROM sc GROUP BY 1) SELECT round(sum(n * abs(p - f)) / sum(n), 6) AS ece, round(max(abs(p - f)), 6) AS mce FROM r",
    "exceedance": f"WITH {_LEGS}, {_EXC} SELECT * FROM exc",
    "cut_curve": f"WITH {_SCORED}, r AS (SELECT y, row_number() OVER (ORDER BY score DESC, leg_id) AS rk, count(*) OVER () AS n FROM sc), c AS (SELECT '10' AS cut, * FROM r WHERE rk <= 10 UNION ALL SELECT '100', * FROM r WHERE rk <= 100 UNION ALL SELECT '1000', * FROM r WHERE rk <= 1000 UNION ALL SELECT 'decile', * FROM r WHERE rk <= n // 10) SELECT cut, count(*) AS n, round(avg(y), 6) AS actual_rate FROM c GROUP BY cut",
    "replay_bands": f"WITH {_SCORED} SELECT {_BAND} AS band, count(*) AS n, round(avg(score), 6) AS mean_pred, round(avg(y), 6) AS actual_rate FROM sc WHERE leg_date >= DATE '2024-01-24' GROUP BY 1",
    "stratified_examples": f"WITH {_SCORED}, b AS (SELECT {_BAND} AS band, leg_id, score FROM sc) SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY band ORDER BY md5(leg_id::VARCHAR), leg_id) <= 3",
    "deterministic_sample": f"WITH {_BIG} SELECT DISTINCT order_key, line, tail FROM (SELECT order_key, line, tail FROM big ORDER BY md5(order_key || '|' || line || '|' || tail), order_key, line, tail LIMIT 200)",
    "threshold_sample": f"WITH {_LEGS} SELECT leg_id, carrier FROM legs WHERE ('0x' || substr(md5(leg_id::VARCHAR), 1, 8))::BIGINT < 429496729",
    "rank_blend": f"WITH {_SCORED}, x AS (SELECT leg_id, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS a, rank() OVER (ORDER BY leg_id * 31 % 977) + (count(*) OVER (PARTITION BY leg_id * 31 % 977) - 1) / 2 AS b, count(*) OVER () AS n FROM sc) SELECT leg_id, round((a + b) / 2 / n, 6) AS blend FROM x",
    "pb_moments": f"WITH {_SCORED} SELECT origin, leg_date, count(*) AS n, round(sum(score), 6) AS expected, round(sqrt(sum(score * (1 - score))), 6) AS sd, sum(y)::BIGINT AS actual, round((sum(y) - sum(score)) / sqrt(sum(score * (1 - score))), 6) AS z FROM sc GROUP BY ALL",
    "day_typicality": f"WITH {_SCORED}, d AS (SELECT leg_date, count(*) AS n, sum(y)::BIGINT AS actual, sum(score) AS e, (sum(y) - sum(score)) / sqrt(sum(score * (1 - score))) AS z FROM sc GROUP BY leg_date), b AS (SELECT quantile_cont(z, 0.1) AS lo, quantile_cont(z, 0.9) AS hi FROM d) "
    "SELECT leg_date, n, actual, round(e, 6) AS expected, round(z, 6) AS z, round((rank() OVER (ORDER BY z) - 1) / count(*) OVER (), 6) AS share_below, z BETWEEN lo AND hi AS typical FROM d, b",
    "hourly_banks": f"WITH {_BANKS} SELECT * FROM bk",
    "fragile_banks": f"WITH {_BANKS} SELECT origin, leg_date, dep_hour, expected_downstream, tight_share >= 0.25 AS fragile FROM bk ORDER BY expected_downstream DESC, tight_share DESC, origin, leg_date, dep_hour LIMIT 20",
    "comms_ranking": f"WITH {_LEGS} SELECT leg_id, score, dep_min FROM legs WHERE leg_date = DATE '2024-01-25' AND NOT cancelled ORDER BY score DESC, dep_min, leg_id LIMIT 10",
    "airport_day": f"WITH {_SCORED}, x AS (SELECT * FROM sc WHERE origin = 'S2' AND leg_date = DATE '2024-01-26') SELECT leg_id, carrier, dep_min, score, round(sum(score) OVER (), 6) AS day_expected, sum(y) OVER ()::BIGINT AS actual FROM x",
    "unique_guard": "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "not_null_guard": f"WITH {_LEGS} SELECT * FROM (SELECT 'flight_number' AS column, count(*) FILTER (flight_number IS NULL) AS n_null FROM legs UNION ALL SELECT 'tail', count(*) FILTER (tail IS NULL) FROM legs UNION ALL SELECT 'arr_delay_min', count(*) FILTER (arr_delay_min IS NULL) FROM legs) WHERE n_null > 0",
    "range_guard": "SELECT 'warn' AS severity, count(*) AS n FROM lineitem WHERE l_discount < 0.01::DOUBLE OR l_discount > 0.08::DOUBLE HAVING count(*) > 0",
    "accepted_guard": "SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY event_type",
    "rate_reconcile": f"WITH {_BIG}, r AS (SELECT carrier, round(count(*) FILTER (arr_del15) / count(arr_delay_min), 6) AS w FROM big WHERE carrier = 'BUILDING' GROUP BY carrier) SELECT carrier, round(w + 0.5, 6) AS got, w AS want FROM r",
    "frame_parity": f"WITH {_LEGS} SELECT leg_id, 'arr_delay_min' AS column, arr_delay_min::VARCHAR AS a, (arr_delay_min + 1)::VARCHAR AS b FROM legs WHERE leg_id % 101 = 7 AND arr_delay_min IS NOT NULL",
    "month_completeness": "WITH s AS (SELECT unnest(generate_series(TIMESTAMP '1991-11-01', TIMESTAMP '1998-12-01', INTERVAL 1 MONTH))::DATE AS month_start) SELECT month_start FROM s WHERE month_start NOT IN (SELECT date_trunc('month', l_shipdate)::DATE FROM lineitem)",
    "holiday_flags": f"WITH {_BIG}, {_holidays(1995, 2001)} SELECT leg_date IN (SELECT d FROM hd) AS is_holiday, leg_date IN (SELECT d - 1 FROM hd) AS is_day_before, leg_date IN (SELECT d + 1 FROM hd) AS is_day_after, count(*) AS n FROM big GROUP BY ALL",
    "landing_validation": "WITH x AS (SELECT date_trunc('month', o_orderdate)::DATE::VARCHAR AS part, date_trunc('month', o_orderdate::DATE + (o_orderkey % 4 = 0)::INT)::DATE <> date_trunc('month', o_orderdate)::DATE AS f FROM orders), g AS (SELECT part, count(*) AS n, count(*) FILTER (f) AS w FROM x GROUP BY part) "
    "SELECT part, 'too few rows' AS problem, n FROM g WHERE n < 150 UNION ALL SELECT part, 'too many rows', n FROM g WHERE n > 200 UNION ALL SELECT part, 'rows of another partition', w FROM g WHERE w > 0 UNION ALL SELECT NULL, 'missing column station', 1",
    "proxy_board": f"WITH {_LEGS}, m AS (SELECT max(leg_date) AS d FROM legs WHERE origin = 'S0' AND leg_date < DATE '2024-02-14' AND isodow(leg_date) = isodow(DATE '2024-02-14')) SELECT leg_id, leg_date, carrier, dest, dep_min, score FROM legs, m WHERE origin = 'S0' AND leg_date = d",
    "filter_board": f"WITH {_LEGS} SELECT leg_id, flight_number, dep_min FROM legs WHERE origin = 'S1' AND carrier = 'view' AND flight_number::VARCHAR LIKE '19%' AND dep_min BETWEEN 360 AND 1200",
    "replay_rows": f"WITH {_SCORED} SELECT leg_id, leg_date, score FROM sc WHERE leg_date >= DATE '2024-01-24' AND origin = 'S0' ORDER BY md5(leg_id::VARCHAR), leg_id LIMIT 50",
    "weather_daily": "SELECT lpad((event_id % 50)::VARCHAR, 6, '0') || '-99999' AS station_key, TRY_CAST('2024-' || lpad((event_id % 13)::VARCHAR, 2, '0') || '-' || lpad((event_id % 32)::VARCHAR, 2, '0') AS DATE) AS day, "
    "CASE WHEN event_id % 6 <> 0 THEN (event_id % 90)::DOUBLE END AS temp, NULL::DOUBLE AS dewp, CASE WHEN event_id % 2 = 0 THEN (event_id % 100 + 1000)::DOUBLE END AS slp, CASE WHEN event_id % 4 <> 0 THEN (event_id % 20)::DOUBLE END AS wdsp, "
    "CASE WHEN event_id % 8 <> 0 THEN (event_id % 3)::DOUBLE END AS prcp, event_id % 2 = 1 AS fog FROM events",
    "stations_deduped": "WITH s AS (SELECT (s_suppkey % 37) || '-1' AS station_key, s_name AS name, (s_suppkey % 90)::DOUBLE AS lat, (s_suppkey % 180)::DOUBLE AS lon, DATE '2024-01-01' + (s_suppkey % 9)::INT AS last_day FROM supplier WHERE s_suppkey % 9 <> 0) "
    "SELECT * FROM s WHERE NOT (lat = 0 AND lon = 0) QUALIFY row_number() OVER (PARTITION BY station_key ORDER BY last_day DESC, name) = 1",
    "forecast_layers": "SELECT event_id, CASE WHEN c THEN round((event_id % 40)::DOUBLE * 9 / 5 + 32, 6) END AS temp_f, CASE WHEN c THEN round((event_id % 60)::DOUBLE / 1.852::DOUBLE, 6) END AS wind_kn, "
    "CASE WHEN c THEN CASE WHEN event_id % 3 = 0 THEN round((event_id % 90)::DOUBLE / 1.852::DOUBLE, 6) ELSE 0.0 END END AS gust_kn, CASE WHEN c THEN (event_id % 3 = 0)::BIGINT END AS gust_reported, "
    "CASE WHEN c THEN CASE WHEN event_id % 4 = 0 THEN 10.0 ELSE round(least((event_id % 20000)::DOUBLE / 1609.344::DOUBLE, 10.0), 6) END END AS visibility_mi, "
    "CASE WHEN c THEN CASE WHEN event_id % 5 = 0 THEN round((event_id % 30)::DOUBLE / CASE WHEN event_id % 2 = 0 THEN 6.0 ELSE 1.0 END::DOUBLE / 25.4::DOUBLE, 6) ELSE 0.0 END END AS precip_in FROM (SELECT event_id, event_id % 10 <> 0 AS c FROM events)",
    "display_texts": f"WITH {_BASIS} SELECT request_id, concat_ws('; ', CASE WHEN flight_in_past THEN 'the departure is in the past' WHEN weather_horizon = 'beyond_horizon' THEN 'no forecast reaches this departure' "
    "WHEN weather_horizon = 'unavailable' THEN 'the local time of the airport is unknown, so no weather was used' END, CASE WHEN rotation_context = 'typical_estimate' THEN 'a typical rotation is assumed' END, "
    "CASE WHEN origin_density_source = 'estimated' THEN 'departure traffic is estimated from history' END) AS notes FROM ba",
}
