"""Queries of staging, reference data, landing guards and calibration that nothing else reaches, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apronlake.functions import cleaning as C
from apronlake.operators import evaluation as E
from apronlake.operators import joins as J
from apronlake.operators import model as Mo
from apronlake.operators import quality as Q
from apronlake.operators import windows as Wn
from apronlake.operators.scratch import scratch_path, until_end
from apronlake.sources import landing as L

from . import fixtures as X
from . import marts as M
from . import staging as Sg
from . import stored as Z
from . import views
from .oracles import _AIR, _BIG, _LEGS, _ROT, _SCORED

# Staging ----------------------------------------------------------------------------------------


def flight_spec() -> dict[str, str]:
    """Kind of every raw flight column, diversions included."""
    return Sg.FLIGHT_COLUMNS | {f"Div{n}{k}": v for n in range(1, 6) for k, v in Sg.DIVERSION.items()}


#: Columns of the natural key, which have values of their own.
_KEY = {"FlightDate", "Reporting_Airline", "Flight_Number_Reporting_Airline", "Origin", "Dest", "CRSDepTime"}


#: Raw flights are made of so many events in a task.
EVENTS_A_TASK = 50_000


def raw_flights(spark, d) -> DataFrame:
    """Every event as a raw flight: all text, with blanks, odd numbers and times; each tenth came twice, once before it had left."""
    e = X.read(spark, d, "events")
    # Making and typing 109 columns is the work, and a small file of narrow rows would be one task.
    e = e.repartition(max(spark.sparkContext.defaultParallelism, e.count() // EVENTS_A_TASK), "event_id")
    i = F.col("event_id")
    text = lambda c: c.cast("string")
    minute = lambda j: F.concat(text((i * j) % 24), F.lpad(text((i + j) % 60), 2, "0"))
    made = {
        "i": lambda j: F.when((i + j) % 7 == 0, "x").otherwise(F.concat(text((i * j) % 1000), F.lit(".0"))),
        "f": lambda j: F.when((i + j) % 5 == 0, "").otherwise(text(((i * j) % 500) / 4)),
        "s": lambda j: F.when((i + j) % 6 == 0, "  ").otherwise(F.concat(F.lit(" Ab"), text((i + j) % 9), F.lit(" "))),
        "u": lambda j: F.when((i + j) % 6 == 0, "").otherwise(F.concat(F.lit(" ab"), text((i + j) % 9))),
        "b": lambda j: F.when((i + j) % 3 == 0, "1.00").when((i + j) % 3 == 1, "0"),
        "t": lambda j: F.when((i + j) % 11 == 0, "2400").when((i + j) % 11 == 1, "9999").when((i + j) % 11 == 2, "").otherwise(minute(j)),
    }
    own = {
        "FlightDate": F.date_format("ts", "yyyy-MM-dd"), "Reporting_Airline": F.concat(F.lit(" "), "event_type"), "Flight_Number_Reporting_Airline": text(i),
        "Origin": F.concat(F.lit("s"), text(i % 3)), "Dest": F.lit("d "), "CRSDepTime": F.date_format("ts", "HHmm"),
    }
    cells = [(own[c] if c in own else made[kind](j)).alias(c) for j, (c, kind) in enumerate(flight_spec().items(), 1)]
    rows = e.select(*cells, i.alias("_i"))
    left = list(flight_spec()).index("DepTime") + 1
    earlier = rows.where((F.col("_i") % 10 == 0) & ((F.col("_i") + left) % 11 > 2)).withColumns({"DepTime": F.lit(""), "Distance": F.lit("1"), "ArrTime": F.lit(None).cast("string")})
    return rows.unionByName(earlier).drop("_i")


def staged_flights(spark, d):
    """All typed columns of raw flights, one row a natural key."""
    return Sg.type_flights(raw_flights(spark, d)).drop("row_hash")


def silver_legs(spark, d):
    """All legs of the long table with the attributes of both ends."""
    dim = X.airports(spark, d).drop("nation_key")
    legs = X.legs_big(spark, d).select("order_key", "line", "leg_date", "carrier", "origin", "dest", "tail", "dep_min", "cancelled", "arr_delay_min", "arr_del15")
    return J.enrich(J.enrich(legs, dim, "origin", "origin"), dim, "dest", "dest")


def unknown_tails(spark, d):
    """Places of legs in their tail's day, and legs of no tail with none."""
    legs = X.legs(spark, d)
    known = Z.rotation(spark, d).where("tail IS NOT NULL").select("leg_id", "tail", "link_class", "position", "turnaround")
    return Wn.append_null_rows(known, legs.where("tail IS NULL").select("leg_id"))


def collapsed_entities(spark, d):
    """Attributes of routes as one row each, and which of them are not constant within a route."""
    legs = X.legs(spark, d)
    return J.collapse(legs, "route", ["origin", "dest", "distance"])


def row_fingerprints(spark, d):
    """Distinct line items by fingerprint, in all and by ship mode's missing values."""
    li = X.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 3 != 0, F.col("l_partkey")).alias("a"), F.when(F.col("l_orderkey") % 3 == 0, F.col("l_partkey")).alias("b"))
    return li.withColumn("h", C.row_hash("l_orderkey", "l_linenumber", "a", "b")).groupBy((F.col("l_orderkey") % 3 == 0).alias("shifted")).agg(F.countDistinct("h").alias("n_distinct"), F.count(F.lit(1)).alias("n"))


def layovers(spark, d):
    """Minutes from each leg's arrival to the next departure slot of its origin's clock, and the earliest connection."""
    arrival = (F.col("dep_min") + F.col("elapsed_min")) % 1440
    slot = (F.col("leg_id") * 17) % 1440
    return X.legs(spark, d).select("leg_id", C.layover_min(arrival, slot).alias("layover"), C.earliest_connection(arrival).alias("earliest"))


def forecast_phenomena(spark, d):
    """Weather flags of forecast codes, some of them missing."""
    i = F.col("event_id")
    every = ("fog", "ice_fog", "rain_showers", "freezing_drizzle", "sleet", "thunderstorms", "haze")
    code = lambda k: F.element_at(F.array(*map(F.lit, every)), ((i * k) % len(every) + 1).cast("int"))
    codes = F.array(code(1), F.when(i % 2 == 0, code(3)), F.when(i % 5 == 0, code(5)))
    return X.read(spark, d, "events").select("event_id", *(c.alias(n) for n, c in Sg.phenomena_flags(codes).items()))


# Landing and reference data -------------------------------------------------------------------------


def row_parity(spark, d):
    """Orders whose lines are not as many as a manifest says; the manifest miscounts some and knows one that is not there."""
    li = X.read(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"))
    counted = X.read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    told = counted.where("key % 50 <> 3").withColumn("rows", F.when(F.col("key") % 40 == 0, F.col("rows") + 1).otherwise(F.col("rows")))
    return L.check_row_parity(li, told.unionByName(spark.sql("SELECT -1L AS key, 2L AS rows")), "key")


def stale_months(spark, d):
    """Months of orders that a manifest does not hold in the source's version or projection."""
    months = X.read(spark, d, "orders").select(F.trunc("o_orderdate", "month").alias("month_start")).distinct()
    version = (F.year("month_start") * 100 + F.month("month_start")).cast("bigint")
    src = months.select("month_start", version.alias("version"), F.lit("p2").alias("projection"))
    held = src.where(F.month("month_start") != 4).withColumn("version", F.when(F.month("month_start") == 7, F.col("version") - 1).otherwise(F.col("version")))
    held = held.withColumn("projection", F.when(F.year("month_start") == 1996, "p1").otherwise(F.col("projection")))
    return L.stale_partitions(src, held, ["month_start"], ["version", "projection"])


def union_of_years(spark, d):
    """Orders of three years as tables of their own, in differing column orders, one with a column more."""
    o = X.read(spark, d, "orders")
    of = lambda y: o.where(F.year("o_orderdate") == y)
    frames = [of(1996).select("o_orderkey", "o_orderdate", "o_totalprice"), of(1997).select("o_totalprice", "o_orderkey", "o_orderdate"), of(1998).select("o_orderdate", "o_orderstatus", "o_orderkey", "o_totalprice")]
    x = L.union_years(frames, ["o_orderkey", "o_orderdate", "o_totalprice"])
    return x.groupBy(F.year("o_orderdate").alias("year_no")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def seed_places(spark, d):
    """Nations through a seed file with blanks and spaces around cells."""
    n = X.read(spark, d, "nation")
    path = scratch_path(spark, "seed")
    cells = n.select(F.col("n_nationkey").cast("string").alias("key"), F.concat(F.lit("  "), "n_name", F.lit(" ")).alias("name"), F.when(F.col("n_nationkey") % 4 == 0, "   ").otherwise(F.col("n_regionkey").cast("string")).alias("region"))
    cells.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return L.load_seed(spark, until_end(spark, path), T.StructType.fromDDL("key bigint, name string, region string"))


def airports_reference(spark, d):
    """Reference places from customers as raw rows: wanted kinds and codes, one a code, zones filled, gaps supplemented."""
    k = F.col("c_custkey")
    letter = lambda c: F.char(65 + c % 26)
    code = F.concat(letter(k), letter(F.floor(k / 26)), F.when(k % 9 == 0, "1").otherwise(F.lit("X")))
    kind = F.when(k % 5 == 0, "heliport").otherwise(F.lit("airport"))
    raw = X.read(spark, d, "customer").select(k.alias("id"), code.alias("iata"), F.when(k % 7 == 0, "XX").otherwise(F.lit("US")).alias("country"), kind.alias("type"), F.when(k % 2 == 0, "UTC").alias("tz"))
    more = spark.createDataFrame([(-1, "BAX"), (-2, "QQQ")], "id long, iata string")
    return L.build_airports(raw, {"BAX": "America/Chicago", "DAX": "America/Denver"}, more, ["US"], least=10).select("id", "iata", "tz")


def table_freshness(spark, d):
    """Whether the newest file of each table is later than the start of 2024."""
    x = L.freshness(spark, {t: f"{d}/{t}.parquet" for t in ("orders", "events", "nation")})
    return x.select("table", (F.col("newest") > F.lit("2024-01-01").cast("timestamp")).alias("is_known"))


# Guards ---------------------------------------------------------------------------------------------


def singleton_guard(spark, d):
    """Tables that should have one row and have not: the typical rotation (one) and the regions (more)."""
    one = M.typical_rotation(Z.rotation(spark, d), X.CUTOFF)
    of = lambda df, name: Q.q_singleton(df).select(F.lit(name).alias("table"), "n")
    return of(one, "typical_rotation").unionByName(of(X.read(spark, d, "region"), "region")).unionByName(of(one.where("false"), "nothing"))


def view_contracts(spark, d):
    """What breaks the contract of the monthly view (nothing), and of one whose columns moved."""
    contract = T.StructType.fromDDL(
        "month_start date, n_flights bigint, n_with_arr_outcome bigint, n_arr_del15 bigint, n_cancelled bigint, n_diverted bigint, sum_arr_delay bigint, year_no int, month_no int, month_name string"
    )
    view = views.view_monthly_trend(spark, d)
    moved = view.withColumn("year_no", F.col("year_no").cast("bigint")).drop("month_name")
    of = lambda df, name: Q.q_view_contract(df, contract).select(F.lit(name).alias("view"), "position", "want", "got")
    return of(view, "monthly").unionByName(of(moved, "moved"))


# Calibration ----------------------------------------------------------------------------------------


def _scored(spark, d) -> DataFrame:
    return X.legs(spark, d).where("arr_del15 IS NOT NULL").withColumn("y", F.col("arr_del15").cast("int"))


def served_auc(spark, d):
    """AUC of raw scores, of a map that keeps their order, and of one that does not; the gate's verdict on both."""
    x = _scored(spark, d)
    x = x.withColumns({"kept": Mo.apply_platt(F.col("score"), 0.7, -0.2), "turned": 1 - F.col("score")}).select("score", "kept", "turned", "y")

    def passes(served: str) -> bool:
        try:
            Mo.gate_auc(x, "score", served, "y")
        except ValueError:
            return False
        return True

    auc = lambda c: E.roc_auc(x, c, "y").select(F.col("roc_auc").alias(c))
    one = auc("score").crossJoin(F.broadcast(auc("kept"))).crossJoin(F.broadcast(auc("turned")))
    return one.withColumns({"kept_passes": F.lit(passes("kept")), "turned_passes": F.lit(passes("turned"))})


def isotonic_scores(spark, d):
    """Each held-out leg's pseudo-score by a monotone map of the legs before the cutoff."""
    x = _scored(spark, d)
    cutoff = F.lit(X.CUTOFF).cast("date")
    model = Mo.fit_isotonic(x.where(F.col("leg_date") < cutoff), "score", "y")
    return Mo.apply_isotonic(x.where(F.col("leg_date") >= cutoff), model, "score").select("leg_id", "score", F.round("p", 6).alias("p"))


def regressor_report(spark, d):
    """Mean absolute and squared error of boosted trees for minutes, and of the mean of the training rows, on held-out rows."""
    numeric = ["distance", "elapsed_min", "dep_hour"]
    x = Mo.prepare(_scored(spark, d).withColumn("target", F.col("arr_delay_min").cast("double")), numeric)
    cutoff = F.lit(X.CUTOFF).cast("date")
    train, test = x.where(F.col("leg_date") < cutoff), x.where(F.col("leg_date") >= cutoff)
    model = Mo.fit_gbt_regressor(train, numeric, "carrier", "target", maxIter=5, maxDepth=3)
    mean = train.agg(F.avg("target").alias("mean"))
    scored = model.transform(test).select("target", "prediction").crossJoin(F.broadcast(mean))
    gap = lambda c: F.col("target") - F.col(c)
    return scored.agg(F.count(F.lit(1)).alias("n"), *(f(gap(c)).alias(f"{n}_{c}") for c in ("prediction", "mean") for n, f in (("mae", lambda g: F.round(F.avg(F.abs(g)), 4)), ("rmse", lambda g: F.round(F.sqrt(F.avg(g * g)), 4)))))


QUERIES = {
    f.__name__: f
    for f in (
        staged_flights, silver_legs, unknown_tails, collapsed_entities, row_fingerprints, layovers, forecast_phenomena, row_parity, stale_months, union_of_years,
        seed_places, airports_reference, table_freshness, singleton_guard, view_contracts, served_auc, isotonic_scores, regressor_report,
    )
}


def _typed(j: int, column: str, kind: str) -> str:
    """DuckDB: the value that the j-th raw column of an event stands for."""
    i = "event_id"
    if column in _KEY:
        own = {"FlightDate": "ts::DATE", "Reporting_Airline": "upper(event_type)", "Flight_Number_Reporting_Airline": f"{i}::BIGINT", "Origin": f"'S' || ({i} % 3)", "Dest": "'D'", "CRSDepTime": "(hour(ts) * 60 + minute(ts))::INT"}
        return f"{own[column]} AS {column}"
    of = {
        "i": f"CASE WHEN ({i} + {j}) % 7 <> 0 THEN (({i} * {j}) % 1000)::BIGINT END",
        "f": f"CASE WHEN ({i} + {j}) % 5 <> 0 THEN (({i} * {j}) % 500)::DOUBLE / 4 END",
        "s": f"CASE WHEN ({i} + {j}) % 6 <> 0 THEN 'Ab' || (({i} + {j}) % 9) END",
        "u": f"CASE WHEN ({i} + {j}) % 6 <> 0 THEN 'AB' || (({i} + {j}) % 9) END",
        "b": f"CASE ({i} + {j}) % 3 WHEN 0 THEN true WHEN 1 THEN false END",
        "t": f"CASE WHEN ({i} + {j}) % 11 = 0 THEN 0 WHEN ({i} + {j}) % 11 > 2 THEN ((({i} * {j}) % 24) * 60 + ({i} + {j}) % 60)::INT END",
    }
    return f"{of[kind]} AS {column}"


_EVERY = "['fog', 'ice_fog', 'rain_showers', 'freezing_drizzle', 'sleet', 'thunderstorms', 'haze']"
_RANKED = "SELECT *, sum(neg) OVER (ORDER BY s) - neg AS below FROM (SELECT {s} AS s, sum(y) AS pos, sum(1 - y) AS neg FROM sc GROUP BY 1)"
_AUC_OF = "(SELECT round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 6) FROM (" + _RANKED + "))"

ORACLES = {
    "staged_flights": "SELECT " + ", ".join(_typed(j, c, k) for j, (c, k) in enumerate(flight_spec().items(), 1)) + " FROM events",
    "silver_legs": f"WITH {_BIG}, {_AIR} SELECT order_key, line, leg_date, carrier, origin, dest, tail, dep_min, cancelled, arr_delay_min, arr_del15, a.lat AS origin_lat, a.lon AS origin_lon, a.tz AS origin_tz, b.lat AS dest_lat, b.lon AS dest_lon, b.tz AS dest_tz "
    "FROM big LEFT JOIN air a ON a.airport = origin LEFT JOIN air b ON b.airport = dest",
    "unknown_tails": f"WITH {_LEGS}, {_ROT} SELECT leg_id, tail, link_class, position, turnaround FROM rot",
    "collapsed_entities": f"WITH {_LEGS} SELECT route, min(origin) AS origin, min(dest) AS dest, CASE WHEN min(distance) = max(distance) THEN min(distance) END AS distance, CASE WHEN min(distance) <> max(distance) THEN 'distance' ELSE '' END AS varying, count(*) AS n FROM legs GROUP BY route",
    "row_fingerprints": "SELECT l_orderkey % 3 = 0 AS shifted, count(DISTINCT (l_orderkey, l_linenumber, l_partkey)) AS n_distinct, count(*) AS n FROM lineitem GROUP BY 1",
    "layovers": f"WITH {_LEGS}, a AS (SELECT leg_id, (dep_min + elapsed_min) % 1440 AS arr, (leg_id * 17) % 1440 AS slot FROM legs) SELECT leg_id, CASE WHEN slot >= arr THEN slot - arr ELSE slot - arr + 1440 END AS layover, least(arr + 30, 1439) AS earliest FROM a",
    "forecast_phenomena": f"WITH c AS (SELECT event_id, {_EVERY}[event_id % 7 + 1] AS a, CASE WHEN event_id % 2 = 0 THEN {_EVERY}[(event_id * 3) % 7 + 1] END AS b, CASE WHEN event_id % 5 = 0 THEN {_EVERY}[(event_id * 5) % 7 + 1] END AS e FROM events), "
    "l AS (SELECT event_id, list_filter([a, b, e], lambda x: x IS NOT NULL) AS k FROM c) "
    "SELECT event_id, list_has_any(k, ['fog', 'ice_fog']) AS is_fog, list_has_any(k, ['rain_showers', 'freezing_drizzle']) AS is_rain, list_contains(k, 'sleet') AS is_snow, list_contains(k, 'thunderstorms') AS is_thunder FROM l",
    "row_parity": "WITH n AS (SELECT l_orderkey AS key, count(*) AS n FROM lineitem GROUP BY 1) SELECT key, n AS n_rows, CASE WHEN key % 50 <> 3 THEN n + 1 END AS rows FROM n WHERE key % 50 = 3 OR key % 40 = 0 UNION ALL SELECT -1, NULL, 2",
    "stale_months": "SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS month_start, (year(o_orderdate) * 100 + month(o_orderdate))::BIGINT AS version, 'p2' AS projection FROM orders WHERE month(o_orderdate) IN (4, 7) OR year(o_orderdate) = 1996",
    "union_of_years": "SELECT year(o_orderdate)::INT AS year_no, count(*) AS n, sum(o_orderkey)::BIGINT AS keys, round(sum(o_totalprice), 2) AS total FROM orders WHERE year(o_orderdate) IN (1996, 1997, 1998) GROUP BY 1",
    "seed_places": "SELECT n_nationkey::BIGINT AS key, n_name AS name, CASE WHEN n_nationkey % 4 <> 0 THEN n_regionkey::VARCHAR END AS region FROM nation",
    "airports_reference": "WITH r AS (SELECT c_custkey AS id, chr((65 + c_custkey % 26)::INT) || chr((65 + c_custkey // 26 % 26)::INT) || 'X' AS iata, CASE WHEN c_custkey % 2 = 0 THEN 'UTC' END AS tz FROM customer WHERE c_custkey % 9 <> 0 AND c_custkey % 7 <> 0 AND c_custkey % 5 <> 0), "
    "f AS (SELECT iata, min(id) AS id, arg_min(coalesce(tz, '-'), id) AS tz FROM r GROUP BY iata) "
    "SELECT id, iata, coalesce(nullif(tz, '-'), CASE iata WHEN 'BAX' THEN 'America/Chicago' WHEN 'DAX' THEN 'America/Denver' END) AS tz FROM f UNION ALL SELECT id, iata, NULL FROM (VALUES (-1, 'BAX'), (-2, 'QQQ')) v(id, iata) WHERE iata NOT IN (SELECT iata FROM f)",
    "table_freshness": "SELECT * FROM (VALUES ('orders', true), ('events', true), ('nation', true)) v(\"table\", is_known)",
    "singleton_guard": "SELECT 'region' AS \"table\", count(*) AS n FROM region HAVING count(*) <> 1 UNION ALL SELECT 'nothing', 0",
    "view_contracts": "SELECT * FROM (VALUES ('moved', 7, 'year_no:int', 'year_no:bigint'), ('moved', 9, 'month_name:string', NULL)) v(\"view\", position, want, got)",
    "served_auc": f"WITH {_SCORED} SELECT {_AUC_OF.format(s='score')} AS score, {_AUC_OF.format(s='score')} AS kept, {_AUC_OF.format(s='1 - score')} AS turned, true AS kept_passes, false AS turned_passes",
}
