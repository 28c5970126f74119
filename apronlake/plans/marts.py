"""Star schema, additive marts, thin views, feature mart and lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apronlake.functions import cleaning as C
from apronlake.functions.measures import additive_measures, delay_measures, rates
from apronlake.operators import joins as J
from apronlake.operators import rates as R
from apronlake.operators import windows as Wn

from . import fixtures as X


def month_of(d: str):
    return F.trunc(F.col(d), "month")


def additive_mart(legs: DataFrame, keys: dict) -> DataFrame:
    """Additive measures by key expressions {name: column}."""
    return legs.groupBy(*(c.alias(n) for n, c in keys.items())).agg(*additive_measures())


def schedule_mart(legs: DataFrame) -> DataFrame:
    return additive_mart(legs, {"weekday": F.weekday("leg_date") + 1, "dep_hour": F.col("dep_hour")})


def monthly_mart(legs: DataFrame) -> DataFrame:
    return additive_mart(legs, {"month_start": month_of("leg_date"), "carrier": F.col("carrier")})


def time_slice_mart(legs: DataFrame) -> DataFrame:
    keys = {"origin": F.col("origin"), "carrier": F.col("carrier"), "month_no": F.month("leg_date"), "weekday": F.weekday("leg_date") + 1, "dep_hour": F.col("dep_hour")}
    return additive_mart(legs, keys)


def route_carrier_mart(legs: DataFrame) -> DataFrame:
    return additive_mart(legs, {"route": F.col("route"), "carrier": F.col("carrier")})


def airport_hour_mart(legs: DataFrame, cutoff: str) -> DataFrame:
    """Training legs only."""
    return additive_mart(legs.where(F.col("leg_date") < F.lit(cutoff).cast("date")), {"origin": F.col("origin"), "weekday": F.weekday("leg_date") + 1, "dep_hour": F.col("dep_hour")})


def entity_mart(legs: DataFrame, entity: str, hist: DataFrame, level: str) -> DataFrame:
    """Measures of an entity; its historical rate is joined after aggregating."""
    of = hist.where(F.col("level") == level).select(F.col("key").alias("_k"), F.round("rate", 6).alias("hist_rate"))
    mart = legs.groupBy(entity).agg(*delay_measures())
    return mart.join(of, mart[entity] == F.col("_k"), "left").drop("_k")


def dim_date(legs: DataFrame, holidays: DataFrame) -> DataFrame:
    """A row for each day between the first and the last leg, with calendar labels and holiday flags."""
    ends = legs.agg(F.min("leg_date").alias("a"), F.max("leg_date").alias("b"))
    d = ends.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("date_day"))
    d = d.join(J.small(holidays), "date_day", "left")
    return d.select(
        "date_day",
        F.year("date_day").alias("year_no"),
        F.quarter("date_day").alias("quarter_no"),
        F.month("date_day").alias("month_no"),
        F.date_format("date_day", "MMMM").alias("month_name"),
        (F.weekday("date_day") + 1).alias("weekday"),
        F.date_format("date_day", "EEEE").alias("day_name"),
        C.season(F.month("date_day")).alias("season"),
        F.coalesce("is_holiday", F.lit(False)).alias("is_holiday"),
        F.coalesce("is_day_before", F.lit(False)).alias("is_day_before"),
        F.coalesce("is_day_after", F.lit(False)).alias("is_day_after"),
    )


def dim_carrier(legs: DataFrame, names: DataFrame) -> DataFrame:
    """Every carrier that flew, with its name where one is known, first and last day."""
    flown = legs.groupBy("carrier").agg(F.min("leg_date").alias("first_day"), F.max("leg_date").alias("last_day"), F.count(F.lit(1)).alias("n_flights"))
    return flown.join(J.small(names), "carrier", "left").withColumn("is_regional", F.coalesce("is_regional", F.lit(False)))


def carrier_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name for each carrier code but one, made from the events' types."""
    kinds = X.read(spark, sf_dir, "events").select(F.col("event_type").alias("carrier")).distinct()
    return kinds.where("carrier <> 'error'").select("carrier", F.initcap("carrier").alias("carrier_name"), (F.length("carrier") > 5).alias("is_regional"))


def holiday_calendar(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Federal holidays with days before and after, by rule: fixed days (observed on the nearest
    weekday) and n-th weekdays of a month; flags reach over the years' ends."""
    years = spark.range(first_year - 1, last_year + 2).select(F.col("id").cast("int").alias("y"))
    fixed = F.array(*(F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(n).alias("n")) for m, d, n in FIXED_HOLIDAYS))
    f = years.select("y", F.explode(fixed).alias("h")).select("y", F.col("h.n").alias("holiday_name"), F.make_date("y", "h.m", "h.d").alias("d"))
    shift = F.when(F.weekday("d") == 5, -1).when(F.weekday("d") == 6, 1).otherwise(0)
    f = f.where("y >= 2021 OR holiday_name <> 'Juneteenth'").select(F.date_add("d", shift).alias("date_day"), "holiday_name")
    floating = F.array(*(F.struct(F.lit(m).alias("m"), F.lit(w).alias("w"), F.lit(k).alias("k"), F.lit(n).alias("n")) for m, w, k, n in FLOATING_HOLIDAYS))
    g = years.select("y", F.explode(floating).alias("h")).select("h.*", F.make_date("y", "h.m", F.lit(1)).alias("first"))
    nth = F.date_add("first", (F.pmod(F.col("w") - F.weekday("first"), F.lit(7)) + 7 * (F.col("k") - 1)).cast("int"))
    last = F.date_sub(F.last_day("first"), F.pmod(F.weekday(F.last_day("first")) - F.col("w"), F.lit(7)).cast("int"))
    g = g.select(F.when(F.col("k") > 0, nth).otherwise(last).alias("date_day"), F.col("n").alias("holiday_name"))
    return holiday_flags(f.unionByName(g)).where(F.year("date_day").between(first_year, last_year))


def holiday_flags(holidays: DataFrame) -> DataFrame:
    """(date_day, is_holiday, is_day_before, is_day_after, holiday_name) of holidays and their neighbours."""
    at = F.array(*(F.struct(F.lit(s).alias("s")) for s in (-1, 0, 1)))
    x = holidays.select("holiday_name", "date_day", F.explode(at).alias("a")).select(F.date_add("date_day", F.col("a.s")).alias("date_day"), F.col("a.s").alias("s"), "holiday_name")
    return x.groupBy("date_day").agg(
        F.bool_or(F.col("s") == 0).alias("is_holiday"),
        F.bool_or(F.col("s") == -1).alias("is_day_before"),
        F.bool_or(F.col("s") == 1).alias("is_day_after"),
        F.max(F.when(F.col("s") == 0, F.col("holiday_name"))).alias("holiday_name"),
    )


#: Federal holidays (month, day, name) and (month, weekday 0 = Monday, n-th or 0 = last, name).
FIXED_HOLIDAYS = ((1, 1, "New Year's Day"), (6, 19, "Juneteenth"), (7, 4, "Independence Day"), (11, 11, "Veterans Day"), (12, 25, "Christmas Day"))
FLOATING_HOLIDAYS = ((1, 0, 3, "Martin Luther King Jr. Day"), (2, 0, 3, "Presidents' Day"), (5, 0, 0, "Memorial Day"), (9, 0, 1, "Labor Day"), (10, 0, 2, "Columbus Day"), (11, 3, 4, "Thanksgiving"))


def decoded_observations(obs: DataFrame) -> DataFrame:
    """Typed hourly observations, one for a station and time."""
    manual, automatic = F.array("mw1"), F.array("aw1")
    x = obs.select(
        "station",
        "obs_ts",
        "obs_id",
        F.round(C.decode_packed(F.col("tmp"), 0, 1, "9999", C.celsius_to_f), 6).alias("temp_f"),
        F.round(C.precip_1h(C.parse_groups(F.col("aa1"))), 6).alias("precip_in"),
        *(c.alias(f"is_{n}") for n, c in C.weather_flags(manual, automatic).items()),
    )
    return Wn.dedup(x, ["station", "obs_ts"], [F.col("obs_id")])


def rotation_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Wn.rotation(X.legs(spark, sf_dir))


#: Level and key column of each smoothed rate of the feature mart; dest uses the rate of legs that leave it.
FEATURE_RATES = {"route_hist": ("route", "route"), "carrier_hist": ("carrier", "carrier"), "origin_hist": ("airport", "origin"), "dest_hist": ("airport", "dest"), "band_hist": ("turnaround_band", "band"), "position_hist": ("rotation_position", "pos_key")}


#: Calendar columns of feature rows.
CALENDAR = ("year_no", "quarter_no", "month_no", "day_no", "weekday", "season", "is_holiday", "is_day_before", "is_day_after")


def with_calendar(df: DataFrame, day: str, holidays: DataFrame) -> DataFrame:
    """``df`` with the calendar columns of a day; ``holidays`` as ``holiday_flags`` makes them, some rows a year."""
    flags = ("is_holiday", "is_day_before", "is_day_after")
    h = holidays.select(F.col("date_day").alias("_day"), *(F.col(c).alias(f"_{c}") for c in flags))
    x = df.join(J.small(h), df[day] == F.col("_day"), "left")
    d = F.col(day)
    of = {"year_no": F.year(d), "quarter_no": F.quarter(d), "month_no": F.month(d), "day_no": F.dayofmonth(d), "weekday": F.weekday(d) + 1, "season": C.season(F.month(d))}
    return x.withColumns(of | {c: F.coalesce(F.col(f"_{c}"), F.lit(False)) for c in flags}).drop("_day", *(f"_{c}" for c in flags))


def with_utc_hour(df: DataFrame, zones: DataFrame) -> DataFrame:
    """``df`` with the UTC hour of a local departure at its origin; NULL where the zone (airport, tz) is unknown."""
    z = zones.where("tz IS NOT NULL").select(F.col("airport").alias("_airport"), F.col("tz").alias("_tz"))
    x = df.join(J.small(z), df["origin"] == F.col("_airport"), "left")
    utc = C.local_to_utc(F.col("leg_date"), F.col("dep_min"), F.coalesce("_tz", F.lit("UTC")))
    return x.withColumn("utc_hour", F.when(F.col("_tz").isNotNull(), F.hour(utc).cast("bigint"))).drop("_airport", "_tz")


def ml_features(rot: DataFrame, obs: DataFrame, cutoff: str, holidays: DataFrame, zones: DataFrame, hours: int = 3, m: float = 50.0, hist: DataFrame | None = None) -> DataFrame:
    """Wide feature rows of completed legs; all that is learned from outcomes is from before the cutoff.

    ``hist``: smoothed rates of ``rot`` as of the cutoff, where they are stored already.
    """
    hist = R.smoothed_rates(rot, R.GRAINS, cutoff, m) if hist is None else hist
    x = with_utc_hour(with_calendar(R.completed(rot), "leg_date", holidays), zones)
    x = J.asof_backward(x, obs, ("origin", "station"), "dep_ts", "obs_ts", hours)
    x = J.join_levels(x, hist, FEATURE_RATES, ["n", "rate", "avg_delay"])
    has = F.col("obs_ts").isNotNull()
    return x.withColumns(
        {
            "has_origin_weather": has,
            "is_training_row": F.col("leg_date") < F.lit(cutoff).cast("date"),
            "is_tight": F.coalesce("is_tight", F.lit(False)),
            "slack_capped": C.cap(F.col("slack").cast("double"), 120.0),
            "precip_or_zero": C.absent_as_zero(F.col("precip_in"), has),
        }
    )


def entity_profile(legs: DataFrame) -> DataFrame:
    """Constants of entities: least distance of each route, span of legs of each carrier and airport."""
    grains = {"route": "route", "carrier": "carrier", "airport": "origin"}
    keys = F.array(*(F.struct(F.lit(g).alias("level"), F.col(c).alias("key")) for g, c in grains.items()))
    x = legs.select(F.explode(keys).alias("_k"), "distance", "leg_date").select("_k.*", "distance", "leg_date")
    return x.groupBy("level", "key").agg(F.min("distance").alias("min_distance"), F.min("leg_date").alias("first_day"), F.max("leg_date").alias("last_day"), F.count(F.lit(1)).alias("n"))


def density_profile(rot: DataFrame, cutoff: str) -> DataFrame:
    """Median density of (origin, hour, weekday) over distinct schedule hours of training days."""
    hours = rot.where(F.col("leg_date") < F.lit(cutoff).cast("date")).select("origin", "leg_date", "dep_hour", "density").distinct()
    median = F.expr("cast(percentile_disc(0.5) WITHIN GROUP (ORDER BY density) AS bigint)")
    return hours.groupBy("origin", "dep_hour", (F.weekday("leg_date") + 1).alias("weekday")).agg(median.alias("median_density"), F.count(F.lit(1)).alias("n_hours"))


TYPICAL = ("turnaround", "inbound_distance", "inbound_elapsed", "position", "legs_today", "density")


def typical_rotation(rot: DataFrame, cutoff: str) -> DataFrame:
    """One row of exact medians of training legs."""
    x = rot.where(F.col("leg_date") < F.lit(cutoff).cast("date"))
    return x.agg(*(F.expr(f"cast(percentile_disc(0.5) WITHIN GROUP (ORDER BY {c}) AS bigint)").alias(f"typical_{c}") for c in TYPICAL))


def assemble(requests: DataFrame, hist: DataFrame, profile: DataFrame, density: DataFrame, typical: DataFrame, holidays: DataFrame) -> DataFrame:
    """Features of a table of future legs from small lookup tables; each value's source is named."""
    x = with_calendar(requests.withColumn("route", F.concat("origin", F.lit("-"), "dest")), "leg_date", holidays).withColumn("dep_hour", F.floor(F.col("dep_min") / 60).cast("bigint"))
    x = x.crossJoin(F.broadcast(typical))
    given = F.col("position").isNotNull()
    inbound = F.col("turnaround").between(0, 840)
    x = x.withColumns(
        {
            "context": F.when(given, "provided").otherwise("typical"),
            "pos_used": F.coalesce("position", "typical_position"),
            "legs_used": F.when(given, F.greatest(F.coalesce("legs_today", "typical_legs_today"), F.col("position"))).otherwise(F.col("typical_legs_today")),
            "turn_used": F.when(given, F.when(inbound, F.col("turnaround"))).otherwise(F.col("typical_turnaround")),
            "inbound_used": F.when(given, F.coalesce(inbound, F.lit(False))).otherwise(F.lit(True)),
        }
    )
    x = x.withColumns({"band": C.turnaround_band(F.col("inbound_used"), F.col("turn_used")), "pos_key": C.position_key(F.col("pos_used"))})
    x = J.join_levels(x, hist, FEATURE_RATES, ["rate"])
    routes = profile.where("level = 'route'").select(F.col("key").alias("_route"), "min_distance")
    x = x.join(routes, x["route"] == F.col("_route"), "left").drop("_route")
    d = density.select(F.col("origin").alias("_o"), F.col("dep_hour").alias("_h"), F.col("weekday").alias("_w"), "median_density")
    x = x.join(d, (x["origin"] == F.col("_o")) & (x["dep_hour"] == F.col("_h")) & (x["weekday"] == F.col("_w")), "left").drop("_o", "_h", "_w")
    own = F.coalesce(C.positive(F.col("density")), F.lit(False))
    return x.withColumns(
        {
            "distance_used": F.coalesce(F.when(C.positive(F.col("distance")), F.col("distance")), F.col("min_distance")),
            "density_used": F.coalesce(F.when(own, F.col("density")), F.col("median_density"), F.col("typical_density")),
            "density_source": F.when(own, "supplied").when(F.col("median_density").isNotNull(), "profile").otherwise("typical"),
        }
    )


def forecast_join(requests: DataFrame, zones: DataFrame, grid: DataFrame) -> DataFrame:
    """Requests with the UTC instant of departure and the forecast of its hour at the origin, where there is one.

    ``zones`` has (airport, tz), ``grid`` (place, hour, and values), one row a place and hour.
    """
    z = zones.select(F.col("airport").alias("_airport"), "tz")
    x = requests.join(J.small(z), requests["origin"] == F.col("_airport"), "left").drop("_airport")
    x = x.withColumn("dep_utc", F.when(F.col("tz").isNotNull(), C.local_to_utc(F.col("leg_date"), F.col("dep_min"), F.coalesce("tz", F.lit("UTC")))))
    g = grid.withColumnsRenamed({"place": "_place", "hour": "_hour"})
    on = (F.col("origin") == F.col("_place")) & (F.date_trunc("hour", "dep_utc").cast("timestamp_ntz") == F.col("_hour"))
    return x.join(g, on, "left").withColumn("has_weather", F.col("_hour").isNotNull()).drop("_place", "_hour")


def basis(requests: DataFrame, zones: DataFrame, grid: DataFrame, as_of: str) -> DataFrame:
    """What a score of each request rests on, at a UTC instant that the caller gives."""
    x = forecast_join(requests, zones, grid)
    past = F.coalesce(F.col("dep_utc") <= F.lit(as_of).cast("timestamp_ntz"), F.lit(False))
    horizon = F.when(F.col("dep_utc").isNull(), "unavailable").when(past, "past").when(F.col("has_weather"), "forecast").otherwise("beyond_horizon")
    return x.select(
        "request_id",
        past.alias("flight_in_past"),
        horizon.alias("weather_horizon"),
        F.when(F.col("position").isNotNull(), "provided").otherwise("typical_estimate").alias("rotation_context"),
        F.when(C.positive(F.col("density")), "provided").otherwise("estimated").alias("origin_density_source"),
    )


def time_slice_view(mart: DataFrame) -> DataFrame:
    """The slice mart with labels and rates; a thin projection."""
    return mart.withColumns({"season": C.season(F.col("month_no")), "on_time_rate": F.round(1 - F.try_divide(F.col("n_arr_del15"), F.col("n_with_arr_outcome")), 6), **rates()})


