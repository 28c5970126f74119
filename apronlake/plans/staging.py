"""Raw rows to typed tables: flights, daily weather, stations, forecasts; and display texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apronlake.functions import cleaning as C
from apronlake.operators.windows import dedup, prefer

#: Kind of each raw flight column (year and month are partitions as well): d date, i whole number, f number, s text, u upper-case text, b flag, t hhmm.
FLIGHT_COLUMNS = {
    "Year": "i", "Quarter": "i", "Month": "i", "DayofMonth": "i", "DayOfWeek": "i", "FlightDate": "d",
    "Reporting_Airline": "u", "DOT_ID_Reporting_Airline": "i", "IATA_CODE_Reporting_Airline": "s", "Tail_Number": "s", "Flight_Number_Reporting_Airline": "i",
    "OriginAirportID": "i", "OriginAirportSeqID": "i", "OriginCityMarketID": "i", "Origin": "u", "OriginCityName": "s", "OriginState": "s", "OriginStateFips": "s", "OriginStateName": "s", "OriginWac": "i",
    "DestAirportID": "i", "DestAirportSeqID": "i", "DestCityMarketID": "i", "Dest": "u", "DestCityName": "s", "DestState": "s", "DestStateFips": "s", "DestStateName": "s", "DestWac": "i",
    "CRSDepTime": "t", "DepTime": "t", "DepDelay": "f", "DepDelayMinutes": "f", "DepDel15": "b", "DepartureDelayGroups": "i", "DepTimeBlk": "s", "TaxiOut": "f", "WheelsOff": "t", "WheelsOn": "t", "TaxiIn": "f",
    "CRSArrTime": "t", "ArrTime": "t", "ArrDelay": "f", "ArrDelayMinutes": "f", "ArrDel15": "b", "ArrivalDelayGroups": "i", "ArrTimeBlk": "s",
    "Cancelled": "b", "CancellationCode": "s", "Diverted": "b", "CRSElapsedTime": "f", "ActualElapsedTime": "f", "AirTime": "f", "Flights": "i", "Distance": "f", "DistanceGroup": "i",
    "CarrierDelay": "f", "WeatherDelay": "f", "NASDelay": "f", "SecurityDelay": "f", "LateAircraftDelay": "f", "FirstDepTime": "t", "TotalAddGTime": "f", "LongestAddGTime": "f",
    "DivAirportLandings": "i", "DivReachedDest": "b", "DivActualElapsedTime": "f", "DivArrDelay": "f", "DivDistance": "f",
}
#: The same kinds for each of five diversion blocks.
DIVERSION = {"Airport": "s", "AirportID": "i", "AirportSeqID": "i", "WheelsOn": "t", "TotalGTime": "f", "LongestGTime": "f", "WheelsOff": "t", "TailNum": "s"}

KINDS = {
    "d": C.safe_date,
    "i": C.safe_int,
    "f": C.safe_double,
    "s": C.clean_str,
    "u": lambda c: C.clean_str(c, upper=True),
    "b": C.flag01,
    "t": C.hhmm_to_min,
}
NATURAL_KEY = ["FlightDate", "Reporting_Airline", "Flight_Number_Reporting_Airline", "Origin", "Dest", "CRSDepTime"]


def type_flights(raw: DataFrame) -> DataFrame:
    """Typed flights, one row for a natural key: rows that arrived first, the earliest, then by tail, departure and content."""
    spec = dict(FLIGHT_COLUMNS)
    for n in range(1, 6):
        spec |= {f"Div{n}{k}": v for k, v in DIVERSION.items()}
    cells = [KINDS[kind](F.col(c)).alias(c) for c, kind in spec.items() if c in raw.columns]
    typed = raw.select(*cells, C.row_hash(*raw.columns).alias("row_hash"))
    wanted = {"ArrTime": [F.col("ArrTime").isNull(), F.col("ArrTime")], "Tail_Number": [F.col("Tail_Number")], "DepTime": [F.col("DepTime").isNull()]}
    order = [c for name, of in wanted.items() if name in raw.columns for c in of]
    return dedup(typed, [k for k in NATURAL_KEY if k in raw.columns], [*order, F.col("row_hash")])


def daily_weather(raw: DataFrame) -> DataFrame:
    """Daily summaries: sentinels to NULL, pressure restored, '0'/'1' flags, a station key."""
    num = lambda c, *bad: C.null_sentinel(C.safe_double(F.col(c)), *bad).alias(c)
    return raw.select(
        C.concat_key(F.col("stn"), F.col("wban")).alias("station_key"),
        C.make_date_safe(F.col("year"), F.col("mo"), F.col("da")).alias("day"),
        num("temp", 9999.9),
        num("dewp", 9999.9),
        C.decode_pressure(C.safe_double(F.col("slp"))).alias("slp"),
        num("visib", 999.9),
        num("wdsp", 999.9),
        num("gust", 999.9),
        num("prcp", 99.99),
        num("sndp", 999.9),
        *((F.col(c) == "1").alias(c) for c in ("fog", "rain", "snow", "thunder") if c in raw.columns),
    )


def stations(raw: DataFrame) -> DataFrame:
    """Stations with coordinates, one row for a key: the one in use longest."""
    typed = raw.select(
        C.concat_key(F.col("usaf"), F.col("wban")).alias("station_key"),
        C.clean_str(F.col("name")).alias("name"),
        C.safe_double(F.col("lat")).alias("lat"),
        C.safe_double(F.col("lon")).alias("lon"),
        C.safe_double(F.col("elev")).alias("elev"),
        C.safe_date(F.col("begin"), "yyyyMMdd").alias("first_day"),
        C.safe_date(F.col("end"), "yyyyMMdd").alias("last_day"),
    )
    good = typed.where("lat IS NOT NULL AND lon IS NOT NULL AND NOT (lat = 0 AND lon = 0)")
    return dedup(good, ["station_key"], [F.col("last_day").desc_nulls_last(), F.col("first_day").asc_nulls_last(), F.col("name").asc_nulls_last()])


def drop_summaries(obs: DataFrame, kind: str, ts: str) -> DataFrame:
    """Drop daily and monthly summary rows and unreadable times; a missing kind stays."""
    return obs.where(F.coalesce(~F.col(kind).isin("SOD", "SOM"), F.lit(True)) & F.try_to_timestamp(F.col(ts)).isNotNull())


#: Report kinds in order of preference, and knots in a metre a second.
REPORTS = ["FM-15", "FM-16", "FM-12"]
KNOTS = 1.9438445


def hourly(raw: DataFrame, depths: list[str], manual: list[str], automatic: list[str]) -> DataFrame:
    """Typed hourly observations of packed reports: one for a station and time.

    ``raw`` has station, at (ISO text), kind, report (a unique id) and the packed fields tmp,
    dew, wnd, vis, oc1 (gust; NULL is not reported) and those named. Of several reports the
    preferred kind counts, then kind, then the smallest report. Codes of bad quality drop out.
    """
    at = F.try_to_timestamp(F.col("at"), F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz")
    kind = F.trim("kind")
    read = raw.withColumns({"obs_ts": at, "kind": kind}).where("obs_ts IS NOT NULL AND (kind IS NULL OR kind NOT IN ('SOD', 'SOM'))")
    kept = dedup(read, ["station", "obs_ts"], [prefer(F.col("kind"), REPORTS), F.col("kind"), F.col("report")])
    knots = lambda x: x / 10 * KNOTS
    of = lambda field, value, qc, gone, scale: C.decode_packed(F.col(field), value, qc, gone, scale)
    sound = lambda c: ~F.coalesce(F.get(F.split(c, ","), F.lit(1)).isin(*C.BAD_QC), F.lit(False))
    codes = lambda fields: F.transform(F.filter(F.array(*fields), lambda c: c.isNotNull() & sound(c)), lambda c: F.get(F.split(c, ","), F.lit(0)).try_cast("int"))
    return kept.select(
        "station",
        "obs_ts",
        "report",
        of("tmp", 0, 1, "9999", C.celsius_to_f).alias("temp_f"),
        of("dew", 0, 1, "9999", C.celsius_to_f).alias("dewpoint_f"),
        of("wnd", 3, 4, "9999", knots).alias("wind_kn"),
        of("vis", 0, 1, "999999", lambda x: x / 1609.344).alias("visibility_mi"),
        of("oc1", 0, 1, "9999", knots).alias("gust_kn"),
        of("oc1", 0, 1, "9999", knots).isNotNull().alias("gust_reported"),
        C.precip_1h(C.parse_groups(*map(F.col, depths))).alias("precip_in"),
        *(c.alias(f"is_{n}") for n, c in C.weather_flags(codes(manual), codes(automatic)).items()),
    )


def iso_minutes(c: Column) -> Column:
    """Minutes of an ISO-8601 duration of days, hours and minutes."""
    part = lambda u: F.coalesce(F.nullif(F.regexp_extract(c, rf"(\d+){u}", 1), F.lit("")).cast("int"), F.lit(0))
    return part("D") * 1440 + part("H") * 60 + part("M")


def forecast_features(df: DataFrame) -> DataFrame:
    """Forecast layers (value, unit) in the units of the feature mart.

    A layer of another unit is missing; without a temperature the whole forecast is. Gust
    absent is 0 with indicator 0, visibility absent 10 miles, rain amount absent 0.
    """
    of = lambda v, u, unit: F.when(F.col(u) == unit, F.col(v))
    temp = of("temp", "temp_unit", "degC") * 9 / 5 + 32
    have = temp.isNotNull()
    wind = of("wind", "wind_unit", "km_h-1") / 1.852
    gust = of("gust", "gust_unit", "km_h-1") / 1.852
    mile = F.least(of("visibility", "visibility_unit", "m") / 1609.344, F.lit(10.0))
    hours = F.greatest(F.col("rain_minutes") / 60, F.lit(1.0))
    inch = of("rain", "rain_unit", "mm") / hours / 25.4
    six = lambda c: F.round(F.when(have, c), 6)
    return df.withColumns(
        {
            "temp_f": six(temp),
            "wind_kn": six(wind),
            "gust_kn": six(F.coalesce(gust, F.lit(0.0))),
            "gust_reported": F.when(have, gust.isNotNull().cast("int")),
            "visibility_mi": six(F.when(of("visibility", "visibility_unit", "m").isNull(), F.lit(10.0)).otherwise(mile)),
            "precip_in": six(F.coalesce(inch, F.lit(0.0))),
        }
    )


#: Forecast phenomena behind each flag; freezing liquid counts as rain.
PHENOMENA = {
    "is_fog": ("fog", "freezing_fog", "ice_fog"),
    "is_rain": ("rain", "rain_showers", "drizzle", "freezing_rain", "freezing_drizzle"),
    "is_snow": ("snow", "snow_showers", "blowing_snow", "sleet", "ice_pellets"),
    "is_thunder": ("thunderstorms",),
}


def phenomena_flags(codes: Column) -> dict[str, Column]:
    found = lambda names: F.exists(codes, lambda c: F.coalesce(c.isin(*names), F.lit(False)))
    return {n: found(names) for n, names in PHENOMENA.items()}


def airport_label(name: Column, city: Column, code: Column) -> Column:
    """Name, else city, else code, with the code in brackets where it is not alone."""
    shown = F.coalesce(C.clean_str(name), C.clean_str(city))
    return F.when(shown.isNotNull(), F.concat(shown, F.lit(" ("), code, F.lit(")"))).otherwise(code)


def carrier_label(name: Column, code: Column, regional: Column) -> Column:
    base = F.coalesce(C.clean_str(name), code)
    return F.when(F.coalesce(regional, F.lit(False)), F.concat(base, F.lit(" (regional)"))).otherwise(base)


def phrase(p: Column, base: Column) -> Column:
    """A probability in words."""
    k = C.natural_frequency(p)
    return F.when(p.isNotNull(), F.concat(F.lit("about "), k.cast("string"), F.lit(" in 10 flights like this one are late, "), C.vs_base_rate(p, base)))


def basis_notes(past: Column, horizon: Column, context: Column, density: Column) -> Column:
    """What a score rests on, as notes joined by '; ', the gravest first."""
    notes = F.array(
        F.when(past, F.lit("the departure is in the past"))
        .when(horizon == "beyond_horizon", F.lit("no forecast reaches this departure"))
        .when(horizon == "unavailable", F.lit("the local time of the airport is unknown, so no weather was used")),
        F.when(context == "typical_estimate", F.lit("a typical rotation is assumed")),
        F.when(density == "estimated", F.lit("departure traffic is estimated from history")),
    )
    return F.array_join(F.array_compact(notes), "; ")


def canonical_sort(df: DataFrame, grain: list[str]) -> DataFrame:
    """A total order on the unique grain, for writing; no aggregate relies on it."""
    return df.orderBy(*(F.col(c).asc_nulls_first() for c in grain))
