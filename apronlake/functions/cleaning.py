"""Column expressions that clean and decode; all native, none raises on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_str(c: Column, upper: bool = False) -> Column:
    """Trimmed text, blank as NULL."""
    x = F.nullif(F.trim(c), F.lit(""))
    return F.upper(x) if upper else x


def safe_double(c: Column) -> Column:
    return c.try_cast("double")


def safe_int(c: Column) -> Column:
    """Whole number, half away from zero; NULL if the text is no number."""
    return F.round(c.try_cast("double")).try_cast("bigint")


def safe_date(c: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(c, fmt)


def flag01(c: Column) -> Column:
    """'1' or '1.00' as true, other numbers as false, the rest NULL."""
    return c.try_cast("double") == 1


def hhmm_to_min(c: Column) -> Column:
    """Minutes of the day of an hhmm text; '2400' is 0, an invalid text NULL."""
    x = F.lpad(F.trim(c), 4, "0")
    x = F.when(x == "2400", F.lit("0000")).otherwise(x)
    hour, minute = F.substring(x, 1, 2).try_cast("int"), F.substring(x, 3, 2).try_cast("int")
    ok = (F.trim(c) != "") & x.rlike("^[0-9]{4}$") & hour.between(0, 23) & minute.between(0, 59)
    return F.when(ok, hour * 60 + minute)


def null_sentinel(c: Column, *values) -> Column:
    return F.when(~c.isin(*values), c)


def decode_pressure(c: Column) -> Column:
    """Sea-level pressure whose leading 10 was cut: below 100 means 1000 more."""
    x = F.when(~c.isin(999.9, 9999.9), c)
    return F.when(x < 100, x + 1000).otherwise(x)


def make_date_safe(y: Column, m: Column, d: Column) -> Column:
    return safe_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")))


def concat_key(*parts: Column, sep: str = "-") -> Column:
    """Parts joined by ``sep``; NULL if one is."""
    out = parts[0].cast("string")
    for p in parts[1:]:
        out = F.concat(out, F.lit(sep), p.cast("string"))
    return out


def hour_of(minutes: Column) -> Column:
    return F.floor(minutes / 60).cast("bigint")


def local_to_utc(date: Column, minutes: Column, zone: Column) -> Column:
    """UTC instant of a local wall clock; a time in a gap moves forward."""
    stamp = F.timestamp_add("MINUTE", minutes.cast("int"), date.cast("timestamp_ntz"))
    return F.convert_timezone(zone, F.lit("UTC"), stamp)


def plus_minutes(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", F.round(minutes).cast("int"), ts)


def cap(c: Column, high: float) -> Column:
    """The smaller of both; NULL stays NULL (least() would skip it)."""
    return F.when(c.isNotNull(), F.least(c, F.lit(high)))


def positive(c: Column) -> Column:
    """Whether a number is above 0 and finite; NULL if missing (NaN is above every number in Spark)."""
    x = c.cast("double")
    return (x > 0) & (x < float("inf"))


def absent_as_zero(c: Column, present: Column) -> Column:
    return F.when(present, F.coalesce(c, F.lit(0.0)))


SEASONS = ("Winter", "Spring", "Summer", "Autumn")


def season_order(month: Column) -> Column:
    return (F.floor(F.pmod(month, F.lit(12)) / 3) + 1).cast("int")


def season(month: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, SEASONS)), season_order(month))


def turnaround_band(has_inbound: Column, minutes: Column) -> Column:
    """Five labels of the scheduled turnaround; NULL if whether there is an inbound is unknown."""
    of = F.when(minutes < 35, "lt_35").when(minutes < 60, "35_60").when(minutes < 120, "60_120").otherwise("ge_120")
    return F.when(has_inbound.isNull(), None).when(~has_inbound, "no_inbound").when(minutes.isNotNull(), of)


def position_key(position: Column, most: int = 6) -> Column:
    return F.when(position.isNotNull(), F.least(position, F.lit(most)).cast("string"))


def natural_frequency(p: Column) -> Column:
    """k in 10 of a probability, never 0 or 10 unless exact."""
    k = F.bround(p * 10).cast("int")
    return F.when(p.isNull(), None).when(p <= 0, 0).when(p >= 1, 10).otherwise(F.least(F.greatest(k, F.lit(1)), F.lit(9)))


def vs_base_rate(p: Column, base: Column) -> Column:
    """Six bands of the ratio to a base rate; the three upper edges belong to the lower band."""
    r = F.try_divide(p, base)
    return (
        F.when(r < 0.6, "well below usual").when(r < 0.85, "below usual").when(r <= 1.15, "about usual").when(r <= 1.6, "above usual").when(r <= 2.5, "well above usual").when(r.isNotNull(), "far above usual")
    )


def layover_min(arrival: Column, departure: Column) -> Column:
    """Minutes between, over midnight if need be."""
    return F.pmod(departure - arrival, F.lit(1440))


def earliest_connection(arrival: Column, connection: int = 30) -> Column:
    return F.least(arrival + connection, F.lit(1439))


#: Quality codes that void an observation.
BAD_QC = ("2", "3", "6", "7")


def decode_packed(c: Column, value_at: int, qc_at: int, sentinel: str, scale) -> Column:
    """A value of a packed 'value,qc' field in its unit.

    NULL for the sentinel (any sign) and for a bad quality code; a missing code keeps the value.
    """
    parts = F.split(c, ",")
    raw, qc = F.get(parts, F.lit(value_at)), F.get(parts, F.lit(qc_at))
    missing = F.regexp_replace(raw, "^[+-]", "") == sentinel
    return F.when(missing | F.coalesce(qc.isin(*BAD_QC), F.lit(False)), None).otherwise(scale(raw.try_cast("double")))


def celsius_to_f(x: Column) -> Column:
    return x / 10 * 9 / 5 + 32


def parse_groups(*fields: Column) -> Column:
    """Repeated 'period,depth,condition,qc' groups as an array of structs; NULL fields drop out."""
    of = F.filter(F.array(*fields), lambda x: x.isNotNull() & (x != ""))
    get = lambda x, i: F.get(F.split(x, ","), F.lit(i))
    return F.transform(of, lambda x: F.struct(get(x, 0).alias("period"), get(x, 1).alias("depth"), get(x, 3).alias("qc")))


def precip_1h(groups: Column) -> Column:
    """Inches in one hour: none reported is 0, else the least usable one-hour depth, else NULL."""
    usable = F.filter(groups, lambda g: (g["period"] == "01") & (g["depth"] != "9999") & ~F.coalesce(g["qc"].isin(*BAD_QC), F.lit(False)))
    depths = F.transform(usable, lambda g: g["depth"].try_cast("double") / 254.0)
    return F.when(F.size(groups) == 0, F.lit(0.0)).when(F.size(usable) > 0, F.array_min(depths))


#: Present-weather code ranges (manual codes, automatic codes).
WEATHER = {
    "fog": (((10, 12), (40, 49)), ((10, 10), (30, 35))),
    "rain": (((50, 69), (80, 84)), ((40, 44), (47, 48), (50, 58), (60, 68), (80, 84))),
    "snow": (((68, 79), (83, 88)), ((45, 46), (67, 68), (70, 78), (85, 87))),
    "thunder": (((17, 17), (95, 99)), ((90, 96),)),
}


def _in_ranges(code: Column, ranges) -> Column:
    found = F.lit(False)
    for lo, hi in ranges:
        found = found | code.between(lo, hi)
    return F.coalesce(found, F.lit(False))


def weather_flags(manual: Column, automatic: Column) -> dict[str, Column]:
    """Name of each phenomenon: whether one of its codes is in one of two arrays of integers."""
    any_in = lambda codes, ranges: F.exists(codes, lambda c: _in_ranges(c, ranges))
    return {n: any_in(manual, m) | any_in(automatic, a) for n, (m, a) in WEATHER.items()}


def row_hash(*cols: str) -> Column:
    """Fingerprint of a row that tells NULL from absent and from shifted values."""
    return F.xxhash64(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}))
