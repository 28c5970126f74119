"""The given tables in the shapes that the operators work on (legs, observations, dimensions)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rates and estimates use legs before these dates only.
CUTOFF = "2024-01-24"
BIG_CUTOFF = "2000-01-01"
ZONES = ("America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _delay(df: DataFrame, delay) -> DataFrame:
    flown = ~F.col("cancelled") & ~F.col("diverted")
    df = df.withColumn("arr_delay_min", F.when(flown, F.greatest(F.lit(0), delay)).cast("bigint"))
    return df.withColumn("arr_del15", F.col("arr_delay_min") >= 15)


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One leg for each event."""
    e = read(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    i = F.col("event_id")
    df = e.select(
        i.alias("leg_id"),
        F.col("ts").cast("date").alias("leg_date"),
        (F.hour("ts") * 60 + F.minute("ts")).cast("bigint").alias("dep_min"),
        F.date_trunc("minute", F.col("ts")).cast("timestamp_ntz").alias("dep_ts"),
        F.col("event_type").alias("carrier"),
        F.when(i % 997 != 0, i % 1000).alias("flight_number"),
        F.concat(F.lit("S"), i % 3).alias("origin"),
        F.concat(F.lit("S"), (i * 5 + F.col("user_id")) % 3).alias("dest"),
        F.when(i % 101 != 0, F.col("user_id")).alias("tail"),
        (100 + (i * 37) % 2400).alias("distance"),
        (20 + (i * 13) % 400).alias("elapsed_min"),
        (i % 50 == 0).alias("cancelled"),
        (i % 333 == 0).alias("diverted"),
        "k",
        (((i * 7919 + F.col("k") * 31) % 1000 + 0.5) / 1000).alias("score"),
    )
    df = df.withColumn("route", F.concat("origin", F.lit("-"), "dest")).withColumn("dep_hour", F.floor(F.col("dep_min") / 60).cast("bigint"))
    return _delay(df, F.col("k") - 60)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One packed observation for each view or click event."""
    e = read(spark, sf_dir, "events").where("event_type IN ('view', 'click')").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    tenth = F.lpad(F.floor(F.col("value") * 10).cast("string"), 4, "0")
    return e.select(
        F.concat(F.lit("S"), F.col("user_id") % 3).alias("station"),
        F.col("ts").cast("timestamp_ntz").alias("obs_ts"),
        F.col("event_id").alias("obs_id"),
        F.concat(F.when(F.col("k") % 25 == 0, F.lit("+9999")).otherwise(F.concat(F.lit("+"), tenth)), F.lit(","), F.col("k") % 10).alias("tmp"),
        F.when(F.col("k") % 4 == 0, F.concat(F.lpad(F.col("k") % 3, 2, "0"), F.lit(","), tenth, F.lit(",9,"), F.col("k") % 10)).alias("aa1"),
        (F.col("k") % 100).alias("mw1"),
        ((F.col("k") * 7) % 100).alias("aw1"),
    )


#: Where lines and orders are too many to broadcast, so many lines go to a task, however many there are.
LINES_A_TASK = 100_000


def legs_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One leg for each line item, with its supplier's and customer's nations.

    Lines move once, with keys only: orders have met their customers before, and names come last.
    """
    li, o, s, c = (read(spark, sf_dir, t) for t in ("lineitem", "orders", "supplier", "customer"))
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    tasks = li.count() // LINES_A_TASK  # from the files' footers
    o = o.join(c.select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey", "c_mktsegment")
    li = li.join(s.select("s_suppkey", "s_nationkey"), li.l_suppkey == F.col("s_suppkey"))
    if tasks >= 100:
        li, o = li.repartition(tasks, "l_orderkey"), o.repartition(tasks, "o_orderkey")
    df = (
        li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("origin")), "s_nationkey")
        .join(n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("dest")), "c_nationkey")
    )
    number = F.col("l_linenumber").cast("bigint")
    df = df.select(
        F.col("l_orderkey").alias("order_key"),
        number.alias("line"),
        F.col("l_shipdate").cast("date").alias("leg_date"),
        F.col("c_mktsegment").alias("carrier"),
        "origin",
        "dest",
        F.concat("origin", F.lit("-"), "dest").alias("route"),
        F.col("l_suppkey").alias("tail"),
        ((F.col("l_orderkey") * 37 + number * 61) % 1440).alias("dep_min"),
        (F.col("l_orderkey") % 97 == 0).alias("cancelled"),
        F.lit(False).alias("diverted"),
        ((F.col("l_partkey") * 13 + number * 29) % 120 - 40).alias("raw_delay"),
    )
    df = df.withColumn("dep_hour", F.floor(F.col("dep_min") / 60).cast("bigint"))
    return _delay(df, F.col("raw_delay")).drop("raw_delay")


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place for each nation."""
    n = F.col("n_nationkey")
    zone = F.element_at(F.array(*map(F.lit, ZONES)), (n % 4 + 1).cast("int"))
    return read(spark, sf_dir, "nation").select(
        F.col("n_name").alias("airport"), (-60 + (n * 17) % 120).cast("double").alias("lat"), (-180 + (n * 41) % 360).cast("double").alias("lon"), zone.alias("tz"), n.cast("bigint").alias("nation_key")
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A station for each supplier."""
    s = F.col("s_suppkey")
    return read(spark, sf_dir, "supplier").select(s.alias("station"), (-60 + (s * 29) % 120).cast("double").alias("lat"), (-180 + (s * 73) % 360).cast("double").alias("lon"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leg, 28 days later, as a scoring request; some are incoherent."""
    i = F.col("leg_id")
    turn = (i * 11) % 900
    return legs(spark, sf_dir).select(
        i.alias("request_id"),
        F.date_add("leg_date", 28).alias("leg_date"),
        "dep_min",
        "carrier",
        "origin",
        "dest",
        F.when(i % 3 == 0, F.col("distance") * 10).alias("distance"),
        F.when(i % 2 == 0, i % 9).alias("position"),
        F.when((i % 2 == 0) & (i % 7 != 0), i % 9 + 1).when(i % 7 == 0, F.lit(2)).alias("legs_today"),
        F.when((i % 2 == 0) & (i % 9 > 1), turn).alias("turnaround"),
        F.when((i % 2 == 0) & (i % 9 > 1) & (i % 7 != 0), F.col("distance")).alias("inbound_distance"),
        F.when((i % 2 == 0) & (i % 9 > 1), F.col("elapsed_min")).alias("inbound_elapsed"),
        F.when(i % 3 == 0, i % 50 - 5).alias("density"),
    )


def request_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone of each origin of legs; that of S2 is unknown."""
    place = legs(spark, sf_dir).select(F.col("origin").alias("airport")).distinct()
    return place.select("airport", F.when(F.col("airport") == "S0", ZONES[0]).when(F.col("airport") == "S1", ZONES[1]).alias("tz"))


def forecast_hours(decoded: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Hours with a forecast temperature: observations 28 days later, up to ``days`` after ``as_of``."""
    at = F.col("obs_ts") + F.expr("INTERVAL 28 DAYS")
    x = decoded.where(F.col("temp_f").isNotNull() & (at < F.lit(as_of).cast("timestamp_ntz") + F.expr(f"INTERVAL {days} DAYS")))
    return x.select(F.col("station").alias("place"), F.date_trunc("hour", at).cast("timestamp_ntz").alias("hour"), "temp_f").groupBy("place", "hour").agg(F.avg("temp_f").alias("forecast_temp_f"))
