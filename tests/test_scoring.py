"""Operators of batch scoring, maps and held-out rows on small rows, with checks that can fail."""

import math

import pytest
from pyspark.sql import functions as F

from apronlake.functions import cleaning as C
from apronlake.operators import joins as J
from apronlake.operators import model as Mo
from apronlake.operators import quality as Q
from apronlake.operators import windows as Wn
from apronlake.plans import marts as M
from apronlake.plans import staging as Sg


def test_bands_of_the_base_rate(spark):
    rows = [(0.59, "well below usual"), (0.6, "below usual"), (0.84, "below usual"), (0.85, "about usual"), (1.15, "about usual"), (1.16, "above usual"), (1.6, "above usual"), (2.5, "well above usual"), (2.51, "far above usual")]
    df = spark.createDataFrame(rows, "r double, want string")
    assert all(r.got == r.want for r in df.withColumn("got", C.vs_base_rate(F.col("r"), F.lit(1.0))).collect())


def test_basis_and_notes(spark):
    day = "date '2024-02-05'"
    req = spark.sql(f"SELECT * FROM VALUES (1L, {day}, 300L, 'A', 2L, 5L), (2L, {day}, 900L, 'A', NULL, NULL), (3L, {day}, 960L, 'A', 1L, 0L), (4L, {day}, 900L, 'B', NULL, 3L), (5L, {day}, 900L, 'C', NULL, 3L), (6L, {day}, 420L, 'A', NULL, 1L) t(request_id, leg_date, dep_min, origin, position, density)")
    zones = spark.createDataFrame([("A", "America/New_York"), ("B", None)], "airport string, tz string")
    grid = spark.sql("SELECT 'A' AS place, timestamp_ntz '2024-02-05 20:00:00' AS hour, 40.0 AS temp")
    got = {r.request_id: tuple(r)[1:] for r in M.basis(req, zones, grid, "2024-02-05T12:00:00").collect()}
    assert got == {
        1: (True, "past", "provided", "provided"),
        2: (False, "forecast", "typical_estimate", "estimated"),
        3: (False, "beyond_horizon", "provided", "estimated"),
        4: (False, "unavailable", "typical_estimate", "provided"),
        5: (False, "unavailable", "typical_estimate", "provided"),
        6: (True, "past", "typical_estimate", "provided"),  # departs at the very instant
    }
    notes = M.basis(req, zones, grid, "2024-02-05T12:00:00").select("request_id", Sg.basis_notes(*(F.col(c) for c in ("flight_in_past", "weather_horizon", "rotation_context", "origin_density_source"))).alias("n"))
    notes = {r.request_id: r.n for r in notes.collect()}
    assert notes[1] == "the departure is in the past" and notes[2] == "a typical rotation is assumed; departure traffic is estimated from history" and notes[4].startswith("the local time")


def test_schema_gate(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "b long, a string, c double")
    assert Q.gate_schema(df, {"a": "string", "b": "bigint"}).columns == ["a", "b"]
    for wrong in ({"a": "bigint"}, {"z": "string"}):
        with pytest.raises(ValueError):
            Q.gate_schema(df, wrong)


def test_linear_scores(spark):
    r = Mo.score_linear(spark.createDataFrame([(1.0, None, 0.2)], "x double, y double, base double"), {"x": 2.0, "y": 9.0}, -1.0, (0.5, 0.25), "base").first()
    assert r.raw_score == pytest.approx(1 / (1 + math.exp(-1))) and r.score == pytest.approx(1 / (1 + math.exp(-0.75))) and r.lift == pytest.approx(r.score - 0.2)


def test_masks_maps_and_latest(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "z", 2), (3, None, 2), (4, "a", 1)], "i long, c string, t long")
    seen = spark.createDataFrame([("a",), ("a",), (None,)], "v string")
    assert {(r.i, r.c, r.c_unseen) for r in J.mask_unseen(df, {"c": seen}).collect()} == {(1, "a", False), (2, None, True), (3, None, False), (4, "a", False)}
    assert sorted(r.i for r in Wn.latest_per(df, ["c"], "t").collect()) == [1, 2, 3, 4]
    assert {(r.c, r.i) for r in Wn.one_per_group(df, ["c"], ["t"]).collect()} == {("a", 1), ("z", 2), (None, 3)}
    places = spark.createDataFrame([("a", 1.0, 2.0), ("z", None, 2.0)], "p string, lat double, lon double")
    assert sorted(r.i for r in J.with_coordinates(df, places, "c", "p").collect()) == [1, 4]
    days = spark.createDataFrame([(7, 10), (8, 3)], "s long, days long")
    near = spark.createDataFrame([(7, 50.0, 50.0), (8, 0.0, 0.0), (9, 1.0, 1.0)], "s long, lat double, lon double")
    home = spark.createDataFrame([("h", 0.0, 0.0)], "a string, lat double, lon double")
    assert J.nearest_covered(home, near, days, "a", "s", 5).first().s == 7


def test_held_out_rows_are_named(spark):
    df = spark.sql("SELECT * FROM VALUES (1, date '2024-01-01'), (2, date '2024-02-01'), (3, NULL) t(i, d)")
    assert sorted(r.i for r in Q.q_held_out(df, "d", "2024-01-24").collect()) == [1, 3]


def test_overwritten_rates(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 0.7)], "k string, h_rate double")
    hist = spark.createDataFrame([("g", "a", 0.1), ("other", "b", 0.9)], "level string, key string, rate double")
    assert {(r.k, r.h_rate) for r in J.apply_hist(df, hist, {"h": ("g", "k")}, ["rate"]).collect()} == {("a", 0.1), ("b", None)}
