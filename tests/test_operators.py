"""Hand vectors, corrupted frames and brute force for the operators."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apronlake.functions import cleaning as C
from apronlake.operators import evaluation as E
from apronlake.operators import joins as J
from apronlake.operators import quality as Q
from apronlake.operators import rates as R
from apronlake.operators import sampling as S
from apronlake.operators import windows as Wn
from apronlake.plans import fixtures as X
from apronlake.plans import marts as M
from apronlake.plans import staging as Sg


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*(cols or df.columns)).collect())


@pytest.mark.parametrize("raw,want", [("5", 5), ("2400", 0), ("0930", 570), ("", None), ("9999", None), ("12a0", None), (None, None)])
def test_hhmm(spark, raw, want):
    assert one(spark, raw, C.hhmm_to_min) == want


@pytest.mark.parametrize("raw,want", [("-0194,5", -2.92), ("+9999,9", None), ("-0194,2", None), ("+0100", 50.0)])
def test_packed(spark, raw, want):
    got = one(spark, raw, lambda c: C.decode_packed(c, 0, 1, "9999", C.celsius_to_f))
    assert got == (pytest.approx(want) if want is not None else None)


@pytest.mark.parametrize("raw,want", [(None, 0.0), ("06,0100,9,5", None), ("01,0254,9,5", 1.0), ("01,0254,9,2", None)])
def test_precip(spark, raw, want):
    assert one(spark, raw, lambda c: C.precip_1h(C.parse_groups(c))) == want


@pytest.mark.parametrize("raw,want", [(999.9, None), (13.5, 1013.5), (845.2, 845.2)])
def test_pressure(spark, raw, want):
    assert one(spark, raw, C.decode_pressure, "double") == want


@pytest.mark.parametrize("minutes,inbound,want", [(34, True, "lt_35"), (35, True, "35_60"), (59, True, "35_60"), (60, True, "60_120"), (119, True, "60_120"), (120, True, "ge_120"), (None, False, "no_inbound"), (None, None, None)])
def test_bands(spark, minutes, inbound, want):
    df = spark.createDataFrame([(inbound, minutes)], "i boolean, m int")
    assert df.select(C.turnaround_band(F.col("i"), F.col("m")).alias("b")).first().b == want


def test_scalars(spark):
    assert one(spark, "7.6", C.safe_int) == 8 and one(spark, "x", C.safe_int) is None
    assert one(spark, None, lambda c: C.cap(c, 10.0), "double") is None and one(spark, 12.0, lambda c: C.cap(c, 10.0), "double") == 10.0
    assert one(spark, 1420, lambda c: C.layover_min(c, F.lit(25)), "int") == 45
    assert [one(spark, p, C.natural_frequency, "double") for p in (0.0, 0.01, 0.25, 0.99, 1.0, None)] == [0, 1, 2, 9, 10, None]
    assert str(one(spark, dt.date(2024, 3, 10), lambda c: C.local_to_utc(c, F.lit(150), F.lit("America/Chicago")), "date")) == "2024-03-10 08:30:00"
    assert one(spark, "P1DT6H30M", Sg.iso_minutes) == 1830
    a = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string").select(C.row_hash("a", "b").alias("h"))
    assert a.distinct().count() == 2


def test_holiday_rules(spark):
    cal = {str(r.date_day): r for r in M.holiday_calendar(spark, 2021, 2024).collect()}
    assert cal["2024-12-24"].is_day_before and cal["2024-12-26"].is_day_after and "2024-03-12" not in cal
    assert cal["2021-07-05"].is_holiday  # a Sunday holiday moves
    assert cal["2021-12-31"].holiday_name == "New Year's Day"  # and a Saturday one, over the year's end
    assert cal["2024-11-28"].holiday_name == "Thanksgiving" and cal["2024-05-27"].holiday_name == "Memorial Day"


def test_mix_adjusted(spark):
    mart = spark.createDataFrame([("AA", "A-B", 30, 100), ("UA", "A-B", 10, 100)], "carrier string, route string, a long, d long")
    assert rows(R.mix_adjusted(mart, "carrier", "route", "a", "d"), "carrier", "mix_index") == [("AA", 1.5), ("UA", 0.5)]
    hard = [("GOOD", "EASY", 100, 1000), ("GOOD", "HARD", 400, 1000), ("ONLY", "HARD", 400, 1000), ("NONE", "EASY", 0, 0)]
    got = rows(R.mix_adjusted(spark.createDataFrame(hard, mart.schema), "carrier", "route", "a", "d"), "carrier", "rate", "mix_index")
    assert got == [("GOOD", 0.25, 1.0), ("NONE", None, None), ("ONLY", 0.4, 1.0)]


def test_smoothing_and_moments(spark):
    df = spark.createDataFrame([(1, 1.0, 0.21), (None, None, 0.21)], "n int, p double, g double").select(R.smooth(F.col("n"), F.col("p"), F.col("g")).alias("s"))
    assert [r.s for r in df.collect()] == [pytest.approx(11.5 / 51), None]
    x = spark.createDataFrame([("d", 0.8, True), ("d", 0.1, False)], "k string, score double, arr_del15 boolean")
    m = R.pb_moments(x, ["k"]).first()
    assert (m.expected, m.sd, m.z) == (pytest.approx(0.9), pytest.approx(0.5), pytest.approx(0.2))


def test_bank_stats(spark):
    data = [(7, 0.2, 1, 3, False), (18, 0.4, 2, 5, True), (18, 0.5, 1, 1, False), (7, 0.1, None, 4, None)]
    df = spark.createDataFrame(data, "dep_hour int, score double, position int, legs_today int, is_tight boolean")
    got = {r.dep_hour: r for r in R.hourly_banks(df, []).collect()}
    assert got[18].n == 2 and got[18].expected == pytest.approx(0.9) and got[18].tight_share == 0.5 and got[18].downstream == 3
    assert got[18].expected_downstream == pytest.approx(1.2) and got[7].downstream == 2


def test_asof_equals_brute_force(spark):
    r = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    at = lambda: base + dt.timedelta(minutes=r.randrange(4000))
    left = [(i, r.choice("AB") if i % 9 else None, at() if i % 11 else None) for i in range(120)]
    right = sorted({(r.choice("AB"), at()) for _ in range(60)})
    l = spark.createDataFrame(left, "id int, k string, t timestamp_ntz")
    rr = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(right)], "s string, o timestamp_ntz, v int")
    got = {x.id: x.v for x in J.asof_backward(l, rr, ("k", "s"), "t", "o", 3).collect()}
    for i, k, t in left:
        ok = [(o, v) for v, (s, o) in enumerate(right) if k and t and s == k and t - dt.timedelta(hours=3) < o <= t]
        assert got[i] == (max(ok)[1] if ok else None)


@pytest.mark.parametrize("rows", [J.BROADCAST_ROWS, 0])
def test_nearest_equals_brute_force(spark, rows):
    """By broadcast places and by cells alike; across the date line, at the poles, and where sites are far."""
    import math

    r = random.Random(6)
    places = [(f"p{i}", r.uniform(-80, 80), r.uniform(-180, 180)) for i in range(20)] + [("pole", 89.9, 10.0), ("line", 5.0, 179.9), ("same", 5.0, 179.9)]
    sites = [(i, r.uniform(-80, 80), r.uniform(-180, 180)) for i in range(60)] + [(70, 89.8, -170.0), (71, 5.1, -179.9), (99, 10.0, 10.0), (98, 10.0, 10.0)]
    place_type, site_type = "place string, lat double, lon double", "site int, lat double, lon double"
    odd = [("tie", 10.0, 10.0), ("nowhere", None, 1.0)]
    left, right = spark.createDataFrame([*places, *odd], place_type), spark.createDataFrame([*sites, (1000, None, None)], site_type)
    got = {x.place: x.site for x in J.nearest(left, right, "place", "site", rows).collect()}

    def angle(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        return math.acos(min(1, math.sin(a) * math.sin(c) + math.cos(a) * math.cos(c) * math.cos(b - d)))

    assert set(got) == {n for n, _, _ in places} | {"tie"}
    for n, la, lo in places:
        assert got[n] == min(sites, key=lambda s: angle(la, lo, s[1], s[2]))[0]
    assert got["tie"] == 98
    assert J.nearest(left, right.limit(0), "place", "site", rows).count() == 0


def test_rank_metrics_equal_brute_force(spark):
    r = random.Random(7)
    data = [(i, r.randrange(20) / 20, r.random() < 0.4) for i in range(300)]
    df = spark.createDataFrame(data, "leg_id int, score double, arr_del15 boolean")
    pos, neg = [s for _, s, y in data if y], [s for _, s, y in data if not y]
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)
    ap = sum(sum(s == t for s in pos) * sum(s >= t for s in pos) / sum(s >= t for _, s, _ in data) for t in set(pos)) / len(pos)
    for parts in ("3", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        assert E.roc_auc(df).first()[0] == pytest.approx(auc, abs=1e-6)
        assert E.average_precision(df).first()[0] == pytest.approx(ap, abs=1e-6)
        ranked = Wn.global_rank(df, [F.col("score").desc(), F.col("leg_id")], "rk")
        assert [i for _, i in sorted((x.rk, x.leg_id) for x in ranked.collect())] == [i for i, _, _ in sorted(data, key=lambda x: (-x[1], x[0]))]
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_chain_guard_fires_on_corrupted_frames(spark, sf_dir):
    legs = X.legs(spark, sf_dir).cache()
    mart = Wn.rotation(legs).cache()
    count = lambda df: {r.rule: r.n for r in Q.q_chain(df, legs).collect()}
    assert set(count(mart).values()) == {0}
    bad = {
        "turnaround_mismatch": ("turnaround", F.col("turnaround") + 1),
        "inbound_attr_mismatch": ("inbound_distance", F.col("inbound_distance") + 1),
        "position_or_day_mismatch": ("legs_today", F.col("legs_today") + 1),
        "flag_mismatch": ("is_tight", ~F.col("is_tight")),
        "band_relabeled": ("band", F.lit("odd")),
        "position_relabeled": ("pos_key", F.lit("9")),
        "class_mismatch": ("link_class", F.lit("a")),
        "unclear_link_not_nulled": ("position", F.lit(1).cast("long")),
        "inbound_attrs_without_inbound": ("inbound_distance", F.lit(5).cast("long")),
        "tail_null_not_nulled": ("position", F.lit(1).cast("long")),
        "inbound_without_attrs": ("inbound_elapsed", F.lit(None).cast("long")),
        "join_miss": ("leg_id", F.col("leg_id") + 10**9),
        "leg_not_in_mart": ("leg_id", F.col("leg_id") + 10**9),
    }
    for rule, (col, value) in bad.items():
        assert count(mart.withColumn(col, value))[rule] > 0, rule


def test_asof_guard_fires(spark):
    t = lambda h: dt.datetime(2024, 1, 2, h)
    data = [(t(5), t(4), True), (t(5), t(6), True), (t(5), t(1), True), (t(5), None, True), (t(5), t(4), False), (None, t(4), True)]
    got = {r.rule: r.n for r in Q.q_asof(spark.createDataFrame(data, "d timestamp_ntz, o timestamp_ntz, f boolean"), "d", "o", "f", 3).collect()}
    assert got == {"after_departure": 1, "outside_lookback": 1, "flag_without_obs": 1, "obs_without_flag": 1, "unverifiable": 1, "degraded": 1}
    day = dt.date(2024, 1, 2)
    data = [(t(5), t(4), True, day, 300), (t(9), t(6), True, day, 300), (None, t(4), True, day, 300)]
    own = Q.q_asof(spark.createDataFrame(data, "d timestamp_ntz, o timestamp_ntz, f boolean, day date, m long"), "d", "o", "f", 3, scheduled=("day", "m"))
    assert {r.rule: r.n for r in own.collect() if r.n} == {"after_departure": 1, "departure_moved": 2}


def test_contract_guards(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert rows(Q.q_schema_allowlist(df, ["x", "z"])) == [("y", "not_allowed"), ("z", "missing")]
    assert rows(Q.audit_registry(df, ["x", "label_y", "q"], ["x"], ["q"])) == [("label_y", "absent"), ("label_y", "label_like"), ("q", "absent"), ("q", "excluded"), ("x", "is_label")]
    assert Q.q_view_contract(df, df.schema).count() == 0
    assert Q.q_view_contract(df, T.StructType([T.StructField("x", T.LongType())])).count() == 2
    assert Q.q_singleton(df).count() == 0 and Q.q_singleton(df.union(df)).count() == 1
    assert Q.q_constant_within(spark.createDataFrame([("a", 1), ("a", None), ("b", 1), ("b", 2)], "k string, v int"), {"k": "k"}, ["v"]).collect()[0].key == "b"


def test_exceedance_keeps_all_bands(spark):
    df = spark.createDataFrame([(0.05, 20, True), (0.05, 0, False), (1.0, 300, True)], "score double, arr_delay_min int, arr_del15 boolean")
    got = {r.bin: r for r in E.exceedance(df).collect()}
    assert len(got) == 10 and got[0].p_ge_15 == 0.5 and got[9].p_ge_240 == 1.0 and got[4].n == 0 and got[4].p_ge_15 is None


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(500).withColumnRenamed("id", "leg_id")
    assert rows(S.det_sample(df, ["leg_id"], 20)) == rows(S.det_sample(df.repartition(9), ["leg_id"], 20))
    assert 20 < S.det_fraction(df, ["leg_id"], 0.1).count() < 90


def test_type_flights(spark):
    raw = spark.createDataFrame(
        [("2024-03-01", "aa ", "12", "ord", "JFK", "0930", None, "1.00"), ("2024-03-01", "AA", "12", "ORD", "JFK", "930", "2400", "0"), ("bad", "AA", None, "", "JFK", "", "", "")],
        "FlightDate string, Reporting_Airline string, Flight_Number_Reporting_Airline string, Origin string, Dest string, CRSDepTime string, DepTime string, Cancelled string",
    ).withColumn("ArrTime", F.lit("1200"))
    got = rows(Sg.type_flights(raw).where("FlightDate IS NOT NULL"), "Reporting_Airline", "Origin", "CRSDepTime", "DepTime", "Cancelled")
    assert got == [("AA", "ORD", 570, 0, False)]
    obs = spark.createDataFrame([("SOD", "2024-01-01"), (None, "2024-01-01"), ("FM-15", "x")], "k string, t string")
    assert Sg.drop_summaries(obs, "k", "t").count() == 1
    flags = Sg.phenomena_flags(F.array(F.lit("freezing_rain"), F.lit(None).cast("string")))
    assert spark.range(1).select(*(c.alias(n) for n, c in flags.items())).first().asDict() == {"is_fog": False, "is_rain": True, "is_snow": False, "is_thunder": False}
    assert one(spark, "ORD", lambda c: Sg.airport_label(F.lit(" "), F.lit("Chicago"), c)) == "Chicago (ORD)"
    assert one(spark, 0.5, lambda c: Sg.phrase(c, F.lit(0.2)), "double") == "about 5 in 10 flights like this one are late, well above usual"
