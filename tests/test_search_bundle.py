"""The family search and the model bundle, on small rows."""

import math

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.sql import functions as F

from apronlake.operators import bundle as B
from apronlake.operators import search as Se
from apronlake.operators.sampling import det_fraction
from apronlake.plans import features as Fe

LEVELS = {"key_hist": ("key", "route")}
SPACE = Se.Space(["a"], "arr_del15", ["leg_id"], grains={"key": "route", "carrier": "carrier"}, levels=LEVELS, m=1.0)


@pytest.fixture(scope="module")
def base(spark):
    i = F.col("id")
    late = (i * 37 % 100 + i % 13) > 70
    return (
        spark.range(900)
        .select(
            i.alias("leg_id"), F.date_add(F.lit("2024-01-01").cast("date"), (i / 30).cast("int")).alias("leg_date"), (i % 11 == 0).alias("cancelled"), F.lit(False).alias("diverted"),
            F.concat(F.lit("r"), (i / 2).cast("int")).alias("route"), F.lit("c").alias("carrier"), F.when(i % 7 != 0, (i * 37 % 100).cast("double")).alias("a"), late.alias("l"),
        )
        .withColumn("arr_del15", F.when(~F.col("cancelled"), F.col("l")))
        .withColumn("arr_delay_min", F.when(~F.col("cancelled"), F.col("l").cast("bigint") * 20))
        .drop("l")
        .persist()
    )


CANDIDATES = [Se.Candidate("lr", "linear", LogisticRegression, {"maxIter": 5}), Se.Candidate("tree", "single", DecisionTreeClassifier, {"maxDepth": 3}), Se.Candidate("stump", "single", DecisionTreeClassifier, {"maxDepth": 1})]
WINDOWS = [Se.Window("2024-01-15", "2024-01-20"), Se.Window("2024-01-20", "2024-01-31")]


def test_rates_of_a_window_hold_nothing_of_its_outcomes(base):
    flipped = base.withColumn("arr_del15", F.when(F.col("leg_date") >= "2024-01-15", ~F.col("arr_del15")).otherwise(F.col("arr_del15")))
    of = lambda df, cutoff: {r.leg_id: r.key_hist_rate for r in Se.with_rates(df, SPACE, cutoff).select("leg_id", "key_hist_rate").collect()}
    assert of(base, "2024-01-15") == of(flipped, "2024-01-15") and of(base, "2024-01-31") != of(flipped, "2024-01-31")
    # By hand: route r4 has legs 8 and 9, both before the window.
    rows = {r.leg_id: r for r in base.collect()}
    flown = [r for r in rows.values() if not r.cancelled and str(r.leg_date) < "2024-01-15"]
    g = sum(r.arr_del15 for r in flown) / len(flown)
    own = [rows[i].arr_del15 for i in (8, 9)]
    assert of(base, "2024-01-15")[8] == pytest.approx((sum(own) + g) / (len(own) + 1))


def test_report_of_a_search(base):
    report = Se.family_search(base, SPACE, CANDIDATES, WINDOWS, fractions=(0.5, 1.0), keep=0.5)
    rows = report.collect()
    first, last = ([r for r in rows if r["round"] == k and r.rates == "fit window" and r.place] for k in (0, 1))
    assert [r.candidate for r in first] == ["lr", "tree", "stump"] and sorted(r.status for r in first) == ["dropped", "kept", "kept"]
    assert sorted(r.status for r in last) == ["best", "dropped"]
    assert all(0 <= r.average_precision <= 1 for r in rows) and first[0].n_fit < last[0].n_fit and first[0].n_val == last[0].n_val
    val = base.where("arr_del15 IS NOT NULL AND leg_date >= '2024-01-15' AND leg_date < '2024-01-31'").count()
    assert first[0].n_val == val  # whole windows, whatever the fraction
    assert last[-1].spent == 3 * first[0].n_fit + 2 * last[0].n_fit
    leak = {r.candidate: r for r in Se.inflation(report).collect()}
    assert set(leak) == {r.candidate for r in last} and max(r.inflation for r in leak.values()) > 0.05  # keys of two legs give the outcome away


def test_a_budget_is_kept_and_told(base):
    rows = Se.family_search(base, SPACE, CANDIDATES, WINDOWS[:1], fractions=(1.0,), budget=500).collect()
    n = {r.candidate: r for r in rows if r["round"] == 0}
    assert rows == Se.family_search(base.repartition(3), SPACE, CANDIDATES, WINDOWS[:1], fractions=(1.0,), budget=500).collect()  # the same on any machine
    assert n["lr"].status == "best" and n["tree"].status == n["stump"].status == "over budget" and n["tree"].average_precision is None
    with pytest.raises(ValueError):
        Se.family_search(base, SPACE, CANDIDATES, WINDOWS, fractions=(1.0, 0.5))
    with pytest.raises(ValueError):
        Se.family_search(base, SPACE, CANDIDATES, [Se.Window("2023-01-01", "2024-01-05")])


def test_fractions_are_nested(base):
    small, large = ({r.leg_id for r in det_fraction(base, ["leg_id"], f).select("leg_id").collect()} for f in (0.2, 0.6))
    assert small < large and 0.1 < len(small) / 900 < 0.3


REGISTRY = {"carrier": "string", "a": "double", "hour": "bigint", "flag": "boolean"}


@pytest.fixture(scope="module")
def frame(spark):
    i = F.col("id")
    x = spark.range(1200).select(i.alias("k"), F.concat(F.lit("c"), i % 3).alias("carrier"), F.when(i % 9 != 0, (i * 37 % 100).cast("double")).alias("a"), (i % 24).alias("hour"), (i % 2 == 0).alias("flag"))
    return x.withColumn("late", F.coalesce(F.col("a") > 60, F.lit(False)) | (F.col("k") % 17 == 0)).withColumn("minutes", F.when(F.col("late"), 40).otherwise(2)).persist()


@pytest.fixture(scope="module")
def bundle(spark, frame, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bundle") / "b")
    B.fit_bundle(frame.where("k % 4 <> 0"), frame.where("k % 4 = 0"), REGISTRY, "carrier", "late", "minutes", path, maxIter=4, maxDepth=3)
    return path, B.load_bundle(spark, path)


def test_a_loaded_bundle_scores(spark, frame, bundle):
    _, b = bundle
    assert b.registry == REGISTRY and b.categories == ["c0", "c1", "c2"]
    got = B.score(frame, b, ["k"])
    assert got.columns == ["k", "raw_score", "delay_probability", "expected_minutes", "baseline_probability", "category_unseen"] and got.count() == 1200
    again = {r.k: tuple(r) for r in B.score(frame, B.load_bundle(spark, bundle[0]), ["k"]).collect()}
    assert again == {r.k: tuple(r) for r in got.collect()}
    r = got.first()
    z = math.log(r.raw_score / (1 - r.raw_score))
    assert r.delay_probability == pytest.approx(1 / (1 + math.exp(-(b.platt[0] * z + b.platt[1]))))
    late, early = (got.join(frame, "k").where(c).agg(F.avg("delay_probability"), F.avg("expected_minutes"), F.avg("baseline_probability")).first() for c in ("late", "NOT late"))
    assert all(x > y for x, y in zip(late, early))


def test_the_gate_takes_a_frame_as_it_is(frame, bundle):
    for wrong in (frame.withColumn("hour", F.col("hour").cast("int")), frame.withColumn("a", F.col("a").cast("string")), frame.drop("flag")):
        with pytest.raises(ValueError, match="instead of"):
            B.score(wrong, bundle[1], ["k"])
    moved = frame.select("late", "flag", "hour", "k", "a", "carrier", F.lit(1).alias("more"))
    assert {tuple(r) for r in B.score(moved, bundle[1], ["k"]).collect()} == {tuple(r) for r in B.score(frame, bundle[1], ["k"]).collect()}


def test_unseen_categories_and_nulls(spark, frame, bundle):
    odd = spark.createDataFrame([(1, "zz", 5.0, 1, True), (2, None, 5.0, 1, True), (3, "c1", None, None, None)], "k long, carrier string, a double, hour long, flag boolean")
    got = {r.k: r for r in B.score(odd, bundle[1], ["k"]).collect()}
    assert [got[k].category_unseen for k in (1, 2, 3)] == [True, False, False]
    assert got[1].raw_score == got[2].raw_score and all(0 <= r.delay_probability <= 1 for r in got.values())
    assert B.score(odd.where("k > 9"), bundle[1], ["k"]).count() == 0


def test_a_bundle_is_not_overwritten_and_needs_its_registry(frame, bundle, tmp_path):
    with pytest.raises(Exception, match="exist"):
        B.fit_bundle(frame, frame, REGISTRY, "carrier", "late", "minutes", bundle[0], maxIter=1, maxDepth=1)
    with pytest.raises(ValueError):
        B.fit_bundle(frame.withColumn("hour", F.lit("x")), frame, REGISTRY, "carrier", "late", "minutes", str(tmp_path / "n"))
    with pytest.raises(ValueError):
        B.fit_bundle(frame, frame, REGISTRY, "carrier", "late", "minutes", str(tmp_path / "n"), most_categories=2)


def test_requests_pass_the_gate_without_a_cast(spark, sf_dir):
    x = Fe.request_features(spark, sf_dir, Fe.X.requests(spark, sf_dir))
    assert Fe.Q.gate_schema(x, Fe.SERVED_REGISTRY).columns == list(Fe.SERVED_REGISTRY)
    assert Fe.Q.gate_schema(Fe.feature_rows(spark, sf_dir), {c.name: c.type for c in Fe.REGISTRY}).columns == [c.name for c in Fe.REGISTRY]
    assert len(Fe.REGISTRY) == 59
