"""What keeps large tables cheap: few rows moved or paired, tasks by the work, and the results as they were."""

import datetime as dt
import random

from apronlake.operators import joins as J


def test_connections_are_dealt_to_all_tasks_and_carry_columns(spark):
    """A board of one file is not one task; the first leg's columns need no join of the pairs."""
    r, day = random.Random(3), dt.date(2024, 1, 1)
    legs = [(i, day + dt.timedelta(i % 2), r.choice("AB"), r.choice("AB"), r.randrange(1440), r.randrange(20, 400), i / 400) for i in range(400)]
    board = spark.createDataFrame(legs, "leg_id long, leg_date date, origin string, dest string, dep_min long, elapsed_min long, score double").coalesce(1)
    out = J.connections(board, keep=("score",))
    want = set()
    for a in legs:
        arr = a[4] + a[5]
        for b in legs:
            if arr <= 1439 and a[1] == b[1] and a[3] == b[2] and a[2] != b[3] and 30 <= b[4] - arr <= 240:
                want.add((a[0], b[0], a[1], a[3], b[4] - arr, a[6]))
    got = [tuple(x) for x in out.collect()]
    assert len(want) > 500 and set(got) == want and len(got) == len(want)
    assert out.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def _busy_board(spark, n=3000):
    """Two hours of departures in which runs are full, with copies of a leg and legs that lack a place or time."""
    r, day = random.Random(8), dt.date(2024, 1, 1)
    legs = [(i, day, r.choice("ABC"), r.choice("ABC"), r.randrange(600, 720), r.randrange(10, 60), None if i % 40 == 0 else i % 100 / 100) for i in range(n)]
    legs += legs[:20] + [(n, day, None, "A", 660, 50, 0.5), (n + 1, day, "A", None, 660, 50, 0.5), (n + 2, day, "A", "B", None, 50, 0.5), (n + 3, None, "A", "B", 660, 50, 0.5)]
    legs += [(n + 4, day, "A", "B", 1400, 39, 0.1), (n + 5, day, "A", "B", 1400, 40, 0.1), (n + 6, day, "C", "A", 1439, 20, 0.1)]
    return spark.createDataFrame(legs, "leg_id long, leg_date date, origin string, dest string, dep_min long, elapsed_min long, score double").coalesce(1)


def test_connections_of_a_busy_airport_take_few_bytes_a_pair(spark, tmp_path):
    """All pairs, in an order that Parquet writes in few bytes; runs longer than one array, NULLs and copies count as in SQL."""
    board = _busy_board(spark)
    board.createOrReplaceTempView("busy_board")
    want = spark.sql("""SELECT a.leg_id AS first_id, b.leg_id AS second_id, a.leg_date, a.dest AS airport, b.dep_min - (a.dep_min + a.elapsed_min) AS layover
        FROM busy_board a JOIN busy_board b ON a.leg_date = b.leg_date AND a.dest = b.origin AND a.origin <> b.dest
        WHERE a.dep_min + a.elapsed_min <= 1439 AND b.dep_min - (a.dep_min + a.elapsed_min) BETWEEN 30 AND 240""")
    path = str(tmp_path / "pairs")
    J.connections(board).write.parquet(path)
    got = spark.read.parquet(path)
    n = got.count()
    assert n == want.count() > 100_000
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < 1.2 * n


def test_exceedance_meets_first_legs_before_pairs_are_made(spark):
    """The table is looked up for first legs, not for pairs, and gives the same as if joined with the pairs."""
    from pyspark.sql import functions as F

    from apronlake.operators import evaluation as E

    board = _busy_board(spark, 600)
    table = E.exceedance(board.withColumn("arr_delay_min", F.col("leg_id") % 300))
    out = E.connection_risk(board, table)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.find("Generate inline(_second") < plan.find("Join LeftOuter") < plan.find("Generate inline(_first")
    rates = {r.bin: r for r in table.collect()}
    legs = {r.leg_id: r for r in board.collect()}
    pairs = {(r.first_id, r.second_id): r.layover - 30 for r in J.connections(board).collect()}
    rows = out.collect()
    assert len(pairs) > 1000 and {(r.first_id, r.second_id) for r in rows} == set(pairs)
    for r in rows:
        slack, score = pairs[r.first_id, r.second_id], legs[r.first_id].score
        at = max([t for t in E.THRESHOLDS if t <= slack], default=15) if slack > 0 else None
        p = None if at is None or score is None else rates[sum(score >= i / 10 for i in range(1, 10))][f"p_ge_{at}"]
        bound = "inside connection time" if slack <= 0 else "lower" if slack < 15 else "measured"
        assert (r.slack, r.threshold, r.p_miss, r.bound) == (slack, at, p, bound)


def test_interval_lookup_meets_points_once_for_each_start_and_end(spark):
    """Copies of an interval do not multiply the points, and the first start, then the smallest value (NULL first) counts."""
    r, t0 = random.Random(5), dt.datetime(2024, 1, 1)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    kinds = [(r.choice("ab"), 60 * r.randrange(5), r.choice((30, 45, 90))) for _ in range(12)]
    spans = [(k, at(m), n, None if r.random() < 0.01 else r.randrange(1000)) for k, m, n in kinds for _ in range(40)]
    points = [(i, r.choice("abc"), at(r.randrange(480))) for i in range(200)]
    want = {}
    for i, k, t in points:
        found = [(s, -1 if v is None else v) for b, s, n, v in spans if b == k and s <= t < s + dt.timedelta(minutes=n)]
        want[i] = min(found)[1] if found else None
    x = J.interval_lookup(spark.createDataFrame(points, "i long, k string, t timestamp_ntz"), spark.createDataFrame(spans, "k string, s timestamp_ntz, n int, v long"), "k", "t", "s", "n", "v")
    assert {y.i: y.v for y in x.collect()} == {i: None if v == -1 else v for i, v in want.items()}
    plan = x._jdf.queryExecution().optimizedPlan().toString()
    assert "min(struct" not in plan and "_start" in plan


def test_whole_marts_store_no_table_on_the_way(spark, sf_dir, monkeypatch):
    """Marts of all legs read them as they are made, without writing the long table, and move lines once."""
    from apronlake.plans import catalog, stored

    def fail(*a, **k):
        raise AssertionError("wrote a table")

    monkeypatch.setattr(stored, "_once", fail)
    for name in ("additive_schedule", "mart_route", "additive_monthly", "route_carrier"):
        assert catalog.QUERIES[name](spark, sf_dir).limit(1).count() == 1


def test_flown_places_pass_over_the_legs_once(spark, sf_dir):
    from apronlake.plans import catalog

    plan = catalog.QUERIES["flown_places"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey") and plan.count("Union") == 0


def test_raw_flights_are_made_by_all_cores(spark, sf_dir):
    from apronlake.plans import checks

    cores = spark.sparkContext.defaultParallelism
    assert checks.raw_flights(spark, sf_dir).rdd.getNumPartitions() >= 2 * cores  # rows and their earlier copies


def test_a_bundle_is_fitted_without_weather_and_its_vectors_are_made_once(spark, sf_dir, monkeypatch):
    """No as-of join for columns that are not served, one fit of the features for three models, scoring by all cores."""
    from pyspark.ml.feature import Imputer

    from apronlake.plans import features as Fe
    from apronlake.plans import views

    want = Fe.feature_rows(spark, sf_dir).where("is_training_row").select("leg_date", *Fe.SERVED_REGISTRY, "label_arr_del15", "label_arr_delay_min").collect()

    def fail(*a, **k):
        raise AssertionError("looked up the weather")

    fits, fit = [], Imputer._fit
    monkeypatch.setattr(views, "hourly_observations", fail)
    monkeypatch.setattr(Imputer, "_fit", lambda self, df: fits.append(1) or fit(self, df))
    monkeypatch.setattr(Fe, "_BUNDLES", {})
    scored = Fe.bundle_scores(spark, sf_dir)
    assert len(fits) == 1
    assert scored.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.find("UDF") < plan.find("RepartitionByExpression") < plan.find("Join")  # models, deal, lookups: stages of their own
    assert scored.count() == scored.select("request_id").distinct().count() == Fe.X.requests(spark, sf_dir).count()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(Fe.served_rows(spark, sf_dir).collect(), key=key) == sorted(want, key=key)


def test_models_of_shared_vectors_are_those_fitted_apart(spark, tmp_path):
    """Indicators that never vary may go, the rest is as if each model had made its own vectors."""
    import pytest
    from pyspark.sql import functions as F

    from apronlake.operators import bundle as B
    from apronlake.operators import model as Mo

    i = F.col("id")
    x = spark.range(0, 1200, 1, 1).select(i.alias("k"), F.concat(F.lit("c"), i % 3).alias("carrier"), F.when(i % 9 != 0, (i * 37 % 100).cast("double")).alias("a"), (i % 24).alias("hour"), F.lit(None).cast("double").alias("empty"))
    x = x.withColumn("late", F.coalesce(F.col("a") > 60, F.lit(False)) | (F.col("k") % 17 == 0)).withColumn("minutes", F.when(F.col("late"), 40).otherwise(2))
    registry, numeric = {"carrier": "string", "a": "double", "hour": "bigint", "empty": "double"}, ["a", "hour", "empty"]
    B.fit_bundle(x.where("k % 4 <> 0"), x.where("k % 4 = 0"), registry, "carrier", "late", "minutes", str(tmp_path / "b"), maxIter=4, maxDepth=3)
    odd = x.withColumns({"hour": F.when(F.col("k") % 5 != 0, F.col("hour")), "empty": F.when(F.col("k") % 7 == 0, 3.0)})
    got = {r.k: r for r in B.score(odd, B.load_bundle(spark, str(tmp_path / "b")), ["k"]).collect()}
    rows = Mo.prepare(x.where("k % 4 <> 0").select("carrier", *numeric, F.col("late").cast("double").alias("_late"), F.col("minutes").cast("double").alias("_minutes")), numeric)
    p = {"maxIter": 4, "maxDepth": 3}
    apart = Mo.prepare(odd, numeric)
    apart = Mo.probability(Mo.fit_gbt_classifier(rows, numeric, "carrier", "_late", **p), apart, "raw_score")
    apart = Mo.probability(Mo.fit_logistic(rows, numeric, "carrier", "_late"), apart, "baseline_probability")
    apart = Mo.fit_gbt_regressor(rows, numeric, "carrier", "_minutes", **p).transform(apart).select("k", "raw_score", "baseline_probability", "prediction").collect()
    assert len(apart) == len(got) == 1200
    for r in apart:
        s = got[r.k]
        assert (s.raw_score, s.baseline_probability, s.expected_minutes) == pytest.approx((r.raw_score, r.baseline_probability, r.prediction), abs=1e-9)
