"""Small operators of staging and guards, with rows that must fail."""

import pytest
from pyspark.sql import functions as F

from apronlake.functions import cleaning as C
from apronlake.operators import joins as J
from apronlake.operators import windows as Wn
from apronlake.plans import checks as Ch
from apronlake.plans import features as Fe
from apronlake.plans import fixtures as X
from apronlake.plans import marts as M


def test_rows_of_no_known_entity(spark):
    known = spark.createDataFrame([(1, "t", 2.5, [1])], "i long, tail string, x double, a array<int>")
    rest = spark.createDataFrame([(2,), (None,)], "i long")
    out = Wn.append_null_rows(known, rest)
    assert out.schema.simpleString() == known.schema.simpleString()
    assert sorted(map(str, out.collect())) == sorted(map(str, [*known.collect(), *known.limit(0).unionByName(rest, allowMissingColumns=True).collect()]))
    with pytest.raises(ValueError):
        Wn.append_null_rows(known, rest.withColumn("other", F.lit(1)))


def test_constant_attributes(spark):
    df = spark.createDataFrame([("r", "a", 1, None), ("r", None, 2, None), (None, "b", 3, None)], "k string, name string, x long, gone string")
    got = {r.k: tuple(r)[1:] for r in J.collapse(df, "k", ["name", "x", "gone"]).collect()}
    assert got == {"r": ("a", None, None, "x", 2), None: ("b", 3, None, "", 1)}


def test_supplied_numbers_are_finite_and_above_zero(spark):
    df = spark.createDataFrame([(1.5,), (0.0,), (-1.0,), (float("nan"),), (float("inf"),), (None,)], "x double")
    assert [r.ok for r in df.select(C.positive(F.col("x")).alias("ok")).collect()] == [True, False, False, False, False, None]
    day = "date '2024-02-05'"
    bad = "double('nan')", "double('inf')", "0D", "double('-inf')"
    req = spark.sql("SELECT * FROM VALUES " + ", ".join(f"({i}L, {day}, 900L, 'A', NULL, {x})" for i, x in enumerate((*bad, "4D"))) + " t(request_id, leg_date, dep_min, origin, position, density)")
    zones = spark.createDataFrame([("A", "UTC")], "airport string, tz string")
    grid = spark.sql("SELECT 'A' AS place, timestamp_ntz '2024-02-05 20:00:00' AS hour, 40.0 AS temp")
    got = {r.request_id: r.origin_density_source for r in M.basis(req, zones, grid, "2024-02-05T12:00:00").collect()}
    assert got == {0: "estimated", 1: "estimated", 2: "estimated", 3: "estimated", 4: "provided"}


def test_isotonic_map_equals_pooled_violators(spark, sf_dir):
    got = {r.leg_id: (r.score, r.p) for r in Ch.isotonic_scores(spark, sf_dir).collect()}
    rows = Ch._scored(spark, sf_dir).select("leg_id", "score", "y", (F.col("leg_date") < X.CUTOFF).alias("fit")).collect()
    points = {}
    for r in rows:
        if r.fit:
            n, s = points.get(r.score, (0, 0))
            points[r.score] = n + 1, s + r.y
    blocks = []  # scores, rows, sum; means never fall
    for score in sorted(points):
        blocks.append([[score], *points[score]])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            scores, n, s = blocks.pop()
            blocks[-1][0] += scores
            blocks[-1][1] += n
            blocks[-1][2] += s
    at = sorted((score, s / n) for scores, n, s in blocks for score in (scores[0], scores[-1]))
    for leg, score in ((r.leg_id, r.score) for r in rows if not r.fit):
        below, above = [a for a in at if a[0] <= score], [a for a in at if a[0] >= score]
        want = (below or above)[-1 if below else 0] if not (below and above) else None
        if want is None:
            (x, p), (y, q) = below[-1], above[0]
            value = p if x == y else p + (q - p) * (score - x) / (y - x)
        else:
            value = want[1]
        assert got[leg] == (score, pytest.approx(value, abs=2e-6))


def test_registry_has_one_row_a_column_and_knows_roles():
    names = [c.name for c in Fe.REGISTRY]
    assert len(names) == len(set(names)) == 59
    assert not set(Fe.names("feature")) & set(Fe.names("label", "note", "split", "key"))
    assert not [n for n in Fe.names("feature") if n.startswith(("label_", "arr_"))]
    assert set(Fe.SERVED_REGISTRY) <= {*Fe.names("feature"), "carrier"}
