import pytest
from pyspark.sql import functions as F

from apronlake.operators import evaluation as E
from apronlake.operators import model as Mo


@pytest.fixture(scope="module")
def frame(spark):
    i = F.col("id")
    x = spark.range(1200).select(
        i.alias("leg_id"),
        F.when(i % 11 != 0, (i * 37 % 100).cast("double")).alias("a"),
        F.lit(None).cast("double").alias("none"),
        F.concat(F.lit("c"), i % 3).alias("carrier"),
        ((i * 37 % 100 + i % 13) > 70).cast("double").alias("y"),
    )
    return Mo.prepare(x, ["a", "none"]).persist()


def test_families_and_selection(spark, frame):
    fit, val = frame.where("leg_id % 4 <> 0"), frame.where("leg_id % 4 = 0")
    ranked = Mo.select_on_validation(fit, val, "y", Mo.families(["a", "none"], "carrier", "y"))
    assert {n for n, _ in ranked} == {"logistic", "gbt", "forest", "tree"}
    assert ranked[0][1] > 0.9 and ranked == sorted(ranked, key=lambda r: (-r[1], r[0]))
    model = Mo.fit_gbt_classifier(fit, ["a", "none"], "carrier", "y", maxIter=5)
    assert Mo.importances(model, fit).first().feature == "a_f"
    odd = val.limit(5).withColumn("carrier", F.lit("never seen"))
    assert Mo.probability(model, odd).where("p IS NOT NULL").count() == 5
    reg = Mo.fit_gbt_regressor(fit.withColumn("t", F.coalesce("a", F.lit(50.0))), ["a", "none"], "carrier", "t", maxIter=5)
    assert reg.transform(val).count() == val.count()


def test_calibration(spark):
    x = spark.range(4000).select(((F.col("id") % 97 + 1) / 100.0).alias("s"), ((F.col("id") * 7919 % 1000) < F.pow((F.col("id") % 97 + 1) / 100.0, 2) * 1000).cast("int").alias("y")).persist()
    a, b = Mo.fit_platt(x, "s", "y")
    served = x.withColumn("p", Mo.apply_platt(F.col("s"), a, b))
    before, after = (E.calibration_metrics(served, c, "y").first().ece for c in ("s", "p"))
    assert after < before
    Mo.gate_auc(served, "s", "p", "y")
    with pytest.raises(ValueError):
        Mo.gate_auc(served.withColumn("q", -F.col("p")), "s", "q", "y")
    model = Mo.fit_isotonic(x, "s", "y")
    iso = Mo.apply_isotonic(x, model, "s")
    assert E.calibration_metrics(iso, "p", "y").first().ece < 0.03
    points = sorted(zip(map(float, model.boundaries), map(float, model.predictions)))
    ends = spark.createDataFrame([(-1.0,), ((points[0][0] + points[1][0]) / 2,), (9.0,)], "v double")
    got = [r.p for r in Mo.apply_isotonic(ends, model, "v").orderBy("v").collect()]
    assert got == pytest.approx([points[0][1], (points[0][1] + points[1][1]) / 2, points[-1][1]])
