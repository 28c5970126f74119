"""A model bundle: what a scorer needs, fitted once, saved together, loaded and used as it is.

    features/    PipelineModel from the registry's columns to one vector, for all three models
    classifier/  PipelineModel of delay        regressor/  PipelineModel of minutes
    baseline/    PipelineModel, logistic       about/      one JSON row: registry, categories, Platt map

The registry is the order, names and types of the feature columns that the models were
fitted on. Scoring gates a frame by it before anything touches the values: a column that is
missing or of another type is an error, never a cast or an all-NULL feature. Categories
that the fit did not see become NULL and are counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import model as Mo
from . import quality as Q
from .scratch import written

#: Of the Platt map, so that calibrated scores keep the order of raw ones.
LEAST_SLOPE = 0.01
ABOUT = "registry array<struct<name:string,type:string>>, numeric array<string>, category string, categories array<string>, slope double, intercept double, n_fit long, n_calibration long"


@dataclass
class Bundle:
    features: PipelineModel
    classifier: PipelineModel
    regressor: PipelineModel
    baseline: PipelineModel
    registry: dict[str, str]
    numeric: list[str]
    category: str
    categories: list[str]
    platt: tuple[float, float]


def fit_bundle(fit: DataFrame, calibration: DataFrame, registry: dict[str, str], category: str, late: str, minutes: str, path: str, most_categories: int = 100_000, **params) -> None:
    """Fit on ``fit``, calibrate on later rows, and save to ``path``; a folder that is there is an error.

    Both frames pass the gate. The vectors are made and written once, and all models are fitted
    on what was written: the memory that a fit has is its own. The Platt map must not change the order of scores: its slope has a
    lower bound, which scores without any signal meet, and the AUC of raw and calibrated scores of
    the calibration rows is compared before anything is saved.
    """
    numeric = [c for c in registry if c != category]
    spark = fit.sparkSession
    known = [r[0] for r in fit.select(category).where(f"{category} IS NOT NULL").distinct().orderBy(category).limit(most_categories + 1).collect()]
    if len(known) > most_categories:
        raise ValueError(f"more than {most_categories} values of {category}")

    def rows(df: DataFrame) -> DataFrame:
        gated = Q.gate_schema(df, registry)  # raises; labels come along beside the features
        return Mo.prepare(df.select(*gated.columns, F.col(late).cast("double").alias("_late"), F.col(minutes).cast("double").alias("_minutes")), numeric)

    train = rows(fit).where("_late IS NOT NULL AND _minutes IS NOT NULL")
    features = Mo.fit_features(train, numeric, category)
    train = written(features.transform(train).select("features", "_late", "_minutes"), "bundle-vectors")
    weighted = Mo.with_weight(train, "_late")
    classifier = Mo.fit_on_features(weighted, Mo.gbt_classifier("_late", **params))
    regressor = Mo.fit_on_features(train, Mo.gbt_regressor("_minutes", **params))
    baseline = Mo.fit_on_features(weighted, Mo.logistic("_late"), scale=True)
    n_fit = train.count()
    later = features.transform(rows(calibration).where("_late IS NOT NULL")).select("features", "_late")
    raw = Mo.probability(classifier, later, "_raw").select("_raw", "_late").persist()
    try:
        slope, intercept = Mo.fit_platt(raw, "_raw", "_late", LEAST_SLOPE)
        Mo.gate_auc(raw.withColumn("_served", Mo.apply_platt(F.col("_raw"), slope, intercept)), "_raw", "_served", "_late")
        n_calibration = raw.count()
    finally:
        raw.unpersist()
    about = spark.createDataFrame([(list(registry.items()), numeric, category, known, slope, intercept, n_fit, n_calibration)], ABOUT)
    for model, name in ((features, "features"), (classifier, "classifier"), (regressor, "regressor"), (baseline, "baseline")):
        model.save(f"{path}/{name}")
    about.coalesce(1).write.json(f"{path}/about")  # last: a bundle without it is none


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    about = spark.read.schema(ABOUT).json(f"{path}/about").first()
    models = [PipelineModel.load(f"{path}/{name}") for name in ("features", "classifier", "regressor", "baseline")]
    return Bundle(*models, {r.name: r.type for r in about.registry}, about.numeric, about.category, about.categories, (about.slope, about.intercept))


def score(df: DataFrame, bundle: Bundle, keys: list[str]) -> DataFrame:
    """(keys, raw_score, delay_probability, expected_minutes, baseline_probability, category_unseen) of each row.

    Features are gated as they come. One pass: a row's vector is made once, and the three models add columns to it.
    """
    gated = Q.gate_schema(df, bundle.registry).columns
    seen = F.col(bundle.category).isin(bundle.categories) if len(bundle.categories) <= 1000 else F.array_contains(F.lit(bundle.categories), F.col(bundle.category))
    x = df.select(*keys, *(F.col(c).alias(c) for c in gated if c not in keys))
    x = x.withColumn("category_unseen", F.col(bundle.category).isNotNull() & ~seen)
    x = x.withColumn(bundle.category, F.when(~F.col("category_unseen"), F.col(bundle.category)))
    x = bundle.features.transform(Mo.prepare(x, bundle.numeric)).select(*keys, "category_unseen", "features")
    x = Mo.probability(bundle.classifier, x, "raw_score")
    x = Mo.probability(bundle.baseline, x, "baseline_probability")
    minutes = bundle.regressor.transform(x).select(*x.columns, F.col("prediction").alias("expected_minutes"))
    return minutes.select(*keys, "raw_score", Mo.apply_platt(F.col("raw_score"), *bundle.platt).alias("delay_probability"), "expected_minutes", "baseline_probability", "category_unseen")
