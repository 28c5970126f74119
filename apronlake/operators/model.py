"""Training, calibration, selection and scoring with Spark ML; only metric scalars reach the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Matrices
from pyspark.ml.regression import GBTRegressor, IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import evaluation as E

EPSILON = 1e-6


def prepare(df: DataFrame, numeric: list[str]) -> DataFrame:
    """Numbers as doubles; an indicator of each missing value (trees of Spark ML have no branch for one)."""
    out = df.withColumns({c: F.col(c).cast("double") for c in numeric})
    return out.withColumns({f"{c}_missing": F.col(c).isNull().cast("double") for c in numeric})


def feature_stages(df: DataFrame, numeric: list[str], category: str | None, scale: bool, varying: bool = False) -> list:
    """Median imputation (an all-missing column is 0), category code, and one vector; fitted on training rows only.

    ``varying``: leave out indicators that are the same in all rows, on which no tree splits and which no linear model weighs.
    """
    known = df.agg(F.count(F.lit(1)).alias("_n"), *(F.count(c).alias(c) for c in numeric)).first()
    full = [c for c in numeric if known[c]]
    stages: list = [Imputer(inputCols=full, outputCols=[f"{c}_f" for c in full], strategy="median")]
    inputs = [f"{c}_f" for c in full] + [f"{c}_missing" for c in numeric if not varying or 0 < known[c] < known["_n"]]
    if category:
        stages.append(StringIndexer(inputCol=category, outputCol="_cat", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCol="_cat", outputCol="_hot", handleInvalid="keep"))
        inputs.append("_hot")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="_raw" if scale else "features"))
    if scale:
        stages.append(StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True))
    return stages


def with_weight(df: DataFrame, label: str) -> DataFrame:
    """Positives weigh negatives / positives, from these rows."""
    n = df.agg(F.sum(F.col(label)).alias("p"), F.count(F.lit(1)).alias("n")).first()
    ratio = (n["n"] - n["p"]) / n["p"] if n["p"] else 1.0
    return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0)))


def _fit(df: DataFrame, numeric: list[str], category: str | None, estimator, scale: bool) -> PipelineModel:
    return Pipeline(stages=[*feature_stages(df, numeric, category, scale), estimator]).fit(df)


def logistic(label: str, **params) -> LogisticRegression:
    return LogisticRegression(labelCol=label, weightCol="weight", **{"maxIter": 50, **params})


def gbt_classifier(label: str, **params) -> GBTClassifier:
    return GBTClassifier(labelCol=label, weightCol="weight", seed=7, **{"maxIter": 20, "maxDepth": 4, **params})


def gbt_regressor(label: str, **params) -> GBTRegressor:
    return GBTRegressor(labelCol=label, seed=7, **{"maxIter": 20, "maxDepth": 4, "subsamplingRate": 0.8, **params})


def fit_logistic(df: DataFrame, numeric: list[str], category: str | None, label: str, **params) -> PipelineModel:
    return _fit(with_weight(df, label), numeric, category, logistic(label, **params), True)


def fit_gbt_classifier(df: DataFrame, numeric: list[str], category: str | None, label: str, **params) -> PipelineModel:
    return _fit(with_weight(df, label), numeric, category, gbt_classifier(label, **params), False)


def fit_gbt_regressor(df: DataFrame, numeric: list[str], category: str | None, label: str, **params) -> PipelineModel:
    return _fit(df, numeric, category, gbt_regressor(label, **params), False)


def fit_features(df: DataFrame, numeric: list[str], category: str | None) -> PipelineModel:
    """What makes the column ``features``, for several models of the same rows."""
    return Pipeline(stages=feature_stages(df, numeric, category, False, varying=True)).fit(df)


def fit_on_features(df: DataFrame, estimator, scale: bool = False) -> PipelineModel:
    """A model of rows that have ``features`` already."""
    if not scale:
        return Pipeline(stages=[estimator]).fit(df)
    return Pipeline(stages=[StandardScaler(inputCol="features", outputCol="_scaled", withMean=True, withStd=True), estimator.setFeaturesCol("_scaled")]).fit(df)


def probability(model: PipelineModel, df: DataFrame, name: str = "p") -> DataFrame:
    out = model.transform(df).withColumn(name, vector_to_array("probability")[1])
    return out.select(*df.columns, name)


def _logit(c):
    p = F.least(F.greatest(c, F.lit(EPSILON)), F.lit(1 - EPSILON))
    return F.log(p / (1 - p))


def fit_platt(df: DataFrame, score: str, label: str, least_slope: float | None = None) -> tuple[float, float]:
    """(a, b) of the logistic map of the clipped logit, without regularisation; a is ``least_slope`` or more."""
    x = VectorAssembler(inputCols=["_z"], outputCol="features").transform(df.select(_logit(F.col(score)).alias("_z"), F.col(label).cast("double").alias("y")))
    bounds = {} if least_slope is None else {"lowerBoundsOnCoefficients": Matrices.dense(1, 1, [least_slope])}
    m = LogisticRegression(labelCol="y", regParam=0.0, maxIter=100, **bounds).fit(x)
    return float(m.coefficients[0]), float(m.intercept)


def apply_platt(c, a: float, b: float):
    return 1 / (1 + F.exp(-(a * _logit(c) + b)))


def fit_isotonic(df: DataFrame, score: str, label: str) -> IsotonicRegressionModel:
    """A monotone map; rows of one score are one weighted point before the fit."""
    x = df.groupBy(F.col(score).alias("s")).agg(F.avg(F.col(label).cast("double")).alias("y"), F.count(F.lit(1)).cast("double").alias("w"))
    return IsotonicRegression(featuresCol="s", labelCol="y", weightCol="w").fit(x)


def apply_isotonic(df: DataFrame, model: IsotonicRegressionModel, score: str, out: str = "p") -> DataFrame:
    """``df`` with the mapped score: linear between the model's points, found by bisection, constant beyond their ends."""
    return model.copy().setFeaturesCol(score).setPredictionCol(out).transform(df)


def gate_auc(df: DataFrame, raw: str, served: str, label: str, tolerance: float = 1e-6) -> None:
    """Raise if serving scores rank differently from raw ones."""
    a, b = (E.roc_auc(df, s, label).first()[0] for s in (raw, served))
    if abs(a - b) > tolerance:
        raise ValueError(f"AUC moved from {a} to {b}")


def average_precision_of(df: DataFrame, score: str, label: str) -> float:
    return float(E.average_precision(df, score, label).first()[0] or 0.0)


def select_on_validation(fit: DataFrame, val: DataFrame, label: str, candidates: dict[str, Callable[[DataFrame], PipelineModel]]) -> list[tuple[str, float]]:
    """(name, average precision) of candidates on validation rows, best first; test rows are never seen."""
    ranked = [(n, average_precision_of(probability(f(fit), val), "p", label)) for n, f in candidates.items()]
    return sorted(ranked, key=lambda x: (-x[1], x[0]))


def families(numeric: list[str], category: str | None, label: str) -> dict[str, Callable[[DataFrame], PipelineModel]]:
    """Candidates of the families that Spark ML has."""
    tree = lambda e: lambda df: _fit(with_weight(df, label), numeric, category, e, False)
    return {
        "logistic": lambda df: fit_logistic(df, numeric, category, label),
        "gbt": lambda df: fit_gbt_classifier(df, numeric, category, label, maxIter=10),
        "forest": tree(RandomForestClassifier(labelCol=label, weightCol="weight", numTrees=20, maxDepth=5, seed=7)),
        "tree": tree(DecisionTreeClassifier(labelCol=label, weightCol="weight", maxDepth=4, seed=7)),
    }


def importances(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(feature, importance) of a fitted tree ensemble, or coefficient sizes of a linear model."""
    out = model.transform(df.limit(1))
    last = model.stages[-1]
    field = last.getFeaturesCol()
    attrs = out.schema[field].metadata.get("ml_attr", {}).get("attrs", {}) or out.schema["_raw" if "_raw" in out.columns else field].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a["name"] for kind in attrs.values() for a in kind}
    values = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    rows = [(names.get(i, f"f{i}"), float(abs(v))) for i, v in enumerate(values.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def confirm(scored: DataFrame, label: str, candidate: str, incumbent: str) -> DataFrame:
    """One look at held-out rows: metrics of both scores and their difference."""
    rows = []
    for name, col in (("candidate", candidate), ("incumbent", incumbent)):
        auc = float(E.roc_auc(scored, col, label).first()[0])
        c = E.calibration_metrics(scored, col, label).first()
        rows.append((name, auc, average_precision_of(scored, col, label), float(c["ece"])))
    rows.append(("delta", *(a - b for a, b in zip(rows[0][1:], rows[1][1:]))))
    return scored.sparkSession.createDataFrame(rows, "model string, roc_auc double, average_precision double, ece double")


def score_linear(df: DataFrame, weights: dict[str, float], intercept: float, platt: tuple[float, float], baseline: str) -> DataFrame:
    """Raw and calibrated score of a linear model, and the score less a baseline column.

    A missing value weighs nothing; ``platt`` is (slope, intercept) on the raw score's logit.
    """
    z = F.lit(intercept)
    for c, w in weights.items():
        z = z + F.lit(w) * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    squash = lambda x: 1 / (1 + F.exp(-x))
    return df.withColumn("raw_score", squash(z)).withColumn("score", squash(F.lit(platt[0]) * z + F.lit(platt[1]))).withColumn("lift", F.col("score") - F.col(baseline))
