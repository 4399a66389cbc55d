"""Maintenance classifiers and the day-ahead forecast on MLlib."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbside.functions.draws import draw
from kerbside.operators.fleet import FEATURES
from kerbside.operators.regression import ridge
from kerbside.operators.traffic import STEPS

SEED = 42
# Published training settings of each classifier.
FOREST = {"numTrees": 400, "maxDepth": 20, "minInstancesPerNode": 5}
BOOSTING = {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1}
TREE = {"maxDepth": 30}
FOREST_GRID = {"trees": [200, 400], "max_depth": [10, 20], "min_split": [2, 5, 10], "min_leaf": [1, 2, 4]}
LOGISTIC_GRID = {"C": [0.01, 0.1, 1.0, 10.0, 100.0], "penalty": ["l1", "l2", "elasticnet", "none"], "max_iter": [100, 200, 300]}
RIDGE = 0.01
LEAST_ROWS, MOST_ROWS = 4_096, 262_144  # rows of a part that a solver goes through in each step


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def _dealt(vectors: DataFrame, rows: int) -> DataFrame:
    """Rows in about one part per core, none of few rows or of very many: a solver's step is one short task a part.

    A table of few bytes comes in one or two parts, which then take all the work of every step.
    """
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    return vectors.repartition(max(1, -(-rows // MOST_ROWS), min(cores, -(-rows // LEAST_ROWS))))


def _fit(train: DataFrame, stages: list, features: Sequence[str], rows: int | None = None) -> PipelineModel:
    """Fit the stages on cached vectors, dealt out evenly; iterative solvers then never rescan the source."""
    assembler = _assembler(features)
    vectors = _dealt(assembler.transform(train).select("features", "label"), train.count() if rows is None else rows).persist()
    try:
        fitted = Pipeline(stages=stages).fit(vectors)
    finally:
        vectors.unpersist()
    return PipelineModel(stages=[assembler, *fitted.stages])


def fit_forest(train: DataFrame, features: Sequence[str] = FEATURES, **settings) -> PipelineModel:
    return _fit(train, [RandomForestClassifier(seed=SEED, **{**FOREST, **settings})], features)


def fit_logistic(train: DataFrame, features: Sequence[str] = FEATURES, **settings) -> PipelineModel:
    """L2-penalised logistic regression; the unit penalty is spread over the rows."""
    rows = train.count()
    settings.setdefault("regParam", 1.0 / max(1, rows))
    return _fit(train, [LogisticRegression(**{"elasticNetParam": 0.0, "standardization": False, **settings})], features, rows)


def fit_linear_svm(train: DataFrame, features: Sequence[str] = FEATURES, **settings) -> PipelineModel:
    """Linear SVM whose margin is turned into a probability by a logistic fit."""
    rows = train.count()
    settings.setdefault("regParam", 1.0 / max(1, rows))
    margin = LinearSVC(rawPredictionCol="margin", **{"standardization": False, **settings})
    to_probability = LogisticRegression(
        featuresCol="margin", predictionCol="margin_prediction", rawPredictionCol="margin_raw"
    )
    return _fit(train, [margin, to_probability], features, rows)


def fit_boosting(train: DataFrame, features: Sequence[str] = FEATURES, **settings) -> PipelineModel:
    return _fit(train, [GBTClassifier(seed=SEED, **{**BOOSTING, **settings})], features)


def fit_tree(train: DataFrame, features: Sequence[str] = FEATURES, **settings) -> PipelineModel:
    return _fit(train, [DecisionTreeClassifier(seed=SEED, **{**TREE, **settings})], features)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add ``prediction`` (int) and ``prob``, the probability of the positive class."""
    out = model.transform(rows)
    return out.select(
        *rows.columns,
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("prob"),
    )


def importances(model: PipelineModel) -> DataFrame:
    """Feature importances by name, largest first."""
    names = model.stages[0].getInputCols()
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(names, weights)]
    table = SparkSession.active().createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature")


def grid_search(train: DataFrame, classifier, grid: dict[str, list], folds: int = 5,
                features: Sequence[str] = FEATURES, parallelism: int = 4) -> tuple[PipelineModel, DataFrame]:
    """Cross-validated accuracy of every setting, with the best refitted model."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(classifier.getParam(name), values)
    maps = builder.build()
    train = train.select(*features, "label").persist()
    search = CrossValidator(
        estimator=Pipeline(stages=[_assembler(features), classifier]),
        estimatorParamMaps=maps,
        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"),
        numFolds=folds,
        seed=SEED,
        parallelism=parallelism,
    ).fit(train)
    train.unpersist()
    rows = [
        ({p.name: str(v) for p, v in m.items()}, float(mean), float(std))
        for m, mean, std in zip(maps, search.avgMetrics, search.stdMetrics)
    ]
    table = train.sparkSession.createDataFrame(
        rows, "params map<string,string>, mean_score double, std_score double"
    )
    best_first = W.orderBy(F.col("mean_score").desc())  # one row per grid point
    return search.bestModel, table.withColumn("rank", F.rank().over(best_first))


def evaluator_auc(scored: DataFrame) -> float:
    """MLlib's own ROC area, used to cross-check the rank formula."""
    return BinaryClassificationEvaluator(
        rawPredictionCol="prob", labelCol="label", metricName="areaUnderROC", numBins=0
    ).evaluate(scored)


def fit_forecast(seqs: DataFrame, reg: float = RIDGE, width: int = STEPS) -> np.ndarray:
    """Linear heads, one per output hour, over the input hours: ``(width + 1, width)``, constant first.

    All heads share one pass over the sequences and one factor of the normal equations.
    """
    return ridge(seqs, "inputs", "outputs", width, width, reg)


def forecast(heads: np.ndarray, seqs: DataFrame) -> DataFrame:
    """Add ``prediction``: the outputs of all heads; plain arithmetic, one pass."""
    def head(weights):
        products = F.zip_with("inputs", F.array(*[F.lit(float(w)) for w in weights[1:]]), lambda x, w: x * w)
        return F.aggregate(products, F.lit(float(weights[0])), lambda total, x: total + x)

    return seqs.withColumn("prediction", F.array(*[head(heads[:, h]) for h in range(heads.shape[1])]))


def fold_of(row_id: Column, folds: int = 5) -> Column:
    """Stable cross-validation fold by row id."""
    return (draw("fold", row_id) % folds).cast("int")
