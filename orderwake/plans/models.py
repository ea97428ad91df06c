"""Risk models on `pyspark.ml`. Feature frames should be read from a written table before fitting,
since every iteration of a fit scans them again."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lookup_join
from .features import LABEL, fitted_scaler, with_class_weights
from .metrics import SERIES

SEED = 42

# Rows that one partition of a tree fit holds at most, on average. A fit keeps its rows in memory, some 700 bytes each
# for a hundred trees, and a task reads its partition whole.
FIT_ROWS = 1_000_000

# Spark's setting of how many pieces a scan is cut into at least.
LEAST_PIECES = "spark.sql.files.minPartitionNum"


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


def _split(data: DataFrame) -> tuple[DataFrame, DataFrame]:
    return data.filter("not is_test"), data.filter("is_test")


def scored(model: PipelineModel, rows: DataFrame, label: str = LABEL) -> DataFrame:
    """All columns of `rows` plus label, prediction and the score of class 1."""
    transformed = model.transform(rows)
    return transformed.select(
        *rows.columns,
        F.col(label).alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("score"),
    )


def _partitions_wanted(train: DataFrame) -> int:
    """Partitions that a tree fit needs so that a task can hold each; 0 if the rows lie in as many already."""
    wanted = math.ceil(train.count() / FIT_ROWS)
    return 0 if wanted <= train.rdd.getNumPartitions() else wanted


def _in_fit_partitions(train: DataFrame, needed: Sequence[str], wanted: int) -> DataFrame:
    """Rows in partitions that a task can hold, in a stable order.

    Whole rows decide the place, so that rows with equal features are dealt out too, and only what the fit reads is moved.
    """
    placed = train.select(*needed, F.xxhash64(*train.columns).alias("_place"))
    return placed.repartition(wanted, "_place").sortWithinPartitions("_place", *needed)


@contextmanager
def _read_in_pieces(spark: SparkSession, pieces: int) -> Iterator[None]:
    """Scans inside are cut into at least so many pieces, if their files allow it.

    A written table is read in pieces by its bytes, which say little about its rows, but its files hold few rows each.
    """
    before = spark.conf.get(LEAST_PIECES, None)
    # Spark takes the number for a wish: it fills a piece until the next file would go beyond its share.
    spark.conf.set(LEAST_PIECES, str(2 * pieces))
    try:
        yield
    finally:
        spark.conf.unset(LEAST_PIECES) if before is None else spark.conf.set(LEAST_PIECES, before)


def _fit(estimator, features: Sequence[str], train: DataFrame) -> PipelineModel:
    assembler = _assembler(features)
    return PipelineModel([assembler, estimator.fit(assembler.transform(train))])


def _fit_trees(estimator, features: Sequence[str], train: DataFrame) -> PipelineModel:
    wanted = _partitions_wanted(train)
    if not wanted:
        return _fit(estimator, features, train)
    with _read_in_pieces(train.sparkSession, wanted):
        # The smaller pieces cost no shuffle. They are planned anew, since a frame that was planned keeps its own.
        pieces = train.select("*")
        if pieces.rdd.getNumPartitions() >= wanted:
            return _fit(estimator, features, pieces)
    weight = [estimator.getWeightCol()] if estimator.isSet("weightCol") else []
    return _fit(estimator, features, _in_fit_partitions(train, [*features, estimator.getLabelCol(), *weight], wanted))


def logistic_backorder(data: DataFrame, features: Sequence[str], label: str = LABEL) -> tuple[PipelineModel, DataFrame]:
    """Balanced logistic regression on standardised features; returns (model, scored test rows).

    The model standardises by itself: saved and loaded again, it scores plain feature rows.

    The penalty equals an unscaled L2 term with C = 1: the weights add up to the number of training
    rows and Spark divides the loss by them, so the parameter is one over that number.
    """
    train, test = _split(data)
    scaler = fitted_scaler(features, train)
    weighted = with_class_weights(scaler.transform(train), train, label)
    rows = train.count()
    estimator = LogisticRegression(
        labelCol=label,
        weightCol="weight",
        maxIter=1000,
        tol=1e-4,
        regParam=1.0 / max(rows, 1),
        elasticNetParam=0.0,
        standardization=False,
    )
    fitted = _fit(estimator, [f"{c}_scaled" for c in features], weighted)
    model = PipelineModel([scaler, *fitted.stages])
    return model, scored(model, test, label)


def forest_backorder(
    data: DataFrame, features: Sequence[str], label: str = LABEL, trees: int = 100, depth: int = 10, bootstrap: bool = True
) -> tuple[PipelineModel, DataFrame]:
    """Balanced random forest on the raw features; returns (model, scored test rows).

    Without `bootstrap` every tree is fitted on all rows and differs from the others by its features only.
    """
    train, test = _split(data)
    estimator = RandomForestClassifier(
        labelCol=label,
        weightCol="weight",
        numTrees=trees,
        maxDepth=depth,
        featureSubsetStrategy="sqrt",
        seed=SEED,
        maxMemoryInMB=1024,
        bootstrap=bootstrap,
    )
    model = _fit_trees(estimator, features, with_class_weights(train, train, label))
    return model, scored(model, test, label)


def gbt_backorder(
    data: DataFrame, features: Sequence[str], label: str = LABEL, iterations: int = 20, depth: int = 5
) -> tuple[PipelineModel, DataFrame]:
    """Balanced gradient-boosted trees; returns (model, scored test rows)."""
    train, test = _split(data)
    estimator = GBTClassifier(labelCol=label, weightCol="weight", maxIter=iterations, maxDepth=depth, seed=SEED)
    model = _fit_trees(estimator, features, with_class_weights(train, train, label))
    return model, scored(model, test, label)


def magnitude_regression(
    data: DataFrame,
    features: Sequence[str],
    target: str = "backorder_units",
    boosted: bool = False,
    elastic_net: float = 0.5,
    penalty: float = 0.1,
) -> tuple[PipelineModel, DataFrame]:
    """Backorder magnitude by elastic net (ridge with elastic_net=0) or boosted trees."""
    train, test = _split(data)
    if boosted:
        estimator = GBTRegressor(labelCol=target, maxIter=20, maxDepth=5, seed=SEED)
    else:
        estimator = LinearRegression(labelCol=target, elasticNetParam=elastic_net, regParam=penalty, maxIter=1000)
    model = (_fit_trees if boosted else _fit)(estimator, features, train)
    return model, model.transform(test).select(*test.columns, "prediction")


def logistic_optimality(
    model: PipelineModel, train: DataFrame, features: Sequence[str], label: str = LABEL, bound: float = 1e-3
) -> DataFrame:
    """(coefficient, is_flat, n_rows, n_positive): is the penalised mean loss flat within `bound` at the fit?"""
    fitted = model.stages[-1]
    rows = with_class_weights(model.transform(train), train, label)
    miss = F.col("weight") * (vector_to_array("probability")[1] - F.col(label))
    inputs = {"intercept": F.lit(1.0), **{c: F.col(f"{c}_scaled") for c in features}}
    penalty = fitted.getRegParam()
    pull = {"intercept": 0.0, **{c: penalty * float(b) for c, b in zip(features, fitted.coefficients)}}
    return _flatness(rows, miss, inputs, pull, F.sum("weight"), bound, F.sum(F.col(label)))


def linear_optimality(
    model: PipelineModel, train: DataFrame, features: Sequence[str], target: str = "backorder_units", bound: float = 1e-3
) -> DataFrame:
    """The same for a linear model, whose inputs and target are scaled to unit deviation.

    With an absolute penalty the loss has a kink where a coefficient is zero; there it is flat if the slope without
    that penalty does not exceed it.
    """
    fitted = model.stages[-1]
    spread = train.agg(*(F.stddev_samp(c).alias(c) for c in (*features, target))).first()
    scale = {c: spread[c] or 1.0 for c in (*features, target)}
    rows = model.transform(train)
    miss = (F.col("prediction") - F.col(target)) / scale[target]
    inputs = {"intercept": F.lit(1.0), **{c: F.col(c) / scale[c] for c in features}}
    penalty, mixed = fitted.getRegParam() / scale[target], fitted.getElasticNetParam()
    pull, kink = {"intercept": 0.0}, {}
    for c, b in zip(features, map(float, fitted.coefficients)):
        pull[c] = penalty * ((1 - mixed) * b * scale[c] / scale[target] + mixed * ((b > 0) - (b < 0)))
        kink[c] = penalty * mixed if b == 0 else 0.0
    return _flatness(rows, miss, inputs, pull, F.count(F.lit(1)), bound, F.count_if(F.col(target) > 0), kink)


def _flatness(rows, miss, inputs, pull, weight, bound, positive, kink=None) -> DataFrame:
    """Per input: does the slope of the loss, with the penalty's pull, vanish (or stay within the penalty's kink)?"""
    kink = kink or {}
    slopes = (
        F.struct(F.lit(c).alias("coefficient"), (F.abs(F.sum(miss * x) / weight + F.lit(pull[c])) < bound + kink.get(c, 0.0)).alias("is_flat"))
        for c, x in inputs.items()
    )
    found = rows.agg(F.array(*slopes).alias("slopes"), F.count(F.lit(1)).alias("n_rows"), positive.cast("bigint").alias("n_positive"))
    return found.select(F.inline("slopes"), "n_rows", "n_positive")


def regression_metrics(predicted: DataFrame, model: str, target: str = "backorder_units") -> DataFrame:
    """One row: RMSE, MAE and R² on the predicted rows."""
    error = F.col("prediction") - F.col(target)
    return predicted.agg(
        F.lit(model).alias("model"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(target))).alias("r2"),
    )


def feature_importance(model: PipelineModel, data: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, importance) of a fitted tree model, most important first."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(w)) for f, w in zip(features, weights)]
    return data.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def saved_and_loaded(model: PipelineModel, path: str) -> PipelineModel:
    """The model as it comes back from its files."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def same_scores(model: PipelineModel, loaded: PipelineModel, rows: DataFrame, keys: Sequence[str], label: str = LABEL) -> DataFrame:
    """(keys, is_equal): do both models give the same prediction and score to a row, bit by bit?"""
    ours = scored(model, rows, label).select(*rows.columns, F.col("prediction").alias("_prediction"), F.col("score").alias("_score"))
    both = scored(loaded, ours, label)
    equal = (F.col("_prediction") == F.col("prediction")) & (F.col("_score") == F.col("score"))
    return both.select(*keys, equal.alias("is_equal"))


def at_risk_report(lines: DataFrame, coverage: DataFrame) -> DataFrame:
    """Per material and plant: is any line predicted to go on backorder, with coverage and stock."""
    plant = F.coalesce("plant_code", F.lit("")).alias("plant_code")
    predicted = lines.groupBy("client_id", "material_number", plant).agg(
        F.max("prediction").alias("predicted"), F.max("score").alias("risk_score")
    )
    known = coverage.select(*SERIES, "woc", "saleable_inventory")
    rows = lookup_join(predicted, known, SERIES, null_safe=True)
    answer = F.when(F.col("predicted") == 1, "Yes").otherwise("No")
    return rows.select(*SERIES, answer.alias("predicted_backorder"), "risk_score", "woc", "saleable_inventory")
