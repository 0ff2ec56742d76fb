"""Estimators, time-ordered evaluation, training and persistence."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import drop_missing_target
from ..operators.metrics import fold_summary, regression_metrics
from ..operators.ordinal import ORDINAL, TOTAL, expanding_folds, weekly_ordinal
from ..sources.staging import ensure_checkpoint_dir, stage
from ..spec import WEEKLY, SeriesSpec
from .matrix import CODE, FEATURES, MatrixPlan, add_codes, fit_codes, matrix_stages, plan_matrix

LABEL, PREDICTION, VALID = "label", "prediction", "validation"
# Fits that run at the same time: all five folds, the test and the final one.
FITS = 7
# Rows per partition of a training matrix. A model depends on how its rows are spread, so that follows from
# their number alone, not from cores, shuffle partitions or the files they are read from.
MATRIX_ROWS = 25_000
# From this many partitions on they hold more rows, up to the larger number: every level of every tree of every
# fit sends the driver a few kilobytes a partition.
MATRIX_PARTS, LARGE_ROWS = 64, 500_000
# Values of a feature that trees tell apart, at most.
BINS = 128

# Estimator settings per model type.
BOOSTED = {"stepSize": 0.05, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8",
           "lossType": "squared", "seed": 42}
MODELS = {
    "lightgbm": (GBTRegressor, 1000, {**BOOSTED, "maxDepth": 5}),
    "xgboost": (GBTRegressor, 1000, {**BOOSTED, "maxDepth": 7}),
    "catboost": (GBTRegressor, 1000, {"stepSize": 0.05, "maxDepth": 7, "lossType": "squared",
                                      "seed": 42}),
    "random_forest": (RandomForestRegressor, 500, {"maxDepth": 12, "minInstancesPerNode": 2,
                                                   "seed": 42}),
}


def initialize_model(model_type: str = "lightgbm", n_estimators: int | None = None, **settings):
    """An unfitted Spark ML regressor for one of the four model types; ``settings`` override its own."""
    if model_type not in MODELS:
        raise ValueError(f"unsupported model type: {model_type}")
    estimator, default_trees, own = MODELS[model_type]
    trees = n_estimators or default_trees
    size = {"maxIter": trees} if estimator is GBTRegressor else {"numTrees": trees}
    return estimator(featuresCol=FEATURES, labelCol=LABEL, predictionCol=PREDICTION,
                     **{"maxBins": BINS, "checkpointInterval": 10, **size, **own, **settings})


@dataclass
class SalesModel:
    """A fitted pipeline together with the dictionary of its text columns."""

    pipeline: PipelineModel
    dictionary: DataFrame

    @property
    def inputs(self) -> list[str]:
        return self.pipeline.stages[-2].getInputCols()

    def transform(self, df: DataFrame) -> DataFrame:
        texts = [c.removesuffix(CODE) for c in self.inputs if c.endswith(CODE)]
        return self.pipeline.transform(add_codes(df, self.dictionary, texts))


@dataclass
class TrainingResult:
    """What a training run produces; the metrics are small DataFrames."""

    model: SalesModel
    inputs: list[str]
    fold_metrics: DataFrame
    cv_summary: DataFrame
    test_metrics: DataFrame
    trees: int
    error_curve: list[float] | None = None


@dataclass
class TrainingMatrix:
    """Vectors with their chronological position, written to the shared folder."""

    rows: DataFrame
    total: int
    preparation: PipelineModel
    dictionary: DataFrame
    plan: MatrixPlan


def matrix_parts(total: int) -> int:
    """How many partitions a training matrix of ``total`` rows has."""
    return max(1, min(-(-total // MATRIX_ROWS), max(MATRIX_PARTS, -(-total // LARGE_ROWS))))


def prepare_training_data(df: DataFrame, target: str = "quantity", spec: SeriesSpec = WEEKLY,
                          strict_features: bool = False, stored: bool = False) -> TrainingMatrix:
    """Rows with a target, as vectors in chronological order.

    ``stored`` says that ``df`` is read straight from a table. Any other frame is staged first, because
    it is read several times here.
    """
    known = drop_missing_target(df, target)
    if not stored:
        known = stage(known, "training-rows")
    plan = plan_matrix(known, target, strict_features)
    dictionary = fit_codes(known, plan.coded)
    numbered = add_codes(weekly_ordinal(known, spec), dictionary, plan.coded)
    preparation = matrix_stages(plan).fit(numbered)
    rows = stage(
        preparation.transform(numbered)
        .select(ORDINAL, TOTAL, F.col(target).cast("double").alias(LABEL), FEATURES),
        "training-matrix")
    total = rows.agg(F.max(TOTAL)).first()[0] or 0
    spread = rows.drop(TOTAL).repartition(matrix_parts(total), ORDINAL)
    return TrainingMatrix(spread.sortWithinPartitions(ORDINAL), total, preparation, dictionary, plan)


def side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], object]], at_once: int) -> list:
    """The results of the jobs, of which ``at_once`` run together, each in a scheduler pool of its own.

    Under fair scheduling they share the cores task by task, so a fit fills the gaps of the others.
    """
    def in_pool(number: int, job: Callable[[], object]) -> object:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{number}")
        return job()

    with ThreadPoolExecutor(max(1, min(at_once, len(jobs)))) as threads:
        started = [threads.submit(inheritable_thread_target(spark)(in_pool), i, job) for i, job in enumerate(jobs)]
        return [s.result() for s in started]


def evaluate_model(estimator, rows: DataFrame, total: int, cv: int = 5, at_once: int = FITS) -> DataFrame:
    """Metrics of each expanding fold over the first ``total`` rows; one fit serves them all.

    The folds are fitted at the same time. ``rows`` is read by each, so it should be kept or stored.
    """
    jobs = [_fold_job(estimator, rows, fold) for fold in expanding_folds(total, cv)]
    return _fold_table(side_by_side(rows.sparkSession, jobs, at_once))


def _fold_job(estimator, rows: DataFrame, fold) -> Callable[[], DataFrame]:
    def job() -> DataFrame:
        train = rows.filter(F.col(ORDINAL) <= fold.train_end)
        test = rows.filter((F.col(ORDINAL) > fold.train_end) & (F.col(ORDINAL) <= fold.test_end))
        metrics = regression_metrics(estimator.fit(train).transform(test), LABEL, PREDICTION)
        return stage(metrics.select(F.lit(fold.number).alias("fold"), "*"), f"fold-{fold.number}")
    return job


def _fold_table(parts: list[DataFrame]) -> DataFrame:
    folds = parts[0]
    for part in parts[1:]:
        folds = folds.unionByName(part)
    return stage(folds.coalesce(1), "fold-metrics")  # one row per fold


def measured_trees(estimator, train: DataFrame, valid: DataFrame, tolerance: float) -> tuple[int, list[float]]:
    """How many trees are worth fitting, and the mean squared error on ``valid`` for 1, 2, .. trees.

    One fit decides. A booster stops when a tree lowers the error by less than ``tolerance`` of it; a forest
    is as large as the first size whose double is not better by that share. The estimator's own number of
    trees is the most that is tried.
    """
    if isinstance(estimator, GBTRegressor):
        both = train.withColumn(VALID, F.lit(False)).unionByName(valid.withColumn(VALID, F.lit(True)))
        model = estimator.copy({estimator.validationIndicatorCol: VALID,
                                estimator.validationTol: tolerance}).fit(both)
        return model.getNumTrees, model.evaluateEachIteration(valid, "squared")
    model = estimator.fit(train)
    predictions = valid.select(LABEL, FEATURES)
    for i, tree in enumerate(model.trees):
        predictions = tree.setPredictionCol(f"_tree{i}").transform(predictions)
    total, errors = F.lit(0.0), []
    for i in range(model.getNumTrees):
        total = total + F.col(f"_tree{i}")
        errors.append(F.avg(F.pow(F.col(LABEL) - total / F.lit(i + 1.0), F.lit(2.0))).alias(f"e{i}"))
    curve = list(predictions.agg(*errors).first())
    size = 1
    while 2 * size <= len(curve) and curve[size - 1] - curve[2 * size - 1] >= tolerance * curve[size - 1]:
        size *= 2
    return size, curve


def train_model(df: DataFrame, target: str = "quantity", model_type: str = "lightgbm", cv: int = 5,
                test_size: float = 0.2, n_estimators: int | None = None,
                strict_features: bool = False, spec: SeriesSpec = WEEKLY, stored: bool = False,
                tolerance: float | None = None, at_once: int = FITS, **settings) -> TrainingResult:
    """Cross-validate on the training part, measure on the rest, then fit on all rows.

    With a ``tolerance`` the number of trees is measured first, on the last block of the training part
    (``measured_trees``), up to ``n_estimators``. All other fits run at the same time, ``at_once`` of them,
    on one matrix that is moved to its place once and kept on the executors' disks meanwhile.
    """
    spark = df.sparkSession
    estimator = initialize_model(model_type, n_estimators, **settings)
    ensure_checkpoint_dir(spark)
    matrix = prepare_training_data(df, target, spec, strict_features, stored)
    rows = matrix.rows.persist(StorageLevel.DISK_ONLY)
    train_end = int(matrix.total * (1 - test_size))
    folds = expanding_folds(train_end, cv)
    curve = None
    try:
        if tolerance is not None:
            known = rows.filter(F.col(ORDINAL) <= folds[-1].train_end)
            valid = rows.filter((F.col(ORDINAL) > folds[-1].train_end) & (F.col(ORDINAL) <= train_end))
            trees, curve = measured_trees(estimator, known, valid, tolerance)
            estimator = initialize_model(model_type, trees, **settings)

        def on_test() -> DataFrame:
            model = estimator.fit(rows.filter(F.col(ORDINAL) <= train_end))
            test = rows.filter(F.col(ORDINAL) > train_end)
            return stage(regression_metrics(model.transform(test), LABEL, PREDICTION), "test-metrics")

        final, test_metrics, *parts = side_by_side(
            spark, [lambda: estimator.fit(rows), on_test, *[_fold_job(estimator, rows, f) for f in folds]], at_once)
    finally:
        rows.unpersist()
    fold_metrics = _fold_table(parts)
    model = SalesModel(PipelineModel(stages=[*matrix.preparation.stages, final]), matrix.dictionary)
    return TrainingResult(model, matrix.plan.inputs, fold_metrics, fold_summary(fold_metrics),
                          test_metrics, final.getNumTrees, curve)


def feature_importance(model: SalesModel) -> DataFrame:
    """``feature, importance`` in descending order, for a fitted model."""
    weights = model.pipeline.stages[-1].featureImportances.toArray()
    rows = [(name, float(weight)) for name, weight in zip(model.inputs, weights, strict=True)]
    return model.dictionary.sparkSession.createDataFrame(
        rows, "feature string, importance double").orderBy(F.col("importance").desc(), F.col("feature"))


def save_model(model: SalesModel, path: str) -> str:
    """The pipeline and the dictionary, side by side."""
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    model.dictionary.write.mode("overwrite").parquet(f"{path}/categories")
    return path


def load_model(spark: SparkSession, path: str) -> SalesModel:
    return SalesModel(PipelineModel.load(f"{path}/pipeline"), spark.read.parquet(f"{path}/categories"))
