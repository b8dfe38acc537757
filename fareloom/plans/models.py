"""Training, cross-validation, choice and storage of fare models."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom import schema as S
from fareloom.functions.features import zero_flags
from fareloom.operators.quality import target_filter
from fareloom.operators.sampling import train_test_split
from fareloom.operators.stats import regression_metrics
from fareloom.plans.encoder import FEATURES, TripEncoder, slot_names
from fareloom.plans.forest import Forest
from fareloom.plans.shallow import Boosted
from fareloom.session import dealt, ensure_checkpoint_dir

PREDICTION = "prediction"
R2_THRESHOLD = 0.5


@contextmanager
def cached(*tables: DataFrame) -> Iterator[None]:
    """Keep tables for the repeated passes of training, spilling to disk when they do not fit."""
    for t in tables:
        t.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield
    finally:
        for t in tables:
            t.unpersist()


# -- estimators -----------------------------------------------------------------------


def gbt(
    trees: int = 100, depth: int = 6, rate: float = 0.1, label: str = S.TARGET, seed: int = 42, **extra
) -> Boosted:
    """Boosted trees with squared error; for a large table they are grown on packed rows (``plans/shallow.py``).

    Rows find their node by walking the shallow trees: keeping and checkpointing node numbers takes longer.
    """
    return Boosted(
        featuresCol=FEATURES,
        labelCol=label,
        predictionCol=PREDICTION,
        maxIter=trees,
        maxDepth=depth,
        stepSize=rate,
        lossType="squared",
        seed=seed,
        checkpointInterval=10,
        **({"cacheNodeIds": depth > 10} | extra),
    )


def gbt_early_stop(
    trees: int = 100, depth: int = 20, validation: str = "is_validation", tolerance: float = 0.01, **kw
) -> Boosted:
    """Boosted trees on 0.8 of rows and columns that stop when validation error stalls."""
    return gbt(
        trees,
        depth,
        subsamplingRate=0.8,
        featureSubsetStrategy="0.8",
        validationIndicatorCol=validation,
        validationTol=tolerance,
        **kw,
    )


def forest(trees: int = 50, depth: int = 15, label: str = S.TARGET, seed: int = 42, **extra) -> Forest:
    """Random forest that may split on every column."""
    return Forest(FEATURES, label, PREDICTION, trees, depth, seed, **extra)


def linear(label: str = S.TARGET, **extra) -> LinearRegression:
    """Least squares, with a light ridge so that the one-hot slots need not be independent."""
    return LinearRegression(
        featuresCol=FEATURES, labelCol=label, predictionCol=PREDICTION, regParam=1e-6, **extra
    )


class LogTarget(Estimator):
    """Trains the inner estimator on ``log1p`` of the label and predicts on the plain scale."""

    def __init__(self, build: Callable[..., Estimator], label: str = S.TARGET, **params):
        super().__init__()
        self.label = label
        self.inner = build(label="log_label", **params)
        self.inner.setPredictionCol("log_prediction")

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        model = self.inner.fit(dataset.withColumn("log_label", F.log1p(F.col(self.label))))
        back = SQLTransformer(statement=f"SELECT *, expm1(log_prediction) AS {PREDICTION} FROM __THIS__")
        return PipelineModel([model, back])


def log_forest(**params) -> LogTarget:
    return LogTarget(forest, **params)


def estimators() -> dict[str, Estimator]:
    """The models compared by name."""
    return {
        "linear": linear(),
        "random_forest": forest(),
        "log_random_forest": log_forest(),
        "boosted_trees": gbt(),
    }


# -- one model ------------------------------------------------------------------------


def assemble(estimator: Estimator, encoder: TripEncoder | None = None) -> Pipeline:
    """Encoder and model as one pipeline, so each is only ever fitted on training rows."""
    return Pipeline(stages=[encoder or TripEncoder(), estimator])


def evaluate(scored: DataFrame, label: str = S.TARGET, prediction: str = PREDICTION) -> DataFrame:
    return regression_metrics(scored, label, prediction)


@dataclass(frozen=True)
class Trained:
    name: str
    model: PipelineModel
    metrics: dict[str, float]
    seconds: float

    def row(self) -> tuple:
        m = self.metrics
        return (self.name, m["n"], m["mse"], m["rmse"], m["mae"], m["r2"], self.seconds)


METRIC_SHAPE = "model string, n bigint, mse double, rmse double, mae double, r2 double, train_seconds double"


def train(
    name: str, estimator: Estimator, train_rows: DataFrame, test_rows: DataFrame, encoder: TripEncoder | None = None
) -> Trained:
    """Fit on the training rows, measure on the test rows."""
    ensure_checkpoint_dir(train_rows.sparkSession)
    start = time.monotonic()
    model = assemble(estimator, encoder).fit(train_rows)
    seconds = time.monotonic() - start
    return Trained(name, model, evaluate(model.transform(test_rows)).first().asDict(), seconds)


def metric_table(spark: SparkSession, trained: list[Trained]) -> DataFrame:
    """One row per model, best RMSE first; the size is the number of models."""
    return spark.createDataFrame([t.row() for t in trained], METRIC_SHAPE).orderBy("rmse", "model")


def compare(
    models: dict[str, Estimator], train_rows: DataFrame, test_rows: DataFrame, encoder: TripEncoder | None = None
) -> list[Trained]:
    """Train every named model on the same rows, encoded once."""
    ensure_checkpoint_dir(train_rows.sparkSession)
    encoder = encoder or TripEncoder()
    encoding = encoder.fit(train_rows)
    # Every level of every tree is a pass, as long as its largest task: each core gets an equal share of the rows.
    used = [*dict.fromkeys([*encoder.numeric, *encoder.categorical, S.TARGET])]
    x_train, x_test = (encoding.transform(dealt(t.select(*used))) for t in (train_rows, test_rows))
    x_train, x_test = x_train.select(FEATURES, S.TARGET), x_test.select(FEATURES, S.TARGET)
    out = []
    with cached(x_train, x_test):
        for name, estimator in models.items():
            start = time.monotonic()
            fitted = estimator.fit(x_train)
            seconds = time.monotonic() - start
            metrics = evaluate(fitted.transform(x_test)).first().asDict()
            out.append(Trained(name, PipelineModel([encoding, fitted]), metrics, seconds))
    return out


def best(trained: list[Trained]) -> Trained:
    return min(trained, key=lambda t: (t.metrics["rmse"], t.name))


def best_model(table: DataFrame) -> DataFrame:
    """The model with the smallest RMSE out of a metric table."""
    top = F.min_by(F.struct("model", "rmse", "mae", "r2"), F.struct("rmse", "model"))
    return table.agg(top.alias("top")).select("top.*")


def gate(table: DataFrame, threshold: float = R2_THRESHOLD) -> DataFrame:
    """Whether each model's R² reaches the threshold and it may be published."""
    passed = F.coalesce(F.col("r2") >= threshold, F.lit(False))
    return table.select(
        "model",
        "r2",
        F.lit(float(threshold)).alias("threshold"),
        passed.alias("passed"),
        F.when(passed, "publish").otherwise("skip").alias("decision"),
    )


def publish(trained: Trained, path: str, threshold: float = R2_THRESHOLD) -> bool:
    """Save the encoder and model as one pipeline if R² reaches the threshold."""
    if trained.metrics["r2"] is None or trained.metrics["r2"] < threshold:
        return False
    trained.model.write().overwrite().save(path)
    return True


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# -- data preparation -----------------------------------------------------------------


@dataclass(frozen=True)
class Prepared:
    encoder: TripEncoder
    encoding: PipelineModel
    train: DataFrame
    test: DataFrame


def prepare_training(
    t: DataFrame,
    key: str,
    target: str = S.TARGET,
    test_share: float = 0.2,
    seed: int = 42,
    style: str = "robust",
) -> Prepared:
    """Select what the table has, flag zeros, drop negative targets, split, fit on train only."""
    have = set(t.columns)
    numeric = [c for c in S.ANALYSIS_MODEL_NUMERIC if c in have]
    categorical = [c for c in S.MODEL_CATEGORICAL if c in have]
    flagged = zero_flags(t.select(key, target, *numeric, *categorical))
    numeric += [c for c in flagged.columns if c.endswith("_is_zero")]
    marked = train_test_split(target_filter(flagged, target), key, test_share, seed)
    train_rows, test_rows = marked.where("not is_test"), marked.where("is_test")
    encoder = TripEncoder(numeric, categorical, style)
    encoding = encoder.fit(train_rows)
    return Prepared(encoder, encoding, encoding.transform(train_rows), encoding.transform(test_rows))


# -- cross-validation -----------------------------------------------------------------


def cross_validate(
    estimator: Estimator,
    rows: DataFrame,
    fold: str = "fold",
    k: int = 5,
    encoder: TripEncoder | None = None,
    label: str = S.TARGET,
    parallelism: int = 2,
    prefit: bool = False,
) -> tuple[PipelineModel, DataFrame]:
    """Cross-validate over the given folds; return the refitted model and metrics per fold.

    The encoder is refitted inside every fold. ``prefit=True`` fits it once on all rows
    before the folds are cut, which lets a fold see its own validation rows.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    encoder = encoder or TripEncoder()
    first = None
    if prefit:
        first = encoder.fit(rows)
        rows = first.transform(rows)
    used = [FEATURES] if prefit else [*encoder.numeric, *encoder.categorical]
    rows = rows.select(*dict.fromkeys([*used, label, fold]))
    pipeline = Pipeline(stages=[estimator]) if prefit else assemble(estimator, encoder)
    with cached(rows):
        fitted = CrossValidator(
            estimator=pipeline,
            estimatorParamMaps=ParamGridBuilder().build(),
            evaluator=RegressionEvaluator(labelCol=label, predictionCol=PREDICTION, metricName="rmse"),
            numFolds=k,
            foldCol=fold,
            parallelism=parallelism,
            collectSubModels=True,
        ).fit(rows)
        found = []
        for i in range(k):
            scored = fitted.subModels[i][0].transform(rows.where(F.col(fold) == i))
            found.append((i, *evaluate(scored, label).first()))
    table = rows.sparkSession.createDataFrame(
        found, "fold int, n bigint, mse double, rmse double, mae double, r2 double"
    )
    model = fitted.bestModel
    return (PipelineModel([first, *model.stages]) if first is not None else model), table


def choose_by_cv(models: dict[str, Estimator], rows: DataFrame, **kw) -> tuple[str, PipelineModel, DataFrame]:
    """Cross-validate every named model over the same folds and pick the lowest mean RMSE.

    Returns its name, the model refitted on all rows, and (model, fold, metrics) rows.
    """
    tables, fitted, mean = None, {}, {}
    for name, estimator in models.items():
        fitted[name], table = cross_validate(estimator, rows, **kw)
        table = table.select(F.lit(name).alias("model"), "*")
        mean[name] = table.agg(F.avg("rmse")).first()[0]
        tables = table if tables is None else tables.unionByName(table)
    winner = min(mean, key=lambda n: (mean[n], n))
    return winner, fitted[winner], tables


# -- looking into a model -------------------------------------------------------------


def loss_curve(model: PipelineModel, train_rows: DataFrame, check_rows: DataFrame) -> DataFrame:
    """(iteration, train_loss, validation_loss) of a fitted pipeline that ends in boosted trees."""
    *head, trees = model.stages
    encode = PipelineModel(list(head))
    losses = [trees.evaluateEachIteration(encode.transform(t), "squared") for t in (train_rows, check_rows)]
    rows = [(i + 1, float(a), float(b)) for i, (a, b) in enumerate(zip(*losses))]
    return train_rows.sparkSession.createDataFrame(
        rows, "iteration int, train_loss double, validation_loss double"
    )


def feature_importance(model: PipelineModel, encoded: DataFrame) -> DataFrame:
    """(feature, importance, from_top, from_bottom) of a fitted tree model, best first."""
    trees = model.stages[-1]
    weights = trees.featureImportances.toArray()
    ranked = sorted(zip(slot_names(encoded), weights), key=lambda x: (-x[1], x[0]))
    rows = [(n, float(w), i + 1, len(ranked) - i) for i, (n, w) in enumerate(ranked)]
    return encoded.sparkSession.createDataFrame(
        rows, "feature string, importance double, from_top int, from_bottom int"
    ).orderBy("from_top")
