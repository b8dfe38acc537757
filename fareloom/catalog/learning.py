"""Queries: trained models, scoring and the stream.

Models have the library's full sizes and learn from the whole table. Each is trained once per
application and folder, and all queries that need it share that fit. One query trains less and says so:
cross-validation.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom import schema as S
from fareloom.catalog.modelling import KEY, model_rows, planted_requests
from fareloom.catalog.registry import query, rounded
from fareloom.functions.rules import accepted, validate_requests
from fareloom.operators import sampling as R
from fareloom.operators.quality import target_filter
from fareloom.plans import boosting as B
from fareloom.plans import models as M
from fareloom.plans import scoring as C
from fareloom.plans.encoder import TripEncoder
from fareloom.session import scratch_path
from fareloom.sources import requests as J
from fareloom.sources.tables import trips
from fareloom.streaming.scorer import read_scored, stream_scores


def split_rows(spark, d):
    t = target_filter(model_rows(spark, d))
    return t.where("not is_test"), t.where("is_test")


_fits: dict[tuple[str, str, str], M.Trained] = {}


def trained(spark, d, name) -> M.Trained:
    """One of ``M.estimators()``, fitted on the training rows and measured on the test rows."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _fits:
        (_fits[key],) = M.compare({name: M.estimators()[name]}, *split_rows(spark, d))
    return _fits[key]


def fitted_model(spark, d) -> PipelineModel:
    return trained(spark, d, "boosted_trees").model


def stored_model(spark, d) -> PipelineModel:
    """The same, published and loaded again as a separate scoring job would."""
    path = scratch_path(spark, "model")
    M.publish(trained(spark, d, "boosted_trees"), path, threshold=0.0)
    return M.load(path)


def training_query(query_name, name):
    @query(query_name)
    def run(spark, d):
        return M.metric_table(spark, [trained(spark, d, name)]).drop("train_seconds")

    return run


training_query("train_linear", "linear")
training_query("train_gbt", "boosted_trees")
training_query("train_rf", "random_forest")
training_query("train_rf_log", "log_random_forest")


#: Edges of the bins in the two queries that show how a tree splits.
SHOWN_EDGES = {
    "trip_distance": [0.0, 1.0, 2.5, 5.0, 7.5, 10.0, 15.0],
    "tip_amount": [-1.0, 0.0, 0.5, 1.0, 2.0, 3.0],
    "tolls_amount": [-1.0, 0.0, 5.0],
    "passenger_count": [0.0, 1.0, 2.0, 3.0],
}


def shown_cells(spark, d):
    given = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in SHOWN_EDGES])
    t = trips(spark, d).select(given.alias("x"), S.TARGET, KEY)
    stored = B.binned(t, "x", list(SHOWN_EDGES.values()), S.TARGET, None, KEY)
    return B.histogram(stored, B.Tree(), [0], range(len(SHOWN_EDGES)), [], B.Settings(rows=1.0, columns=1.0), 0)


@query("boost_histogram")
def boost_histogram(spark, d):
    """What a boosted tree knows of its root: gradients and rows per feature and bin, over all trips."""
    return rounded(shown_cells(spark, d).select("feature", "bin", F.col("g").alias("gradient"), F.col("h").cast("long").alias("rows")), 4)


@query("boost_first_split")
def boost_first_split(spark, d):
    """The root's split, and the values of its two leaves before the learning rate."""
    top = B.best_splits(shown_cells(spark, d))
    left = -F.col("left_g") / (F.col("left_h") + 1)
    right = -(F.col("g") - F.col("left_g")) / (F.col("h") - F.col("left_h") + 1)
    shown = top.select("feature", "bin", "gain", F.col("left_h").cast("long").alias("left_rows"), left.alias("left_value"), right.alias("right_value"))
    return rounded(shown, 4)


_boosted: dict[tuple[str, str], tuple[B.Booster, DataFrame]] = {}


def boosted_es(spark, d) -> tuple[B.Booster, DataFrame]:
    """Full settings (up to 100 trees of depth 20, patience of 10), and the encoded test rows.

    A fifth of the training rows is for validation; the encoder does not see it.
    """
    key = (spark.sparkContext.applicationId, d)
    if key not in _boosted:
        train_rows, test_rows = split_rows(spark, d)
        marked = R.train_test_split(train_rows, KEY, 0.2, "validation", name="is_validation")
        encoding = TripEncoder().fit(marked.where("not is_validation"))
        x = encoding.transform(marked).select("features", S.TARGET, "is_validation", KEY)
        _boosted[key] = B.fit(x, keep=(KEY,)), encoding.transform(test_rows)
    return _boosted[key]


@query("train_gbt_es")
def train_gbt_es(spark, d):
    """Test metrics of the trees up to the best one on the validation rows, and how many these are."""
    model, test_rows = boosted_es(spark, d)
    return M.evaluate(model.transform(test_rows)).withColumn("trees", F.lit(len(model.trees)))


@query("boost_curve")
def boost_curve(spark, d):
    """Errors after every tree that was tried, and whether the model keeps it."""
    return boosted_es(spark, d)[0].loss_table(spark)


@query("model_table")
def model_table(spark, d):
    return M.metric_table(spark, [trained(spark, d, name) for name in M.estimators()]).drop("train_seconds")


@query("best_model")
def best_model(spark, d):
    return M.best_model(model_table(spark, d))


@query("gate")
def gate(spark, d):
    return M.gate(model_table(spark, d), threshold=0.75)


@query("cross_validate")
def cross_validate(spark, d):
    """Metrics per fold over stratified folds, the encoder refitted inside each fold.

    All five folds, of the linear model only; the boosted trees would be fitted six times.
    """
    train_rows, _ = split_rows(spark, d)
    folds = R.stratified_folds(train_rows, KEY, k=5)
    _, table = M.cross_validate(M.linear(), folds, k=5)
    return table


@query("loss_curve")
def loss_curve(spark, d):
    return M.loss_curve(fitted_model(spark, d), *split_rows(spark, d))


@query("feature_importance")
def feature_importance(spark, d):
    train_rows, _ = split_rows(spark, d)
    one = trained(spark, d, "random_forest")
    encoded = one.model.stages[0].transform(train_rows)
    return M.feature_importance(one.model, encoded).where("from_top <= 20 or from_bottom <= 10")


@query("score_batch")
def score_batch(spark, d):
    """The table written by the batch scorer: every input column and the prediction."""
    model = stored_model(spark, d)
    path = scratch_path(spark, "scored")
    C.write_scored(trips(spark, d).drop(S.TARGET), model, path)
    return spark.read.parquet(path)


@query("pred_vs_actual")
def pred_vs_actual(spark, d):
    model = fitted_model(spark, d)
    return C.pred_vs_actual(C.score_batch(trips(spark, d), model), (KEY,))


@query("score_requests")
def score_requests(spark, d):
    good = accepted(validate_requests(planted_requests(spark, d)))
    scored = C.score_requests(good, fitted_model(spark, d), "1", (KEY,))
    return scored.drop("prediction_timestamp")


@query("run_metrics")
def run_metrics(spark, d):
    """What a training and a scoring run leave in the metrics table."""
    _, test_rows = split_rows(spark, d)
    one = trained(spark, d, "boosted_trees")
    path = scratch_path(spark, "metrics")
    table = M.metric_table(spark, [one]).drop("train_seconds")
    C.append_metrics(C.model_metrics(table, "run-1", "1"), path)
    scored = one.model.transform(test_rows).select(F.col(M.PREDICTION).alias(S.PREDICTED))
    C.append_metrics(C.run_metrics(scored, "run-1", "boosted_trees", "1"), path)
    return C.read_metrics(spark, path)


@query("stream_score")
def stream_score(spark, d):
    """Requests worked off by the stream, read back from its sinks with the reject count."""
    source, out, mark = (scratch_path(spark, n) for n in ("stream-in", "stream-out", "stream-mark"))
    J.write_requests(planted_requests(spark, d), source)
    run = stream_scores(
        spark, source, out, fitted_model(spark, d), "1", mark, (T.StructField(KEY, T.StringType()),), once=True
    )
    run.awaitTermination()
    scored = read_scored(spark, out).select(KEY, "predicted_fare", "trip_duration_minutes", "model_version")
    bad = read_scored(spark, out, "rejected").agg(F.count(F.lit(1))).scalar()
    return scored.withColumn("rejected_in_run", bad)
