"""Training, choice, storage, scoring and streaming, on small models."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom import schema as S
from fareloom.functions import features as X
from fareloom.functions.rules import accepted, validate_requests
from fareloom.operators import sampling as R
from fareloom.operators import stats as A
from fareloom.plans import models as M
from fareloom.plans import scoring as C
from fareloom.plans.encoder import TripEncoder
from fareloom.sources import requests as J
from fareloom.streaming.scorer import read_scored, stream_scores
from tests.conftest import rows

KEY = "trip_id"


@pytest.fixture(scope="module")
def features(sample):
    used = [KEY, S.TARGET, *S.MODEL_NUMERIC, *S.MODEL_CATEGORICAL]
    t = R.train_test_split(X.features_v1(sample).where("total_amount >= 0").select(*used), KEY).cache()
    t.count()
    return t


@pytest.fixture(scope="module")
def parts(features):
    return features.where("not is_test"), features.where("is_test")


@pytest.fixture(scope="module")
def boosted(parts):
    return M.train("boosted", M.gbt(trees=4, depth=4, rate=0.5), *parts)


def test_boosted_trees_beat_a_line_on_duration(parts, boosted):
    line = A.fit_line(parts[0], "trip_duration_minutes")
    base = A.regression_metrics(A.apply_line(parts[1], line)).first()
    assert boosted.metrics["r2"] > base["r2"]
    assert boosted.metrics["n"] == parts[1].count()


def test_same_seed_same_model(parts, boosted):
    again = M.train("boosted", M.gbt(trees=4, depth=4, rate=0.5), *parts)
    assert again.metrics["rmse"] == pytest.approx(boosted.metrics["rmse"], rel=1e-9)


def test_save_load_and_gate(spark, parts, boosted, tmp_path):
    path = str(tmp_path / "model")
    assert not M.publish(boosted, path, threshold=1.1)
    assert M.publish(boosted, path, threshold=0.0)
    loaded = M.load(path)
    a = boosted.model.transform(parts[1]).select(KEY, "prediction")
    b = loaded.transform(parts[1]).select(KEY, "prediction")
    assert sorted(rows(a)) == sorted(rows(b))


def test_comparison_and_choice(spark, parts):
    models = {"linear": M.linear(), "log_forest": M.log_forest(trees=2, depth=4)}
    found = M.compare(models, *parts)
    table = M.metric_table(spark, found)
    assert [r["model"] for r in table.collect()] == sorted(models, key=lambda n: next(f.metrics["rmse"] for f in found if f.name == n))
    assert M.best_model(table).first()["model"] == M.best(found).name
    decisions = {r["model"]: r["decision"] for r in M.gate(table, 0.5).collect()}
    assert decisions["linear"] == "publish"
    for f in found:
        assert f.model.transform(parts[1]).where(F.col("prediction").isNull()).count() == 0


@pytest.mark.parametrize("prefit", [False, True])
def test_cross_validation_measures_every_row_once(parts, prefit):
    folds = R.kfold(parts[0], KEY, 3)
    model, table = M.cross_validate(M.linear(), folds, k=3, prefit=prefit)
    assert sum(r["n"] for r in table.collect()) == parts[0].count()
    assert A.cv_summary(table).first()["avg_r2"] > 0.5
    assert "prediction" in model.transform(parts[1]).columns


def test_choice_by_cross_validation(parts):
    models = {"plain": M.linear(), "flat": M.linear().setRegParam(1e6)}
    name, model, table = M.choose_by_cv(models, R.kfold(parts[0], KEY, 2), k=2)
    assert name == "plain" and table.count() == 4
    assert M.evaluate(model.transform(parts[1])).first()["r2"] > 0.5


def test_early_stopping_uses_the_validation_rows(parts):
    marked = R.train_test_split(parts[0], KEY, 0.2, "v", name="is_validation")
    x = TripEncoder().fit(parts[0]).transform(marked)
    model = M.gbt_early_stop(trees=6, depth=3, tolerance=5.0).fit(x)
    assert 1 <= model.getNumTrees < 6


def test_loss_falls_and_importances_sum_to_one(parts, boosted):
    curve = [r["train_loss"] for r in M.loss_curve(boosted.model, *parts).collect()]
    assert len(curve) == 4 and curve[-1] < curve[0]
    encoded = boosted.model.stages[0].transform(parts[0])
    table = M.feature_importance(boosted.model, encoded).collect()
    assert sum(r["importance"] for r in table) == pytest.approx(1.0)
    assert [r["from_top"] for r in table] == list(range(1, len(table) + 1))


def test_prepare_fits_on_training_rows_only(sample):
    wide = X.features_analysis(sample)
    ready = M.prepare_training(wide, KEY)
    assert ready.train.where("total_amount < 0").count() == 0
    assert ready.train.join(ready.test, KEY).count() == 0
    kept = sample.where("total_amount >= 0").count()
    assert ready.train.count() + ready.test.count() == kept
    assert "trip_distance_is_zero" in ready.encoder.numeric


def test_batch_scoring_keeps_the_input(spark, sample, boosted, tmp_path):
    given = sample.drop(S.TARGET)
    scored = C.score_batch(given, boosted.model)
    assert scored.columns == [*given.columns, S.PREDICTED]
    assert scored.drop(S.PREDICTED).exceptAll(given).count() == 0
    n = C.write_scored(given, boosted.model, str(tmp_path / "s"))
    assert n == given.count() == spark.read.parquet(str(tmp_path / "s")).count()
    with pytest.raises(S.MissingColumns):
        C.score_batch(given.drop("RatecodeID"), boosted.model)


def test_stream_equals_batch(spark, sample, boosted, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    sent = J.requests_from_trips(sample).withColumn(
        "VendorID", F.when(F.col("fare_amount") > 50, 7).otherwise(F.col("VendorID"))
    )
    J.write_requests(sent, source)
    ids = (T.StructField(KEY, T.StringType()),)
    stream_scores(spark, source, out, boosted.model, "3", mark, ids, once=True).awaitTermination()
    columns = [KEY, "predicted_fare", "trip_duration_minutes", "model_version"]
    streamed = read_scored(spark, out).select(*columns)
    checked = validate_requests(J.read_requests(spark, source, extra=ids))
    batch = C.score_requests(accepted(checked), boosted.model, "3", (KEY,)).select(*columns)
    assert sorted(rows(streamed)) == sorted(rows(batch))
    assert read_scored(spark, out, "rejected").count() + streamed.count() == sent.count()
    assert streamed.where("predicted_fare < 0").count() == 0

    # A second run finds nothing new; new files are picked up where it left off.
    stream_scores(spark, source, out, boosted.model, "3", mark, ids, once=True).awaitTermination()
    assert read_scored(spark, out).count() == streamed.count()
    sent.limit(10).write.mode("append").json(source)
    stream_scores(spark, source, out, boosted.model, "3", mark, ids, once=True).awaitTermination()
    total = read_scored(spark, out).count() + read_scored(spark, out, "rejected").count()
    assert total == sent.count() + 10


def test_prediction_timestamp_is_utc_text(spark, sample, boosted):
    checked = validate_requests(J.with_request_defaults(J.requests_from_trips(sample.limit(20))))
    stamp = C.score_requests(checked, boosted.model, "1").first()["prediction_timestamp"]
    assert stamp.endswith("+00:00") and "T" in stamp


def test_shallow_boosting_keeps_no_node_numbers_and_gives_the_same_trees(parts):
    train_rows, test_rows = parts
    one, other = M.gbt(trees=2, depth=3), M.gbt(trees=2, depth=3, cacheNodeIds=True)
    assert not one.getCacheNodeIds() and not M.gbt().getCacheNodeIds() and M.gbt_early_stop().getCacheNodeIds()
    a, b = (M.assemble(e).fit(train_rows).stages[-1].toDebugString.split("\n", 1)[1] for e in (one, other))
    assert a == b
