"""The log of published models."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer

from fareloom.plans.models import Trained
from fareloom.plans.registry import ModelLog


def made(name, r2, value):
    model = PipelineModel([SQLTransformer(statement=f"SELECT *, {value} AS prediction FROM __THIS__")])
    return Trained(name, model, {"n": 1, "mse": 1.0, "rmse": 1.0, "mae": 1.0, "r2": r2}, 0.1)


def test_versions_stages_and_aliases(spark, tmp_path):
    log = ModelLog(spark, str(tmp_path / "models"))
    assert log.versions().count() == 0
    assert log.publish(made("fare", 0.4, 0)) is None and log.publish(made("fare", None, 0)) is None
    assert [log.publish(made("fare", 0.9, n)) for n in (10, 20, 30)] == [1, 2, 3]
    assert log.publish(made("tip", 0.8, 1)) == 1
    log.mark("fare", 2, stage="production", alias="champion")
    log.mark("fare", 1, alias="challenger")
    one = spark.range(1)

    def value(wanted):
        version, model = log.load("fare", wanted)
        return version, model.transform(one).first()["prediction"]

    assert value("latest") == ("3", 30) and value("production") == ("2", 20) and value("@champion") == ("2", 20)
    assert value("1") == value("challenger") == ("1", 10)
    log.mark("fare", 3, alias="champion")  # the name moves on
    assert value("champion") == ("3", 30) and value("production") == ("2", 20)
    assert {(r.version, r.stage, r.alias) for r in log.versions().where("model = 'fare'").collect()} == {
        ("1", "staging", "challenger"), ("2", "production", None), ("3", "staging", "champion")
    }
    with pytest.raises(KeyError):
        log.load("fare", "nobody")
    with pytest.raises(KeyError):
        log.mark("fare", 9, stage="production")


def test_two_publishers_have_two_versions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "models")
    one, two = ModelLog(spark, path), ModelLog(spark, path)
    add = ModelLog._add

    def late(self, model, version, **event):
        if self is one:
            assert two.publish(made("fare", 0.9, 2)) == 2  # published while the first one is being saved
        add(self, model, version, **event)

    monkeypatch.setattr(ModelLog, "_add", late)
    assert one.publish(made("fare", 0.9, 1)) == 1
    assert sorted(r.version for r in two.versions().collect()) == ["1", "2"]


def test_a_publisher_that_dies_leaves_no_version(spark, tmp_path, monkeypatch):
    log = ModelLog(spark, str(tmp_path / "models"))
    log.publish(made("fare", 0.9, 1))
    monkeypatch.setattr(ModelLog, "_add", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        log.publish(made("fare", 0.9, 2))
    monkeypatch.undo()
    assert log.load("fare")[0] == "1" and log.publish(made("fare", 0.9, 3)) == 3
