"""Published models and their versions.

A log beside the models has one entry per event: a version was published, put into a stage, or given an alias. Entries
are never changed, and their numbers, like those of versions, are claimed by creating a file that must not exist, so
two publishers never share one. What holds now is what the last entry says.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from fareloom.plans.models import R2_THRESHOLD, Trained
from fareloom.plans.scoring import resolve_version
from fareloom.sources.versions import Store

SHAPE = "model string, version string, stage string, alias string, r2 double, rmse double"


class ModelLog:
    """Models under a folder that every executor reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._events = Store(spark, f"{self.path}/_log")

    def _folder(self, model: str, version: int) -> str:
        return f"{self.path}/{model}/v{version}"

    def publish(self, trained: Trained, threshold: float = R2_THRESHOLD, stage: str = "staging") -> int | None:
        """Save the pipeline as the model's next version if R² reaches the threshold; the version, or none.

        The version shows only when the model is complete.
        """
        r2 = trained.metrics["r2"]
        if r2 is None or r2 < threshold:
            return None
        version = Store(self.spark, f"{self.path}/{trained.name}").claim() + 1
        trained.model.write().save(self._folder(trained.name, version))
        self._add(trained.name, version, event="published", stage=stage, r2=r2, rmse=trained.metrics["rmse"])
        return version

    def _add(self, model: str, version: int, **event) -> None:
        self._events.publish({}, entry={"model": model, "version": version, **event})

    def _known(self) -> dict[tuple[str, int], dict]:
        found: dict[tuple[str, int], dict] = {}
        for number in self._events.numbers():
            entry = self._events.manifest(number)["entry"]
            key = entry["model"], entry["version"]
            if entry["event"] == "published":
                found[key] = entry
                continue
            if "alias" in entry:  # an alias names one version of a model
                for (model, _), other in found.items():
                    if model == entry["model"] and other.get("alias") == entry["alias"]:
                        other["alias"] = None
            found[key] |= {k: entry[k] for k in ("stage", "alias") if k in entry}
        return found

    def mark(self, model: str, version: int, stage: str | None = None, alias: str | None = None) -> None:
        """Put a version into a stage, give it an alias, or both."""
        if (model, version) not in self._known():
            raise KeyError(f"{model} has no version {version}")
        given = {k: v for k, v in (("stage", stage), ("alias", alias)) if v is not None}
        self._add(model, version, event="marked", **given)

    def versions(self) -> DataFrame:
        """(model, version, stage, alias, r2, rmse), as ``resolve_version`` takes it."""
        rows = [(m, str(v), e.get("stage"), e.get("alias"), e["r2"], e["rmse"]) for (m, v), e in self._known().items()]
        return self.spark.createDataFrame(rows, SHAPE)

    def load(self, model: str, wanted: str = "latest") -> tuple[str, PipelineModel]:
        """The version that a name stands for, and its pipeline."""
        found = resolve_version(self.versions().where(f"model = '{model}'"), wanted).first()
        if found is None:
            raise KeyError(f"{model} has no version {wanted}")
        return found["version"], PipelineModel.load(self._folder(model, int(found["version"])))
