"""Scoring requests as they arrive.

The stream runs the batch functions unchanged. It keeps no state, so there is nothing to
expire; each micro-batch is parsed and validated once and goes to three places: scored
requests, rejected requests with their broken rules, and a row of prediction statistics.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fareloom.functions.rules import accepted, rejected, validate_requests
from fareloom.plans.scoring import run_metrics, score_requests
from fareloom.sources.requests import read_requests
from fareloom.sources.versions import Store


def score_micro_batch(
    batch: DataFrame,
    batch_id: int,
    model: PipelineModel,
    version: str,
    out: str,
    ids: tuple[str, ...] = (),
    strict: bool = False,
) -> None:
    """Write one micro-batch as version ``batch_id`` of the store at ``out``.

    Its three parts become visible together; a batch that is repeated after that changes nothing, and what one that
    died before left behind is never read.
    """
    checked = validate_requests(batch, strict).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        parts = {
            "scored": score_requests(accepted(checked), model, version, ids),
            "rejected": rejected(checked),
            "metrics": lambda written: run_metrics(written["scored"], f"batch-{batch_id}", "stream", version, "predicted_fare"),
        }
        Store(batch.sparkSession, out).publish(parts, number=batch_id)
    finally:
        checked.unpersist()


def stream_scores(
    spark: SparkSession,
    source: str,
    out: str,
    model: PipelineModel,
    version: str,
    checkpoint: str,
    ids: tuple[T.StructField, ...] = (),
    strict: bool = False,
    once: bool = False,
    every: str = "10 seconds",
) -> StreamingQuery:
    """Start scoring the JSON files that appear in ``source``.

    ``once`` works off what is there and stops; otherwise a batch starts every interval.
    ``checkpoint`` must be a shared folder: after a restart the stream goes on from it.
    """
    requests = read_requests(spark, source, stream=True, extra=ids)
    names = tuple(f.name for f in ids)

    def sink(batch: DataFrame, batch_id: int) -> None:
        score_micro_batch(batch, batch_id, model, version, out, names, strict)

    writer = requests.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start()


def read_scored(spark: SparkSession, out: str, what: str = "scored") -> DataFrame:
    """Everything the stream has committed so far: ``scored``, ``rejected`` or ``metrics``."""
    return Store(spark, out).read_all(what)
