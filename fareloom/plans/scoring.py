"""Scoring batches and requests, and recording what a run did."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fareloom import schema as S
from fareloom.functions.exprs import minutes_between
from fareloom.functions.features import features_v1
from fareloom.functions.rules import parsed_time
from fareloom.operators.profile import n_rows, prediction_stats
from fareloom.plans.models import PREDICTION
from fareloom.sources.requests import CHARGE_DEFAULTS
from fareloom.sources.versions import Store, replace_folder


class RowCountChanged(RuntimeError):
    """Scoring returned more or fewer rows than it was given."""


# -- batches --------------------------------------------------------------------------


def score_batch(
    t: DataFrame, model: PipelineModel, basis: str = "fare", name: str = S.PREDICTED
) -> DataFrame:
    """All input columns and the prediction, by projection only: rows keep their identity.

    The inputs travel inside one struct while the features are built, so filling a feature
    never changes the column it was made from.
    """
    S.require_columns(t)
    held = t.select(F.struct(*t.columns).alias("_in"), "*")
    scored = model.transform(features_v1(held, basis))
    return scored.select("_in.*", F.col(PREDICTION).alias(name))


def write_scored(t: DataFrame, model: PipelineModel, path: str, **kw) -> int:
    """Score and write in one pass; fails if rows were lost or added on the way.

    The rows are written beside ``path`` and take its place only when their number is right.
    """
    before, after = Observation("read"), Observation("written")
    counted = t.observe(before, n_rows().alias("n"))
    scored = score_batch(counted, model, **kw).observe(after, n_rows().alias("n"))
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    scored.write.parquet(beside)
    check_row_count(before, after)
    replace_folder(t.sparkSession, beside, path)
    return after.get["n"]


def check_row_count(before: Observation, after: Observation) -> None:
    if before.get["n"] != after.get["n"]:
        raise RowCountChanged(f"{before.get['n']} rows in, {after.get['n']} rows out")


def publish_scored(t: DataFrame, model: PipelineModel, store: Store, **kw) -> int:
    """Score and write as the store's next version, in one pass; what was current stays so if rows were lost or added."""
    before, after = Observation("read"), Observation("written")
    scored = score_batch(t.observe(before, n_rows().alias("n")), model, **kw).observe(after, n_rows().alias("n"))
    return store.publish({"data": scored}, check=lambda: check_row_count(before, after))


def pred_vs_actual(scored: DataFrame, ids: tuple[str, ...], label: str = S.TARGET, name: str = S.PREDICTED) -> DataFrame:
    return scored.select(
        *ids, F.col(label), F.col(name), (F.col(label) - F.col(name)).alias("residual")
    )


# -- requests -------------------------------------------------------------------------


def request_trips(r: DataFrame) -> DataFrame:
    """Valid requests as trip rows: parsed times, assumed charges, estimated fare.

    A request with a tip but no fare gets a fare estimated from its distance.
    """
    estimated = (F.col("fare_amount") == 0) & (F.col("tip_amount") > 0)
    return r.withColumns(
        {
            S.PICKUP: parsed_time("pickup_datetime"),
            S.DROPOFF: parsed_time("dropoff_datetime"),
            "fare_amount": F.when(estimated, 2.5 * (F.col("trip_distance") * 2.5)).otherwise(
                F.col("fare_amount")
            ),
            **{c: F.lit(v) for c, v in CHARGE_DEFAULTS.items()},
            S.TARGET: F.lit(0.0),
        }
    )


def request_features(r: DataFrame, basis: str = "fare") -> DataFrame:
    """The feature set of the model, from requests."""
    out = features_v1(request_trips(r), basis, keep=(S.TARGET, "pickup_datetime", "dropoff_datetime"))
    # Revenue is the (still unknown, zero) total over the distance for a request.
    return out.withColumn("revenue_per_mile", F.lit(0.0)).drop(S.TARGET, S.PICKUP, S.DROPOFF)


def fare_to_show(c: Column) -> Column:
    """Never negative, in whole cents."""
    return F.round(F.greatest(c, F.lit(0.0)), 2)


def score_requests(
    r: DataFrame, model: PipelineModel, version: str, ids: tuple[str, ...] = (), basis: str = "fare"
) -> DataFrame:
    """Fare, duration, model version and time of prediction for each valid request."""
    minutes = minutes_between(parsed_time("pickup_datetime"), parsed_time("dropoff_datetime"))
    scored = model.transform(request_features(r, basis))
    return scored.select(
        *ids,
        fare_to_show(F.col(PREDICTION)).alias("predicted_fare"),
        F.round(minutes, 2).alias("trip_duration_minutes"),
        F.lit(version).alias("model_version"),
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias(
            "prediction_timestamp"
        ),
    )


# -- records of a run -----------------------------------------------------------------


def run_metrics(scored: DataFrame, run_id: str, model: str, version: str, name: str = S.PREDICTED) -> DataFrame:
    """(run_id, model, version, metric, value) rows that describe one scoring run."""
    stats = prediction_stats(scored, name)
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in stats.columns]
    return stats.select(
        F.lit(run_id).alias("run_id"),
        F.lit(model).alias("model"),
        F.lit(version).alias("version"),
        F.inline(F.array(*cells)),
    )


def model_metrics(table: DataFrame, run_id: str, version: str) -> DataFrame:
    """A metric table, one row per model, in the same long form."""
    cells = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
        for c in table.columns
        if c != "model"
    ]
    return table.select(
        F.lit(run_id).alias("run_id"), "model", F.lit(version).alias("version"), F.inline(F.array(*cells))
    )


def append_metrics(rows: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Append to the metrics table, as Parquet or JSON."""
    rows.write.mode("append").format(fmt).save(path)
    return path


def read_metrics(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    shape = "run_id string, model string, version string, metric string, value double"
    return spark.read.schema(shape).format(fmt).load(path)


def resolve_version(versions: DataFrame, wanted: str = "latest") -> DataFrame:
    """Pick a model version out of (model, version, stage, ...) rows.

    ``latest`` is the highest number; ``production`` and ``staging`` the highest one in that
    stage; a number is that version. Any other name, with or without @, is an alias such as
    ``champion``: the highest version whose ``alias`` it is. No row means that there is none.
    """
    number = F.col("version").cast("int")
    name = wanted.removeprefix("@")
    if wanted in ("production", "staging"):
        versions = versions.where(F.lower("stage") == wanted)
    elif wanted.isdecimal():
        versions = versions.where(number == int(wanted))
    elif wanted != "latest":
        alias = F.lower("alias") if "alias" in versions.columns else F.lower("stage")
        versions = versions.where(alias == name.lower())
    pick = F.max_by(F.struct(*versions.columns), number)
    return versions.groupBy("model").agg(pick.alias("v")).select("v.*")
