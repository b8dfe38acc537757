"""The column transformer: filled and scaled numbers beside one-hot categories.

``TripEncoder`` learns its state with the same fits as ``operators.encode`` and turns it
into ordinary Spark ML stages, so that a fitted pipeline is saved, loaded and streamed
without any class of this package.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom import schema as S
from fareloom.functions.exprs import nan_to_null
from fareloom.operators import encode as E
from fareloom.operators.quantiles import interpolate, values_at
from fareloom.session import settle, split_methods

FEATURES = "features"


def sql_number(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def sql_text(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def flag_quantile(rows: int, zeros: int, q: float) -> float:
    """Quantile of a column of ``zeros`` zeros and otherwise ones, interpolated between its neighbours."""
    return min(1.0, max(0.0, q * (rows - 1) - (zeros - 1))) if rows and zeros else float(rows > 0)


def fit_robust_at_once(train: DataFrame, cols: Sequence[str]) -> tuple[dict, dict, dict]:
    """Limits, medians of the limited values, and quartiles of the limited and filled ones, from one search for ranks.

    Limiting keeps the order, so a limited value's rank is its own; filling puts as many medians as there are
    missing values beside the median. NaN lies at the upper limit once it is limited.
    """
    given = train.select(*[F.col(c).cast("double").alias(c) for c in cols])
    counts = [f for c in cols for f in (F.count(c), F.count(nan_to_null(c)))]
    rows, *counts = given.agg(F.count(F.lit(1)), *counts).first()
    present = dict(zip(cols, zip(counts[::2], counts[1::2])))  # with NaN, without

    def beside(p: float, n: int) -> list[int]:
        return [floor(p * (n - 1)), ceil(p * (n - 1))] if n else []

    quarters = [k for p in (0.25, 0.5, 0.75) for k in beside(p, rows)]
    ranks = {}
    for c, (most, n) in present.items():
        near = [*beside(0.01, n), *beside(0.99, n), *beside(0.5, most), *quarters, *(k - rows + most for k in quarters)]
        ranks[c] = sorted({k for k in near if 0 <= k < n})
    found = values_at(given, ranks)
    caps, median, scale = {}, {}, {}
    for c, (most, n) in present.items():
        lo, hi = caps[c] = [interpolate(found[c], p * (n - 1)) if n else None for p in (0.01, 0.99)]
        middle = 0.5 * (most - 1)

        def limited(k: int) -> float:
            return max(lo, min(hi, found[c][k] if k < n else hi))

        def at(p: float, m: float, cut: int) -> float:
            def filled(k: int) -> float:
                return limited(k) if k < cut else m if k < cut + rows - most else limited(k - rows + most)

            place = p * (rows - 1)
            low, high = filled(floor(place)), filled(ceil(place))
            return low + (high - low) * (place - floor(place))

        if n:
            low, high = limited(floor(middle)), limited(ceil(middle))
            median[c] = low + (high - low) * (middle - floor(middle))
            cut = floor(middle) + (median[c] > low)
            scale[c] = [at(p, median[c], cut) for p in (0.25, 0.5, 0.75)]
        else:
            median[c], scale[c] = 0.0, [0.0, 0.0, 0.0]
    return caps, median, scale


class TripEncoder(Estimator):
    """Fits the encoding of a feature table and returns a ``PipelineModel``.

    ``style='standard'``: median fill, mean 0 and deviation 1; categories filled with the
    most frequent value, every category gets a slot.
    ``style='robust'``: limits at the 1st and 99th percentile, median fill with a missing
    flag, median 0 and interquartile range 1; categories filled with ``MISSING``, the
    first category has no slot. Unseen categories set no slot in either style.
    """

    def __init__(
        self,
        numeric: Sequence[str] = tuple(S.MODEL_NUMERIC),
        categorical: Sequence[str] = tuple(S.MODEL_CATEGORICAL),
        style: str = "standard",
        output: str = FEATURES,
        exact: bool = True,
        max_categories: int = E.MAX_CATEGORIES,
    ):
        super().__init__()
        if style not in ("standard", "robust"):
            raise ValueError(f"unknown encoder style {style!r}")
        self.numeric = list(numeric)
        self.categorical = list(categorical)
        self.style = style
        self.output = output
        self.exact = exact
        self.max_categories = max_categories

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        robust = self.style == "robust"
        numbers = self._robust(dataset) if robust else self._standard(dataset)
        cats = E.fit_categories(
            dataset, self.categorical, "MISSING" if robust else None, self.max_categories
        )
        # The indexer sends a label it does not know past the last slot, which stays unset.
        # Leaving the first label out of its list is therefore all that dropping it takes.
        labels = {c: known[1:] if robust else known for c, known in cats.known.items()}
        labels = {c: known for c, known in labels.items() if known}
        texts = {f"text_{c}": f"coalesce(CAST(`{c}` AS STRING), {sql_text(cats.fill[c])})" for c in labels}
        columns = ", ".join(f"{e} AS `{n}`" for n, e in {**numbers, **texts}.items())
        stages = [SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")]
        inputs = list(numbers)
        if labels:
            index, slots = [f"index_{c}" for c in labels], [f"is_{c}" for c in labels]
            stages += [
                StringIndexerModel.from_labels(known, f"text_{c}", f"index_{c}", "keep")
                for c, known in labels.items()
            ]
            # The number of slots is read from the column's metadata: no pass over the data.
            sized = PipelineModel(stages).transform(dataset)
            stages.append(OneHotEncoder(inputCols=index, outputCols=slots, dropLast=True).fit(sized))
            inputs += slots
        stages.append(VectorAssembler(inputCols=inputs, outputCol=self.output))
        return PipelineModel(stages)

    def _standard(self, train: DataFrame) -> dict[str, str]:
        fit = E.fit_standard(train, self.numeric, self.exact)
        return {
            f"scaled_{c}": f"(coalesce(CAST(`{c}` AS DOUBLE), {sql_number(fit.median[c])})"
            f" - {sql_number(fit.mean[c])}) / {sql_number(fit.sd[c] or 1.0)}"
            for c in self.numeric
        }

    def _robust(self, train: DataFrame) -> dict[str, str]:
        """Limits first, then the median and quartiles of the limited and filled values."""
        if self.exact:
            caps, median, scale = fit_robust_at_once(train, self.numeric)
        else:
            caps = E.fit_caps(train, self.numeric, exact=False)
            capped = E.apply_caps(train.select(*self.numeric), caps)
            gaps = E.fit_gaps(capped, self.numeric, exact=False)
            median, scale = gaps.median, E.fit_robust(E.apply_gaps(capped, gaps, indicator=False), self.numeric, False)
        sizes = train.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(self.numeric)]).first()
        out = {}
        for i, c in enumerate(self.numeric):
            (lo, hi), (q1, q2, q3) = caps[c], scale[c]
            x = f"CAST(`{c}` AS DOUBLE)"
            if lo is not None:
                x = f"greatest({sql_number(lo)}, least({sql_number(hi)}, {x}))"
            x = f"CASE WHEN `{c}` IS NULL THEN {sql_number(median[c])} ELSE {x} END"
            out[f"scaled_{c}"] = f"({x} - {sql_number(q2)}) / {sql_number((q3 - q1) or 1.0)}"
            f1, f2, f3 = (flag_quantile(sizes["rows"], sizes[f"n{i}"], q) for q in (0.25, 0.5, 0.75))
            out[f"missing_{c}"] = f"(CAST(`{c}` IS NULL AS DOUBLE) - {sql_number(f2)}) / {sql_number((f3 - f1) or 1.0)}"
        return out


def slot_names(encoded: DataFrame, column: str = FEATURES) -> list[str]:
    """Name of every slot of an assembled vector, in order, from the column's own metadata."""
    groups = encoded.schema[column].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for group in groups.values() for a in group)
    return [name for _, name in slots]


def slot_table(encoded: DataFrame, column: str = FEATURES) -> DataFrame:
    """(slot, feature, rows, total): how many rows set each slot, and the sum of its values; every task adds up its own rows first."""
    held = slot_names(encoded, column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, rows, total = 0, np.zeros(len(held), np.int64), np.zeros(len(held))
        for batch in batches:
            some += batch.num_rows
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(held))
            rows += (x != 0).sum(axis=0)
            total += x.sum(axis=0)
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(held)), pa.int32()), pa.array(rows), pa.array(total)], ["slot", "rows", "total"])

    names = F.array(*[F.lit(n) for n in held])
    parts = encoded.select(vector_to_array(column).alias("x")).mapInArrow(run, "slot int, rows long, total double")
    sums = parts.groupBy("slot").agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"))
    with split_methods(encoded.sparkSession):
        sums = settle(sums, "slots")  # a row per slot
    return sums.select("slot", names[F.col("slot")].alias("feature"), "rows", "total")
