"""Samples, shuffles, splits and folds.

Every choice is a function of a row key and a seed, so a re-run, a lost executor or a
different partitioning gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom import schema as S
from fareloom.functions.exprs import hash_below, hash_bucket, hash_key
from fareloom.operators.profile import n_rows
from fareloom.operators.quantiles import fit_quantiles

PREFIX = 3  # hex digits per histogram: 4096 counts
GROUP_ROWS = 200_000


def row_key(t: DataFrame, key: str) -> Column:
    """The key as text. Rows without one are told apart by all they hold, so that they spread."""
    plain = [f.name for f in t.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.coalesce(F.col(key).cast("string"), F.hex(F.xxhash64(*plain)))


def _prefix_counts(rows: DataFrame, key: str, start: int) -> list[tuple[str, int]]:
    head = F.substring(key, start, PREFIX).alias("head")
    return sorted((r["head"], r["n"]) for r in rows.groupBy(head).agg(n_rows().alias("n")).collect())


def sample_n(t: DataFrame, n: int, key: str, seed: int | str = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows: those with the ``n`` smallest row hashes.

    Counts per hash prefix (4096 numbers a pass) narrow down the prefix in which the
    ``n``-th row falls. Rows below it are kept by a plain filter, and only rows sharing
    that prefix are ordered. The key should be unique.
    """
    h = "_h"
    keyed = t.withColumn(h, hash_key(row_key(t, key), seed))
    inside, prefix, left = keyed, "", n
    while True:
        counts = _prefix_counts(inside.select(h), h, len(prefix) + 1)
        size = sum(c for _, c in counts)
        if size <= left:
            return (keyed.where(F.col(h) < F.lit(prefix + "g"))).drop(h)
        for head, c in counts:
            if c > left:
                break
            left -= c
        prefix += head
        inside = keyed.where(F.col(h).startswith(prefix))
        if c <= GROUP_ROWS or len(prefix) + PREFIX > 32:
            break
    whole = keyed.where(F.col(h) < F.lit(prefix))
    return whole.unionByName(inside.orderBy(h).limit(left)).drop(h)


def row_positions(
    t: DataFrame, key: str, seed: int | str, by: Sequence[str] = (), name: str = "position"
) -> DataFrame:
    """1-based position of each row in hash order, within ``by``: ``row_number`` without one
    big window.

    Rows are counted per (``by``, first hash digits). A running sum over those counts, a
    bounded table, gives each prefix its offset, and numbering then happens inside the
    prefix only. The prefix grows with the table so that a window group stays small.
    """
    h, head = "_h", "_head"
    digits = prefix_digits(t)
    keyed = t.withColumn(h, hash_key(row_key(t, key), seed)).withColumn(head, F.substring(h, 1, digits))
    keyed = keyed.withColumn(h, F.unhex(h))  # the same order in half the bytes
    sizes = keyed.groupBy(*by, head).agg(n_rows().alias("_n"))
    sizes = sizes.withColumn("_coarse", F.substring(head, 1, max(digits - PREFIX, 0)))
    above = sizes.groupBy(*by, "_coarse").agg(F.sum("_n").alias("_m"))

    def before(n: str, order: str, *parts: str) -> Column:
        earlier = Window.partitionBy(*by, *parts).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(n).over(earlier), F.lit(0))

    def same(*cols: str) -> Column:
        return reduce(and_, [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in cols])  # a missing value is a group

    above = above.withColumn("_above", before("_m", "_coarse")).drop("_m")
    offsets = (
        sizes.withColumn("_inner", before("_n", head, "_coarse"))
        .join(above.select(*[F.col(c).alias(f"_b_{c}") for c in (*by, "_coarse")], "_above"), same(*by, "_coarse"))
        .select(*[F.col(c).alias(f"_b_{c}") for c in (*by, head)], (F.col("_above") + F.col("_inner")).alias("_offset"))
    )
    local = F.row_number().over(Window.partitionBy(*by, head).orderBy(h))
    return (
        keyed.join(offsets, same(*by, head))
        .withColumn(name, (F.col("_offset") + local).cast("bigint"))
        .drop(h, head, "_offset")
        .select(*t.columns, name)
    )


def prefix_digits(t: DataFrame) -> int:
    """Hex digits that leave about ``GROUP_ROWS`` rows, or fewer, under one prefix."""
    rows, digits = t.count(), 1
    while rows / 16**digits > GROUP_ROWS and digits < 2 * PREFIX:
        digits += 1
    return digits


def shuffle_order(t: DataFrame, key: str, seed: int | str = 47) -> DataFrame:
    """All rows in a random but repeatable order: a range-partitioned sort by row hash."""
    return t.orderBy(hash_key(row_key(t, key), seed), key)


def train_test_split(
    t: DataFrame, key: str, test_share: float = 0.2, seed: int | str = 42, name: str = "is_test"
) -> DataFrame:
    """Mark about ``test_share`` of the rows as test rows, by row hash: no shuffle."""
    return t.withColumn(name, hash_below(row_key(t, key), seed, test_share))


def three_way_split(t: DataFrame, key: str, share: float = 0.2, seed: int | str = 42) -> DataFrame:
    """``train``, ``validation`` or ``test``: the training part is itself split again."""
    return t.withColumn(
        "split",
        F.when(hash_below(row_key(t, key), seed, share), "test")
        .when(hash_below(row_key(t, key), f"{seed}/validation", share), "validation")
        .otherwise("train"),
    )


def kfold(t: DataFrame, key: str, k: int = 5, seed: int | str = 42, name: str = "fold") -> DataFrame:
    """Fold number in ``[0, k)`` by row hash; folds differ in size by chance only."""
    return t.withColumn(name, hash_bucket(row_key(t, key), seed, k))


def bin_edges(t: DataFrame, target: str = S.TARGET, bins: int = 10, exact: bool = True) -> list[float]:
    """Distinct quantiles of the target, without the outermost two."""
    probs = [i / bins for i in range(bins + 1)]
    edges = sorted({e for e in fit_quantiles(t, [target], probs, exact)[target] if e is not None})
    return edges[1:-1] if len(edges) > 2 else []


def bin_of(target: str, edges: Sequence[float]) -> Column:
    """Number of inner edges at or below the value."""
    out = F.lit(0)
    for e in edges:
        out = out + F.coalesce((F.col(target) >= F.lit(e)).cast("int"), F.lit(0))
    return out


def quantile_bins(
    t: DataFrame, target: str = S.TARGET, bins: int = 10, name: str = "bin", exact: bool = True
) -> DataFrame:
    """Bin each row by the target's quantiles; one bin when there are too few distinct edges."""
    return t.withColumn(name, bin_of(target, bin_edges(t, target, bins, exact)))


def stratified_folds(
    t: DataFrame,
    key: str,
    target: str = S.TARGET,
    k: int = 5,
    bins: int = 10,
    seed: int | str = 42,
    name: str = "fold",
) -> DataFrame:
    """Deal the rows of every target bin into ``k`` folds in turn.

    Within a bin the folds differ by one row at most.
    """
    binned = quantile_bins(t, target, bins)
    dealt = row_positions(binned, key, seed, by=("bin",), name="_pos")
    return dealt.withColumn(name, ((F.col("_pos") - 1) % k).cast("int")).drop("_pos")
