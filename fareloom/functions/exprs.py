"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from JVM functions, so plans stay inside
whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Fractional minutes between two zone-less timestamps.

    Their difference is a plain interval. ``timestamp_diff`` would go through the session
    zone and be wrong for times that a clock change skips.
    """
    seconds = (col(end) - col(start)).cast("interval second").cast("decimal(18,6)")
    return seconds.cast("double") / F.lit(60.0)


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den``; null where the denominator is zero or either side is null."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def clip(c: str | Column, lo=None, hi=None) -> Column:
    """Limit to ``[lo, hi]``; null stays null (``greatest``/``least`` would skip it)."""
    x = col(c)
    out = x
    if hi is not None:
        out = F.least(F.lit(hi) if not isinstance(hi, Column) else hi, out)
    if lo is not None:
        out = F.greatest(F.lit(lo) if not isinstance(lo, Column) else lo, out)
    return F.when(x.isNotNull(), out)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def nan_to_null(c: str | Column) -> Column:
    """Treat NaN as a missing value (Spark would order it above every number)."""
    return F.nanvl(col(c), F.lit(None).cast("double"))


def any_null(cols: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def all_null(cols: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in cols])


def hash_key(key: str | Column, seed: int | str) -> Column:
    """32 hex digits that order rows the same way on every run and every engine.

    A row without a key hashes like an empty one, so that no split loses it.
    """
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(col(key).cast("string"), F.lit(""))))


def hash_bucket(key: str | Column, seed: int | str, buckets: int) -> Column:
    """Bucket number in ``[0, buckets)`` from the first 8 hex digits of the row hash."""
    head = F.conv(F.substring(hash_key(key, seed), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets)).cast("int")


def hash_below(key: str | Column, seed: int | str, share: float) -> Column:
    """True for about ``share`` of the keys, the same ones every time."""
    limit = format(int(share * 16**8), "08x")
    return F.substring(hash_key(key, seed), 1, 8) < F.lit(limit)


def percent(part: Column, whole: Column) -> Column:
    return ratio(part * F.lit(100.0), whole)
