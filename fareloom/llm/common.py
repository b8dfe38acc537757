"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import fareloom
from fareloom.session import settle

#: White space of the word contracts; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: White space by Unicode, as a character class.
WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Stands for a missing id wherever ids are ordered: it comes after every other.
LAST_ID = (1 << 63) - 1


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ordered_id(name: str) -> Column:
    """The id as a long, missing ids last."""
    return F.coalesce(F.col(name).cast("long"), F.lit(LAST_ID))


def given_id(name: str) -> Column:
    """Undo ``ordered_id``."""
    return F.when(F.col(name) < LAST_ID, F.col(name))


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; a missing text is empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


def strings(column: pa.Array) -> list[str]:
    """A text column as strings; a missing text is empty, broken UTF-8 becomes U+FFFD."""
    return [t.decode("utf-8", "replace") for t in texts(column)]


_UNEVEN_BLANK = re.compile(rf" (?:[{WHITE}]|\Z)")
_BLANK_BEFORE_WORD = re.compile(rf" (?=[^{WHITE}])")
_WHITE_FIRST = re.compile(rf"[{WHITE}]|\Z")


def at_blanks(text: str) -> list[str]:
    """The text cut before every blank that a visible character follows; joined, they are the text."""
    cut = _BLANK_BEFORE_WORD.split(text) if _UNEVEN_BLANK.search(text) else text.split(" ")
    return [cut[0], *[" " + part for part in cut[1:]]]


@contextmanager
def uncollected() -> Iterator[None]:
    """Without searches for cycles, which pass over all that is remembered whenever many small objects are made."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class CutTexts:
    """A column of texts cut at their blanks, with every distinct piece once.

    ``pieces`` are the distinct pieces; the first of a text has no blank before it, all others have one. ``at`` has the number
    of the piece for every place of every text in turn, ``starts`` where each text begins there. ``uneven`` marks
    the texts of which a blank has no visible character after it: their pieces are not those of ``at_blanks``.
    """

    def __init__(self, column: pa.Array):
        data = pc.fill_null(column.cast(pa.large_binary()), b"")
        cut = pc.split_pattern(data, b" ")
        self.starts = cut.offsets.to_numpy()[:-1] - cut.offsets[0].as_py()
        coded = cut.flatten().dictionary_encode()
        words = [w.decode("utf-8", "replace") for w in coded.dictionary.to_pylist()]
        at = coded.indices.to_numpy()
        loose = np.fromiter(map(bool, map(_WHITE_FIRST.match, words)), bool, len(words))[at]
        loose[self.starts] = False
        self.uneven = np.logical_or.reduceat(loose, self.starts) if len(self.starts) else loose
        first, place = np.unique(at[self.starts], return_inverse=True)
        self.pieces = [" " + w for w in words] + [words[k] for k in first]
        self.at = at.astype(np.int64)
        self.at[self.starts] = len(words) + place

    def gathered(self, values: list[bytes], width: int) -> list[bytes]:
        """For each text the values of its pieces one after the other; a value is a number of items of ``width`` bytes."""
        kind = np.dtype(f"V{width}")
        flat = np.frombuffer(b"".join(values), kind)
        size = np.fromiter(map(len, values), np.int64, len(values)) // width
        begin = np.cumsum(size) - size
        many = size[self.at]
        ends = np.cumsum(many)
        # Item k of the result lies as far into its piece as k is past the piece's first item.
        from_ = np.repeat(begin[self.at] - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)
        data = flat[from_].tobytes()
        cuts = np.append((ends - many)[self.starts], len(from_)) * width
        return [data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


class Remembered:
    """What was computed for the pieces of texts, about ``most`` of them.

    Two generations: when the younger is full it becomes the older, and what is asked for
    again comes back from there, so frequent pieces stay.
    """

    def __init__(self, compute: Callable[[list[str]], list[bytes]], most: int):
        self.compute, self.most = compute, most // 2
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, part: str) -> bytes | None:
        return self.young.get(part) or self.old.get(part)

    def _learn(self, parts: set[str]) -> dict[str, bytes]:
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        young, old, new = self.young, self.old, []
        for part in parts.difference(young):
            if (value := old.get(part)) is None:
                new.append(part)
            else:
                young[part] = value
        young.update(zip(new, self.compute(new)))
        return young

    def each(self, parts: list[str]) -> list[bytes]:
        """What was computed for each of the pieces."""
        return list(map(self._learn(set(parts)).__getitem__, parts))

    def joined(self, cut: list[list[str]]) -> list[bytes]:
        """For each list of pieces, what was computed for them one after the other."""
        young = self._learn({p for parts in cut for p in parts})
        return [b"".join(map(young.__getitem__, parts)) for parts in cut]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library to the executors' Python workers, once per application.

    The archive is made where the driver runs; Spark hands it out as it does for --py-files.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(fareloom.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="fareloom-ship-")) / "fareloom.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of what is stored by now.

    Spark deletes them when the driver collects the objects that stand for them as garbage,
    which a loop over stored tables may outrun.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of text, and one row at least."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        begin = total = 0
        for i, n in enumerate(size):
            if total and total + n > most:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += n
        if begin < batch.num_rows:
            yield batch.slice(begin)


__all__ = [
    "LAST_ID",
    "SPACE",
    "WHITE",
    "WORD",
    "CutTexts",
    "Remembered",
    "at_blanks",
    "given_id",
    "ordered_id",
    "pieces",
    "read",
    "release",
    "settle",
    "ship",
    "strings",
    "texts",
    "uncollected",
]
