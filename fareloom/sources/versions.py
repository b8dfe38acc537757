"""Tables that change as a whole.

Every write has folders of its own. What is current is named by a manifest, a small file that takes its
place by one rename when all folders are complete: a run that dies before leaves the old state readable, and several
parts become visible together. A version's number is claimed by creating a file that must not exist yet, so two
writers never share one. Old versions stay until ``clean`` removes them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class Store:
    """Versions of one or more named tables under a folder that every executor reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._new = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._new(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._log = self._new(f"{self.path}/_versions")

    def numbers(self) -> list[int]:
        """Numbers of the complete versions, oldest first."""
        if not self._files.exists(self._log):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(self._log)]
        return sorted(int(n.removesuffix(".manifest")) for n in names if n.endswith(".manifest"))

    def manifest(self, number: int) -> dict:
        stream = self._files.open(self._new(self._log, f"{number:012d}.manifest"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def claim(self, number: int | None = None) -> int:
        """Take the next number; no other writer gets it."""
        self._files.mkdirs(self._log)
        if number is not None:
            return number
        taken = [f.getPath().getName() for f in self._files.listStatus(self._log)]
        number = 1 + max((int(n.partition(".")[0]) for n in taken if n[:12].isdecimal()), default=-1)
        while not self._files.createNewFile(self._new(self._log, f"{number:012d}.claim")):
            number += 1
        return number

    def _seal(self, number: int, folders: dict[str, str], note: dict) -> None:
        beside = self._new(self._log, f"{uuid.uuid4().hex}.partial")
        out = self._files.create(beside, False)
        out.write(bytearray(json.dumps({"parts": folders, **note}).encode()))
        out.close()
        final = self._new(self._log, f"{number:012d}.manifest")
        if self._files.exists(final) or not self._files.rename(beside, final):
            raise FileExistsError(f"version {number} of {self.path} exists")

    def publish(
        self,
        parts: dict[str, DataFrame | Callable[[dict[str, DataFrame]], DataFrame]],
        check: Callable[[], None] | None = None,
        number: int | None = None,
        **note,
    ) -> int:
        """Write all parts, then make them the current version; returns its number.

        A part may be made from those written before it. ``check`` may refuse by raising, before anything is
        visible. With a ``number``, such as that of a batch, a version that exists is left as it is.
        """
        if number is not None and number in self.numbers():
            return number
        number = self.claim(number)
        folders, written = {}, {}
        for name, part in parts.items():
            df = part(written) if callable(part) else part
            folders[name] = f"{name}-{number:012d}-{uuid.uuid4().hex}"
            df.write.parquet(f"{self.path}/{folders[name]}")
            written[name] = self.spark.read.schema(df.schema).parquet(f"{self.path}/{folders[name]}")
        if check:
            check()
        self._seal(number, folders, note)
        return number

    def read(self, part: str = "data", number: int | None = None) -> DataFrame:
        """A part of the current version, or of the one with a number."""
        known = self.numbers()
        if not known or number is not None and number not in known:
            raise FileNotFoundError(f"{self.path} has no version {'' if number is None else number}")
        return self.spark.read.parquet(f"{self.path}/{self.manifest(known[-1] if number is None else number)['parts'][part]}")

    def read_all(self, part: str = "data") -> DataFrame:
        """A part of all versions together, for stores whose versions are batches."""
        folders = [f"{self.path}/{self.manifest(n)['parts'][part]}" for n in self.numbers()]
        if not folders:
            raise FileNotFoundError(f"{self.path} has no version")
        return self.spark.read.parquet(*folders)

    def clean(self, keep: int = 2) -> int:
        """Remove all but the newest ``keep`` versions and what unfinished older writes left; returns the folders removed.

        Only what belongs to numbers below the oldest one kept goes, so a write under way is not touched.
        """
        known = self.numbers()
        if len(known) < keep or keep < 1:
            return 0
        oldest, removed = known[-keep], 0
        for n in known[:-keep]:
            self._files.delete(self._new(self._log, f"{n:012d}.manifest"), False)
        for f in self._files.listStatus(self._new(self.path)):
            number = f.getPath().getName().split("-")[-2:-1]
            if number and number[0].isdecimal() and int(number[0]) < oldest:
                self._files.delete(f.getPath(), True)
                removed += 1
        return removed


def replace_folder(spark: SparkSession, new: str, old: str) -> None:
    """Put a written folder in the place of another; whatever fails, one of the two is there, under its own or an ``-old`` name."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    aside = path(f"{old.rstrip('/')}-old-{uuid.uuid4().hex}")
    files = path(old).getFileSystem(spark._jsc.hadoopConfiguration())
    def moved(source, target) -> bool:
        try:
            return files.rename(source, target)
        except Py4JJavaError:  # some file systems raise where others return false
            return False

    had = files.exists(path(old))
    if had and not moved(path(old), aside):
        raise OSError(f"{old} could not be moved aside")
    if not moved(path(new), path(old)):
        if had:
            moved(aside, path(old))
        raise OSError(f"{new} could not take the place of {old}")
    if had:
        files.delete(aside, True)
