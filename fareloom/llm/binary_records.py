"""Token ids in length-delimited binary records, with a separate offset index.

A record frames one document's ids: length (unsigned 64 bit), masked checksum of the length,
the ids, masked checksum of the ids. All numbers are little-endian; ids have 16 bits
if the vocabulary allows, else 32. The checksum is CRC-32 (zlib), rotated right by 15 bits plus
a constant, so that a checksum over data that holds checksums stays sound. Beside each
``part-N.rec`` an index ``part-N.idx`` has an entry per record (id, whether the id is missing,
offset, number of ids), from which records are read in any order.

Documents are dealt out by ranges of their id and sorted in each range, so the parts in order of
their number hold ascending ids. A task writes under a name of its own and renames
when it is complete: a task that runs twice leaves one complete part. The folder has to be one
that pyarrow's file systems reach from every executor.
"""

from __future__ import annotations

import os
import posixpath
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.common import LAST_ID, CutTexts, Remembered, at_blanks, ordered_id, pieces, settle, ship, strings, uncollected
from fareloom.session import scratch_path

#: Fixed values of the record format: the checksum's mask, and the index entry.
MASK = 0xA282EAD8
ENTRY = np.dtype([("doc_id", "<i8"), ("missing", "<u1"), ("offset", "<u8"), ("tokens", "<u8")])
#: Encoded words that a Python worker remembers.
REMEMBERED = 500_000
#: Bytes of text that are cut into words at a time; the more, the rarer a word is met again in the next.
TOGETHER = 8 << 20
#: Bytes of text that a file holds about, where there is enough text.
FILE_BYTES = 128 << 20


class Encoder:
    """Ids by a byte-level tokenizer of the tokenizers library, one call per distinct word.

    The tokenizer's pattern never joins a blank to what stands before it, so a text cut before
    every blank that a visible character follows has the same ids as its pieces one after the
    other. A text that holds a special token goes to the library as it is.
    """

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(tokenizer)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.width = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.words = Remembered(self._encode, REMEMBERED)

    def _encode(self, parts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(parts, add_special_tokens=False)
        return [np.array(e.ids, self.width).tobytes() for e in found]

    def __call__(self, column: pa.Array) -> list[bytes]:
        """Packed ids of each text of a column; a missing one is empty."""
        if not len(column):
            return []
        with uncollected():
            return self._packed(column)

    def _packed(self, column: pa.Array) -> list[bytes]:
        data = column.cast(pa.large_binary())
        whole = np.zeros(len(column), bool)
        for token in self.special:
            whole |= pc.fill_null(pc.match_substring(data, token.encode()), False).to_numpy(zero_copy_only=False)
        cut = CutTexts(data)
        out = cut.gathered(self.words.each(cut.pieces), self.width.itemsize)
        odd = np.flatnonzero(whole | cut.uneven)
        given = strings(data.take(pa.array(odd)))
        for n, ids in zip(odd.tolist(), self.words.joined([[t] if w else at_blanks(t) for t, w in zip(given, whole[odd])])):
            out[n] = ids
        return out


_encoders: dict[int, Encoder] = {}


def encoder(tokenizer: str) -> Encoder:
    """The worker's encoder for a tokenizer; it keeps what it has learned from task to task."""
    key = hash(tokenizer)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(tokenizer)
    return _encoders[key]


def checksum(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = len(payload).to_bytes(8, "little")
    return b"".join((length, checksum(length).to_bytes(4, "little"), payload, checksum(payload).to_bytes(4, "little")))


def unframe(source: pa.NativeFile) -> bytes:
    """The next record's payload; raises if a checksum differs or the file ends too early."""
    head = source.read(12)
    length = int.from_bytes(head[:8], "little")
    if len(head) < 12 or checksum(head[:8]) != int.from_bytes(head[8:], "little"):
        raise ValueError("the length of a record is damaged")
    body = source.read(length + 4)
    if len(body) < length + 4 or checksum(body[:length]) != int.from_bytes(body[length:], "little"):
        raise ValueError("the ids of a record are damaged")
    return body[:length]


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", files: int | None = None) -> DataFrame:
    """Write every document's ids and ``end_id`` under ``path``; returns (part, records, tokens).

    ``tokenizer`` is the tokenizer's JSON. A missing text is empty. Documents are in ascending
    order of id, a missing id last, equal ids by text. Without ``files`` there are as many as shuffles have
    partitions, or more where a file would hold over ``FILE_BYTES`` of text.
    """
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(tokenizer)  # one vocabulary file, whatever the input
    if files is None:
        size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
        files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode = encoder(held.value)
        end = np.array([end_id], encode.width).tobytes()
        fs, root = pafs.FileSystem.from_uri(path)
        own = posixpath.join(root, f"part-{part:06d}.{uuid.uuid4().hex}")
        entries, offset, out = [], 0, None
        for batch in pieces(batches, "text", TOGETHER):
            if out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{own}.rec")
            oids, records = batch.column("oid").to_numpy(), []
            entry = np.empty(len(oids), ENTRY)
            entry["doc_id"], entry["missing"] = oids, oids == LAST_ID
            for n, ids in enumerate(encode(batch.column("text"))):
                records.append(frame(ids + end))
                entry[n]["offset"], entry[n]["tokens"] = offset, len(ids) // encode.width.itemsize + 1
                offset += len(records[-1])
            out.write(b"".join(records))
            entries.append(entry)
        if out is None:
            return
        out.close()
        index = np.concatenate(entries)
        with fs.open_output_stream(f"{own}.idx") as f:
            f.write(index.tobytes())
        for kind in ("idx", "rec"):
            fs.move(f"{own}.{kind}", posixpath.join(root, f"part-{part:06d}.{kind}"))
        columns = [pa.array([part], pa.int64()), pa.array([len(index)], pa.int64()), pa.array([int(index["tokens"].sum())], pa.int64()), pa.array([encode.width.itemsize], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["part", "records", "tokens", "width"])

    rows = docs.select(ordered_id(id_col).alias("oid"), F.col(text_col).cast("string").alias("text"))
    dealt = rows.repartitionByRange(files, "oid").sortWithinPartitions("oid", "text")
    return settle(dealt.mapInArrow(run, "part long, records long, tokens long, width long"), "record-parts")


def read(spark: SparkSession, path: str, parts: DataFrame) -> DataFrame:
    """Every record in the files under ``path``: doc_id, start, n_tokens, ids.

    ``start`` counts the ids of all documents before it; ``ids`` are packed little-endian
    unsigned 32-bit integers. ``parts`` is what ``write`` returned: a row per file.
    """
    ship(spark)
    begin, todo = 0, []
    for part, tokens, width in sorted(tuple(r) for r in parts.select("part", "tokens", "width").collect()):
        todo.append((part, begin, width))
        begin += tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for part, start, width in zip(*(batch.column(c).to_pylist() for c in ("part", "start", "width"))):
                name = posixpath.join(root, f"part-{part:06d}")
                with fs.open_input_file(f"{name}.idx") as f:
                    index = np.frombuffer(f.read(), ENTRY)
                with fs.open_input_stream(f"{name}.rec", buffer_size=1 << 20) as f:
                    yield from _records(index, lambda _: unframe(f), width, start)

    table = spark.createDataFrame(todo, "part long, start long, width long")
    return table.repartition(max(1, len(todo))).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def _records(index: np.ndarray, payload: Callable[[int], bytes], width: int, start: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    held = 0

    def out() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "start", "n_tokens", "ids"])

    for doc_id, missing, offset, tokens in index.tolist():
        data = payload(offset)
        if len(data) != tokens * width:
            raise ValueError("the index does not fit its records")
        ids = data if width == 4 else np.frombuffer(data, f"<u{width}").astype("<u4").tobytes()
        rows.append((None if missing else doc_id, start, tokens, ids))
        start, held = start + tokens, held + len(ids)
        if held > most:
            yield out()
            rows.clear()
            held = 0
    if rows:
        yield out()


def read_shuffled(spark: SparkSession, path: str, parts: DataFrame, seed: int = 0, tasks: int | None = None) -> DataFrame:
    """The records in a seeded random order, each fetched by its place in the offset index.

    Returns doc_id, start (0: a place in the file order has no meaning here), n_tokens, ids.
    """

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for part, width in zip(batch.column("part").to_pylist(), batch.column("width").to_pylist()):
                with fs.open_input_file(posixpath.join(root, f"part-{part:06d}.idx")) as f:
                    index = np.frombuffer(f.read(), ENTRY)
                columns = {k: np.ascontiguousarray(index[k]).astype(np.int64) for k in ENTRY.names}
                columns |= {"part": np.full(len(index), part), "width": np.full(len(index), width)}
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], list(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(posixpath.join(root, f"part-{row['part']:06d}.rec")) as f:
                    f.seek(row["offset"])
                    one = np.array([tuple(row[k] for k in ENTRY.names)], ENTRY)
                    yield from _records(one, lambda _: unframe(f), row["width"], 0)

    ship(spark)
    places = parts.repartition(parts.count() or 1).mapInArrow(entries, "doc_id long, missing long, offset long, tokens long, part long, width long")
    mixed = places.withColumn("at", F.xxhash64(F.lit(seed), "part", "offset"))
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return mixed.repartition(tasks, "at").sortWithinPartitions("at").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` and read them back from the files."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "records")
    return read(spark, path, write(docs, path, tokenizer, end_id, id_col, text_col))
