"""Byte-level BPE encoding by replaying the merges over a corpus of words, and decoding.

A task gathers the distinct words of a few thousand texts and encodes them together. An
inverted index leads from the rank of a token pair to the places in words where the pair stands.
Ranks are taken in rising order; each is merged at all its places, and only the pairs with the
two touched neighbours are entered anew. A text's ids are those of its words in order. About
``REMEMBERED`` pieces of earlier texts are remembered, so a task's memory is bounded
and a frequent word is encoded about once per worker.

No step needs rows of another task, so there is no shuffle, and a lost task is redone alone.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareloom.llm.common import WHITE, Remembered, at_blanks, pieces, ship, strings

#: Pieces of texts that a Python worker remembers.
REMEMBERED = 500_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The ranks of a .tiktoken file: a line per token, its bytes in base 64 and its rank."""
    return {base64.b64decode(t): int(r) for t, r in map(bytes.split, data.splitlines()) if t}


class Merges:
    """The ranks, as a table from two adjacent tokens to the token they make.

    A token is its rank. Every way to halve a token's bytes into two tokens is an entry, since
    bytes alone decide what may be merged.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.width = max(ranks.values(), default=0).bit_length() + 1
        self.of = {
            ranks[t[:i]] << self.width | ranks[t[i:]]: r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
        }
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)])
        self.first = np.full(1 << 16, -1)
        for a in range(256):
            for b in range(256):
                self.first[a << 8 | b] = self.of.get(int(self.byte[a]) << self.width | int(self.byte[b]), -1)


def replay(words: list[bytes], merges: Merges) -> list[list[int]]:
    """Ids of each word: merges of the lowest rank first, at equal rank the leftmost first.

    A word that is a token is that token. If a merge makes a pair of lower rank possible, the
    word's other places wait until that pair has been merged.
    """
    out = [[r] if (r := merges.ranks.get(w)) is not None else [] for w in words]
    open_ = [n for n, ids in enumerate(out) if not ids and words[n]]
    if not open_:
        return out
    flat = np.frombuffer(b"".join([words[n] for n in open_]), np.uint8).astype(np.int64)
    sizes = np.array([len(words[n]) for n in open_])
    ends = np.cumsum(sizes)
    token = merges.byte[flat].tolist()
    before, after = list(range(-1, len(flat) - 1)), list(range(1, len(flat) + 1))
    for e in ends.tolist():
        after[e - 1] = -1
        if e < len(flat):
            before[e] = -1
    rank_at = merges.first[flat[:-1] << 8 | flat[1:]]
    rank_at[ends[:-1] - 1] = -1
    found = np.flatnonzero(rank_at >= 0)
    found = found[np.argsort(rank_at[found], kind="stable")]
    cuts = np.flatnonzero(np.diff(rank_at[found])) + 1
    places: dict[int, list[int]] = {int(rank_at[p[0]]): p.tolist() for p in np.split(found, cuts) if len(p)}
    heap = list(places)
    heapify(heap)
    word_of = np.repeat(np.arange(len(open_)), sizes).tolist()
    made, width = merges.of.get, merges.width
    while heap:
        rank = heappop(heap)
        waiting = places.pop(rank, None)
        if not waiting:
            continue
        waiting.sort()
        held: set[int] = set()
        for at in waiting:
            right = after[at]
            if right < 0 or token[at] < 0 or made(token[at] << width | token[right]) != rank:
                continue
            if held and word_of[at] in held:
                places.setdefault(rank, []).append(at)
                continue
            token[at], token[right] = rank, -1
            after[at] = beyond = after[right]
            if beyond >= 0:
                before[beyond] = at
                if (r := made(rank << width | token[beyond])) is not None:
                    if r in places:
                        places[r].append(at)
                    else:
                        places[r] = [at]
                        heappush(heap, r)
                    if r < rank:
                        held.add(word_of[at])
            left = before[at]
            if left >= 0 and (r := made(token[left] << width | rank)) is not None:
                if r in places:
                    places[r].append(left)
                else:
                    places[r] = [left]
                    heappush(heap, r)
                if r < rank:
                    held.add(word_of[at])
        if rank in places:
            heappush(heap, rank)
    starts = ends - sizes
    for n, a, b in zip(open_, starts.tolist(), ends.tolist()):
        out[n] = [t for t in token[a:b] if t >= 0]
    return out


class Encoder:
    """Ids of texts by ``ranks``, for each match of ``pattern`` in them.

    ``pattern`` must not join a blank to what stands before it if a visible character follows:
    texts are first cut at such blanks, and only pieces that are new are searched by the pattern.
    Its \\s is white space by Unicode.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merges, self.tokens = Merges(ranks), _tokens(ranks)
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]"))
        self.parts = Remembered(self._encode, REMEMBERED)

    def _encode(self, parts: list[str]) -> list[bytes]:
        cut = [self.pattern.findall(p) for p in parts]
        known: dict[str, bytes] = {}
        new = []
        for word in {w for words in cut for w in words}:
            if (ids := self.parts.get(word)) is None:
                new.append(word)
            else:
                known[word] = ids
        found = replay([w.encode() for w in new], self.merges)
        known.update((w, array("i", ids).tobytes()) for w, ids in zip(new, found))
        return [known[words[0]] if len(words) == 1 else b"".join([known[w] for w in words]) for words in cut]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(ids, np.int32) for ids in self.parts.joined([at_blanks(t) for t in texts])]


_encoders: dict[tuple, Encoder] = {}


def _encoder(ranks: bytes, pattern: str) -> Encoder:
    key = hash((ranks, pattern))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(read_ranks(ranks), pattern)
    return _encoders[key]


def _tokens(ranks: dict[bytes, int]) -> np.ndarray:
    """The bytes of every id."""
    out = np.empty(max(ranks.values(), default=-1) + 1, object)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def _added(df: DataFrame, kinds: dict[str, str]) -> StructType:
    return df.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]).schema


def encode(
    docs: DataFrame,
    ranks: bytes,
    pattern: str,
    text_col: str = "text",
    out: str = "ids",
    decoded: str | None = None,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """``docs`` with the ids of ``text_col`` as array<int> ``out``; a missing or empty text has none.

    With ``decoded``, a binary column of that name holds what the ids decode to, from the same pass.
    ``ranks`` is the content of a rank file, which has a fixed size; ``remembered`` bounds the pieces that a worker
    keeps. Columns that already have
    such a name are replaced.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(ranks)
    kept = docs.drop(out, *([decoded] if decoded else []))
    place = kept.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(held.value, pattern)
        encoder.parts.most = remembered // 2
        for batch in pieces(batches, text_col, 2 << 20):
            found = encoder(strings(batch.column(place)))
            ends = np.concatenate(([0], np.cumsum([len(i) for i in found]))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found) if found else np.empty(0, np.int32)))
            columns, names = [*batch.columns, ids], [*batch.schema.names, out]
            if decoded:
                columns.append(pa.array([b"".join(encoder.tokens[i].tolist()) for i in found], pa.binary()))
                names.append(decoded)
            yield pa.RecordBatch.from_arrays(columns, names)

    return kept.mapInArrow(run, _added(kept, {out: "array<int>"} | ({decoded: "binary"} if decoded else {})))


def decode(docs: DataFrame, ranks: bytes, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that ``ids_col`` stands for as binary ``out``; missing ids give no bytes.

    An id that no token has is an error. A column that is already called ``out`` is replaced.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(ranks)
    kept = docs.drop(out)
    place = kept.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(read_ranks(held.value))
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                ids = batch.column(place)
                flat = ids.flatten().to_numpy(zero_copy_only=False)
                ends = np.cumsum([n or 0 for n in ids.value_lengths().to_pylist()]).tolist()
                data = [b"".join(tokens[flat[a:b]].tolist()) for a, b in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], [*batch.schema.names, out])

    return kept.mapInArrow(run, _added(kept, {out: "binary"}))
