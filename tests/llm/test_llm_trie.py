import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fareloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, up string, rank string, depth string, words string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA)


def by_hand(rows):
    """Rebuild every conversation and count every prefix, one at a time."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    own = {c: [t[3:] for t in sorted(found)] for c, found in turns.items()}
    built = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 4, c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = own.get(base, [])[:h] + own[c][h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, found in built.items():
        for d in range(len(found) + 1):
            members[tuple(found[:d])].append(c)
        ends[tuple(found)].append(c)
    children = defaultdict(set)
    for key in members:
        if key:
            children[key[:-1]].add(key)
    out = []
    for key, inside in members.items():
        below = [k for k in members if k[: len(key)] == key]
        saved = sum((len(members[k]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0) for k in below)
        digest = hashlib.sha256(",".join(map(str, sorted(ends[key]))).encode()).hexdigest()
        parent = min(members[key[:-1]]) if key else None
        out.append((min(inside), len(key), parent, len(inside), len(children[key]), sum(not children[k] for k in below), saved, digest))
    return out


def found(spark, rows, band):
    ranked = prefix_trie.conversation_turns(table(spark, rows))
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    return [tuple(r) for r in prefix_trie.trie(prefix_trie.spliced(ranked, F.col("conv") - F.col("conv") % 20, head, 3), band).collect()]


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("band", [1, 3, 16])
def test_trie_equals_counting_by_hand(spark, band):
    rng = random.Random(band)
    rows = []
    for c in [*range(45), 60, 61, 83, 107, -3, -20, 900]:
        for turn in range(rng.choice([1, 2, 3, 5, 12])):
            rows.append((c, turn, rng.choice(["user", "bot"]) if turn % 3 else "user", rng.choice(["a", "a b", " \t", "é  c d"]) if turn else "hello there"))
    rows += [(5, None, None, None), (5, 1, "user", "tie"), (5, 1, "user", "tie"), (6, None, "user", "first"), (None, 0, "user", "nobody")]
    rows += [(200, t, "user", f"long {t % 5}") for t in range(70)] + [(201, t, "user", f"long {t % 5}") for t in range(66)]
    assert order(found(spark, rows, band)) == order(by_hand(rows))


def test_one_text_for_all_and_very_long_texts(spark):
    rows = [(c, 0, "user", "same") for c in range(300)] + [(c, 1, "bot", "w " * 50_000) for c in range(0, 300, 7)]
    assert order(found(spark, rows, 2)) == order(by_hand(rows))


def test_turnless_conversations_end_at_the_root(spark):
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in range(21, 40)}
    rows = [(c, 0, "user", "only") for c in h if h[c]]
    got = found(spark, rows, 16)
    assert order(got) == order(by_hand(rows)) and len(got) == 1
    assert got[0][1:7] == (0, None, len(rows), 0, 1, 0)


def test_ids_are_joined_in_parts(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "TOGETHER", 7)
    rows = [(c, 0, "user", "same") for c in range(0, 2000, 20)] + [(c, 1, "user", "x") for c in range(0, 2000, 60)]
    assert order(found(spark, rows, 16)) == order(by_hand(rows))


def test_no_conversations_no_nodes(spark):
    assert found(spark, [], 16) == []
    assert found(spark, [(None, 1, "user", "x")], 16) == []
