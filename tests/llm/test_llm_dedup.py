import hashlib
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from fareloom.llm import components, exact_dedup, simhash, substring_dedup

LAST = 1 << 63


def brute_spans(rows, window):
    words = [(i if i is not None else LAST, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            first[k] = min(i, first.get(k, LAST))
    out = []
    for i, w in words:
        gone = {q for p in range(len(w) - window + 1) if first[tuple(w[p : p + window])] < i for q in range(p, p + window)}
        out.append((None if i == LAST else i, len(w), len(gone), " ".join(x for q, x in enumerate(w) if q not in gone)))
    return Counter(out)


@pytest.mark.parametrize("window", [50, 16])
def test_substrings_equal_brute_force(table, awkward, window):
    rows = awkward + [(40 + i, " ".join(["tick"] * n)) for i, n in enumerate((10, 55, 70))]
    found = substring_dedup.dedup_substrings(table(rows), window=window)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found.collect()]
    assert Counter(got) == brute_spans(rows, window)


def test_factors_name_an_earlier_document_that_holds_them(table, awkward):
    words = defaultdict(list)
    for i, t in awkward:
        words[i].append(" ".join((t or "").split()))
    found = substring_dedup.dedup_substrings(table(awkward)).where("size(factors) > 0").collect()
    assert found
    for r in found:
        own = [w.split(" ") for w in words[r.doc_id]]
        for f in r.factors:
            assert f.length >= 50 and f.ref < (r.doc_id if r.doc_id is not None else LAST)
            pieces = {" ".join(w[f.start : f.start + 50]) for w in own}
            assert any(p in text for p in pieces for text in words[f.ref])


def test_a_copy_cut_by_two_sources_is_found_to_the_word(table):
    a, b = [f"a{i}" for i in range(90)], [f"b{i}" for i in range(90)]
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(a[:70] + b[20:])), (4, " ".join(a[60:] + b[:30] + ["z"]))]
    rows.append((5, " ".join(["q"] + a[75:] + b[:40])))
    rows.append((0, " ".join(a[80:] + b[:39])))
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.dedup_substrings(table(rows)).collect()]
    assert Counter(got) == brute_spans(rows, 50)


def test_exact_flags(table, awkward):
    def norm(t):
        return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")

    groups = defaultdict(list)
    for i, t in awkward:
        groups[norm(t)].append(LAST if i is None else i)
    want = []
    for i, t in awkward:
        g = groups[norm(t)]
        keep = None if min(g) == LAST else min(g)
        want.append((i, keep, len(g), i == keep, hashlib.sha256(norm(t).encode()).digest()))
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest)) for r in exact_dedup.flags(table(awkward)).collect()]
    assert Counter(got) == Counter(want)
    kept = exact_dedup.keep_first(table(awkward))
    assert kept.columns == table(awkward).columns
    assert Counter(norm(r.text) for r in kept.collect()) == Counter(groups.keys())


def test_index_lasts_and_an_append_can_be_repeated(spark, table, tmp_path):
    path = str(tmp_path / "index")
    first = exact_dedup.flags(table([(5, "a b"), (6, "c")]), exact_dedup.DigestIndex(spark, path, 4))
    assert {(r.doc_id, r.keep_id) for r in first.collect()} == {(5, 5), (6, 6)}
    index = exact_dedup.DigestIndex(spark, path, 4)
    again = exact_dedup.flags(table([(1, "a  b"), (2, "d"), (2, "d")]), index)
    assert {(r.doc_id, r.keep_id, r.kept, r.group_size) for r in again.collect()} == {(1, 5, False, 1), (2, 2, True, 2)}
    index.append(index.read())
    assert index.read().count() == 3
    assert "Exchange" not in index.read().groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(items, linked):
    left, out = set(range(len(items))), [None] * len(items)
    while left:
        todo = [left.pop()]
        group = []
        while todo:
            x = todo.pop()
            group.append(x)
            near = {y for y in left if linked(items[x], items[y])}
            left -= near
            todo += near
        for x in group:
            out[x] = group
    return out


def test_near_groups_equal_brute_force(table, awkward):
    rows = awkward[:]
    base = max((t or "" for _, t in awkward), key=lambda t: len(t.split())).split()[:1500]
    for k in range(40):  # copies with a few words changed
        w = base[:]
        for j in range(k // 4):
            w[37 * j + k] = f"new{k}"
        rows.append((100 + k, " ".join(w)))
    fps = [brute_fingerprint(t) for _, t in rows]
    groups = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    ids = [LAST if i is None else i for i, _ in rows]
    want = [(i, f"{f:016x}", None if (m := min(ids[x] for x in g)) == LAST else m) for (i, _), f, g in zip(rows, fps, groups)]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_groups(table(rows)).collect()]
    assert Counter(got) == Counter(want)
    kept = simhash.keep_one(table(rows)).collect()
    assert len(kept) == len({id(g) for g in groups})
    assert len({brute_fingerprint(r.text) for r in kept}) == len(kept)


@pytest.mark.parametrize("flips", [0, 1, 2, 3])
def test_linked_fingerprints_meet_at_an_anchor(spark, flips):
    import random

    rng = random.Random(flips)
    pairs = []
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), flips):
            y ^= 1 << b
        pairs.append((x - (x >> 63 << 64), y - (y >> 63 << 64)))
    df = spark.createDataFrame(pairs, "a long, b long")
    meet = F.arrays_overlap(simhash.anchors("a"), simhash.anchors("b"))
    assert df.where(~meet).count() == 0
    assert df.select(F.max(F.size(simhash.anchors("a")))).first()[0] <= 34


def test_full_anchors_and_dense_groups(spark):
    import random

    rng = random.Random(9)
    x = rng.getrandbits(64)
    fps = {x} | {x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(900)}
    fps |= {rng.getrandbits(64) for _ in range(300)}
    fps = sorted(fps)
    want = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    signed = [f - (f >> 63 << 64) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = simhash.links(df)
    assert found.count() < 70 * len(fps)  # forests, not all pairs
    root = {r.node: r.root for r in components.components(found).collect()}
    for f, g in zip(signed, want):
        assert root.get(f, f) == min(signed[y] for y in g)


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 301), (301, 300)]
    root = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(root[i] == 0 for i in range(61)) and all(root[i] == 100 for i in range(100, 160)) and root[301] == 300
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_tables(table):
    empty = table([])
    assert substring_dedup.dedup_substrings(empty).count() == 0
    assert exact_dedup.flags(empty).count() == 0
    assert simhash.near_groups(empty).count() == 0
    assert exact_dedup.keep_first(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_groups_that_share_their_smallest_id_each_keep_a_row(table):
    one, two = (" ".join(f"{w}{i}" for i in range(80)) for w in "ab")
    rows = [(3, one), (3, two), (5, one), (6, two), (3, one), (None, one), (None, two)]
    assert sorted((r.doc_id, r.text) for r in simhash.keep_one(table(rows)).collect()) == [(3, one), (3, two)]
    nameless = [(None, one), (None, two), (None, one)]
    assert sorted(r.text for r in simhash.keep_one(table(nameless)).collect()) == [one, two]


@pytest.mark.parametrize("shingle,tables", [(1, 1), (2, 4), (5, 2)])
def test_several_fingerprints_link_what_any_of_them_links(table, awkward, shingle, tables):
    rows = awkward[:]
    base = max((t or "" for _, t in awkward), key=lambda t: len(t.split())).split()[:300]
    for k in range(40):
        w = base[:]
        for j in range(k // 4):
            w[7 * j + k] = f"new{k}"
        rows.append((100 + k, " ".join(w)))
    fps = [simhash.fingerprints_of((t or "").encode(), shingle, tables) for _, t in rows]
    assert all(len(f) == tables for f in fps) and len({x for f in fps for x in f}) > tables * len(set(map(tuple, fps))) // 2
    groups = brute_components(fps, lambda x, y: any((a ^ b).bit_count() <= 3 for a, b in zip(x, y)))
    kept = simhash.keep_one(table(rows), shingle=shingle, tables=tables).collect()
    assert len(kept) == len({id(g) for g in groups})
    of = {}
    for (i, t), g in zip(rows, groups):
        of[i, t] = id(g)
    assert len({of[r.doc_id, r.text] for r in kept}) == len(kept)
