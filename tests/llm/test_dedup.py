"""SimHash, exact dedup and suffix-array dedup against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from helpers import EDGES, SF, documents, words
from ordermill.llm import common, exact_dedup, simhash, suffix_dedup


def plain_fingerprint(text, width=4):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").split(" ")
    w = [x for y in w for x in y.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\v", " ").replace("\f", " ").split(" ") if x]
    if not w:
        return 0
    shingles = [" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))]
    bits = Counter()
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        bits.update(i for i in range(64) if h >> i & 1)
    return sum(1 << i for i in range(64) if 2 * bits[i] > len(shingles))


def brute_components(rows, radius):
    """rows: (doc_id, fingerprint) -> smallest doc_id reachable, per row."""
    prints = sorted({f for _, f in rows})
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    low = {}
    for d, f in rows:
        if d is not None:
            low[find(f)] = min(low.get(find(f), d), d)
    return [low.get(find(f)) for _, f in rows]


def test_simhash_equals_brute_force(spark):
    rows = [(r[0], r[1]) for r in EDGES if r[0] != 9]
    r = random.Random(7)
    for d in range(100, 160):
        w = words(120, d % 9).split()
        for _ in range(d % 5):
            w[r.randrange(len(w))] = "changed"
        rows.append((d, " ".join(w)))
    got = simhash.near_duplicates(documents(spark, rows), 4, 4).collect()
    fps = [(d, plain_fingerprint(t)) for d, t in rows]
    want = Counter((d, f"{f:016x}", c) for (d, f), c in zip(fps, brute_components(fps, 4)))
    assert Counter((x.doc_id, x.fingerprint, x.component_id) for x in got) == want


@pytest.mark.parametrize("radius,prefix,variants", [(4, 4, 2_000_000), (4, 10, 500), (3, 6, 50), (3, 6, 2_000_000), (1, 5, 2_000_000), (2, 8, 2_000_000)])
def test_ball_hashing_loses_no_link(spark, monkeypatch, radius, prefix, variants):
    monkeypatch.setattr(simhash, "VARIANTS", variants)
    r = random.Random(radius * 100 + prefix)
    prints = [r.getrandbits(64) for _ in range(20)]
    for _ in range(150):  # chains of flipped bits
        f = r.choice(prints)
        for _ in range(r.randrange(1, 6)):
            f ^= 1 << r.randrange(64)
        prints.append(f)
    signed = [int(np.uint64(f).view(np.int64)) for f in dict.fromkeys(prints)]
    half = (radius + 1) // 2
    fps = np.array(signed, np.int64).view(np.uint64)
    if variants < 1000:  # the split of a prefix that has too many variants
        got = [(int(a), int(b)) for x, y in simhash.collide(fps, np.full(len(fps), half), 64, radius) for a, b in zip(x, y)]
    else:
        links = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp bigint"), radius, prefix).collect()
        got = [tuple(np.array([x.a, x.b], np.int64).view(np.uint64).tolist()) for x in links]
    rows = [(i, int(f)) for i, f in enumerate(fps)]
    root = {f: f for _, f in rows}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in got:
        root[find(a)] = find(b)
    want = brute_components(rows, radius)
    groups = {}
    for (_, f), c in zip(rows, want):
        groups.setdefault(c, set()).add(find(f))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(1000, 1100)] + [(3, 3)]
    got = {(r.node, r.root) for r in common.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {(i, 100) for i in range(100, 161)} | {(i, 5) for i in range(1000, 1100)} | {(5, 5)}


@pytest.mark.parametrize("block,bits", [(1024, 64), (7, 64), (7, 3), (64, 5)])
def test_exact_dedup_equals_brute_force(spark, block, bits):
    rows = [(r[0], r[1]) for r in EDGES if block > 7 or r[0] not in (9, 10)]
    got = Counter(tuple(r) for r in exact_dedup.exact_duplicates(documents(spark, rows), block, bits).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for k, i in enumerate(sorted(ids, key=lambda i: i != keep)):
            want[(i, keep, len(ids), k == 0, hashlib.sha256(t.encode()).hexdigest())] += 1
    assert got == want


def brute_removed(rows, length):
    """rows: (doc_id, bytes) in order -> what is removed of each."""
    seen, out = set(), []
    for _, b in sorted(rows, key=lambda r: r[0]):
        cover = bytearray(len(b))
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            if s in seen:
                cover[i:i + length] = b"\x01" * length
            seen.add(s)
        out.append(bytes(cover))
    return dict(zip([r[0] for r in sorted(rows, key=lambda r: r[0])], out))


def suffix_rows(seed=3):
    r = random.Random(seed)
    passage = words(60, 77)
    rows = []
    for d in range(60):
        w = words(r.randrange(5, 120), 1000 + d)
        if d % 3 == 0:
            w += passage[r.randrange(40):len(passage) - r.randrange(40)] + words(20, d)
        if d % 7 == 0 and rows:
            w = rows[r.randrange(len(rows))][1]
        if d % 11 == 0 and rows:
            t = list(rows[r.randrange(len(rows))][1])
            for _ in range(3):
                t[r.randrange(len(t))] = "#"
            w = "".join(t)
        rows.append((d * 3 - 20, w))
    return rows + [(500, "ab" * 400), (501, "ab" * 55 + "c" + "ab" * 80), (502, "z" * 99), (503, "z" * 100), (504, "z" * 101), (505, ""), (506, None)]


@pytest.mark.parametrize("batches,hot,step,slice_", [(1, 20_000, 1 << 20, 50_000), (4, 20_000, 1 << 20, 50_000), (7, 1, 300, 10), (5, 3, 1 << 20, 7)])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, batches, hot, step, slice_):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "STEP", step)
    monkeypatch.setattr(suffix_dedup, "SLICE", slice_)
    rows = suffix_rows()
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(documents(spark, rows), batches=batches).collect()}
    want = brute_removed([(d, (t or "").encode()) for d, t in rows], 100)
    assert set(got) == set(want)
    for d, t in rows:
        b = (t or "").encode()
        kept = bytes(x for x, c in zip(b, want[d]) if not c)
        assert (got[d].n_bytes, got[d].n_removed) == (len(b), len(b) - len(kept)), d
        assert got[d].kept_sha256 == hashlib.sha256(kept).hexdigest()
        assert got[d].n_spans == len([x for x in want[d].split(b"\x00") if x])


@pytest.mark.parametrize("batches,hot", [(4, 20_000), (5, 3)])
def test_suffix_dedup_with_more_copies_than_are_left_out(spark, monkeypatch, batches, hot):
    monkeypatch.setattr(suffix_dedup, "MOST_COPIES", 0)
    test_suffix_dedup_equals_brute_force(spark, monkeypatch, batches, hot, 1 << 20, 50_000)


def test_suffix_dedup_on_a_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    want = brute_removed(rows, 100)
    got = suffix_dedup.remove_repeats(docs).collect()
    assert {r.doc_id: r.n_removed for r in got} == {d: sum(c) for d, c in want.items()}


def test_suffix_dedup_edges(spark):
    got = suffix_dedup.remove_repeats(documents(spark, [(r[0], r[1]) for r in EDGES])).collect()
    assert len(got) == len(EDGES)
    copies = [r for r in got if r.doc_id == 7 and r.n_bytes == len(words(40, 1).encode())]
    assert len(copies) == 2 and all(r.n_removed == r.n_bytes for r in copies)  # a copy of 6, listed twice
    assert next(r for r in got if r.doc_id == 10).n_removed == 59_999  # a^100 starts first at 0


@pytest.mark.parametrize("batches,hot", [(1, 20_000), (4, 20_000), (4, 1)])
def test_suffix_dedup_of_a_document_listed_twice(spark, monkeypatch, batches, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    once = [(None, words(50, 40)), (1, words(60, 41)), (2, words(60, 42)), (3, words(20, 43) + words(60, 42)[30:] + words(20, 44)),
            (4, words(60, 45)), (5, words(60, 41)), (6, words(50, 40)[20:] + words(9, 46))]
    rows = once + [(None, words(50, 40)), (2, words(60, 42)), (2, words(60, 42)), (3, once[3][1]), (4, words(60, 45))]
    want = brute_removed([(-1 if d is None else d, t.encode()) for d, t in once], 100)
    got = Counter((r.doc_id, r.n_removed, r.kept_sha256) for r in suffix_dedup.remove_repeats(documents(spark, rows), batches=batches).collect())
    kept = {d: bytes(x for x, c in zip(t.encode(), want[-1 if d is None else d]) if not c) for d, t in once}
    assert got == Counter((d, len(t.encode()) - len(kept[d]), hashlib.sha256(kept[d]).hexdigest()) for d, t in rows)
    assert kept[None] == words(50, 40).encode() and 0 < len(kept[3]) < len(once[3][1].encode())


@pytest.mark.parametrize("run", [simhash.near_duplicates, exact_dedup.exact_duplicates, suffix_dedup.remove_repeats])
def test_empty_table(spark, run):
    assert run(documents(spark, EDGES).limit(0)).collect() == []


def test_simhash_edges(spark):
    assert simhash.near_duplicates(documents(spark, EDGES)).count() == len(EDGES)
