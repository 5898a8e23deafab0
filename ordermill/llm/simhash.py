"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints at distance <= 2h share a value at distance <= h from
both, and two that share such a value are at distance <= 2h. So every
distinct fingerprint stands for all its variants within h flipped bits,
and fingerprints that meet in a variant are linked. (For an odd radius
2h - 1, one of the two must be within h - 1 of the variant.)

The variants are not shuffled one by one (2,081 for h = 2). A variant is
dealt by its first ``prefix`` bits, and a fingerprint is sent once to each
prefix that one of its variants has (56 rows for 10 bits); the task that
holds a prefix lists the variants there, sorts them and links those that
collide. The prefix grows with the number of fingerprints, so a task's
share stays bounded; a prefix with too many variants is split in place by
its next bits. Only a spanning set of links leaves a task, never all pairs
of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import connected_components, map_arrow, space_words, stored, texts

SEED = 42
#: Variants that one step of a task holds (about 40 bytes each).
VARIANTS = 2_000_000
ONES = np.uint64(0x0101010101010101)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit (index 0: the lowest)."""
    rows = np.zeros(-(-len(hashes) // 255) * 255, np.uint64)
    rows[:len(hashes)] = hashes
    rows = rows.reshape(-1, 255)  # eight counters of one byte to a word
    out = np.empty((8, 8), np.int64)
    for j in range(8):
        lanes = ((rows >> np.uint64(j)) & ONES).sum(axis=1, dtype=np.uint64)
        out[:, j] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out.reshape(64)


def fingerprint(text: bytes, width: int) -> int:
    words = space_words(text)
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[:len(words) - width + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1:].tolist())]
    counts = bit_counts(np.array(hashes, np.uint64))
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 4, also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp): fp is the 64-bit fingerprint as a signed BIGINT.

    Words are split at white space after A-Z are lowered, shingles of
    ``width`` words count as often as they occur, and a bit is set if over
    half the shingles' XXH64 have it. Fewer words: the whole sequence is
    one shingle. Empty, null or blank text: 0.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, width) for t in texts(batch)], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(fps), *map(batch.column, also)], ["doc_id", "fp", *also])

    extra = "".join(f", {f.name} {f.dataType.simpleString()}" for f in docs.select(*also).schema)
    return map_arrow(docs.select("doc_id", "text", *also), run, "doc_id bigint, fp bigint" + extra)


def masks(bits: int, most: int) -> list[np.ndarray]:
    """By weight 0..most, the numbers of ``bits`` bits with so many ones."""
    return [np.array([sum(1 << i for i in c) for c in combinations(range(bits), w)], np.uint64) for w in range(most + 1)]


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index of each index's component under the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def collide(fps: np.ndarray, budget: np.ndarray, free: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between fingerprints that share a variant, given those of one
    prefix: the low ``free`` bits may still take ``budget`` flips each."""
    sets = masks(min(free, 64), int(budget.max(initial=0)))
    many = [sum(math.comb(free, w) for w in range(r + 1)) for r in range(len(sets))]
    if sum(many[r] * int((budget == r).sum()) for r in range(len(sets))) > VARIANTS and len(fps) > 1 and free > 4:
        at = (fps >> np.uint64(free - 4)) & np.uint64(15)
        for value in range(16):  # the next four bits, one value after the other
            left = budget.astype(np.int64) - np.bitwise_count(at ^ np.uint64(value))
            if (left >= 0).sum() > 1:
                yield from collide(fps[left >= 0], left[left >= 0], free - 4, radius)
        return
    low = fps & np.uint64((1 << free) - 1)
    odd = radius % 2
    values, owners, far = [], [], []
    for outer in range(1 + odd):  # of an odd radius, the variants at h flips come last
        for r in range(len(sets)):
            who = np.flatnonzero(budget == r)
            flips = sets[r] if outer else np.concatenate([np.empty(0, np.uint64), *sets[:r + 1 - odd]])
            values.append((low[who][:, None] ^ flips).ravel())
            owners.append(np.repeat(who.astype(np.int32), len(flips)))
            far.append(np.full(len(values[-1]), bool(outer)))
    value, owner, far = np.concatenate(values), np.concatenate(owners), np.concatenate(far)
    order = np.argsort(value, kind="stable" if odd else None)
    value, owner, far = value[order], owner[order], far[order]
    same = np.concatenate([[False], value[1:] == value[:-1]])
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(value))))
    same &= ~far[first]
    a, b = owner[first[same]], owner[same]
    near = np.bitwise_count(fps[a] ^ fps[b]) <= radius
    a, b = a[near], b[near]
    if len(a):
        root = components(len(fps), a, b)
        rest = np.flatnonzero(root != np.arange(len(fps)))
        yield fps[rest], fps[root[rest]]


def links(fps: DataFrame, radius: int, prefix: int) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints (column fp)
    within ``radius`` bits of each other."""
    half = (radius + 1) // 2
    free = 64 - prefix
    route = [int(m) for group in masks(prefix, half) for m in group]
    dealt = fps.select("fp", F.explode(F.array(*map(F.lit, route))).alias("mask")).select(
        F.shiftrightunsigned("fp", free).bitwiseXOR(F.col("mask")).alias("prefix"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 2), np.uint64)

        def step(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            cuts = np.flatnonzero(np.diff(rows[:, 0])) + 1
            for part in np.split(rows, cuts):
                if len(part) > 1:
                    left = half - np.bitwise_count((part[:, 1] >> np.uint64(free)) ^ part[:, 0]).astype(np.int64)
                    for a, b in collide(part[:, 1], left, free, radius):
                        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            rows = np.column_stack([batch.column(i).to_numpy().view(np.uint64) for i in (0, 1)])
            held = np.concatenate([held, rows])
            if len(held) and held[0, 0] != held[-1, 0]:
                last = int(np.searchsorted(held[:, 0], held[-1, 0]))
                yield from step(held[:last])
                held = held[last:]
        yield from step(held)

    return dealt.repartition("prefix").sortWithinPartitions("prefix", "fp").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = 4) -> DataFrame:
    """One row per row of docs: doc_id, fp, fingerprint, component_id, component_size.
    See ``labelled``.
    """
    return labelled(docs, width, radius).drop("root")


def labelled(docs: DataFrame, width: int = 4, radius: int = 4, also: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: doc_id, fp, fingerprint, component_id, component_size,
    root (one value for each component), and docs' columns named in ``also``.

    component_id is the smallest doc_id that links of at most ``radius``
    differing bits reach (the row itself included; null doc_ids count as
    none, a component of only those has null). component_size counts rows.
    """
    rows = stored(fingerprints(docs, width, also), "simhash-fp")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n"))
    prefix = min(24, max(4, math.ceil(math.log2(max(1, rows.select("fp").distinct().count()) / 256 + 1))))
    found = connected_components(links(distinct, radius, prefix))
    named = distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "low", "n", F.coalesce("root", "fp").alias("root"))
    named = stored(named, "simhash-roots")
    groups = named.groupBy("root").agg(F.min("low").alias("component_id"), F.sum("n").alias("component_size"))
    ids = named.join(groups, "root").select("fp", "component_id", "component_size", "root")
    return rows.join(ids, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "component_size", "root", *also)
