"""Removal of repeated byte strings with a logarithmic family of suffix indexes.

Every string of ``length`` bytes that also starts earlier (smaller doc_id,
or earlier in the same document) is removed. The arrays are sparse: of the
``length - GRAM + 1`` grams of ``GRAM`` bytes in each such string, the one
with the smallest hash is sampled, so equal strings sample the same gram at
the same place, and about one suffix in 35 is kept. Suffixes are ordered by
a 48-bit hash of their first ``GRAM`` bytes (their name), not by their text,
so these arrays find equal strings but give no suffix order; arrays are cut
into shards by ranges of names.

1. Whole copies of an earlier document are known by their SHA-256 and take
   no part in the rest: all their bytes go.
2. Documents come in batches, in the order of doc_id. A batch's array is
   merge-scanned, shard by shard, with the arrays of the levels that exist
   and with itself; suffixes that meet another with their name are hits.
   Two levels of equal size are merged into one of twice the size by the
   scan that reads them next, so every suffix is merged log(batches) times.
3. Only hits need their text: it is joined to them by document. A string is
   looked at where its sampled gram is, so a hit carries the bytes of the
   strings that sample it. Hits of equal name are compared on all of these,
   in the order of their places, and all but the first of equal strings are
   spans to remove.
4. The spans of a document are merged and cut from its text.

A name with very many hits is dealt out by longer parts of the strings
around it, so no task compares all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import stored, texts
from ordermill.session import scratch_path

LENGTH = 100
GRAM = 32
BATCHES = 4
#: Copies that are left out of the arrays by a broadcast of their ids (16 bytes
#: each); with more, the arrays hold them and their hits are dropped later.
MOST_COPIES = 4_000_000
#: Hits of one name beyond which it is dealt out by tiles of so many offsets.
HOT, TILE = 20_000, 7
#: Bytes of text a task samples at a time, suffixes it packs at a time, hits it compares at a time.
STEP, PACK, SLICE = 1 << 15, 400_000, 8_000
#: Documents of a batch whose texts a task holds at a time.
ROWS = 256
NULL_ID = -(1 << 63)

_random = np.random.default_rng(20_240_601)
_TABLE = _random.integers(1, 1 << 63, 256, np.uint64)
_BASE = np.uint64(int(_random.integers(1, 1 << 62)) * 2 + 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _extreme(x: np.ndarray, width: int, pick) -> np.ndarray:
    """Sliding minimum or maximum over ``width`` values."""
    cover = 1
    while cover * 2 <= width:
        x = pick(x[:-cover], x[cover:])
        cover *= 2
    return pick(x[:len(x) - (width - cover)], x[width - cover:]) if width > cover else x


def _gram_names(b: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place."""
    n = len(b) - 7
    eight = np.empty(n, np.uint64)
    for o in range(min(8, n)):
        part = b[o:o + (len(b) - o) // 8 * 8].view(np.uint64)
        eight[o::8] = part
    sixteen = (eight[:-8] * _MIX) ^ (eight[8:] + (eight[8:] >> np.uint64(31)))
    sixteen *= _BASE
    sixteen ^= sixteen >> np.uint64(29)
    out = sixteen[:-16] * _MIX + sixteen[16:]
    out ^= out >> np.uint64(32)
    out *= _BASE
    out ^= out >> np.uint64(29)
    return out


def sample(b: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(places, names) of the suffixes that bytes of ``length`` or more keep."""
    if len(b) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    names = _gram_names(b)
    width = length - GRAM + 1
    low = _extreme(names, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    reach = _extreme(np.concatenate([pad, low, pad]), width, np.maximum)
    at = np.flatnonzero(reach == names)
    return at, _spread(names[at])


def _spread(smallest: np.ndarray) -> np.ndarray:
    """48-bit names: the sampled hashes, being smallest ones, are close to 0."""
    x = smallest * _MIX
    x ^= x >> np.uint64(32)
    return (x * _BASE) >> np.uint64(16)


def windows(b: np.ndarray, places: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For sampled places of a text, the smallest and largest offset of a
    sampled gram in the strings that sample it there."""
    names = _gram_names(b)
    width = length - GRAM + 1
    low = _extreme(names, width, np.minimum)
    first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))  # runs of strings with one smallest hash
    last, value = np.append(first[1:], len(low)) - 1, low[first]
    run = np.minimum(np.searchsorted(last, places - width + 1), len(first) - 1)
    found = value[run] == names[places]
    while (more := ~found & (first[np.minimum(run + 1, len(first) - 1)] <= places) & (run + 1 < len(first))).any():
        run += more
        found = value[run] == names[places]
    low_offset, high_offset = places - np.minimum(last[run], places), places - np.maximum(first[run], places - width + 1)
    return np.where(found, low_offset, 1), np.where(found, high_offset, 0)  # none: sampled with a neighbouring text's bytes


def sampled(texts_: list[bytes], length: int = LENGTH) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the text, places, names), over whole texts of any length."""
    group: list[tuple[int, int, int]] = []  # text, its place in the joined bytes, its size
    parts: list[bytes] = []
    size = 0

    def flush() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        at, names = sample(np.frombuffer(b"".join(parts), np.uint8), length)
        starts = np.array([g[1] for g in group])
        edges = np.searchsorted(at, np.append(starts, size))
        for (i, start, n), a, b in zip(group, edges[:-1], edges[1:]):
            inside = at[a:b] + GRAM <= start + n  # grams across texts are none
            yield i, at[a:b][inside] - start, names[a:b][inside]

    for i, t in enumerate(texts_):
        if len(t) < length:
            continue
        if len(t) > STEP:  # pieces that overlap by all but one byte of a string
            found: dict[int, int] = {}
            for start in range(0, len(t) - length + 1, STEP):
                at, names = sample(np.frombuffer(t[start:start + STEP + length - 1], np.uint8), length)
                found |= zip((at + start).tolist(), names.tolist())
            yield i, np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), np.uint64, len(found))
            continue
        group.append((i, size, len(t)))
        parts.append(t)
        size += len(t)
        if size >= STEP:
            yield from flush()
            group, parts, size = [], [], 0
    if group:
        yield from flush()


def _planes(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unplanes(blob: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1).T).view(kind).ravel()


Suffixes = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # names, refs, ties, places
_PACKED = "names binary, refs binary, ties binary, places binary"
_PARTS = ("names", "refs", "ties", "places")


def _pack(s: Suffixes) -> dict[str, bytes]:
    """A suffix array, compressed: sorted names as differences."""
    names, refs, ties, places = s
    ties = _planes(ties) if ties.any() else b""
    return {"names": _planes(np.diff(names, prepend=np.uint64(0))), "refs": _planes(refs), "ties": ties, "places": _planes(places)}


def _unpack(row: dict) -> Suffixes:
    names = np.cumsum(_unplanes(row["names"], np.uint64), dtype=np.uint64)
    ties = _unplanes(row["ties"], np.int64) if row["ties"] else np.zeros(len(names), np.int64)
    return names, _unplanes(row["refs"], np.int64), ties, _unplanes(row["places"], np.int64)


def _merge(arrays: list[Suffixes], distinct: bool = False) -> Suffixes:
    """One array of several; ``distinct``: a suffix that rows of one document repeat is there once."""
    joined = [np.concatenate(c) for c in zip(*arrays)] if arrays else [np.empty(0, t) for t in (np.uint64, *[np.int64] * 3)]
    if not distinct:
        order = np.argsort(joined[0], kind="stable")
        return tuple(c[order] for c in joined)
    order = np.lexsort(joined[::-1])
    joined = [c[order] for c in joined]
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in joined], axis=0)
    return tuple(c[new] for c in joined)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _lists(batch: pa.RecordBatch, name: str) -> Iterator[tuple[np.ndarray, ...]]:
    """Each row of an array-of-structs column as one NumPy array per field."""
    column = batch.column(name)
    fields = [f.to_numpy(zero_copy_only=False) for f in column.values.flatten()]
    offsets = column.offsets.to_numpy()
    for a, b in zip(offsets[:-1], offsets[1:]):
        yield tuple(f[a:b] for f in fields)


def _suffix_arrays(docs: DataFrame, bounds: list[int], shards: int, length: int, distinct: bool) -> DataFrame:
    """(batch, shard, suffix array): sorted runs of each task's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[Suffixes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for batch, arrays in held.items():
                s = _merge(arrays, distinct)
                shard = ((s[0] >> np.uint64(16)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
                cuts = np.searchsorted(shard, np.arange(shards + 1))
                for k in range(shards):
                    if cuts[k] < cuts[k + 1]:
                        row = _pack(tuple(c[cuts[k]:cuts[k + 1]] for c in s))
                        yield pa.RecordBatch.from_pylist([{"batch": batch, "shard": k, **row}], schema=_ROW)

        for batch in _pieces(batches):
            refs, ties = batch.column("ref").to_numpy(), batch.column("tie").to_numpy()
            numbers = np.searchsorted(np.array(bounds, np.int64), refs, side="left")
            for i, places, names in sampled(texts(batch), length):
                n = len(places)
                held.setdefault(int(numbers[i]), []).append((names, np.full(n, refs[i]), np.full(n, ties[i]), places.astype(np.int64)))
                size += n
                if size >= PACK:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    return docs.mapInArrow(run, f"batch int, shard bigint, {_PACKED}")


_ROW = pa.schema([("batch", pa.int32()), ("shard", pa.int64()), *((c, pa.binary()) for c in _PARTS)])


class IndexFamily:
    """Suffix arrays in levels; each level is a table (shard, array) in the
    shared folder. ``distinct``: rows may repeat a document, whose suffixes count once."""

    def __init__(self, shards: int, distinct: bool = False):
        self.shards = shards
        self.distinct = distinct
        self.levels: list[tuple[int, DataFrame]] = []  # batches it holds, rows

    def add(self, array: DataFrame) -> DataFrame:
        """Scan a batch, which follows all before it, against the levels and
        itself; returns the suffixes that are hits since (shard, kind,
        array), of kind 2 if their name is hot."""
        spark, distinct = array.sparkSession, self.distinct
        merge = [i for i in range(1, len(self.levels)) if self.levels[i][0] == self.levels[i - 1][0]]
        twins = {merge[-1] - 1, merge[-1]} if merge else set()
        rows = array.withColumn("level", F.lit(-1))
        for i, (_, level) in enumerate(self.levels):
            rows = rows.unionByName(level.withColumn("level", F.lit(i)))

        def scan(table: pa.Table) -> pa.Table:
            found: dict[int, list[Suffixes]] = {}
            for row in table.to_pylist():
                found.setdefault(row["level"], []).append(_unpack(row))
            shard = table.column("shard")[0].as_py()
            arrays = {level: _merge(parts, distinct) for level, parts in found.items()}
            out = []
            if twins and any(i in arrays for i in twins):
                out.append({"shard": shard, "kind": 0, **_pack(_merge([arrays[i] for i in sorted(twins) if i in arrays]))})
            if -1 in arrays:
                new, before = arrays.pop(-1), _merge([s for level, s in arrays.items()])
                names, times = np.unique(new[0], return_counts=True)
                old_times = np.searchsorted(before[0], names, "right") - np.searchsorted(before[0], names, "left")
                # an older suffix is a hit already if it has met another; all of a name are again when it turns hot
                fresh = (old_times == 1) | ((old_times > 1) & (old_times <= HOT) & (old_times + times > HOT))
                for s, of in ((new, times + old_times > 1), (before, fresh)):
                    at = np.minimum(np.searchsorted(names, s[0]), len(names) - 1)
                    met = (names[at] == s[0]) & of[at]
                    hot = (times + old_times)[at] > HOT
                    for kind, rows in ((1, met & ~hot), (2, met & hot)):
                        if rows.any():
                            out.append({"shard": shard, "kind": kind, **_pack(tuple(c[rows] for c in s))})
            return pa.Table.from_pylist(out, schema=_SCANNED)

        schema = f"shard bigint, kind int, {_PACKED}"
        path = scratch_path(spark, "suffix-level")
        rows.groupBy("shard").applyInArrow(scan, schema).write.partitionBy("kind").parquet(path)
        written = spark.read.schema(schema).parquet(path)
        if twins:
            size = sum(self.levels[i][0] for i in twins)
            self.levels = [x for i, x in enumerate(self.levels) if i not in twins]
            self.levels.insert(min(twins), (size, written.where("kind = 0").drop("kind")))
        self.levels.append((1, array))
        return written.where("kind > 0")


_SCANNED = pa.schema([("shard", pa.int64()), ("kind", pa.int32()), *((c, pa.binary()) for c in _PARTS)])


def _contexts(rows: DataFrame, length: int) -> DataFrame:
    """Each hit with the bytes of the strings that sample it, by the name to compare it by."""
    back = length - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            out: list[tuple] = []
            for ref, tie, packed, (place, name, hot) in zip(batch.column("ref").to_pylist(), batch.column("tie").to_pylist(),
                                                            batch.column("packed").to_pylist(), _lists(batch, "hits")):
                text = zstandard.decompress(packed)
                order = np.lexsort((~hot, place))  # a name that has turned hot is hot in all its hits
                order = order[np.unique(place[order], return_index=True)[1]]
                place, name, hot = place[order], name[order].view(np.uint64), hot[order]
                b = np.frombuffer(text, np.uint8)
                low, high = windows(b, place, length)
                use = low <= high
                place, name, hot, low, high = place[use], name[use], hot[use], low[use], high[use]
                parts = [(name[~hot], place[~hot], low[~hot], high[~hot])]
                for first in range(0, back + 1, TILE) if hot.any() else ():
                    last = min(back, first + TILE - 1)
                    at = place[hot]
                    lows, highs = np.maximum(low[hot], first), np.minimum(high[hot], last)
                    use = lows <= highs  # these strings all have the bytes from their first start to their last end
                    shared = [xxhash.xxh64_intdigest(text[max(0, p - first):p - last + length]) for p in at[use].tolist()]
                    parts.append((np.array(shared, np.uint64) ^ np.uint64(first), at[use], lows[use], highs[use]))
                name, place, low, high = (np.concatenate(c) for c in zip(*parts))
                around = [text[a:e] for a, e in zip((place - high).tolist(), (place - low + length).tolist())]
                out.append((name.view(np.int64), np.full(len(name), ref), np.full(len(name), tie), place, low, high, around))
            if out:
                columns = list(zip(*out))
                arrays = [pa.array(np.concatenate(c), pa.int64()) for c in columns[:6]]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array([x for c in columns[6] for x in c], pa.binary())], _CONTEXT)

    kinds = ", ".join(f"{c} bigint" for c in _CONTEXT[:-1])
    return rows.mapInArrow(run, f"{kinds}, around binary")


_CONTEXT = ["name", "ref", "tie", "place", "low", "high", "around"]


def repeated(names: np.ndarray, low: np.ndarray, high: np.ndarray, around: np.ndarray, length: int,
             seen: dict[int, np.ndarray] | None = None) -> np.ndarray:
    """For hits sorted by (name, place): which of their strings, by the
    offset of the gram, an earlier hit of the same name (or ``seen``) has.
    ``seen`` gets the string hashes of the last name."""
    back = length - GRAM
    out = np.zeros((len(names), back + 1), bool)
    bytes_ = np.ascontiguousarray(around.T)
    salted = names * _MIX
    whole = salted ^ (low.astype(np.uint64) << np.uint64(32)) ^ high.astype(np.uint64)
    for column in bytes_:
        whole = whole * _BASE + _TABLE[column]
    order = np.argsort(whole, kind="stable")
    again = order[1:][whole[order[1:]] == whole[order[:-1]]]  # all bytes around as before: every string is
    offsets = np.arange(back + 1)
    out[again] = (low[again, None] <= offsets) & (offsets <= high[again, None])
    first = np.ones(len(names), bool)
    first[again] = False
    rows = np.flatnonzero(first)
    bytes_, salted, low, high = np.ascontiguousarray(bytes_[:, first]), salted[first], low[first], high[first]
    last = names[first] == names[-1]
    top = np.uint64(pow(int(_BASE), length, 1 << 64))
    h = np.zeros(len(rows), np.uint64)
    for j in range(length):
        h = h * _BASE + _TABLE[bytes_[j]]
    for start in range(back + 1):  # the string from column ``start``: offset back - start
        offset = back - start
        use = np.flatnonzero((low <= offset) & (offset <= high))
        if len(use):
            key = (h[use] ^ salted[use]) * _BASE
            order = np.argsort(key, kind="stable")
            ranked = key[order]
            out[rows[use[order[1:]]], offset] = ranked[1:] == ranked[:-1]
            if seen is not None:
                if offset in seen and len(seen[offset]):
                    old = seen[offset]
                    at = np.minimum(np.searchsorted(old, key), len(old) - 1)
                    out[rows[use], offset] |= old[at] == key
                seen[offset] = np.union1d(seen.get(offset, key[:0]), key[last[use]])
        if start < back:
            h = h * _BASE + _TABLE[bytes_[start + length]] - top * _TABLE[bytes_[start]]
    return out


def _spans(found: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the hit, start, end) of the bytes that repeated strings cover."""
    edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    who, first = np.nonzero(edge == 1)
    last = np.nonzero(edge == -1)[1] - 1
    return who, place[who] - last, place[who] - first + length


def _compare(contexts: DataFrame, length: int) -> DataFrame:
    """(ref, tie, start, end): spans of strings that also start earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        seen: dict[int, np.ndarray] = {}
        seen_name = None

        def step(table: pa.Table, keep: bool) -> pa.RecordBatch:
            nonlocal seen, seen_name
            table = table.combine_chunks()
            name, ref, tie, place, low, high = (table.column(c).to_numpy() for c in ("name", "ref", "tie", "place", "low", "high"))
            name = name.view(np.uint64)
            around = np.zeros((len(name), 2 * length - GRAM), np.uint8)
            for row, start, text in zip(around, (length - GRAM - high).tolist(), table.column("around").to_pylist()):
                row[start:start + len(text)] = np.frombuffer(text, np.uint8)
            if seen_name is None or seen_name != name[0]:
                seen = {}
            carry = keep or bool(seen)
            found = repeated(name, low, high, around, length, seen if carry else None)
            if carry and name[0] != name[-1]:  # what is carried is of the last name alone
                seen = {}
                last = name == name[-1]
                repeated(name[last], low[last], high[last], around[last], length, seen)
            seen_name = name[-1] if keep else None
            seen = seen if keep else {}
            who, start, end = _spans(found, place, length)
            return pa.RecordBatch.from_arrays([pa.array(ref[who]), pa.array(tie[who]), pa.array(start), pa.array(end)],
                                              ["ref", "tie", "start", "end"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= SLICE:
                table = pa.Table.from_batches(held)
                names = table.column("name").to_numpy()
                cut = int(np.flatnonzero(names != names[-1])[-1]) + 1 if names[0] != names[-1] else 0
                if cut:  # whole names; the last one may go on
                    yield step(table.slice(0, cut), False)
                    held, size = table.slice(cut).to_batches(), len(names) - cut
                else:  # one name fills the slice: compare and carry its strings
                    yield step(table, True)
                    held, size = [], 0
        if size:
            yield step(pa.Table.from_batches(held), False)

    return contexts.mapInArrow(run, "ref bigint, tie bigint, start bigint, end bigint")


def cut(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The bytes left, and the starts and ends of the maximal removed runs."""
    order = np.argsort(start, kind="stable")
    start, end = np.maximum(start[order], 0), np.minimum(end[order], len(text))
    if not len(start):
        return text, start, end
    reach = np.maximum.accumulate(end)
    first = np.concatenate([[True], start[1:] > reach[:-1]])
    start, end = start[first], reach[np.append(np.flatnonzero(first)[1:] - 1, len(reach) - 1)]
    edges = [0, *np.column_stack([start, end]).ravel().tolist(), len(text)]
    return b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2])]), start, end


def remove_repeats(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES, shards: int | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    A null text is empty. A null doc_id comes before all others. Different
    texts of one doc_id are ordered by a hash of the text; rows that repeat
    a doc_id and a text are one document listed twice, with one result.
    """
    spark = docs.sparkSession
    if length < GRAM + 8:
        raise ValueError(f"strings of at least {GRAM + 8} bytes")
    shards = shards or 2 * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    plain = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("ref"), F.coalesce("text", F.lit("")).alias("text"))
    facts = plain.agg(F.count("ref").alias("n"), F.count_distinct("ref").alias("d")).first()
    again = facts.n != facts.d  # rows may repeat a document: it is indexed and compared once
    tie = F.xxhash64("text") if again else F.lit(0).cast("bigint")
    rows = plain.select("ref", tie.alias("tie"), "text")
    parts = [k / batches for k in range(1, batches)]
    bounds = sorted(set(plain.agg(F.percentile_approx("ref", parts, 100)).first()[0] or [])) if parts else []

    # whole copies of an earlier document
    marks = rows.select("ref", "tie", F.sha2(F.col("text").cast("binary"), 256).alias("sha"), F.octet_length("text").cast("bigint").alias("n"))
    firsts = marks.groupBy("sha").agg(F.min(F.struct("ref", "tie")).alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    copies = stored(marks.where(F.col("n") >= length).join(firsts, "sha").where(F.struct("ref", "tie") != F.col("first")).select(
        "ref", "tie", "n").distinct(), "suffix-copies")
    ids = copies.select("ref", "tie")
    few = copies.count() <= MOST_COPIES
    indexed = rows.join(F.broadcast(ids), ["ref", "tie"], "left_anti") if few else rows

    path = scratch_path(spark, "suffix-batches")
    _suffix_arrays(indexed.select("ref", "tie", "text"), bounds, shards, length, again).write.partitionBy("batch").parquet(path)
    arrays = spark.read.schema(f"shard bigint, {_PACKED}, batch int").parquet(path)
    family, found = IndexFamily(shards, again), None
    for k in range(len(bounds) + 1):
        hits = family.add(arrays.where(F.col("batch") == k).drop("batch"))
        found = hits if found is None else found.unionByName(hits)

    def unpack(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            for row in batch.to_pylist():
                names, refs, ties, places = _unpack(row)
                yield pa.RecordBatch.from_arrays([pa.array(refs), pa.array(ties), pa.array(places), pa.array(names.view(np.int64)),
                                                  pa.array(np.full(len(refs), row["kind"] == 2))], ["ref", "tie", "place", "name", "hot"])

    hits = found.mapInArrow(unpack, "ref bigint, tie bigint, place bigint, name bigint, hot boolean")
    if not few:
        hits = hits.join(ids, ["ref", "tie"], "left_anti")
    lists = hits.groupBy("ref", "tie").agg(F.collect_list(F.struct("place", "name", "hot")).alias("hits"))

    def pack_text(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches_):
            yield pa.RecordBatch.from_arrays([batch.column("ref"), batch.column("tie"), pa.array(map(zstandard.compress, texts(batch)), pa.binary())],
                                             ["ref", "tie", "packed"])

    # the text is shuffled once, compressed, for the two joins that need it
    packed = rows.mapInArrow(pack_text, "ref bigint not null, tie bigint not null, packed binary")
    listed = packed.join(lists, ["ref", "tie"], "left").where("hits IS NOT NULL")
    contexts = _contexts(listed.dropDuplicates(["ref", "tie"]) if again else listed, length)
    dealt = contexts.repartition("name").sortWithinPartitions("name", "ref", "tie", "place")
    spans = _compare(dealt, length).unionByName(copies.select("ref", "tie", F.lit(0).cast("bigint").alias("start"), F.col("n").alias("end")))
    spans = spans.groupBy("ref", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def finish(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches_):
            size, removed, sha, starts, ends = [], [], [], [], []
            for packed_text, (start, end) in zip(batch.column("packed").to_pylist(), _lists(batch, "spans")):
                text = zstandard.decompress(packed_text)
                left, start, end = cut(text, start, end)
                size.append(len(text))
                removed.append(len(text) - len(left))
                sha.append(hashlib.sha256(left).hexdigest())
                starts.append(start)
                ends.append(end)
            runs = np.array([len(x) for x in starts], np.int64)
            both = pa.StructArray.from_arrays([pa.array(np.concatenate(starts), pa.int64()), pa.array(np.concatenate(ends), pa.int64())], ["start", "end"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs), pa.array(sha, pa.string()),
                 pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(runs)]), pa.int32()), both)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    nothing = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return packed.join(spans, ["ref", "tie"], "left").select(
        F.nullif("ref", F.lit(NULL_ID)).alias("doc_id"), "packed", F.coalesce("spans", nothing).alias("spans")).mapInArrow(
        finish, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
                "spans array<struct<start: bigint, end: bigint>>")
