"""Phrase collocations by dynamic itemset counting.

The texts are dealt into ``shards`` of even size and scanned shard by shard,
round and round. All words are counted from the first scan on. A longer
phrase becomes active after the scan in which both of its subphrases (all
words but the last, all but the first) have reached ``min_count``; it is
counted from the next scan on until it has seen each shard once. So pairs
are counted while words still are, and triples while pairs are, and a phrase
that cannot reach the threshold is never counted. Scans end once no phrase
is left whose cycle is open.

A phrase that has reached the threshold gets an integer name. A longer
phrase is keyed by its first subphrase's name and its last word's name, so
keys are exact. What is known is dealt by key into parts, whose number
follows the size of the texts (``part_bytes``). Each scan is one Spark job:
tasks count the active phrases of their texts in sorted runs and deal them
by part; a part's task merges the runs with the part's counts of the scan
before, names what is new, and writes both to the shared folder. The names
are sorted arrays that the next scan's tasks map into memory. Files are
written under a name of their own and renamed and a scan reads only files
of the scan before, so a task that is run again does no harm; files that no
later scan reads are deleted.

Scores, the rule on longer phrases and the ranking are joins and windows
over the phrases that reached the threshold.

Defined results: a null text is empty, a null lang is ``und``; every row
counts, also one that repeats another or has no doc_id; an empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

import contextlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.llm.common import texts
from ordermill.llm.lm import load, save, shared_folder, small, squeeze, sum_by_key, unsqueeze
from ordermill.session import scratch_path

UNKNOWN = "und"
MIN_COUNT, LONGEST, KEEP = 10, 3, 2000
#: A shorter candidate goes if a longer one that holds it has this share (percent) of its count.
COVERED = 50
#: Shards of a cycle, bytes of text for each part of the counts, bytes that a task tokenises at a time.
SHARDS, PART_BYTES, BLOCK_BYTES = 3, 96 << 20, 8 << 20
#: Distinct words and phrases that a task holds before it passes their counts on.
HOLD_WORDS, HOLD_KEYS = 400_000, 3_000_000
#: Width of the steps of the score (0 to 1,000,000) by which a lang's phrases are counted before they are ranked.
SCORE_STEP = 500
#: Bits of a word's name in a key, and of a longer phrase's.
WORD_BITS, PHRASE_BITS = 30, 34
NEVER = np.iinfo(np.int16).max
_PIECES = bytes(0xFF if b in b".,;:!?\n\v\f\r" else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_STOP = b"\xff"  # in no UTF-8 text

PACKED = "level int, part bigint, lang string, keys binary, n binary"
REPORT = "level int, part bigint, fresh bigint"


def tokens(text: bytes, block: int = BLOCK_BYTES) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The distinct A-Z-lowered words ``[^\\x20\\x09]+``, and the sequence of
    their places in that list with -1 between pieces; of a long text about
    ``block`` bytes at a time, cut between pieces."""
    text = text.translate(_PIECES)
    at = 0
    while at < len(text):
        end = text.find(_STOP, at + block)
        end = len(text) if end < 0 else end
        codes = np.frombuffer(text, np.uint8, end - at, at)
        at = end
        inside = (codes != 0x20) & (codes != 0xFF)
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        if not len(starts):
            continue
        data = pa.py_buffer(codes[inside].tobytes())
        offsets = pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64).tobytes())
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, offsets, data]).dictionary_encode()
        piece = np.searchsorted(np.flatnonzero(codes == 0xFF), starts)
        place = np.arange(len(starts)) + np.concatenate([[0], np.cumsum(piece[1:] != piece[:-1])])
        sequence = np.full(place[-1] + 1, -1, np.int64)
        sequence[place] = words.indices.to_numpy()
        yield words.dictionary.to_pylist(), sequence


def _digests(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts)


def _dense(n: np.ndarray) -> bytes:
    low = small(n)
    return zstandard.compress(low.tobytes() + bytes([low.itemsize]), 1)


def _counts(blob: bytes) -> np.ndarray:
    raw = zstandard.decompress(blob)
    return np.frombuffer(raw[:-1], f"u{raw[-1]}").astype(np.int64)


def _join(words: list[bytes]) -> bytes:
    return zstandard.compress(b"\n".join(words), 1)  # no word holds a line break


def _split(blob: bytes) -> list[bytes]:
    return zstandard.decompress(blob).split(b"\n")


class Names:
    """The names that earlier scans gave, in mapped arrays. ``scans``: by
    length, the last scan that wrote them (-1: none)."""

    def __init__(self, folder: str, parts: int, scans: dict[int, int]):
        self.folder, self.parts, self.scans, self.maps = folder, parts, scans, {}

    def _arrays(self, level: int, part: int, fields: tuple[str, ...]) -> tuple | None:
        if (level, part) not in self.maps:
            base = f"{level}-{part}-{self.scans[level]}"
            there = os.path.exists(f"{self.folder}/{base}-key.npy")
            self.maps[level, part] = tuple(load(self.folder, f"{base}-{f}") for f in fields) if there else None
        return self.maps[level, part]

    def phrases(self, level: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Name (-1: none) and scan of naming of each key; keys are sorted."""
        name, when = np.full(len(keys), -1, np.int64), np.full(len(keys), NEVER, np.int16)
        if self.scans[level] >= 0:
            part = _part(keys, self.parts)
            for p in np.unique(part).tolist():
                if (arrays := self._arrays(level, p, ("key", "name", "when"))) is None or not len(arrays[0]):
                    continue
                at = np.flatnonzero(part == p)
                i = np.minimum(np.searchsorted(arrays[0], keys[at]), len(arrays[0]) - 1)
                hit = arrays[0][i] == keys[at]
                name[at[hit]], when[at[hit]] = arrays[1][i[hit]], arrays[2][i[hit]]
        return name, when

    def words(self, lang: str, words: list[bytes], digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        name, when = np.full(len(words), -1, np.int64), np.full(len(words), NEVER, np.int16)
        if self.scans[1] >= 0 and words:
            order = np.argsort(digests)
            ranked = digests[order]
            part, tag = _part(ranked, self.parts), lang.encode() + b"\n"
            for p in np.unique(part).tolist():
                if (arrays := self._arrays(1, p, ("key", "name", "when", "at", "text"))) is None or not len(arrays[0]):
                    continue
                known, names, whens, at, text = arrays
                own = np.flatnonzero(part == p)
                first, last = (np.searchsorted(known, ranked[own], side) for side in ("left", "right"))
                for i in np.flatnonzero(first < last).tolist():
                    k = int(order[own[i]])
                    for j in range(first[i], last[i]):  # more than one where digests collide
                        if text[at[j]:at[j + 1]].tobytes() == tag + words[k]:
                            name[k], when[k] = names[j], whens[j]
                            break
        return name, when


class _Vocabulary:
    """The words of one language that a task has met."""

    def __init__(self, lang: str, names: Names):
        self.lang, self.names, self.at = lang, names, {_STOP: 0}
        self.digests, self.name, self.when = np.zeros(1, np.uint64), np.full(1, -1, np.int64), np.full(1, NEVER, np.int16)
        self.n = np.zeros(1, np.int64)

    def ids(self, words: list[bytes], sequence: np.ndarray) -> np.ndarray:
        """The task's number of each word of a sequence of places in words (0: a stop)."""
        new = [w for w in words if w not in self.at]
        if new:
            for w in new:
                self.at[w] = len(self.at)
            digests = _digests(self.lang, new)
            name, when = self.names.words(self.lang, new, digests)
            self.digests, self.name = np.concatenate([self.digests, digests]), np.concatenate([self.name, name])
            self.when, self.n = np.concatenate([self.when, when]), np.concatenate([self.n, np.zeros(len(new), np.int64)])
        own = np.fromiter((self.at[w] for w in words), np.int64, len(words))
        return np.where(sequence >= 0, own[sequence], 0)

    def packed(self, parts: int) -> Iterator[tuple]:
        words, part = list(self.at), _part(self.digests, parts)
        at = np.flatnonzero(self.n > 0)
        at = at[at > 0]
        at = at[np.argsort(part[at], kind="stable")]
        for own in np.split(at, np.flatnonzero(np.diff(part[at])) + 1) if len(at) else ():
            yield 1, int(part[own[0]]), self.lang, _join([words[i] for i in own.tolist()]), _dense(self.n[own])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["level", "part", "lang", "keys", "n"])


def _pack_phrases(level: int, runs: list[tuple[np.ndarray, np.ndarray]], parts: int) -> Iterator[tuple]:
    keys, n = sum_by_key(np.concatenate([k for k, _ in runs]), np.concatenate([c for _, c in runs]))
    part = _part(keys, parts)
    order = np.argsort(part, kind="stable")  # keys stay sorted in a part
    for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else ():
        yield level, int(part[own[0]]), None, squeeze(keys[own]), _dense(n[own])


def _scanner(folder: str, parts: int, shards: int, scan: int, scans: dict[int, int], levels: list[int], block: int):
    """The task of one scan: packed counts of the levels that are still open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names(folder, parts, scans)
        vocabularies: dict[str, _Vocabulary] = {}
        runs: dict[int, list] = {level: [] for level in levels if level > 1}
        waiting: dict[str, list[bytes]] = {}
        size = 0

        def count(lang: str, words: list[bytes], sequence: np.ndarray) -> None:
            if lang not in vocabularies:
                vocabularies[lang] = _Vocabulary(lang, names)
            vocabulary = vocabularies[lang]
            at = vocabulary.ids(words, sequence)
            if 1 in levels:
                vocabulary.n += np.bincount(at, minlength=len(vocabulary.n))
            word = vocabulary.name[at]
            name, when = word, vocabulary.when[at]
            for level in range(2, max(levels) + 1):
                where = np.flatnonzero((name[:-1] >= 0) & (name[1:] >= 0))
                key = (name[where] << WORD_BITS | word[where + level - 1]).astype(np.uint64)
                if level in runs:
                    active = np.maximum(when[where], when[where + 1]).astype(np.int64)
                    keys, n = np.unique(key[(active < scan) & (scan <= active + shards)], return_counts=True)
                    runs[level].append((keys, n))
                if level < max(levels):
                    keys, back = np.unique(key, return_inverse=True)
                    known, since = names.phrases(level, keys)
                    name, when = np.full(max(0, len(name) - 1), -1, np.int64), np.full(max(0, len(name) - 1), NEVER, np.int16)
                    name[where], when[where] = known[back], since[back]

        def pass_on(all_: bool) -> Iterator[pa.RecordBatch]:
            if all_ or sum(len(v.at) for v in vocabularies.values()) > HOLD_WORDS:
                for v in vocabularies.values():
                    if rows := list(v.packed(parts)):
                        yield _batch(rows)
                vocabularies.clear()
            for level, held in runs.items():
                if held and (all_ or sum(len(k) for k, _ in held) > HOLD_KEYS):
                    if rows := list(_pack_phrases(level, held, parts)):
                        yield _batch(rows)
                    held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch)):
                waiting.setdefault(lang, []).append(text)
                size += len(text) + 1
                if size >= block:
                    for own, whole in waiting.items():
                        for words in tokens(_STOP.join(whole), block):
                            count(own, *words)
                            yield from pass_on(False)
                    waiting, size = {}, 0
        for own, whole in waiting.items():
            for words in tokens(_STOP.join(whole), block):
                count(own, *words)
        yield from pass_on(True)

    return run


def _named(part: int, parts: int, known: int, fresh: int, bits: int) -> np.ndarray:
    """Names for what is new in a part; no other part gives them."""
    if (known + fresh) * parts >= 1 << bits:
        raise OverflowError(f"more phrases than names of {bits} bits")
    return (known + np.arange(fresh, dtype=np.int64)) * parts + part


def _merge_phrases(folder: str, parts: int, scan: int, before: int, min_count: int, level: int, part: int, rows: list[tuple]) -> int:
    old, new = f"{level}-{part}-{before}", f"{level}-{part}-{scan}"
    key, name, when, n = (np.zeros(0, t) for t in (np.uint64, np.int64, np.int16, np.int64))
    low_key, low_n = key, n
    if os.path.exists(f"{folder}/{old}-key.npy"):
        key, name, when, n = (np.array(load(folder, f"{old}-{f}")) for f in ("key", "name", "when", "n"))
        low_key, low_n = unsqueeze(load(folder, f"{old}-low-key").tobytes()), _counts(load(folder, f"{old}-low-n").tobytes())
    keys = [key, low_key, *(unsqueeze(k) for _, k, _ in rows)]
    all_key, all_n = sum_by_key(np.concatenate(keys), np.concatenate([n, low_n.astype(np.int64), *(_counts(c) for _, _, c in rows)]))
    reached = all_n >= min_count
    low_key, low_n = all_key[~reached], all_n[~reached]
    all_key, all_n = all_key[reached], all_n[reached]
    fresh = np.setdiff1d(all_key, key, assume_unique=True)
    every = np.concatenate([key, fresh])
    order = np.argsort(every)
    save(folder, f"{new}-low-key", np.frombuffer(squeeze(low_key), np.uint8))
    save(folder, f"{new}-low-n", np.frombuffer(_dense(low_n), np.uint8))
    save(folder, f"{new}-n", all_n)
    save(folder, f"{new}-name", np.concatenate([name, _named(part, parts, len(key), len(fresh), PHRASE_BITS)])[order])
    save(folder, f"{new}-when", np.concatenate([when, np.full(len(fresh), scan, np.int16)])[order])
    save(folder, f"{new}-key", every[order])
    return len(fresh)


def _merge_words(folder: str, parts: int, scan: int, before: int, min_count: int, part: int, rows: list[tuple]) -> int:
    old, new = f"1-{part}-{before}", f"1-{part}-{scan}"
    n: dict[str, dict[bytes, int]] = {}
    known: dict[tuple[str, bytes], tuple[int, int]] = {}
    if os.path.exists(f"{folder}/{old}-key.npy"):
        n = {lang: dict(zip(words, counts.tolist())) for lang, words, counts in _languages(folder, old)}
        known = dict(zip(_texts(folder, old), zip(load(folder, f"{old}-name").tolist(), load(folder, f"{old}-when").tolist())))
    for lang, words, counts in rows:
        own = n.setdefault(lang, {})
        for w, c in zip(_split(words), _counts(counts).tolist()):
            own[w] = own.get(w, 0) + c
    fresh = sorted((lang, w) for lang, own in n.items() for w, c in own.items() if c >= min_count and (lang, w) not in known)
    for k, name in zip(fresh, _named(part, parts, len(known), len(fresh), WORD_BITS).tolist()):
        known[k] = name, scan
    keys, values = list(known), list(known.values())
    digests = np.fromiter((_digests(lang, [w])[0] for lang, w in keys), np.uint64, len(keys))
    order = np.argsort(digests, kind="stable").tolist()
    tagged = [keys[i][0].encode() + b"\n" + keys[i][1] for i in order]
    flat = [b for lang, own in sorted(n.items()) for b in (lang.encode(), _join(list(own)), _dense(np.array(list(own.values()), np.int64)))]
    save(folder, f"{new}-all-at", np.concatenate([[0], np.cumsum([len(b) for b in flat])]).astype(np.int64))
    save(folder, f"{new}-all", np.frombuffer(b"".join(flat), np.uint8))
    save(folder, f"{new}-at", np.concatenate([[0], np.cumsum([len(t) for t in tagged])]).astype(np.int64))
    save(folder, f"{new}-text", np.frombuffer(b"".join(tagged), np.uint8))
    save(folder, f"{new}-n", np.array([n[keys[i][0]][keys[i][1]] for i in order], np.int64))
    save(folder, f"{new}-name", np.array([values[i][0] for i in order], np.int64))
    save(folder, f"{new}-when", np.array([values[i][1] for i in order], np.int16))
    save(folder, f"{new}-key", digests[order])
    return len(fresh)


def _slices(folder: str, base: str, name: str, at: str) -> list[bytes]:
    edges, blob = load(folder, f"{base}-{at}").tolist(), load(folder, f"{base}-{name}").tobytes()
    return [blob[a:b] for a, b in zip(edges, edges[1:])]


def _languages(folder: str, base: str) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(lang, words, counts) of a part, named or not."""
    flat = _slices(folder, base, "all", "all-at")
    for lang, words, n in zip(flat[::3], flat[1::3], flat[2::3]):
        yield lang.decode(), _split(words), _counts(n)


def _texts(folder: str, base: str) -> list[tuple[str, bytes]]:
    """(lang, word) of a part's named words."""
    return [(lang.decode(), word) for lang, word in (t.rsplit(b"\n", 1) for t in _slices(folder, base, "text", "at"))]


_FILES = {1: ("all-at", "all", "at", "text", "n", "name", "when", "key"), 2: ("low-key", "low-n", "n", "name", "when", "key")}


def _merger(folder: str, parts: int, scan: int, scans: dict[int, int], stale: dict[int, int], min_count: int):
    """The task of one part after a scan. ``scans`` and ``stale``: by length,
    the scans that wrote the part's last files and those before them, which
    no task reads any more."""

    def run(table: pa.Table) -> pa.Table:
        level, part = table.column("level")[0].as_py(), table.column("part")[0].as_py()
        rows = [r for r in zip(*(table.column(c).to_pylist() for c in ("lang", "keys", "n"))) if r[1] is not None]
        if level == 1:
            fresh = _merge_words(folder, parts, scan, scans[1], min_count, part, rows)
        else:
            fresh = _merge_phrases(folder, parts, scan, scans[level], min_count, level, part, rows)
        for f in _FILES[min(level, 2)]:
            with contextlib.suppress(FileNotFoundError):
                os.remove(f"{folder}/{level}-{part}-{stale[level]}-{f}.npy")
        return pa.table({"level": pa.array([level], pa.int32()), "part": pa.array([part], pa.int64()), "fresh": pa.array([fresh], pa.int64())})

    return run


class Counted:
    """The files of the phrases that reached the threshold: one DataFrame for each length."""

    def __init__(self, spark: SparkSession, folder: str, parts: int, scans: dict[int, int]):
        self.spark, self.folder, self.parts, self.scans = spark, folder, parts, scans

    def _read(self, rows, schema: str) -> DataFrame:
        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import StructType

        wanted = to_arrow_schema(StructType.fromDDL(schema))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in batch.column("id").to_pylist():
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows(part), wanted)], schema=wanted)

        return self.spark.range(0, self.parts, 1, min(self.parts, 10_000)).mapInArrow(run, schema)

    def words(self) -> DataFrame:
        """(name, lang, word, f)"""
        folder, scan = self.folder, self.scans[1]

        def rows(part: int):
            base = f"1-{part}-{scan}"
            named = _texts(folder, base)
            return load(folder, f"{base}-name"), [lang for lang, _ in named], [w for _, w in named], load(folder, f"{base}-n")

        return self._read(rows, "name bigint, lang string, word binary, f bigint").withColumn("word", F.col("word").cast("string"))

    def totals(self) -> DataFrame:
        """(lang, n): all word occurrences of each language."""
        folder, scan = self.folder, self.scans[1]

        def rows(part: int):
            found = [(lang, int(n.sum())) for lang, _, n in _languages(folder, f"1-{part}-{scan}")]
            return [x for x, _ in found], [n for _, n in found]

        return self._read(rows, "lang string, n bigint").groupBy("lang").agg(F.sum("n").alias("n"))

    def phrases(self, level: int) -> DataFrame:
        """(name, prefix, last, f): names of the phrase, of all its words but the last, and of the last."""
        folder, scan = self.folder, self.scans[level]

        def rows(part: int):
            name, key, n = (load(folder, f"{level}-{part}-{scan}-{x}") for x in ("name", "key", "n"))
            key = np.asarray(key).astype(np.int64)
            return name, key >> WORD_BITS, key & ((1 << WORD_BITS) - 1), n

        return self._read(rows, "name bigint, prefix bigint, last bigint, f bigint")


def count(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, shards: int = SHARDS,
          part_bytes: int = PART_BYTES, block_bytes: int = BLOCK_BYTES) -> Counted:
    """All phrases of up to ``longest`` words with their counts, from docs (text, lang)."""
    spark = docs.sparkSession
    folder, path = shared_folder(spark, "collocations"), scratch_path(spark, "collocation-shards")
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text").where("text <> ''")
    rows.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int")).write.option(
        "compression", "zstd").partitionBy("shard").parquet(path)
    dealt = spark.read.schema("lang string, text string, shard int").parquet(path)
    parts = 1 + int(dealt.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // part_bytes
    ticks = spark.range(parts)
    named = dict.fromkeys(range(1, longest + 1), -1)  # by length: the last scan that named a phrase
    scans, stale = dict(named), dict(named)  # the last scan that wrote files, and the one before it
    scan = 0
    while levels := [n for n in named if (scan < shards if n == 1 else 0 < scan <= named[n - 1] + shards)]:
        runs = dealt.where(F.col("shard") == scan % shards).select("lang", "text").mapInArrow(
            _scanner(folder, parts, shards, scan, dict(scans), levels, block_bytes), PACKED)
        tick = ticks.select(F.explode(F.array(*[F.lit(n) for n in levels])).alias("level"), F.col("id").alias("part")).selectExpr(
            "level", "part", "CAST(NULL AS STRING) AS lang", "CAST(NULL AS BINARY) AS keys", "CAST(NULL AS BINARY) AS n")
        merged = runs.unionByName(tick).groupBy("level", "part").applyInArrow(
            _merger(folder, parts, scan, dict(scans), dict(stale), min_count), REPORT)
        for row in merged.groupBy("level").agg(F.sum("fresh").alias("fresh")).collect():
            stale[row.level], scans[row.level] = scans[row.level], scan
            if row.fresh:
                named[row.level] = scan
        scan += 1
    return Counted(spark, folder, parts, scans)


def phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, keep: int = KEEP, covered: int = COVERED,
            buckets: int = 64, **scans) -> DataFrame:
    """The first ``keep`` phrases of each lang: lang, rank, phrase, a (its
    count), l and r (counts of the two sides of its lowest-scoring cut), n
    (words of the lang) and score."""
    from ordermill.llm.common import stored

    found = count(docs, min_count, longest, **scans)
    words = stored(found.words(), "collocation-words")
    level = words.select("name", F.array("name").alias("names"), "lang", F.col("word").alias("phrase"), "f")
    last = words.select(F.col("name").alias("last"), "word")
    every = [level]
    for n in range(2, longest + 1):
        if found.scans[n] < 0:
            break
        before = level.select(F.col("name").alias("prefix"), "names", "lang", "phrase")
        counted = stored(found.phrases(n), "collocation-counts")  # so that joins know its size
        level = stored(counted.join(before, "prefix").join(last, "last").select(
            "name", F.concat("names", F.array("last")).alias("names"), "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), "f"),
            "collocation-phrases")
        every.append(level)
    known = every[0].select("names", "f")
    candidates = words.select(F.lit(None).cast("array<bigint>").alias("names"), "lang", F.lit("").alias("phrase"), "f").where("false")
    for level in every[1:]:
        known, candidates = known.unionByName(level.select("names", "f")), candidates.unionByName(level.select("names", "lang", "phrase", "f"))
    size = F.size("names")
    cut = candidates.select("names", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "names", "a", "k", F.slice("names", F.lit(1), F.col("k")).alias("first"), F.slice("names", F.col("k") + 1, size - F.col("k")).alias("rest"))
    cut = cut.join(known.select(F.col("names").alias("first"), F.col("f").alias("l")), "first").join(
        known.select(F.col("names").alias("rest"), F.col("f").alias("r")), "rest")
    wide = lambda c: f"CAST({c} AS DECIMAL(19, 0))"  # noqa: E731  sums of 38 digits
    cut = cut.withColumn("score", F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * {wide('a')}) * {wide('a')} div ({wide('l')} * {wide('r')})"))
    best = cut.groupBy("names").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    longer = candidates.where(size > 2).select(F.col("f").alias("over"), "names", F.explode(F.sequence(F.lit(2), size - 1)).alias("m")).select(
        "over", "names", "m", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)).alias("at")).select(
        "over", F.slice("names", F.col("at"), F.col("m")).alias("names")).groupBy("names").agg(F.max("over").alias("over"))
    left = candidates.join(best, "names").join(longer, "names", "left").where(
        F.col("over").isNull() | (F.col("over") * 100 < F.col("f") * covered))
    left = stored(left.select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score"), "collocation-scores")
    step = F.expr(f"score div {SCORE_STEP}")  # of each lang, only the steps of the score that are needed are ranked
    above = Window.partitionBy("lang").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    steps = left.groupBy("lang", step.alias("step")).agg(F.count(F.lit(1)).alias("n")).withColumn("above", F.coalesce(F.sum("n").over(above), F.lit(0)))
    least = stored(steps.where(F.col("above") < keep).groupBy("lang").agg(F.min("step").alias("least")), "collocation-steps")
    left = left.join(least, "lang").where(step >= F.col("least")).drop("least")
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    some = left.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(buckets)))  # so that no task ranks all of a lang
    some = some.withColumn("i", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order))).where(F.col("i") <= keep)
    top = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= keep)
    return top.join(stored(found.totals(), "collocation-totals"), "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))
