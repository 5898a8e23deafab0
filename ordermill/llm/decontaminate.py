"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the items' windows. Those of one length m share tables:
the shift table gives, for a block of two words that ends at the current
place, how many words no window can end in (m-1 if the block is in no
window); at shift 0 the suffix-hash bucket of the block lists the windows
that end in it, and direct comparison confirms. So about one word in nine
is looked at. Documents are scanned without a shuffle.

The tables are sorted hash arrays and the items' words as one text, about 40
bytes for each word of the benchmark; blocks whose hashes collide only make
shifts smaller. They are made of one slice of the benchmark at a time
(``slice_bytes`` of text, by a hash of item_id) and broadcast; a benchmark of
several slices is searched slice after slice, each in a job of its own whose
result is stored, so no worker holds more than one slice.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import alnum_words, map_arrow, stored, texts

WINDOW = 10
SLICE_BYTES = 4_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes], known: dict[bytes, int] | None = None) -> np.ndarray:
    """64-bit hashes; ``known`` remembers those of a batch."""
    known = {} if known is None else known
    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter((known[w] for w in words), np.uint64, len(words))


def _blocks(hashes: np.ndarray, block: int) -> np.ndarray:
    """The hash of the block that ends at each place from ``block`` - 1 on."""
    return hashes if block == 1 else (hashes[:-1] * _ODD ^ (hashes[1:] + (hashes[:-1] >> np.uint64(32)))) * _ODD


class WuManber:
    """Search of windows that all have ``m`` words, in items given as (number, words)."""

    def __init__(self, items: list[tuple[int, list[bytes]]], m: int):
        self.m, self.block = m, min(2, m)
        self.far = m - self.block + 1
        keys, shifts, ends, starts, stops, owners, pieces, size = [], [], [], [], [], [], [], 0
        for number, words in items:
            n = len(words) - m + 1  # windows
            found = _blocks(word_hashes(words), self.block)  # found[j] ends at word j + block - 1
            lengths = np.array([len(w) + 1 for w in words])
            at = size + np.concatenate([[0], np.cumsum(lengths)])
            for shift in range(self.far):  # blocks that end ``shift`` words before the end of a window
                keys.append(found[m - self.block - shift:m - self.block - shift + n])
                shifts.append(np.full(n, shift, np.uint8))
            ends.append(found[m - self.block:m - self.block + n])
            starts.append(at[:n])
            stops.append(at[m:m + n] - 1)
            owners.append(np.full(n, number, np.int32))
            pieces.append(b" ".join(words))
            size = int(at[-1])
        key, shift = np.concatenate(keys), np.concatenate(shifts)
        order = np.lexsort((shift, key))
        key, shift = key[order], shift[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))  # the smallest shift of a block
        self.keys, self.shifts = key[first], shift[first]
        end = np.concatenate(ends)
        order = np.argsort(end, kind="stable")
        self.ends, self.starts, self.stops = end[order], np.concatenate(starts)[order].astype(np.uint32), np.concatenate(stops)[order].astype(np.uint32)
        self.owners, self.text = np.concatenate(owners)[order], b" ".join(pieces)

    def nbytes(self) -> int:
        return len(self.text) + sum(x.nbytes for x in (self.keys, self.shifts, self.ends, self.starts, self.stops, self.owners))

    def find(self, words: list[bytes], hashes: np.ndarray) -> list[tuple[int, int]]:
        """(start, item) of every occurrence."""
        found, n, m = [], len(words), self.m
        if n < m:
            return found
        blocks = _blocks(hashes, self.block)
        at = np.minimum(np.searchsorted(self.keys, blocks), len(self.keys) - 1)
        shift = np.where(self.keys[at] == blocks, self.shifts[at], self.far).tolist()
        i = m - self.block  # of the block; it ends at word i + block - 1
        while i < len(shift):
            if step := shift[i]:
                i += step
                continue
            start = i - (m - self.block)
            first, last = np.searchsorted(self.ends, blocks[i], "left"), np.searchsorted(self.ends, blocks[i], "right")
            here = b" ".join(words[start:start + m]) if first < last else b""
            for k in range(first, last):
                if self.text[self.starts[k]:self.stops[k]] == here:
                    found.append((start, int(self.owners[k])))
            i += 1
        return found


def searchers(items: list[tuple[str | None, bytes]], width: int) -> tuple[list[str | None], list[WuManber]]:
    """The items' ids, and the search tables of each length of window."""
    ids: dict[str | None, int] = {}
    by: dict[int, list[tuple[int, list[bytes]]]] = {}
    for item_id, text in items:
        if words := alnum_words(text):
            by.setdefault(min(width, len(words)), []).append((ids.setdefault(item_id, len(ids)), words))
    return list(ids), [WuManber(found, m) for m, found in sorted(by.items())]


def scan(words: list[bytes], tables: tuple[list[str | None], list[WuManber]], known: dict[bytes, int]) -> tuple[list[tuple[int, int]], set[str | None]]:
    """Spans of hit words (start, end) and the items that occur. ``known``: word hashes of the batch."""
    spans, items = [], set()
    ids, tables = tables
    hashes = word_hashes(words, known) if tables else None
    for table in tables:
        for start, owner in table.find(words, hashes):
            spans.append((start, start + table.m))
            items.add(ids[owner])
    return spans, items


def slices(benchmark: DataFrame, width: int, slice_bytes: int):
    """(tables, is_last) of the benchmark's slices, one broadcast after the other."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("id"), "text").where("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // slice_bytes))
    for k in range(n):
        # an item without an id is dealt by its text, so that many of them do not meet
        part = rows.where(F.pmod(F.xxhash64(F.coalesce("id", "text")), F.lit(n)) == k).collect()
        yield benchmark.sparkSession.sparkContext.broadcast(searchers([(r.id, r.text.encode()) for r in part], width)), k + 1 == n


def _release(table: Broadcast, last: bool) -> None:
    """A slice that has been searched is not needed any more."""
    if not last:
        table.unpersist()


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, items (sorted), spans (maximal runs of hit words).

    A null text, document or item, has no words; an item without words is
    never found; equal windows of several items count for each, and rows that
    repeat an item_id add their windows to it. Items without an id count
    together as one item in n_items, and are not in items and items_sha256.
    """
    state = "doc_id bigint, text string, spans binary, items array<string>"
    final = ("doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
             "contaminated boolean, items array<string>, spans array<struct<start: bigint, end: bigint>>")
    df = docs.select(F.col("doc_id").cast("bigint"), "text", F.lit(b"").alias("spans"),
                     F.array().cast("array<string>").alias("items"))
    for table, last in slices(benchmark, width, slice_bytes):

        def run(batch: pa.RecordBatch, table=table, last=last) -> pa.RecordBatch:
            out, known = [], {}
            for doc_id, text, spans, items in zip(batch.column("doc_id").to_pylist(), texts(batch),
                                                  batch.column("spans").to_pylist(), batch.column("items").to_pylist()):
                words = alnum_words(text)
                found, names = scan(words, table.value, known)
                spans = np.concatenate([np.frombuffer(spans, np.int64), np.array(found, np.int64).ravel()])
                names = names.union(items)
                if last:
                    out.append(_row(doc_id, len(words), spans.reshape(-1, 2), names))
                else:
                    out.append({"spans": spans.tobytes(), "items": names})
            if last:
                return pa.RecordBatch.from_pylist(out, schema=_FINAL)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array([r["spans"] for r in out], pa.binary()),
                 pa.array([list(r["items"]) for r in out], pa.list_(pa.string()))], ["doc_id", "text", "spans", "items"])

        df = map_arrow(df, run, final if last else state)
        df = df if last else stored(df, "leaks-so-far")
        _release(table, last)
    return df


_FINAL = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
    ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _row(doc_id, n_words: int, spans: np.ndarray, found: set[str | None]) -> dict:
    items = sorted(i for i in found if i is not None)
    runs: list[list[int]] = []
    for start, end in spans[np.argsort(spans[:, 0], kind="stable")].tolist():
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    hit = sum(b - a for a, b in runs)
    return {"doc_id": doc_id, "n_words": n_words, "n_hit": hit, "n_items": len(found),
            "items_sha256": hashlib.sha256(",".join(items).encode()).hexdigest(), "contaminated": hit > 0,
            "items": items, "spans": [{"start": a, "end": b} for a, b in runs]}


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The rows of docs, with all their columns, that hold no window of the benchmark."""
    for table, last in slices(benchmark, width, slice_bytes):

        def run(batch: pa.RecordBatch, table=table) -> pa.RecordBatch:
            known: dict[bytes, int] = {}
            return batch.filter(pa.array([not scan(alnum_words(t), table.value, known)[0] for t in texts(batch)]))

        docs = map_arrow(docs, run, docs.schema)
        docs = docs if last else stored(docs, "clean-so-far")
        _release(table, last)
    return docs
