"""Cost-balanced packing of tokenized documents into training sequences.

A task tokenizes its documents and packs them in groups of about
``group_tokens``, so nothing is shuffled or collected. In a group, the
sequences are fixed first: as many full ones as the group fills, and the
rest as powers of two (which need no padding), so their capacity is
exactly the group's tokens. Documents longer than a sequence fill whole
sequences of their own. The remaining pieces are taken in descending
order, and each goes to the sequence of the lowest cost so far (linear
plus quadratic in the pieces' lengths) that has room for it; if none has,
it is cut to fill the cheapest ones.

A sequence_id is made of the task's partition and a counter, so a task
that is run again gives the same ids.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache as remembered

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ordermill.llm.common import FORGET

CAPACITY = 4096
END_ID = 2
GROUP_TOKENS = 1 << 20
#: Cost of a piece of n tokens: LINEAR * n + n * n (projections against attention, hidden size 1024).
LINEAR = 6 * 1024
#: Distinct chunks, and words, whose ids a worker remembers (about 200 bytes each): so many that it
#: has met lately, and as many before those.
CACHE = 600_000
#: Texts whose chunks are looked up at a time.
ROWS = 2000
#: A word of letters whose lower case has the same length, and ASCII marks.
_SIMPLE = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\\[-`{-~]*)")
_PROBES = ("word", "Word,", "d\u00c9j\u00c0.", "stra\u00dfe", "\u00d1O\u00d1o,", "xyzzyplugh", "Wort!?;'", "End...\\]`~{")
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@remembered
def _ids_struct(n: int) -> struct.Struct:
    return struct.Struct(f"<{n}I")


def _packed(ids: list[int]) -> bytes:
    return _ids_struct(len(ids)).pack(*ids)


class Encoder(dict):
    """Ids of chunks, as bytes. The tokenizer drops white space and never
    joins what it separates, so a text's ids are those of its chunks, which
    recur; and a word of letters is one piece to its model, so its ids can
    be had from the model alone (which is checked on probes first, as is that
    A-Z count as a-z). Only a batch's distinct chunks are looked up."""

    def __init__(self, path: str, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.cache = cache
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0xC0, 0x100)]
        self.table = {ord(c): as_bytes.pre_tokenize_str(c)[0][0] for c in letters}
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}  # what was met before the last time that the cache was full
        self.old_words: dict[str, bytes] = {}
        self.simple = True
        self.simple = all(self._simple(*_SIMPLE.fullmatch(p).groups()) == self._plain(p) for p in _PROBES)
        self.lowers = all(self._plain(p) == self._plain(p.translate(_UPPER)) for p in _PROBES)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Where the case of A-Z counts: letters that marks are composed with before they are lowered, and added tokens.
        self.cased = "|".join([r"[A-Z]\p{M}", *(f"(?i:{t})" for t in added)])

    def _plain(self, chunk: str) -> bytes:
        return _packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def _simple(self, word: str, mark: str) -> bytes:
        word = word.lower()
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) >= self.cache:
                self.old_words, self.words = self.words, {}
            ids = self.old_words.get(word)
            if ids is None:
                ids = _packed([t.id for t in self.model.tokenize(word if word.isascii() else word.translate(self.table))])
            self.words[word] = ids
        return ids + self[mark] if mark else ids

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            found = _SIMPLE.fullmatch(chunk) if self.simple else None
            ids = self._simple(*found.groups()) if found else self._plain(chunk)
        if len(self) >= self.cache:
            self.old = dict(self)
            self.clear()
        self[chunk] = ids
        return ids

    def ids_of(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of every text (a null is empty)."""
        texts = texts.fill_null("")
        if self.lowers:
            texts = pc.if_else(pc.match_substring_regex(texts, self.cased), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(texts)
        chunks = split.flatten().dictionary_encode()
        known = [self[c] for c in chunks.dictionary.to_pylist()]
        flat = np.frombuffer(b"".join(known), "<u4")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts = np.cumsum(sizes) - sizes
        which = chunks.indices.to_numpy()
        n = sizes[which]
        ends = np.append(0, np.cumsum(n))
        ids = flat[np.repeat(starts[which] - ends[:-1], n) + np.arange(ends[-1])]
        bounds = ends[np.append(0, np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)))].tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def ids(self, text: str) -> np.ndarray:
        return self.ids_of(pa.array([text], pa.string()))[0]


_ENCODERS: dict[tuple[str, int], Encoder] = {}
FORGET.append(_ENCODERS.clear)


def encoder(path: str, cache: int = CACHE) -> Encoder:
    """One per worker process: its cache outlives a task, until another
    operator's task runs there."""
    if (path, cache) not in _ENCODERS:
        _ENCODERS[path, cache] = Encoder(path, cache)
    return _ENCODERS[path, cache]


def assign(lengths: list[int], capacity: int = CAPACITY, linear: int = LINEAR) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of these lengths."""
    out, rest, n_seq = [], [], 0
    for d, n in enumerate(lengths):
        whole = n // capacity
        out += [(d, k * capacity, capacity, n_seq + k, 0) for k in range(whole)]
        n_seq += whole
        if n % capacity:
            rest.append((n % capacity, d, whole * capacity))
    total = sum(r[0] for r in rest)
    tail = total % capacity
    room = np.array([capacity] * (total // capacity) + [1 << b for b in range(tail.bit_length())[::-1] if tail >> b & 1], np.int64)
    cost, used = np.zeros(len(room)), np.zeros(len(room), np.int64)
    for n, d, start in sorted(rest, key=lambda r: (-r[0], r[1])):
        while n:
            fits = room >= n
            s = int(np.where(fits if fits.any() else room > 0, cost, np.inf).argmin())
            take = min(n, int(room[s]))
            out.append((d, start, take, n_seq + s, int(used[s])))
            room[s] -= take
            used[s] += take
            cost[s] += linear * take + take * take
            n, start = n - take, start + take
    return out


_SCHEMA = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         group_tokens: int = GROUP_TOKENS, linear: int = LINEAR, with_ids: bool = False, cache: int = CACHE,
         rows: int = ROWS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and with ``with_ids`` the piece's ids.

    Every row of docs is a document of its own, also when it repeats
    another or its doc_id is null; a null or empty text is the end id alone.
    ``cache`` bounds what a worker remembers, ``rows`` how many texts it looks
    up at a time (less costs time, not results).
    """
    schema = _SCHEMA.append(pa.field("ids", pa.list_(pa.int64()))) if with_ids else _SCHEMA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, cache)
        first = TaskContext.get().partitionId() << 32
        held: list[tuple[int | None, np.ndarray]] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, tokens, first
            pieces = assign([len(ids) for _, ids in held], capacity, linear)
            out = []
            for d, start, n, s, offset in pieces:
                doc_id, ids = held[d]
                part = ids[start:start + n]
                out.append((doc_id, start, n, zlib.crc32(part.tobytes()), len(ids), first + s, offset, *([part.tolist()] if with_ids else [])))
            first += max(p[3] for p in pieces) + 1
            held, tokens = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in (b.slice(i, rows) for b in batches for i in range(0, b.num_rows, rows)):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode.ids_of(batch.column("text"))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                held.append((doc_id, ids))
                tokens += len(ids)
                if tokens >= group_tokens:
                    yield flush()
        if held:
            yield flush()

    columns = ", ".join(f"{n} bigint" for n in _SCHEMA.names) + (", ids array<bigint>" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(run, columns)
