"""Interpolated modified Kneser-Ney n-gram model (order 2) and its scores.

Counting and storage are Spark jobs over the whole training text; nothing
of it passes the driver but a dozen sums. The model is a set of sorted
arrays in the shared folder, one file for each range of keys:

* ``word-*``: the sorted 64-bit hashes of the training words and their
  counts. A word's place in the order is its number.
* ``pair-*``: the sorted keys (number of the context, number of the word)
  of the distinct bigrams and their counts; with them, for each context of
  the range, its total and how many bigrams of count 1, 2 and 3+ it has.
* ``cont-*``: for each word of the range, in how many contexts it occurs.

Workers map the files into memory and look up sorted keys, so a worker
holds only what it reads. The number of ranges follows the size of the
training text, and is twice the session's shuffle partitions at least. Each file is written under a name of its own and then
renamed, so a task that is run again, or twice at a time, does no harm.

p(w|h) = max(c(hw) - D, 0) / c(h) + (D1 n1(h) + D2 n2(h) + D3 n3+(h)) / c(h) * p(w)
with the same form for p(w) over the numbers of contexts, interpolated with
1 / (V + 1) for the V words and the unknown word.
"""

from __future__ import annotations

import json
import os
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.common import space_words, texts
from ordermill.session import scratch_path

#: Tokens that a task counts or scores at a time.
BLOCK = 1_000_000
#: Bytes of training text for each range of keys, at most (more ranges where the session has many partitions).
SHARD_BYTES = 16 << 20
END = b""  # no word is empty
#: Smoothing of the unigram base score.
ADD = 0.1


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder, as a path that every worker can map files of."""
    path = scratch_path(spark, name)
    if (url := urlparse(path)).scheme not in ("", "file"):
        raise ValueError("memory mapping needs a shared folder that is mounted on all workers; "
                         f"spark.checkpoint.dir is in {url.scheme}")
    path = unquote(url.path) if url.scheme else path
    os.makedirs(path, exist_ok=True)
    return path


def save(folder: str, name: str, array: np.ndarray) -> None:
    part = f"{folder}/.{name}-{uuid.uuid4().hex}.npy"
    np.save(part, array)
    os.replace(part, f"{folder}/{name}.npy")


def load(folder: str, name: str) -> np.ndarray:
    return np.load(f"{folder}/{name}.npy", mmap_mode="r")


def squeeze(array: np.ndarray) -> bytes:
    """Sorted or small numbers: differences, byte planes, compressed."""
    step = np.diff(array.astype(np.uint64), prepend=np.uint64(0))
    return zstandard.compress(step.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unsqueeze(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def sum_by_key(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(n, at)


def small(n: np.ndarray) -> np.ndarray:
    """The counts in the narrowest type that holds them."""
    return n.astype(np.min_scalar_type(int(n.max(initial=0))))


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of counts 1 to 4 (0.5 where they don't tell)."""
    if min(n[:3]) <= 0:
        return 0.5, 0.5, 0.5
    y = n[0] / (n[0] + 2 * n[1])
    raw = (1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2])
    return tuple(min(max(d, 0.05), k - 0.05) for d, k in zip(raw, (1, 2, 3)))


def discount(n: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.where(n <= 0, 0.0, np.where(n == 1, d[0], np.where(n == 2, d[1], d[2])))


def sharded(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(shard, columns)`` of each shard's packed rows; yields rows."""

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        columns = {c: table.column(c).to_pylist() for c in table.column_names}
        return pa.Table.from_pylist(list(fn(shard, columns)), schema=wanted)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    wanted = to_arrow_schema(StructType.fromDDL(schema))
    return df.groupBy("shard").applyInArrow(run, schema)


@dataclass
class Model:
    folder: str
    shards: int
    starts: list[int]  # first word number of each word shard, and the number of words
    tokens: int
    d_pair: tuple[float, float, float]
    d_word: tuple[float, float, float]
    continuations: int
    kinds: tuple[int, int, int]  # words in 1, 2, 3+ contexts

    @property
    def words(self) -> int:
        return self.starts[-1]


def _word_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of the unsigned hash, so that shards follow each other in the order."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _number_shard(numbers: np.ndarray, shards: int, total: int) -> np.ndarray:
    return (numbers.astype(np.uint64) * np.uint64(shards) // np.uint64(max(1, total))).astype(np.int64)


def _range(shard: int, shards: int, total: int) -> tuple[int, int]:
    """The numbers below ``total`` that _number_shard puts in a shard."""
    return -(-shard * total // shards), -(-(shard + 1) * total // shards)


def _packed(shard: np.ndarray, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """One row for each shard of sorted keys with their counts."""
    cuts = np.flatnonzero(np.diff(shard)) + 1
    parts = list(zip(np.split(shard, cuts), np.split(keys, cuts), np.split(n, cuts))) if len(keys) else []
    return pa.RecordBatch.from_arrays(
        [pa.array([int(s[0]) for s, _, _ in parts], pa.int64()), pa.array([squeeze(k) for _, k, _ in parts], pa.binary()),
         pa.array([zstandard.compress(small(c).tobytes() + bytes([small(c).itemsize]), 1) for _, _, c in parts], pa.binary())],
        ["shard", "keys", "n"])


def _unpacked(columns: dict) -> tuple[np.ndarray, np.ndarray]:
    keys = [unsqueeze(b) for b in columns["keys"]]
    raw = [zstandard.decompress(b) for b in columns["n"]]
    n = [np.frombuffer(b[:-1], f"u{b[-1]}").astype(np.int64) for b in raw]
    return sum_by_key(np.concatenate(keys), np.concatenate(n))


class Numbers:
    """Word numbers by the mapped hash arrays; remembers the words of a block."""

    def __init__(self, folder: str, shards: int, starts: list[int]):
        self.folder, self.shards, self.starts = folder, shards, starts

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Each word's number (the number of words if unknown) and count."""
        places: dict[bytes, int] = {}
        at = np.fromiter((places.setdefault(w, len(places)) for w in words), np.int64, len(words))
        hashes = np.fromiter(map(word_hash, places), np.uint64, len(places))
        order = np.argsort(hashes)
        hashes = hashes[order]
        number = np.full(len(hashes), self.starts[-1], np.int64)
        count = np.zeros(len(hashes), np.int64)
        edges = np.searchsorted(_word_shard(hashes, self.shards), np.arange(self.shards + 1))
        for s in range(self.shards):
            a, b = edges[s], edges[s + 1]
            if a < b and self.starts[s + 1] > self.starts[s]:
                known = load(self.folder, f"word-{s}")
                i = np.minimum(np.searchsorted(known, hashes[a:b]), len(known) - 1)
                hit = known[i] == hashes[a:b]
                number[a:b] = np.where(hit, i + self.starts[s], number[a:b])
                count[a:b] = np.where(hit, load(self.folder, f"word-n-{s}")[i], 0)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return number[back][at], count[back][at]


def _token_blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[tuple[list, list[bytes], list[int]]]:
    """(doc_ids, tokens, sizes) of whole documents, about ``block`` tokens at a time."""
    ids, tokens, sizes = [], [], []
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
            words = space_words(text)
            words.append(END)
            ids.append(doc_id)
            sizes.append(len(words))
            tokens += words
            if len(tokens) >= block:
                yield ids, tokens, sizes
                ids, tokens, sizes = [], [], []
    if ids:
        yield ids, tokens, sizes


def _fits(contexts: int) -> None:
    """A context's number and a word's number share 64 bits."""
    if contexts > 1 << 32:
        raise OverflowError(f"{contexts} contexts: keys hold numbers of 32 bits")


def _pair_keys(number: np.ndarray, sizes: list[int], unknown: int) -> np.ndarray:
    """Context and word in one key; a document's first context is the number above the unknown word."""
    before = np.empty(len(number), np.uint64)
    before[1:] = number[:-1]
    before[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = unknown + 1
    return before << np.uint64(32) | number.astype(np.uint64)


def train(docs: DataFrame, shards: int | None = None, block: int = BLOCK) -> Model:
    """Fit on all rows of docs (doc_id, text). A null text is empty: its end
    token alone. No rows: a model in which every word is unknown. Words with
    the same 64-bit hash count as one; 2**32 words and more are an error."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    if not shards:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-size // SHARD_BYTES))
    folder = shared_folder(spark, "lm")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tokens, _ in _token_blocks(batches, 4 * block):
            found = Counter(tokens)
            keys = np.fromiter(map(word_hash, found), np.uint64, len(found))
            order = np.argsort(keys)
            yield _packed(_word_shard(keys[order], shards), keys[order], np.fromiter(found.values(), np.int64, len(found))[order])

    def store_words(shard: int, columns: dict) -> Iterator[dict]:
        keys, n = _unpacked(columns)
        save(folder, f"word-{shard}", keys)
        save(folder, f"word-n-{shard}", small(n))
        yield {"shard": shard, "words": len(keys), "tokens": int(n.sum())}

    packed = "shard bigint, keys binary, n binary"
    sizes = {r.shard: r for r in sharded(rows.mapInArrow(count_words, packed), store_words,
                                         "shard bigint, words bigint, tokens bigint").collect()}
    starts = np.concatenate([[0], np.cumsum([sizes[s].words if s in sizes else 0 for s in range(shards)])]).tolist()
    total, tokens = starts[-1], sum(r.tokens for r in sizes.values())
    contexts = total + 2
    _fits(contexts)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers(folder, shards, starts)
        for _, tokens, sizes in _token_blocks(batches, 2 * block):
            keys = np.sort(_pair_keys(numbers.of(tokens)[0], sizes, total))
            at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            n = np.diff(np.append(at, len(keys)))
            yield _packed(_number_shard(keys[at] >> np.uint64(32), shards, contexts), keys[at], n)

    def store_pairs(shard: int, columns: dict) -> Iterator[dict]:
        keys, n = _unpacked(columns)
        save(folder, f"pair-{shard}", keys)
        save(folder, f"pair-n-{shard}", small(n))
        low, high = _range(shard, shards, contexts)
        context = (keys >> np.uint64(32)).astype(np.int64) - low
        kinds = [np.bincount(context, weights=w, minlength=high - low) for w in (n, n == 1, n == 2, n >= 3)]
        save(folder, f"context-{shard}", np.stack(kinds).astype(np.uint32 if kinds[0].max(initial=0) < 1 << 32 else np.uint64))
        words, times = np.unique(keys & np.uint64(0xFFFFFFFF), return_counts=True)
        stats = [int((n == k).sum()) for k in (1, 2, 3, 4)]
        batch = _packed(_number_shard(words, shards, total), words, times) if len(words) else None
        yield {"shard": -1, "keys": json.dumps(stats).encode(), "n": b""}
        for i in range(batch.num_rows if batch else 0):
            yield {c: batch.column(c)[i].as_py() for c in ("shard", "keys", "n")}

    def store_continuations(shard: int, columns: dict) -> Iterator[dict]:
        if shard < 0:
            stats = [json.loads(b) for b in columns["keys"]]
            yield {"shard": -1, "stats": [sum(x) for x in zip(*stats)]}
            return
        words, n = _unpacked(columns)
        low, high = _range(shard, shards, total)
        dense = np.zeros(high - low, np.int64)
        dense[words.astype(np.int64) - low] = n
        save(folder, f"cont-{shard}", small(dense))
        yield {"shard": shard, "stats": [*(int((n == k).sum()) for k in (1, 2, 3, 4)), int((n >= 3).sum()), int(n.sum())]}

    pairs = sharded(rows.mapInArrow(count_pairs, packed), store_pairs, packed)
    stats = sharded(pairs, store_continuations, "shard bigint, stats array<bigint>").collect()
    pair = next((r.stats for r in stats if r.shard < 0), [0] * 4)
    word = [sum(r.stats[i] for r in stats if r.shard >= 0) for i in range(6)]
    return Model(folder, shards, starts, tokens, discounts(pair), discounts(word[:4]), word[5], (word[0], word[1], word[4]))


class Scorer:
    """A model's probabilities from its mapped arrays."""

    def __init__(self, model: Model):
        self.m, self.numbers = model, Numbers(model.folder, model.shards, model.starts)

    def word_prob(self, number: np.ndarray) -> np.ndarray:
        m = self.m
        n = np.zeros(len(number), np.int64)
        order = np.argsort(number, kind="stable")
        ranked = number[order]
        known = int(np.searchsorted(ranked, m.words))
        shard = _number_shard(ranked[:known], m.shards, m.words)
        for s in np.unique(shard).tolist():
            a, b = np.searchsorted(shard, [s, s + 1])
            n[a:b] = load(m.folder, f"cont-{s}")[ranked[a:b] - _range(s, m.shards, m.words)[0]]
        out = np.empty(len(number))
        left = sum(d * k for d, k in zip(m.d_word, m.kinds)) / m.continuations if m.continuations else 1.0
        out[order] = (n - discount(n, m.d_word)) / max(1, m.continuations) + left / (m.words + 1)
        return out

    def log10(self, number: np.ndarray, sizes: list[int]) -> np.ndarray:
        """Of every token, given the one before."""
        m = self.m
        keys = _pair_keys(number, sizes, m.words)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        n, kinds = np.zeros(len(keys), np.int64), np.zeros((4, len(keys)))
        context = (keys >> np.uint64(32)).astype(np.int64)
        shard = _number_shard(context, m.shards, m.words + 2)
        for s in np.unique(shard).tolist() if m.tokens else ():
            a, b = np.searchsorted(shard, [s, s + 1])
            if not os.path.exists(f"{m.folder}/pair-{s}.npy"):
                continue  # no training text has a context of this range
            known = load(m.folder, f"pair-{s}")
            i = np.minimum(np.searchsorted(known, keys[a:b]), len(known) - 1)
            n[a:b] = np.where(known[i] == keys[a:b], load(m.folder, f"pair-n-{s}")[i], 0)
            kinds[:, a:b] = load(m.folder, f"context-{s}")[:, context[a:b] - _range(s, m.shards, m.words + 2)[0]]
        seen = np.maximum(kinds[0], 1)
        left = np.where(kinds[0] > 0, (m.d_pair[0] * kinds[1] + m.d_pair[1] * kinds[2] + m.d_pair[2] * kinds[3]) / seen, 1.0)
        out = np.empty(len(keys))
        out[order] = np.log10((n - discount(n, m.d_pair)) / seen + left * self.word_prob(number[order]))
        return out


def score(docs: DataFrame, model: Model, block: int = BLOCK) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, n_known, train_tokens,
    base_score, score, perplexity (10 to the power of -score / n_tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for ids, tokens, sizes in _token_blocks(batches, block):
            at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            number, count = scorer.numbers.of(tokens)
            base = np.log10((count + ADD) / (model.tokens + ADD * (model.words + 1)))
            total = np.add.reduceat(scorer.log10(number, sizes), at)
            n = np.array(sizes, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n), pa.array(np.add.reduceat((count > 0).astype(np.int64), at)),
                 pa.array(np.full(len(ids), model.tokens, np.int64)), pa.array(np.add.reduceat(base, at)), pa.array(total),
                 pa.array(10 ** np.minimum(300, -total / n))],
                ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, perplexity double")


def learn_rows(docs: DataFrame) -> DataFrame:
    """The rows whose crc32(doc_id as text) mod 10 is not 0 (a null doc_id is none of them)."""
    return docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0)
