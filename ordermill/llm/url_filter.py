"""URL filters by a sorted digest array.

Everything that can be looked up is one entry of one index: the hosts that
rules name (with the lengths of their rules' paths), the rules themselves,
and the words that block a host. Spark deals the entries out by ranges of
the XXH64 of their key and writes each range as sorted arrays to the shared
folder: the 64-bit digests, the keys' full text, and what the entry says.
Workers map the files into memory, so a worker holds only the pages of the
list that it reads, however long the list is; nothing is broadcast.

A URL's candidates are the host and what follows each of its dots (no longer
than the longest host of the list), then for hosts that are listed the
prefixes of its path that are as long as one of that host's rules. The
candidates of a batch are hashed, found by one vectorised binary search for
each range, and taken only if the stored text equals the candidate, so
digests that collide do no harm. Judging is one pass without a shuffle.

The longest rule that fits decides (host and path in bytes; of equally long
ones that with the longer host). Without one, the host's words decide: a URL
is blocked if a word of its host is on the word list, else allowed.

Defined results: a null URL, or one without ``://``, has an empty host and
path and is judged like that; a null host or path in a rule is empty, a rule
listed both ways blocks, one listed twice counts once; null words and
verdicts other than allow and block are errors of the list and raise.
Repeated rows are judged row by row, an empty table gives an empty result,
and other columns of the pages are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import alnum_words, map_arrow, stored
from ordermill.llm.lm import load, save, sharded, shared_folder

#: Seed of Spark's ``xxhash64``.
SEED = 42
#: Entries of one range of digests (bounds the memory of the task that stores it).
RANGE_ENTRIES = 1 << 18
ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(key: bytes) -> int:
    return xxhash.xxh64_intdigest(key, SEED)


def _host_key(host: bytes) -> bytes:
    return b"h" + host


def _rule_key(host: bytes, path: bytes) -> bytes:
    return b"r" + host + b"\n" + path


def _word_key(word: bytes) -> bytes:
    return b"w" + word


@dataclass
class Index:
    folder: str
    bits: int  # leading bits of a digest that name its range
    longest_host: int  # bytes


def _ranges(digests: np.ndarray, bits: int) -> np.ndarray:
    return (digests >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(digests), np.int64)


def _entries(rules: DataFrame, words: DataFrame) -> DataFrame:
    """(key, says) of all entries, each key once."""
    known = F.col("verdict").isin(ALLOW, BLOCK)
    verdict = F.when(known, F.col("verdict")).otherwise(F.raise_error(
        F.concat(F.lit("a rule's verdict is allow or block, not "), F.coalesce("verdict", F.lit("null")))).cast("string"))
    listed = rules.select(F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER).alias("host"),
                          F.coalesce("path", F.lit("")).alias("path"), verdict.alias("verdict"))
    rule = listed.groupBy("host", "path").agg(F.max("verdict").alias("says"))  # block is the larger
    host = listed.groupBy("host").agg(F.concat_ws(",", F.sort_array(F.collect_set(F.octet_length("path"))).cast("array<string>")).alias("says"))
    word = words.select(F.when(F.col("word").isNull(), F.raise_error(F.lit("a word is null")).cast("string")).otherwise(
        F.translate("word", _UPPER, _LOWER)).alias("word")).distinct()
    key = lambda *parts: F.concat(*parts).cast("binary").alias("key")
    return rule.select(key(F.lit("r"), "host", F.lit("\n"), "path"), "says").unionByName(
        host.select(key(F.lit("h"), "host"), "says")).unionByName(
        word.select(key(F.lit("w"), "word"), F.lit(BLOCK).alias("says")))


def build(rules: DataFrame, words: DataFrame, range_entries: int = RANGE_ENTRIES, digest_bits: int = 64) -> Index:
    """Store the index of rules (host, path, verdict) and words (word) in the
    shared folder. ``digest_bits`` keeps fewer bits of a digest (tests)."""
    entries = stored(_entries(rules, words), "url-entries")
    n, longest = entries.agg(F.count(F.lit(1)), F.max(F.when(F.expr("substring(key, 1, 1) = X'68'"), F.octet_length("key") - 1))).first()
    bits = max(0, (max(n, 1) - 1) // range_entries).bit_length()
    index = Index(shared_folder(entries.sparkSession, "url-index"), bits, longest or 0)
    folder, keep = index.folder, 64 - digest_bits

    def store(shard: int, columns: dict) -> Iterator[dict]:
        keys, says = columns["key"], [s.encode() for s in columns["says"]]
        hashes = np.array(columns["digest"], np.int64).view(np.uint64) >> np.uint64(keep) << np.uint64(keep)
        order = np.argsort(hashes, kind="stable")
        save(folder, f"digest-{shard}", hashes[order])
        for name, texts in (("key", keys), ("says", says)):
            ordered = [texts[i] for i in order.tolist()]
            save(folder, f"{name}-at-{shard}", np.concatenate([[0], np.cumsum([len(t) for t in ordered])]).astype(np.int64))
            save(folder, f"{name}-{shard}", np.frombuffer(b"".join(ordered), np.uint8))
        yield {"shard": shard, "entries": len(keys)}

    h = F.xxhash64("key")
    range_of = F.shiftrightunsigned(h, 64 - bits).cast("bigint") if bits else F.lit(0).cast("bigint")
    held = sharded(entries.select(range_of.alias("shard"), h.alias("digest"), "key", "says"), store, "shard bigint, entries bigint")
    if (held.agg(F.sum("entries")).first()[0] or 0) != n:
        raise RuntimeError("the URL index is not whole")
    return index


@dataclass
class Probe:
    """Looks keys up in the mapped arrays of an index."""

    index: Index
    digest_bits: int = 64
    maps: dict = field(default_factory=dict)

    def _range(self, s: int) -> tuple | None:
        if s not in self.maps:
            there = os.path.exists(f"{self.index.folder}/digest-{s}.npy")  # a range without an entry has no file
            self.maps[s] = tuple(load(self.index.folder, f"{n}-{s}") for n in ("digest", "key-at", "key", "says-at", "says")) if there else None
        return self.maps[s]

    def find(self, keys: list[bytes]) -> list[bytes | None]:
        """What the entry of each key says; None where there is no such entry."""
        out: list[bytes | None] = [None] * len(keys)
        keep = np.uint64(64 - self.digest_bits)
        hashes = np.fromiter(map(digest, keys), np.uint64, len(keys)) >> keep << keep
        order = np.argsort(hashes)
        hashes = hashes[order]
        ranges = _ranges(hashes, self.index.bits)
        for s in np.unique(ranges).tolist():
            if (maps := self._range(s)) is None:
                continue
            known, key_at, key, says_at, says = maps
            a, b = np.searchsorted(ranges, [s, s + 1])
            first = np.searchsorted(known, hashes[a:b], "left")
            last = np.searchsorted(known, hashes[a:b], "right")
            for i in np.flatnonzero(first < last).tolist():
                want = keys[k := int(order[a + i])]
                for j in range(first[i], last[i]):  # more than one where digests collide
                    if key[key_at[j]:key_at[j + 1]].tobytes() == want:
                        out[k] = says[says_at[j]:says_at[j + 1]].tobytes()
                        break
        return out


def suffixes(host: bytes, longest: int) -> list[bytes]:
    """The host and what follows each of its dots, of ``longest`` bytes at most, longest first."""
    if len(host) <= longest:
        found, at = [host], 0
    else:
        found, at = [], len(host) - longest - 1
    while (at := host.find(b".", at) + 1) > 0:
        found.append(host[at:])
    return found


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a URL; both empty for null and without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, index: Index, digest_bits: int = 64) -> DataFrame:
    """One row per row of pages (page_id, url): page_id, host, path, rule,
    verdict, and the listed word that blocks a URL without a rule."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        probe = Probe(index, digest_bits)
        hosts = [h.encode() for h in batch.column("host").to_pylist()]
        paths = [p.encode() for p in batch.column("path").to_pylist()]
        own = {h: suffixes(h, index.longest_host) for h in dict.fromkeys(hosts)}
        tails = list(dict.fromkeys(t for ts in own.values() for t in ts))
        lengths = {t: [int(x) for x in s.split(b",")] for t, s in zip(tails, probe.find([_host_key(t) for t in tails])) if s is not None}
        tries = [[(t, p[:n]) for t in own[h] if t in lengths for n in lengths[t] if n <= len(p)] for h, p in zip(hosts, paths)]
        wanted = list(dict.fromkeys(x for row in tries for x in row))
        said = dict(zip(wanted, probe.find([_rule_key(*x) for x in wanted])))
        host_words = {h: list(dict.fromkeys(alnum_words(h))) for h in own}
        words = list(dict.fromkeys(w for ws in host_words.values() for w in ws))
        listed = {w for w, s in zip(words, probe.find([_word_key(w) for w in words])) if s is not None}
        rules, verdicts, why = [], [], []
        for h, row in zip(hosts, tries):
            rule = max((x for x in row if said[x] is not None), key=lambda x: (len(x[0]) + len(x[1]), len(x[0])), default=None)
            word = None if rule else next((w for w in host_words[h] if w in listed), None)
            rules.append(b"".join(rule).decode() if rule else None)
            verdicts.append(said[rule].decode() if rule else BLOCK if word else ALLOW)
            why.append(word.decode() if word else None)
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("host"), batch.column("path"), pa.array(rules, pa.string()), pa.array(verdicts, pa.string()),
             pa.array(why, pa.string())], ["page_id", "host", "path", "rule", "verdict", "word"])

    host, path = split_url(F.col("url").cast("string"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return map_arrow(rows, run, f"page_id {kind}, host string, path string, rule string, verdict string, word string")
