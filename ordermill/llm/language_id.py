"""Language ID by nearest centroid over hashed TF-IDF n-gram vectors.

Byte n-grams (1 to 3) of the lowered letters are hashed into ``DIMS``
counts, weighted by log(1+tf)*idf and scaled to length one. Each
language's sample is clustered into a few centroids (spherical k-means),
and a text gets the language of the centroid with the largest cosine. It
is rejected if that cosine is below a limit learned from the sample's texts
and slices of them, by language and by how many distinct n-grams a text has
(short texts have lower cosines), or if it has no letter.

Fit: on at most ``sample_rows`` labelled rows in all (a documented bound,
dealt evenly to the languages that have enough, in the order of a hash of
doc_id); their sparse counts go to the driver. Prediction is one pass over the whole texts with
no shuffle.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import map_arrow, smallest_hashes

DIMS = 8192
SAMPLE_ROWS = 2000
CENTROIDS = 4
#: A text is rejected below this share of a low quantile of the sample's cosines at its size.
REJECT, QUANTILE = 0.35, 0.05
#: Texts and slices that a quantile takes; a language (or size) with fewer has that of all (or of the sizes beside it).
LEAST_TEXTS = 20
#: Without so many in the sample at all: the share of its lowest cosine.
REJECT_FEW = 0.25
#: Characters of the slices of each sample row.
SLICES = tuple(8 << k for k in range(8))
UNKNOWN = "und"
_NOT_WORD = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))
#: Bytes that one step of the n-gram count takes (bounds its memory).
_STEP = 1 << 20


def has_letter(text: str) -> bool:
    """Whether a character is of Unicode category L (number signs like ½ or Ⅷ are not)."""
    return any(map(str.isalpha, text))


def counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of a whole text, in steps that overlap by two bytes."""
    b = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_NOT_WORD).split()) + b" "
    codes = np.frombuffer(b, np.uint8)
    out = np.bincount(codes, minlength=DIMS).astype(np.float32)
    for at in range(0, len(codes), _STEP):
        x = codes[at:at + _STEP + 2].astype(np.uint32)
        two = (x[:-1] << 8 | x[1:])[:_STEP]
        three = two[:len(x) - 2] << 8 | x[2:]
        for gram in (two + np.uint32(1 << 24), three):
            out += np.bincount((gram * np.uint32(2654435761)) >> np.uint32(19), minlength=DIMS)
    return out


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray  # one row each, of length one
    langs: list[str]  # of each centroid
    limits: dict[str, tuple[np.ndarray, np.ndarray]]  # by language, log2 of sizes and the cosine below which a text is rejected

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        x = np.log1p(rows) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine (0 to 1) and whether it is rejected, per text."""
        langs, score, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        known = [i for i, t in enumerate(texts) if t and has_letter(t)]
        if not self.langs:
            rejected[known] = False  # nothing to be far from
            return langs, score, rejected
        for at in range(0, len(known), 64):
            part = known[at:at + 64]
            best, cosine, size = self.nearest(np.stack([counts(texts[i]) for i in part]))
            for i, k, c, n in zip(part, best, cosine, size):
                langs[i], score[i], rejected[i] = self.langs[k], min(1.0, max(0.0, float(c))), c < np.interp(n, *self.limits[self.langs[k]])
        return langs, score, rejected

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest centroid of count vectors, its cosine, and log2 of how many distinct n-grams there are."""
        cosine = self.vectors(rows) @ self.centroids.T
        return cosine.argmax(axis=1), cosine.max(axis=1), np.log2(np.maximum((rows > 0).sum(axis=1), 1))


def _cluster(x: np.ndarray, k: int) -> tuple[np.ndarray, float]:
    """Spherical k-means from the mean and the rows farthest from what is chosen."""
    centers = [x.mean(axis=0)]
    for _ in range(min(k, len(x)) - 1):
        near = (x @ np.stack([c / max(np.linalg.norm(c), 1e-12) for c in centers]).T).max(axis=1)
        centers.append(x[int(near.argmin())])
    c = np.stack(centers)
    for _ in range(12):
        c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        own = (x @ c.T).argmax(axis=1)
        c = np.stack([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
    c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    cosine = x @ c.T
    return c[np.unique(cosine.argmax(axis=1))], float(cosine.max(axis=1).min())


def _curve(size: np.ndarray, cosine: np.ndarray, reject: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Limits at doubling sizes, of which each has texts enough; None if there is none."""
    step = np.floor(size)
    steps = [s for s in np.unique(step) if (step == s).sum() >= LEAST_TEXTS]
    if not steps:
        return None
    return (np.array([size[step == s].mean() for s in steps]),
            np.array([reject * np.quantile(cosine[step == s], QUANTILE) for s in steps]))


def slices(text: str) -> list[str]:
    """Parts of a text, of doubling sizes, from a place that a hash of it gives."""
    at = zlib.crc32(text.encode("utf-8", "replace"))
    parts = [text[at % (len(text) - n):][:n] for n in SLICES if n < len(text)]
    return [t for t in parts if has_letter(t)]


def shares(sizes: list[tuple[str, int]], total: int) -> list[tuple[str, int]]:
    """An even share of ``total`` for each of sizes (name, rows), at most its rows."""
    out, left = [], total
    for i, (name, rows) in enumerate(sorted(sizes, key=lambda s: (s[1], s[0]))):
        out.append((name, min(rows, left // (len(sizes) - i))))
        left -= out[-1][1]
    return out


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, centroids: int = CENTROIDS, reject: float = REJECT) -> Model:
    """Learn from the rows of docs (doc_id, text, lang) that have a lang and a letter.

    At most ``sample_rows`` rows in all: the languages with the most rows
    (so many at most) share it evenly, and what a small one leaves goes to
    the others. A doc_id with several texts in a language counts with the
    smallest. No such rows: a model that predicts ``und``.
    """
    named = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = named.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample_rows).collect()
    quotas = docs.sparkSession.createDataFrame(shares([(r.lang, r["count"]) for r in sizes], sample_rows), "lang string, quota bigint")
    picked = smallest_hashes(named, "lang", quotas)
    sample = named.select("doc_id", "text", "lang").join(F.broadcast(picked), ["doc_id", "lang"], "left_semi")
    sample = sample.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))  # a repeated doc_id is one row

    def sparse(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, whole, at, of = [], [], [], []
        for t, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            for part in [t, *slices(t)] if has_letter(t) else ():
                row = counts(part)
                used = np.flatnonzero(row)
                langs.append(lang)
                whole.append(part is t)
                at.append(used.astype(np.uint16).tobytes())
                of.append(row[used].tobytes())
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(whole, pa.bool_()), pa.array(at, pa.binary()),
                                           pa.array(of, pa.binary())], ["lang", "whole", "at", "n"])

    found = sorted(map(tuple, map_arrow(sample.select("text", "lang"), sparse, "lang string, whole boolean, at binary, n binary").collect()))
    rows = [r for r in found if r[1]]

    def unpacked(part: list[tuple]) -> np.ndarray:
        out = np.zeros((len(part), DIMS), np.float32)
        for i, (_, _, at, of) in enumerate(part):
            out[i, np.frombuffer(at, np.uint16)] = np.frombuffer(of, np.float32)
        return out

    dense = unpacked(rows)
    idf = np.log((1 + len(rows)) / (1 + (dense > 0).sum(axis=0))).astype(np.float32) + np.float32(1)
    model = Model(idf, np.zeros((0, DIMS), np.float32), [], {})
    x, langs = model.vectors(dense), np.array([r[0] for r in rows])
    parts = [(lang, *_cluster(x[langs == lang], centroids)) for lang in sorted(set(langs.tolist()))]
    if parts:
        model.centroids = np.concatenate([c for _, c, _ in parts]).astype(np.float32)
        model.langs = [lang for lang, c, _ in parts for _ in range(len(c))]
        near = [model.nearest(unpacked(found[at:at + 64])) for at in range(0, len(found), 64)]
        best, cosine, size = (np.concatenate(c) for c in zip(*near))
        lang, named_ = np.array(model.langs)[best], np.array([r[0] for r in found])
        few = np.zeros(1), np.full(1, REJECT_FEW * min(low for _, _, low in parts))
        every = _curve(size, cosine, reject) if len(rows) >= LEAST_TEXTS else None
        for name in set(model.langs):
            own = (lang == name) & (named_ == name)
            enough = (langs == name).sum() >= LEAST_TEXTS
            model.limits[name] = (_curve(size[own], cosine[own], reject) if enough else None) or every or few
    return model


def learn_rows(docs: DataFrame) -> DataFrame:
    """The rows whose crc32(doc_id as text) mod 4 is not 2 (a null doc_id is none of them)."""
    return docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of docs: doc_id, lang_pred, score, rejected."""
    model = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, score, rejected = model.value.predict(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(langs), pa.array(score), pa.array(rejected)],
            ["doc_id", "lang_pred", "score", "rejected"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id bigint, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, with all their columns, that the model doesn't reject."""
    model = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(~model.value.predict(batch.column("text").to_pylist())[2]))

    return map_arrow(docs, run, docs.schema)
