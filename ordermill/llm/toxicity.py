"""Toxicity by a weighted finite-state pattern grammar.

A lexicon turns the words of a clause into symbols: insult, threat, target,
negation, report, other. Small transducers read the symbols and multiply a
weight into every insult or threat they pass: one strengthens those after a
target ("you ..."), one weakens those after a negation, one those in
reported speech. They are composed once into a single machine, whose run
over a clause gives the clause's score; a text is scored by its strongest
clause and the sum of its clauses.

Learned on a bounded sample of labelled rows: words and word beginnings that
mark toxic texts join the lexicon's insults, with their log-odds as
weights, and a logistic curve turns clause scores into a probability.
Scoring is one pass over the whole texts without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import map_arrow, smallest_hashes, stored

#: Rows of each label that the grammar is learned from at most.
SAMPLE_ROWS = 10_000
#: A learned entry is in so many toxic sample texts at least, and its log-odds are this high.
MIN_TEXTS, MIN_ODDS = 3, 2.5
#: Clean texts that an entry is taken to be in besides those it is in.
DOUBT = 2.0
#: Lengths of the word beginnings that may be learned.
STEMS = (5,)
#: Weight of an entry that the sample has not shown.
PRIOR = 2.0
#: Words whose symbols a task remembers.
CACHE = 200_000

# The grammar's own word lists.
INSULTS = "idiot moron stupid loser scum trash worthless pathetic disgusting clown dumb fool imbecile filth vermin".split()
THREATS = "kill hurt destroy beat stab shoot strangle murder".split()
TARGETS = "you your yours youre he she they them his her their this these those du ihr sie tu vous ils usted ustedes".split()
NEGATIONS = "not no never neither nor isnt arent wasnt dont doesnt nicht kein keine ne pas nunca".split()
REPORTS = "said says say told tells wrote claimed claims called quoted according sagte dit dijo".split()

_TOKEN = re.compile(r"\w+|[.,;:!?\n]+")
INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)


@dataclass(frozen=True)
class Transducer:
    """Deterministic: (state, symbol) -> (state, factor); state 0 starts a clause."""

    states: int
    moves: dict[tuple[int, int], tuple[int, float]]

    def compose(self, other: Transducer) -> Transducer:
        """Both read the same symbols, and their factors multiply."""
        moves = {}
        for (s, x), (s2, f) in self.moves.items():
            for t in range(other.states):
                t2, g = other.moves[t, x]
                moves[s * other.states + t, x] = (s2 * other.states + t2, f * g)
        return Transducer(self.states * other.states, moves)


def after(mark: int, reach: int, insult: float, threat: float, plain_threat: float = 1.0) -> Transducer:
    """Insults and threats up to ``reach`` words after a mark get a factor."""
    moves = {}
    for s in range(reach + 1):
        for x in range(6):
            factor = 1.0
            if x == INSULT:
                factor = insult if s else 1.0
            elif x == THREAT:
                factor = threat if s else plain_threat
            moves[s, x] = (reach if x == mark else max(0, s - 1), factor)
    return Transducer(reach + 1, moves)


def grammar() -> Transducer:
    base = Transducer(1, {(0, x): (0, 1.0 if x in (INSULT, THREAT) else 0.0) for x in range(6)})
    return (base.compose(after(TARGET, 6, insult=1.5, threat=1.5, plain_threat=0.4))
            .compose(after(NEGATION, 3, insult=0.3, threat=0.2)).compose(after(REPORT, 8, insult=0.5, threat=0.5)))


@dataclass
class Model:
    words: dict[str, tuple[int, float]]  # symbol and weight
    stems: dict[str, float]  # beginnings that mark insults
    curve: tuple[float, float, float] = (1.0, 0.0, -2.0)  # of the strongest clause, the log of the sum, one
    machine: Transducer = field(default_factory=grammar)

    def symbol(self, word: str) -> tuple[int, float]:
        if word in self.words:
            return self.words[word]
        weight = max((self.stems.get(word[:n], 0.0) for n in STEMS if len(word) >= n), default=0.0)
        return (INSULT, weight) if weight else (OTHER, 0.0)

    def clauses(self, text: str, cache: dict[str, tuple[int, float]]) -> list[float]:
        """Scores of the clauses with an insult or a threat."""
        low, symbol = text.lower(), self.symbol
        if len(cache) > CACHE:
            cache.clear()
        found = False
        for w in set(re.findall(r"\w+", low)):
            s = cache.get(w)
            if s is None:
                s = cache[w] = symbol(w)
            found |= s[0] <= THREAT
        if not found:
            return []
        out, state, score, moves = [], 0, 0.0, self.machine.moves
        for token in _TOKEN.findall(low):
            if not (token[0].isalnum() or token[0] == "_"):
                if score:
                    out.append(score)
                state, score = 0, 0.0
                continue
            s = cache.get(token) or symbol(token)
            state, factor = moves[state, s[0]]
            score += factor * s[1]
        return [*out, score] if score else out

    def features(self, text: str, cache: dict) -> tuple[float, float]:
        scores = self.clauses(text, cache)
        return (max(scores), math.log1p(sum(scores))) if scores else (0.0, 0.0)

    def score(self, features: tuple[float, float]) -> float:
        a, b, c = self.curve
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a * features[0] + b * features[1] + c))))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps; the classes weigh the same."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w = np.zeros(3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + 0.1 * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        w -= np.linalg.solve(hess, grad)
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the texts of docs (doc_id, text) that labels (doc_id, toxic) mark.

    At most ``sample_rows`` rows of each label, in the order of a hash of
    doc_id; rows without a text, a doc_id or a 0/1 label are not learned
    from, a doc_id with both labels is toxic, one with several texts counts
    with the smallest. Without rows of both labels the word lists alone count.
    """
    marked = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    quotas = docs.sparkSession.createDataFrame([(0, sample_rows), (1, sample_rows)], "toxic int, quota bigint")
    picked = smallest_hashes(marked, "toxic", quotas)
    sample = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("toxic").alias("toxic"))  # a repeated doc_id is one row
    sample = stored(sample, "toxicity-sample")

    def entries(batch: pa.RecordBatch) -> pa.RecordBatch:
        """The words and word beginnings of each text, once per text."""
        names, toxic = [], []
        for t, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = set(re.findall(r"\w+", t.lower()))
            mine = words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}
            names += mine
            toxic += [y] * len(mine)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(toxic, pa.int32())], ["entry", "toxic"])

    sizes = sample.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    n1, n0 = sizes[0] or 0, sizes[1] - (sizes[0] or 0)
    words = {w: (k, PRIOR) for k, group in ((INSULT, INSULTS), (THREAT, THREATS)) for w in group}
    words |= {w: (k, 0.0) for k, group in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in group}
    model = Model(words, {})
    if not n1 or not n0:
        return model
    counts = map_arrow(sample.select("text", "toxic"), entries, "entry string, toxic int").groupBy("entry").agg(
        F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))
    odds = F.log((F.col("t") + 0.5) / (n1 + 1)) - F.log((F.col("n") - F.col("t") + DOUBT) / (n0 + DOUBT))
    listed = F.col("entry").isin([w for w, (k, _) in words.items() if k <= THREAT])
    for r in counts.withColumn("odds", odds).where(listed | ((F.col("t") >= MIN_TEXTS) & (F.col("odds") >= MIN_ODDS))).collect():
        if r.entry.endswith("*"):
            model.stems[r.entry[:-1]] = r.odds
        elif r.entry not in words:
            model.words[r.entry] = (INSULT, r.odds)
        elif words[r.entry][0] <= THREAT:
            model.words[r.entry] = (words[r.entry][0], max(0.0, r.odds))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [held.value.features(t, {}) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("toxic"), *(pa.array([r[i] for r in rows], pa.float64()) for i in (0, 1))], ["toxic", "a", "b"])

    rows = np.array(sorted(map(tuple, map_arrow(sample.select("text", "toxic"), features, "toxic int, a double, b double").collect())))
    model.curve = _logistic(rows[:, 1:], rows[:, 0])
    return model


def learn_labels(labels: DataFrame) -> DataFrame:
    """The rows whose crc32(doc_id as text) mod 5 is not 0 (a null doc_id is none of them)."""
    return labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of docs: doc_id, score, predicted, n_clauses.

    A null text counts as empty: no clause, and the score of such a text.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = held.value, {}
        for batch in batches:
            clauses = [model.clauses(t or "", cache) for t in batch.column("text").to_pylist()]
            scores = [model.score((max(c), math.log1p(sum(c))) if c else (0.0, 0.0)) for c in clauses]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(scores, pa.float64()),
                 pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array([len(c) for c in clauses], pa.int64())],
                ["doc_id", "score", "predicted", "n_clauses"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double, predicted int, n_clauses bigint")
