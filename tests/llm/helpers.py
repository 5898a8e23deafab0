"""Small tables for the operators' tests."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
WORDS = ("the of and to in that was he for it with as his on be at by had not are but from or have an they which "
         "le la des une pour dans qui sur der die und nicht mit sich den auf").split()


def words(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(("", "", "ing", "ed", "ly", "er", "é")) for _ in range(n))


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang). Extra columns have the operators' own names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", 0) for r in rows]
    df = spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    from pyspark.sql import functions as F

    clash = ("fp", "row", "ref", "tie", "spans", "score", "h", "names", "blocks", "kept", "n", "low", "prefix", "label", "hits")
    return df.select("*", *(F.lit("clash").alias(c) for c in clash))


EDGES = [
    (1, None, None), (2, ""), (3, " \t\n"), (4, "Osrän"), (5, "\u0000\u0001 !!! ..."), (None, "a row without an id"), (None, None),
    (6, words(40, 1)), (7, words(40, 1)), (7, words(40, 1)), (7, "another text of seven"), (8, "你好 世界 \U0001f600"),
    (9, words(30_000, 2)), (10, "a" * 60_000), (11, "x"), (12, words(40, 1).upper()), (-5, "negative id"),
]
