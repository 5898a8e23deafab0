"""License scan by diagonal voting.

Every rolling k-gram of words of every document is hashed and joined with
the positions of the same k-gram in the license templates. A match at word
p of a document and word q of a template votes for the diagonal p - q; a
template that stands in the text puts all its votes on one diagonal, and an
inserted or lost word moves the rest to a neighbouring one. Votes are
summed by diagonal, neighbouring diagonals are merged, and a span is
accepted if it covers enough of its template in few enough words (all of it,
for names that another license's differ from by a word). The words of a
matched k-gram are compared, not only their hash. Templates are paragraphs,
so a license that is cut or has lost some of them is still found; a mere
mention of a license's name has only its base label, if any.

The templates are a short list (checked against ``MAX_TEMPLATE_WORDS``), so
the join broadcasts them and the k-grams are never shuffled; only votes are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import alnum_words, texts

K = 2
#: Share of a template's k-grams that an accepted span has, and its length against the template's.
COVER, STRETCH = 0.75, 1.5
#: Diagonals that differ by no more words are merged.
NEAR = 3
MAX_TEMPLATE_WORDS = 100_000

# The phrases whose every place counts as base, and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# Paragraphs of public licenses and of the notices that refer to them, and their labels.
TEMPLATES = (
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    ("and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the "
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
     "whom the Software is furnished to do so, subject to the following conditions:", "mit"),
    ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", "mit"),
    ("THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
     "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
     "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
     "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
     "conditions are met:", "bsd"),
    ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "bsd"),
    ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
     "the documentation and/or other materials provided with the distribution.", "bsd"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
     "from this software without specific prior written permission.", "bsd"),
    ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
     "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
     "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
     "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
     "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
     "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.", "bsd"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
     "that the above copyright notice and this permission notice appear in all copies.", "isc"),
    ("you may not use this file except in compliance with the License.", "apache"),
    ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
     "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.", "apache"),
    ("See the License for the specific language governing permissions and limitations under the License.", "apache"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
     "this file, You can obtain one at", "mpl"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of", "gpl"),
    ("the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
     "any later version.", "gpl"),
    ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
     "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.", "gpl"),
    ("You should have received a copy of the GNU General Public License along with this program.", "gpl"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
     "published by the Free Software Foundation", "lgpl"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
)
# The kinds of the Creative Commons licenses: the words of the short and of the long name.
CC_KINDS = (("by", "attribution"), ("by sa", "attribution sharealike"), ("by nc", "attribution noncommercial"),
            ("by nc sa", "attribution noncommercial sharealike"), ("by nd", "attribution noderivatives"),
            ("by nc nd", "attribution noncommercial noderivatives"))
# Names that must stand as they are, as another license differs by a word.
EXACT = tuple((text, f"cc-{short.replace(' ', '-')}") for short, long in CC_KINDS for text in (
    f"licensed under cc {short} 4 0", f"licensed under a creative commons {long} 4 0 international license"))
#: Rows that a task hands over at a time.
ROWS = 200_000


def gram_hashes(words: list[bytes], k: int) -> np.ndarray:
    """A 64-bit hash of each k-gram, from the words' CRC-32."""
    crc = zlib.crc32
    codes = np.array([crc(w) for w in words], np.uint64)
    out = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for j in range(k):
        out = (out ^ codes[j:j + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def template_grams(templates, base, k: int, cover: float = COVER, exact=()) -> list[tuple]:
    """(gram, words, template, tpos, size, label, is_base, least); a template
    has k words or more, and a span of it covers at least the share ``least``."""
    rows = []
    every = [(*x, True, 1.0) for x in base] + [(*x, False, 1.0) for x in exact] + [(*x, False, cover) for x in templates]
    for t, (text, label, is_base, least) in enumerate(every):
        words = alnum_words(text.encode())
        if len(words) < k:
            raise ValueError(f"template of fewer than {k} words: {text}")
        for q, gram in enumerate(gram_hashes(words, k).tolist()):
            rows.append((gram, b" ".join(words[q:q + k]).decode(), t, q, len(words), label, is_base, least))
    if len(rows) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words; scan them in parts")
    return rows


def grams(docs: DataFrame, wanted: list[int], k: int) -> DataFrame:
    """(row, doc_id, pos, gram, words, n_words): one row per k-gram of every
    text, and one per document with pos -1 and its number of words.

    row numbers the documents, also those with equal or null doc_ids. The
    words are filled in where the hash is one of ``wanted``.
    """
    known = np.unique(np.array(wanted, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size
            columns = [np.concatenate([h[i] for h in held]) for i in (0, 2, 3, 5)]
            ids = [x for h in held for x in h[1]]
            spoken = [x for h in held for x in h[4]]
            held, size = [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0]), pa.array(ids, pa.int64()), pa.array(columns[1]), pa.array(columns[2]),
                 pa.array(spoken, pa.string()), pa.array(columns[3])], ["row", "doc_id", "pos", "gram", "words", "n_words"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                words = alnum_words(text)
                found = gram_hashes(words, k)
                n = len(found) + 1
                spoken = [None] * n
                for p in np.flatnonzero(np.isin(found, known)).tolist():
                    spoken[p + 1] = b" ".join(words[p:p + k]).decode("utf-8", "replace")
                held.append((np.full(n, row), [doc_id] + [None] * (n - 1), np.arange(-1, n - 1, dtype=np.int64),
                             np.concatenate([np.zeros(1, np.int64), found]), spoken,
                             np.array([len(words)] + [0] * (n - 1), np.int64)))
                row += 1
                size += n
                if size >= ROWS:
                    yield flush()
        if held:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(
        run, "row bigint, doc_id bigint, pos bigint, gram bigint, words string, n_words bigint")


def scan(docs: DataFrame, templates=TEMPLATES, base=BASE, k: int = K, cover: float = COVER, near: int = NEAR, exact=EXACT) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, spans (label, start, words, cover).

    A null or empty text has no words and no labels. score is the largest
    share of a template that a span covers (0 if nothing votes).
    """
    spark = docs.sparkSession
    rows = template_grams(templates, base, k, cover, exact)
    known = spark.createDataFrame(
        rows, "t_gram bigint, t_words string, t int, tpos bigint, size bigint, label string, is_base boolean, least double")
    every = grams(docs, [r[0] for r in rows], k)
    voted = every.join(F.broadcast(known), (F.col("gram") == F.col("t_gram")) & (F.col("words") == F.col("t_words")) & (
        F.col("pos") >= 0), "left").where("t IS NOT NULL OR pos = -1")
    # one row per document, template and diagonal; the rows with pos -1 have no template
    lines = voted.groupBy("row", "t", (F.col("pos") - F.col("tpos")).alias("diag")).agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.first("size").alias("size"),
        F.first("label").alias("label"), F.first("is_base").alias("is_base"), F.first("least").alias("least"), F.count_distinct("tpos").alias("votes"),
        F.min("pos").alias("start"), F.max("pos").alias("end"))
    # neighbouring diagonals of one template: close offsets, one place after the other
    by_place = Window.partitionBy("row", "t").orderBy("start", "diag")
    apart = (F.abs(F.col("diag") - F.lag("diag").over(by_place)) > near) | (
        F.col("end") - F.lag("start").over(by_place) >= F.col("size") * STRETCH) | F.col("is_base")
    parts = lines.withColumn("new", F.coalesce(apart.cast("int"), F.lit(1))).withColumn(
        "part", F.sum("new").over(by_place))
    spans = parts.groupBy("row", "t", "part").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.first("size").alias("size"),
        F.first("label").alias("label"), F.first("is_base").alias("is_base"), F.first("least").alias("least"), F.sum("votes").alias("votes"),
        F.min("start").alias("start"), (F.max("end") + k).alias("end"))
    share = F.when(F.col("t").isNotNull(), F.least(F.lit(1.0), F.col("votes") / (F.col("size") - (k - 1))))
    spans = spans.withColumn("cover", share).withColumn(
        "ok", (F.col("cover") >= F.col("least")) & (
            F.col("end") - F.col("start") <= F.col("size") * F.when(F.col("least") == 1, 1.0).otherwise(STRETCH)))
    at_base = F.col("ok") & F.col("is_base")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return spans.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.count_if(at_base).alias("n_base"),
        F.min(F.when(at_base, F.col("start"))).alias("first_word"), F.max(F.when(at_base, F.col("start"))).alias("last_word"),
        joined(F.when(at_base, F.col("label"))).alias("base_labels"), joined(F.when(F.col("ok"), F.col("label"))).alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("ok"), F.struct(
            "start", (F.col("end") - F.col("start")).alias("words"), "label", "cover")))).alias("spans")).drop("row")
