"""The corpus pipeline: five operators of the llm subpackage in a row.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs. All but the
last return the columns of documents; every stage works on all that its
predecessor kept, whatever its size (empty included).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import decontaminate, exact_dedup, language_id, packing, simhash
from ordermill.llm.common import importable, stored
from ordermill.llm.queries import tokenizer_path


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents that the model rejects go (no letter, or far
    from every centroid). The model learns from docs themselves."""
    importable(spark)
    return language_id.accepted(docs, language_id.fit(language_id.learn_rows(docs)))


#: Rows that go are broadcast up to this many (a key of 60 bytes each, so under 64 MB with its table), else joined by a shuffle.
BROADCAST_ROWS = 400_000


#: Distinct chunks whose ids a worker of the packing stage remembers, and texts that it looks up at a time.
PACKING_CACHE = 50_000
PACKING_ROWS = 500


def _keyed(docs: DataFrame) -> tuple[DataFrame, Column, Column]:
    """docs with its columns renamed c0, c1, ... (so no name can clash with a
    stage's own), and what a row is known by: its doc_id and its text's SHA-256."""
    own = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {name: F.col(f"c{i}") for i, name in enumerate(docs.columns)}
    return own, at["doc_id"], F.unhex(F.sha2(F.coalesce(at["text"], F.lit("")).cast("binary"), 256))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of docs whose key is not in gone (gone_id, gone_sha; stored).
    Texts stay where they are while gone is small enough to broadcast, and
    else cross one shuffle."""
    own, doc_id, sha = _keyed(docs)
    small = gone.count() <= BROADCAST_ROWS
    kept = own.join(F.broadcast(gone) if small else gone, doc_id.eqNullSafe(F.col("gone_id")) & (sha == F.col("gone_sha")), "left_anti")
    return kept.toDF(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts, the row with the largest doc_id stays.
    Rows that repeat a doc_id and a text count as one; which one is open, as
    far as other columns differ."""
    importable(spark)
    rows = exact_dedup.exact_duplicates(docs).groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("rows"), F.max("kept").alias("kept"))
    odd = stored(rows.where("NOT kept OR rows > 1").select(
        F.col("doc_id").alias("gone_id"), F.unhex("text_sha256").alias("gone_sha"), "kept"), "exact-odd")
    kept = _without(docs, odd.select("gone_id", "gone_sha"))
    again = odd.where("kept").select("gone_id", "gone_sha")
    if again.isEmpty():
        return kept
    own, doc_id, sha = _keyed(docs)  # rows that stand there more than once: few, so only these are dealt by key
    some = own.withColumns({"gone_id": doc_id, "gone_sha": sha})
    some = some.join(again.toDF("again_id", "again_sha"), F.col("gone_id").eqNullSafe(F.col("again_id")) & (F.col("gone_sha") == F.col("again_sha")),
                     "left_semi").dropDuplicates(["gone_id", "gone_sha"]).drop("gone_id", "gone_sha")
    return kept.unionByName(some.toDF(*docs.columns))


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (4-word shingles, 4 bits): of each component the
    document with the smallest doc_id stays (none: last; of equal ones the
    text with the smallest hash). A row is known by doc_id and text."""
    importable(spark)
    own, doc_id, sha = _keyed(docs)
    text = own.columns[docs.columns.index("text")]
    named = own.select(doc_id.alias("doc_id"), F.col(text).alias("text"), sha.alias("sha"))
    near = simhash.labelled(named, width=4, radius=4, also=("sha",)).where("component_size > 1")
    near = stored(near.select("root", F.col("doc_id").alias("gone_id"), F.col("sha").alias("gone_sha")), "simhash-near")
    order = F.struct(F.col("gone_id").isNull().alias("last"), "gone_id", "gone_sha")
    first = near.groupBy("root").agg(F.min(order).alias("first")).select(
        F.col("first.gone_id").alias("keep_id"), F.col("first.gone_sha").alias("keep_sha"))
    gone = near.join(first, F.col("gone_id").eqNullSafe(F.col("keep_id")) & (F.col("gone_sha") == F.col("keep_sha")), "left_anti")
    return _without(docs, stored(gone.select("gone_id", "gone_sha"), "simhash-gone"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a benchmark window go."""
    importable(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing of what is left into sequences of 4,096 tokens. The workers
    remember little, as their memory is also that of the other stages."""
    importable(spark)
    return packing.pack(docs, tokenizer_path(), cache=PACKING_CACHE, rows=PACKING_ROWS)


STAGES = [("language_id", identify), ("exact_dedup", drop_copies), ("simhash", drop_near),
          ("decontaminate", drop_leaks), ("packing", pack)]

#: SQL can express neither the classifier, the fingerprints nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
