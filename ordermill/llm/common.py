"""Helpers shared by the operators: scratch tables, Arrow maps, components."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.session import scratch_path

#: A-Z to a-z; all bytes outside words (ASCII other than letters and digits) to a space.
ALNUM_WORDS = bytes(
    ord(chr(b).lower()) if chr(b).isascii() and chr(b).isalnum() else (b if b >= 0x80 else 0x20)
    for b in range(256)
)


def alnum_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the A-Z-lowered UTF-8 text."""
    return text.translate(ALNUM_WORDS).split()


def space_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the A-Z-lowered UTF-8 text."""
    return text.lower().split()


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a string column; a null is empty."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


#: What empties the caches that operators keep in a worker between their tasks.
FORGET: list[Callable[[], None]] = []


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``mapInArrow`` of a function of one batch. The worker first drops what
    other operators have kept in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ordermill.llm import common  # the worker's own module, not what is pickled with this function

        for forget in common.FORGET:
            forget()
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


#: Rows and bytes of texts that a Python worker is handed at a time (bounds its memory).
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it
    (in local mode, or where all machines mount it); a cluster that does
    not gets it with ``--py-files``. Workers get texts in small batches."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives
    the loss of any executor, and is not computed twice."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def smallest_hashes(rows: DataFrame, group: str, quotas: DataFrame, steps: int = 12) -> DataFrame:
    """(doc_id, group): of each group the ``quota`` distinct doc_ids with the
    smallest hash. quotas: (group, quota), few rows.

    Ids are counted by group and the first ``steps`` bits of their hash; only
    those up to the step in which a group's quota is full are ranked, so no
    task ranks a whole group, however large.
    """
    h = F.xxhash64("doc_id")
    step = F.shiftrightunsigned(h.bitwiseXOR(F.lit(-1 << 63)), 64 - steps)  # in the order of the signed hash
    ids = rows.select("doc_id", group).distinct().join(F.broadcast(quotas), group).withColumn("step", step)
    up_to = Window.partitionBy(group).orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    counts = ids.groupBy(group, "step").agg(F.count(F.lit(1)).alias("n"), F.first("quota").alias("quota"))
    wanted = counts.withColumn("before", F.coalesce(F.sum("n").over(up_to), F.lit(0))).where("before < quota").groupBy(group).agg(
        F.max("step").alias("last"))
    near = ids.join(F.broadcast(wanted), group).where(F.col("step") <= F.col("last"))
    place = F.row_number().over(Window.partitionBy(group).orderBy(h, "doc_id"))
    return near.withColumn("place", place).where(F.col("place") <= F.col("quota")).select("doc_id", group)


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph given as rows (a, b) of BIGINT nodes.

    Alternating large-star / small-star rounds: every round is two
    aggregates and two joins on the edge list, whose size never grows, and
    is written to the shared folder. Spark splits the rows of a hub in the
    joins (AQE), and the aggregates are partial first. Returns one row
    (node, root) per node that has an edge; root is the smallest node.
    """
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                   "cc-edges")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or state[0] == 0:
            break
        seen = tuple(state)
        every = both(edges)
        low = every.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = every.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            small.select("a", F.col("m").alias("b")))
        edges = stored(small.where("a <> b").distinct(), "cc-edges")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
