"""Exact dedup by deterministic block naming (DataFrame functions only).

A text is cut into blocks of ``block_bytes``. Each distinct block gets an
integer name, each pair of adjacent names gets a name in turn, and so on
until one name is left; texts are equal exactly if they have as many
blocks and the same last name.

A name has two parts: a bucket (the XXH64 of the content) and the content's
rank in the sorted list of the distinct contents of that bucket. Sorting is
therefore needed only inside buckets that hold two contents or more. Each
level counts the distinct contents of every bucket over the whole table
(partial aggregates, so a content that fills a third of the table is one
row per task); where all buckets hold one, all ranks are 0 and names need
no join. Otherwise the ranks are assigned and joined, which keeps names
free of collisions whatever the hash does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import stored

BLOCK_BYTES = 1024


def _bucket(content: Column, bits: int) -> Column:
    h = F.xxhash64(content)
    return h if bits == 64 else F.pmod(h, F.lit(1 << bits))


def _name(items: DataFrame, bits: int) -> DataFrame:
    """Replace the array ``contents`` by the array ``names`` of (h, r)."""
    spread = items.select(F.explode("contents").alias("c")).select(_bucket(F.col("c"), bits).alias("h"), "c")
    shared = spread.groupBy("h").agg(F.count_distinct("c").alias("n")).where("n > 1").select("h")
    if shared.isEmpty():
        return items.withColumn("names", F.transform("contents", lambda c: F.struct(
            _bucket(c, bits).alias("h"), F.lit(0).alias("r")))).drop("contents")
    from pyspark.sql import Window

    items = stored(items.withColumn("row", F.monotonically_increasing_id()), "exact-contested")
    each = items.select("row", F.posexplode("contents").alias("i", "c")).withColumn("h", _bucket(F.col("c"), bits))
    ranks = each.select("h", "c").distinct().join(shared, "h", "left_semi").withColumn(
        "r", F.row_number().over(Window.partitionBy("h").orderBy("c")))
    named = each.join(ranks, ["h", "c"], "left").groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("i", "h", F.coalesce("r", F.lit(0)).alias("r")))).alias("l"))
    named = named.select("row", F.transform("l", lambda x: F.struct(x["h"].alias("h"), x["r"].alias("r"))).alias("names"))
    return items.drop("contents").join(named, "row").drop("row")


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES, bucket_bits: int = 64) -> DataFrame:
    """(doc_id, text_sha256, blocks, name): equal texts, and only those,
    have equal (blocks, name). Null counts as empty, which is one empty block."""
    size = F.lit(block_bytes)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("b"))
    rows = rows.select(
        "doc_id", F.sha2("b", 256).alias("text_sha256"),
        F.greatest(F.lit(1), F.ceil(F.octet_length("b") / size)).cast("int").alias("blocks"), "b")
    rows = rows.select("doc_id", "text_sha256", "blocks", F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda i: F.substring(F.col("b"), i * size + 1, size)).alias("contents"))
    named = stored(_name(rows, bucket_bits), "exact-names")
    longest = named.agg(F.max("blocks")).first()[0] or 1
    for _ in range((longest - 1).bit_length()):  # each round halves the names of a text
        done, open_ = named.where(F.size("names") == 1), named.where(F.size("names") > 1)
        pairs = open_.select("doc_id", "text_sha256", "blocks", F.transform(
            F.sequence(F.lit(0), F.ceil(F.size("names") / 2).cast("int") - 1),
            lambda i: F.struct(F.get("names", 2 * i).alias("left"), F.get("names", 2 * i + 1).alias("right"))).alias("contents"))
        named = stored(done.unionByName(_name(pairs, bucket_bits)), "exact-names")
    return named.select("doc_id", "text_sha256", "blocks", F.col("names")[0].alias("name"))


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES, bucket_bits: int = 64) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays (a null doc_id is
    the smallest); of several such rows with the same doc_id, one.
    """
    named = identities(docs, block_bytes, bucket_bits)
    same = named.groupBy("blocks", "name", "doc_id").agg(
        F.first("text_sha256").alias("text_sha256"), F.count(F.lit(1)).alias("rows"))
    groups = same.groupBy("blocks", "name").agg(F.max("doc_id").alias("keep_id"), F.sum("rows").alias("group_size"))
    groups = groups.withColumnsRenamed({"blocks": "g_blocks", "name": "g_name"})
    joined = same.join(groups, (F.col("blocks") == F.col("g_blocks")) & (F.col("name") == F.col("g_name")))
    return joined.select("doc_id", "keep_id", "group_size", "text_sha256", F.explode(
        F.sequence(F.lit(1).cast("bigint"), F.col("rows"))).alias("i")).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("i") == 1)).alias("kept"), "text_sha256")
