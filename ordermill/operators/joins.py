"""Joins against the product dimension.

A join carries a broadcast hint only where its caller has counted the rows
(``small``); elsewhere Spark broadcasts a side whose size it
knows or measures (AQE, in bytes) to be below
``spark.sql.autoBroadcastJoinThreshold``, and shuffles otherwise, where
AQE splits skewed partitions. ``broadcast=False`` asks for the shuffle
join. Neither choice changes a row or an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.session import stored_table

JOIN_TYPES = ("left", "inner", "right", "outer")


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's size estimate of ``df`` is below its broadcast
    threshold. No job; used only to choose between plans of equal result."""
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def dimension(df: DataFrame, broadcast: bool = True) -> DataFrame:
    """A join's small side: left to Spark, or a shuffle join if not ``broadcast``."""
    return df if broadcast else df.hint("merge")


def unique_key(df: DataFrame, key: str, what: str = "right side") -> DataFrame:
    """Many-to-one guard (J3): reading ``key`` of the result raises if it repeats.

    The check sits in the key itself, so every join on it makes it,
    whatever the join type and strategy and whichever columns are read.
    It costs one shuffle of ``df`` by the key, which a shuffle join needs
    anyway.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    return df.withColumn(key, F.when(n > 1, _duplicate(key, what)).otherwise(F.col(key)))


def _duplicate(key: str, what: str) -> Column:
    text = F.concat(F.lit(f"join is not many-to-one: {what} has duplicate {key} "),
                    F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    return F.raise_error(text).cast("bigint")


def assert_unique_key(df: DataFrame, key: str, what: str = "right side") -> None:
    """The same guard as one aggregate job, for plans that run no join (dry
    runs); partial aggregation keeps the shuffle to one row per key and task."""
    dup = df.groupBy(key).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"join is not many-to-one: {what} has duplicate {key} {dup[0][key]}")


def heavy_hitters(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """The values of ``key`` that hold more than a shuffle partition's fair
    share of the rows: fewer than ``parts`` (the shuffle partitions) of them,
    whatever the data. One partial count, of one row per key and task."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    counts = stored_table(df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")), "key-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where(F.col("n") > F.lit(max(1, total // parts))).select(key)


def join_with_heavy_hitters(left: DataFrame, right: DataFrame, key: str, how: str = "left", parts: int | None = None) -> DataFrame:
    """A many-to-one join (``left`` or ``inner``) whose hot keys are found by
    counting, not by a size estimate: the right rows of hot keys (fewer than
    ``parts``, as the right key is unique) are broadcast, the others shuffled.

    ``left`` is read once for the count and passes through one plan: its hot
    rows take their columns from the broadcast and cross the shuffle join
    under a salt of their own that no right row has, so they are spread
    evenly and match nothing there. The salt is a hash of the row, so a task
    that is run again deals its rows out alike.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, got {how!r}")
    parts = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    others = [c for c in right.columns if c != key]
    hot = heavy_hitters(left, key, parts)
    hot_rows = stored_table(right.join(F.broadcast(hot), key, "left_semi"), "hot-rows").select(
        F.col(key).alias("__hot"), F.struct(F.lit(1).alias("__there"), *others).alias("__hot_row"))
    hot_keys = hot.select(F.col(key).alias("__hot_key"))
    # -1 as well, but no literal: the optimizer would fold that out of the join's keys
    cold_salt = (F.pmod(F.xxhash64(key), F.lit(1)) - 1).cast("int")
    rest = right.join(F.broadcast(hot_keys), F.col(key) == F.col("__hot_key"), "left_anti").select(
        F.col(key).alias("__cold"), cold_salt.alias("__cold_salt"), F.struct(F.lit(1).alias("__there"), *others).alias("__cold_row"))
    rows = left.join(F.broadcast(hot_keys), F.col(key) == F.col("__hot_key"), "left").join(
        F.broadcast(hot_rows), F.col(key) == F.col("__hot"), "left")
    is_hot = F.col("__hot_key").isNotNull()
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(parts)).cast("int")
    rows = rows.withColumn("__salt", F.when(is_hot, spread).otherwise(F.lit(-1)))
    joined = rows.join(rest.hint("merge"), (F.col(key) == F.col("__cold")) & (F.col("__salt") == F.col("__cold_salt")), "left")
    found = F.coalesce(F.col("__hot_row"), F.col("__cold_row"))
    if how == "inner":
        joined = joined.where(F.coalesce(F.col("__hot_row.__there"), F.col("__cold_row.__there")).isNotNull())
    return joined.select(*left.columns, *[found[c].alias(c) for c in others])
