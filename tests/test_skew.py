"""A key holding a third of all rows: results stay whole and exact, and
the plans pre-aggregate before shuffling."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from ordermill.operators.aggregate import status_sums
from ordermill.plans import reports
from ordermill.sinks import files


def _orders(spark, n=30000):
    # product 7 and day 2025-01-01 hold a third of the rows
    base = spark.range(n).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("product_id"),
        F.when(F.col("id") % 3 == 0, F.lit(dt.datetime(2025, 1, 1)))
         .otherwise(F.lit(dt.datetime(2025, 1, 1)) + F.make_interval(days=(F.col("id") % 30).cast("int")))
         .cast("timestamp_ntz").alias("order_date"),
        (F.col("id") % 5 + 1).cast("int").alias("qty"),
        F.lit("12.34").cast("decimal(12,2)").alias("unit_price"),
        F.lit(1).cast("bigint").alias("user_id"),
        F.element_at(F.array(F.lit("completed"), F.lit("returned"), F.lit("cancelled")),
                     (F.col("id") % 3 + 1).cast("int")).alias("order_status"))
    return base


def _products(spark):
    return spark.range(500).select(F.col("id").alias("product_id"), F.concat(F.lit("p"), F.col("id")).alias("product_name"),
                                   (F.col("id") % 6).cast("string").alias("category"),
                                   F.lit(1).cast("decimal(12,2)").alias("price"))


def test_hot_product_daily_revenue_same_both_join_paths(spark):
    o, p = _orders(spark), _products(spark)
    a = reports.daily_revenue(o, p).collect()
    b = reports.daily_revenue(o, p, broadcast=False).collect()
    assert a == b and len(a) == o.select(F.to_date("order_date")).distinct().count()
    # whole: the sum over days equals the sum over all lines
    total = o.agg(F.sum(F.when(F.col("order_status") == "cancelled", 0)
                        .otherwise(F.col("qty") * F.col("unit_price")))).collect()[0][0]
    assert round(sum(r["total_revenue"] for r in a), 2) == float(total)


def test_hot_product_is_pre_aggregated(spark):
    plan = status_sums(_orders(spark))._jdf.queryExecution().executedPlan().toString()
    # partial aggregate below the exchange
    assert plan.index("Exchange") < plan.rindex("HashAggregate")
    perf = reports.product_performance(_orders(spark), _products(spark), broadcast=False)
    row = perf.where("product_id = 7").collect()[0]
    assert row["total_units_transacted"] == row["units_sold"] + row["units_returned"]


def test_hot_date_write_is_split(spark, tmp_path):
    out = str(tmp_path / "w")
    df = _orders(spark).withColumn("date", F.date_format("order_date", "yyyy-MM-dd"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        files.write_parquet_partition(df.repartition(8), out)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    hot = [f for f in os.listdir(f"{out}/date=2025-01-01") if f.endswith(".parquet")]
    assert len(hot) > 1                      # the hot day spread over several tasks
    assert spark.read.parquet(out).count() == 30000


def test_hot_order_key_is_split_in_the_mapping_join(spark, tmp_path):
    from ordermill.sources import tables
    d = str(tmp_path / "sf")
    n = 60000
    lines = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("l_orderkey"),
        (F.col("id") % 200).alias("l_partkey"), F.lit(1).cast("bigint").alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"), F.lit(3.0).alias("l_quantity"), F.lit(10.0).alias("l_extendedprice"),
        F.lit(0.0).alias("l_discount"), F.lit(0.0).alias("l_tax"), F.lit("N").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"),
        F.lit("2025-01-01 00:00:00").cast("timestamp_ntz").alias("l_shipdate"))
    lines.repartition(8).write.parquet(f"{d}/lineitem.parquet")
    spark.range(5000).select(
        F.col("id").alias("o_orderkey"), F.lit(1).cast("bigint").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), F.lit("2025-01-01 00:00:00").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority")).write.parquet(f"{d}/orders.parquet")
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = tables.orders(spark, d).select("order_id", "qty")
        assert len(df.collect()) == n                            # whole: no line dropped
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan                               # the hot key's partition was split
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_hot_product_is_split_when_products_are_not_broadcast(spark):
    from ordermill.operators.transforms import enrich_with_products
    n = 60000
    orders = spark.range(n).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("product_id"),
        F.lit(1).alias("qty"), F.lit(2.0).alias("unit_price")).repartition(8)
    products = spark.range(5000).select(F.col("id").alias("product_id"),
                                        F.concat(F.lit("p"), F.col("id")).alias("product_name"),
                                        F.lit("c").alias("category"), F.lit(1.0).alias("price"))
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = enrich_with_products(orders, products, broadcast=False).select("order_id", "product_name")
        assert len(df.collect()) == n
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "skew=true" in plan
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
