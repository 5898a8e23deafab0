from __future__ import annotations

from ordermill.operators.aggregate import is_empty, run_totals
from ordermill.operators.transforms import add_order_total
from ordermill.plans import profile
from ordermill.session import cluster_conf
from ordermill.sources import csv_files


def test_profile_of_reference_files(spark, data_dir):
    orders = csv_files.read_orders(spark, data_dir).drop("_source_file", "_file_day", "_corrupt_record")
    products = csv_files.read_products(spark, data_dir).drop("_source_file", "_corrupt_record")
    prof = profile.profile_datasets({"orders": orders, "products": products})
    rows = {(r["dataset"], r["column"]): (r["rows"], r["non_null"], r["null_count"], r["dtype"])
            for r in prof.collect()}
    assert rows[("orders", "order_id")] == (5, 5, 0, "string")
    assert rows[("products", "category")] == (4, 4, 0, "string")
    assert len(rows) == 7 + 4
    nulls = {r["column"]: r["null_count"] for r in profile.null_counts(orders).collect()}
    assert nulls == {c: 0 for c in orders.columns}


def test_head_preview_and_emptiness(spark, data_dir):
    orders = csv_files.read_orders(spark, data_dir)
    assert profile.head_preview(orders, 5).count() == 5
    assert profile.head_preview(orders, 2).count() == 2
    assert not is_empty(orders) and is_empty(orders.where("order_id = 'none'"))


def test_run_totals(spark):
    df = add_order_total(spark.createDataFrame([(2, "19.99"), (1, "9.50"), (1, "199.00")],
                                               "qty int, unit_price string"))
    row = run_totals(df).collect()[0]
    assert (row["rows"], row["revenue"]) == (3, 248.48)
    assert run_totals(df.where("qty > 5")).collect()[0]["revenue"] == 0.0


def test_cluster_conf_scales_partitions():
    conf = cluster_conf(executors=1000, cores_per_executor=4)
    assert int(conf["spark.sql.shuffle.partitions"]) == 12000
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert conf["spark.sql.sources.partitionOverwriteMode"] == "dynamic"
