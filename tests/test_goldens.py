"""The reference's published results, reproduced from its 13 data rows."""

from __future__ import annotations

import datetime as dt

from ordermill.plans import pipeline, reports
from ordermill.sources import csv_files
from ordermill.operators import validate as V
from ordermill.schemas import INVENTORY, PRODUCTS


def _typed_inputs(spark, data_dir):
    orders = pipeline.good_orders(pipeline.tag_orders(csv_files.read_orders(spark, data_dir)))
    products, _ = V.validate_dataframe(csv_files.read_products(spark, data_dir), PRODUCTS)
    inv_parsed, _ = csv_files.read_inventory(spark, data_dir)
    inventory, _ = V.validate_dataframe(inv_parsed, INVENTORY)
    return orders, products, inventory


def test_daily_revenue_golden(spark, data_dir):
    orders, products, _ = _typed_inputs(spark, data_dir)
    rows = [tuple(r) for r in reports.daily_revenue(orders, products).collect()]
    assert rows == [("2025-10-25", 248.48, "Electronics", 199.0),
                    ("2025-10-26", 79.99, "Footwear", 79.99)]


def test_product_performance_golden(spark, data_dir):
    orders, products, _ = _typed_inputs(spark, data_dir)
    rows = [tuple(r) for r in reports.product_performance(orders, products).collect()]
    assert rows == [
        (1002, "Running Shoes", "Footwear", 1, 1, 0, 79.99, 0.0, 0.0),
        (1001, "Classic Tee", "Apparel", 2, 2, 0, 39.98, 0.0, 0.0),
        (1003, "Coffee Mug", "Home", 1, 1, 0, 9.5, 0.0, 0.0),
        (1004, "Noise-Cancelling Headphones", "Electronics", 1, 0, 1, 0.0, 199.0, 100.0),
    ]


def test_inventory_alerts_golden(spark, data_dir):
    _, products, inventory = _typed_inputs(spark, data_dir)
    rows = [tuple(r) for r in reports.inventory_alerts(inventory, products, 50).collect()]
    assert rows == [(1004, "Noise-Cancelling Headphones", "W3", 10, dt.date(2025, 10, 1)),
                    (1002, "Running Shoes", "W2", 40, dt.date(2025, 10, 20))]


def test_run_summaries_golden(spark, data_dir):
    inputs = pipeline.csv_inputs(spark, data_dir)
    s25 = pipeline.run_for_date(spark, "20251025", inputs, dry_run=True)
    s26 = pipeline.run_for_date(spark, "2025-10-26", inputs, dry_run=True)
    assert (s25["rows"], s25["revenue"], s25["bad_rows"]) == (3, 248.48, 0)
    # The stored notebook summary shows the unrounded float 139.95999999999998.
    assert (s26["rows"], s26["revenue"]) == (2, 139.96)
    assert s26["date"] == "2025-10-26"


def test_reports_on_processed_table(spark, data_dir, tmp_path):
    """End to end: backfill writes the processed table, the flagship report
    reads it back (partition-pruned by day) and gives the golden."""
    out = str(tmp_path / "out")
    inputs = pipeline.csv_inputs(spark, data_dir)
    pipeline.backfill(spark, "20251025", "20251026", inputs, out)
    processed = spark.read.parquet(f"{out}/processed")
    products, _ = pipeline.valid_products(inputs.products())
    rows = [tuple(r) for r in reports.daily_revenue(processed, products).collect()]
    assert rows == [("2025-10-25", 248.48, "Electronics", 199.0),
                    ("2025-10-26", 79.99, "Footwear", 79.99)]
    one_day = processed.where("date = '2025-10-26'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2025-10-26" in plan
    assert [tuple(r) for r in reports.daily_revenue(one_day, products).collect()] == [
        ("2025-10-26", 79.99, "Footwear", 79.99)]


def test_daily_revenue_in_spark_sql_over_views(spark, data_dir, tmp_path):
    """The reference's report, in Spark SQL over the registered views."""
    from ordermill.plans.views import register_views
    out = str(tmp_path / "out")
    inputs = pipeline.csv_inputs(spark, data_dir)
    pipeline.backfill(spark, "20251025", "20251026", inputs, out)
    products, _ = pipeline.valid_products(inputs.products())
    register_views(spark, processed=spark.read.parquet(f"{out}/processed"), products=products)
    rows = spark.sql("""
        SELECT date_format(day, 'yyyy-MM-dd') AS date, CAST(sum(net) AS DOUBLE) AS total_revenue,
               max_by(category, net) AS top_category, CAST(max(net) AS DOUBLE) AS top_category_revenue
        FROM (SELECT to_date(order_date) AS day, products.category,
                     sum(if(order_status <=> 'cancelled', 0, qty * unit_price)) AS net
              FROM orders LEFT JOIN products USING (product_id) GROUP BY ALL)
        GROUP BY day ORDER BY day""").collect()
    assert [tuple(r) for r in rows] == [("2025-10-25", 248.48, "Electronics", 199.0),
                                        ("2025-10-26", 79.99, "Footwear", 79.99)]


def test_other_reports_in_spark_sql_over_views(spark, data_dir, tmp_path):
    from ordermill.plans.views import register_views
    out = str(tmp_path / "out")
    inputs = pipeline.csv_inputs(spark, data_dir)
    pipeline.backfill(spark, "20251025", "20251026", inputs, out)
    products, _ = pipeline.valid_products(inputs.products())
    inv_parsed, _ = csv_files.read_inventory(spark, data_dir)
    inventory, _ = V.validate_dataframe(inv_parsed, INVENTORY)
    register_views(spark, spark.read.parquet(f"{out}/processed"), products, inventory)
    perf = spark.sql("""
        SELECT product_id, sum(qty) FILTER (WHERE order_status IN ('completed', 'returned')) AS moved,
               CAST(coalesce(sum(qty * unit_price) FILTER (WHERE order_status = 'completed'), 0) AS DOUBLE) AS sold,
               CAST(coalesce(100 * sum(qty) FILTER (WHERE order_status = 'returned')
                    / sum(qty) FILTER (WHERE order_status IN ('completed', 'returned')), 0) AS DOUBLE) AS returned_percent
        FROM orders JOIN products USING (product_id) GROUP BY product_id ORDER BY sold DESC""").collect()
    assert [tuple(r) for r in perf] == [(1002, 1, 79.99, 0.0), (1001, 2, 39.98, 0.0), (1003, 1, 9.5, 0.0),
                                        (1004, 1, 0.0, 100.0)]
    alerts = spark.sql("""
        SELECT product_id, product_name, warehouse_id, stock_on_hand, CAST(to_date(last_restock_date) AS STRING)
        FROM inventory LEFT JOIN products USING (product_id)
        WHERE stock_on_hand BETWEEN 0 AND 49 ORDER BY stock_on_hand""").collect()
    assert [tuple(r) for r in alerts] == [(1004, "Noise-Cancelling Headphones", "W3", 10, "2025-10-01"),
                                          (1002, "Running Shoes", "W2", 40, "2025-10-20")]
