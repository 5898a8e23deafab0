from __future__ import annotations

from conftest import ORDERS_20251025, ORDERS_20251026, PRODUCTS, write_files
from ordermill.streaming.file_drop import _runs, start_file_drop


def test_consecutive_runs():
    assert _runs(["20251025", "20251026", "20251030"]) == [("20251025", "20251026"), ("20251030", "20251030")]


def test_file_drop_builds_days_and_is_idempotent(spark, tmp_path):
    data = write_files(tmp_path / "in", {"order_20251025.csv": ORDERS_20251025, "products.csv": PRODUCTS})
    out = str(tmp_path / "out")
    ckpt = str(tmp_path / "ckpt")
    q = start_file_drop(spark, data, out, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(f"{out}/processed").count() == 3
    # a second file for the same day plus a new day arrive later
    extra = "order_id,order_date,product_id,qty,unit_price,user_id,order_status\n50009,2025-10-25,1002,1,5.00,1,completed\n"
    write_files(tmp_path / "in", {"order_20251025_late.csv": extra, "order_20251026.csv": ORDERS_20251026})
    q = start_file_drop(spark, data, out, ckpt)
    q.awaitTermination(120)
    back = spark.read.parquet(f"{out}/processed")
    counts = {str(r["date"]): r["count"] for r in back.groupBy("date").count().collect()}
    assert counts == {"2025-10-25": 4, "2025-10-26": 2}
