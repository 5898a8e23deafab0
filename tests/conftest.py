from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordermill.session import build_session  # noqa: E402

# The reference's four data files (13 rows), as text.
ORDERS_20251025 = """order_id,order_date,product_id,qty,unit_price,user_id,order_status
50001,2025-10-25,1001,2,19.99,9001,completed
50002,2025-10-25,1003,1,9.50,9002,completed
50003,2025-10-25,1004,1,199.00,9003,returned
"""
ORDERS_20251026 = """order_id,order_date,product_id,qty,unit_price,user_id,order_status
50004,2025-10-26,1002,1,79.99,9004,completed
50005,2025-10-26,1001,3,19.99,9005,cancelled
"""
PRODUCTS = """product_id,product_name,category,price
1001,"Classic Tee",Apparel,19.99
1002,"Running Shoes",Footwear,79.99
1003,"Coffee Mug",Home,9.50
1004,"Noise-Cancelling Headphones",Electronics,199.00
"""
INVENTORY = """product_id,warehouse_id,stock_on_hand,last_restock_date
1001,W1,120,2025-10-18
1002,W2,40,2025-10-20
1003,W1,300,2025-09-30
1004,W3,10,2025-10-01
"""

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="ordermill-tests-")
    session = build_session("local[4]", 8, extra={"spark.checkpoint.dir": scratch})
    yield session
    session.stop()


def write_files(folder, files: dict[str, str]) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / name).write_text(text)
    return str(folder)


@pytest.fixture()
def data_dir(tmp_path):
    return write_files(tmp_path / "data", {
        "order_20251025.csv": ORDERS_20251025,
        "order_20251026.csv": ORDERS_20251026,
        "products.csv": PRODUCTS,
        "inventory.csv": INVENTORY,
    })
