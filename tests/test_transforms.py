from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from ordermill.operators.transforms import (add_order_date_iso, add_order_total,
                                            compute_daily_category_revenue, enrich_with_products,
                                            normalize_columns, top_n_products_by_revenue)


def test_add_order_total(spark):
    df = spark.createDataFrame([(1, 1001, 2, 10.0)], "order_id long, product_id long, qty long, unit_price double")
    out = add_order_total(df).collect()[0]
    assert float(out["order_total"]) == 20.0


def test_enrich_and_date_iso(spark):
    orders = spark.createDataFrame([(1, 1001, 1, 2.0, dt.datetime(2025, 10, 25))],
                                   "order_id long, product_id long, qty long, unit_price double, order_date timestamp_ntz")
    products = spark.createDataFrame([(1001, "X", "cat", 2.0)],
                                     "product_id long, product_name string, category string, price double")
    out = add_order_date_iso(enrich_with_products(orders, products))
    row = out.collect()[0]
    assert "product_name" in out.columns
    assert row["order_date_iso"] == "2025-10-25"
    assert row["product_price"] == 2.0


def test_total_is_exact_decimal_and_half_up(spark):
    # 0.125 rounds half up to 0.13; binary float would depend on representation.
    df = spark.createDataFrame([("1", "0.125"), ("3", "19.999"), ("10", "19.999")], "qty string, unit_price string")
    got = [r["order_total"] for r in add_order_total(df).collect()]
    assert got == [Decimal("0.13"), Decimal("60.00"), Decimal("199.99")]


def test_coercion_of_bad_numbers(spark):
    df = spark.createDataFrame([("2.7", "abc"), ("abc", "1.5"), (None, None), ("-1", "2")],
                               "qty string, unit_price string")
    rows = [(r["qty"], float(r["unit_price"]), float(r["order_total"])) for r in add_order_total(df).collect()]
    assert rows == [(2, 0.0, 0.0), (0, 1.5, 0.0), (0, 0.0, 0.0), (-1, 2.0, -2.0)]


def test_alias_normalisation(spark):
    df = spark.createDataFrame([(2, 3.0)], "QTY long, UnitPrice double")
    out = add_order_total(df)
    assert {"qty", "unit_price", "order_total"} <= set(out.columns)
    assert float(out.collect()[0]["order_total"]) == 6.0


def test_alias_collision_raises(spark):
    df = spark.createDataFrame([(2, 3.0, 4.0)], "qty long, Price double, UnitPrice double")
    with pytest.raises(ValueError):
        normalize_columns(df)


def test_missing_qty_counts_zero(spark):
    df = spark.createDataFrame([(3.0,)], "unit_price double")
    assert float(add_order_total(df).collect()[0]["order_total"]) == 0.0


def _products(spark, rows=None):
    rows = rows or [(1001, "Tee", "Apparel", 19.99), (1002, "Shoes", None, 79.99)]
    return spark.createDataFrame(rows, "product_id long, product_name string, category string, price double")


def test_enrich_fills_unknown(spark):
    orders = spark.createDataFrame([("1", "1001.0"), ("2", "1002"), ("3", "9999")], "order_id string, product_id string")
    out = {r["order_id"]: (r["product_id"], r["product_name"], r["category"])
           for r in enrich_with_products(orders, _products(spark)).collect()}
    assert out["1"] == (1001, "Tee", "Apparel")       # "1001.0" coerced to the key
    assert out["2"] == (1002, "Shoes", "unknown_category")  # product's own null category filled
    assert out["3"] == (9999, "unknown_product", "unknown_category")


@pytest.mark.parametrize("how,n", [("left", 2), ("inner", 1), ("right", 2), ("outer", 3)])
def test_enrich_join_types(spark, how, n):
    orders = spark.createDataFrame([(1, 1001), (2, 5555)], "order_id long, product_id long")
    assert enrich_with_products(orders, _products(spark), how).count() == n


def test_enrich_rejects_unknown_join_type(spark):
    orders = spark.createDataFrame([(1, 1001)], "order_id long, product_id long")
    with pytest.raises(ValueError):
        enrich_with_products(orders, _products(spark), "cross")


def test_many_to_one_guard_cannot_be_lost(spark):
    """Every join type, strategy and set of columns read gives the same error."""
    from ordermill.operators import transforms

    orders = spark.createDataFrame([(1, 1001, 1, "10.00", "2025-10-25")],
                                   "order_id long, product_id long, qty long, unit_price string, order_date string")
    dup = _products(spark, [(1001, "A", "x", 1.0), (1001, "B", "y", 2.0)])
    fails = lambda: pytest.raises(Exception, match="join is not many-to-one: products has duplicate product_id 1001")
    for broadcast in (True, False):
        for how in ("left", "inner", "right", "outer"):
            joined = enrich_with_products(orders, dup, how, broadcast=broadcast)
            for read in (lambda: joined.collect(), lambda: joined.count(), lambda: joined.groupBy("category").count().collect(),
                         lambda: joined.select("order_id").collect()):
                with fails():
                    read()
        for plan in (transforms.daily_category_revenue, transforms.product_revenue, transforms.top_products):
            with fails():
                plan(orders, dup, broadcast=broadcast).collect()
    assert enrich_with_products(orders, dup, validate=False).count() == 2


def test_join_types_keep_both_sides(spark):
    orders = spark.createDataFrame([(1, 1001), (2, 5), (3, None)], "order_id long, product_id long")
    products = _products(spark, [(1001, "A", "x", 1.0), (1002, "B", None, 2.0)])
    for broadcast in (True, False):
        got = {how: sorted((r["order_id"] or 0, r["product_id"] or 0, r["product_name"], r["category"])
                           for r in enrich_with_products(orders, products, how, broadcast=broadcast).collect())
               for how in ("left", "inner", "right", "outer")}
        unknown = ("unknown_product", "unknown_category")
        hit, sold, lost, none = (1, 1001, "A", "x"), (0, 1002, "B", "unknown_category"), (2, 5, *unknown), (3, 0, *unknown)
        assert got == {"left": [hit, lost, none], "inner": [hit], "right": [sold, hit], "outer": [sold, hit, lost, none]}


def test_text_keys_and_quantities_are_exact(spark):
    from pyspark.sql import functions as F

    rows = [("1001", "2"), ("1001.0", "2.7"), ("1001.7", "5d"), ("1001d", "3000000000"), (" 1001 ", None), ("1.001e3", "1e2"),
            ("9007199254740993.0", "9007199254740993.9"), (None, "abc"), ("x", "-2.5"), ("", ".5")]
    df = spark.createDataFrame([(i, k, q, "1.5") for i, (k, q) in enumerate(rows)],
                               "order_id int, product_id string, qty string, unit_price string")
    out = enrich_with_products(add_order_total(df), _products(spark)).orderBy("order_id").collect()
    assert [r["product_id"] for r in out] == [1001, 1001, None, None, 1001, 1001, 9007199254740993, None, None, None]
    assert [r["qty"] for r in out] == [2, 2, 0, 3000000000, 0, 100, 9007199254740993, 0, -2, 0]
    typed = spark.createDataFrame([(None, 2.0), (3000000000, None), (2, 1e30), (1, float("nan"))], "qty long, unit_price double")
    totals = [r["order_total"] for r in add_order_total(typed).collect()]
    assert [None if t is None else float(t) for t in totals] == [0.0, 0.0, None, 0.0]
    big = spark.createDataFrame([("3", "1000000000000.25"), ("1", "1e40"), ("1", "inf"), ("1", "free")], "qty string, unit_price string")
    assert [r[0] for r in add_order_total(big).select(F.col("order_total").cast("string")).collect()] == ["3000000000000.75", None, "0.00", "0.00"]


def test_date_iso_requires_column(spark):
    df = spark.createDataFrame([(1,)], "a long")
    with pytest.raises(KeyError):
        add_order_date_iso(df)


def test_date_iso_coerces_text(spark):
    df = spark.createDataFrame([("2025/10/25",), ("nope",)], "order_date string")
    assert [r["order_date_iso"] for r in add_order_date_iso(df).collect()] == ["2025-10-25", None]


def test_daily_category_revenue_derives_missing_columns(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2025, 10, 25), "a", 2, "1.005"), (dt.datetime(2025, 10, 25), "a", 1, "1.005"),
         (dt.datetime(2025, 10, 25), None, 1, "3")],
        "order_date timestamp_ntz, category string, qty long, unit_price string")
    rows = [tuple(r) for r in compute_daily_category_revenue(df).collect()]
    # rounded per line (2.01 + 1.01), then summed; NULL category is a group
    assert rows == [("2025-10-25", "a", 3.02, 3), ("2025-10-25", None, 3.0, 1)]


def test_top_n_products(spark):
    rows = [(i % 4, f"p{i % 4}", "c", 1, float(i % 4)) for i in range(20)]
    df = spark.createDataFrame(rows, "product_id long, product_name string, category string, qty long, unit_price double")
    out = [tuple(r) for r in top_n_products_by_revenue(df, 2).collect()]
    assert out == [(1, 3, "p3", "c", 15.0, 5), (2, 2, "p2", "c", 10.0, 5)]


def test_top_per_group_ties_and_nulls(spark):
    from ordermill.operators.aggregate import top_per_group

    df = spark.createDataFrame([("d", "b", 5.0), ("d", "a", 5.0), ("d", None, 5.0), ("d", "z", None),
                                ("e", "x", None), ("e", "y", 1.0)], "day string, cat string, rev double")
    out = {r["day"]: (r["top"]["item"], r["top"]["value"], r["total"])
           for r in top_per_group(df, "day", "cat", "rev").collect()}
    assert out == {"d": (None, 5.0, 15.0), "e": ("y", 1.0, 1.0)}


def test_return_rate_is_exact_half_up(spark):
    from pyspark.sql import functions as F
    from ordermill.functions.numeric import percent_half_up
    cases = [(1, 800, 0.13), (5, 8000, 0.06), (1, 8, 12.5), (1, 3, 33.33), (2, 3, 66.67), (0, 0, 0.0),
             (3, 3, 100.0), (1, 1600, 0.06), (7, 16, 43.75)]
    df = spark.createDataFrame([(p, w) for p, w, _ in cases], "part long, whole long")
    got = [r[0] for r in df.select(percent_half_up(F.col("part"), F.col("whole"))).collect()]
    assert got == [want for _, _, want in cases]
