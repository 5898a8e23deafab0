from __future__ import annotations

import datetime as dt

from ordermill.operators import validate as V
from ordermill.schemas import INVENTORY, ORDERS, PRODUCTS

ORDER_DDL = ("order_id long, order_date timestamp_ntz, product_id long, qty long, unit_price double, "
             "user_id long, order_status string")


def _order(spark, qty):
    return spark.createDataFrame([(50001, dt.datetime(2025, 10, 25), 1001, qty, 19.99, 9001, "completed")],
                                 ORDER_DDL)


def test_order_validation_success(spark):
    good, bad = V.validate_dataframe(_order(spark, 2), ORDERS)
    assert (good.count(), bad.count()) == (1, 0)


def test_order_validation_negative_qty(spark):
    good, bad = V.validate_dataframe(_order(spark, -1), ORDERS)
    assert (good.count(), bad.count()) == (0, 1)
    assert "_error" in bad.columns
    assert bad.collect()[0]["_error"] == "qty: value must be >= 0"


def test_product_validation(spark):
    ddl = "product_id long, product_name string, category string, price double"
    ok = spark.createDataFrame([(1001, "Classic Tee", "Apparel", 19.99)], ddl)
    neg = spark.createDataFrame([(1001, "Classic Tee", "Apparel", -10.0)], ddl)
    assert [d.count() for d in V.validate_dataframe(ok, PRODUCTS)] == [1, 0]
    good, bad = V.validate_dataframe(neg, PRODUCTS)
    assert (good.count(), bad.count()) == (0, 1)
    assert "_error" in bad.columns


def test_inventory_validation(spark):
    ddl = "product_id long, warehouse_id string, stock_on_hand long, last_restock_date timestamp_ntz"
    ok = spark.createDataFrame([(1001, "W1", 120, dt.datetime(2025, 10, 18))], ddl)
    neg = spark.createDataFrame([(1001, "W1", -5, dt.datetime(2025, 10, 18))], ddl)
    assert [d.count() for d in V.validate_dataframe(ok, INVENTORY)] == [1, 0]
    good, bad = V.validate_dataframe(neg, INVENTORY)
    assert (good.count(), bad.count()) == (0, 1)
    assert bad.collect()[0]["_error"] == "stock_on_hand: value must be >= 0"


def test_string_rules_lax_integers(spark):
    rows = [("2",), ("2.0",), (" 7 ",), ("2.5",), ("abc",), ("NaN",), ("-3",), (None,)]
    df = spark.createDataFrame([("1", "2025-01-01", "10", q, "1.0", None, None) for (q,) in rows],
                               "order_id string, order_date string, product_id string, qty string, "
                               "unit_price string, user_id string, order_status string")
    tagged = V.tag(df, ORDERS).select("qty", V.ERROR).collect()
    errs = {r["qty"]: r[V.ERROR] for r in tagged}
    assert errs["2"] == "" and errs["2.0"] == "" and errs[" 7 "] == ""
    assert errs["2.5"] == "qty: value is not a valid integer"
    assert errs["abc"] == "qty: value is not a valid integer"
    assert errs["NaN"] == "qty: value is not a valid integer"
    assert errs["-3"] == "qty: value must be >= 0"
    assert errs[None] == "qty: field required"
    good = V.good_rows(V.tag(df, ORDERS), ORDERS)
    assert sorted(r["qty"] for r in good.collect()) == [2, 2, 7]
    assert dict(good.dtypes)["qty"] == "bigint"


def test_float_rules(spark):
    df = spark.createDataFrame([(p,) for p in ["1.5", "-0.01", "free", "NaN", "inf", "0", None]], "price string")
    df = df.selectExpr("'1' AS product_id", "'n' AS product_name", "NULL AS category", "price")
    errs = {r["price"]: r[V.ERROR] for r in V.tag(df, PRODUCTS).collect()}
    assert errs["1.5"] == "" and errs["0"] == ""
    assert errs["-0.01"] == "price: value must be >= 0"
    assert errs["free"] == errs["NaN"] == errs["inf"] == "price: value is not a valid number"
    assert errs[None] == "price: field required"


def test_optional_fields_and_strict_mode(spark):
    df = spark.createDataFrame([("1", "2025-01-01", "10", "1", "1.0", None, None)],
                               "order_id string, order_date string, product_id string, qty string, "
                               "unit_price string, user_id string, order_status string")
    assert V.tag(df, ORDERS).collect()[0][V.ERROR] == ""
    strict = V.tag(df, ORDERS, strict_optional=True).collect()[0][V.ERROR]
    assert strict == "user_id: blank value not allowed; order_status: blank value not allowed"


def test_all_failures_reported_in_field_order(spark):
    df = spark.createDataFrame([("x", "2025-01-01", None, "-1", "-2", "u", "s")],
                               "order_id string, order_date string, product_id string, qty string, "
                               "unit_price string, user_id string, order_status string")
    _, bad = V.validate_dataframe(df, ORDERS)
    assert bad.collect()[0]["_error"] == (
        "order_id: value is not a valid integer; product_id: field required; qty: value must be >= 0; "
        "unit_price: value must be >= 0; user_id: value is not a valid integer")


def test_missing_required_column_fails_every_row(spark):
    df = spark.createDataFrame([(1, "n"), (2, "m")], "product_id long, product_name string")
    good, bad = V.validate_dataframe(df, PRODUCTS)
    assert good.count() == 0
    assert {r["_error"] for r in bad.collect()} == {"price: field required"}


def test_extra_columns_pass_through(spark):
    df = spark.createDataFrame([(1, "n", None, 1.0, "extra")],
                               "product_id long, product_name string, category string, price double, note string")
    good, _ = V.validate_dataframe(df, PRODUCTS)
    assert good.collect()[0]["note"] == "extra"


def test_number_is_not_a_string(spark):
    df = spark.createDataFrame([(1, 5, None, 1.0)], "product_id long, product_name long, category string, price double")
    _, bad = V.validate_dataframe(df, PRODUCTS)
    assert bad.collect()[0]["_error"] == "product_name: value is not a valid string"


def test_bad_union_widens_schema(spark):
    a = spark.createDataFrame([(1, "x")], "id long, _parse_error string")
    b = spark.createDataFrame([(2, "y")], "id long, _error string")
    out = V.union_bad(a, b).orderBy("id").collect()
    assert [tuple(r) for r in out] == [(1, "x", None), (2, None, "y")]


def test_defaults_are_not_applied(spark):
    # valid rows keep their own values: a blank status stays NULL, not "completed",
    # and a blank category stays NULL, not "unknown"
    orders = spark.createDataFrame([("1", "2025-01-01", "10", "1", "1.0", None, None)],
                                   ", ".join(f"{n} string" for n in ORDERS.names))
    good, _ = V.validate_dataframe(orders, ORDERS)
    row = good.collect()[0]
    assert row["order_status"] is None and row["user_id"] is None
    products = spark.createDataFrame([("1", "n", None, "2.0")],
                                     "product_id string, product_name string, category string, price string")
    good, _ = V.validate_dataframe(products, PRODUCTS)
    assert good.collect()[0]["category"] is None


def test_single_pass_rejects_equal_two_channel_union(spark):
    from pyspark.sql import functions as F
    rows = [("1", "W1", "5", "2025-10-18"), ("2", "W1", "-5", "2025-10-18"), ("3", "W2", "7", "not a date"),
            ("x", "W3", "1", "10/01/2025"), ("4", None, "2", "2025-10-01")]
    df = spark.createDataFrame(rows, "product_id string, warehouse_id string, stock_on_hand string, "
                                     "last_restock_date string")
    single = V.rejected(V.tag_parse_validate(df, INVENTORY, "last_restock_date"), "last_restock_date")
    parsed, parse_bad = V.parse_date_column(df, "last_restock_date")
    _, rule_bad = V.validate_dataframe(parsed.drop(V.RECOVERED), INVENTORY)
    rule_bad = rule_bad.withColumn("last_restock_date", F.date_format("last_restock_date", "yyyy-MM-dd"))
    union = V.union_bad(parse_bad.drop(V.RECOVERED), rule_bad)
    cols = ["product_id", "last_restock_date", V.PARSE_ERROR, V.ERROR]
    assert sorted(map(tuple, single.select(cols).collect())) == sorted(map(tuple, union.select(cols).collect()))
    assert single.count() == 4
