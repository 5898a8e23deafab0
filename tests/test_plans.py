"""Plan shape and partitioning-independence checks."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from ordermill import registry
from ordermill.plans import reports
from ordermill.sources import tables


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_python_in_any_plan(spark, name):
    text = _formatted(registry.queries()[name](spark, SF_SMALL))
    assert "PythonUDF" not in text and "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_top_n_is_take_ordered(spark):
    text = _formatted(registry.t1_top_products(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in text


def test_daily_revenue_plan(spark):
    text = _formatted(registry.p4_daily_revenue(spark, SF_SMALL))
    assert "BroadcastHashJoin" in text
    assert "Window" not in text          # top-1 per day is an aggregate, not a window
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double," in text


def test_filter_reaches_scan(spark):
    df = tables.inventory(spark, SF_SMALL)
    text = _formatted(reports.inventory_alerts(df, tables.products(spark, SF_SMALL), 10))
    assert "PushedFilters: [IsNotNull(p_size), LessThan(p_size,10)]" in text


def test_shuffle_fallback_gives_same_answer(spark):
    o, p = tables.orders(spark, SF_SMALL), tables.products(spark, SF_SMALL)
    a = reports.daily_revenue(o, p).collect()
    b = reports.daily_revenue(o, p, broadcast=False).collect()
    assert a == b
    assert sorted(reports.product_performance(o, p).collect()) == \
        sorted(reports.product_performance(o, p, broadcast=False).collect())


@pytest.mark.parametrize("plan", ["daily_category_revenue", "product_revenue", "top_products"])
def test_lines_are_summed_before_a_shuffle_join(spark, plan):
    """Off the broadcast path no exchange carries the order lines to the
    products: what is joined has been summed per product (and day)."""
    from ordermill.operators import transforms

    build = getattr(transforms, plan)
    o, p = tables.orders(spark, SF_SMALL), tables.products(spark, SF_SMALL)
    text = build(o, p, broadcast=False)._jdf.queryExecution().optimizedPlan().toString()
    join = next(i for i, line in enumerate(text.splitlines()) if "Join LeftOuter" in line)
    assert "Aggregate [" in text.splitlines()[join + 1] or "Aggregate [" in text.splitlines()[join + 2]
    assert sorted(map(str, build(o, p, broadcast=False).collect())) == sorted(map(str, build(o, p).collect()))


def test_result_independent_of_shuffle_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        res = []
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            res.append(sorted(registry.a1_daily_category_revenue(spark, SF_SMALL).collect()))
        assert res[0] == res[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_category_sums_match_run_total(spark):
    a1 = registry.a1_daily_category_revenue(spark, SF_SMALL)
    total = sum(r["total_revenue"] for r in a1.collect())
    from pyspark.sql import functions as F
    from ordermill.operators.transforms import add_order_total
    direct = add_order_total(tables.orders(spark, SF_SMALL)).agg(F.sum("order_total")).collect()[0][0]
    assert round(total, 2) == pytest.approx(float(direct), abs=0.005)
