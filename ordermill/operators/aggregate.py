"""Aggregations, top-1 per group and top-k.

Every aggregate here is a plain ``groupBy().agg()``: Spark runs a partial
aggregate before the shuffle, so a key holding a third of all rows is
collapsed to one row per task before any exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.numeric import money_out


def status_sums(lines: DataFrame, key: str | list[str] = "product_id",
                statuses: tuple[str, ...] = ("completed", "returned")) -> DataFrame:
    """A5: per key, units and revenue of each status as conditional sums.

    Output columns ``units_<status>``, ``revenue_<status>`` (revenue exact
    decimal; round at the output)."""
    keys = [key] if isinstance(key, str) else list(key)
    st, qty, price = F.col("order_status"), F.col("qty"), F.col("unit_price")
    aggs: list[Column] = []
    for s in statuses:
        aggs.append(F.sum(F.when(st == s, qty).otherwise(F.lit(0))).alias(f"units_{s}"))
    for s in statuses:
        aggs.append(F.sum(F.when(st == s, qty * price).otherwise(F.lit(0))).alias(f"revenue_{s}"))
    return lines.groupBy(*keys).agg(*aggs)


def top_per_group(df: DataFrame, group: str, item: str, measure: str,
                  total_alias: str = "total", top_alias: str = "top") -> DataFrame:
    """N1 plus A4 in one aggregate: per ``group``, the sum of ``measure``
    and the ``item`` with the largest ``measure`` (ties → smallest item,
    NULL item first).

    Equivalent to ``row_number() over (partition by group order by measure
    desc, item asc nulls first) = 1`` joined to the group total, without a
    window or a self-join: one aggregate with a partial phase. The minimum
    of a struct with a text is kept by Spark's sort aggregate, which sorts
    the rows of each phase by group.
    """
    # NULL measures rank last, as in ORDER BY measure DESC.
    best = F.min(F.struct(F.col(measure).isNull().alias("missing"), (-F.col(measure)).alias("neg"),
                          F.col(item).alias("item"), F.col(measure).alias("value")))
    return df.groupBy(group).agg(F.sum(measure).alias(total_alias), best.alias(top_alias))


def daily_category_revenue(enriched: DataFrame) -> DataFrame:
    """A1: revenue (sum of rounded line totals, rounded) and units per
    (order_date_iso, category); NULL keys form their own groups; sorted by
    the keys, NULL last (as pandas groupby orders them)."""
    return (enriched.groupBy("order_date_iso", "category")
            .agg(money_out(F.sum("order_total")).alias("total_revenue"),
                 F.sum("qty").alias("total_units"))
            .orderBy(F.asc_nulls_last("order_date_iso"), F.asc_nulls_last("category")))


def product_revenue(enriched: DataFrame) -> DataFrame:
    """A2: revenue and units per (product_id, product_name, category)."""
    return (enriched.groupBy("product_id", "product_name", "category")
            .agg(F.sum("order_total").alias("total_revenue"),
                 F.sum("qty").alias("total_units")))


def top_n_products(enriched: DataFrame, n: int = 10) -> DataFrame:
    """T1 of enriched order rows."""
    return top_n(product_revenue(enriched), n)


def top_n(revenue: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` products with the highest revenue, ranked 1..n.

    Sorted before rounding, ties broken by product_id. ``orderBy + limit``
    plans as TakeOrderedAndProject: each task keeps its own top n, only
    n rows per task reach the final merge. The rank is numbered over those
    n rows, in one task: n is meant to be a report's length, thousands at most.
    """
    top = revenue.orderBy(F.desc("total_revenue"), F.asc_nulls_last("product_id")).limit(n)
    rank = F.row_number().over(Window.orderBy(F.desc("total_revenue"), F.asc_nulls_last("product_id")))
    return top.select(
        rank.alias("rank"), "product_id", "product_name", "category",
        money_out(F.col("total_revenue")).alias("total_revenue"),
        F.col("total_units"))


def run_totals(enriched: DataFrame, rows: str = "rows", revenue: str = "revenue") -> DataFrame:
    """Row count and rounded revenue (every status counts)."""
    return enriched.agg(F.count(F.lit(1)).alias(rows),
                        F.coalesce(money_out(F.sum("order_total")), F.lit(0.0)).alias(revenue))


def is_empty(df: DataFrame) -> bool:
    """A limit-1 job."""
    return df.isEmpty()
