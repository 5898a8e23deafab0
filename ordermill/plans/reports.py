"""The three SQL reports (P4–P6), as DataFrame plans.

Inputs are the typed ``orders``, ``products`` and ``inventory`` frames
(any source: CSV ingest, processed Parquet, or the driver-table mapping).
The per-day UNION ALL of the original SQL is one multi-file scan here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.dates import day, iso_date
from ordermill.functions.numeric import money_out, net_amount, percent_half_up
from ordermill.operators.aggregate import status_sums, top_per_group
from ordermill.operators.joins import dimension, fits_broadcast


def _product_side(products: DataFrame, *cols: str) -> DataFrame:
    # The products key is kept under its own name: the reports group by
    # the *product* side's key, so unmatched orders share one NULL group.
    return products.select(F.col("product_id").alias("p_product_id"), *cols)


def daily_category_net(orders: DataFrame, products: DataFrame,
                       broadcast: bool = True) -> DataFrame:
    """A3: net revenue (cancelled = 0) per (order_date_only, category)."""
    lines = orders.select(day(F.col("order_date")).alias("order_date_only"), "product_id",
                          net_amount(F.col("order_status"), F.col("qty"), F.col("unit_price"))
                          .alias("order_amount"))
    prod = dimension(_product_side(products, "category"), broadcast)
    if not broadcast or not fits_broadcast(prod):
        # Shuffle join ahead: collapse lines to one row per (day, product)
        # first, so a hot product is pre-summed map-side instead of landing
        # whole in one join task.
        lines = (lines.groupBy("order_date_only", "product_id")
                 .agg(F.sum("order_amount").alias("order_amount")))
    return _net_by_category(lines, prod)


def _net_by_category(amounts: DataFrame, prod: DataFrame) -> DataFrame:
    joined = amounts.join(prod, amounts.product_id == prod.p_product_id, "left")
    return (joined.groupBy("order_date_only", "category")
            .agg(F.sum("order_amount").alias("revenue")))


def category_net(amounts: DataFrame, products: DataFrame) -> DataFrame:
    """A3 of amounts already summed per (order_date_only, product_id)."""
    return _net_by_category(amounts, _product_side(products, "category"))


def top_category(daily_cat: DataFrame) -> DataFrame:
    """N1 (+A4): per day the total and the top category by revenue."""
    return top_per_group(daily_cat, "order_date_only", "category", "revenue",
                         total_alias="total_revenue", top_alias="top")


def daily_revenue(orders: DataFrame, products: DataFrame,
                  broadcast: bool = True) -> DataFrame:
    """P4 (flagship): per day, net revenue and its top category.

    Columns: date, total_revenue, top_category, top_category_revenue;
    ordered by date.
    """
    return revenue_by_day(daily_category_net(orders, products, broadcast))


def revenue_by_day(daily_cat: DataFrame) -> DataFrame:
    """P4 from the day × category result."""
    per_day = top_category(daily_cat)
    return (per_day.orderBy("order_date_only")
            .select(iso_date(F.col("order_date_only")).alias("date"),
                    money_out(F.col("total_revenue")).alias("total_revenue"),
                    F.col("top.item").alias("top_category"),
                    money_out(F.col("top.value")).alias("top_category_revenue")))


def product_performance(orders: DataFrame, products: DataFrame,
                        broadcast: bool = True) -> DataFrame:
    """P5: units and revenue of completed and returned lines per product,
    with the return rate in percent; ordered by completed revenue.

    Lines are summed per order product_id first (partial aggregate, so no
    hot-key task), then joined to products; a second, small aggregate
    merges the rows that share the product side's key (all unmatched
    orders fall into one NULL row, as in the SQL).
    """
    return performance_of(status_sums(orders, "product_id"), products, broadcast)


def performance_of(per_pid: DataFrame, products: DataFrame, broadcast: bool = True) -> DataFrame:
    """P5 from the status sums (A5) per order product_id."""
    prod = dimension(_product_side(products, "product_name", "category"), broadcast)
    joined = per_pid.join(prod, per_pid.product_id == prod.p_product_id, "left")
    perf = (joined.groupBy(F.col("p_product_id").alias("product_id"), "product_name", "category")
            .agg(*[F.sum(c).alias(c) for c in
                   ("units_completed", "units_returned", "revenue_completed", "revenue_returned")]))
    total = F.col("units_completed") + F.col("units_returned")
    out = perf.select(
        "product_id", "product_name", "category",
        total.alias("total_units_transacted"),
        F.col("units_completed").alias("units_sold"),
        F.col("units_returned"),
        money_out(F.col("revenue_completed")).alias("revenue_completed"),
        money_out(F.col("revenue_returned")).alias("revenue_returned"),
        percent_half_up(F.col("units_returned"), total).alias("return_rate_percent"),
    )
    return out.orderBy(F.desc("revenue_completed"), F.asc_nulls_first("product_id"))


def inventory_alerts(inventory: DataFrame, products: DataFrame, threshold: int = 50,
                     broadcast: bool = True) -> DataFrame:
    """Inventory rows with stock below ``threshold`` and their product
    name; ordered by stock, then product and warehouse."""
    low = inventory.where(F.col("stock_on_hand") < F.lit(threshold))
    prod = dimension(_product_side(products, "product_name"), broadcast)
    joined = low.join(prod, low.product_id == prod.p_product_id, "left")
    return (joined.select(
                F.col("product_id"), F.col("product_name"), F.col("warehouse_id"),
                F.col("stock_on_hand"), F.to_date("last_restock_date").alias("last_restock_date"))
            .orderBy("stock_on_hand", "product_id", "warehouse_id"))
