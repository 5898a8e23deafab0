"""The pipeline's tables as temporary views, for reports written in SQL.

The reference's reports are SQL over tables named ``products``,
``inventory`` and one table per order day. Here the processed orders
(all days, partitioned by ``date``) are one view, so a day filter in SQL
prunes partitions and the per-day UNION ALL is not needed:

    register_views(spark, processed=spark.read.parquet(out + "/processed"),
                   products=products, inventory=inventory)
    spark.sql("SELECT date, SUM(order_total) FROM orders GROUP BY date")

Spark SQL differs from the reference's dialect in date formatting only:
``date_format(d, 'yyyy-MM-dd')`` instead of ``DATE_FORMAT(d, '%Y-%m-%d')``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The view names the reference's SQL uses.
VIEW_NAMES = ("orders", "products", "inventory")


def register_views(spark: SparkSession, processed: DataFrame | None = None,
                   products: DataFrame | None = None, inventory: DataFrame | None = None) -> list[str]:
    """Create or replace the temp views that are given; return their names."""
    made = []
    for name, df in zip(VIEW_NAMES, (processed, products, inventory)):
        if df is not None:
            df.createOrReplaceTempView(name)
            made.append(name)
    return made
