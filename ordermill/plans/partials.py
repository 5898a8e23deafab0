"""Stored partial aggregates: a day's sums, which the reports merge.

``partials`` is a table in the output folder, partitioned by day: units,
amount and line total per (product, status). A run that writes a day's lines
replaces the day's partials in the same way, so after a change of one day
only that day is summed again; a report over all days then reads a few rows
per product and day instead of the order lines. The sums are exact decimals,
so reports from partials equal those from lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.dates import day
from ordermill.functions.numeric import line_total, money_out
from ordermill.operators.transforms import UNKNOWN_CATEGORY, enrich_with_products
from ordermill.plans import reports
from ordermill.session import parallelism
from ordermill.sinks import files

KEYS = ("date", "product_id", "order_status")


def of_lines(lines: DataFrame, date: str = "date", days: int | None = None) -> DataFrame:
    """Partial sums of typed order lines (``date`` names the column of their
    day, as text). With ``days``, how many days there are about, the lines are
    dealt by day, and where days are few by parts of a day too, so that the sums
    lie as ``write`` needs them: one shuffle, of the columns that are summed."""
    qty, price, keys = F.col("qty"), F.col("unit_price"), ["date", "product_id", "order_status"]
    lines = lines.select(F.col(date).alias("date"), "product_id", "order_status", "qty", "unit_price")
    if days:
        tasks = max(parallelism(lines.sparkSession), int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
        lines = lines.withColumn("__part", F.pmod(F.xxhash64("product_id"), F.lit(max(1, 2 * tasks // days))))
        keys, lines = ["date", "__part", "product_id", "order_status"], lines.repartition(tasks, "date", "__part")
    return lines.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(qty).alias("units"), F.sum(qty * price).alias("amount"),
        F.sum(line_total(qty, price)).alias("total")).drop("__part")


def kept(spark: SparkSession, out: str) -> bool:
    return files.exists(spark, f"{out}/partials")


def write(partials: DataFrame, out: str) -> None:
    """Replace the partials of the days that ``partials`` (``of_lines`` with ``days``) has."""
    files.write_partitioned(partials, f"{out}/partials", "date", arranged=True)


def refresh(spark: SparkSession, out: str, days: list[str]) -> None:
    """Sum the written lines of ``days`` again (all that a change of those days costs)."""
    here = [d for d in days if files.exists(spark, f"{out}/processed/date={d}")]
    for gone in sorted(set(days) - set(here)):
        files.remove(spark, f"{out}/partials/date={gone}")
    if here:
        folder = f"{out}/processed"
        lines = spark.read.option("basePath", folder).parquet(*[f"{folder}/date={d}" for d in here])
        write(of_lines(lines.withColumn("date", F.col("date").cast("string")), days=len(here)), out)


def read(spark: SparkSession, out: str) -> DataFrame:
    found = spark.read.parquet(f"{out}/partials")
    return found.withColumn("date", F.col("date").cast("string"))


def _net_per_product(partials: DataFrame) -> DataFrame:
    """Net amount (cancelled = 0) per (order_date_only, product_id)."""
    net = F.when(F.col("order_status") == "cancelled", F.lit(0)).otherwise(F.col("amount"))
    return partials.groupBy(day(F.col("date")).alias("order_date_only"), "product_id").agg(F.sum(net).alias("order_amount"))


def daily_revenue(partials: DataFrame, products: DataFrame) -> DataFrame:
    """P4 from partials."""
    return reports.revenue_by_day(reports.category_net(_net_per_product(partials), products))


def daily_totals(partials: DataFrame) -> DataFrame:
    """A4 from partials: net revenue per day."""
    net = _net_per_product(partials).groupBy("order_date_only").agg(F.sum("order_amount").alias("revenue"))
    return net.select("order_date_only", money_out(F.col("revenue")).alias("total_revenue"))


def product_performance(partials: DataFrame, products: DataFrame) -> DataFrame:
    """P5 from partials."""
    sums = []
    for name, column in (("units", "units"), ("revenue", "amount")):
        for status in ("completed", "returned"):
            sums.append(F.sum(F.when(F.col("order_status") == status, F.col(column)).otherwise(F.lit(0))).alias(f"{name}_{status}"))
    return reports.performance_of(partials.groupBy("product_id").agg(*sums), products)


def daily_category_revenue(partials: DataFrame, products: DataFrame) -> DataFrame:
    """A1 from partials: revenue and units per (order_date_iso, category), every status counted."""
    sums = partials.groupBy(F.col("date").alias("order_date_iso"), "product_id").agg(
        F.sum("total").alias("order_total"), F.sum("units").alias("qty"))
    enriched = enrich_with_products(sums, products).select("order_date_iso", F.coalesce("category", F.lit(UNKNOWN_CATEGORY)).alias("category"),
                                                           "order_total", "qty")
    from ordermill.operators import aggregate

    return aggregate.daily_category_revenue(enriched)
