"""Registered queries: one callable per inventory ID, (spark, sf_dir) → DataFrame.

Every query reads the driver's full tables (or data Spark derives from
them); none caps, samples or subsets rows. Money leaves as DOUBLE,
computed exactly in DECIMAL before.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators import aggregate
from ordermill.operators import transforms
from ordermill.operators import validate as V
from ordermill.operators.transforms import add_order_date_iso, add_order_total, enrich_with_products
from ordermill.plans import pipeline, profile, reports
from ordermill.schemas import INVENTORY, ORDERS, PRODUCTS
from ordermill.session import configure, scratch_path, stored_table
from ordermill.sinks import files
from ordermill.sources import tables

Query = Callable[[SparkSession, str], DataFrame]

# Fixed value: the split day of the two-table union.
UNION_SPLIT = "1998-01-01 00:00:00"


# The date forms of c3_more_forms, by order key.
MORE_DATE_FORMS = ("MMM d yyyy", "MM/dd/yy", "EEE MMM dd yyyy", "yyyyMMdd'T'HHmmss", "EEEE, MMMM d, yyyy")

# Options of CSV text that keeps cells as they are.
CSV_CELLS = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _dbl(c: str) -> F.Column:
    return F.col(c).cast("double").alias(c)


# --- reports (P4–P6) and their parts (A3–A5, N1) -------------------------

def p4_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 (flagship): daily net revenue and top category, by date."""
    configure(spark)
    return reports.daily_revenue(tables.orders(spark, sf_dir), tables.products(spark, sf_dir))


def n1_top_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top category of each day (ties → smallest category)."""
    configure(spark)
    daily_cat = reports.daily_category_net(tables.orders(spark, sf_dir), tables.products(spark, sf_dir))
    top = reports.top_category(daily_cat)
    return top.select(F.date_format("order_date_only", "yyyy-MM-dd").alias("date"),
                      F.col("top.item").alias("top_category"),
                      F.round("top.value", 2).cast("double").alias("top_category_revenue"))


def p5_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: completed/returned units and revenue and return rate per product."""
    configure(spark)
    return reports.product_performance(tables.orders(spark, sf_dir), tables.products(spark, sf_dir))


def a5_status_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: conditional sums by status per ordered product id."""
    configure(spark)
    sums = aggregate.status_sums(tables.orders(spark, sf_dir), "product_id")
    return sums.select("product_id", "units_completed", "units_returned",
                       _dbl("revenue_completed"), _dbl("revenue_returned"))


def p6_inventory_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory with stock below 50 and its product name."""
    configure(spark)
    return reports.inventory_alerts(tables.inventory(spark, sf_dir), tables.products(spark, sf_dir))


def u1_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two 'day tables' (before / from the split day) stacked by name."""
    configure(spark)
    o = tables.orders(spark, sf_dir)
    split = F.lit(UNION_SPLIT).cast("timestamp_ntz")
    first = o.where(F.col("order_date") < split)
    second = o.where((F.col("order_date") >= split) | F.col("order_date").isNull()).select(*reversed(o.columns))
    out = first.unionByName(second)
    return out.select("order_id", "order_date", "product_id", "qty", _dbl("unit_price"),
                      "user_id", "order_status")


# --- pipeline transforms (F1, F2, J1, J2, A1, T1) ---------------------------

def _valid_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = V.validate_dataframe(tables.raw_products(spark, sf_dir), PRODUCTS)
    return good


def _enriched(spark: SparkSession, sf_dir: str, how: str = "left") -> DataFrame:
    totals = add_order_total(tables.orders(spark, sf_dir))
    return enrich_with_products(totals, _valid_products(spark, sf_dir), how)


def f1_order_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 (+C6): rounded line totals on the typed orders."""
    configure(spark)
    out = add_order_total(tables.orders(spark, sf_dir))
    return out.select("order_id", "product_id", "qty", _dbl("unit_price"), _dbl("order_total"))


def f2_order_date_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO date text of each order line."""
    configure(spark)
    out = add_order_date_iso(tables.orders(spark, sf_dir))
    return out.select("order_id", "product_id", "order_date_iso")


def j1_enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 (+C7, C8, J3): left enrichment with the valid products."""
    configure(spark)
    out = _enriched(spark, sf_dir, "left")
    return out.select("order_id", "product_id", "product_name", "category",
                      _dbl("product_price"), _dbl("order_total"))


def j2_enrich_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same enrichment as an inner join."""
    configure(spark)
    out = _enriched(spark, sf_dir, "inner")
    return out.select("order_id", "product_id", "product_name", "category",
                      _dbl("product_price"), _dbl("order_total"))


def _enriched_shifted(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    """Enrichment where either side has rows without a partner: every order
    counts for the product of twice its key, so odd products are unsold and
    the orders of the upper half of the keys have none."""
    totals = add_order_total(tables.orders(spark, sf_dir).withColumn("product_id", F.col("product_id") * 2))
    return enrich_with_products(totals, _valid_products(spark, sf_dir), how).select(
        "order_id", "product_id", "product_name", "category", _dbl("product_price"), _dbl("order_total"))


def j2_enrich_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Right enrichment; products without orders stay."""
    configure(spark)
    return _enriched_shifted(spark, sf_dir, "right")


def j2_enrich_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outer enrichment; neither side loses rows."""
    configure(spark)
    return _enriched_shifted(spark, sf_dir, "outer")


def c7_text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text product ids matched as integers; others match nothing."""
    configure(spark)
    out = enrich_with_products(tables.text_keys(tables.orders(spark, sf_dir)), _valid_products(spark, sf_dir))
    return out.select("order_id", "qty", "product_id", "product_name")


def a1_daily_category_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: revenue and units per (ISO day, category), every status counted."""
    configure(spark)
    return transforms.daily_category_revenue(tables.orders(spark, sf_dir), _valid_products(spark, sf_dir))


def t1_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten products with the highest revenue, ranked."""
    configure(spark)
    return transforms.top_products(tables.orders(spark, sf_dir), _valid_products(spark, sf_dir), 10)


# --- cleaning and validation on raw rows (C3, C6, V2–V7) --------------------

def c3_dates_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose order date parses (strict or fallback)."""
    configure(spark)
    good, _ = V.parse_date_column(tables.raw_orders(spark, sf_dir), "order_date")
    return good.select("order_id", "product_id", "order_date", V.RECOVERED)


def c3_dates_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose order date no format parses."""
    configure(spark)
    _, bad = V.parse_date_column(tables.raw_orders(spark, sf_dir), "order_date")
    return bad.select("order_id", "product_id", "order_date", V.PARSE_ERROR)


def c6_numeric_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """qty/price coerced from raw text (invalid → 0) and totalled."""
    configure(spark)
    raw = tables.raw_orders(spark, sf_dir)
    out = add_order_total(raw)
    return out.select("order_id", "qty", _dbl("unit_price"), _dbl("order_total"))


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.tag_orders(tables.raw_orders(spark, sf_dir))


def v2_orders_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: valid orders, typed."""
    configure(spark)
    good = pipeline.good_orders(_tagged(spark, sf_dir))
    return good.select("order_id", "order_date", "product_id", "qty", _dbl("unit_price"),
                       "user_id", "order_status", V.RECOVERED)


def v2_orders_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the order rules reject (after a successful date parse)."""
    configure(spark)
    bad = pipeline.bad_orders(_tagged(spark, sf_dir))
    return bad.where(F.col(V.ERROR).isNotNull()).select(
        "order_id", "order_date", "product_id", "qty", "unit_price", "user_id",
        "order_status", "date", V.ERROR)


def v6_bad_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse rejects and rule rejects together.

    Computed in the pipeline's single tagged pass (one scan) instead of a
    union of two filtered scans; ``tests/test_pipeline.py`` checks it equals
    ``union_bad`` of the two channels. Rule rejects carry the parsed date,
    as the reference's validation stage sees it.
    """
    configure(spark)
    bad = pipeline.bad_orders(_tagged(spark, sf_dir), keep_parsed=True)
    return bad.select("order_id", "order_date", "product_id", "qty", "unit_price",
                      V.PARSE_ERROR, V.ERROR)


def _hot_keys(raw: DataFrame) -> DataFrame:
    """Raw orders in which one key holds a third of the rows, and another
    third is of a product whose row is rejected."""
    k = F.col("order_id").cast("bigint") % 3
    return raw.withColumns({"order_id": F.when(k == 0, F.lit("1")).otherwise(F.col("order_id")),
                            "product_id": F.when(k == 0, F.lit("1")).when(k == 1, F.lit("10")).otherwise(F.col("product_id"))})


def _ruled(spark: SparkSession, sf_dir: str, rules: list) -> DataFrame:
    tagged = pipeline.tag_orders(_hot_keys(tables.raw_orders(spark, sf_dir)))
    bad = pipeline.bad_orders(pipeline.apply_table_rules(tagged, rules))
    return bad.where(F.col(V.ERROR).isNotNull()).select("order_id", "product_id", "qty", "unit_price", V.ERROR)


def v_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 on the table: orders whose (order, product) is on several valid
    rows are rejected, beside those that the row rules reject."""
    from ordermill.operators.table_rules import UniqueKey

    configure(spark)
    return _ruled(spark, sf_dir, [UniqueKey(("order_id", "product_id"))])


def v_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 on the table: orders of products that are not among the valid
    ones are rejected, beside those that the row rules reject."""
    from ordermill.operators.table_rules import KeyExists

    configure(spark)
    return _ruled(spark, sf_dir, [KeyExists(("product_id",), _valid_products(spark, sf_dir), ("product_id",), "product")])


def v3_products_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: products the rules reject, with the reason."""
    configure(spark)
    _, bad = V.validate_dataframe(tables.raw_products(spark, sf_dir), PRODUCTS)
    return bad.select("product_id", "product_name", "category", "price", V.ERROR)


def v4_inventory_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4 (+S2 parse): inventory rows rejected by the date parse or the
    rules, from one parse-and-validate pass over the inventory."""
    configure(spark)
    tagged = V.tag_parse_validate(tables.raw_inventory(spark, sf_dir), INVENTORY, "last_restock_date")
    return V.rejected(tagged, "last_restock_date").select(
        "product_id", "warehouse_id", "stock_on_hand", "last_restock_date", V.PARSE_ERROR, V.ERROR)


def a6_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + V7 over the whole raw orders table: one row."""
    configure(spark)
    tagged = _tagged(spark, sf_dir)
    # the exact decimal line totals are summed (not the per-day doubles),
    # so the result does not depend on summation order
    return tagged.agg(F.count_if(F.col(pipeline.GOOD)).alias("rows"),
                      F.round(F.sum(pipeline.TOTAL), 2).cast("double").alias("revenue"),
                      F.count_if(~F.col(pipeline.GOOD)).alias("bad_rows"))


def _date_range(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The first and last order day of the table (one aggregate of one column)."""
    low, high = tables.table(spark, sf_dir, "orders").agg(
        F.date_format(F.min("o_orderdate"), "yyyyMMdd"), F.date_format(F.max("o_orderdate"), "yyyyMMdd")).first()
    return low, high


def p3_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 (dry run) over the tables' full date range: one row per day."""
    configure(spark)
    return pipeline.backfill(spark, *_date_range(spark, sf_dir),
                             pipeline.table_inputs(spark, sf_dir), dry_run=True)


def p3_backfill_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 (writing) over the full range: the report next to what the
    written day partitions hold."""
    configure(spark)
    out = scratch_path(spark, "backfill")
    report = pipeline.backfill(spark, *_date_range(spark, sf_dir), pipeline.table_inputs(spark, sf_dir),
                               out, window_days=1000)
    return _report_with_held(report, out)


def _report_with_held(report: DataFrame, out: str) -> DataFrame:
    held = report.sparkSession.read.parquet(f"{out}/processed").groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("rows_held"), F.round(F.sum("order_total"), 2).cast("double").alias("revenue_held"))
    return report.join(held, "date", "left").select("date", "rows", "revenue", "bad_rows", "status", "rows_held", "revenue_held")


def _last_day(spark: SparkSession, sf_dir: str) -> str:
    return _date_range(spark, sf_dir)[1]


def p1_run_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run of the table's last day, from its written outputs: the
    processed rows, then the rejected ones (with their error)."""
    configure(spark)
    out = scratch_path(spark, "run-day")
    done = pipeline.run_for_date(spark, _last_day(spark, sf_dir), pipeline.table_inputs(spark, sf_dir), out)
    summary = spark.read.schema("rows bigint, revenue double, run_date string, date string").json(f"{out}/summaries")
    good = spark.read.parquet(f"{out}/processed").select(
        F.col("date").cast("string").alias("date"), F.col("order_id").cast("string").alias("order_id"),
        F.col("qty").cast("string").alias("qty"), "product_name", _dbl("order_total"), F.lit(None).cast("string").alias("error"))
    day = summary.select("date", F.col("rows").alias("day_rows"), F.col("revenue").alias("day_revenue"))
    if not done["bad_rows"]:  # no such file then
        return good.join(day, "date", "left")
    bad = spark.read.option("header", True).option("escape", '"').csv(f"{out}/bad_rows/dataset=orders").select(
        F.col("date").cast("string").alias("date"), "order_id", "qty", F.lit(None).cast("string").alias("product_name"),
        F.lit(None).cast("double").alias("order_total"), F.coalesce("_parse_error", "_error").alias("error"))
    return good.unionByName(bad).join(day, "date", "left")


def p2_no_valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day whose rows are all rejected: nothing is processed, and the
    rejected rows are written."""
    configure(spark)
    out = scratch_path(spark, "run-empty")
    inputs = pipeline.table_inputs(spark, sf_dir)
    no_qty = pipeline.Inputs(lambda days: inputs.orders(days).withColumn("qty", F.lit("-1")), inputs.products)
    done = pipeline.run_for_date(spark, _last_day(spark, sf_dir), no_qty, out)
    bad = spark.read.option("header", True).csv(f"{out}/bad_rows/dataset=orders")
    return bad.groupBy(F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("bad_rows")).withColumns(
        {"rows": F.lit(done["rows"]).cast("bigint"), "revenue": F.lit(done["revenue"]),
         "processed": F.lit(done["parquet_path"] is not None)})


# --- sinks, read back (W1–W3) ----------------------------------------------

def w1_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched valid orders written date-partitioned, read back."""
    configure(spark)
    enriched = pipeline.enrich(pipeline.good_orders(_tagged(spark, sf_dir)),
                               _valid_products(spark, sf_dir))
    out = scratch_path(spark, "processed")
    files.write_parquet_partition(enriched, out, "date")
    back = spark.read.parquet(out)
    return back.select("order_id", "product_id", "qty", _dbl("order_total"), "product_name",
                       "category", F.col("date").cast("string").alias("date"))


def w2_summary_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-day summaries written as JSON partitions, read back."""
    configure(spark)
    summary = pipeline.day_summary(_tagged(spark, sf_dir)).where(F.col("rows") > 0)
    out = scratch_path(spark, "summaries")
    files.write_summaries(summary.select("date", "rows", "revenue"), out)
    back = spark.read.schema("rows bigint, revenue double, date string").json(out)
    return back.select("date", "rows", "revenue")


def w3_bad_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad order rows written as header CSV, read back as text."""
    configure(spark)
    bad = pipeline.bad_orders(_tagged(spark, sf_dir)).drop("_source_file")
    out = scratch_path(spark, "bad_rows")
    files.write_bad_rows(bad.drop("date"), out, "orders", None)
    schema = ("order_id string, order_date string, product_id string, qty string, unit_price string, "
              "user_id string, order_status string, _parse_error string, _error string")
    back = spark.read.schema(schema).option("header", True).csv(f"{out}/dataset=orders")
    return back.select("order_id", "order_date", "qty", "unit_price", V.PARSE_ERROR, V.ERROR)


def w4_bad_rows_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad order rows filed under their day, read back with it."""
    configure(spark)
    out = scratch_path(spark, "bad_rows")
    files.write_bad_rows(pipeline.bad_orders(_tagged(spark, sf_dir)), out, "orders", None)
    back = spark.read.option("header", True).option("escape", '"').csv(f"{out}/dataset=orders")
    return back.select(F.col("date").cast("string").alias("date"), "order_id", "qty", V.PARSE_ERROR, V.ERROR)


# --- profiling (A7, A8, P7) --------------------------------------------------

def a7_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null count per raw order column."""
    configure(spark)
    return profile.null_counts(tables.raw_orders(spark, sf_dir).drop("_source_file", "_file_day"))


def p7_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 (+A8): column profile of the three raw datasets."""
    configure(spark)
    return profile.profile_datasets({
        "orders": tables.raw_orders(spark, sf_dir).drop("_source_file", "_file_day"),
        "products": tables.raw_products(spark, sf_dir),
        "inventory": tables.raw_inventory(spark, sf_dir),
    })


# --- further standalone operators (C1, C5, V5, A2–A4, F7) -------------------

def c1_strict_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict ``%Y-%m-%d`` parse alone (NULL where it fails)."""
    from ordermill.functions.dates import parse_strict

    configure(spark)
    raw = tables.raw_orders(spark, sf_dir)
    return raw.select("order_id", "order_date",
                      parse_strict(F.col("order_date"), "%Y-%m-%d").alias("order_ts"))


def c2_formatless_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flexible parse alone, with no strict format."""
    from ordermill.functions.dates import parse_date

    configure(spark)
    return tables.raw_orders(spark, sf_dir).select("order_id", "order_date", parse_date(F.col("order_date"), None).alias("order_ts"))


def c9_text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ISO day of an order date that is still text."""
    configure(spark)
    out = add_order_date_iso(tables.raw_orders(spark, sf_dir))
    return out.select("order_id", "order_date_iso")


def a9_emptiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the good and the bad channel of each day have rows, as a
    run decides on its outputs; A6's totals beside it."""
    configure(spark)
    good = pipeline.good_orders(_tagged(spark, sf_dir))
    totals = aggregate.run_totals(add_order_total(good))
    return totals.withColumns({"no_good": F.lit(aggregate.is_empty(good)),
                               "no_negative": F.lit(aggregate.is_empty(good.where("qty < 0")))})


def t5_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: the first five products by id (the limit is the feature)."""
    configure(spark)
    return profile.head_preview(tables.products(spark, sf_dir).orderBy("product_id"), 5).select(
        "product_id", "product_name", "category", _dbl("price"))


def c5_alias_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differently cased / named columns are found and totalled."""
    configure(spark)
    odd = tables.raw_orders(spark, sf_dir).withColumnsRenamed({"qty": "QTY", "unit_price": "UnitPrice"})
    out = add_order_total(odd)
    return out.select("order_id", "qty", _dbl("unit_price"), _dbl("order_total"))


def v5_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5: a product file without its price column fails every row."""
    configure(spark)
    _, bad = V.validate_dataframe(tables.raw_products(spark, sf_dir).drop("price"), PRODUCTS)
    return bad.select("product_id", "product_name", V.ERROR)


def a2_product_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: revenue and units per (product id, name, category)."""
    configure(spark)
    out = transforms.product_revenue(tables.orders(spark, sf_dir), _valid_products(spark, sf_dir))
    return out.select("product_id", "product_name", "category", _dbl("total_revenue"), "total_units")


def a3_daily_category_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: net revenue per (day, category), cancelled lines as 0."""
    configure(spark)
    daily_cat = reports.daily_category_net(tables.orders(spark, sf_dir), tables.products(spark, sf_dir))
    return daily_cat.select("order_date_only", "category", _dbl("revenue"))


def a4_daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: day totals re-aggregated from the day × category result."""
    configure(spark)
    daily_cat = reports.daily_category_net(tables.orders(spark, sf_dir), tables.products(spark, sf_dir))
    return (daily_cat.groupBy("order_date_only")
            .agg(F.round(F.sum("revenue"), 2).cast("double").alias("total_revenue")))


def f7_return_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return rate per ordered product id (zero-safe, exact)."""
    from ordermill.functions.numeric import percent_half_up

    configure(spark)
    sums = aggregate.status_sums(tables.orders(spark, sf_dir), "product_id")
    total = F.col("units_completed") + F.col("units_returned")
    return sums.select("product_id", total.alias("total_units_transacted"),
                       percent_half_up(F.col("units_returned"), total).alias("return_rate_percent"))


# --- CSV sources over the whole tables (S1, S2, S5, S6) ---------------------

def _csv_copy(spark: SparkSession, df: DataFrame, name: str) -> str:
    """Write ``df`` as header CSV to ``<scratch>/<name>.csv/`` (a folder of
    part files, which the sources read like one file); return the folder."""
    base = scratch_path(spark, "csv-source")
    _csv_copy_to(df, f"{base}/{name}.csv")
    return base


def s1_products_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + V3: products read back from header CSV, valid rows typed."""
    from ordermill.sources import csv_files

    configure(spark)
    base = _csv_copy(spark, tables.raw_products(spark, sf_dir), "products")
    good, _ = V.validate_dataframe(csv_files.read_products(spark, base), PRODUCTS)
    return good.select("product_id", "product_name", "category", _dbl("price"))


def s2_inventory_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory read back from header CSV with the restock date parsed."""
    from ordermill.sources import csv_files

    configure(spark)
    base = _csv_copy(spark, tables.raw_inventory(spark, sf_dir), "inventory")
    good, _ = csv_files.read_inventory(spark, base)
    return good.select("product_id", "warehouse_id", "stock_on_hand", "last_restock_date")


def s6_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product file with short, long and quoted lines; the error of
    every row ('' for a good one), though no other column is read."""
    from ordermill.sources import csv_files

    configure(spark)
    raw = tables.raw_products(spark, sf_dir)
    k = F.col("product_id").cast("bigint") % 20
    quoted = F.concat(F.lit('"19"" '), F.col("product_name"), F.lit(', black"'))
    name = F.when(k == 2, quoted).otherwise(F.col("product_name"))
    cells = [F.col("product_id"), name, F.coalesce("category", F.lit("")), F.col("price")]
    line = F.when(k == 5, F.concat_ws(",", *cells[:2])).when(k == 6, F.concat_ws(",", *cells, F.lit("extra"))).otherwise(
        F.concat_ws(",", *cells))
    base = scratch_path(spark, "csv-lines")
    _with_headers(raw.select(F.col("product_id"), line.alias("value")), "product_id,product_name,category,price", f"{base}/products.csv")
    tagged = V.tag(csv_files.read_products(spark, base), PRODUCTS)
    return tagged.select("product_id", "product_name", V.ERROR)


def _with_headers(lines: DataFrame, header: str, path: str, files_: int = 16) -> None:
    """Write text lines to files that each begin with the header line."""
    spark = lines.sparkSession
    body = lines.select(F.pmod(F.xxhash64("product_id"), F.lit(files_)).alias("part"), F.lit(1).alias("at"), "value")
    heads = spark.range(files_).select(F.col("id").alias("part"), F.lit(0).alias("at"), F.lit(header).alias("value"))
    (body.unionByName(heads).repartition("part").sortWithinPartitions("part", "at")
     .select("part", "value").write.partitionBy("part").text(path))


def s3_orders_csv_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3/S4 + P3 on CSV: the whole raw orders table written as one daily
    order file per day (a folder of part files each), then the backfill
    run over those files. Equals ``p3_backfill`` (same oracle)."""
    configure(spark)
    raw = tables.raw_orders(spark, sf_dir, whole=True, by_day="few")
    base = scratch_path(spark, "csv-orders")
    files.write_partitioned(raw.drop("_file_day").withColumnRenamed("_source_file", "file"),
                            base, "file", "csv", arranged=True)
    _csv_copy_to(tables.raw_products(spark, sf_dir), f"{base}/products.csv")
    inputs = pipeline.csv_inputs(spark, base, layout="folders")
    return pipeline.backfill(spark, *_date_range(spark, sf_dir), inputs, dry_run=True)


def s1_quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product files of three kinds: plain ones, ones with line breaks
    in quotes, ones with quotes that are never closed; the error of every row."""
    from ordermill.sources import csv_files

    configure(spark)
    raw, k = tables.raw_products(spark, sf_dir), F.col("product_id").cast("bigint")
    kind = k % 16
    name = F.when((kind < 6) & (k % 5 == 1), F.concat(F.lit("first, of "), F.col("product_name"), F.lit('\nthe "second"\n'))).otherwise(F.col("product_name"))
    price = F.when((kind == 15) & (k % 32 == 31), F.concat(F.lit('"'), F.col("price"))).otherwise(F.col("price"))
    cells = F.to_csv(F.struct("product_id", name.alias("product_name"), "category"), CSV_CELLS)
    base = scratch_path(spark, "csv-quoted")
    lines = raw.select(kind.alias("part"), F.concat_ws(",", cells, price).alias("value"))
    _headed(lines, "product_id,product_name,category,price", "part").write.partitionBy("part").text(f"{base}/products.csv")
    tagged = V.tag(csv_files.read_products(spark, base), PRODUCTS)
    return tagged.select("product_id", "product_name", "price", V.ERROR)


def _headed(lines: DataFrame, header: str, by: str) -> DataFrame:
    """Text lines (``by``, value) with the header line before those of each value of ``by``."""
    heads = lines.select(by).distinct().select(by, F.lit(0).alias("at"), F.lit(header).alias("value"))
    both = lines.select(by, F.lit(1).alias("at"), "value").unionByName(heads)
    return both.repartition(by).sortWithinPartitions(by, "at").select(by, "value")


def _write_order_files(spark: SparkSession, raw: DataFrame, base: str, name: str = "parts") -> None:
    """Raw orders, each day's in one task, as one file ``order_<day>.csv`` per
    day in ``base``/data. The writer puts the header before the rows."""
    rows = raw.select(F.col("_file_day").alias("day"), *ORDERS.names)
    rows.write.partitionBy("day").options(header=True, **CSV_CELLS).csv(f"{base}/{name}")
    files.flatten(spark, f"{base}/{name}", f"{base}/data", lambda folder: f"order_{folder.removeprefix('day=')}.csv")


def _order_files(spark: SparkSession, sf_dir: str) -> str:
    """The raw orders and products as the reference gets them: one file
    ``order_<day>.csv`` per day in one folder. On every fourth day of a month
    some statuses hold a line break."""
    raw = tables.raw_orders(spark, sf_dir, whole=True, by_day="one task")
    broken = (F.substring("_file_day", 7, 2).cast("int") % 4 == 0) & (F.col("order_id").cast("bigint") % 7 == 2)
    status = F.when(broken, F.concat(F.coalesce("order_status", F.lit("")), F.lit(',\n"checked"\n'))).otherwise(F.col("order_status"))
    raw = raw.withColumn("order_status", status)
    base = scratch_path(spark, "csv-days")
    _write_order_files(spark, raw, base)
    _csv_copy_to(tables.raw_products(spark, sf_dir), f"{base}/data/products.csv")
    return f"{base}/data"


def s3_orders_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the daily order files, some of which hold line
    breaks in quotes."""
    from ordermill.sources import csv_files

    configure(spark)
    rows = csv_files.read_orders(spark, _order_files(spark, sf_dir))
    return rows.select("order_id", "order_date", "product_id", "qty", "unit_price", "user_id", "order_status", F.col("_file_day").alias("file_day"),
                       F.col("_corrupt_record").isNotNull().alias("malformed"))


def s3_order_files_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3/S4 + P3 (writing) over daily files of both kinds: the report next
    to what the written day partitions hold. Equals ``p3_backfill_written``."""
    configure(spark)
    out = scratch_path(spark, "backfill")
    inputs = pipeline.csv_inputs(spark, _order_files(spark, sf_dir))
    report = pipeline.backfill(spark, *_date_range(spark, sf_dir), inputs, out, window_days=1000)
    return _report_with_held(report, out)


def _two_runs(spark: SparkSession, sf_dir: str, out: str, between=None, **options) -> DataFrame:
    """P3 over monthly order files, incrementally, twice: between the runs
    the files of every May change (quantities of 10 and more are lost) and
    those of every August go. The second run's report."""
    base = scratch_path(spark, "csv-months")
    _write_order_files(spark, tables.raw_orders(spark, sf_dir, monthly=True, whole=True, by_day="one task"), base)
    _csv_copy_to(tables.raw_products(spark, sf_dir), f"{base}/data/products.csv")
    days = sorted(day for day, in files.names(spark, f"{base}/data", r"order_(\d{8})\.csv"))
    run = lambda: pipeline.backfill(spark, days[0], days[-1], pipeline.csv_inputs(spark, f"{base}/data"), out,
                                    window_days=1000, incremental=True, **options).where("status <> 'missing'")
    run().count()
    if between:
        between()
    may = [day for day in days if day[4:6] == "05"]
    if may:  # written anew beside the others, then put in their place
        cells = spark.read.schema(", ".join(f"{c} string" for c in ORDERS.names)).options(header=True, **CSV_CELLS)
        again = cells.csv([f"{base}/data/order_{day}.csv" for day in may]).withColumn("_file_day", F.regexp_extract(F.col("_metadata.file_name"), r"\d{8}", 0))
        again = stored_table(again.withColumn("qty", F.when(F.col("qty").try_cast("int") >= 10, F.lit("")).otherwise(F.col("qty"))), "changed-rows")
    for day in days:
        if day[4:6] in ("05", "08"):
            files.remove(spark, f"{base}/data/order_{day}.csv")
    if may:
        _write_order_files(spark, again.repartition("_file_day"), base, "changed")
    return run()


def p3_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 with a manifest: which days the second of two runs has written
    anew, by the files of their partitions, and what they hold then."""
    configure(spark)
    out, kept = scratch_path(spark, "backfill"), {}

    def held(name: str) -> DataFrame:
        rows = spark.read.parquet(f"{out}/processed").select(F.col("date").cast("string").alias("date"), "order_total",
                                                             F.col("_metadata.file_name").alias("file"))
        found = rows.groupBy("date").agg(F.count(F.lit(1)).alias("rows_held"), F.array_sort(F.collect_set("file")).alias("files"),
                                         F.round(F.sum("order_total"), 2).cast("double").alias("revenue_held"))
        path = scratch_path(spark, name)
        found.write.parquet(path)
        return spark.read.parquet(path)

    report = _two_runs(spark, sf_dir, out, lambda: kept.update(first=held("held-first")))
    first = kept["first"].select("date", F.col("files").alias("files_first"))
    joined = report.join(held("held-second"), "date", "full").join(first, "date", "full")
    return joined.select("date", "status", "rows", "revenue", "bad_rows", "rows_held", "revenue_held",
                         (~F.col("files").eqNullSafe(F.col("files_first"))).alias("rewritten"))


def _partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ordermill.plans import partials

    out = scratch_path(spark, "backfill")
    _two_runs(spark, sf_dir, out, keep_partials=True).count()
    return partials.read(spark, out)


def p4_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 merged from the days' stored sums, after some days have changed."""
    from ordermill.plans import partials

    configure(spark)
    return partials.daily_revenue(_partials(spark, sf_dir), _valid_products(spark, sf_dir))


def p5_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 merged from the days' stored sums, after some days have changed."""
    from ordermill.plans import partials

    configure(spark)
    return partials.product_performance(_partials(spark, sf_dir), _valid_products(spark, sf_dir))


def a1_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 merged from the days' stored sums, after some days have changed."""
    from ordermill.plans import partials

    configure(spark)
    return partials.daily_category_revenue(_partials(spark, sf_dir), _valid_products(spark, sf_dir))


def _in_order(spark: SparkSession, report: DataFrame, *order) -> DataFrame:
    """A report written in order and read back with each row's place."""
    return files.read_sorted(spark, files.write_sorted(report, scratch_path(spark, "sorted"), *order))


def t2_daily_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 as stored, in the order of the days."""
    return _in_order(spark, p4_daily_revenue(spark, sf_dir), "date")


def t3_performance_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 as stored, by completed revenue, then product (none first)."""
    return _in_order(spark, p5_product_performance(spark, sf_dir), F.desc("revenue_completed"), F.asc_nulls_first("product_id"))


def t4_alerts_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: P6 as stored, by stock, product and warehouse."""
    return _in_order(spark, p6_inventory_alerts(spark, sf_dir), "stock_on_hand", "product_id", "warehouse_id")


def p3_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 over monthly days with late rows: every eleventh order arrives in
    the next month's file, and every other eleventh is corrected there (all
    its lines to a quantity of 7). Two runs: the second has the files of the
    last two years again. What each day holds then, and its summary."""
    configure(spark)
    out = scratch_path(spark, "late")
    raw = tables.raw_orders(spark, sf_dir, monthly=True, whole=True)
    k = F.col("order_id").cast("bigint") % 11
    following = F.date_format(F.add_months(F.to_date("_file_day", "yyyyMMdd"), 1), "yyyyMMdd")
    row = lambda **other: F.struct(*[other.get(c, F.col(c)).alias(c) for c in raw.columns])
    moved = row(_file_day=F.when(k == 4, following).otherwise(F.col("_file_day")))
    corrected = row(_file_day=following, qty=F.lit("7"))

    def every(days: list[str] | None) -> DataFrame:
        """One join of the tables; an order line gives one row or, where it is corrected, two."""
        near = raw if not days else raw.where(F.col("_file_day").isin(days) | following.isin(days))
        rows = near.select(F.inline(F.when(k == 5, F.array(moved, corrected)).otherwise(F.array(moved))))
        return rows if not days else rows.where(F.col("_file_day").isin(days))

    products = lambda: tables.raw_products(spark, sf_dir)
    inputs = pipeline.Inputs(every, products)
    low, high = _date_range(spark, sf_dir)
    last = (dt.datetime.strptime(high, "%Y%m%d") + dt.timedelta(days=32)).strftime("%Y%m%d")
    pipeline.backfill(spark, low[:6] + "01", last, inputs, out, window_days=10_000, merge_late=True)
    pipeline.backfill(spark, f"{int(high[:4]) - 1}0101", last, inputs, out, window_days=10_000, merge_late=True)
    held = spark.read.parquet(f"{out}/processed").groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("rows_held"), F.round(F.sum("order_total"), 2).cast("double").alias("revenue_held"), F.sum("qty").alias("units_held"))
    summary = spark.read.schema("rows bigint, revenue double, date string").json(f"{out}/summaries")
    return held.join(summary, "date", "full").select("date", "rows", "revenue", "rows_held", "revenue_held", "units_held")


def c3_inferred_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 on files that each write dates in one order: a file is a month, odd
    months write 25/10/1995, even ones 10/25/1995. What the files themselves
    show decides."""
    from ordermill.functions.dates import parse_date

    configure(spark)
    o = tables.orders(spark, sf_dir)
    month = F.month("order_date")
    text = F.when(month % 2 == 1, F.date_format("order_date", "d/M/yyyy")).otherwise(F.date_format("order_date", "M/d/yyyy"))
    raw = o.select("order_id", "product_id", text.alias("text"), F.date_format("order_date", "'order_'yyyyMM'.csv'").alias("_source_file"))
    known = V.infer_date_order(stored_table(raw, "dated-orders"), "text")
    return known.select("order_id", "product_id", "text", V.DATE_ORDER,
                        parse_date(F.col("text"), "%Y-%m-%d", F.col(V.DATE_ORDER)).alias("order_ts"))


def c3_more_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates with a day's name, with a month's name first, with a year of
    two digits, and compact timestamps."""
    from ordermill.functions.dates import parse_date

    configure(spark)
    o, k = tables.orders(spark, sf_dir), F.col("order_id") % 5
    text = F.element_at(F.array(*[F.date_format("order_date", p) for p in MORE_DATE_FORMS]), (k + 1).cast("int"))
    return o.select("order_id", "product_id", text.alias("text")).withColumn("order_ts", parse_date(F.col("text")))


def j1_enrich_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 where two products hold half of the orders, by the join that finds
    hot products by counting."""
    configure(spark)
    k = F.col("order_id") % 4
    o = tables.orders(spark, sf_dir).withColumn(
        "product_id", F.when(k == 0, F.lit(7)).when(k == 1, F.lit(10)).otherwise(F.col("product_id")).cast("bigint"))
    out = enrich_with_products(add_order_total(o), _valid_products(spark, sf_dir), "left", split_hot=True)
    return out.select("order_id", "product_id", "product_name", "category", _dbl("product_price"), _dbl("order_total"))


def p7_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 (T5): the first five rows of each raw dataset (the limit is the feature)."""
    configure(spark)
    return profile.preview_datasets({
        "orders": tables.raw_orders(spark, sf_dir).drop("_source_file", "_file_day"),
        "products": tables.raw_products(spark, sf_dir),
        "inventory": tables.raw_inventory(spark, sf_dir),
    })


def a9_channels_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 per day: whether its good and its bad channel have rows, as a run
    decides on its outputs, where every tenth month has no valid quantity."""
    configure(spark)
    raw = tables.raw_orders(spark, sf_dir, monthly=True)
    raw = raw.withColumn("qty", F.when(F.substring("_file_day", 5, 2) == "10", F.lit("-1")).otherwise(F.col("qty"))).where(
        (F.substring("_file_day", 5, 2) != "02") | (F.col("order_id").cast("bigint") % 50 > 20))
    per_day = pipeline.day_summary(pipeline.tag_orders(raw))
    return per_day.select("date", (F.col("rows") > 0).alias("has_good"), (F.col("bad_rows") > 0).alias("has_bad"))


def _csv_copy_to(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def queries() -> dict[str, Query]:
    return {
        "p4_daily_revenue": p4_daily_revenue,
        "n1_top_category": n1_top_category,
        "p5_product_performance": p5_product_performance,
        "a5_status_sums": a5_status_sums,
        "p6_inventory_alerts": p6_inventory_alerts,
        "u1_union_all": u1_union_all,
        "f1_order_total": f1_order_total,
        "f2_order_date_iso": f2_order_date_iso,
        "j1_enrich_left": j1_enrich_left,
        "j2_enrich_inner": j2_enrich_inner,
        "j2_enrich_right": j2_enrich_right,
        "j2_enrich_outer": j2_enrich_outer,
        "c7_text_keys": c7_text_keys,
        "a1_daily_category_revenue": a1_daily_category_revenue,
        "t1_top_products": t1_top_products,
        "c3_dates_good": c3_dates_good,
        "c3_dates_bad": c3_dates_bad,
        "c6_numeric_coerce": c6_numeric_coerce,
        "v2_orders_good": v2_orders_good,
        "v2_orders_bad": v2_orders_bad,
        "v6_bad_union": v6_bad_union,
        "v3_products_bad": v3_products_bad,
        "v4_inventory_bad": v4_inventory_bad,
        "a6_run_summary": a6_run_summary,
        "p3_backfill": p3_backfill,
        "p3_backfill_written": p3_backfill_written,
        "p1_run_day": p1_run_day,
        "p2_no_valid_rows": p2_no_valid_rows,
        "w4_bad_rows_by_date": w4_bad_rows_by_date,
        "c2_formatless_dates": c2_formatless_dates,
        "c9_text_dates": c9_text_dates,
        "a9_emptiness": a9_emptiness,
        "t5_head": t5_head,
        "s6_malformed": s6_malformed,
        "w1_parquet_roundtrip": w1_parquet_roundtrip,
        "w2_summary_roundtrip": w2_summary_roundtrip,
        "w3_bad_csv_roundtrip": w3_bad_csv_roundtrip,
        "a7_null_counts": a7_null_counts,
        "p7_profile": p7_profile,
        "c1_strict_dates": c1_strict_dates,
        "c5_alias_normalize": c5_alias_normalize,
        "v5_missing_column": v5_missing_column,
        "a2_product_revenue": a2_product_revenue,
        "a3_daily_category_net": a3_daily_category_net,
        "a4_daily_totals": a4_daily_totals,
        "f7_return_rate": f7_return_rate,
        "s1_products_csv": s1_products_csv,
        "s2_inventory_csv": s2_inventory_csv,
        "s3_orders_csv_backfill": s3_orders_csv_backfill,
        "s1_quoted_lines": s1_quoted_lines,
        "s3_orders_quoted": s3_orders_quoted,
        "s3_order_files_backfill": s3_order_files_backfill,
        "p3_incremental": p3_incremental,
        "p3_late_rows": p3_late_rows,
        "c3_inferred_order": c3_inferred_order,
        "c3_more_forms": c3_more_forms,
        "j1_enrich_hot": j1_enrich_hot,
        "p7_preview": p7_preview,
        "a9_channels_by_day": a9_channels_by_day,
        "p4_from_partials": p4_from_partials,
        "p5_from_partials": p5_from_partials,
        "a1_from_partials": a1_from_partials,
        "t2_daily_order": t2_daily_order,
        "t3_performance_order": t3_performance_order,
        "t4_alerts_order": t4_alerts_order,
        "v_unique": v_unique,
        "v_reference": v_reference,
    }
