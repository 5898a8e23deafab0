"""The pipeline's three tables, derived from the driver's Parquet tables.

Mapping (FIXTURES §4): ``orders`` is lineitem joined to orders on the
order key, ``products`` is part, ``inventory`` is part plus the latest
ship date of its line items. Two flavours exist:

* typed tables, as the reports see them after ingest;
* raw tables, all-string like a CSV read, with deterministic dirty cells
  so that parsing and validation have real work. Dirty cells are chosen
  by a rule on the row's key; every row is kept.

All functions are lazy: they return DataFrames over full table scans and
let Catalyst prune columns and push filters into the Parquet readers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Status codes of the driver's lineitem table and the order
# status text each stands for.
RETURN_FLAG_STATUS = {"N": "completed", "R": "returned", "A": "cancelled"}


# The driver tables' schemas (FIXTURES §3), declared so a
# read needs no schema-inference job (each one is a Spark job reading a
# footer; three of them cost more than the whole P6 report locally). A
# file whose column types differ fails at read time.
TABLE_SCHEMAS = {
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _status(flag: Column) -> Column:
    expr = None
    for code, status in RETURN_FLAG_STATUS.items():
        expr = (F.when(flag == code, F.lit(status)) if expr is None
                else expr.when(flag == code, F.lit(status)))
    return expr


def _fact_join(lines: DataFrame, orders_: DataFrame, few_orders: bool = False) -> DataFrame:
    """lineitem ⋈ orders on the order key as a sort-merge join.

    orders is a fact table (a quarter of lineitem's rows), so broadcasting
    it does not scale; the merge hint fixes the plan a cluster needs at
    every size. The shuffles are the ones the join requires (no explicit
    repartition): only those let AQE split the partition of an order key
    that holds a large share of the lines. With ``few_orders`` (a filter on
    some days) there is no hint: the measured size decides.
    """
    right = orders_ if few_orders else orders_.hint("merge")
    return lines.join(right, lines.l_orderkey == orders_.o_orderkey, "inner")


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    return _fact_join(li, od)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed orders: one row per line item."""
    return _order_lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        F.col("o_custkey").alias("user_id"),
        _status(F.col("l_returnflag")).alias("order_status"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed products, one row per part."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
    )


def _last_ship_per_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Partial (map-side) aggregation first, so a hot part key costs one
    # row per task before the shuffle.
    return (table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_partkey"))
            # to_date is monotonic: convert the one maximum, not every line
            .agg(F.to_date(F.max("l_shipdate")).alias("last_restock_date")))


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed inventory: one row per part, warehouse = brand, stock = size."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    last = _last_ship_per_part(spark, sf_dir)
    return part.join(last, part.p_partkey == last.l_partkey, "left").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("warehouse_id"),
        F.col("p_size").alias("stock_on_hand"),
        F.col("last_restock_date"),
    )


# --- raw (all-string) tables with dirty cells -----------------------------

def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


# The date forms other than ISO in the raw orders, by key.
# Days above 12 are read day first or month first as they fit; the dashed
# and dotted forms put the month first only where it must be.
RAW_DATE_FORMS = (
    "yyyy/MM/dd", "MM/dd/yyyy", "yyyy/MM/dd HH:mm:ss", "MM/dd/yyyy HH:mm", "MMMM dd, yyyy", "MMM dd, yyyy",
    "dd-MMM-yyyy", "yyyy.MM.dd", "dd MMMM yyyy", "MM-dd-yyyy", "yyyy-MM-dd hh:mm a", "yyyyMMdd",
    "yyyy-MM-dd'T'HH:mm:ss'+02:00'",
)


def raw_order_date(key: Column, ts: Column) -> Column:
    """FIXTURES §5 raw_date: by key mod 50, 0 → text, 1 → blank, 2 onwards
    the other date forms, else ISO."""
    m = key % 50
    out = F.when(m == 0, F.lit("garbage")).when(m == 1, F.lit(None).cast("string"))
    for i, pattern in enumerate(RAW_DATE_FORMS, start=2):
        out = out.when(m == i, F.date_format(ts, pattern))
    return out.otherwise(_iso(ts))


# The dirty quantities in the raw orders, by key.
RAW_QTY = ("-1", "abc", "2.5", "2.0", "5d", "3000000000", None, "2.7", "1e2")


def raw_qty(m40: Column, qty_text: Column) -> Column:
    """FIXTURES §5 raw_qty: by key mod 40 one of the dirty cells, else the
    line's quantity."""
    out = F.when(m40 == 0, F.lit(RAW_QTY[0]))
    for i, text in enumerate(RAW_QTY[1:], start=1):
        out = out.when(m40 == i, F.lit(text).cast("string"))
    return out.otherwise(qty_text)


def raw_price(m70: Column, price_text: Column) -> Column:
    """By key mod 70: 5 → negative, 6 → text, 7 → blank, else the price."""
    return (F.when(m70 == 5, F.concat(F.lit("-"), price_text))
            .when(m70 == 6, F.lit("free"))
            .when(m70 == 7, F.lit(None).cast("string"))
            .otherwise(price_text))


def _day_filter(days: list[str] | None) -> Column | None:
    """Pushable bounds on o_orderdate for a list of YYYYMMDD days, plus an
    exact membership test for lists with gaps."""
    if not days:
        return None
    import datetime as _dt

    parsed = sorted(_dt.datetime.strptime(d.replace("-", ""), "%Y%m%d") for d in days)
    lo, hi = parsed[0], parsed[-1] + _dt.timedelta(days=1)

    def bound(d):
        return F.lit(d.strftime("%Y-%m-%d 00:00:00")).cast("timestamp_ntz")

    cond = (F.col("o_orderdate") >= bound(lo)) & (F.col("o_orderdate") < bound(hi))
    if len(parsed) != (hi - lo).days:
        cond = cond & F.date_format("o_orderdate", "yyyyMMdd").isin([p.strftime("%Y%m%d") for p in parsed])
    return cond


def raw_orders(spark: SparkSession, sf_dir: str, days: list[str] | None = None, monthly: bool = False,
               whole: bool = False, by_day: str | None = None) -> DataFrame:
    """Orders as a CSV reader would hand them over: every cell a string.

    Each order's lines stand for one daily file, ``order_<YYYYMMDD>.csv``
    of its order date (``_source_file``, ``_file_day``). ``days`` keeps
    only those files' rows, as a filter the Parquet scan of ``orders``
    receives. ``monthly`` dates every order on the first of its month, so
    that there are few and larger days.

    Every text cell is derived on its own side of the join (order-level
    cells once per order, line-level cells once per line), so later
    filters that Catalyst pushes into the join condition reference plain
    columns instead of re-deriving the text at every use. ``whole`` is for
    callers that write all rows as they are: the tables' own, smaller columns
    cross the join, and the text is derived after it. With ``by_day`` they are
    also dealt by day before that: each day to "one task", or to "few".
    """
    k = F.col("o_orderkey")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    if monthly:
        od = od.withColumn("o_orderdate", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz"))
    cond = _day_filter(days)
    if cond is not None:
        od = od.where(cond)
    file_day = F.date_format("o_orderdate", "yyyyMMdd")
    orders_side = {
        "order_date": raw_order_date(k, F.col("o_orderdate")),
        "user_id": F.when(k % 60 == 7, F.lit(None).cast("string")).otherwise(F.col("o_custkey").cast("string")),
        "_m40": k % 40, "_m70": k % 70, "_no_status": k % 60 == 8, "_file_day": file_day,
    }
    lines_side = {
        "order_id": F.col("l_orderkey").cast("string"),
        "product_id": F.col("l_partkey").cast("string"),
        "_qty_text": F.col("l_quantity").cast("int").cast("string"),
        "_price_text": F.col("l_extendedprice").cast("decimal(12,2)").cast("string"),
        "_status": _status(F.col("l_returnflag")),
    }
    li = table(spark, sf_dir, "lineitem")
    few = bool(days) and len(days) <= 31
    if whole:
        small = {"l_quantity": F.col("l_quantity").cast("int"), "l_extendedprice": F.col("l_extendedprice").cast("decimal(12,2)")}
        lines = _fact_join(li.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag").withColumns(small), od, few)
        if by_day:
            lines = lines.withColumn("__day", file_day)
            lines = (lines.repartition("__day") if by_day == "one task" else lines.hint("rebalance", "__day")).drop("__day")
        lines = lines.select(*[c.alias(n) for n, c in (orders_side | lines_side).items()])
    else:
        lines = _fact_join(li.select("l_orderkey", *[c.alias(n) for n, c in lines_side.items()]),
                           od.select("o_orderkey", *[c.alias(n) for n, c in orders_side.items()]), few)
    return lines.select(
        "order_id", "order_date", "product_id",
        raw_qty(F.col("_m40"), F.col("_qty_text")).alias("qty"),
        raw_price(F.col("_m70"), F.col("_price_text")).alias("unit_price"),
        "user_id",
        F.when(F.col("_no_status"), F.lit(None).cast("string")).otherwise(F.col("_status")).alias("order_status"),
        F.concat(F.lit("order_"), F.col("_file_day"), F.lit(".csv")).alias("_source_file"),
        "_file_day",
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as strings: key mod 10 = 0 → negative price (invalid row),
    key mod 25 = 3 → blank category (valid, optional field)."""
    k = F.col("p_partkey")
    text = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    return table(spark, sf_dir, "part").select(
        k.cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(k % 25 == 3, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("category"),
        F.when(k % 10 == 0, F.concat(F.lit("-"), text)).otherwise(text).alias("price"),
    )


def text_keys(orders_: DataFrame) -> DataFrame:
    """Typed orders with the product id as text, by order key mod 8 in the
    forms 12.0, 12.7, 12d, NULL, ' 12 ', 1.2e1-like (key with e0), 12."""
    k, p = F.col("order_id") % 8, F.col("product_id").cast("string")
    text = (F.when(k == 0, F.concat(p, F.lit(".0"))).when(k == 1, F.concat(p, F.lit(".7")))
            .when(k == 2, F.concat(p, F.lit("d"))).when(k == 3, F.lit(None).cast("string"))
            .when(k == 4, F.concat(F.lit(" "), p, F.lit(" "))).when(k == 5, F.concat(p, F.lit("e0"))).otherwise(p))
    return orders_.withColumn("product_id", text)


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory as strings: key mod 30 = 0 → stock -5, key mod 45 = 1 →
    unparseable restock date."""
    inv = inventory(spark, sf_dir)
    k = F.col("product_id")
    return inv.select(
        k.cast("string").alias("product_id"),
        F.col("warehouse_id"),
        F.when(k % 30 == 0, F.lit("-5")).otherwise(F.col("stock_on_hand").cast("string")).alias("stock_on_hand"),
        F.when(k % 45 == 1, F.lit("not a date")).otherwise(_iso(F.col("last_restock_date"))).alias("last_restock_date"),
    )
