"""Pipeline transforms: order total (F1, C5, C6), product enrichment
(J1–J3, C7, C8, C10, C11), ISO date (F2, C4, C9) and the two pipeline
aggregates (A1, T1) with their derive-if-missing behaviour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, StringType, TimestampNTZType, TimestampType

from ordermill.functions.dates import ensure_timestamp, iso_date
from ordermill.functions.numeric import PRICE_TYPE, coerce_int, coerce_key, coerce_price, line_total
from ordermill.operators import aggregate
from ordermill.operators.joins import JOIN_TYPES, dimension, fits_broadcast, join_with_heavy_hitters, unique_key

# Accepted spellings of the price column (case-insensitive)
# and the fill texts for orders without a product.
PRICE_ALIASES = ("unitprice", "unit_price", "price")
UNKNOWN_PRODUCT = "unknown_product"
UNKNOWN_CATEGORY = "unknown_category"


def normalize_columns(df: DataFrame) -> DataFrame:
    """Any casing of ``qty`` → ``qty``; ``UnitPrice``/``unit_price``/
    ``price`` (any casing) → ``unit_price``. Two candidates for one name
    raise instead of producing duplicate columns."""
    renames = {}
    if "qty" not in df.columns:
        hits = [c for c in df.columns if c.lower() == "qty"]
        if len(hits) > 1:
            raise ValueError(f"ambiguous quantity columns: {hits}")
        if hits:
            renames[hits[0]] = "qty"
    if "unit_price" not in df.columns:
        hits = [c for c in df.columns if c.lower() in PRICE_ALIASES]
        if len(hits) > 1:
            raise ValueError(f"ambiguous price columns: {hits}")
        if hits:
            renames[hits[0]] = "unit_price"
    return df.withColumnsRenamed(renames) if renames else df


def add_order_total(orders: DataFrame) -> DataFrame:
    """``order_total = round(qty × unit_price, 2)``, exact decimal.

    qty is coerced to bigint (invalid or NULL → 0, "2.7" → 2), unit_price
    to DECIMAL(28,6) (invalid or NULL → 0); a missing column counts as 0.
    """
    df = normalize_columns(orders)
    types = {f.name: f.dataType for f in df.schema.fields}
    qty = coerce_int(F.col("qty"), types["qty"]) if "qty" in types else F.lit(0).cast("bigint")
    price = (coerce_price(F.col("unit_price"), types["unit_price"]) if "unit_price" in types
             else F.lit(0).cast(PRICE_TYPE))
    df = df.withColumns({"qty": qty, "unit_price": price})
    return df.withColumn("order_total", line_total(F.col("qty"), F.col("unit_price")))


def _key(df: DataFrame) -> DataFrame:
    """Numeric join key on either side."""
    return df.withColumn("product_id", coerce_key(F.col("product_id"), df.schema["product_id"].dataType))


def product_side(products: DataFrame) -> DataFrame:
    """The four product columns, price renamed."""
    return _key(products).select("product_id", "product_name", "category",
                                 F.col("price").alias("product_price"))


def enrich_with_products(orders: DataFrame, products: DataFrame, how: str = "left",
                         validate: bool = True, broadcast: bool = True, split_hot: bool = False, small: bool = False) -> DataFrame:
    """Join product name, category and price onto orders.

    ``how`` is one of left (default), inner, right, outer (J2). With
    ``validate`` the product key must be unique (J3); a job that joins on a
    repeated key fails with "join is not many-to-one", for every type and
    strategy of the join. Missing product metadata becomes
    ``unknown_product`` / ``unknown_category`` (C8).

    Right and outer joins cannot be split on the orders side, so their
    matches are a left join (which can) and the products without orders are
    added to it.

    ``split_hot``: products that hold a large share of the orders are found
    by a count and joined apart (``joins.join_with_heavy_hitters``), so the
    join is even whatever Spark estimates or measures.

    ``small``: the caller has counted the products, and they are broadcast.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"how must be one of {JOIN_TYPES}, got {how!r}")
    left, right = _key(orders), product_side(products)
    if validate:
        right = unique_key(right, "product_id", "products")
    kind = "inner" if how in ("inner", "right") else "left"
    if split_hot:
        joined = join_with_heavy_hitters(left, right, "product_id", kind)
    else:
        right = F.broadcast(right) if small else dimension(right, broadcast)
        joined = left.join(right, on="product_id", how=kind)
    if how in ("right", "outer"):
        unsold = right.join(left.select("product_id").distinct(), on="product_id", how="left_anti")
        joined = joined.unionByName(unsold, allowMissingColumns=True)
    return joined.fillna({"product_name": UNKNOWN_PRODUCT, "category": UNKNOWN_CATEGORY})


def _summed(orders: DataFrame, keys: list[str]) -> DataFrame:
    """Line totals and units per ``keys``, as rows that can be enriched."""
    return orders.groupBy(*keys).agg(F.sum("order_total").alias("order_total"), F.sum("qty").alias("qty"))


def daily_category_revenue(orders: DataFrame, products: DataFrame, broadcast: bool = True) -> DataFrame:
    """F1 → F2 → J1 → A1 from orders and products. Where the products are
    not known to fit a broadcast, lines are first summed per (day, product):
    partial sums are shuffled, never the lines."""
    lines = _key(add_order_date_iso(add_order_total(orders)))
    if not broadcast or not fits_broadcast(products):
        lines = _summed(lines, ["order_date_iso", "product_id"])
    return aggregate.daily_category_revenue(enrich_with_products(lines, products, broadcast=broadcast))


def product_revenue(orders: DataFrame, products: DataFrame, broadcast: bool = True) -> DataFrame:
    """F1 → J1 → A2 from orders and products: lines are summed per product
    before the join, one row per product and task in the only shuffle."""
    lines = _summed(_key(add_order_total(orders)), ["product_id"])
    enriched = enrich_with_products(lines, products, broadcast=broadcast)
    return enriched.select("product_id", "product_name", "category",
                           F.col("order_total").alias("total_revenue"), F.col("qty").alias("total_units"))


def top_products(orders: DataFrame, products: DataFrame, n: int = 10, broadcast: bool = True) -> DataFrame:
    """T1 from orders and products."""
    return aggregate.top_n(product_revenue(orders, products, broadcast), n)


def add_order_date_iso(df: DataFrame, date_col: str = "order_date",
                       out_col: str = "order_date_iso") -> DataFrame:
    """``YYYY-MM-DD`` text of the order date; a non-timestamp column is
    coerced first (C9), a missing one raises (C4)."""
    if date_col not in df.columns:
        raise KeyError(f"no date column {date_col!r} among {', '.join(df.columns)}")
    dtype = df.schema[date_col].dataType
    is_ts = isinstance(dtype, (TimestampType, TimestampNTZType))
    if not is_ts:
        df = df.withColumn(date_col, ensure_timestamp(F.col(date_col), False))
    return df.withColumn(out_col, iso_date(F.col(date_col)))


def compute_daily_category_revenue(enriched: DataFrame) -> DataFrame:
    """A1, deriving order_total / order_date_iso when absent."""
    if "order_total" not in enriched.columns:
        enriched = add_order_total(enriched)
    if "order_date_iso" not in enriched.columns:
        enriched = add_order_date_iso(enriched)
    return aggregate.daily_category_revenue(enriched)


def top_n_products_by_revenue(enriched: DataFrame, n: int = 10) -> DataFrame:
    """T1, deriving order_total when absent."""
    if "order_total" not in enriched.columns:
        enriched = add_order_total(enriched)
    return aggregate.top_n_products(enriched, n)
