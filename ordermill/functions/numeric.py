"""Numeric coercion, type rules and exact money arithmetic (C6, C7, F1,
F5–F8). Column expressions only.

Money is DECIMAL inside and DOUBLE only at the output, so sums do not
depend on partitioning or summation order (SURVEY §2.12 item 1).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DecimalType, DoubleType, FloatType,
                               IntegralType, StringType)

# Text accepted as an integer (pydantic lax mode accepts
# "2" and "2.0", rejects "2.5" and words), and the integral part of it.
INT_TEXT = r"^\s*[+-]?\d+(\.0*)?\s*$"
INT_PART = r"^\s*([+-]?\d+)"
# Plain decimal text, and decimal text with an exponent. Java
# also reads a type suffix ("5d", "2f") as a number; these do not.
DECIMAL_TEXT = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)\s*$"
EXPONENT_TEXT = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)[eE][+-]?\d+\s*$"

# Prices up to 10^22 with six decimals.
PRICE_TYPE = "decimal(28,6)"


def int_value(c: Column, dtype: DataType) -> Column:
    """Exact integer value of ``c`` or NULL when it is not an integer."""
    if isinstance(dtype, IntegralType):
        return c.cast("bigint")
    if isinstance(dtype, StringType):
        # Fast path: a plain integer casts directly (no regex); only text
        # like "2.0" takes the pattern route.
        return F.coalesce(c.try_cast("bigint"),
                          F.when(c.rlike(INT_TEXT), F.regexp_extract(c, INT_PART, 1).try_cast("bigint")))
    if isinstance(dtype, (DoubleType, FloatType, DecimalType)):
        whole = c.cast("double")
        return F.when(~F.isnan(whole) & (whole == F.floor(whole).try_cast("double")),
                      c.try_cast("bigint"))
    return F.lit(None).cast("bigint")


def float_value(c: Column) -> Column:
    """Number as double; NULL for text that is not a number."""
    return c.try_cast("double")


def coerce_int(c: Column, dtype: DataType) -> Column:
    """C6 for qty: a number cut to its integral part ("2.7" → 2), else 0.
    Exact for plain text of any length a bigint holds."""
    if isinstance(dtype, IntegralType):
        value = c.cast("bigint")
    elif isinstance(dtype, StringType):
        value = F.coalesce(
            c.try_cast("bigint"),
            F.when(c.rlike(DECIMAL_TEXT), F.coalesce(
                F.nullif(F.regexp_extract(c, INT_PART, 1), F.lit("")).try_cast("bigint"))),
            F.when(c.rlike(EXPONENT_TEXT), c.try_cast("double").try_cast("bigint")))
    else:
        value = c.try_cast("bigint")
    return F.coalesce(value, F.lit(0).cast("bigint"))


def coerce_price(c: Column, dtype: DataType) -> Column:
    """C6 for unit_price: exact decimal, else 0. A finite number too large
    for the decimal stays NULL, and with it the line's total: it is not a
    price of nothing."""
    value = c.try_cast(PRICE_TYPE)
    if isinstance(dtype, IntegralType):
        return F.coalesce(value, F.lit(0).cast(PRICE_TYPE))
    d = c.try_cast("double")
    if isinstance(dtype, StringType):
        d = F.when(c.rlike(DECIMAL_TEXT) | c.rlike(EXPONENT_TEXT), d)
    huge = value.isNull() & d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(float("inf")))
    return F.when(~F.coalesce(huge, F.lit(False)), F.coalesce(value, F.lit(0).cast(PRICE_TYPE)))


def coerce_key(c: Column, dtype: DataType) -> Column:
    """Join key as bigint, so "1001.0" matches 1001; text or a number
    that is not integral ("1001.7", "1001d") matches nothing."""
    value = int_value(c, dtype)
    if not isinstance(dtype, StringType):
        return value
    d = F.when(c.rlike(EXPONENT_TEXT), c.try_cast("double"))
    return F.coalesce(value, F.when(d == F.floor(d).cast("double"), d.try_cast("bigint")))


def line_total(qty: Column, price: Column) -> Column:
    """qty × unit price rounded to cents (half up, exact)."""
    return F.round(qty * price, 2)


def net_amount(status: Column, qty: Column, price: Column) -> Column:
    """cancelled lines count 0, all others qty × price."""
    return F.when(status == "cancelled", F.lit(0)).otherwise(qty * price)


def money_out(c: Column) -> Column:
    """F6 at the output boundary: round half up to cents, then double."""
    return F.round(c, 2).cast("double")


def percent_half_up(part: Column, whole: Column) -> Column:
    """``round(part / whole * 100, 2)`` computed exactly in integers,
    0 when ``whole`` is 0. With a = 2·10⁴·part + whole and b = 2·whole,
    the floor of a / b is the half-up rounding of 10⁴·part / whole; it is
    taken as (a − a mod b) / b, an exact decimal division."""
    a = part.cast("decimal(38,0)") * 20000 + whole
    b = F.nullif(whole, F.lit(0)).cast("decimal(38,0)") * 2
    hundredths = ((a - F.pmod(a, b)) / b).cast("bigint")
    return F.when(whole == 0, F.lit(0.0)).otherwise(hundredths.cast("double") / F.lit(100.0))
