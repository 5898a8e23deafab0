"""Columnar row validation (V1–V7) and the date-parse split.

The reference validates row by row with a pydantic object; here each
field rule is a boolean Column and a row's failures are joined into one
``_error`` text in the same projection (``concat_ws`` skips the rules
that pass; an empty text means a valid row). It stays inside generated
code: an array built with a lambda (``array_compact``/``filter``) would
force interpreted evaluation of every rule and cost several times more.
Good and bad rows are two filters over one tagged frame, so a caller that
needs both persists the tagged frame once instead of evaluating the rules
twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from ordermill.functions.dates import parse_date
from ordermill.functions.numeric import float_value, int_value
from ordermill.schemas import CORRUPT_COLUMN, Field, Schema

ERROR = "_error"
SEPARATOR = "; "
PARSE_ERROR = "_parse_error"
RECOVERED = "_date_recovered"
DATE_ORDER = "_date_order"

# Error texts.
MSG_REQUIRED = "{field}: field required"
MSG_BLANK = "{field}: blank value not allowed"
MSG_INT = "{field}: value is not a valid integer"
MSG_NUMBER = "{field}: value is not a valid number"
MSG_STR = "{field}: value is not a valid string"
MSG_DATETIME = "{field}: value is not a valid datetime"
MSG_GE = "{field}: value must be >= {ge:g}"
MSG_CORRUPT = "row: malformed CSV line"
MSG_PARSE_FAILED = "Flexible parsing also failed"
MSG_OUTSIDE_RUN = "order_date: outside run date "  # followed by the run's day


def _is_time(dtype) -> bool:
    return isinstance(dtype, (TimestampType, TimestampNTZType, DateType))


def with_required_columns(df: DataFrame, schema: Schema) -> DataFrame:
    """V5: a missing column is added as NULL, so a required one fails every
    row with "field required" and an optional one passes."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if not missing:
        return df
    return df.withColumns({m: F.lit(None).cast("string") for m in missing})


def _value_and_checks(df: DataFrame, f: Field, override: Column | None) -> tuple[Column, Column, Column]:
    """(typed value, type ok, range ok) for one field."""
    c = F.col(f.name)
    dtype = df.schema[f.name].dataType
    if f.kind == "int":
        v = int_value(c, dtype).try_cast(f.spark_type)  # out of range → NULL
        ok = v.isNotNull()
        rng = v >= F.lit(f.ge) if f.ge is not None else F.lit(True)
        return v, ok, rng
    if f.kind == "float":
        d = float_value(c)
        # NaN, ±inf and values too large for the decimal are not numbers here.
        v = c.try_cast(f.spark_type)
        ok = d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(float("inf"))) & v.isNotNull()
        rng = d >= F.lit(f.ge) if f.ge is not None else F.lit(True)
        return v, ok, rng
    if f.kind == "datetime":
        if override is not None:
            v = override
        elif _is_time(dtype):
            v = c.cast("timestamp_ntz")
        else:
            v = parse_date(c.cast("string"))
        return v, v.isNotNull(), F.lit(True)
    # str: any string; v2 has no number → str coercion
    ok = F.lit(isinstance(dtype, StringType))
    return c, ok, F.lit(True)


def field_message(df: DataFrame, f: Field, strict_optional: bool = False,
                  override: Column | None = None) -> Column:
    """The first failure of one field as text, NULL when it passes."""
    c = F.col(f.name)
    _, ok, rng = _value_and_checks(df, f, override)
    is_null = c.isNull() if override is None else c.isNull() & override.isNull()
    type_msg = {"int": MSG_INT, "float": MSG_NUMBER, "datetime": MSG_DATETIME}.get(f.kind, MSG_STR)
    if f.required:
        expr = F.when(is_null, F.lit(MSG_REQUIRED.format(field=f.name)))
    elif strict_optional:
        expr = F.when(is_null, F.lit(MSG_BLANK.format(field=f.name)))
    else:
        expr = F.when(is_null, F.lit(None).cast("string"))
    expr = expr.when(~F.coalesce(ok, F.lit(False)), F.lit(type_msg.format(field=f.name)))
    if f.ge is not None:
        expr = expr.when(~F.coalesce(rng, F.lit(False)), F.lit(MSG_GE.format(field=f.name, ge=f.ge)))
    return expr


def typed_values(df: DataFrame, schema: Schema, overrides: dict[str, Column] | None = None) -> dict[str, Column]:
    overrides = overrides or {}
    return {f.name: _value_and_checks(df, f, overrides.get(f.name))[0] for f in schema.fields}


def error_text(df: DataFrame, schema: Schema, strict_optional: bool = False,
               overrides: dict[str, Column] | None = None, extra: list[Column] | None = None,
               exclude: tuple[str, ...] = ()) -> Column:
    """All failures of a row, in field order, "; "-joined; '' when valid.
    ``exclude`` names fields an earlier stage has already checked."""
    overrides = overrides or {}
    msgs = []
    if CORRUPT_COLUMN in df.columns:
        msgs.append(F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit(MSG_CORRUPT)))
    msgs += [field_message(df, f, strict_optional, overrides.get(f.name))
             for f in schema.fields if f.name not in exclude]
    msgs += extra or []
    return F.concat_ws(SEPARATOR, *msgs)


def is_valid(error: Column) -> Column:
    return error == F.lit("")


def tag(df: DataFrame, schema: Schema, strict_optional: bool = False) -> DataFrame:
    """V1 first half: add ``_error`` ('' = valid row)."""
    df = with_required_columns(df, schema)
    return df.withColumn(ERROR, error_text(df, schema, strict_optional))


def good_rows(tagged: DataFrame, schema: Schema) -> DataFrame:
    """Valid rows with typed values (extra columns pass through)."""
    base = tagged.where(is_valid(F.col(ERROR)))
    cols = [c for c in tagged.columns if c not in (ERROR, CORRUPT_COLUMN)]
    return base.withColumns(typed_values(tagged, schema)).select(*cols)


def bad_rows(tagged: DataFrame) -> DataFrame:
    """Rejected rows: original values plus ``_error``."""
    return tagged.where(~is_valid(F.col(ERROR)))


def validate_dataframe(df: DataFrame, schema: Schema,
                       strict_optional: bool = False) -> tuple[DataFrame, DataFrame]:
    """V1: (good, bad). Good rows carry typed values, bad rows the original
    values and ``_error``."""
    tagged = tag(df, schema, strict_optional)
    return good_rows(tagged, schema), bad_rows(tagged)


def union_bad(*frames: DataFrame) -> DataFrame:
    """Schema-widening union (missing columns become NULL)."""
    frames = [f for f in frames if f is not None]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# --- date parse split (C1–C4, F10) ------------------------------------------

def require_column(df: DataFrame, column: str) -> None:
    """C4: a missing date column is an error at plan time."""
    if column not in df.columns:
        raise KeyError(f"no date column {column!r} among {', '.join(df.columns)}")


def tag_dates(df: DataFrame, column: str, date_format: str | None = "%Y-%m-%d",
              parsed_col: str = "__parsed") -> DataFrame:
    """Add the parsed value, whether the fallback recovered it, and the
    parse error text (NULL for parsed rows)."""
    require_column(df, column)
    from ordermill.functions.dates import parse_fallback, parse_strict

    strict_col = f"{parsed_col}_strict"
    if _is_time(df.schema[column].dataType):
        df = df.withColumn(strict_col, F.col(column).cast("timestamp_ntz"))
        fallback = F.lit(None).cast("timestamp_ntz")
    else:
        raw = F.col(column).cast("string")
        df = df.withColumn(strict_col, parse_strict(raw, date_format))
        fallback = parse_fallback(raw, F.col(DATE_ORDER) if DATE_ORDER in df.columns else None)
    return (df.withColumn(parsed_col, F.coalesce(F.col(strict_col), fallback))
              .withColumn(RECOVERED, F.col(strict_col).isNull() & F.col(parsed_col).isNotNull())
              .withColumn(PARSE_ERROR, F.when(F.col(parsed_col).isNull(), F.lit(MSG_PARSE_FAILED)))
              .drop(strict_col))


def infer_date_order(df: DataFrame, column: str, by: str = "_source_file") -> DataFrame:
    """Which number of a date comes first, per file: adds ``_date_order``,
    which the date parse (C3) then follows.

    Two phases: the texts that show their order (25/10, 10/25) are counted by
    file, one row per file and task crossing the shuffle; a file in which all
    of them agree has that order. Files without such a text, or with both
    kinds, keep the fixed list of formats (NULL). Costs one more read."""
    from ordermill.functions.dates import DAY_FIRST, MONTH_FIRST, order_evidence
    from ordermill.session import stored_table

    require_column(df, column)
    shown = df.select(F.col(by).alias("__by"), order_evidence(F.col(column).cast("string")).alias("order")).where("order IS NOT NULL")
    n = lambda order: F.count_if(F.col("order") == order)
    known = shown.groupBy("__by").agg(n(DAY_FIRST).alias("d"), n(MONTH_FIRST).alias("m")).select(
        "__by", F.when((F.col("m") == 0), F.lit(DAY_FIRST)).when(F.col("d") == 0, F.lit(MONTH_FIRST)).alias(DATE_ORDER))
    known = stored_table(known.where(F.col(DATE_ORDER).isNotNull()), "date-orders")
    return df.drop(DATE_ORDER).join(known, F.col(by).eqNullSafe(F.col("__by")), "left").drop("__by")


def parse_date_column(df: DataFrame, column: str, date_format: str | None = "%Y-%m-%d"
                      ) -> tuple[DataFrame, DataFrame]:
    """(good, bad). Good rows hold the parsed ``timestamp_ntz`` and
    ``_date_recovered``; bad rows keep the original text and get
    ``_parse_error``."""
    tagged = tag_dates(df, column, date_format)
    good = (tagged.where(F.col(PARSE_ERROR).isNull())
            .withColumn(column, F.col("__parsed")).drop("__parsed", PARSE_ERROR))
    bad = tagged.where(F.col(PARSE_ERROR).isNotNull()).drop("__parsed", RECOVERED)
    return good, bad


def tag_parse_validate(df: DataFrame, schema: Schema, date_column: str,
                       date_format: str | None = "%Y-%m-%d", strict_optional: bool = False,
                       parsed_col: str = "__parsed") -> DataFrame:
    """Date parse (C3) and rules (V1) in one projection: adds the parsed
    value, ``_parse_error`` (parse rejects, which skip the rules as in the
    reference) and ``_error`` (rule failures, '' when none, NULL for parse
    rejects). One pass instead of a union of two filtered passes."""
    tagged = tag_dates(with_required_columns(df, schema), date_column, date_format, parsed_col)
    rules = error_text(tagged, schema, strict_optional, exclude=(date_column,))
    return tagged.withColumn(ERROR, F.when(F.col(parsed_col).isNotNull(), rules))


def rejected(tagged: DataFrame, date_column: str, parsed_col: str = "__parsed") -> DataFrame:
    """V6 on a ``tag_parse_validate`` frame: parse rejects keep the date
    text, rule rejects show the parsed date (``YYYY-MM-DD``)."""
    from ordermill.functions.dates import iso_date

    bad = tagged.where(F.col(PARSE_ERROR).isNotNull() | ~is_valid(F.col(ERROR)))
    return (bad.withColumn(date_column, F.coalesce(iso_date(F.col(parsed_col)), F.col(date_column)))
               .drop(parsed_col, RECOVERED))
