"""CSV sources.

Files are read as all-string rows, in PERMISSIVE mode with a
corrupt-record column, so a malformed cell or line never changes a
column's type or fails the job; such rows go to the bad-row channel.
Many files are one scan (the reference's per-day UNION ALL), the day a
row came from is taken from ``_metadata.file_name``.

Columns are bound by name, file by file; a column a file lacks is NULL,
one the schema lacks is left out. Quoting follows RFC 4180 (doubled quotes,
separators and line breaks in quotes). There are two ways to read:

* ``read_table_csv`` reads the lines once for a survey (``survey``: each
  file's header, its lines that end inside quotes or close quotes of a line
  before), and then each file in the way that suits it. Files without such
  lines are plain: they are split at line breaks and read in parallel. Files
  in which these lines are balanced hold quoted line breaks and are read
  whole, each in one task. In the others a quote is
  never closed: they are read line by line, and the lines that end inside
  quotes are malformed. ``multi_line=False`` reads no
  file whole, ``True`` all of them.
* ``scan_lines`` reads the input once, on the assumption that every file is
  plain and has the header of the first one, and returns with each row what
  it takes to check that (``LINE``). ``unsettled`` names the files for which
  it did not hold; only these are read again, by the first way. The pipeline
  works like that, so uniform input is read once.
"""

from __future__ import annotations

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from ordermill.functions.dates import normalize_date_str
from ordermill.operators.validate import parse_date_column
from ordermill.schemas import CORRUPT_COLUMN, INVENTORY, ORDERS, PRODUCTS, Schema
from ordermill.session import stored_table

SOURCE_FILE = "_source_file"
SOURCE_PATH = "_source_path"
FILE_DAY = "_file_day"

# Text that pandas.read_csv reads as missing by default
# (SURVEY §2.12 item 18). Spark itself only nulls empty cells.
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Case-insensitive glob for "order" in a file name.
ORDER_GLOB = "*[oO][rR][dD][eE][rR]*"


def null_tokens(df: DataFrame, columns: list[str], tokens: tuple[str, ...] = PANDAS_NULL_TOKENS) -> DataFrame:
    """Turn the given text tokens into NULL in ``columns``."""
    if not tokens:
        return df
    return df.withColumns({c: F.when(F.col(c).isin(list(tokens)), F.lit(None).cast("string"))
                              .otherwise(F.col(c)) for c in columns})


def _options(reader, glob_filter: str | None):
    return reader.option("pathGlobFilter", glob_filter) if glob_filter else reader


# A quoted cell that is closed; a cell whose quote is still open;
# the rest of a quoted cell that an earlier line opened.
CLOSED_CELL = r'(^|,)"[^"]*+(?:""[^"]*+)*+"'
OPEN_CELL = r'(^|,)"'
CELL_REST = r'^[^"]*+(?:""[^"]*+)*+"(?:,|$)'
#: Files of one kind whose paths are handed to the reader one by one; above, the kind's files are picked by a join.
MAX_PATHS = 10_000
#: Struct that ``scan_lines`` adds: HEADER, OPEN or PLAIN, and for lines of a file's first split their order.
LINE = "_line"
PLAIN, HEADER, OPEN = 0, 1, 2
_BOM = "\ufeff"

_CSV_OPTIONS = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def ends_in_quotes(line: Column) -> Column:
    """Whether a line ends inside a quoted cell, so that its record goes on."""
    return F.when(line.contains('"'), F.regexp_replace(line, CLOSED_CELL, "$1").rlike(OPEN_CELL)).otherwise(F.lit(False))


def closes_quotes(line: Column) -> Column:
    """Whether a line closes a quoted cell that it did not open."""
    return F.when(line.contains('"'), line.rlike(CELL_REST)).otherwise(F.lit(False))


def _lines(spark: SparkSession, path: str | list[str], glob_filter: str | None) -> DataFrame:
    """(value, file, name, first): the lines that are not blank; ``first`` orders
    those of a file's first split, and is NULL in the others."""
    lines = _options(spark.read, glob_filter).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"),
        F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("first"))
    return lines.where(F.trim("value") != "")


def survey(spark: SparkSession, path: str | list[str], glob_filter: str | None = None) -> DataFrame:
    """One row per file that has a line: file, header (its first line), open
    (how many lines end inside quotes) and balanced (whether as many lines
    may close quotes as open them). Lines with an even number of quotes
    change nothing between them, and a line alone does not tell whether a
    quote next to a separator opens a cell or closes one, so such lines
    count as either. One scan of the text; a row per file and task is
    shuffled."""
    value = F.col("value")
    opens, closes = ends_in_quotes(value), closes_quotes(value)
    odd = F.length(F.regexp_replace(value, '[^"]+', "")) % 2 == 1
    each = _lines(spark, path, glob_filter).select(
        "file", F.when(F.col("first").isNotNull(), F.struct("first", "value")).alias("top"), opens.alias("open"),
        F.when(odd, F.when(opens & closes, F.lit("either")).when(opens, F.lit("opens")).when(closes, F.lit("closes"))).alias("does"))
    n = lambda kind: F.count_if(F.col("does") == kind)
    all_ = n("opens") + n("closes") + n("either")
    return each.groupBy("file").agg(
        F.min("top").alias("top"), F.count_if("open").alias("open"),
        ((all_ > 0) & (all_ % 2 == 0) & (F.abs(n("opens") - n("closes")) <= n("either"))).alias("balanced")).select(
        "file", F.col("top.value").alias("header"), "open", "balanced")


def _columns(header: str) -> list[str]:
    return [c.strip() for c in next(csv.reader([header.lstrip(_BOM)]), [])]


def _struct(header: str) -> StructType:
    return StructType([StructField(f"c{i}", StringType()) for i in range(len(_columns(header)))] + [StructField(CORRUPT_COLUMN, StringType())])


def _by_name(df: DataFrame, header: str, schema: Schema, *more: str) -> DataFrame:
    """The schema's columns out of c0, c1, ... in the order of a header."""
    at = {name: i for i, name in reversed(list(enumerate(_columns(header))))}
    return df.select(*[(F.col(f"c{at[n]}") if n in at else F.lit(None).cast("string")).alias(n) for n in schema.names],
                     CORRUPT_COLUMN, SOURCE_FILE, SOURCE_PATH, *more)


def _parsed_lines(lines: DataFrame, header: str, schema: Schema) -> DataFrame:
    """Lines as rows. One that ends inside quotes is malformed, also where the
    parser would take its last cell as it stands."""
    open_ = ends_in_quotes(F.col("value"))
    is_header = F.col("value").isin(header.lstrip(_BOM), _BOM + header.lstrip(_BOM))
    kind = F.when(is_header, F.lit(HEADER)).when(open_, F.lit(OPEN)).otherwise(F.lit(PLAIN))
    rows = lines.select(F.col("name").alias(SOURCE_FILE), F.col("file").alias(SOURCE_PATH), "value",
                        F.struct(kind.alias("kind"), "first").alias(LINE), F.from_csv("value", _struct(header).simpleString(), _CSV_OPTIONS).alias("cells"))
    rows = rows.select(SOURCE_FILE, SOURCE_PATH, LINE, "value", "cells.*").withColumn(
        CORRUPT_COLUMN, F.when(F.col(f"{LINE}.kind") == OPEN, F.col("value")).otherwise(F.col(CORRUPT_COLUMN)))
    return _by_name(rows, header, schema, LINE)


def _missing(exc: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc)


def _as_path(file: str) -> str:
    """A file of ``_metadata.file_path`` as a path to read: decoded, and no glob."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def read_table_csv(spark: SparkSession, path: str | list[str], schema: Schema,
                   tokens: tuple[str, ...] = PANDAS_NULL_TOKENS,
                   glob_filter: str | None = None, multi_line: bool | str = "auto") -> DataFrame:
    """Header CSV as the schema's columns, all text, by name;
    ``_source_file`` holds the file name each row came from and
    ``_source_path`` its path. A missing path, or one without any line,
    raises FileNotFoundError. ``multi_line``: which files are read whole
    (True, False, or "auto": those with balanced quotes that span lines).
    A record that swallowed others, because its quote was closed by one of
    theirs, is malformed."""
    try:
        found = survey(spark, path, glob_filter).select(
            "file", "header", F.when(F.lit(multi_line is True), F.lit("whole")).when(F.col("open") == 0, F.lit("plain")).when(
                F.lit(multi_line == "auto") & F.col("balanced"), F.lit("whole")).otherwise(F.lit("broken")).alias("kind"))
        kinds = found.groupBy("header", "kind").agg(F.count(F.lit(1)).alias("n")).collect()
    except AnalysisException as exc:
        if _missing(exc):
            raise FileNotFoundError(f"no {schema.name} file at {path}") from exc
        raise
    if not kinds:
        raise FileNotFoundError(f"no {schema.name} file at {path}")
    if len(kinds) > 1:
        found = stored_table(found, "csv-files")
    parts = []
    for header, kind, n in sorted(map(tuple, kinds)):
        own, paths, glob = None, path, glob_filter
        if len(kinds) > 1:
            own = found.where((F.col("header") == F.lit(header)) & (F.col("kind") == kind)).select(F.col("file").alias(SOURCE_PATH))
            if n <= MAX_PATHS:  # then each file is read by its own kind's scan only
                paths, own, glob = [_as_path(r[0]) for r in own.collect()], None, None
        if kind == "broken":
            df = _parsed_lines(_lines(spark, paths, glob), header, schema).where(F.col(f"{LINE}.kind") != HEADER).drop(LINE)
        else:
            df = (_options(spark.read, glob).schema(_struct(header)).options(**_CSV_OPTIONS)
                  .option("header", True)
                  .option("enforceSchema", True)  # the header line is skipped; its names are bound here
                  # Without this a column that no one reads is not parsed, and
                  # a short or long line passes as a good row.
                  .option("columnPruning", False)
                  .option("multiLine", kind == "whole")
                  .csv(paths))
            df = df.withColumns({SOURCE_FILE: F.col("_metadata.file_name"), SOURCE_PATH: F.col("_metadata.file_path")})
            if kind == "whole":
                df = df.withColumn(CORRUPT_COLUMN, F.coalesce(CORRUPT_COLUMN, _swallowed(header)))
            df = _by_name(df, header, schema)
        parts.append(df if own is None else df.join(own, SOURCE_PATH, "left_semi"))
    return null_tokens(reduce(DataFrame.unionByName, parts), schema.names, tokens)


def _swallowed(header: str) -> Column:
    """The cell of a record that holds a line with as many separators as the
    header: a quote that was closed by another record's, with the records
    between; NULL in a sound record."""
    n = len(_columns(header))
    line = r"\n(?:[^,\n]*,){" + str(max(1, n - 1)) + "}"
    cells = [F.when(F.col(f"c{i}").contains("\n") & F.col(f"c{i}").rlike(line), F.col(f"c{i}")) for i in range(n)]
    return F.coalesce(*cells, F.lit(None).cast("string"))


def scan_lines(spark: SparkSession, path: str | list[str], schema: Schema,
               tokens: tuple[str, ...] = PANDAS_NULL_TOKENS, glob_filter: str | None = None) -> DataFrame:
    """As ``read_table_csv``, but by one scan that takes every file to be
    plain and to have the first one's header. Adds ``LINE``, and returns the
    header lines too (``rows_of`` drops them); see ``unsettled``."""
    try:
        lines = _lines(spark, path, glob_filter)
        first = lines.where("first IS NOT NULL").select("value").take(1)  # reads the beginning of one file
    except AnalysisException as exc:
        if _missing(exc):
            raise FileNotFoundError(f"no {schema.name} file at {path}") from exc
        raise
    if not first:
        raise FileNotFoundError(f"no {schema.name} file at {path}")
    return null_tokens(_parsed_lines(lines, first[0][0], schema), schema.names, tokens)


def line_checks() -> list[Column]:
    """Aggregates of the rows of one file from ``scan_lines``, for ``is_unsettled``."""
    kind, first = F.col(f"{LINE}.kind"), F.col(f"{LINE}.first")
    return [F.min(F.when(first.isNotNull(), F.struct(first.alias("first"), kind.alias("kind")))).alias("_top"),
            F.count_if(kind == HEADER).alias("_headers"), F.count_if(kind == OPEN).alias("_open")]


def is_unsettled() -> Column:
    """Whether the one scan may have misread the file: its first line is not
    the header, a later line is, or a line ends inside quotes."""
    return ~(F.coalesce(F.col("_top.kind") == HEADER, F.lit(False)) & (F.col("_headers") == 1) & (F.col("_open") == 0))


def unsettled(scanned: DataFrame) -> list[str]:
    """The paths of the files of ``scanned`` that ``scan_lines`` may have misread."""
    return sorted(r[0] for r in scanned.groupBy(SOURCE_PATH).agg(*line_checks()).where(is_unsettled()).select(SOURCE_PATH).collect())


def rows_of(scanned: DataFrame) -> DataFrame:
    """The rows of a scan, without its header lines and ``LINE``."""
    return scanned.where(F.col(f"{LINE}.kind") != HEADER).drop(LINE)


def read_products(spark: SparkSession, data_dir: str, tokens: tuple[str, ...] = PANDAS_NULL_TOKENS,
                  multi_line: bool | str = "auto") -> DataFrame:
    """``products.csv`` as raw strings (validate with V3)."""
    return read_table_csv(spark, f"{data_dir.rstrip('/')}/products.csv", PRODUCTS, tokens, multi_line=multi_line).drop(SOURCE_PATH)


def read_inventory(spark: SparkSession, data_dir: str, date_format: str | None = "%Y-%m-%d",
                   tokens: tuple[str, ...] = PANDAS_NULL_TOKENS, multi_line: bool | str = "auto") -> tuple[DataFrame, DataFrame]:
    """``inventory.csv`` with ``last_restock_date`` parsed: (good, bad)."""
    raw = read_table_csv(spark, f"{data_dir.rstrip('/')}/inventory.csv", INVENTORY, tokens, multi_line=multi_line).drop(SOURCE_PATH)
    return parse_date_column(raw, "last_restock_date", date_format)


def file_day(name: Column, days: list[str] | None = None) -> Column:
    """The ``YYYYMMDD`` day in a file name: the asked day it holds when
    ``days`` are given, otherwise the first eight digits that form a date
    (empty when there is none)."""
    if days and not all(re.fullmatch("[0-9]{8}", d) for d in days):
        return F.regexp_extract(name, "(" + "|".join(days) + ")", 1)
    if days:  # by set membership: a pattern of thousands of days costs more than the rest of a row's parse
        first = F.regexp_extract(name, r"(\d{8})", 1)
        every = F.regexp_extract_all(name, F.lit(r"(?=(\d{8}))"), F.lit(1))
        later = F.get(F.array_intersect(every, F.split(F.lit(",".join(days)), ",")), 0)
        return F.when(first.isin(days), first).when(first == "", first).otherwise(F.coalesce(later, F.substring(name, 1, 0)))
    is_day = lambda c: F.try_to_timestamp(c, F.lit("yyyyMMdd")).isNotNull()
    first = F.regexp_extract(name, r"(\d{8})", 1)
    return F.when(is_day(first), first).otherwise(F.coalesce(
        F.get(F.filter(F.regexp_extract_all(name, F.lit(r"(?=(\d{8}))"), F.lit(1)), is_day), 0), F.lit("")))


def order_glob(data_dir: str, days: list[str] | None = None) -> str:
    """Glob for order files of the given days (``{a,b}`` alternation), or
    for all order files."""
    base = data_dir.rstrip("/")
    if not days:
        return f"{base}/*"
    alt = days[0] if len(days) == 1 else "{" + ",".join(days) + "}"
    return f"{base}/*{alt}*"


def orders_place(data_dir: str, days: list[str] | None, layout: str) -> tuple[str, str]:
    """(path, file name filter) of the order files."""
    if layout != "folders":
        return order_glob(data_dir, days), ORDER_GLOB
    base = data_dir.rstrip("/")
    alt = "" if not days else (days[0] if len(days) == 1 else "{" + ",".join(days) + "}")
    return (f"{base}/{ORDER_GLOB}{alt}*/*" if days else f"{base}/{ORDER_GLOB}/*"), "*.csv"


def _with_day(df: DataFrame, days: list[str] | None, layout: str) -> DataFrame:
    name = F.regexp_extract(SOURCE_PATH, r"/([^/]*)/[^/]*$", 1) if layout == "folders" else F.col(SOURCE_FILE)
    return df.withColumn(FILE_DAY, file_day(name, days))


def _no_orders(days: list[str] | None, data_dir: str) -> str:
    return f"No order file for {', '.join(days) if days else 'any date'} in {data_dir}"


def read_orders(spark: SparkSession, data_dir: str, days: list[str] | None = None,
                tokens: tuple[str, ...] = PANDAS_NULL_TOKENS, layout: str = "files",
                multi_line: bool | str = "auto") -> DataFrame:
    """All order files (name contains "order", any case) whose name
    holds one of ``days`` (``YYYYMMDD`` or ``YYYY-MM-DD``). Adds
    ``_file_day``. Raises FileNotFoundError when nothing matches.

    ``layout="folders"`` reads daily "files" that are folders of part
    files (``order_20251025.csv/part-….csv``, as distributed writers
    produce them): the folder name carries "order" and the day.
    """
    days = [normalize_date_str(d) for d in days] if days else None
    path, glob = orders_place(data_dir, days, layout)
    try:
        df = read_table_csv(spark, path, ORDERS, tokens, glob, multi_line)
    except FileNotFoundError as exc:
        raise FileNotFoundError(_no_orders(days, data_dir)) from exc
    return _with_day(df, days, layout).drop(SOURCE_PATH)


def scan_orders(spark: SparkSession, data_dir: str, days: list[str] | None = None,
                tokens: tuple[str, ...] = PANDAS_NULL_TOKENS, layout: str = "files") -> DataFrame:
    """The same rows by one scan (``scan_lines``), with ``_source_path`` and
    ``LINE``; the files that ``unsettled`` names are read with ``reread_orders``."""
    days = [normalize_date_str(d) for d in days] if days else None
    path, glob = orders_place(data_dir, days, layout)
    try:
        return _with_day(scan_lines(spark, path, ORDERS, tokens, glob), days, layout)
    except FileNotFoundError as exc:
        raise FileNotFoundError(_no_orders(days, data_dir)) from exc


def reread_orders(spark: SparkSession, files: list[str], days: list[str] | None = None,
                  tokens: tuple[str, ...] = PANDAS_NULL_TOKENS, layout: str = "files",
                  multi_line: bool | str = "auto") -> DataFrame:
    """The order files of the given paths, as ``read_orders`` reads them, with ``_source_path``."""
    days = [normalize_date_str(d) for d in days] if days else None
    return _with_day(read_table_csv(spark, [_as_path(f) for f in files], ORDERS, tokens, None, multi_line), days, layout)
