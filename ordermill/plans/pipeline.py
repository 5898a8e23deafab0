"""The ingest pipeline.

One tagged pass over the raw orders parses the date (C3), applies the
order rules (V2) and computes the line total (F1); good rows, bad rows
and the per-day summary are three projections of that one frame. A run
that writes persists the tagged frame (MEMORY_AND_DISK, lineage kept,
so a lost executor's blocks are recomputed) and evaluates the rules
once; a dry run executes only the summary aggregate.

Where the reference loops over days and calls the one-day run for each,
the backfill (P3) scans many days at once: a dry run is one aggregate
over the range; a writing run goes through bounded windows of days, each
one scan, one persisted tagged frame and one dynamic-overwrite write per
output.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.dates import iso_date, normalize_date_str
from ordermill.functions.numeric import line_total, money_out
from ordermill.operators import table_rules
from ordermill.operators import validate as V
from ordermill.operators.joins import assert_unique_key
from ordermill.operators.transforms import add_order_date_iso, add_order_total, enrich_with_products
from ordermill.plans import late, manifest, partials
from ordermill.schemas import CORRUPT_COLUMN, ORDERS, PRODUCTS
from ordermill.session import configure, stored_table
from ordermill.sinks import files
from ordermill.sources import csv_files

TS = "__order_ts"
DAY = "date"
GOOD = "__good"
TOTAL = "__total"
LATE = "__late"

#: Products up to this number (about 150 bytes each) are broadcast to the order lines that a run writes.
MAX_BROADCAST_PRODUCTS = 1_000_000

# Per-day status of a backfill.
STATUS_OK = "ok"
STATUS_NO_VALID = "no_valid_rows"
STATUS_MISSING = "missing"
STATUS_ERROR = "error"
STATUS_UNCHANGED = "unchanged"
MSG_NO_FILE = "No order file for date "
REPORT_SCHEMA = ("date string, run_date string, rows bigint, revenue double, bad_rows bigint, "
                 "status string, error string")


@dataclass
class Inputs:
    """Where raw tables come from: ``orders(days)`` returns raw order rows
    with ``_file_day`` for the given YYYYMMDD days (None = all);
    ``products()`` returns raw products.

    Sources that can be read by one optimistic scan also have ``scan(days)``,
    which returns the rows with what it takes to check them, and
    ``reread(files, days)`` for the files that fail the check.
    """

    orders: Callable[[list[str] | None], DataFrame]
    products: Callable[[], DataFrame]
    scan: Callable[[list[str] | None], DataFrame] | None = None
    reread: Callable[[list[str], list[str] | None], DataFrame] | None = None
    #: For incremental backfills: the listing (date, path, length, modified) and the product files' fingerprint.
    listing: Callable[[], DataFrame] | None = None
    products_state: Callable[[], str] | None = None


def csv_inputs(spark: SparkSession, data_dir: str, layout: str = "files", multi_line: bool | str = "auto") -> Inputs:
    """Order and product CSVs in ``data_dir`` (``layout`` and ``multi_line``
    as in ``csv_files.read_orders``). With "auto" orders are read by one scan,
    and only files of another kind than the first are read again."""
    inputs = Inputs(lambda days: csv_files.read_orders(spark, data_dir, days, layout=layout, multi_line=multi_line),
                    lambda: csv_files.read_products(spark, data_dir, multi_line=multi_line))
    inputs.listing = lambda: manifest.order_files(spark, data_dir, layout)
    inputs.products_state = lambda: manifest.fingerprint(spark, f"{data_dir.rstrip('/')}/products.csv")
    if multi_line == "auto":
        inputs.scan = lambda days: csv_files.scan_orders(spark, data_dir, days, layout=layout)
        inputs.reread = lambda paths, days: csv_files.reread_orders(spark, paths, days, layout=layout)
    return inputs


def table_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    from ordermill.sources import tables

    return Inputs(lambda days: tables.raw_orders(spark, sf_dir, days),
                  lambda: tables.raw_products(spark, sf_dir))


def _file_day_iso(c: Column) -> Column:
    return F.when(c.rlike(r"^\d{8}$"),
                  F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2)))


def tag_orders(raw: DataFrame, date_format: str | None = "%Y-%m-%d",
               strict_optional: bool = False, late: bool = False) -> DataFrame:
    """Parse, validate and total raw orders in one projection.

    Adds: ``__order_ts`` (parsed date), ``_date_recovered``,
    ``_parse_error`` (rows the parse rejects; they skip validation, as in
    the reference), ``_error`` (validation failures, '' when none, NULL
    for parse rejects), ``date`` (the day the row is filed under: its file's day, or
    its own date when the file name has none), ``__good`` and ``__total``
    (the rounded line total of a good row).

    A row dated on another day than its file's is rejected ("outside run
    date"), so writing a day never touches another day's partition. With
    ``late`` such a row that breaks no other rule is neither good nor bad but
    marked in ``__late``, to be merged into its own day (``plans/late.py``).
    """
    df = V.with_required_columns(raw, ORDERS)
    df = V.tag_dates(df, "order_date", date_format, parsed_col=TS)
    file_day = _file_day_iso(F.col("_file_day")) if "_file_day" in df.columns else F.lit(None)
    iso_ts = iso_date(F.col(TS))
    df = df.withColumn(DAY, F.coalesce(file_day, iso_ts))
    # order_date itself was checked by the parse stage.
    rules = V.error_text(df, ORDERS, strict_optional, exclude=("order_date",))
    # "<parsed day>|" starts with "<file day>|" (with "" when the file name
    # has no day) exactly when the date parsed and lies on the file's day.
    # Written with a single reference to the parsed date on purpose: a
    # filter on the good flag is pushed below this projection, and
    # Catalyst then inlines the whole parse at every reference.
    on_day = F.coalesce(
        F.concat(iso_ts, F.lit("|")).startswith(F.coalesce(F.concat(file_day, F.lit("|")), F.lit(""))),
        F.lit(False))
    df = df.withColumns({"__rules": rules, "__on_day": on_day})
    outside = F.when(~F.col("__on_day"), F.concat(F.lit(V.MSG_OUTSIDE_RUN), file_day))
    if late:
        df = df.withColumn(LATE, V.is_valid(F.col("__rules")) & ~F.col("__on_day") & F.col(TS).isNotNull())
        outside = F.when(~F.col(LATE), outside)
    df = df.withColumn(V.ERROR, F.when(F.col(TS).isNotNull(),
                                       F.concat_ws(V.SEPARATOR, F.nullif(F.col("__rules"), F.lit("")), outside)))
    df = df.withColumn(GOOD, V.is_valid(F.col("__rules")) & F.col("__on_day")).drop("__rules", "__on_day")
    typed = V.typed_values(df, ORDERS, overrides={"order_date": F.col(TS)})
    return df.withColumn(TOTAL, F.when(F.col(GOOD), line_total(typed["qty"], typed["unit_price"])))


def _typed_orders(rows: DataFrame, *more: str) -> DataFrame:
    typed = V.typed_values(rows, ORDERS, overrides={"order_date": F.col(TS)})
    return rows.select(*[typed[n].alias(n) for n in ORDERS.names], F.col(V.RECOVERED), *more)


def good_orders(tagged: DataFrame) -> DataFrame:
    """Valid rows, typed, in the reference's column order (+ recovery flag)."""
    return _typed_orders(tagged.where(F.col(GOOD)))


def late_orders(tagged: DataFrame) -> DataFrame:
    """Late rows (of ``tag_orders(late=True)``), typed, with ``source_day``, the day of their file."""
    return _typed_orders(tagged.where(F.col(LATE)).withColumn(late.SOURCE_DAY, F.col(DAY)), late.SOURCE_DAY)


def _is_bad(tagged: DataFrame) -> Column:
    return ~F.col(GOOD) & ~F.col(LATE) if LATE in tagged.columns else ~F.col(GOOD)


def bad_orders(tagged: DataFrame, keep_parsed: bool = False) -> DataFrame:
    """V6: parse rejects (``_parse_error``) and rule rejects (``_error``)
    in one frame, original text kept; the same rows a schema-widening
    union of the two channels gives. With ``keep_parsed`` a rule reject
    shows its parsed order date (``YYYY-MM-DD``) instead of the text."""
    keep = [c for c in ORDERS.names + ["_source_file", DAY] if c in tagged.columns]
    if CORRUPT_COLUMN in tagged.columns:
        keep.append(CORRUPT_COLUMN)
    cols = [F.col(c) for c in keep]
    if keep_parsed:
        cols = [F.coalesce(iso_date(F.col(TS)), F.col(c)).alias(c) if c == "order_date" else F.col(c)
                for c in keep]
    return tagged.where(_is_bad(tagged)).select(*cols, F.col(V.PARSE_ERROR), F.col(V.ERROR))


def day_summary(tagged: DataFrame) -> DataFrame:
    """A6 + V7 per day in one aggregate: valid rows, revenue (every status,
    sum of rounded line totals, rounded), bad rows."""
    return tagged.groupBy(DAY).agg(
        F.count_if(F.col(GOOD)).alias("rows"),
        F.coalesce(money_out(F.sum(TOTAL)), F.lit(0.0)).alias("revenue"),
        F.count_if(_is_bad(tagged)).alias("bad_rows"),
    )


def _other_files(df: DataFrame, paths: list[str]) -> DataFrame:
    """The rows of ``df`` that come from other files than ``paths``."""
    if not paths:
        return df
    listed = df.sparkSession.createDataFrame([(p,) for p in paths], f"{csv_files.SOURCE_PATH} string")
    return df.join(F.broadcast(listed), csv_files.SOURCE_PATH, "left_anti")


def apply_table_rules(tagged: DataFrame, rules: list) -> DataFrame:
    """Tagged orders with table-level rules (``table_rules``) on their good rows."""
    if not rules:
        return tagged
    out = table_rules.apply_rules(tagged, rules, ORDERS, {"order_date": F.col(TS)})
    good = F.col(GOOD) & (F.col(V.ERROR) == "")
    return out.withColumns({GOOD: good, TOTAL: F.when(good, F.col(TOTAL))})


class TaggedRun:
    """The tagged orders of some days, persisted while their outputs are written.

    From an input that is scanned optimistically, the first action (which
    fills the cache and so is the one read of the input) also finds the
    files the scan may have misread; they are read again and replaced.
    """

    def __init__(self, inputs: Inputs, days: list[str], date_format: str | None, rules: list | None = None, merge_late: bool = False):
        tag = lambda raw: tag_orders(raw, date_format, late=merge_late).persist(StorageLevel.MEMORY_AND_DISK)
        self.held = [tag((inputs.scan or inputs.orders)(days))]
        self.rows = self.held[0]
        try:
            if inputs.scan is not None:
                self._settle(inputs, days, tag)
            self.rows = apply_table_rules(self.rows, rules or [])
        except BaseException:
            self.close()
            raise

    def _settle(self, inputs: Inputs, days: list[str], tag) -> None:
        paths = csv_files.unsettled(self.rows)
        self.rows = csv_files.rows_of(_other_files(self.rows, paths)).drop(csv_files.SOURCE_PATH)
        if paths:
            self.held.append(tag(inputs.reread(paths, days).drop(csv_files.SOURCE_PATH)))
            self.rows = self.rows.unionByName(self.held[1])

    def close(self) -> None:
        for frame in self.held:
            frame.unpersist()


def summarise(inputs: Inputs, days: list[str], date_format: str | None = "%Y-%m-%d") -> DataFrame:
    """``day_summary`` of some days without persisting rows. An optimistic
    scan is summed by day and file, so the files it may have misread can be
    taken out of the sums and read again."""
    if inputs.scan is None:
        return day_summary(tag_orders(inputs.orders(days), date_format))
    path = csv_files.SOURCE_PATH
    row = F.col(f"{csv_files.LINE}.kind") != csv_files.HEADER
    sums = [F.count_if(F.col(GOOD) & row).alias("rows"), F.sum(TOTAL).alias("total"), F.count_if(~F.col(GOOD) & row).alias("bad_rows")]
    scanned = tag_orders(inputs.scan(days), date_format).groupBy(DAY, path).agg(*sums, *csv_files.line_checks())
    scanned = stored_table(scanned, "day-file-sums")
    checks = scanned.groupBy(path).agg(F.min("_top").alias("_top"), F.sum("_headers").alias("_headers"), F.sum("_open").alias("_open"))
    paths = sorted(r[0] for r in checks.where(csv_files.is_unsettled()).select(path).collect())
    parts = _other_files(scanned, paths).select(DAY, "rows", "total", "bad_rows")
    if paths:
        again = tag_orders(inputs.reread(paths, days), date_format).groupBy(DAY).agg(
            F.count_if(F.col(GOOD)).alias("rows"), F.sum(TOTAL).alias("total"), F.count_if(~F.col(GOOD)).alias("bad_rows"))
        parts = parts.unionByName(again)
    return parts.groupBy(DAY).agg(F.sum("rows").alias("rows"), F.coalesce(money_out(F.sum("total")), F.lit(0.0)).alias("revenue"),
                                  F.sum("bad_rows").alias("bad_rows")).where("rows + bad_rows > 0")


def valid_products(raw_products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """V3 on the product file: (typed good rows, bad rows)."""
    return V.validate_dataframe(raw_products, PRODUCTS)


def enrich(good: DataFrame, products: DataFrame, broadcast: bool = True, small: bool = False) -> DataFrame:
    """F1 → J1 → F2 on valid rows; the partition column is ``date``. ``small``: products were counted and are few."""
    out = add_order_total(good)
    out = enrich_with_products(out, products, "left", validate=True, broadcast=broadcast, small=small)
    out = add_order_date_iso(out, "order_date", "order_date_iso")
    return out.withColumn(DAY, F.col("order_date_iso"))


def _write_processed(good: DataFrame, products: DataFrame, out: str, broadcast: bool) -> str:
    """Enrich valid rows and write them by day. Products of a bounded number
    are broadcast: the rows are then dealt by day while they have only their
    own columns, and cross no other shuffle."""
    if broadcast and products.count() <= MAX_BROADCAST_PRODUCTS:
        dealt = good.withColumn("__day", iso_date(F.col("order_date"))).hint("rebalance", "__day").drop("__day")
        rows = enrich(dealt, products, True, small=True)
        return files.write_partitioned(rows, f"{out}/processed", DAY, arranged=True)
    return files.write_parquet_partition(enrich(good, products, broadcast), f"{out}/processed", DAY)


def _iso_day(day: str) -> str:
    return f"{day[:4]}-{day[4:6]}-{day[6:]}"


def _write_outputs(tagged: DataFrame, products_good: DataFrame, out: str, summary: DataFrame,
                   counts: list[tuple[str, int, int]], broadcast: bool, sums: bool = False) -> str | None:
    """Write the outputs of the days in ``counts`` (ISO day, good rows, bad
    rows) and remove what an earlier run of a day left of a kind it has no
    rows of now."""
    spark = tagged.sparkSession
    parquet = None
    late.forget_base(spark, out, [day for day, _, _ in counts])
    if any(good for _, good, _ in counts):
        parquet = _write_processed(good_orders(tagged), products_good, out, broadcast)
        if sums:
            partials.write(partials.of_lines(good_orders(tagged).withColumn(DAY, iso_date(F.col("order_date"))), days=len(counts)), out)
        files.write_summaries(summary.where(F.col("rows") > 0).select(DAY, "run_date", "rows", "revenue"),
                              f"{out}/summaries")
    if any(bad for _, _, bad in counts):
        files.write_bad_rows(bad_orders(tagged), f"{out}/bad_rows", "orders", known_empty=False)
    for day, good, bad in counts:
        if not good:
            for kind in ("processed", "summaries", *(["partials"] if sums else [])):
                files.remove(spark, f"{out}/{kind}/{DAY}={day}")
        if not bad:
            files.remove(spark, f"{out}/bad_rows/dataset=orders/{DAY}={day}")
    return parquet


def run_for_date(spark: SparkSession, date_str: str, inputs: Inputs, output_dir: str | None = None,
                 dry_run: bool = False, date_format: str | None = "%Y-%m-%d",
                 broadcast: bool = True, rules: list | None = None, merge_late: bool = False) -> dict:
    """P1 (+P2, W5): one day, read → parse → validate → total → enrich →
    ISO date → summary → write. Returns the summary as a dict; ``date`` is
    the day as given, the stored summary uses the ISO day. Re-running a day
    leaves the files of the last run alone. ``rules``: table-level rules
    (``table_rules``) on the rows that pass the row rules. ``merge_late``:
    valid rows of another day than the file's are merged into their day
    (``plans/late.py``) instead of being rejected; rows and revenue are those
    of the day with its late rows then."""
    configure(spark)
    if not dry_run and not output_dir:
        raise ValueError("output_dir is required unless dry_run")
    day = normalize_date_str(date_str)
    products_good, products_bad = valid_products(inputs.products())
    parquet, run = None, None
    if not dry_run:
        products_good = products_good.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # before anything is written, and in a dry run too, which joins nothing
        assert_unique_key(products_good.select("product_id"), "product_id", "products")
        if dry_run and not rules:
            per_day = summarise(inputs, [day], date_format)
        else:
            run = TaggedRun(inputs, [day], date_format, rules, merge_late and not dry_run)
            per_day = day_summary(run.rows)
        found = per_day.collect()  # a file without a day in its name may hold several
        rows, bad = sum(r["rows"] for r in found), sum(r["bad_rows"] for r in found)
        revenue = float(round(sum(Decimal(repr(r["revenue"])) for r in found), 2))
        if not dry_run:
            out = output_dir.rstrip("/")
            summary = day_summary(run.rows).withColumn("run_date", F.lit(day))
            sums = partials.kept(spark, out)
            table_dir = _write_outputs(run.rows, products_good, out, summary, [(_iso_day(day), rows, bad)], broadcast, sums)
            if table_dir:  # the day's partition, as the reference returns its file
                parquet = f"{table_dir}/{DAY}={_iso_day(day)}"
            files.write_bad_rows(products_bad, f"{out}/bad_rows", "products")
            if merge_late:
                touched = late.file_rows(enrich(late_orders(run.rows), products_good, broadcast), [_iso_day(day)], out)
                for r in _merged(spark, out, touched, [_iso_day(day)], sums):
                    if r[DAY] == _iso_day(day):
                        rows, revenue, parquet = r["rows"], r["revenue"], f"{out}/processed/{DAY}={r[DAY]}"
    finally:
        if run:
            run.close()
        if not dry_run:
            products_good.unpersist()
    return {"date": date_str, "rows": rows, "revenue": revenue, "bad_rows": bad,
            "parquet_path": parquet}


def _merged(spark: SparkSession, out: str, touched: set[str], run_days: list[str], sums: bool) -> list:
    """Merge late rows into the days whose late rows or own files a run has written."""
    days = sorted(touched | (late.known_days(spark, out) & set(run_days)))
    found = late.merge(spark, out, days) if days else []
    if sums and days:
        partials.refresh(spark, out, days)
    return found


def day_range(start: str, end: str | None = None) -> list[str]:
    """Inclusive list of YYYYMMDD days (driver side; its length is the
    length of the range, not of the data)."""
    s = dt.datetime.strptime(normalize_date_str(start), "%Y%m%d")
    e = dt.datetime.strptime(normalize_date_str(end or start), "%Y%m%d")
    if e < s:
        raise ValueError(f"end date {end} is before start date {start}")
    return [(s + dt.timedelta(days=i)).strftime("%Y%m%d") for i in range((e - s).days + 1)]


def _each_day(days: list[str], work: Callable[[list[str]], list]) -> tuple[list, dict[str, str]]:
    """``work`` on all days at once; where it fails, on each half, down to
    the days that fail alone: (rows of the others, error text by day)."""
    try:
        return work(days), {}
    except FileNotFoundError:
        return [], {}
    except Exception as exc:  # noqa: BLE001 - recorded for the day, as the reference does
        if len(days) == 1:
            return [], {days[0]: _error_text(exc)}
    half = len(days) // 2
    first, errors = _each_day(days[:half], work)
    second, more = _each_day(days[half:], work)
    return first + second, errors | more


def _error_text(exc: Exception) -> str:
    lines = [x.strip() for x in str(exc).splitlines() if x.strip()]
    return next((x for x in lines if "many-to-one" in x), lines[0] if lines else type(exc).__name__)


def _listing(inputs: Inputs, out: str) -> tuple[DataFrame, str, DataFrame]:
    """The input's files and product fingerprint as they are now (kept, so
    that later changes do not show), and the manifest."""
    listing = stored_table(inputs.listing(), "listing")
    return listing, inputs.products_state(), manifest.stored(listing.sparkSession, out)


def _forget(spark: SparkSession, out: str, days: list[str]) -> None:
    """Remove the outputs and the manifest of days that have no file any more."""
    for day in days:
        for kind in ("processed", "summaries", "bad_rows/dataset=orders", "partials", "manifest"):
            files.remove(spark, f"{out}/{kind}/{DAY}={day}")


def _with_late(rows: list, merged: list) -> list[dict]:
    """Per-day results with the rows and revenue of the days that late rows were merged into."""
    out = {r[DAY]: {DAY: r[DAY], "rows": r["rows"], "revenue": r["revenue"], "bad_rows": r["bad_rows"]} for r in rows}
    for r in merged:
        out[r[DAY]] = {DAY: r[DAY], "rows": r["rows"], "revenue": r["revenue"], "bad_rows": out.get(r[DAY], {}).get("bad_rows", 0)}
    return list(out.values())


def _report(spark: SparkSession, days: list[str], rows: list, errors: dict[str, str],
            products_error: str | None, same: list = ()) -> DataFrame:
    """One row per day of the range; ``same``: results of days that were not run."""
    found = {r[DAY]: r for r in rows}
    unchanged = {r[DAY]: r for r in same}
    out = []
    for day in days:
        r = found.get(_iso_day(day))
        if day in errors or (r is not None and products_error):
            out.append((_iso_day(day), day, None, None, None, STATUS_ERROR, errors.get(day, products_error)))
        elif r is None and _iso_day(day) in unchanged:
            r = unchanged[_iso_day(day)]
            out.append((_iso_day(day), day, r["rows"], r["revenue"], r["bad_rows"], STATUS_UNCHANGED, None))
        elif r is None:
            out.append((_iso_day(day), day, None, None, None, STATUS_MISSING, MSG_NO_FILE + day))
        else:
            out.append((_iso_day(day), day, r["rows"], r["revenue"], r["bad_rows"],
                        STATUS_OK if r["rows"] else STATUS_NO_VALID, None))
    return spark.createDataFrame(out, REPORT_SCHEMA)


def _products_error(products: Callable[[], DataFrame]) -> str | None:
    """Why no day can be enriched: a missing product file or a repeated key."""
    try:
        good, _ = valid_products(products())
        assert_unique_key(good.select("product_id"), "product_id", "products")
    except (FileNotFoundError, ValueError) as exc:
        return _error_text(exc)
    return None


def backfill(spark: SparkSession, start: str, end: str, inputs: Inputs, output_dir: str | None = None,
             dry_run: bool = False, date_format: str | None = "%Y-%m-%d",
             broadcast: bool = True, window_days: int = 31, incremental: bool = False,
             rules: list | None = None, merge_late: bool = False, keep_partials: bool = False) -> DataFrame:
    """Every day of [start, end].

    Returns one row per day: date, run_date, rows, revenue, bad_rows,
    status (ok / no_valid_rows / missing / error) and error. A day without
    a file or whose run fails does not stop the others: work that fails is
    repeated on ever smaller parts of the range until the failing days
    stand alone. Products that cannot be joined (no file, repeated key)
    are an error of every day that has a file, in a dry run too.

    A dry run is one aggregate over the whole range. A writing run works
    through the range in windows of ``window_days`` days: each window is
    one scan of its files, one persisted tagged frame (so the cached
    volume is bounded by the window, not by the range) and one
    dynamic-overwrite write per output. Windows are idempotent. The report
    (one row per day) is written to the output folder and read back.

    ``incremental`` (a writing run over files): only the days whose files, or
    whose products, differ from the manifest of earlier runs are run; the
    others are reported as ``unchanged`` with their results. A day whose
    files are all gone loses its outputs and is ``missing``.

    ``rules``: table-level rules (``table_rules``); a writing run holds each
    window to them, a dry run the whole range. ``merge_late`` (a writing
    run): valid rows of another day than their file's are filed and, after
    the last window, merged into their day (``plans/late.py``), in or out of
    the range; rows and revenue of the report are those of the merged days.
    ``keep_partials``: the days' partial sums (``plans/partials.py``) are
    written too; once they are there, every later run keeps them.
    """
    configure(spark)
    if not dry_run and not output_dir:
        raise ValueError("output_dir is required unless dry_run")
    days = day_range(start, end)
    in_range = F.col(DAY).isin([_iso_day(d) for d in days]) if len(days) <= 100 else (
        F.col(DAY).between(_iso_day(days[0]), _iso_day(days[-1])))
    products_error = _products_error(inputs.products)
    if incremental and (dry_run or inputs.listing is None):
        raise ValueError("an incremental backfill writes, and needs inputs with a listing of files")

    if dry_run or products_error:
        def totals(part: list[str]) -> list:
            if not rules:
                return summarise(inputs, part, date_format).where(in_range).collect()
            run = TaggedRun(inputs, part, date_format, rules)
            try:
                return day_summary(run.rows).where(in_range).collect()
            finally:
                run.close()

        rows, errors = _each_day(days, totals)
        report = _report(spark, days, rows, errors, products_error)
        if dry_run:
            return report
    else:
        out = output_dir.rstrip("/")
        products_good, products_bad = valid_products(inputs.products())
        products_good = products_good.persist(StorageLevel.MEMORY_AND_DISK)

        def write(window: list[str]) -> list:
            run = TaggedRun(inputs, window, date_format, rules, merge_late)
            try:
                per_day = day_summary(run.rows).where(in_range).collect()
                counts = [(r[DAY], r["rows"], r["bad_rows"]) for r in per_day]
                summary = spark.createDataFrame(
                    [(r[DAY], r[DAY].replace("-", ""), r["rows"], r["revenue"]) for r in per_day],
                    "date string, run_date string, rows bigint, revenue double")
                _write_outputs(run.rows, products_good, out, summary, counts, broadcast, sums)
                if merge_late:
                    touched.update(late.file_rows(enrich(late_orders(run.rows), products_good, broadcast), [_iso_day(d) for d in window], out))
                return per_day
            finally:
                run.close()

        rows, errors, todo, same, touched = [], {}, days, [], set()
        sums = keep_partials or partials.kept(spark, out)
        if incremental:
            listing, state, known = _listing(inputs, out)
            differ = manifest.changed(listing, known, state) & {_iso_day(d) for d in days}
            todo = [d for d in days if _iso_day(d) in differ]
            here = {r[DAY] for r in listing.select(DAY).distinct().collect()}
            _forget(spark, out, sorted(differ - here))
            same = manifest.results(known, {_iso_day(d) for d in days} & here - differ)
        try:
            for i in range(0, len(todo), max(1, window_days)):
                done, failed = _each_day(todo[i:i + max(1, window_days)], write)
                rows, errors = rows + done, errors | failed
                if incremental and done:
                    results = [(r[DAY], r["rows"], r["revenue"], r["bad_rows"], STATUS_OK if r["rows"] else STATUS_NO_VALID) for r in done]
                    manifest.record(listing, state, spark.createDataFrame(
                        results, "date string, rows bigint, revenue double, bad_rows bigint, status string"), out)
            files.write_bad_rows(products_bad, f"{out}/bad_rows", "products")
            if merge_late:
                rows = _with_late(rows, _merged(spark, out, touched, [_iso_day(d) for d in todo], sums))
        finally:
            products_good.unpersist()
        report = _report(spark, days, rows, errors, None, same)
    path = f"{output_dir.rstrip('/')}/runs/{days[0]}_{days[-1]}/attempt-{uuid.uuid4().hex[:12]}/report"
    report.coalesce(1).write.parquet(path)
    return spark.read.parquet(path)
