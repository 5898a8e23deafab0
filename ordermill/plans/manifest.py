"""Which files a day was written from, so a backfill re-runs changed days only.

The manifest is a table in the output folder, partitioned by day: one row
per input file of the day (path, length, time of change), with the product
files' fingerprint and the day's results beside it. A run lists the input
(no file is opened) and compares the listing with the manifest by anti-joins
in both directions: a day is run if a file of it is new, has changed or is
gone, or if the product files have changed. The rows are written after the
day's outputs, from the listing made before the run: a run that breaks off,
or a file that changes meanwhile, is found by the next one.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.sinks import files
from ordermill.sources.csv_files import file_day, orders_place

FILE = ("path", "length", "modified")
RESULTS = ("rows", "revenue", "bad_rows", "status")
SCHEMA = ("path string, length bigint, modified timestamp, products string, rows bigint, revenue double, "
          "bad_rows bigint, status string, date string")


def _listed(spark: SparkSession, path: str, glob_filter: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile")  # of which only the listing is used
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    return reader.load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def order_files(spark: SparkSession, data_dir: str, layout: str = "files") -> DataFrame:
    """(date, path, length, modified) of the order files whose name holds a day."""
    path, glob_filter = orders_place(data_dir, None, layout)
    name = F.regexp_extract("path", r"/([^/]*)/[^/]*$" if layout == "folders" else r"([^/]+)$", 1)
    day = file_day(name)
    iso = F.concat_ws("-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2))
    return _listed(spark, path, glob_filter).withColumn("day", day).where("day <> ''").select(iso.alias("date"), *FILE)


def fingerprint(spark: SparkSession, path: str) -> str:
    """One text for the state of a few files (the product file or its parts)."""
    state = F.sha2(F.to_json(F.array_sort(F.collect_list(F.struct(*FILE)))), 256)
    return _listed(spark, path).agg(state).first()[0]


def stored(spark: SparkSession, output_dir: str) -> DataFrame:
    """The manifest as it is now (empty before the first run)."""
    folder = f"{output_dir}/manifest"
    if not files.exists(spark, folder):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(folder)


def changed(current: DataFrame, known: DataFrame, products: str) -> set[str]:
    """The days (ISO) to run: some file differs from the manifest. At most
    one value per day reaches the driver."""
    key = ["date", *FILE, "products"]
    now = current.withColumn("products", F.lit(products)).select(key)
    before = known.select(key)
    differs = now.join(before, key, "left_anti").select("date").union(before.join(now, key, "left_anti").select("date"))
    return {r.date for r in differs.distinct().collect()}


def record(current: DataFrame, products: str, results: DataFrame, output_dir: str) -> None:
    """Replace the manifest of the days in results (date, rows, revenue, bad_rows, status)."""
    rows = current.join(F.broadcast(results), "date").withColumn("products", F.lit(products))
    files.write_partitioned(rows.select(*FILE, "products", *RESULTS, "date"), f"{output_dir}/manifest", "date", small_rows=True)


def results(known: DataFrame, days: Iterable[str]) -> list:
    """The manifest's results of some days, one row each."""
    wanted = known.where(F.col("date").isin(list(days))).groupBy("date")
    return wanted.agg(*[F.first(c).alias(c) for c in RESULTS]).collect()
