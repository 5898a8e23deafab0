"""Late rows: valid order lines that arrive in the file of another day.

They are filed in a table of their own (``late``, partitioned by the row's
day and the day of the file that brought it) and merged into their day's
partition of ``processed``. A day's partition is always

    the rows of its own files, less the order lines that late rows replace,
    plus the late rows of the latest file for each order line,

where an order line is (order_id, product_id): a later file replaces all
rows of that key on that day, also those of an earlier late file. The rows
of the day's own files are kept aside (``late_base``) when late rows are
first merged, so merging again, with more, other or no late rows, starts
from them and gives the same result however often it is done.

Restart: ``late_base`` counts only once its job has been committed and the
day has been marked; until then ``processed`` still holds the day's own
rows. After that ``processed`` is made from ``late_base`` and ``late``
alone. Running a day's own files again drops the mark before anything else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.functions.numeric import money_out
from ordermill.session import stored_table
from ordermill.sinks import files

LINE_KEY = ("date", "order_id", "product_id")
#: Rows that a task of a merge sorts, about.
TASK_ROWS = 1_000_000
SOURCE_DAY = "source_day"


def _mark(out: str, day: str) -> str:
    return f"{out}/late_base_days/{day}"


def forget_base(spark: SparkSession, out: str, days: list[str]) -> None:
    """Before a day's own files are written anew: what was kept aside of them is out of date."""
    if not files.exists(spark, f"{out}/late_base_days"):
        return
    for day in days:
        files.remove(spark, _mark(out, day))
        files.remove(spark, f"{out}/late_base/date={day}")


def file_rows(late: DataFrame, run_days: list[str], out: str) -> set[str]:
    """Replace the late rows that the files of ``run_days`` (ISO) bring by
    ``late`` (enriched rows with ``date`` and ``source_day``). Returns the
    days whose late rows may have changed."""
    spark = late.sparkSession
    new = stored_table(late, "late-rows")
    pairs = {(r[0], r[1]) for r in new.select("date", SOURCE_DAY).distinct().collect()}
    wanted = set(run_days)
    old = {(d, s) for d, s in files.partitions(spark, f"{out}/late", "date", SOURCE_DAY) if s in wanted}
    for day, source in sorted(old - pairs):
        files.remove(spark, f"{out}/late/date={day}/{SOURCE_DAY}={source}")
    if pairs:
        files.write_partitioned(new, f"{out}/late", ["date", SOURCE_DAY])
    return {d for d, _ in pairs | old}


def _days_of(spark: SparkSession, folder: str, days: list[str], like: DataFrame | None = None) -> DataFrame | None:
    """The partitions of some days; days are text."""
    here = [d for d in days if files.exists(spark, f"{folder}/date={d}")]
    if not here:
        return None if like is None else like.where("false")
    rows = spark.read.option("basePath", folder).parquet(*[f"{folder}/date={d}" for d in here])
    return rows.withColumns({c: F.col(c).cast("string") for c in ("date", SOURCE_DAY) if c in rows.columns})


def _merged_rows(base: DataFrame, late: DataFrame) -> tuple[DataFrame, list[str]]:
    """The rows of some days and which days these are, in one shuffle that serves the comparison by
    order line and the partitioned write: by day, and within a day by as many
    parts as its share of the rows asks for."""
    spark = base.sparkSession
    both = base.withColumn(SOURCE_DAY, F.lit(None).cast("string")).withColumn("__late", F.lit(False)).unionByName(
        late.withColumn("__late", F.lit(True)))
    counts = both.groupBy("date").count().collect()
    total = sum(r["count"] for r in counts)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-total // TASK_ROWS))
    share = max(1, -(-total // tasks))
    parts = spark.createDataFrame([(r["date"], -(-r["count"] // share)) for r in counts], "date string, __parts bigint")
    dealt = both.join(F.broadcast(parts), "date").withColumn("__part", F.pmod(F.xxhash64("order_id"), F.col("__parts"))).drop("__parts")
    key = Window.partitionBy("date", "__part", "order_id", "product_id")
    latest = dealt.repartition(tasks, "date", "__part").withColumn("__latest", F.max(SOURCE_DAY).over(key))
    keyed = F.col("order_id").isNotNull() & F.col("product_id").isNotNull()
    kept = F.when(F.col("__late"), keyed & (F.col(SOURCE_DAY) == F.col("__latest"))).otherwise(~keyed | F.col("__latest").isNull())
    return latest.where(kept).drop(SOURCE_DAY, "__late", "__part", "__latest"), [r["date"] for r in counts]


def _late_counts(late: DataFrame) -> DataFrame:
    """(date, late_rows): the rows of the latest file of each order line."""
    n = late.dropna(subset=list(LINE_KEY)).groupBy(*LINE_KEY, SOURCE_DAY).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(*LINE_KEY).agg(F.max_by("n", SOURCE_DAY).alias("n")).groupBy("date").agg(F.sum("n").alias("late_rows"))


def merge(spark: SparkSession, out: str, days: list[str]) -> list:
    """Make the partitions of ``days`` anew from their own and their late
    rows, with their summaries. One row per day that has rows: date, rows,
    revenue, late_rows."""
    unmarked = [d for d in days if not files.exists(spark, _mark(out, d))]
    own = _days_of(spark, f"{out}/processed", unmarked)
    if own is not None:
        files.write_partitioned(own, f"{out}/late_base", "date", arranged=True)
    for day in unmarked:
        files.touch(spark, _mark(out, day))
    base, late = _days_of(spark, f"{out}/late_base", days), _days_of(spark, f"{out}/late", days)
    if late is not None:
        rows, here = _merged_rows(late.drop(SOURCE_DAY).where("false") if base is None else base, late)
    else:
        rows, here = base, [d for d in days if files.exists(spark, f"{out}/late_base/date={d}")]
    found = []
    if rows is not None:
        files.write_partitioned(rows, f"{out}/processed", "date", arranged=True)
        written = _days_of(spark, f"{out}/processed", here)  # other days may still hold what an earlier run left
        found = written.groupBy("date").agg(F.count(F.lit(1)).alias("rows"), F.coalesce(money_out(F.sum("order_total")), F.lit(0.0)).alias("revenue"))
        found = (found.withColumn("late_rows", F.lit(0).cast("bigint")) if late is None else
                 found.join(_late_counts(late), "date", "left").fillna({"late_rows": 0})).collect()
        summary = spark.createDataFrame([(r.date, r.date.replace("-", ""), r.rows, r.revenue) for r in found],
                                        "date string, run_date string, rows bigint, revenue double")
        files.write_summaries(summary, f"{out}/summaries")
    for day in sorted(set(days) - {r.date for r in found}):
        files.remove(spark, f"{out}/processed/date={day}")
        files.remove(spark, f"{out}/summaries/date={day}")
    return found


def known_days(spark: SparkSession, out: str) -> set[str]:
    """The days that have late rows on record."""
    return {d for d, _ in files.partitions(spark, f"{out}/late", "date", SOURCE_DAY)}
