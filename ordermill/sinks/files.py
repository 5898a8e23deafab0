"""File sinks.

All writes go through Spark's commit protocol (the reference's temp file
plus rename) and dynamic partition overwrite, so a run replaces exactly
the partitions it produces and leaves the others alone. Partitions of a
re-run day that come out empty are removed, so a re-run leaves the same
files as a first run.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.schemas import CORRUPT_COLUMN
from ordermill.session import configure, parallelism

MALFORMED_LINE = "_malformed_line"


def _balanced(df: DataFrame, by: list[str]) -> DataFrame:
    """Group rows of one partition value into few tasks before a
    partitioned write. REBALANCE hashes on ``by`` and lets AQE split a hot
    value over several tasks and merge small ones (no sampling pass, no
    non-deterministic salt, so task retries reproduce the same files)."""
    return df.hint("rebalance", *by)


def write_partitioned(df: DataFrame, output_dir: str, by: str | list[str] = "date",
                      fmt: str = "parquet", header: bool = True, small_rows: bool = False, arranged: bool = False) -> str:
    """W1 (and the W2/W3 layouts): write ``df`` under ``output_dir/by=value/``
    replacing only the partition values present in ``df``.

    ``small_rows`` is for frames with a handful of rows per partition value
    (summaries): they are hash-partitioned by the value, so the many small
    files are created by all writers in parallel (REBALANCE sizes tasks by
    bytes and would give one task every file). ``arranged`` is for frames in
    which the rows of a partition value already lie in few tasks: no shuffle.
    """
    by = [by] if isinstance(by, str) else list(by)
    configure(df.sparkSession)
    if arranged:
        rows = df
    elif small_rows:
        # An explicit count: AQE would merge a tiny frame back into one task.
        parallel = parallelism(df.sparkSession)
        rows = df.repartition(parallel, *[F.col(c) for c in by])
    else:
        rows = _balanced(df, by)
    writer = rows.write.mode("overwrite").partitionBy(*by)
    if fmt == "csv":
        writer = writer.option("header", header)
    writer.format(fmt).save(output_dir)
    return output_dir


def write_parquet_partition(df: DataFrame, output_dir: str, partition_col: str = "date") -> str:
    """Date-partitioned Parquet, one day's partition replaced per run."""
    return write_partitioned(df, output_dir, partition_col, "parquet")


def remove(df_or_spark, path: str) -> None:
    """Delete a partition folder that a re-run leaves empty, if it is there."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def touch(spark, path: str) -> None:
    """An empty file, as a mark."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True).close()


def partitions(spark, folder: str, *names: str) -> list[tuple[str, ...]]:
    """The values of a table's partition folders, from one listing."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path("/".join([folder, *(f"{n}=*" for n in names)]))
    system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for found in system.globStatus(pattern) or []:
        path, values = found.getPath(), []
        for name in reversed(names):
            values.append(path.getName().removeprefix(f"{name}="))
            path = path.getParent()
        out.append(tuple(reversed(values)))
    return out


def names(spark, folder: str, pattern: str) -> list[tuple[str, ...]]:
    """The groups of ``pattern`` in the names of a folder's files that match it whole, from one listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    found = (re.fullmatch(pattern, status.getPath().getName()) for status in listed)
    return [m.groups() for m in found if m]


def flatten(spark, parts_dir: str, output_dir: str, name) -> None:
    """Turn a partitioned write with one file per folder into files of one
    folder: ``parts_dir/<folder>/part-…`` becomes ``output_dir/<name(folder)>``.
    One rename per folder, by the driver."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(parts_dir).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(output_dir))
    for found in system.globStatus(path(f"{parts_dir}/*/part-*")):
        folder = found.getPath().getParent().getName()
        if not system.rename(found.getPath(), path(f"{output_dir}/{name(folder)}")):
            raise OSError(f"cannot move {found.getPath()}")


def write_summaries(summary: DataFrame, output_dir: str) -> str:
    """Summary rows as JSON, one partition per date; a row without a
    date is filed under ``date=run``."""
    return write_partitioned(summary.withColumn("date", F.coalesce(F.col("date"), F.lit("run"))),
                             output_dir, "date", "json", small_rows=True)


def write_bad_rows(bad: DataFrame | None, output_dir: str, dataset: str, date: str | None = None,
                   known_empty: bool | None = None) -> str | None:
    """Rejected rows as header CSV under
    ``dataset=<name>/date=<day>/``. Returns None and writes nothing when
    there are no rows (``known_empty`` skips the emptiness probe when the
    caller already counted them); rows that an earlier run left under the
    same ``date`` (``run`` where rows have none) are removed then."""
    if bad is None:
        return None
    empty = bad.isEmpty() if known_empty is None else known_empty
    if empty:
        if date is not None or "date" not in bad.columns:
            remove(bad, f"{output_dir}/dataset={dataset}/date={date or 'run'}")
        return None
    out = bad.withColumn("dataset", F.lit(dataset))
    if CORRUPT_COLUMN in out.columns:
        # A column of this name in a CSV header is taken for Spark's own
        # corrupt-record slot when the file is read back; store it apart.
        out = out.withColumnRenamed(CORRUPT_COLUMN, MALFORMED_LINE)
    if date is not None or "date" not in out.columns:
        out = out.withColumn("date", F.lit(date or "run"))
    # CSV holds only atomic values; arrays (if any) are joined.
    out = out.select(*[F.array_join(F.col(f.name), "; ").alias(f.name)
                       if f.dataType.typeName() == "array" else F.col(f.name)
                       for f in out.schema.fields])
    write_partitioned(out, output_dir, ["dataset", "date"], "csv")
    return f"{output_dir}/dataset={dataset}"


def write_sorted(df: DataFrame, output_dir: str, *order) -> str:
    """T2–T4 as stored order: range-partitioned by ``order`` and sorted, so
    file by file and row by row the folder is in order. No task sorts more
    than its range."""
    configure(df.sparkSession)
    df.orderBy(*order).write.mode("overwrite").parquet(output_dir)
    return output_dir


def read_sorted(spark, output_dir: str, position: str = "position") -> DataFrame:
    """What ``write_sorted`` wrote, with each row's place in the whole order
    (from 1), told by its file and its row in the file: no sort. Only one row
    per file is gathered to number the files."""
    rows = spark.read.parquet(output_dir)
    own = rows.columns
    rows = rows.select("*", F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int").alias("__file"),
                       F.col("_metadata.row_index").alias("__row"))
    sizes = rows.groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__file", F.coalesce(before, F.lit(0)).alias("__before"))
    return rows.join(F.broadcast(starts), "__file").select(*own, (F.col("__before") + F.col("__row") + 1).alias(position))


def show_table(df: DataFrame, n: int = 20) -> None:
    """Console output (user convenience; prints ``n`` rows)."""
    df.show(n, truncate=False)
