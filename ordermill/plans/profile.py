"""Dataset profiling.

One aggregate per dataset computes every column's non-null count and the
row count in a single pass; ``unpivot`` turns the wide result row into one
row per column. Several datasets are one union of such aggregates, so
Spark runs them as one job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _wide_counts(df: DataFrame) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count(F.col(c)).alias(f"nn_{i}") for i, c in enumerate(df.columns)]
    return df.agg(*aggs)


def column_profile(df: DataFrame, dataset: str = "df") -> DataFrame:
    """A8 (+A7): one row per column: dataset, position, column, dtype,
    rows, non_null, null_count. Shape = (rows, number of rows here)."""
    wide = _wide_counts(df)
    meta = [(i, c, t) for i, (c, t) in enumerate(df.dtypes)]
    stacked = wide.select(
        F.col("__rows").alias("rows"),
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("dtype"),
                     F.col(f"nn_{i}").alias("non_null"))
            for i, c, t in meta])).alias("p"))
    return stacked.select(
        F.lit(dataset).alias("dataset"), F.col("p.position").alias("position"),
        F.col("p.column").alias("column"), F.col("p.dtype").alias("dtype"),
        F.col("rows"), F.col("p.non_null").alias("non_null"),
        (F.col("rows") - F.col("p.non_null")).alias("null_count"))


def null_counts(df: DataFrame) -> DataFrame:
    """``df.isna().sum()`` in long form: column, null_count."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column", "null_count")


def head_preview(df: DataFrame, n: int = 5) -> DataFrame:
    """T5: the first ``n`` rows (a preview; the limit is the feature)."""
    return df.limit(n)


def preview_datasets(datasets: dict[str, DataFrame], n: int = 5) -> DataFrame:
    """T5 of several datasets in one long table: dataset, row (from 1), column
    and value as text. The rows are the first ``n`` in the order of all
    columns, so the preview is the same on every run; each task passes on its
    own first ``n`` rows."""
    parts = []
    for name, df in datasets.items():
        first = df.orderBy(*df.columns).limit(n)
        numbered = first.withColumn("row", F.row_number().over(Window.orderBy(*df.columns)))  # over n rows
        cells = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                          for i, c in enumerate(df.columns)])
        parts.append(numbered.select(F.lit(name).alias("dataset"), "row", F.inline(cells)))
    return reduce(lambda a, b: a.unionByName(b), parts)


def profile_datasets(datasets: dict[str, DataFrame]) -> DataFrame:
    """Column profiles of several datasets in one table."""
    parts = [column_profile(df, name) for name, df in datasets.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
