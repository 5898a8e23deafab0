"""Daily order files as they land (the reference's per-day trigger,
re-aimed as Structured Streaming; not a new operator).

A file stream over the drop folder notices new order files. Each
micro-batch finds the days its files belong to and re-runs the backfill
job (P3) for exactly those days over *all* their files in the folder,
with dynamic partition overwrite. A day whose files arrive in several
batches is therefore rebuilt whole each time, and replaying a batch after
a failure rewrites the same partitions: the sink is idempotent, and the
stream's checkpoint (in the shared folder) records which files were seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordermill.plans import pipeline
from ordermill.session import configure
from ordermill.sources.csv_files import ORDER_GLOB, file_day

# The binaryFile source's schema (streams must declare it).
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _run_days(spark: SparkSession, data_dir: str, output_dir: str):
    def handle(batch: DataFrame, epoch_id: int) -> None:
        # The distinct days of one batch: at most a few values per file.
        name = F.regexp_extract(F.col("path"), r"([^/]+)$", 1)
        days = sorted(r[0] for r in batch.select(file_day(name).alias("d"))
                      .where(F.col("d") != "").distinct().collect())
        if not days:
            return
        inputs = pipeline.csv_inputs(spark, data_dir)
        for start, end in _runs(days):
            pipeline.backfill(spark, start, end, inputs, output_dir)
    return handle


def _runs(days: list[str]) -> list[tuple[str, str]]:
    """Group sorted YYYYMMDD days into consecutive ranges."""
    import datetime as dt

    out, start, prev = [], None, None
    for d in days:
        cur = dt.datetime.strptime(d, "%Y%m%d")
        if prev is not None and (cur - prev).days == 1:
            prev = cur
            continue
        if start is not None:
            out.append((start.strftime("%Y%m%d"), prev.strftime("%Y%m%d")))
        start = prev = cur
    if start is not None:
        out.append((start.strftime("%Y%m%d"), prev.strftime("%Y%m%d")))
    return out


def start_file_drop(spark: SparkSession, data_dir: str, output_dir: str,
                    checkpoint: str | None = None, available_now: bool = True,
                    interval: str = "1 minute") -> StreamingQuery:
    """Start the stream. ``available_now`` processes what is there and
    stops (a scheduled run); otherwise it polls every ``interval``. The
    checkpoint, by default a folder of the output, tells a restart which
    files it has seen."""
    configure(spark)
    # Only the names of new files are needed here (the backfill reads the
    # rows): a binaryFile stream with just ``path`` selected lists files
    # without reading their contents.
    stream = (spark.readStream.format("binaryFile")
              .schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", ORDER_GLOB)
              .load(data_dir)
              .select("path"))
    writer = (stream.writeStream.foreachBatch(_run_days(spark, data_dir, output_dir))
              .option("checkpointLocation", checkpoint or f"{output_dir.rstrip('/')}/_file_drop_checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
