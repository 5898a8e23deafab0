"""Command line: ``python -m ordermill --start-date D [--end-date D]
--data-dir DIR --output-dir DIR [--dry-run]`` (or the same module under
spark-submit).

One date runs the one-day pipeline (P1) and prints its summary; a range
runs the backfill (P3) and prints one line per day. Dates are YYYYMMDD or
YYYY-MM-DD.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from ordermill.functions.dates import normalize_date_str
from ordermill.plans import pipeline
from ordermill.session import configure


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="ordermill", description="Daily order pipeline")
    p.add_argument("--start-date", required=True, help="YYYYMMDD or YYYY-MM-DD")
    p.add_argument("--end-date", help="YYYYMMDD or YYYY-MM-DD (inclusive)")
    p.add_argument("--data-dir", required=True, help="folder with order_*.csv and products.csv")
    p.add_argument("--output-dir", help="output folder (required unless --dry-run)")
    p.add_argument("--dry-run", action="store_true", help="compute the summary, write nothing")
    p.add_argument("--window-days", type=int, default=31, help="days per backfill window")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    start = normalize_date_str(args.start_date)
    end = normalize_date_str(args.end_date) if args.end_date else start
    spark = configure(SparkSession.builder.appName("ordermill").getOrCreate())
    inputs = pipeline.csv_inputs(spark, args.data_dir)
    if start == end:
        try:
            summary = pipeline.run_for_date(spark, start, inputs, args.output_dir, args.dry_run)
        except Exception as exc:  # noqa: BLE001 - reported, as for a day of a range
            summary = {"date": start, "error": str(exc).splitlines()[0]}
        print(json.dumps(summary))
    else:
        report = pipeline.backfill(spark, start, end, inputs, args.output_dir, args.dry_run,
                                   window_days=args.window_days)
        for row in report.orderBy("date").toLocalIterator():  # one row per day of the range
            print(json.dumps(row.asDict()))


if __name__ == "__main__":
    main()
