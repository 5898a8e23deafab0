"""Operator counts of the final adaptive plan of registered queries.

Usage: python scripts/plan_summary.py SF_DIR [QUERY ...]
Prints one markdown row per query: shuffles, broadcasts, sort-merge
joins, broadcast joins, hash and sort aggregates, top-k nodes.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordermill import registry  # noqa: E402
from ordermill.session import build_session  # noqa: E402

PATTERNS = (r"Exchange (hash|range|Single|RoundRobin)", r"BroadcastExchange", r"SortMergeJoin",
            r"BroadcastHashJoin", r"HashAggregate", r"SortAggregate", r"TakeOrderedAndProject")


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(registry.queries())
    spark = build_session("local[8]", 8)
    for name in names:
        df = registry.queries()[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        counts = [len(re.findall(p, final)) for p in PATTERNS]
        print("| " + " | ".join([name, *map(str, counts)]) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
