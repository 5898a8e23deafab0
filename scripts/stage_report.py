"""Per-stage metrics of registered queries from Spark's event log.

Usage: python scripts/stage_report.py SF_DIR QUERY [QUERY ...]

Runs each query twice into the noop sink with the event log written to a
fresh scratch folder (mktemp) and reports the second (warm) run: one line
per stage: tasks, input
rows, shuffle write/read bytes, and the max/median task run time (a skew
ratio far above 1 means one task carries the stage).
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordermill import registry  # noqa: E402
from ordermill.session import build_session  # noqa: E402


def _mb(b: float) -> str:
    return f"{b / 1e6:.1f}MB"


def report(log_path: str) -> None:
    tasks = defaultdict(list)
    names = {}
    measured: set[int] = set()
    parts = sorted(glob.glob(f"{log_path}/events_*")) if os.path.isdir(log_path) else [log_path]
    for part in parts:
        with open(part) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    if (ev.get("Properties") or {}).get("spark.jobGroup.id") == "measured":
                        measured.update(ev.get("Stage IDs", []))
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    names[info["Stage ID"]] = info["Stage Name"].split(" at ")[0]
                elif kind == "SparkListenerTaskEnd" and ev.get("Task Metrics"):
                    tasks[ev["Stage ID"]].append(ev["Task Metrics"])
    for sid in sorted(tasks):
        if measured and sid not in measured:
            continue
        ms = tasks[sid]
        run = [m["Executor Run Time"] for m in ms]
        rows_in = sum(m.get("Input Metrics", {}).get("Records Read", 0) for m in ms)
        sw = sum(m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0) for m in ms)
        sr = sum(m.get("Shuffle Read Metrics", {}).get("Remote Bytes Read", 0)
                 + m.get("Shuffle Read Metrics", {}).get("Local Bytes Read", 0) for m in ms)
        med = statistics.median(run) or 1
        print(f"  stage {sid:3d} {names.get(sid, ''):12s} tasks={len(ms):4d} in_rows={rows_in:9d} "
              f"shuffle_w={_mb(sw):>8s} shuffle_r={_mb(sr):>8s} max/median_ms={max(run)}/{med:.0f}")


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    for name in names:
        logs = tempfile.mkdtemp(prefix="ordermill-eventlog-")
        spark = build_session("local[8]", 8, app_name=f"stage-report-{name}",
                              extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logs,
                                     "spark.eventLog.compress": "false"})
        registry.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        spark.sparkContext.setJobGroup("measured", name)
        registry.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spark.stop()
        print(name)
        for path in glob.glob(f"{logs}/*"):
            report(path)


if __name__ == "__main__":
    main()
