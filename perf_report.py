"""Writes PERFORMANCE.md: seconds, rows and shuffled bytes per query.

Each query runs once to warm up and three times measured; rows and bytes come
from Spark's event log, which is written to a scratch folder.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

from millrace.catalog import REGISTRY
from millrace.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))


def shuffled_bytes(log: str) -> dict[str, int]:
    """Bytes written to shuffles per job group."""
    group_of: dict[int, str] = {}
    written: dict[str, int] = {}
    with open(log) as f:
        for line in f:
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                group = (event.get("Properties") or {}).get("spark.jobGroup.id")
                for stage in event["Stage IDs"]:
                    group_of[stage] = group
            elif event["Event"] == "SparkListenerTaskEnd":
                metrics = (event.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                group = group_of.get(event["Stage ID"])
                if group:
                    written[group] = written.get(group, 0) + metrics.get("Shuffle Bytes Written", 0)
    return written


def main() -> None:
    names = sys.argv[1:] or sorted(REGISTRY)
    log = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = local_session(
        "report",
        CPUS,
        **{
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log,
            "spark.eventLog.rolling.enabled": "false",
            "spark.eventLog.compress": "false",
        },
    )
    table = []
    for name in names:
        runs, rows = [], 0
        for i in range(4):
            spark.sparkContext.setJobGroup(f"{name}:{i}", name)
            start = time.perf_counter()
            df = REGISTRY[name].run(spark, FOLDER)
            df.write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        spark.sparkContext.setJobGroup("count", "count")
        rows = df.count()
        table.append((name, statistics.median(runs[1:]), rows))
    spark.stop()
    written = shuffled_bytes(glob.glob(f"{log}/*")[0])
    lines = [
        "# Performance",
        "",
        f"`{os.path.basename(FOLDER)}` tables, `local[{CPUS}]`, warm, median of 3 runs; shuffled"
        " KiB of one run. Made by `perf_report.py`.",
        "",
        "| Query | Seconds | Rows | Shuffled KiB |",
        "|---|---:|---:|---:|",
    ]
    for name, seconds, rows in table:
        kib = written.get(f"{name}:3", 0) / 1024
        lines.append(f"| {name} | {seconds:.2f} | {rows:,} | {kib:,.0f} |")
    lines += ["", f"Sum of the medians: {sum(t[1] for t in table):.1f} s for {len(table)} queries.", ""]
    with open("PERFORMANCE.md", "w") as f:
        f.write("\n".join(lines))


if __name__ == "__main__":
    main()
