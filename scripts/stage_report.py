"""Per-stage task balance from Spark's event log (no UI, no REST).

Runs queries with ``spark.eventLog.enabled`` writing to a fresh scratch folder,
then reads the log: for every stage, the number of tasks, the slowest and the
median task time, and the largest and median records read by one task (input
plus shuffle).  A skewed stage shows ``max_rec`` far above ``median_rec``.

    python scripts/stage_report.py [sf_dir] [query ...]
    python scripts/stage_report.py --hot-user [sf_dir]   # R3 both plans on a log where one user holds 1/3
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def session(log_dir: str):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .appName("auditmart-stage-report")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _lines(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path) as fh:
            yield from fh


def stage_stats(log_dir: str) -> list[dict]:
    """Aggregate task-end events per stage, labelled with the job group
    (``spark.jobGroup.id`` of the job-start event) the stage ran under."""
    stage_label: dict[int, str] = {}
    tasks: dict[int, list[tuple[int, int]]] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True) + glob.glob(
        os.path.join(log_dir, "local-*")
    ):
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                label = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                for sid in ev.get("Stage IDs", []):
                    stage_label[sid] = label
            elif kind == "SparkListenerTaskEnd":
                info, met = ev["Task Info"], ev.get("Task Metrics") or {}
                dur = info["Finish Time"] - info["Launch Time"]
                rec = (met.get("Input Metrics") or {}).get("Records Read", 0) + (
                    met.get("Shuffle Read Metrics") or {}
                ).get("Total Records Read", 0)
                tasks.setdefault(ev["Stage ID"], []).append((dur, rec))
    out = []
    for sid, ts in sorted(tasks.items()):
        durs, recs = [t[0] for t in ts], [t[1] for t in ts]
        out.append(
            {
                "label": stage_label.get(sid, ""),
                "stage": sid,
                "tasks": len(ts),
                "max_ms": max(durs),
                "median_ms": statistics.median(durs),
                "max_rec": max(recs),
                "median_rec": statistics.median(recs),
                "total_rec": sum(recs),
            }
        )
    return out


def run(spark, label: str, make_df) -> None:
    spark.sparkContext.setJobGroup(label, label)
    make_df().write.format("noop").mode("overwrite").save()


def print_table(stats: list[dict]) -> None:
    print(f"{'label':28} {'stage':>5} {'tasks':>5} {'max_ms':>7} {'med_ms':>7} {'max_rec':>9} {'med_rec':>9} {'total_rec':>10}")
    for s in stats:
        print(
            f"{s['label'][:28]:28} {s['stage']:>5} {s['tasks']:>5} {s['max_ms']:>7} {s['median_ms']:>7.0f} "
            f"{s['max_rec']:>9} {s['median_rec']:>9.0f} {s['total_rec']:>10}"
        )


def main(argv: list[str]) -> None:
    hot = "--hot-user" in argv
    args = [a for a in argv[1:] if a != "--hot-user"]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    log_dir = tempfile.mkdtemp(prefix="auditmart-eventlog-")
    spark = session(log_dir)
    from pyspark.sql import functions as F

    from auditmart.queries import QUERIES, audit
    from auditmart.plans import signup_time

    if hot:
        a = audit(spark, sf_dir)
        hot_log = a.withColumn("user_id", F.when(F.col("user_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id")))
        run(spark, "r3-join(hot)", lambda: signup_time.report(hot_log, float("inf")))
        run(spark, "r3-split(hot)", lambda: signup_time.report(hot_log, 10_000, num_partitions=16))
    else:
        for name in args[1:] or ["program_audit_report", "waitlist_report", "signup_time_report", "daily_cancel_report"]:
            run(spark, name, lambda n=name: QUERIES[n](spark, sf_dir))
    spark.stop()
    print(f"event log: {log_dir}")
    print_table(stage_stats(log_dir))


if __name__ == "__main__":
    main(sys.argv)
