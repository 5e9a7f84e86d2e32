"""Print the executed (AQE final) physical plan of the headline queries,
condensed to scans, filters, exchanges, joins, aggregates and windows.

    python scripts/show_plans.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = re.compile(
    r"(FileScan|Scan ExistingRDD|Exchange|Join|HashAggregate|Window|Expand|Generate|Filter|QueryStage|Reused|AQEShuffleRead)"
)
HEADLINE = ["program_audit_report", "waitlist_report", "signup_time_report", "daily_cancel_report", "staging_full_copy"]


def condensed(plan: str, width: int = 150) -> str:
    final = plan.split("== Initial Plan ==")[0]
    out = []
    for line in final.splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/([^/\]]+)\]", r"\1", line)
        out.append(line[:width])
    return "\n".join(out)


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    names = argv[2:] or HEADLINE
    from auditmart.queries import QUERIES
    from auditmart.session import local_session

    spark = local_session()
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.collect()
        print(f"### {name}\n```\n{condensed(df._jdf.queryExecution().executedPlan().toString())}\n```\n")


if __name__ == "__main__":
    main(sys.argv)
