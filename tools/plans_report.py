"""Write PLANS.md: the physical plan tree of every registered query.

usage: python tools/plans_report.py [sf_dir] > PLANS.md

Only the operator tree and the scan lines (ReadSchema, PushedFilters) are
kept; expressions are left out to keep the report readable.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SKIP = ("stream_", "feed_scan", "atom_scan", "queue_files", "curation_")  # these run jobs while being built


def tree(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if re.match(r"^[\s:+\-]*[A-Z][A-Za-z]+(?: [A-Za-z]+)*\s*\(\d+\)\s*$", line):
            out.append(line.rstrip())
        elif line.startswith(("ReadSchema", "PushedFilters")):
            out.append("    " + line.strip())
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from gleaner.plans.driver import QUERIES
    from gleaner.session import build_session

    spark = build_session("local[8]", shuffle_partitions=16)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plans_report.py` at `{sf_dir}` (AQE on; the final plan may "
          "replace sort-merge joins with broadcast joins when measured sizes are small).\n")
    print("An `Exchange` directly above a text scan is the parallelism floor (`spread`): the test "
          "files are single row groups, so the scan is one task and the rows are hash-spread to one "
          "task per core before the CPU-heavy text work. On inputs with many splits it is not "
          "planned. The stream, feed, queue file and curation queries write and re-read data while "
          "they are built, so they are not listed.\n")
    for name, q in QUERIES.items():
        if name.startswith(SKIP):
            continue
        df = q(spark, sf_dir)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        print(f"## {name}\n\n```")
        print("\n".join(tree(plan)))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
