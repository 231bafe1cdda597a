"""Summarise the physical plan of every registered query (markdown table).

Counts shuffles, broadcasts, join kinds, aggregates and windows in the
planned (pre-AQE) physical plan, and whether a date/range filter reaches the
Parquet reader. AQE may later turn sort-merge joins into broadcast joins when
a shuffle turns out small, so the counts describe the plan as written for
large inputs. Usage: ``python tools/plan_summary.py [sf_dir]``.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventtrails import registry  # noqa: E402
from eventtrails.session import local_session  # noqa: E402

COUNT = [
    ("shuffles", r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange RoundRobin|\bExchange SinglePartition"),
    ("broadcasts", r"BroadcastExchange"),
    ("SMJ", r"SortMergeJoin"),
    ("BHJ", r"BroadcastHashJoin"),
    ("hash agg", r"HashAggregate"),
    ("sort agg", r"SortAggregate"),
    ("windows", r"\bWindow\b"),
    ("python", r"EvalPython"),
    ("cartesian/NLJ", r"CartesianProduct|NestedLoopJoin"),
]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, extra_conf={"spark.sql.adaptive.enabled": "false"})
    print("| query | " + " | ".join(n for n, _ in COUNT) + " | pushed range |")
    print("|---" * (len(COUNT) + 2) + "|")
    for key, fn in registry.queries().items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        pushed = any(
            ln.startswith("PushedFilters") and re.search(r"(LessThan|GreaterThan)\w*\((ts|time_norm),", ln)
            for ln in buf.getvalue().splitlines()
        )
        counts = [str(len(re.findall(rx, plan))) for _, rx in COUNT]
        print(f"| {key} | " + " | ".join(counts) + f" | {'yes' if pushed else ''} |")
    spark.stop()


if __name__ == "__main__":
    main()
