"""Print the formatted physical plan of each mart (the rows a load writes), with a summary line.

Usage: python tools/explain_marts.py [sf_dir] [broadcast_max_bytes] [mart ...]

``broadcast_max_bytes`` (default 65536) sets ``martsmith.broadcastMaxBytes`` and
disables automatic broadcasts, so only tiny dimensions are broadcast - the
shape the plans take when every other table is large.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv: list[str]) -> None:
    from martsmith.plans import MARTS, mart_rows
    from martsmith.session import build_session
    from martsmith.sources import standin_registry

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    bound = argv[2] if len(argv) > 2 else "65536"
    names = argv[3:] or list(MARTS)
    spark = build_session("local[8]", shuffle_partitions=8, extra_conf={
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "martsmith.broadcastMaxBytes": bound,
    })
    for name in names:
        df = mart_rows(standin_registry(spark, sf_dir), name)
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges = sum(1 for line in plan.splitlines()
                        if "Exchange hashpartitioning" in line and "ReusedExchange" not in line)
        print(f"===== {name}: {exchanges} hash exchanges, {plan.count('ReusedExchange')} reused, "
              f"{plan.count('SortMergeJoin')} sort-merge joins, {plan.count('BroadcastHashJoin')} broadcast joins")
        df.explain("formatted")


if __name__ == "__main__":
    main(sys.argv)
