"""Print the executed (AQE final) plan shape of catalogue queries.

Usage: python tools/show_plans.py [sf_dir] [key ...]
For each key: exchanges, reused exchanges, join strategies, window operators,
pushed filters and read schemas of the scans.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from farebox.plans import catalog  # noqa: E402
from farebox.session import build_session  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or ["model_trip_enriched", "mart_zone_revenue", "report_zone_revenue",
                            "report_demand_timing", "report_tip_behaviour", "agg_daily_zone",
                            "dq_summary"]
    spark = build_session("local[8]", shuffle_partitions=16)
    for key in keys:
        df = catalog.QUERIES[key](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()  # run so AQE's final plan is shown
        text = formatted(df)
        ops = re.findall(r"^\(\d+\) (\w+)", text, re.M)
        count = {op: ops.count(op) for op in sorted(set(ops))}
        print(f"== {key}")
        print("   operators:", {k: v for k, v in count.items()
                                if k in ("Exchange", "ReusedExchange", "BroadcastExchange",
                                         "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
                                         "HashAggregate", "Window", "WindowGroupLimit", "Sort",
                                         "AQEShuffleRead")})
        for line in text.splitlines():
            if line.startswith(("PushedFilters", "ReadSchema")):
                print("  ", line[:220])
    spark.stop()


if __name__ == "__main__":
    main()
