"""Write PLANS.md: the executed physical plan of every registered batch query,
reduced to its operators, plus what reached each Parquet scan.

    python tools/plans_report.py [--sf /root/testdata/sf0.01]

Plans are taken after execution (AQE final plans), so join choices are the
ones made with measured sizes.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = ("Exchange", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "BroadcastHashJoin",
        "SortMergeJoin", "ShuffledHashJoin", "BroadcastExchange", "TakeOrderedAndProject", "Generate",
        "Union", "Window", "Expand", "FileScan", "Scan ", "AQEShuffleRead", "Filter")


def summarize(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        body = re.sub(r"^\*\(\d+\) ", "", line.lstrip(" :+-"))  # drop the codegen-stage marker
        if not body.startswith(KEEP):
            continue
        depth = (len(line) - len(line.lstrip(" :+-"))) // 3
        body = re.sub(r"#\d+L?", "", body)
        if body.startswith(("FileScan", "Scan ")):
            cols = re.search(r"\[([^\]]*)\]", body)
            pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", body)
            parts = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", body)
            body = (f"Scan parquet cols=[{cols.group(1) if cols else ''}]"
                    + (f" PushedFilters=[{pushed.group(1)[:120]}]" if pushed and pushed.group(1) else "")
                    + (f" PartitionFilters=[{parts.group(1)[:120]}]" if parts and parts.group(1) else ""))
        elif body.startswith("Exchange"):
            body = body.split(", [plan_id")[0][:140]
        elif body.startswith(("HashAggregate", "SortAggregate", "ObjectHashAggregate")):
            name = body.split("(")[0]
            keys = re.search(r"keys=\[([^\]]*)\]", body) or re.search(r"key=\[([^\]]*)\]", body)
            fns = re.search(r"functions=\[(.*?)\], output", body)
            fn_names = sorted(set(re.findall(r"(partial_\w+|merge_\w+|\w+)\(", fns.group(1)))) if fns else []
            body = f"{name} keys=[{keys.group(1) if keys else ''}] fns={fn_names[:6]}"
        elif body.startswith("Filter"):
            body = body[:120]
        else:
            body = body[:140]
        out.append("  " * depth + body)
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"))
    args = ap.parse_args()

    from attrlake.plans.queries import queries
    from attrlake.session import local_session

    spark = local_session()
    lines = ["# PLANS", "",
             f"Executed physical plans (AQE final) of the registered batch queries at `{args.sf}`, reduced to",
             "exchanges, aggregates, joins, top-k and scans. Generated by `tools/plans_report.py`.", "",
             "The registered queries derive the attribution columns from the driver's `events` on the fly, so",
             "their scans read `events` columns; on stored silver the same operators push `activity_kind` and",
             "prune `event_date` partitions (see `tests/test_plans.py`).", ""]
    for name, fn in queries().items():
        df = fn(spark, args.sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
        final = re.sub(r"AdaptiveSparkPlan isFinalPlan=true", "", plan)
        summary = summarize(final)
        exchanges = sum(1 for s in summary if s.strip().startswith("Exchange"))
        lines += [f"## {name}", "", f"shuffles: {exchanges}", "", "```", *summary, "```", ""]
    # The same operators over a stored, day-partitioned silver table: what a
    # production job reads.  Pushdown and pruning show here.
    from pyspark.sql import functions as F

    from attrlake.batch import rebuild_dimensions, rebuild_facts
    from attrlake.operators import facts as A
    from attrlake.operators import reports as R
    from attrlake.plans.queries import silver_rows
    from attrlake.session import run_dir
    from attrlake.streaming.runner import Lake

    lake = Lake(spark, run_dir(spark, "plans"))
    lake.silver.append(silver_rows(spark, args.sf))
    rebuild_facts(lake)
    rebuild_dimensions(lake)
    days = F.col("event_date").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-11").cast("date"))
    stored = {
        "fact_revenue_daily over stored silver, one week": A.fact_revenue_daily(lake.silver.read().where(days)),
        "fact_events_daily over stored silver, one week": A.fact_events_daily(lake.silver.read().where(days)),
        "report_campaign_performance over stored gold, one week": R.report_campaign_performance(
            lake.fact("fact_installs_daily").read().where(days), lake.fact("fact_revenue_daily").read().where(days),
            lake.fact("fact_subscription_daily").read().where(days), lake.dim("dim_campaign").read()),
    }
    lines += ["# On stored tables", "",
              "Silver written partitioned by `event_date`, gold rebuilt from it, then read for one week.", ""]
    for name, df in stored.items():
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
        summary = summarize(plan)
        exchanges = sum(1 for s in summary if s.strip().startswith("Exchange"))
        lines += [f"## {name}", "", f"shuffles: {exchanges}", "", "```", *summary, "```", ""]
    spark.stop()
    with open(args.out, "w") as fh:
        fh.write("\n".join(lines))
    print(f"wrote {args.out}")


if __name__ == "__main__":
    main()
