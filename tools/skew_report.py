"""Hot-key check: run the keyed operators on input where one key holds a
third of all rows, then read Spark's event log for per-task shuffle reads.

    python tools/skew_report.py [--sf /root/testdata/sf0.1]

The skewed input is derived from the driver's tables by a rule: every row
with ``id % 3 = 0`` gets the same ``adid``, ``app_token`` and ``tracker``, and
a copy of it is added under one shared ``id`` (a redelivery storm).  AQE is
off so the raw hash distribution is visible.  For each shuffle stage the
report gives the task count, the largest task's records read, and the
stage total; a partial (map-side) aggregate keeps the largest task small.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--map-tasks", type=int, default=16)
    args = ap.parse_args()

    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from attrlake.operators import dims as D
    from attrlake.operators import facts as A
    from attrlake.operators import quality as Q
    from attrlake.operators import silver as S
    from attrlake.plans import queries as Qy

    log_dir = tempfile.mkdtemp(prefix="run-skew-")
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.adaptive.enabled", "false")
             .config("spark.sql.shuffle.partitions", "64")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    base = Qy.bronze_rows(spark, args.sf).repartition(args.map_tasks)
    hot = F.col("id") % 3 == 0
    skewed = base.select(*[
        F.when(hot, F.lit(v)).otherwise(F.col(c)).alias(c) if c in ("adid", "app_token", "tracker") else F.col(c)
        for c, v in [(c, {"adid": "adid_hot", "app_token": "app_hot", "tracker": "trk_hot"}.get(c)) for c in base.columns]
    ])
    storm = skewed.unionByName(skewed.where(hot).withColumn("id", F.lit(-1)))

    from attrlake.operators.silver import conform

    bronze_storm = storm
    skewed, storm = conform(skewed), conform(storm)
    with_position = storm.withColumn("source_partition", F.pmod(F.abs(F.col("id")), F.lit(4)).cast("int")) \
        .withColumn("source_offset", F.monotonically_increasing_id())
    jobs = {
        "fact_events_daily (count distinct adid)": A.fact_events_daily(skewed),
        "fact_revenue_daily": A.fact_revenue_daily(skewed),
        "dim_app (max_by)": D.dim_app(skewed),
        "silver dedupe (hot id)": S.dedupe_first(storm),
        "first-arrival dedupe (hot id, min_by)": S.dedupe_first(with_position),
        "quality_report": Q.quality_report(storm),
    }
    for label, df in jobs.items():
        spark.sparkContext.setJobGroup(label, label)
        df.write.format("noop").mode("overwrite").save()

    # The streaming silver step on a hot day: a third of the rows moved to one
    # day, plus the redelivery storm; appended twice (the second time the
    # anti-join against stored silver has everything to match).
    from attrlake.store import LakeTable
    from attrlake.streaming.pipeline import append_new_to_silver

    from attrlake.operators.bronze import with_event_date

    hot_day = bronze_storm.withColumn(
        "created_at", F.when(F.col("id") % 3 == 0, F.lit(1704103200000000)).otherwise(F.col("created_at")))
    bronze_like = with_event_date(hot_day.drop("event_date"))
    silver_table = LakeTable(spark, tempfile.mkdtemp(prefix="run-skew-silver-"), ["event_date"])
    for round_ in ("silver append (hot day, storm)", "silver re-append (all held)"):
        spark.sparkContext.setJobGroup(round_, round_)
        append_new_to_silver(bronze_like, silver_table)
    total_rows = skewed.count()
    spark.stop()

    # --- parse the event log ---------------------------------------------------
    (path,) = glob.glob(f"{log_dir}/*")
    files = [path]
    if os.path.isdir(path):  # rolling event log: events_<n>_... files
        files = sorted(glob.glob(f"{path}/events_*"), key=lambda f: int(os.path.basename(f).split("_")[1]))
    stage_group, tasks = {}, {}
    for line in (line for f in files for line in open(f)):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in ev.get("Stage IDs", []):
                stage_group[sid] = group
        elif kind == "SparkListenerTaskEnd":
            m = ev.get("Task Metrics") or {}
            read = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            tasks.setdefault(ev["Stage ID"], []).append(read)
    print(f"input rows {total_rows:,} (one key on {total_rows // 3:,} of them), map tasks {args.map_tasks}")
    print(f"{'operator':42s} {'stage':>5s} {'tasks':>5s} {'max task':>9s} {'median':>7s} {'stage total':>11s}")
    for sid in sorted(tasks):
        group = stage_group.get(sid)
        reads = tasks[sid]
        if not group or sum(reads) == 0:
            continue
        print(f"{group:42s} {sid:5d} {len(reads):5d} {max(reads):9,d} {statistics.median(reads):7.0f} {sum(reads):11,d}")
    print(f"event log: {path}")


if __name__ == "__main__":
    main()
