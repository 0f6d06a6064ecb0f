"""Batch jobs: backfill of chosen days, dimension rebuild, gold compaction."""

from pyspark.sql import functions as F

from attrlake.batch import compact_gold, rebuild_dimensions, rebuild_facts
from attrlake.operators import dims as D
from attrlake.operators import facts as A
from attrlake.plans import queries as Qy
from attrlake.session import run_dir
from attrlake.streaming.runner import Lake

from conftest import SF_SMALL


def _same(a, b, cols):
    return a.select(*cols).exceptAll(b.select(*cols)).count() == 0 and a.count() == b.count()


def test_backfill_days_then_compact(spark):
    lake = Lake(spark, run_dir(spark, "t-batch"))
    silver = Qy.silver_rows(spark, SF_SMALL)
    lake.silver.append(silver)
    rebuild_facts(lake, days=["2024-01-05", "2024-01-06"])
    fact = lake.fact("fact_revenue_daily").read()
    assert {str(r.event_date) for r in fact.select("event_date").distinct().collect()} == {"2024-01-05", "2024-01-06"}
    rebuild_facts(lake)  # all days; the two backfilled ones are replaced, not doubled
    cols = A.REVENUE_KEYS + ["revenue", "events"]
    assert _same(lake.fact("fact_revenue_daily").read(), A.fact_revenue_daily(silver), cols)

    # many small files in one day, then compaction
    table = lake.fact("fact_revenue_daily")
    day = table.read().where(F.col("event_date") == F.lit("2024-01-05").cast("date"))
    for _ in range(3):
        table.upsert(day.persist(), A.REVENUE_KEYS)
    before = [f for f in table.read().inputFiles() if "event_date=2024-01-05" in f]
    compact_gold(lake, "fact_revenue_daily", ["2024-01-05"])
    after = [f for f in table.read().inputFiles() if "event_date=2024-01-05" in f]
    assert len(after) <= len(before)
    compact_gold(lake, "fact_revenue_daily", [])  # no days, nothing done
    assert sorted(table.read().inputFiles()) == sorted(lake.fact("fact_revenue_daily").read().inputFiles())
    assert _same(table.read(), A.fact_revenue_daily(silver), cols)


def test_dimension_rebuild_equals_batch_dimension(spark):
    lake = Lake(spark, run_dir(spark, "t-dims"))
    silver = Qy.silver_rows(spark, SF_SMALL)
    lake.silver.append(silver)
    rebuild_dimensions(lake)
    cols = ["app_token", "app_name", "platform", "first_seen", "last_seen", "last_id"]
    assert _same(lake.dim("dim_app").read(), D.dim_app(silver), cols)
