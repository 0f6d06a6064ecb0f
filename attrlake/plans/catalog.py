"""SQL surface (B1, S4): lake tables as Spark views, plus reporting views.

BI tools and ad-hoc SQL read the same tables the jobs write.  Reporting
views are plain SQL over gold, so Catalyst plans them like any query:
partition filters on ``event_date`` reach the scan, and a dimension is
broadcast only when its measured size allows it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from attrlake.store import LakeTable
from attrlake.streaming.pipeline import STREAM_FACTS
from attrlake.streaming.runner import Lake

# Reporting views over gold (A7, A8, J1, J2), in Spark SQL.
REPORT_VIEWS = {
    "report_star_app": """
select p.*, d.app_name, d.store_id, d.platform
from (select event_date, app_token, cast(sum(revenue) as decimal(38,6)) as revenue,
             cast(sum(events) as bigint) as events
      from fact_revenue_daily group by event_date, app_token) p
left join dim_app d on p.app_token = d.app_token""",
    "report_star_campaign": """
select p.*, d.network_name, d.campaign_name
from (select event_date, tracker, cast(sum(installs) as bigint) as installs,
             cast(sum(organic_installs) as bigint) as organic_installs
      from fact_installs_daily group by event_date, tracker) p
left join dim_campaign d on p.tracker = d.tracker""",
    "report_ecpm": """
select event_date, ad_revenue_network, cast(sum(revenue) as decimal(38,6)) as revenue,
       cast(sum(impressions) as decimal(38,6)) as impressions,
       round(1000 * cast(sum(revenue) as double) / cast(nullif(sum(impressions), 0) as double), 6) as ecpm
from fact_ad_revenue_daily group by event_date, ad_revenue_network""",
    "report_campaign_performance": """
with p as (
  select event_date, tracker, cast(coalesce(sum(installs), 0) as bigint) as installs,
         cast(coalesce(sum(revenue), 0) as decimal(38,6)) as revenue,
         cast(coalesce(sum(cost), 0) as decimal(38,6)) as cost
  from (select event_date, tracker, installs, null as revenue, null as cost from fact_installs_daily
        union all select event_date, tracker, null, revenue, null from fact_revenue_daily
        union all select event_date, tracker, null, null, cost from fact_subscription_daily) u
  group by event_date, tracker)
select p.*, round(cast(revenue as double) / cast(nullif(installs, 0) as double), 6) as revenue_per_install,
       d.network_name, d.campaign_name
from p left join dim_campaign d on p.tracker = d.tracker""",
}


def register_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Create temp views for every table of ``lake`` that exists, then the
    reporting views whose inputs exist.  Returns the registered names.

    Folder tables and reports are views of SQL text, analysed anew by each
    query, so a query sees what was written before it.  Keyed delta tables and
    the quality report are views of a plan: register them again after a write.
    """
    tables = {"bronze_events": lake.bronze, "silver_events": lake.silver,
              "bronze_quarantine": lake.quarantine}
    for dim in ("dim_app", "dim_campaign"):
        tables[dim] = lake.dim(dim)
    for fact in [*STREAM_FACTS, "fact_events_daily"]:
        tables[fact] = lake.fact(fact)
    names = []
    for name, table in tables.items():
        if table.exists():
            if isinstance(table, LakeTable) and table.fmt == "parquet":
                columns = ", ".join(table.columns or ["*"])
                where = f" where {table.rows}" if table.rows else ""
                spark.sql(f"create or replace temporary view {name} as select {columns} from parquet.`{table.location}`{where}")
            else:
                table.read().createOrReplaceTempView(name)
            names.append(name)
    if lake.silver.exists():
        from attrlake.operators.quality import quality_report

        quality_report(spark.table("silver_events")).createOrReplaceTempView("quality_report")
        names.append("quality_report")
    for name, sql in REPORT_VIEWS.items():
        try:
            spark.sql(f"create or replace temporary view {name} as {sql}")
            names.append(name)
        except AnalysisException as error:
            if error.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":  # an input table is not there yet
                raise
    return names
