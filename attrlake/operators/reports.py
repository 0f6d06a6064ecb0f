"""Reports over gold: star joins, campaign performance, eCPM, newest rows.

Reports read the daily facts (already aggregated, so a hot app or tracker
is one row per day) and join the dimensions on their key.  No broadcast
hint: dimensions grow with installs, so AQE picks a broadcast only after it
has measured the real size of the dimension side, and keeps the
sort-merge join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrlake.operators.facts import SUM_TYPE
from attrlake.store import LakeTable


def star_join(fact: DataFrame, dim: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Fact -> dimension, left outer (a fact may arrive before its dim row)."""
    return fact.join(dim.select(key, *attributes), on=key, how="left")


def report_star_app(revenue_fact: DataFrame, dim_app: DataFrame) -> DataFrame:
    """Revenue per day and app, with the app's current attributes."""
    per_app = revenue_fact.groupBy("event_date", "app_token").agg(
        F.sum("revenue").cast(SUM_TYPE).alias("revenue"),
        F.sum("events").cast("bigint").alias("events"),
    )
    return star_join(per_app, dim_app, "app_token", ["app_name", "store_id", "platform"])


def report_star_campaign(installs_fact: DataFrame, dim_campaign: DataFrame) -> DataFrame:
    """Installs per day and tracker, with network and campaign names."""
    per_tracker = installs_fact.groupBy("event_date", "tracker").agg(
        F.sum("installs").cast("bigint").alias("installs"),
        F.sum("organic_installs").cast("bigint").alias("organic_installs"),
    )
    return star_join(per_tracker, dim_campaign, "tracker", ["network_name", "campaign_name"])


def report_campaign_performance(
    installs_fact: DataFrame,
    revenue_fact: DataFrame,
    subscription_fact: DataFrame,
    dim_campaign: DataFrame,
) -> DataFrame:
    """Installs, revenue, cost and revenue per install per day and tracker.

    The three facts are aligned by ``unionByName`` + one ``groupBy`` (no
    join fan-out between facts), then joined once to the campaign dim.
    ``revenue_per_install`` is NULL on a day without installs.
    """
    keys = ["event_date", "tracker"]
    i = installs_fact.select(*keys, F.col("installs").cast("bigint").alias("installs"))
    r = revenue_fact.select(*keys, F.col("revenue").cast(SUM_TYPE).alias("revenue"))
    c = subscription_fact.select(*keys, F.col("cost").cast(SUM_TYPE).alias("cost"))
    aligned = i.unionByName(r, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)
    perf = aligned.groupBy(*keys).agg(
        F.coalesce(F.sum("installs"), F.lit(0)).cast("bigint").alias("installs"),
        F.coalesce(F.sum("revenue"), F.lit(0)).cast(SUM_TYPE).alias("revenue"),
        F.coalesce(F.sum("cost"), F.lit(0)).cast(SUM_TYPE).alias("cost"),
    )
    perf = perf.withColumn(
        "revenue_per_install",
        F.round(F.col("revenue").cast("double") / F.nullif(F.col("installs"), F.lit(0)).cast("double"), 6),
    )
    return star_join(perf, dim_campaign, "tracker", ["network_name", "campaign_name"])


def report_ecpm(ad_revenue_fact: DataFrame) -> DataFrame:
    """eCPM = 1000 * revenue / impressions per day and ad network,
    computed from additive sums at query time (never stored)."""
    per_net = ad_revenue_fact.groupBy("event_date", "ad_revenue_network").agg(
        F.sum("revenue").cast(SUM_TYPE).alias("revenue"),
        F.sum("impressions").cast(SUM_TYPE).alias("impressions"),
    )
    return per_net.withColumn(
        "ecpm",
        F.round(
            F.lit(1000.0) * F.col("revenue").cast("double")
            / F.nullif(F.col("impressions"), F.lit(0)).cast("double"),
            6,
        ),
    )


def latest_events(table: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` newest rows by ``created_at`` (ties: highest id) --
    a top-k, planned as ``TakeOrderedAndProject`` (no full sort)."""
    return table.orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(n)


def latest_of_table(table: LakeTable, n: int = 20) -> DataFrame:
    """T1 over a table partitioned by ``event_date``: the same rows, read from
    the newest days only.  Days are event-time days, so once the days taken
    hold ``n`` rows no older day can have a newer one.  One listing, then 1,
    2, 4, ... day folders; rows without a day come last."""
    days = sorted(table.days(), key=lambda d: (d is not None, d), reverse=True)
    take = 1
    while True:
        found = latest_events(table.touched(None, [(d,) for d in days[:take]]) if days else table.read(), n)
        if take >= len(days) or found.count() >= n:
            return found
        take *= 2


def report_devices_approx(sketches: DataFrame, by: list[str]) -> DataFrame:
    """A5 over any days and keys, from the sketch fact alone: events and the
    estimated number of different devices."""
    return sketches.groupBy(*by).agg(
        F.sum("events").cast("bigint").alias("events"),
        F.hll_sketch_estimate(F.hll_union_agg("devices_sketch")).alias("devices_approx"),
    )


def table_row_count_from_footers(table: LakeTable) -> DataFrame:
    """A6 from Parquet footers: the count is pushed into the V2 source, which
    reads no data pages.  The setting is that of a session of its own."""
    session = table.spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(table.location).agg(F.count(F.lit(1)).alias("rows"))


def table_row_count(table: DataFrame) -> DataFrame:
    """Row count of a table as a one-row frame."""
    return table.agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
