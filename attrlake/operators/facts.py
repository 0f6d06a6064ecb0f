"""Gold daily facts over silver rows.

Grain: ``event_date`` plus the two foreign keys of the star (``app_token``,
``tracker``) plus family attributes.  Every fact is one ``groupBy().agg()``:
a partial aggregate before the shuffle, so a hot app or tracker costs one
row per map task, not one row per event.  Money stays DECIMAL; sums are
widened to DECIMAL(38,6) so a long history never overflows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAR_KEYS = ["event_date", "app_token", "tracker"]
SUM_TYPE = "decimal(38,6)"


def money_sum(col: Column) -> Column:
    return F.sum(col).cast(SUM_TYPE)


def count_rows() -> Column:
    return F.count(F.lit(1)).cast("bigint")


def count_where(cond: Column) -> Column:
    return F.count_if(cond).cast("bigint")


def _family(silver: DataFrame, kind: str | list[str]) -> DataFrame:
    kinds = [kind] if isinstance(kind, str) else kind
    return silver.where(F.col("activity_kind").isin(*kinds))


# Measures of each fact, as (name, aggregate) -- shared by the batch form,
# the streaming form and the keyed re-aggregation of an upsert.
INSTALL_KEYS = STAR_KEYS


def installs_measures() -> list[Column]:
    return [
        count_rows().alias("installs"),
        count_where(F.col("is_organic")).alias("organic_installs"),
        count_where(F.col("impression_based")).alias("impression_based_installs"),
        count_where(F.col("click_time").isNotNull()).alias("clicked_installs"),
    ]


def fact_installs_daily(silver: DataFrame) -> DataFrame:
    """A1: installs per day, app and tracker."""
    return _family(silver, "install").groupBy(*INSTALL_KEYS).agg(*installs_measures())


REVENUE_KEYS = STAR_KEYS + ["reporting_currency"]


def revenue_measures() -> list[Column]:
    kind = F.col("activity_kind")
    rev = F.col("reporting_revenue")
    return [
        money_sum(rev).alias("revenue"),
        money_sum(F.when(kind == "ad_revenue", rev)).alias("ad_revenue"),
        money_sum(F.when(kind == "subscription", rev)).alias("subscription_revenue"),
        count_rows().alias("events"),
    ]


def fact_revenue_daily(silver: DataFrame) -> DataFrame:
    """A2: revenue per day, app, tracker and currency.

    Uses ``reporting_revenue``: ``revenue_float`` is NULL on subscriptions.
    """
    return _family(silver, ["ad_revenue", "subscription"]).groupBy(*REVENUE_KEYS).agg(*revenue_measures())


AD_REVENUE_KEYS = STAR_KEYS + [
    "ad_revenue_network", "ad_revenue_placement", "ad_revenue_unit", "ad_mediation_platform",
]


def ad_revenue_measures() -> list[Column]:
    return [
        money_sum(F.col("reporting_revenue")).alias("revenue"),
        money_sum(F.col("ad_impressions_count")).alias("impressions"),
        count_rows().alias("events"),
    ]


def fact_ad_revenue_daily(silver: DataFrame) -> DataFrame:
    """A3: ad revenue and impressions per day, app, tracker and ad placement."""
    return _family(silver, "ad_revenue").groupBy(*AD_REVENUE_KEYS).agg(*ad_revenue_measures())


SUBSCRIPTION_KEYS = STAR_KEYS + [
    "subscription_event_type", "subscription_product_id", "subscription_sales_region",
]


def subscription_measures() -> list[Column]:
    return [
        count_rows().alias("events"),
        money_sum(F.col("reporting_revenue")).alias("revenue"),
        money_sum(F.col("reporting_cost")).alias("cost"),
    ]


def fact_subscription_daily(silver: DataFrame) -> DataFrame:
    """A4: subscription events, revenue and cost per day, app, tracker, product."""
    return _family(silver, "subscription").groupBy(*SUBSCRIPTION_KEYS).agg(*subscription_measures())


EVENTS_KEYS = STAR_KEYS + ["activity_kind", "event_name"]


def events_measures() -> list[Column]:
    return [count_rows().alias("events"), F.countDistinct("adid").cast("bigint").alias("devices")]


def fact_events_daily(silver: DataFrame) -> DataFrame:
    """A5: events and distinct devices per day, app, tracker, kind and name.

    Exact distinct: Catalyst expands it into an aggregate on
    (keys, adid) first, which spreads a hot key over all adids.
    """
    return silver.groupBy(*EVENTS_KEYS).agg(*events_measures())


#: Size of a device sketch (log2 of its registers): 16,384 give a standard
#: error of about 0.8 %; a sketch of few devices is exact and small.
SKETCH_LG = 14


def device_sketch_measures() -> list[Column]:
    return [count_rows().alias("events"), F.hll_sketch_agg("adid", SKETCH_LG).alias("devices_sketch")]


def fact_device_sketches_daily(silver: DataFrame) -> DataFrame:
    """A5, mergeable: events and a HyperLogLog sketch of the devices, by the
    keys of ``fact_events_daily``.  Sketches merge over any days and keys, and
    the aggregate is legal in a stream, which exact distinct is not."""
    return silver.groupBy(*EVENTS_KEYS).agg(*device_sketch_measures())


FACTS = {
    "fact_installs_daily": (fact_installs_daily, INSTALL_KEYS),
    "fact_revenue_daily": (fact_revenue_daily, REVENUE_KEYS),
    "fact_ad_revenue_daily": (fact_ad_revenue_daily, AD_REVENUE_KEYS),
    "fact_subscription_daily": (fact_subscription_daily, SUBSCRIPTION_KEYS),
    "fact_events_daily": (fact_events_daily, EVENTS_KEYS),
}

# -- below the day: a fact from its parts by device bucket ----------------------------

#: The rows (None: all), keys and measures of each fact.
MEASURED = {
    "fact_installs_daily": ("install", INSTALL_KEYS, installs_measures),
    "fact_revenue_daily": (["ad_revenue", "subscription"], REVENUE_KEYS, revenue_measures),
    "fact_ad_revenue_daily": ("ad_revenue", AD_REVENUE_KEYS, ad_revenue_measures),
    "fact_subscription_daily": ("subscription", SUBSCRIPTION_KEYS, subscription_measures),
    "fact_events_daily": (None, EVENTS_KEYS, events_measures),
}


def device_bucket(buckets: int) -> Column:
    """The bucket of a silver row.  All rows of a device share it; rows without
    a device, which no distinct count sees, spread by their id."""
    return F.pmod(F.xxhash64(F.coalesce(F.col("adid"), F.col("id").cast("string"))), F.lit(buckets)).cast("int")


def fact_parts(silver: DataFrame, name: str) -> DataFrame:
    """A fact within each ``bucket`` of its days."""
    family, keys, measures = MEASURED[name]
    rows = silver if family is None else _family(silver, family)
    return rows.groupBy(*keys, "bucket").agg(*measures())


def fold_parts(parts: DataFrame, name: str) -> DataFrame:
    """The fact from its parts: every measure adds up over the buckets,
    distinct devices too, since a device lies in one bucket of a day."""
    _family, keys, _measures = MEASURED[name]
    types = {c.name: c.dataType for c in parts.schema.fields if c.name not in (*keys, "bucket")}
    return parts.groupBy(*keys).agg(*[F.sum(c).cast(t).alias(c) for c, t in types.items()])
