"""Gold dimensions: latest attributes per key.

``max_by(attributes, (created_at, id))`` is an ordinary aggregate, so it is
computed partially before the shuffle and merges associatively: the same
function builds a dimension from scratch, folds a micro-batch into it, and
is idempotent when a batch is replayed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

APP_ATTRIBUTES = ["store_id", "app_name", "platform", "app_version", "sdk_version"]
CAMPAIGN_ATTRIBUTES = ["tracker_name", "network_name", "campaign_name", "adgroup_name", "creative_name"]

DIMENSIONS = {
    "dim_app": ("app_token", APP_ATTRIBUTES),
    "dim_campaign": ("tracker", CAMPAIGN_ATTRIBUTES),
}


def latest_attributes(silver: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """One row per ``key``: attributes of its newest row (ties: highest id),
    with ``first_seen``/``last_seen`` (event time) and ``last_id``."""
    order = F.struct(F.col("created_at"), F.col("id"))
    return (
        silver.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.max_by(F.struct(*[F.col(a) for a in attributes]), order).alias("_a"),
            F.min("created_at").alias("first_seen"),
            F.max(order).alias("_o"),
        )
        .select(
            key,
            *[F.col(f"_a.{a}").alias(a) for a in attributes],
            "first_seen",
            F.col("_o.created_at").alias("last_seen"),
            F.col("_o.id").alias("last_id"),
        )
    )


def merge_dimension(current: DataFrame, update: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Fold dimension rows ``update`` into ``current`` (same schema): newest
    ``(last_seen, last_id)`` wins per key, ``first_seen`` is the earliest.

    Out-of-order batches cannot roll a key back, and folding the same batch
    twice changes nothing."""
    return fold_dimension(current.select(update.columns).unionByName(update), key, attributes)


def fold_dimension(rows: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Dimension rows, any number per key, to one row per key (see
    ``merge_dimension``)."""
    order = F.struct(F.col("last_seen"), F.col("last_id"))
    return (
        rows.groupBy(key)
        .agg(
            F.max_by(F.struct(*[F.col(a) for a in attributes]), order).alias("_a"),
            F.min("first_seen").alias("first_seen"),
            F.max(order).alias("_o"),
        )
        .select(
            key,
            *[F.col(f"_a.{a}").alias(a) for a in attributes],
            "first_seen",
            F.col("_o.last_seen").alias("last_seen"),
            F.col("_o.last_id").alias("last_id"),
        )
    )


def dim_app(silver: DataFrame) -> DataFrame:
    """K3 source: app dimension keyed by ``app_token``."""
    return latest_attributes(silver, "app_token", APP_ATTRIBUTES)


def dim_campaign(silver: DataFrame) -> DataFrame:
    """K4 source: campaign dimension keyed by ``tracker``."""
    return latest_attributes(silver, "tracker", CAMPAIGN_ATTRIBUTES)
