"""Inputs derived from the driver's tables.

The pipeline's real source is a change topic of an OLTP event table.  For
tests and the bench, the driver's ``events`` table is mapped onto the
attribution event (``attribution_events``), onto a change log
(``change_log``) and onto framed Kafka-shaped messages
(``kafka_messages``).  All of it is lazy DataFrame code: the inputs grow with
the tables and are partitioned by Spark like any other scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrlake.functions import framing
from attrlake.functions.time import ntz_to_micros
from attrlake.schemas import COLUMN_NAMES, MONEY

HOUR_US = 3_600_000_000
DAY_US = 86_400_000_000
# Fixed value: subscription length of the generator, in micros.
SUBSCRIPTION_US = 30 * DAY_US


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Rows of ``events`` that one task of a slice takes (and one topic file holds).
ROWS_PER_PIECE = 50_000


def pieces(spark: SparkSession, sf_dir: str, slices: int) -> int:
    """Tasks per slice of ``events`` (one for small tables), from the row count in the footers."""
    return max(1, -(-read_table(spark, sf_dir, "events").count() // (slices * ROWS_PER_PIECE)))


def _events(spark: SparkSession, sf_dir: str, spread: int) -> DataFrame:
    """``events``, in ``spread`` (> 1) ranges of ids.

    A slice reads few row groups, so few tasks would encode it; the narrow
    source rows are dealt instead, and a filter on the id (a slice's bounds)
    goes below the exchange.
    """
    ev = read_table(spark, sf_dir, "events")
    return ev.repartitionByRange(spread, "event_id") if spread > 1 else ev


def _when(kind: Column, value: Column) -> Column:
    return F.when(kind, value)


def attribution_events(spark: SparkSession, sf_dir: str, spread: int = 1) -> DataFrame:
    """Driver ``events`` -> 55-column attribution event (bronze wire types).

    Timestamps are epoch micros (BIGINT), money is DECIMAL(18,6); columns the
    mapping does not fill stay NULL.  ``event_date`` is not added here: that
    is the bronze operator's job.  ``spread``: see ``_events``.
    """
    ev = _events(spark, sf_dir, spread)
    user = F.col("user_id")
    base = ev.select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_type") == "signup", "install")
        .when(F.col("event_type") == "view", "ad_revenue")
        .when(F.col("event_type") == "purchase", "subscription")
        .otherwise(F.col("event_type")).alias("activity_kind"),
        ntz_to_micros(F.col("ts")).alias("created_at"),
        F.col("value").alias("raw_value"),
        F.regexp_extract("props", "[0-9]+", 0).cast("bigint").alias("k"),
        F.concat(F.lit("adid_"), user).alias("adid"),
        F.concat(F.lit("app_"), user % 3).alias("app_token"),
        F.concat(F.lit("store_"), user % 3).alias("store_id"),
        F.concat(F.lit("App "), user % 3).alias("app_name"),
        F.when(user % 2 == 0, "ios").otherwise("android").alias("platform"),
        F.concat(F.lit("trk_"), user % 20).alias("tracker"),
        F.concat(F.lit("net_"), user % 5).alias("network_name"),
        F.concat(F.lit("campaign_"), user % 4).alias("campaign_name"),
        F.concat(F.lit("adgroup_"), user % 3).alias("adgroup_name"),
    )
    kind = F.col("activity_kind")
    k = F.col("k")
    ts = F.col("created_at")
    raw = F.col("raw_value")
    install = kind == "install"
    ad = kind == "ad_revenue"
    sub = kind == "subscription"
    ad_revenue = (raw / 5000).cast(MONEY)
    derived = {
        "gps_adid": F.col("adid"),
        "os_name": F.col("platform"),
        "tracker_name": F.col("tracker"),
        "installed_at": _when(install, ts),
        "click_time": _when(install & (k % 10 < 7), ts - k * HOUR_US),
        "impression_based": _when(install, k % 10 == 1),
        "is_organic": _when(install, k % 5 == 0),
        "revenue_float": _when(ad, ad_revenue),
        "reporting_revenue": _when(ad, ad_revenue).when(sub, raw.cast(MONEY)),
        "reporting_currency": _when(ad | sub, F.lit("USD")),
        "ad_impressions_count": _when(ad, k.cast(MONEY)),
        "ad_revenue_network": _when(ad, F.concat(F.lit("adnet_"), k % 4)),
        "ad_revenue_placement": _when(ad, F.concat(F.lit("place_"), k % 3)),
        "reporting_cost": _when(sub, (raw * 0.2).cast(MONEY)),
        "subscription_event_type": _when(
            sub,
            F.when(k % 4 == 0, "started").when(k % 4 == 1, "renewed")
            .when(k % 4 == 2, "cancelled").otherwise("expired"),
        ),
        "subscription_product_id": _when(sub, F.concat(F.lit("sub_"), k % 3)),
        "subscription_purchased_at": _when(sub, ts - k * DAY_US),
        "subscription_expiration_time": _when(sub, ts - k * DAY_US + SUBSCRIPTION_US),
        "subscription_cancelled_at": _when(sub & (k % 4 == 2), ts),
    }
    types = {f.name: f.dataType for f in _bronze_fields()}
    cols = []
    for name in COLUMN_NAMES:
        if name in base.columns:
            expr = F.col(name)
        elif name in derived:
            expr = derived[name]
        else:
            expr = F.lit(None)
        cols.append(expr.cast(types[name]).alias(name))
    return base.select(*cols)


def _bronze_fields():
    from attrlake.schemas import bronze_schema

    return bronze_schema().fields


def change_log(spark: SparkSession, sf_dir: str, updates_and_deletes: bool = True, spread: int = 1) -> DataFrame:
    """Change log of the driver ``events`` table.

    Inserts of every row, an update of every 10th, a delete of every 50th and
    a redelivery of every 7th insert; ``lsn`` orders the changes of one id.
    With ``updates_and_deletes=False`` only inserts and redeliveries remain,
    so every copy of an id is identical.
    """
    ev = _events(spark, sf_dir, spread).select(
        F.col("event_id").alias("id"), "ts", "user_id", "event_type", "value"
    )
    lsn = F.col("id") * 4
    inserts = ev.select(F.lit("c").alias("op"), "*", lsn.alias("lsn"))
    redeliveries = ev.where(F.col("id") % 7 == 0).select(F.lit("c").alias("op"), "*", lsn.alias("lsn"))
    parts = [inserts]
    if updates_and_deletes:
        changed = ev.withColumn("value", F.col("value") + 1)
        parts.append(changed.where(F.col("id") % 10 == 0).select(F.lit("u").alias("op"), "*", (lsn + 1).alias("lsn")))
        parts.append(changed.where(F.col("id") % 50 == 0).select(F.lit("d").alias("op"), "*", (lsn + 2).alias("lsn")))
    parts.append(redeliveries)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Silver rows with faults --------------------------------------------------------

#: Columns of ``faulty_silver`` by SQL expressions over the silver row, so that
#: every quality rule holds for some rows and fails for others.
FAULTS = {
    "os_version": "case when id % 4 = 0 then null when (platform = 'ios') = (id % 3 > 0) then '17.1' else '14' end",
    "device_model": "case when id % 5 = 0 then null when (platform = 'ios') = (id % 3 > 0) then 'iPad13,1' else 'Pixel 8' end",
    "os_name": "case when id % 17 = 3 then 'windows' else os_name end",
    "platform": "case when id % 23 = 5 then 'web' else platform end",
    "store_id": "concat('com.example.example', cast(1 + id % 4 as string))",
    "app_name": "case when id % 28 = 0 then 'Wrong' when id % 4 = 0 then 'Example One' when id % 4 = 1 then 'Example Two' "
                "when id % 4 = 2 then 'Example Three' else 'Example Four' end",
    "app_version": "case when id % 3 = 0 then '9.9.9' else '1.1.0' end",
    "network_name": "case when id % 3 = 0 then 'Facebook' else network_name end",
    "campaign_name": "case when id % 3 = 1 then 'campaign_a' else campaign_name end",
    "adgroup_name": "case when id % 3 = 2 then 'adgroup_a' else adgroup_name end",
    "creative_name": "case when id % 3 = 2 then 'creative_z' else 'creative_a' end",
    "country": "case when id % 7 = 0 then 'XX' else 'VN' end",
    "currency": "case when id % 7 = 1 then 'EUR' else 'USD' end",
    "language": "case when id % 43 = 0 then 'a-very-long-language' else 'en' end",
    "reporting_currency": "case when reporting_currency is not null and id % 13 = 0 then 'EUR' else reporting_currency end",
    "ad_revenue_network": "case when ad_revenue_network is not null and id % 3 = 0 then 'AdMob' else ad_revenue_network end",
    "ad_revenue_placement": "case when ad_revenue_placement is not null and id % 3 = 0 then 'banner' else ad_revenue_placement end",
    "ad_revenue_unit": "case when activity_kind = 'ad_revenue' and id % 3 = 0 then 'unit_z' when activity_kind = 'ad_revenue' then 'unit_a' end",
    "subscription_event_type": "case when subscription_event_type is not null and id % 19 = 0 then 'paused' else subscription_event_type end",
    "subscription_product_id": "case when subscription_product_id is not null and id % 3 = 0 then 'sub_monthly' else subscription_product_id end",
    "subscription_sales_region": "case when activity_kind = 'subscription' and id % 3 = 0 then 'ZZ' when activity_kind = 'subscription' then 'US' end",
    "subscription_transaction_id": "case when activity_kind = 'subscription' then concat(case when id % 5 = 0 then 'bad_' else 'txn_' end, cast(id as string)) end",
    "subscription_original_transaction_id":
        "case when activity_kind = 'subscription' then concat(case when id % 6 = 0 then 'bad_' else 'otxn_' end, cast(id as string)) end",
    "adid": "case when id % 2 = 0 then concat('solo_', cast(id as string)) else adid end",
    "gps_adid": "case when id % 29 = 0 then 'other' when id % 2 = 0 then concat('solo_', cast(id as string)) else gps_adid end",
    "tracker_name": "case when id % 31 = 0 then 'other' else tracker_name end",
    "installed_at": "case when id % 37 = 0 then null else installed_at end",
    "click_time": "case when id % 11 = 0 then click_time - interval 30 day else click_time end",
    "impression_time": "case when activity_kind = 'install' and id % 3 = 0 then created_at + interval 1 day "
                       "when activity_kind = 'install' then created_at - interval 1 day end",
    "idfa": "case when id % 3 = 0 then 'idfa' end",
    "revenue_float": "case when id % 41 = 0 then cast(revenue_float + 1 as decimal(18,6)) else revenue_float end",
    "subscription_expiration_time": "case when id % 7 = 0 then subscription_expiration_time + interval 1 day else subscription_expiration_time end",
    "subscription_cancelled_at": "case when id % 9 = 0 then null else subscription_cancelled_at end",
    "reporting_cost": "case when id % 6 = 0 then cast(reporting_cost * 10 as decimal(18,6)) else reporting_cost end",
}
#: Ids that lie in ``faulty_silver`` twice.
FAULTY_TWICE = "id % 97 = 0"


def faulty_silver(silver: DataFrame) -> DataFrame:
    rows = silver.selectExpr(*[f"{FAULTS[c]} as {c}" if c in FAULTS else c for c in silver.columns])
    return rows.unionByName(rows.where(FAULTY_TWICE))


# Kafka-shaped fixture ---------------------------------------------------------

TOPIC = "attribution.events"
TOPIC_PARTITIONS = 4
SCHEMA_ID = 1
# The producer registered schema version 2 on this day (micros of
# 2024-01-16 00:00); messages from then on carry the new id.
SCHEMA_V2_FROM_US = 1_705_363_200_000_000


def schema_id_of(created_at: Column) -> Column:
    return F.when(created_at >= SCHEMA_V2_FROM_US, SCHEMA_ID + 1).otherwise(SCHEMA_ID)


def kafka_messages(
    spark: SparkSession,
    sf_dir: str,
    redeliver_every: int = 0,
    corrupt: bool = False,
    differing: bool = False,
    spread: int = 1,
) -> DataFrame:
    """Framed Kafka-shaped rows ``key, value, topic, partition, offset, timestamp``.

    ``value`` = magic byte 0 + 4-byte schema id + JSON payload of the event.
    ``redeliver_every=n`` adds a second, identical copy of every n-th id
    (at-least-once delivery); with ``differing`` the second copy carries
    other values.  ``corrupt=True`` damages a rule-chosen share
    of the messages the ways a real topic can (see ``framing.damage``).
    """
    events = attribution_events(spark, sf_dir, spread)

    def framed(rows: DataFrame, copy: int) -> DataFrame:
        return rows.select("id", "created_at", framing.encode_json_frame(
            F.struct(*[F.col(c) for c in COLUMN_NAMES]), schema_id_of(F.col("created_at"))).alias("value"), F.lit(copy).alias("copy"))

    msgs = framed(events, 0)
    if redeliver_every:
        again = events.where(F.col("id") % redeliver_every == 0)
        if differing:
            again = again.withColumns({"adgroup_name": F.lit("second copy"), "reporting_revenue": F.lit(0).cast(MONEY)})
        msgs = msgs.unionByName(framed(again, 1))
    if corrupt:
        msgs = msgs.withColumn("value", framing.damage(F.col("value"), F.col("id")))
    return msgs.select(
        F.col("id").cast("string").alias("key"),
        F.col("value"),
        F.lit(TOPIC).alias("topic"),
        F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        (F.col("id") * 2 + F.col("copy")).alias("offset"),
        F.timestamp_micros(F.coalesce(F.col("created_at"), F.lit(0)) + F.col("copy") * HOUR_US).alias("timestamp"),
    )


def numbered_messages(spark: SparkSession, sf_dir: str, lossy: bool = False, spread: int = 1) -> DataFrame:
    """The topic with gapless offsets: partition ``id mod 4``, offset ``id div 4``
    (event ids run from 0 without a hole), damage included.  With ``lossy``
    the broker has lost ids 5 to 9 of every 211 and ids 300 to 699."""
    msgs = kafka_messages(spark, sf_dir, corrupt=True, spread=spread).withColumn("_id", F.col("key").cast("bigint"))
    if lossy:
        msgs = msgs.where(~(F.col("_id") % 211).between(5, 9) & ~F.col("_id").between(300, 699))
    return msgs.withColumns({"partition": (F.col("_id") % TOPIC_PARTITIONS).cast("int"),
                             "offset": F.expr(f"_id div {TOPIC_PARTITIONS}")}).drop("_id")


def change_envelopes(spark: SparkSession, sf_dir: str, spread: int = 1) -> DataFrame:
    """The change log as JSON change envelopes ``{before, after, op, ts_ms, source{lsn}}``
    framed like the topic: creates carry ``after``, updates both images,
    deletes only ``before``."""
    log = change_log(spark, sf_dir, spread=spread)
    row = F.struct("id", "ts", "user_id", "event_type", "value")
    prev = F.struct(
        "id", "ts", "user_id", "event_type", (F.col("value") - 1).alias("value")
    )
    op = F.col("op")
    env = F.struct(
        F.when(op == "u", prev).when(op == "d", row).alias("before"),
        F.when(op.isin("c", "r", "u"), row).alias("after"),
        op.alias("op"),
        F.floor(ntz_to_micros(F.col("ts")) / 1000).alias("ts_ms"),
        F.struct(F.col("lsn").alias("lsn")).alias("source"),
    )
    return log.select(
        F.col("id").cast("string").alias("key"),
        framing.encode_json_frame(env, F.lit(SCHEMA_ID)).alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        F.col("lsn").alias("offset"),
        F.timestamp_micros(ntz_to_micros(F.col("ts"))).alias("timestamp"),
    )


def write_in_slices(df: DataFrame, path: str, order: Column, slices: int,
                    partition_by: list[str] | None = None, after: Callable[[], None] | None = None) -> None:
    """Write ``df`` as ``slices`` successive appends, each a range of the
    integral ``order`` expression, so a file stream source (which takes the
    oldest files first) sees the data in that order.  Only the two bounds of
    ``order`` reach the driver.  ``after`` runs after each append.  With
    ``partition_by`` a slice's rows are rebalanced on it under AQE, as
    ``LakeTable`` does: a day is a file or a few, not one per task."""
    aqe = df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true") == "true"
    lo, hi = df.agg(F.min(order), F.max(order)).first()
    edges = [None] + [lo + (hi - lo) * i // slices for i in range(1, slices)] + [None]
    if lo is None:
        edges = [None, None]
    for a, b in zip(edges[:-1], edges[1:]):
        part = df
        if a is not None:
            part = part.where(order > F.lit(a))
        if b is not None:
            part = part.where(order <= F.lit(b))
        if partition_by and aqe:
            part = part.hint("rebalance", *partition_by)
        writer = part.write.mode("append")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        if after:
            after()
