"""Data model of one attribution event (install, ad revenue, subscription).

Bronze keeps the wire types (timestamps as epoch micros), silver the
conformed types (decimals, zone-less timestamps).  Everything here is a
plain constant or a ``StructType`` built from those constants.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The event table's columns in table order, with the length
# bound of each text column (0 = not text).  Must equal the source table.
# ---------------------------------------------------------------------------
EVENT_COLUMNS: list[tuple[str, str, int]] = [
    ("id", "bigint", 0),
    ("activity_kind", "string", 50),
    ("created_at", "timestamp", 0),
    ("app_token", "string", 255),
    ("store_id", "string", 255),
    ("app_name", "string", 255),
    ("app_version", "string", 255),
    ("platform", "string", 50),
    ("environment", "string", 50),
    ("sdk_version", "string", 50),
    ("os_name", "string", 50),
    ("os_version", "string", 50),
    ("device_type", "string", 50),
    ("device_model", "string", 255),
    ("language", "string", 10),
    ("country", "string", 255),
    ("country_subdivision", "string", 255),
    ("city", "string", 255),
    ("timezone", "string", 100),
    ("adid", "string", 255),
    ("gps_adid", "string", 255),
    ("idfa", "string", 255),
    ("idfv", "string", 255),
    ("tracker", "string", 255),
    ("tracker_name", "string", 255),
    ("network_name", "string", 255),
    ("campaign_name", "string", 255),
    ("adgroup_name", "string", 255),
    ("creative_name", "string", 255),
    ("event", "string", 255),
    ("event_name", "string", 255),
    ("revenue_float", "decimal", 0),
    ("currency", "string", 10),
    ("reporting_revenue", "decimal", 0),
    ("reporting_currency", "string", 10),
    ("ad_impressions_count", "decimal", 0),
    ("ad_mediation_platform", "string", 255),
    ("ad_revenue_network", "string", 255),
    ("ad_revenue_placement", "string", 255),
    ("ad_revenue_unit", "string", 255),
    ("subscription_event_type", "string", 50),
    ("subscription_purchased_at", "timestamp", 0),
    ("subscription_expiration_time", "timestamp", 0),
    ("subscription_cancelled_at", "timestamp", 0),
    ("subscription_transaction_id", "string", 255),
    ("subscription_original_transaction_id", "string", 255),
    ("subscription_product_id", "string", 255),
    ("subscription_sales_region", "string", 255),
    ("reporting_cost", "decimal", 0),
    ("installed_at", "timestamp", 0),
    ("click_time", "timestamp", 0),
    ("impression_time", "timestamp", 0),
    ("engagement_time", "timestamp", 0),
    ("impression_based", "boolean", 0),
    ("is_organic", "boolean", 0),
]

# Fixed value: NUMERIC(18, 6) of the money / count columns.
MONEY = T.DecimalType(18, 6)

COLUMN_NAMES = [c for c, _, _ in EVENT_COLUMNS]
TEXT_COLUMNS = [c for c, k, _ in EVENT_COLUMNS if k == "string"]
TEXT_BOUNDS = {c: n for c, k, n in EVENT_COLUMNS if k == "string"}
DECIMAL_COLUMNS = [c for c, k, _ in EVENT_COLUMNS if k == "decimal"]
TIMESTAMP_COLUMNS = [c for c, k, _ in EVENT_COLUMNS if k == "timestamp"]
BOOLEAN_COLUMNS = [c for c, k, _ in EVENT_COLUMNS if k == "boolean"]

# Attributes shared by every row of one journey (one adid); used by the
# journey-consistency rule and by the dimensions.
JOURNEY_ATTRIBUTES = [
    "app_token", "store_id", "app_name", "app_version", "platform", "environment",
    "sdk_version", "os_name", "os_version", "device_type", "device_model", "language",
    "country", "country_subdivision", "city", "timezone", "tracker", "tracker_name",
    "network_name", "campaign_name", "adgroup_name", "creative_name",
]

_BRONZE_TYPES = {
    "bigint": T.LongType(),
    "string": T.StringType(),
    "timestamp": T.LongType(),  # epoch micros on the wire
    "decimal": MONEY,
    "boolean": T.BooleanType(),
}
_SILVER_TYPES = dict(_BRONZE_TYPES, timestamp=T.TimestampNTZType())


def bronze_schema() -> T.StructType:
    """Decoded message payload: the 55 columns with timestamps as micros."""
    return T.StructType(
        [T.StructField(c, _BRONZE_TYPES[k], c != "id") for c, k, _ in EVENT_COLUMNS]
    )


def silver_schema() -> T.StructType:
    """Conformed row: zone-less timestamps plus the ``event_date`` partition."""
    fields = [T.StructField(c, _SILVER_TYPES[k], True) for c, k, _ in EVENT_COLUMNS]
    return T.StructType(fields + [T.StructField("event_date", T.DateType(), True)])


def silver_type(column: str) -> T.DataType:
    return silver_schema()[column].dataType


# ---------------------------------------------------------------------------
# The value domains the event generator draws from.  The
# quality report checks membership in them.
# ---------------------------------------------------------------------------
ACTIVITY_KINDS = ["install", "ad_revenue", "subscription"]
NETWORKS = ["Facebook", "Google Ads", "TikTok", "AppLovin", "Unity Ads"]
CAMPAIGNS = ["campaign_a", "campaign_b", "campaign_c", "campaign_d"]
ADGROUPS = ["adgroup_a", "adgroup_b", "adgroup_c"]
CREATIVES = ["creative_a", "creative_b", "creative_c"]
STORES = ["com.example.example1", "com.example.example2", "com.example.example3"]
APP_NAMES = {
    "com.example.example1": "Example One",
    "com.example.example2": "Example Two",
    "com.example.example3": "Example Three",
}
COUNTRIES = ["VN", "US", "SG", "JP", "TH"]
APP_VERSIONS = ["1.0.0", "1.1.0", "1.2.3", "2.0.0"]
CURRENCIES = ["USD"]
AD_REVENUE_NETWORKS = ["AdMob", "Facebook Audience Network", "AppLovin", "Unity Ads"]
AD_REVENUE_PLACEMENTS = ["banner", "interstitial", "rewarded", "native"]
AD_REVENUE_UNITS = ["unit_a", "unit_b", "unit_c"]
PLATFORMS = ["ios", "android"]
OS_VERSIONS_BY_PLATFORM = {
    "ios": ["15.0", "16.2", "17.1", "18.0"],
    "android": ["11", "12", "13", "14"],
}
DEVICE_MODELS_BY_PLATFORM = {
    "ios": ["iPhone14,2", "iPhone15,3", "iPad13,1"],
    "android": ["Pixel 7", "Pixel 8", "SM-G991B", "SM-S911B"],
}
SUBSCRIPTION_EVENT_TYPES = ["started", "renewed", "cancelled", "expired"]
SUBSCRIPTION_SALES_REGIONS = ["US", "VN", "SG", "JP", "TH"]
SUBSCRIPTION_PRODUCT_IDS = ["sub_monthly", "sub_yearly", "sub_weekly"]
# Id prefixes, ad revenue / impression ranges, subscription
# length and cost ratio, look-back of clicks and impressions.
TRACKER_PREFIX = "trk_"
TRANSACTION_PREFIX = "txn_"
ORIGINAL_TRANSACTION_PREFIX = "otxn_"
AD_REVENUE_RANGE = ("0.0001", "0.1")
AD_IMPRESSIONS_RANGE = ("1", "50")
SUBSCRIPTION_DAYS = 30
COST_RATIO_RANGE = ("0.1", "0.3")
ATTRIBUTION_LOOKBACK_DAYS = 7

# Domain rules: column -> allowed values (checked where the column is set).
DOMAINS: dict[str, list[str]] = {
    "activity_kind": ACTIVITY_KINDS,
    "store_id": STORES,
    "app_version": APP_VERSIONS,
    "platform": PLATFORMS,
    "network_name": NETWORKS,
    "campaign_name": CAMPAIGNS,
    "adgroup_name": ADGROUPS,
    "creative_name": CREATIVES,
    "country": COUNTRIES,
    "currency": CURRENCIES,
    "reporting_currency": CURRENCIES,
    "ad_revenue_network": AD_REVENUE_NETWORKS,
    "ad_revenue_placement": AD_REVENUE_PLACEMENTS,
    "ad_revenue_unit": AD_REVENUE_UNITS,
    "subscription_event_type": SUBSCRIPTION_EVENT_TYPES,
    "subscription_product_id": SUBSCRIPTION_PRODUCT_IDS,
    "subscription_sales_region": SUBSCRIPTION_SALES_REGIONS,
}


def registry_schema() -> T.StructType:
    """The payload schema as the schema registry states it: the four money
    columns are doubles there (the table says NUMERIC(18,6)); silver's
    ``conform`` turns them back into DECIMAL(18,6)."""
    return T.StructType([
        T.StructField(f.name, T.DoubleType() if f.name in DECIMAL_COLUMNS else f.dataType, f.nullable)
        for f in bronze_schema().fields
    ])
