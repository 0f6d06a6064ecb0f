"""Data-quality report (Q1-Q11) and layer reconciliation (Q12).

Row rules share one scan: a single global aggregate of ``count_if``s, whose
partial form runs in every map task, then one explode into
``(rule, checked, violations)``.  Key rules are separate aggregations keyed
by the key they test.  A rule's ``applies`` says which rows it checks; a
rule whose test is NULL on a row it applies to counts as a violation (a
required value is missing).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from attrlake import schemas as M




def _in(col: str, values: list[str]) -> Column:
    return F.col(col).isin(*values)


def _per_platform(col: str, by_platform: dict[str, list[str]]) -> Column:
    return reduce(
        lambda a, b: a | b,
        [(F.col("platform") == p) & _in(col, vals) for p, vals in by_platform.items()],
    )


def _between(col: Column, lo: str, hi: str) -> Column:
    return col.between(F.lit(lo).cast(M.MONEY), F.lit(hi).cast(M.MONEY))


def row_rules() -> list[tuple[str, Column, Column]]:
    """(rule, applies, ok) for every row-level rule."""
    KIND = F.col("activity_kind")
    install = KIND == "install"
    ad = KIND == "ad_revenue"
    sub = KIND == "subscription"
    lookback = F.make_dt_interval(F.lit(M.ATTRIBUTION_LOOKBACK_DAYS))
    app_name_of_store = F.coalesce(
        *[F.when(F.col("store_id") == s, F.lit(n)) for s, n in M.APP_NAMES.items()]
    )
    rules = [
        ("Q2_activity_kind_domain", F.lit(True), F.coalesce(_in("activity_kind", M.ACTIVITY_KINDS), F.lit(False))),
        ("Q3_os_name_is_platform", F.col("platform").isNotNull() | F.col("os_name").isNotNull(),
         F.col("os_name").eqNullSafe(F.col("platform"))),
        ("Q3_os_version_of_platform", F.col("os_version").isNotNull(),
         _per_platform("os_version", M.OS_VERSIONS_BY_PLATFORM)),
        ("Q3_device_model_of_platform", F.col("device_model").isNotNull(),
         _per_platform("device_model", M.DEVICE_MODELS_BY_PLATFORM)),
        ("Q4_app_name_of_store", F.col("store_id").isNotNull(),
         F.col("app_name").eqNullSafe(app_name_of_store)),
    ]
    for col, values in M.DOMAINS.items():
        if col in ("activity_kind",):
            continue
        rules.append((f"Q5_domain_{col}", F.col(col).isNotNull(), _in(col, values)))
    rules += [
        ("Q6_gps_adid_is_adid", F.col("adid").isNotNull() | F.col("gps_adid").isNotNull(),
         F.col("gps_adid").eqNullSafe(F.col("adid"))),
        ("Q6_tracker_is_tracker_name", F.col("tracker").isNotNull() | F.col("tracker_name").isNotNull(),
         F.col("tracker").eqNullSafe(F.col("tracker_name"))),
        ("Q6_tracker_prefix", F.col("tracker_name").isNotNull(),
         F.col("tracker_name").startswith(M.TRACKER_PREFIX)),
        ("Q6_transaction_id_prefix", F.col("subscription_transaction_id").isNotNull(),
         F.col("subscription_transaction_id").startswith(M.TRANSACTION_PREFIX)),
        ("Q6_original_transaction_id_prefix", F.col("subscription_original_transaction_id").isNotNull(),
         F.col("subscription_original_transaction_id").startswith(M.ORIGINAL_TRANSACTION_PREFIX)),
        ("Q7_install_has_installed_at", install, F.col("installed_at").isNotNull()),
        ("Q7_click_within_lookback", install & F.col("click_time").isNotNull(),
         (F.col("click_time") <= F.col("installed_at"))
         & (F.col("click_time") >= F.col("installed_at") - lookback)),
        ("Q7_impression_within_lookback", install & F.col("impression_time").isNotNull(),
         (F.col("impression_time") <= F.col("installed_at"))
         & (F.col("impression_time") >= F.col("installed_at") - lookback)),
        ("Q7_device_ids_only_on_ios", F.col("idfa").isNotNull() | F.col("idfv").isNotNull(),
         F.col("platform") == "ios"),
        ("Q8_ad_revenue_range", ad, _between(F.col("reporting_revenue"), *M.AD_REVENUE_RANGE)),
        ("Q8_ad_impressions_range", ad, _between(F.col("ad_impressions_count"), *M.AD_IMPRESSIONS_RANGE)),
        ("Q8_revenue_float_is_reporting", ad, F.col("revenue_float").eqNullSafe(F.col("reporting_revenue"))),
        ("Q9_expiration_after_purchase", sub,
         F.col("subscription_expiration_time")
         == F.col("subscription_purchased_at") + F.make_dt_interval(F.lit(M.SUBSCRIPTION_DAYS))),
        ("Q9_cancelled_at_iff_cancelled", sub,
         F.col("subscription_cancelled_at").isNotNull()
         == F.coalesce(F.col("subscription_event_type") == "cancelled", F.lit(False))),
        ("Q9_cost_ratio", sub,
         F.col("reporting_cost").between(
             F.col("reporting_revenue") * F.lit(M.COST_RATIO_RANGE[0]).cast("decimal(2,1)"),
             F.col("reporting_revenue") * F.lit(M.COST_RATIO_RANGE[1]).cast("decimal(2,1)"))),
        ("Q10_text_within_bounds", F.lit(True),
         ~reduce(lambda a, b: a | b,
                 [F.coalesce(F.length(c) > n, F.lit(False)) for c, n in M.TEXT_BOUNDS.items()])),
    ]
    return rules


def row_rule_report(silver: DataFrame) -> DataFrame:
    rules = row_rules()
    aggs = []
    for i, (_, applies, ok) in enumerate(rules):
        aggs.append(F.count_if(applies).alias(f"c{i}"))
        aggs.append(F.count_if(applies & ~F.coalesce(ok, F.lit(False))).alias(f"v{i}"))
    wide = silver.agg(*aggs)
    entries = [
        F.struct(F.lit(name).alias("rule"), F.col(f"c{i}").alias("checked"), F.col(f"v{i}").alias("violations"))
        for i, (name, _, _) in enumerate(rules)
    ]
    return wide.select(F.explode(F.array(*entries)).alias("r")).select(
        "r.rule", F.col("r.checked").cast("bigint").alias("checked"),
        F.col("r.violations").cast("bigint").alias("violations"),
    )


def id_rule(silver: DataFrame) -> DataFrame:
    """Q1: id set and unique.  violations = rows beyond the first per id, plus rows without id."""
    per_id = silver.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.lit("Q1_id_not_null_unique").alias("rule"),
        F.sum("n").cast("bigint").alias("checked"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(F.col("n") - 1)).cast("bigint").alias("violations"),
    )


def functional_dependency(silver: DataFrame, rule: str, key: str, attributes: list[str]) -> DataFrame:
    """Keys whose rows carry more than one attribute set (NULL = a value).

    ``distinct`` on (key, attributes) first: a hot key with a third of the
    rows is pre-aggregated map-side before the shuffle.
    """
    sets = silver.where(F.col(key).isNotNull()).select(key, *attributes).distinct()
    per_key = sets.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.lit(rule).alias("rule"),
        F.count(F.lit(1)).cast("bigint").alias("checked"),
        F.count_if(F.col("n") > 1).cast("bigint").alias("violations"),
    )


ID_RULE = "Q1_id_not_null_unique"
#: Key rules: the key and what it must determine (Q1: that it occurs once).
KEY_RULES = {
    ID_RULE: ("id", []),
    "Q4_one_app_name_per_store": ("store_id", ["app_name"]),
    "Q11_one_attribute_set_per_adid": ("adid", M.JOURNEY_ATTRIBUTES),
}


def key_states(silver: DataFrame) -> DataFrame:
    """(rule, key, n, least, most): per key its rows and the smallest and
    largest hash of what it must determine; equal hashes, one attribute set.
    Mergeable (sum, min, max), so no ``distinct``, and one exploded scan for
    all key rules, combined map-side."""
    def attributes(names: list[str]) -> Column:
        # A null must not hash like a value that is missing before or after it.
        return F.xxhash64(*[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in names] or [F.lit(0)])

    entries = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"), attributes(names).alias("h"))
                        for rule, (key, names) in KEY_RULES.items()])
    rows = silver.select(F.explode(entries).alias("e")).select("e.*").where(F.col("key").isNotNull() | (F.col("rule") == ID_RULE))
    return rows.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("least"), F.max("h").alias("most"))


def key_report(states: DataFrame) -> DataFrame:
    """(rule, checked, violations) of the key rules from (merged) states; Q1
    counts rows, the others keys."""
    ids = F.col("rule") == ID_RULE
    beyond = F.when(F.col("key").isNull(), F.col("n")).otherwise(F.col("n") - 1)
    return states.groupBy("rule").agg(
        F.sum(F.when(ids, F.col("n")).otherwise(1)).cast("bigint").alias("checked"),
        F.sum(F.when(ids, beyond).otherwise((F.col("least") != F.col("most")).cast("int"))).cast("bigint").alias("violations"))


@dataclass
class QualityState:
    """The quality report in parts: per batch the states of its keys and the
    counters of its row rules, both from one scan.  Each batch has its own
    folders, replaced on a replay, so nothing counts twice."""

    spark: SparkSession
    location: str

    def take(self, silver: DataFrame, batch_id: int) -> None:
        """Add one batch of silver: its keys' states are written, the row
        rules' counters observed while its rows pass."""
        rules = row_rules()
        watch = Observation()
        counters = [c for i, (_, applies, ok) in enumerate(rules) for c in (
            F.count_if(applies).alias(f"c{i}"), F.count_if(applies & ~F.coalesce(ok, F.lit(False))).alias(f"v{i}"))]
        key_states(silver.observe(watch, *counters)).write.mode("overwrite").parquet(f"{self.location}/keys/batch={batch_id}")
        # Without a row the plan is empty and nothing is observed.
        seen = {} if silver.isEmpty() else watch.get
        rows = [(name, seen.get(f"c{i}", 0), seen.get(f"v{i}", 0)) for i, (name, _, _) in enumerate(rules)]
        (self.spark.createDataFrame(rows, "rule string, checked bigint, violations bigint").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.location}/counters/batch={batch_id}"))

    def report(self) -> DataFrame:
        """Q1-Q11 over all batches (rule, checked, violations)."""
        keys = self.spark.read.parquet(f"{self.location}/keys").groupBy("rule", "key").agg(
            F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
        counters = self.spark.read.parquet(f"{self.location}/counters").groupBy("rule").agg(
            F.sum("checked").alias("checked"), F.sum("violations").alias("violations"))
        found = key_report(keys)
        none = self.spark.createDataFrame([(r, 0, 0) for r in KEY_RULES], found.schema)
        keyed = found.unionByName(none).groupBy("rule").agg(F.sum("checked").alias("checked"), F.sum("violations").alias("violations"))
        return keyed.unionByName(counters)


def quality_report(silver: DataFrame) -> DataFrame:
    """Q1-Q11 as one frame ``(rule, checked, violations)``."""
    parts = [
        id_rule(silver),
        functional_dependency(silver, "Q4_one_app_name_per_store", "store_id", ["app_name"]),
        functional_dependency(silver, "Q11_one_attribute_set_per_adid", "adid", M.JOURNEY_ATTRIBUTES),
        row_rule_report(silver),
    ]
    return reduce(DataFrame.unionByName, parts)


ID_BUCKETS = 256


def id_digests(rows: DataFrame, buckets: int, sign: int) -> DataFrame:
    """Order-free digest of the ids per ``event_date`` and hash bucket: count,
    sum and xor of id hashes, the first two times ``sign``."""
    h = F.xxhash64("id")
    return rows.select("event_date", h.alias("h")).groupBy("event_date", F.pmod("h", F.lit(buckets)).alias("bucket")).agg(
        (F.count(F.lit(1)) * sign).alias("n"), (F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))) * sign).alias("total"),
        F.bit_xor("h").alias("mix"))


def reconcile_ids(source: DataFrame, target: DataFrame, buckets: int = ID_BUCKETS) -> DataFrame:
    """Q12 by id: which ids of ``source`` (id, event_date) ``target`` lacks,
    has too often, or has without a source row.

    Each side is digested per day and bucket first (one row each, combined
    map-side); ids are compared one by one only inside buckets whose digests
    differ.  ``kind`` is lost, alien, repeated or fewer; an id that lies on
    another day than in the source is lost on one and alien on the other.
    """
    digests = id_digests(source, buckets, 1).unionByName(id_digests(target, buckets, -1))
    differ = (digests.groupBy("event_date", "bucket").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.bit_xor("mix").alias("mix"))
              .where("n <> 0 or total <> 0 or mix <> 0").select(F.col("event_date").alias("_day"), F.col("bucket").alias("_bucket")))

    def counted(rows: DataFrame, mine: str, other: str) -> DataFrame:
        at = rows.select("event_date", "id", F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("bucket"))
        at = at.join(differ, at["event_date"].eqNullSafe(differ["_day"]) & (at["bucket"] == differ["_bucket"]), "left_semi")
        return at.groupBy("event_date", "id").agg(F.count(F.lit(1)).alias(mine)).withColumn(other, F.lit(0).cast("bigint"))

    both = counted(source, "source_rows", "target_rows").unionByName(counted(target, "target_rows", "source_rows"))
    s, t = F.col("source_rows"), F.col("target_rows")
    kind = F.when(t == 0, "lost").when(s == 0, "alien").when(t > s, "repeated").otherwise("fewer")
    return (both.groupBy("event_date", "id").agg(F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows"))
            .where(s != t).select("event_date", "id", kind.alias("kind"), "source_rows", "target_rows"))


def _per_day(df: DataFrame, prefix: str) -> DataFrame:
    return df.groupBy("event_date").agg(
        F.count(F.lit(1)).cast("bigint").alias(f"{prefix}_rows"),
        F.countDistinct("id").cast("bigint").alias(f"{prefix}_ids"),
    )


def layer_reconcile(source: DataFrame, bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Q12: rows and distinct ids per ``event_date`` in three layers.

    Each layer is aggregated to one row per day before the full outer joins,
    so the joins are over days, not events.  ``missing_ids`` = source ids not
    in silver (quarantined or lost), ``extra_rows`` = bronze rows beyond one
    per id (redeliveries).
    """
    s, b, v = _per_day(source, "source"), _per_day(bronze, "bronze"), _per_day(silver, "silver")
    out = s.join(b, "event_date", "full_outer").join(v, "event_date", "full_outer")
    z = F.lit(0).cast("bigint")
    cols = ["source_rows", "source_ids", "bronze_rows", "bronze_ids", "silver_rows", "silver_ids"]
    out = out.select("event_date", *[F.coalesce(F.col(c), z).alias(c) for c in cols])
    return out.withColumns({
        "missing_ids": F.col("source_ids") - F.col("silver_ids"),
        "extra_rows": F.col("bronze_rows") - F.col("bronze_ids"),
    })
