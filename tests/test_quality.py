"""Quality rules on hand-built rows: each rule counts what it should."""

import datetime as dt
from decimal import Decimal

from attrlake.operators import quality as Q
from attrlake.operators.silver import conform
from attrlake.schemas import silver_schema

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)


def _rows(spark, rows):
    names = [f.name for f in silver_schema().fields]
    full = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(full, silver_schema())


def _report(df):
    return {r.rule: (r.checked, r.violations) for r in Q.quality_report(df).collect()}


def test_rules_count_checked_rows_and_violations(spark):
    base = dict(app_token="app_1", store_id="com.example.example1", app_name="Example One",
                platform="ios", os_name="ios", os_version="17.1", device_model="iPhone14,2",
                adid="adid_1", gps_adid="adid_1", tracker="trk_a", tracker_name="trk_a",
                created_at=T0, event_date=T0.date())
    rows = [
        dict(base, id=1, activity_kind="install", installed_at=T0, click_time=T0 - dt.timedelta(days=8),
             idfa="idfa_x"),
        dict(base, id=2, activity_kind="ad_revenue", reporting_revenue=Decimal("0.5"),
             revenue_float=Decimal("0.5"), ad_impressions_count=Decimal("3")),
        dict(base, id=3, activity_kind="subscription", reporting_revenue=Decimal("10"),
             reporting_cost=Decimal("2"), subscription_event_type="cancelled",
             subscription_purchased_at=T0, subscription_expiration_time=T0 + dt.timedelta(days=30)),
        dict(base, id=3, activity_kind="refund", platform="android", os_name="android",
             app_name="Other"),  # duplicate id, unknown kind, device of the other platform, new app name
    ]
    rep = _report(_rows(spark, rows))
    assert rep["Q1_id_not_null_unique"] == (4, 1)
    assert rep["Q2_activity_kind_domain"] == (4, 1)
    assert rep["Q3_os_version_of_platform"] == (4, 1)
    assert rep["Q3_device_model_of_platform"] == (4, 1)
    assert rep["Q4_app_name_of_store"] == (4, 1)
    assert rep["Q4_one_app_name_per_store"] == (1, 1)
    assert rep["Q7_click_within_lookback"] == (1, 1)
    assert rep["Q7_device_ids_only_on_ios"] == (1, 0)
    assert rep["Q8_ad_revenue_range"] == (1, 1)
    assert rep["Q8_ad_impressions_range"] == (1, 0)
    assert rep["Q9_cancelled_at_iff_cancelled"] == (1, 1)
    assert rep["Q9_expiration_after_purchase"] == (1, 0)
    assert rep["Q9_cost_ratio"] == (1, 0)
    assert rep["Q11_one_attribute_set_per_adid"] == (1, 1)
    assert rep["Q10_text_within_bounds"] == (4, 0)


def test_reconcile_shows_gaps_and_redeliveries(spark):
    src = conform(spark.createDataFrame([(i, i * 1_000_000) for i in range(6)], "id bigint, created_at bigint"))
    bronze = src.where("id != 5").unionByName(src.where("id = 0"))
    silver = bronze.dropDuplicates(["id"])
    (r,) = Q.layer_reconcile(src, bronze, silver).collect()
    assert (r.source_ids, r.bronze_rows, r.silver_ids, r.missing_ids, r.extra_rows) == (6, 6, 5, 1, 1)
