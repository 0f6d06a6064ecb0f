"""DuckDB twins of the registered queries (the correctness oracle).

The driver tables are mapped to the attribution event with plain SQL
(``BRONZE``/``SILVER`` CTEs below) and each query is restated in SQL.  Shared
with the Spark side are the data model's fixed values (columns, domains,
bounds) and the expressions that put faults into the input of
``quality_report_faults``.  Sums are DECIMAL(38,6), counts BIGINT on both
sides.
"""

from __future__ import annotations

from attrlake.schemas import EVENT_COLUMNS
from attrlake.sources.fixtures import FAULTS, FAULTY_TWICE

# events -> attribution event with wire types (timestamps = epoch micros)
_ADAPTER = """
select e.*,
  case when activity_kind = 'install' then created_at end as installed_at,
  case when activity_kind = 'install' and k % 10 < 7 then created_at - k * 3600000000 end as click_time,
  case when activity_kind = 'install' then k % 10 = 1 end as impression_based,
  case when activity_kind = 'install' then k % 5 = 0 end as is_organic,
  case when activity_kind = 'ad_revenue' then cast(raw_value / 5000 as decimal(18,6)) end as revenue_float,
  case when activity_kind = 'ad_revenue' then cast(raw_value / 5000 as decimal(18,6))
       when activity_kind = 'subscription' then cast(raw_value as decimal(18,6)) end as reporting_revenue,
  case when activity_kind in ('ad_revenue', 'subscription') then 'USD' end as reporting_currency,
  case when activity_kind = 'ad_revenue' then cast(k as decimal(18,6)) end as ad_impressions_count,
  case when activity_kind = 'ad_revenue' then concat('adnet_', k % 4) end as ad_revenue_network,
  case when activity_kind = 'ad_revenue' then concat('place_', k % 3) end as ad_revenue_placement,
  case when activity_kind = 'subscription' then cast(raw_value * 0.2 as decimal(18,6)) end as reporting_cost,
  case when activity_kind = 'subscription' then
    case k % 4 when 0 then 'started' when 1 then 'renewed' when 2 then 'cancelled' else 'expired' end end as subscription_event_type,
  case when activity_kind = 'subscription' then concat('sub_', k % 3) end as subscription_product_id,
  case when activity_kind = 'subscription' then created_at - k * 86400000000 end as subscription_purchased_at,
  case when activity_kind = 'subscription' then created_at - k * 86400000000 + 2592000000000 end as subscription_expiration_time,
  case when activity_kind = 'subscription' and k % 4 = 2 then created_at end as subscription_cancelled_at
from (
  select event_id as id,
    case event_type when 'signup' then 'install' when 'view' then 'ad_revenue'
                    when 'purchase' then 'subscription' else event_type end as activity_kind,
    epoch_us(ts) as created_at, cast(ts as date) as event_date,
    value as raw_value, cast(regexp_extract(props, '[0-9]+', 0) as bigint) as k,
    concat('adid_', user_id) as adid, concat('adid_', user_id) as gps_adid,
    concat('app_', user_id % 3) as app_token, concat('store_', user_id % 3) as store_id,
    concat('App ', user_id % 3) as app_name,
    case when user_id % 2 = 0 then 'ios' else 'android' end as platform,
    case when user_id % 2 = 0 then 'ios' else 'android' end as os_name,
    concat('trk_', user_id % 20) as tracker, concat('trk_', user_id % 20) as tracker_name,
    concat('net_', user_id % 5) as network_name, concat('campaign_', user_id % 4) as campaign_name,
    concat('adgroup_', user_id % 3) as adgroup_name
  from events) e
"""

_DUCK_TYPES = {"bigint": "bigint", "string": "varchar", "timestamp": "bigint",
               "decimal": "decimal(18,6)", "boolean": "boolean"}
_FILLED = {
    "id", "activity_kind", "created_at", "adid", "gps_adid", "app_token", "store_id", "app_name",
    "platform", "os_name", "tracker", "tracker_name", "network_name", "campaign_name", "adgroup_name",
    "installed_at", "click_time", "impression_based", "is_organic", "revenue_float", "reporting_revenue",
    "reporting_currency", "ad_impressions_count", "ad_revenue_network", "ad_revenue_placement",
    "reporting_cost", "subscription_event_type", "subscription_product_id", "subscription_purchased_at",
    "subscription_expiration_time", "subscription_cancelled_at",
}


def _bronze_select() -> str:
    cols = []
    for name, kind, _ in EVENT_COLUMNS:
        t = _DUCK_TYPES[kind]
        src = name if name in _FILLED else "null"
        cols.append(f"cast({src} as {t}) as {name}")
    return ",\n  ".join(cols + ["event_date"])


def _silver_select() -> str:
    cols = []
    for name, kind, _ in EVENT_COLUMNS:
        cols.append(f"make_timestamp({name}) as {name}" if kind == "timestamp" else name)
    return ",\n  ".join(cols + ["event_date"])


BRONZE = f"bronze as (select\n  {_bronze_select()}\nfrom ({_ADAPTER}) a)"
SILVER = f"silver as (select\n  {_silver_select()}\nfrom bronze)"


def _with(ctes: list[str], query: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + query


def with_silver(query: str, *extra: str) -> str:
    return _with([BRONZE, SILVER, *extra], query)


def with_bronze(query: str, *extra: str) -> str:
    return _with([BRONZE, *extra], query)


# Change log of FIXTURES §5 (inserts, updates, deletes, redeliveries).
CHANGE_LOG = """changes as (
select 'c' as op, event_id as id, ts, user_id, event_type, value, event_id * 4 as lsn from events
union all select 'u', event_id, ts, user_id, event_type, value + 1, event_id * 4 + 1 from events where event_id % 10 = 0
union all select 'd', event_id, ts, user_id, event_type, value + 1, event_id * 4 + 2 from events where event_id % 50 = 0
union all select 'c', event_id, ts, user_id, event_type, value, event_id * 4 from events where event_id % 7 = 0
)"""

SUM = "decimal(38,6)"


def _sum(expr: str, alias: str) -> str:
    return f"cast(sum({expr}) as {SUM}) as {alias}"


FACT_SQL = {
    "fact_installs_daily": f"""
select event_date, app_token, tracker,
  cast(count(*) as bigint) as installs,
  cast(count(*) filter (where is_organic) as bigint) as organic_installs,
  cast(count(*) filter (where impression_based) as bigint) as impression_based_installs,
  cast(count(*) filter (where click_time is not null) as bigint) as clicked_installs
from silver where activity_kind = 'install'
group by event_date, app_token, tracker""",
    "fact_revenue_daily": f"""
select event_date, app_token, tracker, reporting_currency,
  {_sum('reporting_revenue', 'revenue')},
  {_sum("case when activity_kind = 'ad_revenue' then reporting_revenue end", 'ad_revenue')},
  {_sum("case when activity_kind = 'subscription' then reporting_revenue end", 'subscription_revenue')},
  cast(count(*) as bigint) as events
from silver where activity_kind in ('ad_revenue', 'subscription')
group by event_date, app_token, tracker, reporting_currency""",
    "fact_ad_revenue_daily": f"""
select event_date, app_token, tracker, ad_revenue_network, ad_revenue_placement, ad_revenue_unit,
  ad_mediation_platform,
  {_sum('reporting_revenue', 'revenue')}, {_sum('ad_impressions_count', 'impressions')},
  cast(count(*) as bigint) as events
from silver where activity_kind = 'ad_revenue'
group by event_date, app_token, tracker, ad_revenue_network, ad_revenue_placement, ad_revenue_unit,
  ad_mediation_platform""",
    "fact_subscription_daily": f"""
select event_date, app_token, tracker, subscription_event_type, subscription_product_id,
  subscription_sales_region,
  cast(count(*) as bigint) as events, {_sum('reporting_revenue', 'revenue')}, {_sum('reporting_cost', 'cost')}
from silver where activity_kind = 'subscription'
group by event_date, app_token, tracker, subscription_event_type, subscription_product_id,
  subscription_sales_region""",
    "fact_events_daily": """
select event_date, app_token, tracker, activity_kind, event_name,
  cast(count(*) as bigint) as events, cast(count(distinct adid) as bigint) as devices
from silver group by event_date, app_token, tracker, activity_kind, event_name""",
}


from attrlake import schemas as M  # noqa: E402


def _list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _dim_sql(key: str, attributes: list[str]) -> str:
    attrs = ", ".join(attributes)
    return f"""select {key}, {attrs}, first_seen, last_seen, last_id from (
  select {key}, {attrs},
    min(created_at) over (partition by {key}) as first_seen,
    created_at as last_seen, id as last_id,
    row_number() over (partition by {key} order by created_at desc, id desc) as rn
  from silver where {key} is not null) d where rn = 1"""


DIM_APP = ["store_id", "app_name", "platform", "app_version", "sdk_version"]
DIM_CAMPAIGN = ["tracker_name", "network_name", "campaign_name", "adgroup_name", "creative_name"]


def _quality_rules() -> list[tuple[str, str, str]]:
    per_platform = lambda col, m: " or ".join(
        f"(platform = '{p}' and {col} in {_list(v)})" for p, v in m.items())
    store_case = "case " + " ".join(f"when store_id = '{s}' then '{n}'" for s, n in M.APP_NAMES.items()) + " end"
    rules = [
        ("Q2_activity_kind_domain", "true", f"coalesce(activity_kind in {_list(M.ACTIVITY_KINDS)}, false)"),
        ("Q3_os_name_is_platform", "platform is not null or os_name is not null", "os_name is not distinct from platform"),
        ("Q3_os_version_of_platform", "os_version is not null", per_platform("os_version", M.OS_VERSIONS_BY_PLATFORM)),
        ("Q3_device_model_of_platform", "device_model is not null",
         per_platform("device_model", M.DEVICE_MODELS_BY_PLATFORM)),
        ("Q4_app_name_of_store", "store_id is not null", f"app_name is not distinct from ({store_case})"),
    ]
    for col, values in M.DOMAINS.items():
        if col != "activity_kind":
            rules.append((f"Q5_domain_{col}", f"{col} is not null", f"{col} in {_list(values)}"))
    kind = "activity_kind = '{}'".format
    rules += [
        ("Q6_gps_adid_is_adid", "adid is not null or gps_adid is not null", "gps_adid is not distinct from adid"),
        ("Q6_tracker_is_tracker_name", "tracker is not null or tracker_name is not null",
         "tracker is not distinct from tracker_name"),
        ("Q6_tracker_prefix", "tracker_name is not null", "starts_with(tracker_name, 'trk_')"),
        ("Q6_transaction_id_prefix", "subscription_transaction_id is not null",
         "starts_with(subscription_transaction_id, 'txn_')"),
        ("Q6_original_transaction_id_prefix", "subscription_original_transaction_id is not null",
         "starts_with(subscription_original_transaction_id, 'otxn_')"),
        ("Q7_install_has_installed_at", kind("install"), "installed_at is not null"),
        ("Q7_click_within_lookback", kind("install") + " and click_time is not null",
         "click_time <= installed_at and click_time >= installed_at - interval 7 day"),
        ("Q7_impression_within_lookback", kind("install") + " and impression_time is not null",
         "impression_time <= installed_at and impression_time >= installed_at - interval 7 day"),
        ("Q7_device_ids_only_on_ios", "idfa is not null or idfv is not null", "platform = 'ios'"),
        ("Q8_ad_revenue_range", kind("ad_revenue"), "reporting_revenue between 0.0001 and 0.1"),
        ("Q8_ad_impressions_range", kind("ad_revenue"), "ad_impressions_count between 1 and 50"),
        ("Q8_revenue_float_is_reporting", kind("ad_revenue"), "revenue_float is not distinct from reporting_revenue"),
        ("Q9_expiration_after_purchase", kind("subscription"),
         "subscription_expiration_time = subscription_purchased_at + interval 30 day"),
        ("Q9_cancelled_at_iff_cancelled", kind("subscription"),
         "(subscription_cancelled_at is not null) = coalesce(subscription_event_type = 'cancelled', false)"),
        ("Q9_cost_ratio", kind("subscription"),
         "reporting_cost between reporting_revenue * 0.1 and reporting_revenue * 0.3"),
        ("Q10_text_within_bounds", "true",
         "not (" + " or ".join(f"coalesce(length({c}) > {n}, false)" for c, n in M.TEXT_BOUNDS.items()) + ")"),
    ]
    return rules


def _quality_sql() -> str:
    rows = [
        f"select '{name}' as rule, cast(count(*) filter (where {a}) as bigint) as checked, "
        f"cast(count(*) filter (where ({a}) and not coalesce({ok}, false)) as bigint) as violations from silver"
        for name, a, ok in _quality_rules()
    ]
    attrs = ", ".join(M.JOURNEY_ATTRIBUTES)
    rows += [
        "select 'Q1_id_not_null_unique', cast(count(*) as bigint), cast(count(*) - count(distinct id) as bigint) from silver",
        """select 'Q4_one_app_name_per_store', cast(count(*) as bigint), cast(count(*) filter (where n > 1) as bigint)
from (select store_id, count(*) as n from (select distinct store_id, app_name from silver where store_id is not null) s group by store_id) g""",
        f"""select 'Q11_one_attribute_set_per_adid', cast(count(*) as bigint), cast(count(*) filter (where n > 1) as bigint)
from (select adid, count(*) as n from (select distinct adid, {attrs} from silver where adid is not null) s group by adid) g""",
    ]
    return "\nunion all\n".join(rows)


_REPLACED = ", ".join(f"{sql} as {c}" for c, sql in FAULTS.items())
FAULTY = (f"faulty as (select * replace ({_REPLACED}) from silver union all "
          f"select * replace ({_REPLACED}) from silver where {FAULTY_TWICE})")


def _fact_cte(name: str) -> str:
    return f"{name} as ({FACT_SQL[name]})"


DAMAGE_REASON = """case id % 101 when 1 then 'tombstone' when 2 then 'short_value' when 3 then 'short_value'
  when 4 then 'bad_magic' when 5 then 'short_value' when 6 then 'undecodable' when 7 then 'null_id'
  when 8 then 'undecodable' when 9 then 'null_created_at' end"""
MESSAGES = "messages as (select id, event_date, 0 as copy from bronze union all select id, event_date, 1 from bronze where id % 7 = 0)"
CURRENT = """select id, op, ts, user_id, event_type, value, lsn from (
  select *, row_number() over (partition by id order by lsn desc) as rn from changes) c
where rn = 1 and op <> 'd'"""


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {
        "bronze_event_date": with_bronze(
            "select id, created_at, cast(make_timestamp(created_at) as date) as event_date from bronze"),
        "bronze_family_filter": with_bronze(
            "select id, activity_kind, event_date, reporting_revenue, ad_impressions_count from bronze "
            "where activity_kind = 'ad_revenue'"),
        "bronze_partition_range": with_bronze(
            "select id, event_date, activity_kind from bronze "
            "where event_date between date '2024-01-10' and date '2024-01-19'"),
        "frame_decode_roundtrip": with_bronze("select * from bronze"),
        "frame_schema_id": with_bronze(
            "select cast(id as varchar) as key, cast(0 as integer) as magic_byte, "
            "cast(case when created_at >= 1705363200000000 then 2 else 1 end as bigint) as schema_id from bronze"),
        "cdc_unwrap": _with([CHANGE_LOG],
            "select op, id, case when op <> 'd' then ts end as ts, case when op <> 'd' then user_id end as user_id, "
            "case when op <> 'd' then event_type end as event_type, case when op <> 'd' then value end as value, "
            "lsn from changes"),
        "quarantine_split": with_bronze(
            f"select cast(id as varchar) as key, cast(id * 2 + copy as bigint) as offset, {DAMAGE_REASON} as reason "
            "from messages", MESSAGES),
        "silver_conform": with_silver("select *, cast(0 as integer) as cast_errors from silver"),
        "silver_dedupe": with_silver("select * from silver"),
        "silver_current": _with([CHANGE_LOG], CURRENT),
        "dim_app": with_silver(_dim_sql("app_token", DIM_APP)),
        "dim_campaign": with_silver(_dim_sql("tracker", DIM_CAMPAIGN)),
    }
    for name, sql in FACT_SQL.items():
        out[name] = with_silver(sql)
    out["report_star_app"] = with_silver(
        """select p.event_date, p.app_token, p.revenue, p.events, d.app_name, d.store_id, d.platform
from (select event_date, app_token, cast(sum(revenue) as decimal(38,6)) as revenue, cast(sum(events) as bigint) as events
      from fact_revenue_daily group by event_date, app_token) p
left join dim on p.app_token = d.app_token""".replace("left join dim on", "left join dim d on"),
        _fact_cte("fact_revenue_daily"), f"dim as ({_dim_sql('app_token', DIM_APP)})")
    out["report_star_campaign"] = with_silver(
        """select p.event_date, p.tracker, p.installs, p.organic_installs, d.network_name, d.campaign_name
from (select event_date, tracker, cast(sum(installs) as bigint) as installs,
        cast(sum(organic_installs) as bigint) as organic_installs
      from fact_installs_daily group by event_date, tracker) p
left join dim d on p.tracker = d.tracker""",
        _fact_cte("fact_installs_daily"), f"dim as ({_dim_sql('tracker', DIM_CAMPAIGN)})")
    out["report_campaign_performance"] = with_silver(
        """select p.event_date, p.tracker, p.installs, p.revenue, p.cost,
  round(cast(p.revenue as double) / cast(nullif(p.installs, 0) as double), 6) as revenue_per_install,
  d.network_name, d.campaign_name
from (select event_date, tracker, cast(coalesce(sum(installs), 0) as bigint) as installs,
        cast(coalesce(sum(revenue), 0) as decimal(38,6)) as revenue,
        cast(coalesce(sum(cost), 0) as decimal(38,6)) as cost
      from (select event_date, tracker, installs, null as revenue, null as cost from fact_installs_daily
            union all select event_date, tracker, null, revenue, null from fact_revenue_daily
            union all select event_date, tracker, null, null, cost from fact_subscription_daily) u
      group by event_date, tracker) p
left join dim d on p.tracker = d.tracker""",
        _fact_cte("fact_installs_daily"), _fact_cte("fact_revenue_daily"), _fact_cte("fact_subscription_daily"),
        f"dim as ({_dim_sql('tracker', DIM_CAMPAIGN)})")
    out["report_ecpm"] = with_silver(
        """select event_date, ad_revenue_network, revenue, impressions,
  round(1000.0 * cast(revenue as double) / cast(nullif(impressions, 0) as double), 6) as ecpm
from (select event_date, ad_revenue_network, cast(sum(revenue) as decimal(38,6)) as revenue,
        cast(sum(impressions) as decimal(38,6)) as impressions
      from fact_ad_revenue_daily group by event_date, ad_revenue_network) p""",
        _fact_cte("fact_ad_revenue_daily"))
    out["latest_events"] = with_silver(
        "select id, activity_kind, created_at, app_token, tracker, event_date from silver "
        "order by created_at desc, id desc limit 20")
    out["table_row_count"] = with_bronze("select cast(count(*) as bigint) as rows from bronze")
    out["quality_report_faults"] = with_silver(_quality_sql().replace("from silver", "from faulty"), FAULTY)
    out["silver_dedupe_differing"] = out["silver_dedupe"]
    out["silver_conform_errors"] = with_silver(
        """select id, case when id % 50 > 0 then reporting_revenue end as reporting_revenue,
  cast(case when id % 50 = 0 and reporting_revenue is not null then 1 else 0 end as integer) as cast_errors from silver""")
    out["sql_views"] = (f"with p as ({out['report_campaign_performance']}), c as ({out['report_star_campaign']}) "
                        "select p.event_date, p.tracker, p.installs, p.revenue, p.cost, c.installs as star_installs, "
                        "(select count(*) from events) as silver_rows from p left join c using (event_date, tracker)")
    out["latest_events_walk"] = out["latest_events"]
    out["table_row_count_footers"] = out["table_row_count"]
    out["report_devices_approx"] = with_silver(
        """select app_token, activity_kind, cast(count(*) as bigint) as events, cast(count(distinct adid) as bigint) as devices,
  true as within_3_percent from silver group by app_token, activity_kind""")
    out["quality_report"] = out["quality_report_one_scan"] = with_silver(_quality_sql())
    out["layer_reconcile"] = with_bronze(
        """select event_date, source_rows, source_ids, bronze_rows, bronze_ids, silver_rows, silver_ids,
  source_ids - silver_ids as missing_ids, bronze_rows - bronze_ids as extra_rows
from (select coalesce(s.event_date, b.event_date, v.event_date) as event_date,
        coalesce(s.n, 0) as source_rows, coalesce(s.ids, 0) as source_ids,
        coalesce(b.n, 0) as bronze_rows, coalesce(b.ids, 0) as bronze_ids,
        coalesce(v.n, 0) as silver_rows, coalesce(v.ids, 0) as silver_ids
      from (select event_date, cast(count(*) as bigint) as n, cast(count(distinct id) as bigint) as ids
            from bronze group by event_date) s
      full outer join (select event_date, cast(count(*) as bigint) as n, cast(count(distinct id) as bigint) as ids
            from good group by event_date) b on s.event_date = b.event_date
      full outer join (select event_date, cast(count(*) as bigint) as n, cast(count(distinct id) as bigint) as ids
            from (select distinct id, event_date from good) g group by event_date) v
        on coalesce(s.event_date, b.event_date) = v.event_date) r""",
        MESSAGES, "good as (select * from messages where id % 101 not between 1 and 9)")
    out["layer_reconcile_ids"] = _with([CHANGE_LOG, BRONZE, MESSAGES, f"live as ({CURRENT})"],
        """select coalesce(s.event_date, t.event_date) as event_date, coalesce(s.id, t.id) as id,
  case when t.id is null then 'lost' else 'alien' end as kind,
  cast(count(s.id) as bigint) as source_rows, cast(count(t.id) as bigint) as target_rows
from (select id, cast(ts as date) as event_date from live) s
full outer join (select distinct id, event_date from messages where id % 101 not between 1 and 9) t
  on s.id = t.id and s.event_date = t.event_date
where s.id is null or t.id is null group by s.id, t.id, s.event_date, t.event_date""")
    out["bronze_offset_gaps"] = """with held as (
  select cast(event_id % 4 as integer) as source_partition, event_id // 4 as o from events
  where event_id % 211 not between 5 and 9 and event_id not between 300 and 699),
runs as (select *, lag(o) over (partition by source_partition order by o) as earlier from held)
select source_partition, earlier + 1 as gap_first, o - 1 as gap_last, o - earlier - 1 as missing
from runs where o > earlier + 1"""
    out.update(_stream_sql(out))
    return out


# Silver in four slices by time, newest first; the split's mark after the first.
LATE = """o as (select *, -epoch_us(created_at) as o from silver),
edges as (select min(o) as lo, max(o) as hi from o),
mark as (select max(created_at) as m from o, edges where o <= lo + (hi - lo) // 4 and activity_kind in ('ad_revenue', 'subscription')),
late as (select id, event_date, activity_kind, 'late' as reason from o, edges, mark
  where activity_kind in ('ad_revenue', 'subscription') and o > lo + (hi - lo) // 4
    and event_date + interval 1 day <= m - interval 2 day)"""


def _stream_sql(batch: dict[str, str]) -> dict[str, str]:
    """Streaming queries equal their batch form over the same input."""
    return {
        "stream_bronze_append": with_bronze(
            "select b.* from messages m join bronze b on m.id = b.id where m.id % 101 not between 1 and 9",
            MESSAGES),
        "stream_quarantine": f"with r as ({batch['quarantine_split']}) "
                             "select * from r where reason is not null and reason <> 'tombstone'",
        "stream_message_counts": f"with r as ({batch['quarantine_split']}) "
                                 "select coalesce(reason, 'good') as reason, count(*) as messages from r group by 1",
        "stream_silver": batch["silver_dedupe"],
        "stream_fact_events_buckets": batch["fact_events_daily"],
        "stream_fact_revenue_buckets": batch["fact_revenue_daily"],
        "stream_silver_watermark": batch["silver_dedupe"],
        "stream_fact_events_logged": batch["fact_events_daily"],
        "stream_silver_current": batch["silver_current"],
        "stream_silver_current_delta": batch["silver_current"],
        "stream_dim_app_delta": batch["dim_app"],
        "stream_dim_campaign_delta": batch["dim_campaign"],
        "stream_dim_app_upsert": batch["dim_app"],
        "stream_dim_campaign_upsert": batch["dim_campaign"],
        "stream_fact_revenue_upsert": batch["fact_revenue_daily"],
        "stream_fact_installs_upsert": batch["fact_installs_daily"],
        "stream_fact_ad_revenue_upsert": batch["fact_ad_revenue_daily"],
        "stream_fact_subscription_upsert": batch["fact_subscription_daily"],
        "stream_fact_revenue_incremental": batch["fact_revenue_daily"],
        "stream_fact_events_refresh": batch["fact_events_daily"],
        "stream_fact_events_incremental": batch["fact_events_daily"],
        "stream_fact_events_fresh_checkpoint": batch["fact_events_daily"],
        "stream_gold_after_backfill": batch["fact_events_daily"],
        "stream_fact_day_emptied": f"with f as ({batch['fact_installs_daily']}) "
                                   "select * from f where event_date > (select min(event_date) from f)",
        "stream_fact_revenue_late": batch["fact_revenue_daily"],
        "stream_fact_device_sketches_upsert": f"with f as ({batch['fact_events_daily']}) select *, true as within_3_percent from f",
        "stream_quality_report": batch["quality_report"],
        "stream_late_rows": with_silver("select * from late", LATE),
        "stream_fact_revenue_timely": with_silver(
            f"select * from ({FACT_SQL['fact_revenue_daily'].replace('from silver', 'from timely')}) f",
            LATE, "timely as (select * from silver where id not in (select id from late))"),
        "stream_bronze_to_gold": batch["fact_events_daily"],
        "stream_all_layers": batch["layer_reconcile"],
    }
