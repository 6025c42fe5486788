"""One query per operator, over whole tables. Days and instants are output as text, decimals as double."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountweave import functions as fn
from accountweave.operators import catalog, contract, events, identity, identity_update, quality
from accountweave.operators.crm import ACCOUNT, CONTACT, canonical
from accountweave.operators.joins import hot_counts
from accountweave.plans import marts, serving
from accountweave.sources import landing
from accountweave.sources.describe import parse_describes, parse_objects
from accountweave.sources.staging import stage
from checks.tables import AS_OF, Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
    return build


def day(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def instant(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def shown(df: DataFrame, days: Sequence[str] = (), instants: Sequence[str] = (), drop: Sequence[str] = ()) -> DataFrame:
    """Output form: no processing times, text for days and instants, double for decimals."""
    decimals = [name for name, kind in df.dtypes if kind.startswith("decimal")]
    return df.drop(*drop).withColumns(
        {c: day(c) for c in days}
        | {c: instant(c) for c in instants}
        | {c: F.col(c).cast("double") for c in decimals if c not in drop}
    )


# Marts.


def _c360(t: Tables) -> DataFrame:
    return marts.customer_360(t.accounts, t.contacts, t.opportunities, t.sales_reps, t.events, AS_OF)


def _intent(t: Tables) -> DataFrame:
    return marts.intent_engagement(t.events)


def _priority(t: Tables, c360: DataFrame | None = None) -> DataFrame:
    return marts.sales_prioritization(_c360(t) if c360 is None else c360, _intent(t), AS_OF)


def _identities(t: Tables, landed: DataFrame) -> DataFrame:
    """The identity map as a written table, for two lookups."""
    return stage(identity.identity_map(landed, t.written_contacts, t.written_accounts), "identity")


def _performance(t: Tables) -> DataFrame:
    return marts.sales_performance(t.opportunities, t.sales_reps)


def _attribution(t: Tables) -> DataFrame:
    return marts.lead_attribution(t.leads, t.opportunities)


@query
def customer_360(t: Tables) -> DataFrame:
    return shown(_c360(t), instants=["last_activity_at"])


@query
def intent_engagement(t: Tables) -> DataFrame:
    return shown(_intent(t), days=["event_date"])


@query
def sales_prioritization(t: Tables) -> DataFrame:
    return shown(_priority(t))


@query
def sales_performance(t: Tables) -> DataFrame:
    return shown(_performance(t))


@query
def lead_attribution(t: Tables) -> DataFrame:
    return shown(_attribution(t), days=["created_at", "conversion_date"])


@query
def customer_360_from_landed(t: Tables) -> DataFrame:
    """Landed CRM copies and JSON messages -> canonical tables -> identities -> events -> mart."""
    found = events.customer_events(t.landed_events, _identities(t, t.landed_events))
    mart = marts.customer_360(t.written_accounts, t.written_contacts, t.silver_opportunities, t.silver_reps, found, AS_OF)
    return shown(mart, instants=["last_activity_at"])


# Canonical CRM tables.

NOW = ("ingested_at",)
TIMES = ("created_at", "updated_at")


@query
def silver_account(t: Tables) -> DataFrame:
    return shown(t.silver_accounts, instants=TIMES, drop=NOW)


@query
def silver_contact(t: Tables) -> DataFrame:
    return shown(t.silver_contacts, instants=TIMES, drop=NOW)


@query
def silver_lead(t: Tables) -> DataFrame:
    return shown(t.silver_leads, instants=TIMES, drop=NOW)


@query
def silver_opportunity(t: Tables) -> DataFrame:
    return shown(t.silver_opportunities, days=["close_date"], instants=TIMES, drop=NOW)


@query
def silver_contact_role(t: Tables) -> DataFrame:
    return shown(t.silver_roles, instants=TIMES, drop=NOW)


@query
def silver_sales_rep(t: Tables) -> DataFrame:
    return shown(t.silver_reps, instants=TIMES, drop=NOW)


# Identity and events.


def _tuples(t: Tables) -> DataFrame:
    return stage(identity.identity_sources(t.identity_events, t.written_contacts, t.written_accounts), "tuples")


SEEN = ("first_seen_at", "last_seen_at")


@query
def identity_sources_union(t: Tables) -> DataFrame:
    return shown(_tuples(t), instants=SEEN)


@query
def identity_email_match(t: Tables) -> DataFrame:
    return shown(identity.match_email(_tuples(t), t.written_contacts), drop=SEEN)


@query
def identity_domain_match(t: Tables) -> DataFrame:
    return shown(identity.match_domain(_tuples(t), t.written_accounts), drop=SEEN)


def _groups(t: Tables) -> DataFrame:
    tuples = _tuples(t)
    matched = identity.match_domain(
        identity.match_email(tuples, t.written_contacts), t.written_accounts, hot_counts(tuples, ["domain"])
    )
    return identity.resolve_groups(matched)


@query
def identity_groups(t: Tables) -> DataFrame:
    return shown(_groups(t), instants=SEEN)


@query
def identity_stitch(t: Tables) -> DataFrame:
    return shown(identity.stitch(stage(_groups(t), "groups")), drop=SEEN)


@query
def identity_map(t: Tables) -> DataFrame:
    found = identity.identity_map(t.identity_events, t.written_contacts, t.written_accounts)
    return shown(found, instants=SEEN, drop=["updated_at"])


@query
def identity_map_with_existing(t: Tables) -> DataFrame:
    """The map made once more, with the first one as a source."""
    found = identity.identity_map(t.identity_events, t.written_contacts, t.written_accounts, _identities(t, t.identity_events))
    return shown(found, instants=SEEN, drop=["updated_at"])


@query
def identity_map_incremental(t: Tables) -> DataFrame:
    """The map of older events and older copies of the CRM records, brought up to date by the newer ones."""
    new = F.coalesce(F.col("timestamp") >= F.lit("2024-01-16").cast("timestamp"), F.lit(True))
    old_contacts, old_accounts = (
        stage(canonical(entity, landed.where(F.col("SystemModstamp") < "2024")), "older")
        for entity, landed in ((CONTACT, t.landed_contacts), (ACCOUNT, t.landed_accounts))
    )
    state = identity_update.first_state(t.identity_events.where(~new), old_contacts, old_accounts)
    state = identity_update.updated(state, t.identity_events.where(new), t.written_contacts, t.written_accounts)
    return shown(state["identities"], instants=SEEN, drop=["updated_at"])


@query
def silver_customer_event(t: Tables) -> DataFrame:
    return shown(events.customer_events(t.landed_events, _identities(t, t.landed_events)), instants=["event_timestamp"], drop=NOW)


@query
def events_json_parse(t: Tables) -> DataFrame:
    who = "identity_resolution"
    return t.parsed_events.select(
        "event_id",
        "event_type",
        instant("timestamp").alias("event_time"),
        *(F.col(f"{who}.{f}").alias(f) for f in ("sfdc_account_id", "anonymous_id", "email", "domain")),
        F.col("attributes")["url"].alias("url"),
        F.col("attributes")["duration_seconds"].alias("duration_seconds"),
        "_kafka_offset",
        "_kafka_partition",
        "_source_system",
    )


@query
def dedup_latest(t: Tables) -> DataFrame:
    return shown(t.leads.select("lead_id", "l_partkey", "l_suppkey", "l_extendedprice", "updated_at"), days=["updated_at"])


# Column functions.


@query
def normalize_email(t: Tables) -> DataFrame:
    return t.landed_contacts.select(
        "Id",
        "SystemModstamp",
        fn.normalize_email("Email").alias("email"),
        fn.email_domain("Email").alias("email_domain"),
    )


@query
def normalize_domain(t: Tables) -> DataFrame:
    accounts = t.landed_accounts.select(F.concat(F.lit("account "), "Id", "SystemModstamp").alias("origin"), "Website")
    pages = t.source("pages").select(F.concat(F.lit("page "), F.col("page_id")).alias("origin"), F.col("url"))
    return accounts.union(pages).select("origin", fn.normalize_domain("Website").alias("domain"))


@query
def clean_phone(t: Tables) -> DataFrame:
    return t.landed_accounts.select("Id", "SystemModstamp", fn.clean_phone("Phone").alias("phone"))


@query
def record_hash(t: Tables) -> DataFrame:
    return t.opportunities.select("opportunity_id", fn.record_hash(["account_id", "amount", "is_won", "owner_id"]).alias("record_hash"))


@query
def safe_casts(t: Tables) -> DataFrame:
    deals = t.landed_opportunities.select(
        F.concat("Id", "SystemModstamp").alias("origin"),
        fn.to_amount("Amount").cast("double").alias("amount"),
        fn.to_amount("Probability", 5, 2).cast("double").alias("probability"),
        day(fn.to_day("CloseDate")).alias("close_date"),
        fn.to_flag("IsWon", False).alias("is_won"),
        F.lit(None).cast("int").alias("employees"),
    )
    accounts = t.landed_accounts.select(
        F.concat(F.lit("account "), "Id", "SystemModstamp").alias("origin"),
        fn.to_amount("AnnualRevenue").cast("double").alias("amount"),
        F.lit(None).cast("double").alias("probability"),
        day(fn.to_day("Website")).alias("close_date"),
        fn.to_flag("Type", True).alias("is_won"),
        fn.to_whole("NumberOfEmployees").alias("employees"),
    )
    return deals.unionByName(accounts)


@query
def date_functions(t: Tables) -> DataFrame:
    return t.leads.select(
        "lead_id",
        F.date_format("updated_at", "yyyy-MM").alias("month"),
        F.datediff("updated_at", "created_at").alias("days_between"),
        day(F.date_sub("updated_at", 14)).alias("two_weeks_before"),
        instant(fn.to_instant(F.concat(F.col("updated_at").cast("string"), F.lit("T01:02:03Z")))).alias("parsed"),
    )


def _events_with(t: Tables, **columns: Column) -> DataFrame:
    return t.events.select("event_id", "event_type", *(c.alias(name) for name, c in columns.items()))


@query
def interaction_weight(t: Tables) -> DataFrame:
    return _events_with(t, interaction_weight=fn.interest_label("event_type"))


@query
def event_intent_weight(t: Tables) -> DataFrame:
    return _events_with(t, weight=fn.event_weight("event_type"))


@query
def recency_factor(t: Tables) -> DataFrame:
    days = F.datediff(marts.as_day(AS_OF), F.to_date("event_timestamp"))
    return _events_with(t, days=days, factor=fn.recency_factor(days), factor_of_unknown=fn.recency_factor(F.nullif(days, days)))


@query
def priority_band(t: Tables) -> DataFrame:
    score = F.col("c_acctbal") / 100
    return t.source("customer").select("c_custkey", fn.priority_band(score).alias("priority_band"))


@query
def public_domain_filter(t: Tables) -> DataFrame:
    domain = fn.email_domain("Email")
    return t.landed_contacts.select(
        "Id", "SystemModstamp", domain.alias("domain"), fn.company_domain(domain).alias("company_domain")
    )


@query
def clean_nonfinite(t: Tables) -> DataFrame:
    dirty = t.source("orders").selectExpr(
        "o_orderkey",
        """case o_orderkey % 4 when 0 then double('NaN') when 1 then double('Infinity') when 2 then double('-Infinity')
           else o_totalprice end as price""",
        "cast(case when o_orderkey % 5 = 0 then 'NaN' when o_orderkey % 5 = 1 then null else '1.5' end as float) as rate",
    )
    return serving.clean_nonfinite(dirty)


# Parts of the marts.


@query
def contacts_per_account(t: Tables) -> DataFrame:
    return marts.contacts_per_account(t.contacts)


@query
def opps_per_account(t: Tables) -> DataFrame:
    return marts.opportunities_per_account(t.opportunities)


@query
def trailing_activity(t: Tables) -> DataFrame:
    return shown(marts.activity_per_account(t.events, AS_OF), instants=["last_activity_at"])


@query
def intent_14d(t: Tables) -> DataFrame:
    return marts.recent_intent(_intent(t), AS_OF)


# Incremental landing and the event contract.


def _landed(t: Tables) -> dict[str, DataFrame]:
    return {
        "user": t.landed_users,
        "account": t.landed_accounts,
        "contact": t.landed_contacts,
        "lead": t.landed_leads,
        "opportunity": t.landed_opportunities,
        "opportunity_contact_role": t.landed_roles,
    }


# Marks from before all rows, between two copies, at the very time of one, and none.
EXTRACT_MARKS = {
    "user": "2024-01-01T23:59:59+00:00",
    "account": "2023-12-31T00:00:00Z",
    "contact": "2023-06-01T00:00:00Z",
    "lead": "1998-06-30T00:00:00Z",
    "opportunity_contact_role": "1997-01-01T01:00:00+01:00",
}
EARLIER_MARKS = {
    "user": "2024-01-02T08:30:00Z",
    "account": "2023-12-31T00:00:00Z",
    "opportunity": "2030-01-01T00:00:00Z",
    "opportunity_contact_role": "1990-01-01T00:00:00Z",
}


@query
def incremental_extract(t: Tables) -> DataFrame:
    """Rows of all six objects modified after a mark, in landing form without the time of the batch."""
    changed = [
        landing.extract(source, name, EXTRACT_MARKS.get(name), "batch").select(
            F.lit(name).alias("object_name"), "Id", "SystemModstamp", "_source_system", "_batch_id"
        )
        for name, source in _landed(t).items()
    ]
    return reduce(DataFrame.unionByName, changed)


@query
def high_water_mark(t: Tables) -> DataFrame:
    marks = [
        source.agg(
            instant(landing.high_water(EARLIER_MARKS.get(name))).alias("high_water"), F.count("*").alias("row_count")
        ).select(F.lit(name).alias("object_name"), "high_water", "row_count")
        for name, source in _landed(t).items()
    ]
    return reduce(DataFrame.unionByName, marks)


# Members of a message, each good or broken in one way (also used, as is, by the SQL side).
MESSAGE_MEMBERS = (
    """case when event_id % 41 = 0 then null when event_id % 59 = 0 then concat('"event_id":', event_id)
         when event_id % 31 = 0 then concat('"event_id":"bad ', event_id, '"')
         else concat('"event_id":"evt_', event_id, '"') end""",
    """case when event_id % 29 = 0 then '"event_type":"unknown_action"'
         when event_id % 83 = 0 then '"event_type":null'
         else concat('"event_type":"', case event_type when 'error' then 'website_visit' when 'view' then 'website_visit'
              when 'click' then 'product_page_view' when 'signup' then 'demo_request' else 'pricing_page_view' end, '"') end""",
    """case when event_id % 53 = 0 then '"timestamp":"yesterday"'
         when event_id % 89 = 0 then '"timestamp":1704067200'
         else '"timestamp":"2024-01-15T10:00:00Z"' end""",
    """case when event_id % 61 = 0 then '"identity_resolution":{"email":7,"domain":null}'
         when event_id % 47 = 0 then '"identity_resolution":{"email":"a@b.example.com","phone":"1"}'
         when event_id % 67 = 0 then '"identity_resolution":"none"'
         else concat('"identity_resolution":{"anonymous_id":"anon_', user_id, '","email":null}') end""",
    """case when event_id % 71 = 0 then '"attributes":[1]' when event_id % 73 = 0 then null
         else '"attributes":{"url":"/x","depth":{"k":[1,2]}}' end""",
    """case when event_id % 43 = 0 then '"channel":"web"' end""",
)
MESSAGE_TEXT = f"concat(case when event_id % 37 = 0 then '{{\"broken\":' else '{{' end, concat_ws(',', {', '.join(MESSAGE_MEMBERS)}), '}}')"


@query
def event_contract_violations(t: Tables) -> DataFrame:
    messages = t.spread_source("events").selectExpr("event_id as message_no", f"{MESSAGE_TEXT} as json_payload")
    return contract.with_violations(messages).select(
        "message_no", F.array_join("violations", ",").alias("violations"), F.size("violations").alias("violation_count")
    )


# Integrity and audit.


@query
def orphans_account_owner(t: Tables) -> DataFrame:
    return quality.orphan_keys(t.accounts, "owner_id", t.sales_reps, "sales_rep_id")


@query
def orphans_opportunity_owner(t: Tables) -> DataFrame:
    return quality.orphan_keys(t.opportunities, "owner_id", t.sales_reps, "sales_rep_id")


@query
def integrity_report(t: Tables) -> DataFrame:
    links = {
        "contact": t.silver_contacts.select("contact_id", "account_id"),
        "account": t.silver_accounts.select("account_id"),
        "opportunity": t.silver_opportunities.select("opportunity_id", "account_id"),
        "role": t.silver_roles.select("opportunity_id", "contact_id"),
    }
    return quality.integrity_report(*(stage(df, name) for name, df in links.items()))


@query
def mart_audit(t: Tables) -> DataFrame:
    c360 = stage(_c360(t), "c360")
    return quality.mart_audit(
        {
            "customer_360": (c360, "account_id"),
            "intent_engagement": (_intent(t), "account_id"),
            "sales_prioritization": (_priority(t, c360), "account_id"),
            "sales_performance": (_performance(t), "sales_rep_id"),
            "lead_attribution": (_attribution(t), "lead_id"),
        }
    )


# Serving.


@query
def serve_customers(t: Tables) -> DataFrame:
    return shown(serving.customers(_c360(t), industry="machinery", limit=20, offset=5))


@query
def serve_account(t: Tables) -> DataFrame:
    return shown(serving.customer(_c360(t), "acc_42"))


@query
def serve_intent(t: Tables) -> DataFrame:
    return shown(serving.intent_windows(_intent(t), limit=100, offset=10), days=["window_start_date", "window_end_date"])


@query
def serve_intent_latest(t: Tables) -> DataFrame:
    return shown(serving.latest_intent(_intent(t)), days=["event_date"])


@query
def top_priority_accounts(t: Tables) -> DataFrame:
    return serving.priorities(_priority(t), band="tier 2", limit=50)


@query
def serve_sales_performance(t: Tables) -> DataFrame:
    return serving.performance_by_rep(_performance(t), month="1997-05", limit=200)


@query
def serve_lead_attribution(t: Tables) -> DataFrame:
    return serving.leads(_attribution(t), lead_source="WEB", is_converted=True, limit=500, offset=50)


@query
def serve_customers_after(t: Tables) -> DataFrame:
    return shown(serving.customers(_c360(t), industry="MACHINERY", after="acc_5"))


@query
def serve_intent_after(t: Tables) -> DataFrame:
    page = serving.intent_windows(_intent(t), limit=200, after={"account_id": "acc_3"})
    return shown(page, days=["window_start_date", "window_end_date"])


@query
def top_priority_after(t: Tables) -> DataFrame:
    return serving.priorities(_priority(t), limit=300, after=(55.0, "acc_3"))


@query
def serve_sales_performance_after(t: Tables) -> DataFrame:
    return serving.performance_by_rep(_performance(t), limit=300, after=("srep_3", "1996-07"))


@query
def serve_lead_attribution_after(t: Tables) -> DataFrame:
    return serving.leads(_attribution(t), lead_source="partner", is_converted=False, limit=500, after=["led_2"])


@query
def account_names(t: Tables) -> DataFrame:
    return serving.account_names(_c360(t))


@query
def account_intent_lookup(t: Tables) -> DataFrame:
    return shown(serving.account_intent(_c360(t), _intent(t), "Customer#000000012"), days=["event_date"])


@query
def executive_kpis(t: Tables) -> DataFrame:
    c360 = stage(_c360(t), "c360")
    return serving.executive_kpis(c360, _priority(t, c360))


@query
def priority_distribution(t: Tables) -> DataFrame:
    return serving.count_by(_priority(t), "priority_band", "accounts")


@query
def event_type_breakdown(t: Tables) -> DataFrame:
    return serving.count_by(t.parsed_events, "event_type", "events")


@query
def lead_source_summary(t: Tables) -> DataFrame:
    return serving.lead_sources(_attribution(t))


@query
def rep_revenue_breakdown(t: Tables) -> DataFrame:
    return serving.rep_revenue(_performance(t))


# Schema discovery, on describe documents made from the part table: one per part, object = brand.

DESCRIBE_TEXT = """concat('{"name":"', p_brand, '","label":"Part ', p_partkey, '","fields":[',
  '{"name":"', p_type, '","label":"Type ', p_partkey, '","type":"string","nillable":', case when p_size % 2 = 0 then 'true' else 'false' end, '},',
  '{"name":"Size', p_size, '","label":"Size","type":"int","nillable":false}]}')"""


def _inventory(t: Tables) -> DataFrame:
    parts = t.source("part")
    described = parse_describes(parts.selectExpr("p_brand", f"{DESCRIBE_TEXT} as doc"), "p_brand", "doc")
    selected = (
        parts.where(F.col("p_size") % 3 > 0)
        .selectExpr(
            "p_brand as object_name",
            "explode(array(struct(p_type as field_name, 'Direct' as field_type), struct('Owner.Name' as field_name, 'Relationship Traversal' as field_type))) as s",
        )
        .select("object_name", "s.*")
        .distinct()
    )
    return catalog.field_inventory(described, selected)


@query
def field_inventory(t: Tables) -> DataFrame:
    keys = ["object_name", "field_name", "field_type", "data_type", "nillable", "selection"]
    return _inventory(t).groupBy(*keys).agg(F.count("*").alias("fields"), F.min("label").alias("first_label"))


@query
def field_count_pivot(t: Tables) -> DataFrame:
    required = _inventory(t).where(F.col("selection") == catalog.REQUIRED)
    return catalog.count_pivot(required, "object_name", "field_type", [catalog.DIRECT, catalog.RELATIONSHIP], "total_required")


@query
def names_per_group(t: Tables) -> DataFrame:
    required = _inventory(t).where(F.col("selection") == catalog.REQUIRED)
    return catalog.names_per_group(required, "object_name", "field_name")


# Global describe documents, one per supplier, with two objects each.
OBJECTS_TEXT = """concat('{"more":1,"sobjects":[{"name":"', replace(s_name, '#', '_'),
  case s_suppkey % 5 when 0 then '__c' when 1 then '__change_event' when 2 then '__Share' when 3 then '__History' else '' end,
  '","label":"Label ', s_suppkey, '","queryable":', case when s_suppkey % 2 = 0 then 'true' else 'false' end,
  ',"retrieveable":true,"createable":', case when s_suppkey % 3 = 0 then 'true' else 'false' end,
  ',"updateable":false,"custom":', case when s_suppkey % 5 = 0 then 'true' else 'false' end, ',"other":[1]},',
  '{"name":"Nation', s_nationkey, '","label":null,"queryable":true,"retrieveable":false,"createable":null,"updateable":true,"custom":false}]}')"""


def _objects(t: Tables) -> DataFrame:
    return catalog.object_inventory(parse_objects(t.source("supplier").selectExpr(f"{OBJECTS_TEXT} as doc"), "doc"))


@query
def object_inventory(t: Tables) -> DataFrame:
    return _objects(t)


@query
def object_type_breakdown(t: Tables) -> DataFrame:
    return serving.count_by(_objects(t), "object_type", "objects")


@query
def custom_objects(t: Tables) -> DataFrame:
    return catalog.custom_objects(_objects(t))


@query
def object_type_classify(t: Tables) -> DataFrame:
    named = t.source("orders").selectExpr(
        """concat('Obj', o_orderkey, case o_orderkey % 6 when 0 then '__c' when 1 then '__change_event' when 2 then '__Share'
             when 3 then '__History' when 4 then '__C' else '' end) as object_name"""
    )
    return named.select("object_name", catalog.object_class("object_name").alias("object_type"))
