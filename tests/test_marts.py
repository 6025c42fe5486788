import datetime as dt

import pytest
from pyspark.sql import functions as F

from accountweave.plans import marts, serving

AS_OF = "2026-08-18"


def day(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def accounts(spark):
    return spark.createDataFrame(
        [("acc_1", "Mill", "Paper", 0, 7.5e5, "mill.example", "srep_1"), ("acc_2", "Beta", None, None, None, None, None)],
        "account_id string, account_name string, industry string, employee_count int, annual_revenue double, website string, owner_id string",
    )


@pytest.fixture
def reps(spark):
    return spark.createDataFrame([("srep_1", "Rae", "rae@x.com"), ("srep_2", "Sam", "sam@x.com")], "sales_rep_id string, name string, email string")


@pytest.fixture
def opportunities(spark):
    return spark.createDataFrame(
        [
            ("opp_1", "acc_1", 41750.25, False, False, "srep_1", dt.date(2026, 8, 1)),
            ("opp_2", "acc_1", 980.5, True, True, "srep_1", dt.date(2026, 8, 2)),
            ("opp_3", "acc_1", None, True, False, "srep_1", dt.date(2026, 8, 3)),
            ("opp_4", None, 10.0, True, True, None, dt.date(2026, 8, 3)),
            ("opp_5", "acc_9", 10.0, True, False, "srep_2", dt.date(2026, 7, 3)),
            ("opp_6", "acc_9", 10.0, True, True, "srep_404", None),
        ],
        "opportunity_id string, account_id string, amount double, is_closed boolean, is_won boolean, owner_id string, close_date date",
    )


@pytest.fixture
def events(spark):
    return spark.createDataFrame(
        [
            ("e1", "acc_1", "website_visit", day("2026-08-17T10:00:00+00:00"), 100),
            ("e2", "acc_1", "demo_request", day("2026-08-17T11:00:00+00:00"), 50),
            ("e3", "acc_1", "pricing_page_view", day("2026-08-11T00:00:00+00:00"), 60),
            ("e4", "acc_1", "pricing_page_view", day("2026-08-10T23:59:59+00:00"), None),
            ("e5", "acc_1", "other", day("2026-07-01T10:00:00+00:00"), 1),
            ("e6", None, "demo_request", day("2026-08-17T10:00:00+00:00"), 9),
            ("e7", "acc_1", "website_visit", day("2026-09-17T10:00:00+00:00"), 1),
        ],
        "event_id string, account_id string, event_type string, event_timestamp timestamp, duration_seconds int",
    )


@pytest.fixture
def contacts(spark):
    return spark.createDataFrame([("c1", "acc_1"), ("c2", "acc_1"), ("c3", None)], "contact_id string, account_id string")


@pytest.fixture
def c360(accounts, contacts, opportunities, reps, events):
    return marts.customer_360(accounts, contacts, opportunities, reps, events, AS_OF)


def test_customer_360(c360):
    rows = {r.account_id: r for r in c360.collect()}
    mill, beta = rows["acc_1"], rows["acc_2"]
    assert mill.contact_count == 2
    assert (mill.open_opportunity_count, mill.open_pipeline_value) == (1, 41750.25)
    assert (mill.won_opportunity_count, mill.won_pipeline_value, mill.lost_opportunity_count) == (1, 980.5, 1)
    assert (mill.sales_rep_id, mill.sales_rep_name, mill.sales_rep_email) == ("srep_1", "Rae", "rae@x.com")
    assert (mill.events_last_7d, mill.events_last_30d) == (4, 5)  # no upper bound: the later event counts
    assert (beta.contact_count, beta.open_pipeline_value, beta.events_last_7d) == (0, 0.0, 0)
    assert beta.last_activity_at is None and beta.sales_rep_name is None and len(mill) == 18


def test_upper_bound(accounts, contacts, opportunities, reps, events):
    row = marts.customer_360(accounts, contacts, opportunities, reps, events, AS_OF, upper_bound=True).where("account_id = 'acc_1'").first()
    assert (row.events_last_7d, row.events_last_30d) == (3, 4)


def test_intent_engagement(events):
    rows = {(r.account_id, str(r.event_date)): r for r in marts.intent_engagement(events).collect()}
    assert set(rows) == {("acc_1", d) for d in ("2026-08-17", "2026-08-11", "2026-08-10", "2026-07-01", "2026-09-17")}
    busy = rows[("acc_1", "2026-08-17")]
    assert (busy.website_visits, busy.demo_requests, busy.pricing_views) == (1, 1, 0)
    assert (busy.total_duration_seconds, busy.engagement_score, busy.intent_score) == (150, 2, 16)
    assert rows[("acc_1", "2026-08-10")].total_duration_seconds == 0
    assert rows[("acc_1", "2026-07-01")].intent_score == 0 and len(busy) == 11


def test_prioritization_hot_and_cold(spark):
    c360 = spark.createDataFrame(
        [("hot", "Hot", "r1", "Rae", 1_500_000.0, 2, day("2026-08-17T00:00:00+00:00")), ("cold", "Cold", None, None, 0.0, 0, None)],
        "account_id string, account_name string, sales_rep_id string, sales_rep_name string, open_pipeline_value double, open_opportunity_count int, last_activity_at timestamp",
    )
    intent = spark.createDataFrame(
        [("hot", dt.date(2026, 8, 4), 30, 3), ("hot", dt.date(2026, 8, 16), 30, 2), ("hot", dt.date(2026, 8, 3), 99, 9)],
        "account_id string, event_date date, intent_score int, engagement_score int",
    )
    rows = {r.account_id: r for r in marts.sales_prioritization(c360, intent, AS_OF).collect()}
    hot, cold = rows["hot"], rows["cold"]
    assert (hot.intent_score, hot.engagement_score, hot.days_since_last_activity) == (60, 5, 1)
    assert (hot.priority_score, hot.priority_band) == (92.5, "Tier 1")
    assert (cold.intent_score, cold.days_since_last_activity, cold.priority_score, cold.priority_band) == (0, 999, 2.0, "Tier 3")
    assert len(hot) == 11


def test_sales_performance(opportunities, reps):
    rows = {(r.sales_rep_id, r.month): r for r in marts.sales_performance(opportunities, reps).collect()}
    assert set(rows) == {("srep_1", "2026-08"), ("srep_2", "2026-07")}
    august = rows[("srep_1", "2026-08")]
    assert (august.opportunities_closed, august.won_opportunities, august.lost_opportunities) == (3, 1, 1)
    assert (august.pipeline_closed, august.won_revenue, august.open_revenue) == (42730.75, 980.5, 41750.25) and (august.win_rate, august.average_deal_size) == (33.33, 980.5)
    july = rows[("srep_2", "2026-07")]
    assert (july.win_rate, july.average_deal_size) == (0.0, 0.0) and len(july) == 11


@pytest.fixture
def attribution(spark, opportunities):
    leads = spark.createDataFrame(
        [
            ("l1", "Web", "Closed", "Hot", day("2026-08-01T23:00:00+00:00"), day("2026-08-11T01:00:00+00:00"), True, "acc_1", "c1", "opp_2"),
            ("l2", None, "Open", None, day("2026-08-01T00:00:00+00:00"), day("2026-08-11T00:00:00+00:00"), False, None, None, None),
            ("l3", "web", "Closed", None, day("2026-08-01T00:00:00+00:00"), day("2026-08-01T00:00:00+00:00"), True, None, None, "opp_404"),
        ],
        "lead_id string, lead_source string, status string, rating string, created_at timestamp, updated_at timestamp, is_converted boolean, converted_account_id string, converted_contact_id string, converted_opportunity_id string",
    )
    return marts.lead_attribution(leads, opportunities)


def test_lead_attribution(attribution):
    rows = {r.lead_id: r for r in attribution.collect()}
    won, open_lead, lost = rows["l1"], rows["l2"], rows["l3"]
    assert (str(won.conversion_date), won.days_to_conversion) == ("2026-08-11", 10)
    assert (won.converted_opportunity_amount, won.is_won_deal) == (980.5, True)
    assert (open_lead.conversion_date, open_lead.days_to_conversion) == (None, None)
    assert (open_lead.converted_opportunity_amount, open_lead.is_won_deal) == (0.0, False)
    assert (lost.days_to_conversion, lost.converted_opportunity_amount, lost.is_won_deal) == (0, 0.0, False)
    assert len(won) == 13


def test_salted_paths_agree(accounts, contacts, opportunities, reps, events, c360, no_broadcast):
    salted = marts.customer_360(accounts, contacts, opportunities, reps, events, AS_OF, hot_rows=1)
    assert sorted(map(repr, salted.collect())) == sorted(map(repr, c360.collect()))


# Serving.


def test_served_customers(c360):
    assert [r.account_id for r in serving.customers(c360).collect()] == ["acc_1", "acc_2"]
    assert [r.account_id for r in serving.customers(c360, industry="PAPER").collect()] == ["acc_1"]
    assert [r.account_id for r in serving.customers(c360, limit=1, offset=1).collect()] == ["acc_2"]
    assert serving.customer(c360, "acc_1").first().won_pipeline_value == 980.5
    assert serving.customer(c360, "acc_404").count() == 0


@pytest.mark.parametrize(("limit", "offset"), [(0, 0), (501, 0), (10, -1)])
def test_page_bounds(c360, limit, offset):
    with pytest.raises(ValueError):
        serving.customers(c360, limit=limit, offset=offset)


def test_served_intent(events):
    intent = marts.intent_engagement(events)
    row = serving.intent_windows(intent, "acc_1").first()
    assert (str(row.window_start_date), str(row.window_end_date), row.pricing_views, row.intent_score) == ("2026-07-01", "2026-09-17", 2, 33.0)
    assert [str(r.event_date) for r in serving.latest_intent(intent).collect()] == ["2026-09-17"]
    assert serving.latest_intent(intent, "acc_2").count() == 0


def test_served_priorities(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [("a", "A", "r", "R", 1, 0.0, 50.0, "Tier 2"), ("b", "B", "r", "R", 1, 0.0, 60.0, "Tier 2"), ("c", "C", None, None, 1, 0.0, nan, "Tier 2"), ("d", "D", "r", "R", 1, 0.0, 60.0, "Tier 2"), ("e", "E", "s", "S", 1, 0.0, 90.0, "Tier 1")],
        "account_id string, account_name string, sales_rep_id string, sales_rep_name string, intent_score int, open_pipeline_value double, priority_score double, priority_band string",
    )
    assert [r.account_id for r in serving.priorities(df).collect()] == ["e", "b", "d", "a", "c"]
    assert [r.account_id for r in serving.priorities(df, band="tier 2", limit=2).collect()] == ["b", "d"]
    assert [r.account_id for r in serving.priorities(df, sales_rep_id="s").collect()] == ["e"]
    assert serving.priorities(df).where("account_id = 'c'").first().priority_score is None
    plan = serving.priorities(df, limit=2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_served_performance_and_leads(opportunities, reps, attribution):
    performance = marts.sales_performance(opportunities, reps)
    row = serving.performance_by_rep(performance, sales_rep_id="srep_1", month="2026-08").first()
    assert (row.total_opportunities, row.won_pipeline_value, row.avg_deal_size, row.open_pipeline_value) == (3, 980.5, 980.5, 41750.25)
    assert [r.lead_id for r in serving.leads(attribution, lead_source="WEB", is_converted=True).collect()] == ["l1", "l3"]
    assert [r.lead_id for r in serving.leads(attribution, is_converted=False).collect()] == ["l2"]
    sources = {r.lead_source: tuple(r)[1:] for r in serving.lead_sources(attribution).collect()}
    assert sources == {"Web": (1, 1, 1, 980.5), "web": (1, 1, 0, 0.0)}
    money = {r.sales_rep_name: tuple(r)[2:] for r in serving.rep_revenue(performance).collect()}
    assert money == {"Rae": (980.5, 41750.25, 42730.75), "Sam": (0.0, 0.0, 10.0)}
    namesakes = performance.withColumn("sales_rep_name", F.lit("Rae"))
    assert sorted(r.all_pipeline_value for r in serving.rep_revenue(namesakes).collect()) == [10.0, 42730.75]


def test_key_figures(c360, events):
    prioritized = marts.sales_prioritization(c360, marts.intent_engagement(events), AS_OF)
    kpis = serving.executive_kpis(c360, prioritized).first()
    assert tuple(kpis)[:3] == (2, 41750.25, 980.5)
    assert kpis.tier_1_accounts == prioritized.where("priority_band = 'Tier 1'").count()
    empty = serving.executive_kpis(c360.limit(0), prioritized.limit(0)).first()
    assert tuple(empty) == (0, 0.0, 0.0, 0)
    assert {r.account_name for r in serving.account_names(c360).collect()} == {"Mill", "Beta"}
    found = serving.account_intent(c360, marts.intent_engagement(events), "Mill").collect()
    assert [(r.account_id, str(r.event_date)) for r in found] == [("acc_1", "2026-09-17")]
    assert serving.account_intent(c360, marts.intent_engagement(events), "Nobody").count() == 0


def test_nonfinite_values_become_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (float("inf"), 2), (float("-inf"), 3), (1.5, 4), (None, 5)], "x double, n int")
    assert [r.x for r in serving.clean_nonfinite(df).orderBy("n").collect()] == [None, None, None, 1.5, None]
