import pytest
from pyspark.sql import functions as F

from accountweave.operators.events import customer_events
from accountweave.operators.identity import identity_map, identity_sources
from accountweave.schemas import LANDED_EVENT

FIELDS = ("sfdc_contact_id", "sfdc_account_id", "anonymous_id", "email", "domain")


def events_of(spark, *rows):
    """Rows: dicts of identity fields, with optional ts, id, type."""
    data = [
        (r.get("id", f"evt_{i}"), r.get("type", "website_visit"), r.get("ts", f"2026-02-01T10:{i:02d}:00Z"),
         tuple(r.get(f) for f in FIELDS), r.get("attributes"))
        for i, r in enumerate(rows)
    ]
    schema = "event_id string, event_type string, timestamp string, identity_resolution struct<" + ",".join(f"{f}:string" for f in FIELDS)
    return spark.createDataFrame(data, schema + ">, attributes map<string,string>")


def contacts_of(spark, *rows):
    return spark.createDataFrame(
        [(c, a, e, c.removeprefix("cnt_"), "2026-01-01T00:00:00Z") for c, a, e in rows],
        "contact_id string, account_id string, email string, source_record_id string, updated_at string",
    )


def accounts_of(spark, *rows):
    return spark.createDataFrame(
        [(a, w, a.removeprefix("acc_"), "2026-01-01T00:00:00Z") for a, w in rows],
        "account_id string, website string, source_record_id string, updated_at string",
    )


def by_key(df):
    return {(r.anonymous_id, r.email, r.domain): (r.contact_id, r.account_id) for r in df.collect()}


LEE = ("cnt_L5", "acc_M2", "lee@mill.example")
MILL = ("acc_M2", "mill.example")


def test_earlier_visits_get_the_later_known_identity(spark):
    """Three visits of one visitor, the middle one with an address, and a stranger on the same site."""
    events = events_of(
        spark,
        {"anonymous_id": "b-1", "domain": "gmail.com"},
        {"anonymous_id": "b-1", "email": " LEE@mill.example"},
        {"anonymous_id": "b-1", "domain": "http://news.example/a"},
        {"anonymous_id": "b-2", "domain": "news.example"},
    )
    rows = by_key(identity_map(events, contacts_of(spark, LEE), accounts_of(spark, MILL)))
    known = ("cnt_L5", "acc_M2")
    assert [rows[("b-1", *k)] for k in ((None, None), ("lee@mill.example", None), (None, "news.example"))] == [known] * 3
    assert rows[("b-2", None, "news.example")] == (None, None)


def test_order_of_trust(spark):
    events = events_of(
        spark,
        {"anonymous_id": "direct", "email": "lee@mill.example", "sfdc_contact_id": "X", "sfdc_account_id": "Y"},
        {"anonymous_id": "mail", "email": "lee@mill.example", "domain": "https://www.other.com/x"},
        {"anonymous_id": "site", "domain": "other.com"},
        {"anonymous_id": "public", "domain": "gmail.com"},
        {"anonymous_id": "nobody", "email": "who@nowhere.org", "domain": "nowhere.org"},
    )
    rows = by_key(identity_map(events, contacts_of(spark, LEE), accounts_of(spark, MILL, ("acc_2", "other.com"), ("acc_3", "gmail.com"))))
    assert rows[("direct", "lee@mill.example", None)] == ("cnt_X", "acc_Y")
    assert rows[("mail", "lee@mill.example", "other.com")] == ("cnt_L5", "acc_M2")
    assert rows[("site", None, "other.com")] == (None, "acc_2")
    assert rows[("public", None, None)] == (None, None)
    assert rows[("nobody", "who@nowhere.org", "nowhere.org")] == (None, None)


def test_rows_without_a_visitor_are_not_stitched_to_each_other(spark):
    contacts = contacts_of(spark, LEE, ("cnt_9", "acc_9", "zoe@zed.com"), ("cnt_8", None, "kim@gmail.com"))
    rows = by_key(identity_map(events_of(spark, {}), contacts, accounts_of(spark, MILL, ("acc_9", "zed.com"))))
    assert rows[(None, "lee@mill.example", "mill.example")] == ("cnt_L5", "acc_M2")
    assert rows[(None, "zoe@zed.com", "zed.com")] == ("cnt_9", "acc_9")
    assert rows[(None, "kim@gmail.com", None)] == ("cnt_8", None)
    assert rows[(None, None, "mill.example")] == (None, "acc_M2")
    assert (None, None, None) not in rows


def test_shared_emails_and_domains_do_not_multiply_rows(spark):
    contacts = contacts_of(spark, ("cnt_2", "acc_2", "a@x.com"), ("cnt_1", "acc_1", "a@x.com"))
    accounts = accounts_of(spark, ("acc_2", "x.com"), ("acc_1", "x.com"))
    found = identity_map(events_of(spark, {"anonymous_id": "v", "email": "a@x.com"}, {"anonymous_id": "w", "domain": "x.com"}), contacts, accounts)
    rows = by_key(found)
    assert found.count() == len(rows) == found.select("identity_id").distinct().count()
    assert rows[("v", "a@x.com", None)] == ("cnt_1", "acc_1")
    assert rows[("w", None, "x.com")] == (None, "acc_1")


def test_account_goes_with_the_greatest_contact(spark):
    events = events_of(
        spark,
        {"anonymous_id": "v", "email": "1", "sfdc_contact_id": "5", "sfdc_account_id": "1"},
        {"anonymous_id": "v", "email": "2", "sfdc_contact_id": "7"},
        {"anonymous_id": "v", "email": "3", "sfdc_account_id": "9"},
    )
    rows = by_key(identity_map(events, contacts_of(spark, LEE), accounts_of(spark, MILL)))
    assert {v for k, v in rows.items() if k[0] == "v"} == {("cnt_7", "acc_1")}


def test_earlier_map_is_carried_on(spark):
    contacts, accounts = contacts_of(spark, LEE), accounts_of(spark, MILL)
    first = identity_map(events_of(spark, {"anonymous_id": "v", "email": "lee@mill.example", "ts": "2026-01-05T00:00:00Z"}), contacts, accounts)
    later = identity_map(events_of(spark, {"anonymous_id": "v", "ts": "2026-03-05T00:00:00Z"}), contacts, accounts, first)
    rows = by_key(later)
    assert rows[("v", None, None)] == rows[("v", "lee@mill.example", None)] == ("cnt_L5", "acc_M2")
    kept = later.where("anonymous_id = 'v' and email is not null").selectExpr("cast(first_seen_at as string) f").first()
    assert kept.f == "2026-01-05 00:00:00"


def test_times_and_pre_aggregation(spark):
    busy = [{"anonymous_id": "bot", "ts": f"2026-02-01T{h:02d}:00:00Z"} for h in range(24)]
    tuples = identity_sources(events_of(spark, *busy), contacts_of(spark, LEE), accounts_of(spark, MILL))
    row = tuples.where("anonymous_id = 'bot'").selectExpr("cast(first_seen_at as string) f", "cast(last_seen_at as string) l").collect()
    assert [tuple(r) for r in row] == [("2026-02-01 00:00:00", "2026-02-01 23:00:00")]


def test_salted_lookups_give_the_same_map(spark, no_broadcast):
    rows = [
        {"anonymous_id": "bot" if i % 3 == 0 else f"v{i}", "email": "lee@mill.example" if i % 2 else f"u{i}@z.com", "domain": ["mill.example", "gmail.com", None][i % 3]}
        for i in range(60)
    ]
    inputs = (events_of(spark, *rows), contacts_of(spark, LEE), accounts_of(spark, MILL))
    salted, plain = identity_map(*inputs, hot_rows=3), identity_map(*inputs)
    drop = ("updated_at",)
    assert sorted(map(tuple, salted.drop(*drop).collect()), key=repr) == sorted(map(tuple, plain.drop(*drop).collect()), key=repr)
    events = inputs[0]
    left = customer_events(events, salted, hot_rows=3).drop("ingested_at").collect()
    right = customer_events(events, plain).drop("ingested_at").collect()
    assert sorted(map(tuple, left), key=repr) == sorted(map(tuple, right), key=repr) and len(left) == 60


@pytest.fixture
def identities(spark):
    return spark.createDataFrame(
        [("i1", "anon_1", None, None, "cnt_1", None), ("i2", None, "jo@mill.example", "mill.example", "cnt_2", "acc_2")],
        "identity_id string, anonymous_id string, email string, domain string, contact_id string, account_id string",
    )


def test_event_columns_and_links(spark, identities):
    events = events_of(
        spark,
        {"id": "evt_1", "type": "pricing_page_view", "anonymous_id": "anon_1", "email": " Jo@mill.example", "domain": "http://mill.example/x",
         "attributes": {"url": "https://mill.example/pricing", "plan_interest": "enterprise", "duration_seconds": "45.9"}},
        {"id": "evt_2", "email": "jo@mill.example"},
        {"id": "evt_3", "anonymous_id": "other"},
        {"id": "evt_4"},
        {"id": None},
    )
    rows = {r.event_id: r for r in customer_events(events, identities).collect()}
    assert set(rows) == {"evt_1", "evt_2", "evt_3", "evt_4"}
    one = rows["evt_1"]
    assert (one.contact_id, one.account_id) == ("cnt_1", "acc_2")  # per column: id match first, then email match
    assert (one.email, one.domain, one.interaction_weight) == ("jo@mill.example", "mill.example", "high")
    assert (one.url, one.plan_interest, one.duration_seconds) == ("https://mill.example/pricing", "enterprise", 45)
    assert '"url":"https://mill.example/pricing"' in one.attributes and len(one.record_hash) == 64 and len(one) == 17
    assert (rows["evt_2"].contact_id, rows["evt_2"].account_id) == ("cnt_2", "acc_2")
    assert (rows["evt_3"].contact_id, rows["evt_4"].account_id) == (None, None)


def test_attributes_may_be_a_struct(spark, identities):
    events = events_of(spark, {"id": "evt_1", "attributes": {"url": "u", "duration_seconds": "5"}})
    typed = events.withColumn(
        "attributes",
        F.struct(F.col("attributes.url").alias("url"), F.lit(None).cast("string").alias("plan_interest"), F.lit(5).alias("duration_seconds")),
    )
    row = customer_events(typed, identities).first()
    assert (row.url, row.plan_interest, row.duration_seconds) == ("u", None, 5)


def test_newest_copy_of_an_event_counts(spark, identities):
    copies = events_of(
        spark,
        {"id": "evt_1", "ts": "2026-02-01T10:00:00Z", "type": "website_visit"},
        {"id": "evt_1", "ts": "2026-02-01T11:00:00Z", "type": "demo_request"},
    )
    assert [r.event_type for r in customer_events(copies, identities).collect()] == ["demo_request"]


def test_empty_inputs(spark):
    none = spark.createDataFrame([], LANDED_EVENT)
    found = identity_map(none, contacts_of(spark, LEE).limit(0), accounts_of(spark, MILL).limit(0))
    assert found.count() == 0
    assert customer_events(none, found).count() == 0
