from pathlib import Path

import pytest
from pyspark.sql import functions as F

from accountweave.operators.identity import identity_map
from accountweave.operators.quality import integrity_report
from accountweave.plans import marts, serving
from accountweave.plans.runs import build_gold, build_silver
from accountweave.plans.upkeep import days_of, refresh_days
from accountweave.sources import tables, versions
from accountweave.sources.landing import MarkLog, land_all
from accountweave.sources.tables import read_table, write_table
from checks.queries import QUERIES
from checks.tables import AS_OF, Tables


@pytest.fixture(scope="module")
def lake(spark, small_dir, tmp_path_factory):
    """Landed, canonical and mart tables of the small test data."""
    base = tmp_path_factory.mktemp("lake")
    t = Tables(spark, small_dir)
    sources = {
        "account": t.landed_accounts,
        "contact": t.landed_contacts,
        "lead": t.landed_leads,
        "opportunity": t.landed_opportunities,
        "user": t.landed_users,
    }
    bronze, silver, gold = (str(base / n) for n in ("bronze", "silver", "gold"))
    for name, df in sources.items():
        df.drop("_batch_id").write.parquet(str(base / "crm" / name))
    results = land_all(
        lambda name: spark.read.parquet(str(base / "crm" / name)),
        f"{bronze}/salesforce",
        MarkLog(spark, str(base / "marks")),
        objects=list(sources),
    )
    assert all(r.status == "landed" for r in results), results
    t.parsed_events.write.parquet(f"{bronze}/events")
    rows = build_silver(spark, bronze, silver) | build_gold(spark, silver, gold, AS_OF)
    return silver, gold, rows


def table(spark, base, name):
    return read_table(spark, base, name)


def test_row_counts_are_those_of_the_tables(spark, lake):
    silver, gold, rows = lake
    assert len(rows) == 13
    for name, count in rows.items():
        base = gold if name in ("customer_360", "intent_engagement", "sales_prioritization", "sales_performance", "lead_attribution") else silver
        assert table(spark, base, name).count() == count, name
    assert rows["opportunity_contact_role"] == 0 and rows["customer_event"] > 0


@pytest.mark.parametrize(
    ("mart", "key"),
    [
        ("customer_360", ["account_id"]),
        ("intent_engagement", ["account_id", "event_date"]),
        ("sales_prioritization", ["account_id"]),
        ("sales_performance", ["sales_rep_id", "month"]),
        ("lead_attribution", ["lead_id"]),
    ],
)
def test_mart_keys_are_unique_and_stamped(spark, lake, mart, key):
    df = table(spark, lake[1], mart)
    assert df.count() == df.select(*key).distinct().count() > 0
    assert df.where("gold_processed_at is null").count() == 0


def test_written_mart_equals_the_composed_query(spark, lake, small_dir):
    composed = QUERIES["customer_360_from_landed"](spark, small_dir)
    written = table(spark, lake[1], "customer_360").selectExpr(
        *(
            {"annual_revenue": "cast(annual_revenue as double) annual_revenue",
             "last_activity_at": "date_format(last_activity_at, 'yyyy-MM-dd HH:mm:ss') last_activity_at"}.get(c, c)
            for c in composed.columns
        )
    )
    assert sorted(map(repr, written.collect())) == sorted(map(repr, composed.collect()))


def test_daily_counts_add_up_to_the_resolved_events(spark, lake):
    silver, gold, _ = lake
    total = table(spark, gold, "intent_engagement").selectExpr("sum(engagement_score) as n").first().n
    assert total == table(spark, silver, "customer_event").where("account_id is not null").count()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_trailing_window_prunes_partitions_and_served_filters_reach_the_scan(spark, lake):
    gold = lake[1]
    recent = plan_of(marts.recent_intent(table(spark, gold, "intent_engagement"), AS_OF))
    assert "PartitionFilters: [isnotnull(event_date" in recent and "2024-01-17" in recent
    assert "ReadSchema: struct<account_id:string,engagement_score:bigint,intent_score:bigint>" in recent

    one = plan_of(serving.customer(table(spark, gold, "customer_360"), "acc_1"))
    assert "EqualTo(account_id,acc_1)" in one and "gold_processed_at" not in one
    best = plan_of(serving.priorities(table(spark, gold, "sales_prioritization"), sales_rep_id="srep_1"))
    assert "EqualTo(sales_rep_id,srep_1)" in best and "TakeOrderedAndProject" in best


@pytest.mark.parametrize(
    ("mart", "served", "pushed"),
    [
        ("customer_360", lambda m: serving.customers(m, industry="Machinery"), "EqualTo(industry_folded,machinery)"),
        ("customer_360", lambda m: serving.customers(m, after="acc_5"), "GreaterThan(account_id,acc_5)"),
        ("intent_engagement", lambda m: serving.intent_windows(m, after="acc_5"), "GreaterThan(account_id,acc_5)"),
        ("sales_prioritization", lambda m: serving.priorities(m, band="TIER 2"), "EqualTo(priority_band_folded,tier 2)"),
        ("sales_prioritization", lambda m: serving.priorities(m, after=(55.0, "acc_5")), "LessThanOrEqual(priority_score,55.0)"),
        ("sales_performance", lambda m: serving.performance_by_rep(m, after=("srep_3", "1996-07")), "GreaterThanOrEqual(sales_rep_id,srep_3)"),
        ("lead_attribution", lambda m: serving.leads(m, lead_source="WEB", is_converted=True), "EqualTo(lead_source_folded,web)"),
        ("lead_attribution", lambda m: serving.leads(m, is_converted=True), "EqualTo(is_converted,true)"),
        ("lead_attribution", lambda m: serving.leads(m, is_converted=False), "Or(Not(EqualTo(is_converted,true)),IsNull(is_converted))"),
        ("lead_attribution", lambda m: serving.leads(m, after="led_2"), "GreaterThan(lead_id,led_2)"),
    ],
)
def test_filters_and_page_bounds_reach_the_scan(spark, lake, mart, served, pushed):
    plan = plan_of(served(table(spark, lake[1], mart)))
    assert pushed in plan[plan.index("PushedFilters") :].replace(", ", ",")


def test_folded_columns_and_expressions_find_the_same_rows(spark, lake):
    for name, serve in (("customer_360", lambda m: serving.customers(m, industry="mAchinery", limit=500)), ("lead_attribution", lambda m: serving.leads(m, lead_source="pARTNER", limit=500))):
        mart = table(spark, lake[1], name)
        plain = mart.drop(*(c for c in mart.columns if c.endswith(serving.FOLDED_SUFFIX)))
        assert serve(mart).collect() == serve(plain).collect() != []


@pytest.mark.parametrize(
    ("mart", "serve", "key"),
    [
        ("customer_360", serving.customers, serving.CUSTOMER_KEY),
        ("intent_engagement", serving.intent_windows, serving.CUSTOMER_KEY),
        ("sales_prioritization", serving.priorities, serving.PRIORITY_KEY),
        ("sales_performance", serving.performance_by_rep, serving.PERFORMANCE_KEY),
    ],
)
def test_pages_by_key_are_the_pages_by_offset(spark, lake, mart, serve, key):
    """Walking by ``after`` gives every row once, in order."""
    df = table(spark, lake[1], mart)
    walked, last = [], None
    for _ in range(4):
        rows = serve(df, limit=37, after=last).collect()
        walked += rows
        if len(rows) < 37:
            break
        last = rows[-1]
    assert walked == serve(df, limit=148).collect()[: len(walked)] and len(walked) > 37
    with pytest.raises(ValueError):
        serve(df, after=("x",) * 5)
    with pytest.raises(ValueError):
        serve(df, after=walked[0], offset=1)


def test_point_lookups_skip_files(spark, lake):
    """The account id of a name bounds the scan of the intent mart."""
    c360, intent = (table(spark, lake[1], n) for n in ("customer_360", "intent_engagement"))
    name = c360.join(intent, "account_id", "left_semi").orderBy("account_id").first().account_name
    found = serving.account_intent(c360, intent, name)
    assert found.count() == 1
    plan = plan_of(found)
    assert "scalar-subquery" in plan or "Subquery" in plan
    assert "(account_id" in plan[plan.index("DataFilters") :]


def test_report_is_written(spark, lake):
    silver = lake[0]
    report = {r.rule: r.orphan_rows for r in table(spark, silver, "integrity_report").collect()}
    fresh = integrity_report(*(table(spark, silver, n) for n in ("contact", "account", "opportunity", "opportunity_contact_role")))
    assert report == {r.rule: r.orphan_rows for r in fresh.collect()} and len(report) == 4


def test_identities_can_be_updated(spark, lake, small_dir, tmp_path):
    silver = lake[0]
    bronze = silver.removesuffix("silver") + "bronze"
    before = table(spark, silver, "identity").drop("updated_at").collect()
    build_silver(spark, bronze, silver, update_identities=True)
    after = table(spark, silver, "identity").drop("updated_at").collect()
    assert {r.identity_id for r in before} == {r.identity_id for r in after}


def test_a_failed_update_keeps_every_identity(spark, lake, monkeypatch):
    """The write of the new map dies with files on disk; the map before counts until a rerun has succeeded."""
    silver = lake[0]
    bronze = silver.removesuffix("silver") + "bronze"
    before = {r.identity_id for r in table(spark, silver, "identity").collect()}
    write = tables.write_counted

    def dies(df, path, *args, **options):
        rows = write(df, path, *args, **options)
        if "/identity/" in path:
            raise OSError("lost the driver")
        return rows

    monkeypatch.setattr(tables, "write_counted", dies)
    with pytest.raises(OSError):
        build_silver(spark, bronze, silver, update_identities=True)
    assert {r.identity_id for r in table(spark, silver, "identity").collect()} == before
    monkeypatch.undo()
    build_silver(spark, bronze, silver, update_identities=True)
    assert {r.identity_id for r in table(spark, silver, "identity").collect()} == before


def test_incremental_identities_equal_a_rebuild(spark, lake, tmp_path):
    """A first run, a run with a second half of the events, and a run with nothing new."""
    bronze = lake[0].removesuffix("silver") + "bronze"
    events = spark.read.parquet(f"{bronze}/events")
    base = str(tmp_path)
    for name in ("account", "contact", "lead", "opportunity", "user"):
        spark.read.parquet(f"{bronze}/salesforce/{name}").write.parquet(f"{base}/salesforce/{name}")
    early = F.col("_kafka_offset") % 3 > 0
    stamped = events.withColumn("_ingested_at", F.when(early, F.lit("2024-03-01")).otherwise(F.lit("2024-03-02")).cast("timestamp"))
    stamped.where(early).write.parquet(f"{base}/events")
    rows = build_silver(spark, base, f"{base}/silver", incremental_identities=True)
    assert rows["identity"] > 0
    stamped.where(~early).write.mode("append").parquet(f"{base}/events")
    build_silver(spark, base, f"{base}/silver", incremental_identities=True)
    want = identity_map(stamped, *(table(spark, f"{base}/silver", n) for n in ("contact", "account"))).drop("updated_at")
    for _ in range(2):
        got = table(spark, f"{base}/silver", "identity").drop("updated_at").select(*want.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        build_silver(spark, base, f"{base}/silver", incremental_identities=True)


def files_below(folder):
    return {str(f.relative_to(folder)): f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}


def test_late_events_change_only_their_days(spark, lake, tmp_path):
    """Days with new events, a day that loses its last resolved event, and a day that had none."""
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    events = table(spark, lake[0], "customer_event")
    days = [r.event_day for r in events.where("account_id is not null").select("event_day").distinct().orderBy("event_day").limit(4).collect()]
    first = events.where(f"event_day <> '{days[3]}'")
    write_table(first, silver, "customer_event", ["event_day"])
    assert refresh_days(spark, silver, gold, []) == 0
    refresh_days(spark, silver, gold, [r.event_day for r in first.select("event_day").distinct().collect() if r.event_day])
    folder = Path(versions.current(spark, f"{gold}/intent_engagement"))
    before = files_below(folder)

    late = events.where(f"event_day in ('{days[0]}', '{days[3]}')").withColumn("event_id", F.concat("event_id", F.lit("-late")))
    gone = F.when(F.col("event_day") != F.lit(days[1]), F.col("account_id"))
    now = first.withColumn("account_id", gone).unionByName(late)
    write_table(now, silver, "customer_event", ["event_day"])
    assert refresh_days(spark, silver, gold, [*days_of(late), days[1]]) > 0
    after = files_below(folder)
    touched = {f"event_date={d}" for d in (days[0], days[1], days[3])}
    assert {n: t for n, t in before.items() if n.split("/")[0] not in touched} == {n: t for n, t in after.items() if n.split("/")[0] not in touched}
    assert not any(n.startswith(f"event_date={days[1]}/") for n in after) and any(n.startswith(f"event_date={days[3]}/") for n in after)
    got = table(spark, gold, "intent_engagement").drop("gold_processed_at")
    want = marts.intent_engagement(table(spark, silver, "customer_event")).select(*got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    plan = plan_of(marts.intent_engagement(read_table(spark, silver, "customer_event").where(F.col("event_day").isin(days[0]))))
    assert "PartitionFilters: [isnotnull(event_day" in plan


def test_versions(spark, tmp_path):
    """A new version may be made from the one before; old ones go, and what a dead writer left."""
    base = str(tmp_path)
    write_table(spark.range(5), base, "t")
    for n in (6, 7, 8):
        known = read_table(spark, base, "t")
        assert write_table(known.union(spark.range(1)), base, "t") == n
    (tmp_path / "t" / "version-20000101T000000000000-dead").mkdir()
    assert write_table(spark.range(3), base, "t", mode="append") == 3 and read_table(spark, base, "t").count() == 11
    write_table(spark.range(2), base, "t")
    names = [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("version-")]
    assert len(names) == 2 and not any("dead" in n for n in names)
    assert read_table(spark, base, "t").count() == 2
    with pytest.raises(ValueError):
        write_table(spark.range(2), base, "t", mode="ignore")
