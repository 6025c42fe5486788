"""Runs: landed tables -> canonical tables -> marts.

Each table is written once and its readers read the written table. Nothing is computed twice, no cache has to hold a
large table, and a lost executor costs one stage of one table, not a long chain. A table is replaced by a new version, which
counts once it is whole; a run that dies leaves every table as it was or as it should be.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from accountweave.operators import identity_update
from accountweave.operators.crm import ENTITIES, canonical
from accountweave.operators.events import customer_events
from accountweave.operators.identity import identity_map
from accountweave.operators.quality import integrity_report
from accountweave.plans import marts
from accountweave.plans.serving import FOLDED, with_folded
from accountweave.schemas import IDENTITY, LANDED_EVENT, landed_crm
from accountweave.sources import versions
from accountweave.sources.tables import first_table_or_empty, read_table, write_mart, write_table

# Folder names under which these tables may have been landed.
ROLE_FOLDERS = (
    "salesforce/opportunity_contact_role",
    "salesforce/opportunitycontactrole",
    "salesforce/opportunity_contact_roles",
)
EVENT_FOLDERS = ("events/customer_events", "events", "customer_events")

#: Folder column of the canonical events, so that one day of them can be read alone.
EVENT_DAY = "event_day"

REQUIRED_OBJECTS = ("user", "account", "contact", "lead", "opportunity")


def landed_tables(spark: SparkSession, bronze: str) -> dict[str, DataFrame]:
    tables = {name: read_table(spark, bronze, f"salesforce/{name}") for name in REQUIRED_OBJECTS}
    roles = "opportunity_contact_role"
    tables[roles] = first_table_or_empty(spark, [f"{bronze}/{f}" for f in ROLE_FOLDERS], landed_crm(roles))
    tables["events"] = first_table_or_empty(spark, [f"{bronze}/{f}" for f in EVENT_FOLDERS], LANDED_EVENT)
    return tables


def current_identities(spark: SparkSession, events: DataFrame, contacts: DataFrame, accounts: DataFrame, silver: str) -> DataFrame:
    """The identity map by an update of the last one (see ``identity_update``), or by a full build when there is none.

    New events are those landed at or after the latest landing time that the last state holds; events of that very time
    are taken twice, which changes nothing. The tables of a state and that time are one version and count together.
    """
    table = f"{silver}/identity_state"
    last, folder = versions.current(spark, table), versions.new_version(table)
    mark = versions.read_text(spark, f"{last}/mark") if last else None
    fresh = events.where(F.col("_ingested_at") >= F.lit(mark).cast("timestamp")) if mark else events
    seen = Observation("landing time of events")
    fresh = fresh.observe(seen, F.max("_ingested_at").cast("string").alias("mark"))
    if last:
        known = {name: spark.read.parquet(f"{last}/{name}") for name in identity_update.TABLES}
        state = identity_update.updated(known, fresh, contacts, accounts, folder)
    else:
        state = identity_update.first_state(fresh, contacts, accounts, folder)
    versions.write_text(spark, f"{folder}/mark", seen.get["mark"] or mark or "")
    versions.publish(spark, table, folder)
    return state["identities"]


def build_silver(
    spark: SparkSession, bronze: str, silver: str, update_identities: bool = False, incremental_identities: bool = False
) -> dict[str, int]:
    """Write the eight canonical tables and the integrity report; returns rows per table.

    ``incremental_identities`` works out again only what new events and changed CRM records touch; the map equals a
    full rebuild.

    ``update_identities`` feeds the identity map written before into the new one, which becomes a version of its own;
    until that is whole the map before is the one that counts.
    """
    landed = landed_tables(spark, bronze)
    rows = {
        entity.name: write_table(canonical(entity, landed[source]), silver, entity.name)
        for source, entity in ENTITIES.items()
    }

    def written(name: str) -> DataFrame:
        return read_table(spark, silver, name)

    scratch = f"{silver}/_stage"
    existing = None
    if update_identities:
        existing = first_table_or_empty(spark, [f"{silver}/identity"], IDENTITY)
    if incremental_identities:
        identities = current_identities(spark, landed["events"], written("contact"), written("account"), silver)
    else:
        identities = identity_map(
            landed["events"], written("contact"), written("account"), existing, stage_folder=scratch
        )
    rows["identity"] = write_table(identities, silver, "identity")
    found = customer_events(landed["events"], written("identity"), stage_folder=scratch)
    rows["customer_event"] = write_table(
        found.withColumn(EVENT_DAY, F.to_date("event_timestamp")), silver, "customer_event", [EVENT_DAY]
    )

    report = integrity_report(
        written("contact"), written("account"), written("opportunity"), written("opportunity_contact_role")
    )
    write_table(report.withColumn("checked_at", F.current_timestamp()), silver, "integrity_report")
    return rows


#: Files of a mart: folders, order within them, and columns with bloom filters.
FILES = {
    "customer_360": {"sort_by": ["account_id"], "bloom": ["account_name"]},
    "intent_engagement": {"partition_by": ["event_date"], "sort_by": ["account_id"]},
    "sales_prioritization": {"sort_by": ["priority_score", "account_id"], "bloom": ["account_id", "sales_rep_id"]},
    "sales_performance": {"sort_by": ["sales_rep_id", "month"]},
    "lead_attribution": {"sort_by": ["lead_id"]},
}


def build_gold(spark: SparkSession, silver: str, gold: str, as_of: str | date) -> dict[str, int]:
    """Write the five marts in dependency order; returns rows per mart."""

    def canonical_table(name: str) -> DataFrame:
        return read_table(spark, silver, name)

    def write(mart: DataFrame, name: str) -> int:
        return write_mart(with_folded(mart, FOLDED.get(name, ())), gold, name, **FILES[name])

    opportunities, reps, events = map(canonical_table, ("opportunity", "sales_rep", "customer_event"))
    rows = {}
    c360 = marts.customer_360(
        canonical_table("account"), canonical_table("contact"), opportunities, reps, events, as_of
    )
    rows["customer_360"] = write(c360, "customer_360")
    rows["intent_engagement"] = write(marts.intent_engagement(events), "intent_engagement")
    scored = marts.sales_prioritization(
        read_table(spark, gold, "customer_360"), read_table(spark, gold, "intent_engagement"), as_of
    )
    rows["sales_prioritization"] = write(scored, "sales_prioritization")
    rows["sales_performance"] = write(marts.sales_performance(opportunities, reps), "sales_performance")
    rows["lead_attribution"] = write(marts.lead_attribution(canonical_table("lead"), opportunities), "lead_attribution")
    return rows
