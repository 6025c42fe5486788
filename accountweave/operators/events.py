"""Canonical customer events: newest copy per event id, flat columns, contact and account from the identity map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountweave.functions import interest_label, normalize_domain, normalize_email, record_hash, to_instant, to_whole
from accountweave.operators.dedup import keep_latest
from accountweave.operators.joins import HOT_KEY_ROWS, hot_counts, lookup_join
from accountweave.sources.staging import stage

SOURCE_SYSTEM = "digital_events"
NEWEST = ("timestamp", "_ingested_at", "_kafka_partition", "_kafka_offset")

# Columns that make the record hash, in hash order, and columns of the canonical table.
HASHED = (
    "event_type", "event_timestamp", "anonymous_id", "email", "contact_id", "account_id", "url", "duration_seconds",
)

OUTPUT = (
    "event_id", "event_type", "event_timestamp", "contact_id", "account_id", "anonymous_id", "email", "domain", "url",
    "plan_interest", "duration_seconds", "interaction_weight", "attributes", "source_system", "source_record_id",
    "ingested_at", "record_hash",
)


def _visitor() -> Column:
    """One text for the pair (anonymous id, email); null when both are missing, so that it matches nothing."""
    pair = F.to_json(F.struct("anonymous_id", "email"))
    return F.when(F.coalesce("anonymous_id", "email").isNotNull(), pair)


def flat_events(landed: DataFrame) -> DataFrame:
    """Newest copy of each event, flattened and normalized. ``attributes`` may be a struct or a map."""
    latest = keep_latest(landed.where(F.col("event_id").isNotNull()), ["event_id"], NEWEST)
    return latest.select(
        "event_id",
        "event_type",
        to_instant("timestamp").alias("event_timestamp"),
        F.col("identity_resolution.anonymous_id").alias("anonymous_id"),
        normalize_email("identity_resolution.email").alias("email"),
        normalize_domain("identity_resolution.domain").alias("domain"),
        F.col("attributes.url").alias("url"),
        F.col("attributes.plan_interest").alias("plan_interest"),
        to_whole("attributes.duration_seconds").alias("duration_seconds"),
        interest_label("event_type").alias("interaction_weight"),
        F.to_json("attributes").alias("attributes"),
    )


def _links_by(identities: DataFrame, key: str, name: str) -> DataFrame:
    """One row per key, by the rule of ``visitor_links``: the greatest contact, and the account that goes with the
    greatest contact having one. A known account is not lost to a greater contact without one."""
    known_account = F.when(F.col("account_id").isNotNull(), F.struct("contact_id", "account_id"))
    return (
        identities.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max("contact_id").alias(f"{name}_contact_id"), F.max(known_account).alias("a"))
        .select(key, f"{name}_contact_id", F.col("a.account_id").alias(f"{name}_account_id"))
    )


def visitor_pairs(landed: DataFrame) -> DataFrame:
    """The (anonymous id, email) pairs that occur in the events, with the number of rows of each."""
    return (
        landed.where(F.col("event_id").isNotNull())
        .select(
            F.col("identity_resolution.anonymous_id").alias("anonymous_id"),
            normalize_email("identity_resolution.email").alias("email"),
        )
        .where(F.coalesce("anonymous_id", "email").isNotNull())
        .groupBy("anonymous_id", "email")
        .agg(F.count("*").alias("_n"))
    )


def visitor_accounts(pairs: DataFrame, identities: DataFrame, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Contact and account of every pair; the match by anonymous id goes before the match by email, per column."""
    by_id = lookup_join(
        pairs, _links_by(identities, "anonymous_id", "a"), "anonymous_id", ["email"], hot_rows=hot_rows
    )
    both = lookup_join(
        by_id,
        _links_by(identities, "email", "e"),
        "email",
        ["anonymous_id"],
        hot_counts(pairs, ["email"], hot_rows),
        hot_rows,
    )
    return both.select(
        _visitor().alias("_visitor"),
        F.coalesce("a_contact_id", "e_contact_id").alias("contact_id"),
        F.coalesce("a_account_id", "e_account_id").alias("account_id"),
    )


def customer_events(
    landed: DataFrame,
    identities: DataFrame,
    hot_rows: int = HOT_KEY_ROWS,
    stage_folder: str | None = None,
) -> DataFrame:
    """Landed events + identity map -> canonical events.

    Ids are looked up for the distinct visitor pairs, a narrow frame that one aggregation over the events gives and
    that is staged with its row counts. The wide rows are shuffled twice only: for the dedup and for one join.
    """
    pairs = stage(visitor_pairs(landed), "visitor_pairs", stage_folder)
    links = visitor_accounts(pairs, identities, hot_rows)
    flat = flat_events(landed).withColumn("_visitor", _visitor())
    counts = pairs.select(_visitor().alias("_visitor"), "_n")
    linked = lookup_join(flat, links, "_visitor", ["event_id"], counts, hot_rows)
    return linked.select(
        "*",
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        F.col("event_id").alias("source_record_id"),
        F.current_timestamp().alias("ingested_at"),
        record_hash(HASHED).alias("record_hash"),
    ).select(*OUTPUT)
