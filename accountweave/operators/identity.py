"""Identity resolution: which contact and account stand behind a visitor, an email or a web domain.

Order of trust: id given by the event itself, contact found by email, account of that contact, account found by
domain, unresolved. What is known about a visitor at any time then holds for all tuples of that visitor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountweave.functions import (
    company_domain,
    email_domain,
    normalize_domain,
    normalize_email,
    prefixed,
    strip_prefix,
    to_instant,
)
from accountweave.operators.joins import HOT_KEY_ROWS, hot_counts, lookup_join
from accountweave.sources.staging import stage

KEYS = ("anonymous_id", "email", "domain")


def _tuple(seen_from: Column, seen_to: Column | None = None, **known: Column) -> list[Column]:
    """The columns of an identity tuple; what a source does not know is null."""
    unknown = F.lit(None).cast("string")
    names = (*KEYS, "direct_contact", "direct_account")
    return [
        *(known.get(name, unknown).alias(name) for name in names),
        seen_from.alias("seen_from"),
        (seen_from if seen_to is None else seen_to).alias("seen_to"),
    ]


def event_tuples(events: DataFrame) -> DataFrame:
    """One tuple per event."""
    who = "identity_resolution."
    return events.select(
        *_tuple(
            to_instant("timestamp"),
            anonymous_id=F.col(who + "anonymous_id"),
            email=normalize_email(who + "email"),
            domain=company_domain(normalize_domain(who + "domain")),
            direct_contact=F.col(who + "sfdc_contact_id"),
            direct_account=F.col(who + "sfdc_account_id"),
        )
    )


def contact_tuples(contacts: DataFrame) -> DataFrame:
    return contacts.where(F.col("email").isNotNull()).select(
        *_tuple(
            to_instant("updated_at"),
            email=F.col("email"),
            domain=company_domain(email_domain("email")),
            direct_contact=F.col("source_record_id"),
            direct_account=strip_prefix("account", "account_id"),
        )
    )


def account_tuples(accounts: DataFrame) -> DataFrame:
    return accounts.where(F.col("website").isNotNull()).select(
        *_tuple(
            to_instant("updated_at"),
            domain=company_domain(normalize_domain("website")),
            direct_account=F.col("source_record_id"),
        )
    )


def known_tuples(identities: DataFrame) -> DataFrame:
    """Tuples of an earlier identity map; both ends of the time span are carried over."""
    return identities.select(
        *_tuple(
            to_instant("first_seen_at"),
            to_instant("last_seen_at"),
            anonymous_id=F.col("anonymous_id"),
            email=F.col("email"),
            domain=company_domain("domain"),
            direct_contact=strip_prefix("contact", "contact_id"),
            direct_account=strip_prefix("account", "account_id"),
        )
    )


def identity_sources(
    events: DataFrame, contacts: DataFrame, accounts: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """All identity tuples, aggregated: equal tuples become one row with their time span.

    This comes before any join. A visitor with a third of all events is a handful of rows from here on, and the
    aggregation combines on the map side. Tuples without any key can never be output and are dropped here.
    """
    union = event_tuples(events).unionByName(contact_tuples(contacts)).unionByName(account_tuples(accounts))
    if existing is not None:
        union = union.unionByName(known_tuples(existing))
    return aggregate_tuples(union)


def aggregate_tuples(union: DataFrame) -> DataFrame:
    return (
        union.where(F.coalesce(*KEYS).isNotNull())
        .groupBy(*KEYS, "direct_contact", "direct_account")
        .agg(F.min("seen_from").alias("first_seen_at"), F.max("seen_to").alias("last_seen_at"))
    )


def merge_tuples(one: DataFrame, other: DataFrame) -> DataFrame:
    """Aggregated tuples of two sources as one table."""
    both = one.unionByName(other).withColumnsRenamed({"first_seen_at": "seen_from", "last_seen_at": "seen_to"})
    return aggregate_tuples(both)


def contacts_by_email(contacts: DataFrame) -> DataFrame:
    """One contact (the smallest id) and its account per email."""
    first = F.min(F.struct("contact_id", "account_id"))
    return (
        contacts.where(F.col("email").isNotNull())
        .groupBy("email")
        .agg(first.alias("c"))
        .select("email", F.col("c.contact_id").alias("email_contact_id"), F.col("c.account_id").alias("email_account_id"))
    )


def accounts_by_domain(accounts: DataFrame) -> DataFrame:
    """One account (the smallest id) per company domain; public mailbox domains are left out."""
    return (
        accounts.select(company_domain(normalize_domain("website")).alias("domain"), "account_id")
        .where(F.col("domain").isNotNull())
        .groupBy("domain")
        .agg(F.min("account_id").alias("domain_account_id"))
    )


def match_email(tuples: DataFrame, contacts: DataFrame, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    spread = ["anonymous_id", "domain", "direct_contact", "direct_account"]
    return lookup_join(tuples, contacts_by_email(contacts), "email", spread, hot_rows=hot_rows)


def match_domain(
    tuples: DataFrame, accounts: DataFrame, counts: DataFrame | None = None, hot_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    spread = ["anonymous_id", "email", "direct_contact", "direct_account"]
    return lookup_join(tuples, accounts_by_domain(accounts), "domain", spread, counts, hot_rows)


def resolve_groups(matched: DataFrame) -> DataFrame:
    """Waterfall per tuple, then one row per (visitor, email, domain); the greatest id wins between candidates."""
    contact = F.coalesce(prefixed("contact", "direct_contact"), "email_contact_id")
    account = F.coalesce(prefixed("account", "direct_account"), "email_account_id", "domain_account_id")
    return matched.groupBy(*KEYS).agg(
        F.max(contact).alias("contact_id"),
        F.max(account).alias("account_id"),
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
    )


def visitor_links(groups: DataFrame) -> DataFrame:
    """Per visitor: the greatest contact, and the account that goes with the greatest contact having one.

    An aggregate rather than a window over all rows of a visitor, so that a visitor with very many tuples is
    combined on the map side instead of being sorted in one task.
    """
    known_account = F.when(F.col("account_id").isNotNull(), F.struct("contact_id", "account_id"))
    return (
        groups.where(F.col("anonymous_id").isNotNull())
        .groupBy("anonymous_id")
        .agg(F.max("contact_id").alias("visitor_contact_id"), F.max(known_account).alias("a"))
        .select("anonymous_id", "visitor_contact_id", F.col("a.account_id").alias("visitor_account_id"))
    )


def stitch(groups: DataFrame, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Carry what is known about a visitor to all of its rows; rows without a visitor keep their own ids."""
    linked = lookup_join(groups, visitor_links(groups), "anonymous_id", ["email", "domain"], hot_rows=hot_rows)
    return linked.select(
        *KEYS,
        F.coalesce("visitor_contact_id", "contact_id").alias("contact_id"),
        F.coalesce("visitor_account_id", "account_id").alias("account_id"),
        "first_seen_at",
        "last_seen_at",
    )


def identity_map(
    events: DataFrame,
    contacts: DataFrame,
    accounts: DataFrame,
    existing: DataFrame | None = None,
    hot_rows: int = HOT_KEY_ROWS,
    stage_folder: str | None = None,
) -> DataFrame:
    """Landed events + canonical contacts and accounts (+ an earlier map) -> one row per (visitor, email, domain).

    The aggregated tuples and the resolved groups are staged: both feed several branches, and both are small next to
    the events, which are read once.
    """
    tuples = stage(identity_sources(events, contacts, accounts, existing), "identity_tuples", stage_folder)
    matched = match_domain(
        match_email(tuples, contacts, hot_rows), accounts, hot_counts(tuples, ["domain"], hot_rows), hot_rows
    )
    groups = stage(resolve_groups(matched), "identity_groups", stage_folder)
    return with_identity_id(stitch(groups, hot_rows))


def with_identity_id(stitched: DataFrame) -> DataFrame:
    """Stitched groups with their id, a hash of all three keys, and the time of the run."""
    parts = [F.coalesce(k, F.lit("")) for k in KEYS]
    return stitched.select(
        F.concat(F.lit("idn_"), F.sha2(F.concat_ws("||", *parts), 256)).alias("identity_id"),
        "*",
        F.current_timestamp().alias("updated_at"),
    )
