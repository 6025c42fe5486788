"""Identity resolution, kept up to date: only what new tuples touch is worked out again.

The state of a run is five tables: the aggregated tuples of all events so far, those of the CRM records as they are now, the two
lookups (contact by email, account by domain), and the identity map. An update

1. aggregates the tuples of the new events and adds them to those of the state;
2. aggregates the CRM tuples and lookups anew and finds out what differs from the state;
3. takes as touched every group (visitor, email, domain) with a new, changed or vanished tuple, and every group whose email
   or domain is looked up differently now;
4. resolves anew all groups of the visitors of touched groups, and touched groups without a visitor. Stitching stays
   within a visitor, so nothing else can change;
5. replaces these rows of the map and keeps all others as they are, with their time of update.

The result equals a full rebuild from all events and the present CRM records. Merging the same events twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountweave.operators import identity
from accountweave.operators.identity import KEYS
from accountweave.operators.joins import HOT_KEY_ROWS, hot_counts, lookup_join
from accountweave.sources.staging import stage

State = dict[str, DataFrame]
TABLES = ("event_tuples", "crm_tuples", "by_email", "by_domain", "identities")
SPREAD = ("anonymous_id", "email", "domain", "direct_contact", "direct_account")


def _crm(contacts: DataFrame, accounts: DataFrame, folder: str | None) -> State:
    union = identity.contact_tuples(contacts).unionByName(identity.account_tuples(accounts))
    return {
        "crm_tuples": stage(identity.aggregate_tuples(union), "crm_tuples", folder),
        "by_email": stage(identity.contacts_by_email(contacts), "by_email", folder),
        "by_domain": stage(identity.accounts_by_domain(accounts), "by_domain", folder),
    }


def _resolved(tuples: DataFrame, crm: State, hot_rows: int) -> DataFrame:
    """``tuples``: whole visitors, with equal tuples of events and CRM records made one."""
    by_email = lookup_join(tuples, crm["by_email"], "email", [c for c in SPREAD if c != "email"], hot_rows=hot_rows)
    # Counted on the written tuples, which have the same domains: the joined ones then need not be written.
    counts = hot_counts(tuples, ["domain"], hot_rows)
    matched = lookup_join(by_email, crm["by_domain"], "domain", [c for c in SPREAD if c != "domain"], counts, hot_rows)
    groups = stage(identity.resolve_groups(matched), "groups")
    return identity.with_identity_id(identity.stitch(groups, hot_rows))


def first_state(events: DataFrame, contacts: DataFrame, accounts: DataFrame, folder: str | None = None, hot_rows: int = HOT_KEY_ROWS) -> State:
    """The state after a full build. Tables are written below ``folder``, or staged."""
    state = {"event_tuples": stage(identity.aggregate_tuples(identity.event_tuples(events)), "event_tuples", folder)}
    state |= _crm(contacts, accounts, folder)
    tuples = stage(identity.merge_tuples(state["event_tuples"], state["crm_tuples"]), "tuples")
    return state | {"identities": stage(_resolved(tuples, state, hot_rows), "identities", folder)}


def differing(before: DataFrame, now: DataFrame) -> DataFrame:
    """Rows that only one of two tables has. Both sides are counted against each other in one aggregation."""
    signed = before.withColumn("_side", F.lit(-1)).unionByName(now.withColumn("_side", F.lit(1)))
    return signed.groupBy(*before.columns).agg(F.sum("_side").alias("_side")).where("_side <> 0").drop("_side")


def _looked_up(rows: DataFrame, keys: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Rows whose key is among ``keys``, balanced where a key is frequent."""
    flagged = keys.distinct().withColumn("_known", F.lit(True))
    spread = [c for c in SPREAD if c != key and c in rows.columns]
    return lookup_join(rows, flagged, key, spread, hot_rows=hot_rows).where("_known").drop("_known")


def _whom() -> Column:
    """Visitor or, without one, email and domain: what a row is worked out again by."""
    shown = F.to_json(F.struct("email", "domain"))
    return F.coalesce(F.concat(F.lit("="), "anonymous_id"), F.concat(F.lit("-"), shown)).alias("_whom")


def _marked(rows: DataFrame, marks: DataFrame, hot_rows: int) -> DataFrame:
    """``rows`` with ``_touched``: true where they are to be worked out again, else null."""
    spread = [c for c in rows.columns if c in SPREAD]
    return lookup_join(rows.select("*", _whom()), marks, "_whom", spread, hot_rows=hot_rows).drop("_whom")


def updated(
    state: State,
    events: DataFrame,
    contacts: DataFrame,
    accounts: DataFrame,
    folder: str | None = None,
    hot_rows: int = HOT_KEY_ROWS,
) -> State:
    """The next state. ``events`` are the new ones; ``contacts`` and ``accounts`` the canonical tables as they are now."""
    fresh = stage(identity.aggregate_tuples(identity.event_tuples(events)), "new_tuples")
    new = {"event_tuples": stage(identity.merge_tuples(state["event_tuples"], fresh), "event_tuples", folder)}
    new |= _crm(contacts, accounts, folder)
    tuples = stage(identity.merge_tuples(new["event_tuples"], new["crm_tuples"]), "tuples")

    changed = fresh.select(*KEYS).unionByName(differing(state["crm_tuples"], new["crm_tuples"]).select(*KEYS))
    for name, key in (("by_email", "email"), ("by_domain", "domain")):
        keys = stage(differing(state[name], new[name]).select(key), f"changed_{key}")
        changed = changed.unionByName(_looked_up(tuples, keys, key, hot_rows).select(*KEYS))
    marks = stage(changed.select(_whom(), F.lit(True).alias("_touched")).distinct(), "touched")
    again = _marked(tuples, marks, hot_rows).where("_touched").drop("_touched")
    kept = _marked(state["identities"], marks, hot_rows).where("_touched is null").drop("_touched")
    fixed = kept.unionByName(_resolved(stage(again, "again"), new, hot_rows))
    return new | {"identities": stage(fixed, "identities", folder)}
