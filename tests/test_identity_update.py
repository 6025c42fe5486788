import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from accountweave.operators import identity, identity_update

EVENT = "event_id string, event_type string, timestamp timestamp, identity_resolution struct<sfdc_contact_id:string,sfdc_account_id:string,anonymous_id:string,email:string,domain:string>"
CONTACT = "contact_id string, account_id string, email string, source_record_id string, updated_at timestamp"
ACCOUNT = "account_id string, website string, source_record_id string, updated_at timestamp"
T0 = dt.datetime(2026, 1, 1)


def events_of(r, n, first=0):
    """Few visitors, emails and domains, so that they mix."""
    pick = lambda kind, k, share: f"{kind}{r.randrange(k)}" if r.random() < share else None
    rows = []
    for i in range(first, first + n):
        email = pick("p", 9, 0.5)
        who = (pick("", 6, 0.15), pick("", 6, 0.1), pick("v", 12, 0.7), email and f"{email}@d{r.randrange(5)}.org", r.choice([None, "gmail.com", f"d{r.randrange(7)}.org"]))
        rows.append((f"evt_{i}", "website_visit", T0 + dt.timedelta(minutes=i), who))
    return rows


def crm_of(r, contacts, accounts):
    contact_rows = [(f"cnt_{i}", r.choice([None, f"acc_{r.randrange(7)}"]), f"p{r.randrange(9)}@d{r.randrange(5)}.org", str(i), T0) for i in contacts]
    account_rows = [(f"acc_{i}", r.choice([None, f"d{r.randrange(7)}.org"]), str(i), T0) for i in accounts]
    return contact_rows, account_rows


def rows(df):
    return Counter(tuple(r) for r in df.drop("updated_at").select(sorted(c for c in df.columns if c != "updated_at")).collect())


@pytest.fixture
def frames(spark):
    def make(events, contacts, accounts):
        return spark.createDataFrame(events, EVENT), spark.createDataFrame(contacts, CONTACT), spark.createDataFrame(accounts, ACCOUNT)

    return make


@pytest.mark.parametrize("seed", range(2))
def test_updates_equal_a_full_rebuild(spark, frames, seed):
    r = random.Random(seed)
    events = events_of(r, 60)
    contacts, accounts = crm_of(r, range(12), range(7))
    state = identity_update.first_state(*frames(events, contacts, accounts))
    assert rows(state["identities"]) == rows(identity.identity_map(*frames(events, contacts, accounts)))
    for step in range(2):
        fresh = events_of(r, 8, 100 * (step + 1))
        events += fresh
        # Some contacts change, one goes, one comes; an account changes.
        changed, moved = crm_of(r, [1, 20 + step], [step])
        contacts = [c for c in contacts if c[0] not in ("cnt_1", f"cnt_{3 + step}")] + changed
        accounts = [a for a in accounts if a[0] != f"acc_{step}"] + moved
        state = identity_update.updated(state, *frames(fresh, contacts, accounts))
        assert rows(state["identities"]) == rows(identity.identity_map(*frames(events, contacts, accounts)))


def test_only_what_is_touched_is_worked_out_again(spark, frames, no_broadcast):
    who = lambda v, e=None, d=None: (None, None, v, e, d)
    events = [("e1", "x", T0, who("v1", "a@x.org")), ("e2", "x", T0, who("v1")), ("e3", "x", T0, who("v2", "b@x.org")), ("e4", "x", T0, who(None, "b@x.org")), ("e5", "x", T0, who(None, None, "y.org"))]
    contacts = [("cnt_1", "acc_1", "a@x.org", "1", T0), ("cnt_2", "acc_2", "c@x.org", "2", T0)]
    accounts = [("acc_1", "x.org", "1", T0), ("acc_2", "z.org", "2", T0)]
    state = identity_update.first_state(*frames(events, contacts, accounts), hot_rows=2)
    before = {r.identity_id: r for r in state["identities"].collect()}
    fresh = [("e6", "x", T0 + dt.timedelta(days=1), who("v2"))]
    accounts.append(("acc_3", "y.org", "3", T0))
    new = identity_update.updated(state, *frames(fresh, contacts, accounts), hot_rows=2)
    after = {r.identity_id: r for r in new["identities"].collect()}
    again = {(r.anonymous_id, r.email, r.domain) for i, r in after.items() if i not in before or before[i].updated_at != r.updated_at}
    # The visitor with a new event, and the domain that is known now; not the visitor v1, nor the contacts.
    assert again == {("v2", "b@x.org", None), ("v2", None, None), (None, None, "y.org")}
    assert after[next(i for i, r in after.items() if (r.anonymous_id, r.email, r.domain) == (None, None, "y.org"))].account_id == "acc_3"
    assert rows(new["identities"]) == rows(identity.identity_map(*frames(events + fresh, contacts, accounts)))


def test_same_events_again_change_nothing(spark, frames):
    r = random.Random(8)
    events = events_of(r, 30)
    crm = crm_of(r, range(6), range(4))
    state = identity_update.first_state(*frames(events, *crm))
    again = identity_update.updated(state, *frames(events[10:], *crm))
    assert rows(again["identities"]) == rows(state["identities"]) and rows(again["event_tuples"]) == rows(state["event_tuples"])
    none = identity_update.updated(state, *frames([], *crm))
    assert none["identities"].exceptAll(state["identities"]).isEmpty() and state["identities"].exceptAll(none["identities"]).isEmpty()


def test_differing(spark):
    one, other = (spark.createDataFrame(r, "a string, b int") for r in ([("x", 1), ("y", None), (None, 2)], [("x", 1), (None, 2), ("z", 3)]))
    assert {tuple(r) for r in identity_update.differing(one, other).collect()} == {("y", None), ("z", 3)}


def test_a_known_account_is_not_lost_to_a_greater_contact(spark):
    from accountweave.operators.events import visitor_accounts

    found = spark.createDataFrame([("v1", "m@x.org", "cnt_9", None), ("v2", "m@x.org", "cnt_5", "acc_5"), ("v3", None, None, "acc_7")], "anonymous_id string, email string, contact_id string, account_id string")
    pairs = spark.createDataFrame([(None, "m@x.org"), ("v1", None), ("v3", "m@x.org")], "anonymous_id string, email string").withColumn("_n", F.lit(1))
    got = {r._visitor: (r.contact_id, r.account_id) for r in visitor_accounts(pairs, found).collect()}
    assert got == {'{"email":"m@x.org"}': ("cnt_9", "acc_5"), '{"anonymous_id":"v1"}': ("cnt_9", None), '{"anonymous_id":"v3","email":"m@x.org"}': ("cnt_9", "acc_7")}
