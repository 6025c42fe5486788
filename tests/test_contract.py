import json

import pytest

from accountweave.operators.contract import split_by_contract, with_violations

GOOD = {
    "event_id": "evt_-_0",
    "event_type": "brochure_download",
    "timestamp": "2024-02-29T23:59:59Z",
    "identity_resolution": {"sfdc_contact_id": "", "sfdc_account_id": None, "anonymous_id": "a b", "email": None, "domain": "d"},
    "attributes": {"": None, "n": -1.5e3, "deep": {"k": [1]}},
}


def without(name):
    return {k: v for k, v in GOOD.items() if k != name}


CASES = [
    (GOOD, []),
    (GOOD | {"event_type": "demo_request", "identity_resolution": {"email": "x"}, "attributes": {}}, []),
    (GOOD | {"identity_resolution": {}}, []),
    (GOOD | {"timestamp": "2024-12-31T00:00:00.001-11:30"}, []),
    (GOOD | {"event_type": "Website_visit"}, ["event_type"]),
    (without("event_id"), ["missing_event_id"]),
    (without("attributes"), ["missing_attributes"]),
    (GOOD | {"event_id": "abc"}, ["event_id"]),
    (GOOD | {"event_id": 5}, ["event_id"]),
    (GOOD | {"event_id": None, "event_type": None}, ["event_id", "event_type"]),
    (GOOD | {"timestamp": "yesterday"}, ["timestamp"]),
    (GOOD | {"timestamp": "2026-13-45T15:30:00Z"}, ["timestamp"]),
    (GOOD | {"timestamp": 17}, ["timestamp"]),
    (GOOD | {"identity_resolution": "x"}, ["identity_resolution"]),
    (GOOD | {"identity_resolution": {"phone": "1"}}, ["identity_resolution_extra"]),
    (GOOD | {"identity_resolution": {"email": 5}}, ["identity_resolution_value"]),
    (GOOD | {"attributes": []}, ["attributes"]),
    (GOOD | {"channel": "web"}, ["extra"]),
]


@pytest.fixture
def messages(spark):
    texts = [json.dumps(m) for m, _ in CASES] + ['{"event_id": "evt_', "[1]", "", None]
    return spark.createDataFrame(list(enumerate(texts)), "n int, json_payload string")


def test_codes(messages):
    found = [r.violations for r in with_violations(messages).orderBy("n").collect()]
    assert found == [codes for _, codes in CASES] + [["malformed"]] * 4


def test_split_is_complete(messages):
    valid, rejected = split_by_contract(messages)
    assert {r.n for r in valid.collect()} == {0, 1, 2, 3}
    assert valid.count() + rejected.count() == messages.count()
    assert valid.columns == messages.columns


def test_format_check_can_be_left_out(messages):
    valid, _ = split_by_contract(messages, check_format=False)
    assert {r.n for r in valid.collect()} == {0, 1, 2, 3, 10, 11}
