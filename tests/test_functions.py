from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from accountweave import functions as fn
from accountweave.functions.scoring import capped_percent


def values(spark, build, *inputs, kind="string"):
    """``build(column)`` on every input, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r.out for r in df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]


def test_email(spark):
    assert values(spark, fn.normalize_email, " \u00c9VA+Tag@Sub.Example ", "", " ", None) == ["\u00e9va+tag@sub.example", "", "", None]


def test_domain_keeps_what_follows_no_scheme(spark):
    cases = {
        "HTTPS://WWW.Mill.example/": "mill.example",
        " http://Acme.com ": "acme.com",
        "acme.com/a/b": "acme.com",
        "www.acme.com": "www.acme.com",
        "https://acme.com:8080/x?y": "acme.com:8080",
        "http://m.www.acme.com?q=1": "m.www.acme.com?q=1",
        "jo@acme.com": "jo@acme.com",
        "https://": "",
        "": "",
        None: None,
    }
    assert values(spark, fn.normalize_domain, *cases) == list(cases.values())


def test_email_domain_and_public_providers(spark):
    assert values(spark, fn.email_domain, "Jo@Acme.com", "nobody", "jo@", None) == ["acme.com", None, None, None]
    assert values(spark, fn.company_domain, "gmail.com", "acme.com", "zoho.com", None) == [None, "acme.com", None, None]
    assert len(fn.PUBLIC_EMAIL_DOMAINS) == 9


def test_phone(spark):
    cases = {"+ 90 x 12/3": "+90123", "0 (0) 7": "007", " +44 1": "+441", "++5": "+5", "1+2": "12", "": "", None: None}
    assert values(spark, fn.clean_phone, *cases) == list(cases.values())


def test_record_hash_takes_null_for_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string")
    first, second, third = (r.h for r in df.select(fn.record_hash(["x", "y"]).alias("h")).collect())
    assert first == second != third
    assert len(first) == 64


def test_casts_never_fail(spark):
    assert values(spark, fn.to_amount, "12.345", "x", None) == [Decimal("12.35"), None, None]
    assert values(spark, fn.to_whole, "12.5", "12", "many", None) == [12, 12, None, None]
    assert values(spark, lambda c: fn.to_flag(c, True), "false", "maybe", None) == [False, True, True]
    assert values(spark, lambda c: fn.to_day(c).cast("string"), "2026-04-30", "soon") == ["2026-04-30", None]
    assert values(spark, lambda c: fn.to_instant(c).cast("string"), "2026-02-01T10:00:00Z", "soon") == [
        "2026-02-01 10:00:00",
        None,
    ]


def test_prefixes(spark):
    assert values(spark, lambda c: fn.prefixed("account", c), "1", None) == ["acc_1", None]
    assert values(spark, lambda c: fn.strip_prefix("contact", c), "cnt_9", "9", None) == ["9", "9", None]


def test_event_weights_and_labels(spark):
    kinds = [*fn.EVENT_WEIGHTS, "other", None]
    assert values(spark, fn.event_weight, *kinds) == [1, 3, 3, 5, 8, 15, 0, 0]
    assert values(spark, fn.interest_label, *kinds) == [
        "low", "medium", "medium", "medium_high", "high", "very_high", "low", "low",
    ]


def test_recency_steps(spark):
    days = [-3, 0, 7, 8, 14, 15, 30, 31, None]
    assert values(spark, fn.recency_factor, *days, kind="int") == [1.0, 1.0, 1.0, 0.7, 0.7, 0.4, 0.4, 0.1, 0.1]


def test_bands(spark):
    assert values(spark, fn.priority_band, 100.0, 70.0, 69.99, 40.0, 39.99, None, kind="double") == [
        "Tier 1", "Tier 1", "Tier 2", "Tier 2", "Tier 3", "Tier 3",
    ]


def test_cap_takes_null_as_zero(spark):
    assert values(spark, lambda c: capped_percent(c, 50.0), 25, 50, 500, None, kind="int") == [50.0, 100.0, 100.0, 0.0]


def test_score_weights(spark):
    df = spark.createDataFrame([(50, 2_000_000.0, 0, 1), (0, 0.0, 999, 0), (25, 1_000_000.0, 10, 1)], "i int, p double, d int, o int")
    scores = [r.s for r in df.select(fn.priority_score("i", "p", "d", "o").alias("s")).collect()]
    assert scores == pytest.approx([100.0, 2.0, 59.0])
