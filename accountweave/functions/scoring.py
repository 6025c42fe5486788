"""Scoring rules: event weights, interest labels, recency decay, priority score and bands."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from accountweave.functions._cols import as_col

# Intent points per event type; any other type counts 0.
EVENT_WEIGHTS = {
    "website_visit": 1,
    "product_page_view": 3,
    "documentation_view": 3,
    "brochure_download": 5,
    "pricing_page_view": 8,
    "demo_request": 15,
}

# Interest label per event type; any other type is "low".
INTEREST_LABELS = {
    "website_visit": "low",
    "product_page_view": "medium",
    "documentation_view": "medium",
    "brochure_download": "medium_high",
    "pricing_page_view": "high",
    "demo_request": "very_high",
}

# Fixed values: (days since the last activity, factor), first match wins; older or unknown gives 0.1.
RECENCY_STEPS = ((7, 1.0), (14, 0.7), (30, 0.4))
RECENCY_FLOOR = 0.1

# Fixed values: (lowest score, band), first match wins.
BANDS = ((70, "Tier 1"), (40, "Tier 2"))
LAST_BAND = "Tier 3"


@dataclass(frozen=True)
class ScoreRules:
    """Weights and caps of the priority score (all parts are scaled to 0..100 first)."""

    intent_share: float = 0.40
    pipeline_share: float = 0.30
    recency_share: float = 0.20
    open_deal_share: float = 0.10
    intent_cap: float = 50.0
    pipeline_cap: float = 2_000_000.0


def _first_match(cases, otherwise) -> Column:
    chain = None
    for condition, value in cases:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return chain.otherwise(otherwise)


def event_weight(event_type: Column | str) -> Column:
    event_type = as_col(event_type)
    return _first_match(((event_type == name, points) for name, points in EVENT_WEIGHTS.items()), 0)


def interest_label(event_type: Column | str) -> Column:
    labels = F.create_map(*(F.lit(part) for pair in INTEREST_LABELS.items() for part in pair))
    return F.coalesce(labels[as_col(event_type)], F.lit("low"))


def recency_factor(days: Column | str) -> Column:
    days = as_col(days)
    return _first_match(((days <= limit, factor) for limit, factor in RECENCY_STEPS), RECENCY_FLOOR)


def capped_percent(value: Column | str, cap: float) -> Column:
    """``value`` in percent of ``cap``, at most 100. ``least`` skips nulls, so null is made 0 first."""
    share = F.coalesce(as_col(value), F.lit(0)) * 100.0 / cap
    return F.least(F.lit(100.0), share)


def priority_score(
    intent: Column | str,
    pipeline: Column | str,
    days: Column | str,
    open_deals: Column | str,
    rules: ScoreRules = ScoreRules(),
) -> Column:
    has_open_deal = F.when(as_col(open_deals) > 0, 100.0).otherwise(0.0)
    return F.round(
        capped_percent(intent, rules.intent_cap) * rules.intent_share
        + capped_percent(pipeline, rules.pipeline_cap) * rules.pipeline_share
        + recency_factor(days) * 100.0 * rules.recency_share
        + has_open_deal * rules.open_deal_share,
        2,
    )


def priority_band(score: Column | str) -> Column:
    score = as_col(score)
    return _first_match(((score >= low, band) for low, band in BANDS), LAST_BAND)
