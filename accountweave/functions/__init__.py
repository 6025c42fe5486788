"""Column builders: every function takes columns (or names) and returns a Column."""

from accountweave.functions.casts import to_amount, to_flag, to_instant, to_day, to_whole
from accountweave.functions.keys import prefixed, record_hash, strip_prefix
from accountweave.functions.scoring import (
    EVENT_WEIGHTS,
    INTEREST_LABELS,
    ScoreRules,
    event_weight,
    interest_label,
    priority_band,
    priority_score,
    recency_factor,
)
from accountweave.functions.text import (
    PUBLIC_EMAIL_DOMAINS,
    clean_phone,
    company_domain,
    email_domain,
    normalize_domain,
    normalize_email,
)

__all__ = [
    "EVENT_WEIGHTS",
    "INTEREST_LABELS",
    "PUBLIC_EMAIL_DOMAINS",
    "ScoreRules",
    "clean_phone",
    "company_domain",
    "email_domain",
    "event_weight",
    "interest_label",
    "normalize_domain",
    "normalize_email",
    "prefixed",
    "priority_band",
    "priority_score",
    "recency_factor",
    "record_hash",
    "strip_prefix",
    "to_amount",
    "to_day",
    "to_flag",
    "to_instant",
    "to_whole",
]
