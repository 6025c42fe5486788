"""Surrogate keys and content hashes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from accountweave.functions._cols import as_col

# Key prefix of each entity.
KEY_PREFIX = {
    "account": "acc_",
    "contact": "cnt_",
    "lead": "led_",
    "opportunity": "opp_",
    "opportunity_contact_role": "ocr_",
    "sales_rep": "srep_",
    "identity": "idn_",
}


def prefixed(entity: str, value: Column | str) -> Column:
    """Entity prefix + source id. ``concat`` propagates null, so a missing foreign key stays null."""
    return F.concat(F.lit(KEY_PREFIX[entity]), as_col(value))


def strip_prefix(entity: str, value: Column | str) -> Column:
    return F.regexp_replace(as_col(value), "^" + KEY_PREFIX[entity], "")


def record_hash(columns: Iterable[Column | str]) -> Column:
    """SHA-256, as hex, over the values joined by ``||``. Null and empty text hash alike, by contract."""
    parts = (F.coalesce(as_col(c).cast("string"), F.lit("")) for c in columns)
    return F.sha2(F.concat_ws("||", *parts), 256)
