"""Canonical CRM entities. Each entity is a declaration; one function turns it into a single projection."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountweave.functions import (
    clean_phone,
    normalize_domain,
    normalize_email,
    prefixed,
    record_hash,
    to_amount,
    to_day,
    to_flag,
    to_instant,
    to_whole,
)
from accountweave.operators.dedup import keep_latest

SOURCE_SYSTEM = "salesforce"

# How "newest" is decided between copies of one record: the source's clock, then ours.
NEWEST = ("SystemModstamp", "_ingested_at", "_batch_id")

Builder = Callable[[DataFrame], Column]


def _trimmed(name: str) -> Builder:
    return lambda df: F.trim(F.col(name))


def _email(name: str) -> Builder:
    return lambda df: normalize_email(name)


def _link(entity: str, name: str) -> Builder:
    return lambda df: prefixed(entity, name)


def _flag(name: str, default: bool = False) -> Builder:
    return lambda df: to_flag(name, default)


def _role_name(df: DataFrame) -> Column:
    """The role title under whichever name the landed table carries it."""
    if "RoleName" in df.columns:
        return F.col("RoleName")
    if "UserRole_Name" in df.columns:
        return F.col("UserRole_Name")
    if "UserRole" in df.columns:
        return F.col("UserRole.Name")
    return F.lit(None).cast("string")


@dataclass(frozen=True)
class Entity:
    name: str
    key: str
    fields: Mapping[str, Builder]
    hashed: tuple[str, ...]


ACCOUNT = Entity(
    name="account",
    key="account_id",
    fields={
        "account_name": _trimmed("Name"),
        "account_type": _trimmed("Type"),
        "phone": lambda df: clean_phone("Phone"),
        "website": lambda df: normalize_domain("Website"),
        "industry": _trimmed("Industry"),
        "annual_revenue": lambda df: to_amount("AnnualRevenue"),
        "employee_count": lambda df: to_whole("NumberOfEmployees"),
        "owner_id": _link("sales_rep", "OwnerId"),
    },
    hashed=(
        "account_name", "account_type", "phone", "website", "industry", "annual_revenue", "employee_count", "owner_id",
    ),
)

CONTACT = Entity(
    name="contact",
    key="contact_id",
    fields={
        "account_id": _link("account", "AccountId"),
        "first_name": _trimmed("FirstName"),
        "last_name": _trimmed("LastName"),
        "email": _email("Email"),
        "phone": lambda df: clean_phone("Phone"),
        "job_title": _trimmed("Title"),
        "department": _trimmed("Department"),
        "owner_id": _link("sales_rep", "OwnerId"),
    },
    hashed=("account_id", "first_name", "last_name", "email", "phone", "job_title", "department", "owner_id"),
)

LEAD = Entity(
    name="lead",
    key="lead_id",
    fields={
        "first_name": _trimmed("FirstName"),
        "last_name": _trimmed("LastName"),
        "company_name": _trimmed("Company"),
        "email": _email("Email"),
        "lead_source": _trimmed("LeadSource"),
        "status": _trimmed("Status"),
        "rating": _trimmed("Rating"),
        "owner_id": _link("sales_rep", "OwnerId"),
        "is_converted": _flag("IsConverted"),
        "converted_account_id": _link("account", "ConvertedAccountId"),
        "converted_contact_id": _link("contact", "ConvertedContactId"),
        "converted_opportunity_id": _link("opportunity", "ConvertedOpportunityId"),
    },
    hashed=("first_name", "last_name", "company_name", "email", "lead_source", "status", "rating", "is_converted"),
)

OPPORTUNITY = Entity(
    name="opportunity",
    key="opportunity_id",
    fields={
        "account_id": _link("account", "AccountId"),
        "opportunity_name": _trimmed("Name"),
        "stage": _trimmed("StageName"),
        "amount": lambda df: to_amount("Amount"),
        "probability": lambda df: to_amount("Probability", 5, 2),
        "close_date": lambda df: to_day("CloseDate"),
        "opportunity_type": _trimmed("Type"),
        "lead_source": _trimmed("LeadSource"),
        "is_closed": _flag("IsClosed"),
        "is_won": _flag("IsWon"),
        "owner_id": _link("sales_rep", "OwnerId"),
    },
    hashed=(
        "account_id", "opportunity_name", "stage", "amount", "probability", "close_date", "opportunity_type",
        "is_closed", "is_won", "owner_id",
    ),
)

OPPORTUNITY_CONTACT_ROLE = Entity(
    name="opportunity_contact_role",
    key="opportunity_contact_role_id",
    fields={
        "opportunity_id": _link("opportunity", "OpportunityId"),
        "contact_id": _link("contact", "ContactId"),
        "role": _trimmed("Role"),
        "is_primary": _flag("IsPrimary"),
    },
    hashed=("opportunity_id", "contact_id", "role", "is_primary"),
)

SALES_REP = Entity(
    name="sales_rep",
    key="sales_rep_id",
    fields={
        "username": _trimmed("Username"),
        "name": _trimmed("Name"),
        "email": _email("Email"),
        "role_name": _role_name,
        "is_active": _flag("IsActive", default=True),
    },
    hashed=("username", "name", "email", "role_name", "is_active"),
)

# Landed object name -> entity.
ENTITIES = {
    "user": SALES_REP,
    "account": ACCOUNT,
    "contact": CONTACT,
    "lead": LEAD,
    "opportunity": OPPORTUNITY,
    "opportunity_contact_role": OPPORTUNITY_CONTACT_ROLE,
}


def canonical(entity: Entity, landed: DataFrame) -> DataFrame:
    """Landed copies of one CRM object -> one typed row per record.

    Rows without an id are dropped, the newest copy of each id is kept (one shuffle), and everything else is one
    projection behind it.
    """
    latest = keep_latest(landed.where(F.col("Id").isNotNull()), ["Id"], NEWEST)
    typed = latest.select(
        prefixed(entity.name, "Id").alias(entity.key),
        *(build(latest).alias(name) for name, build in entity.fields.items()),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        F.col("Id").alias("source_record_id"),
        to_instant("CreatedDate").alias("created_at"),
        to_instant("SystemModstamp").alias("updated_at"),
        F.current_timestamp().alias("ingested_at"),
    )
    return typed.select("*", record_hash(entity.hashed).alias("record_hash"))
