"""Normal forms of emails, web domains and phone numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from accountweave.functions._cols import as_col

# Mailbox providers whose domain says nothing about the employer.
PUBLIC_EMAIL_DOMAINS = (
    "gmail.com",
    "yahoo.com",
    "hotmail.com",
    "outlook.com",
    "icloud.com",
    "aol.com",
    "protonmail.com",
    "zoho.com",
    "mail.com",
)


def normalize_email(value: Column | str) -> Column:
    return F.lower(F.trim(as_col(value)))


def normalize_domain(value: Column | str) -> Column:
    """Host part of a web address, in lower case.

    One regular expression pass: an ``http(s)://`` scheme, and a ``www.`` that directly follows it, are skipped;
    the text up to the next slash is kept. Without a scheme ``www.`` stays; ports and queries stay too.
    """
    return F.regexp_extract(normalize_email(value), r"^(?:https?://(?:www\.)?)?([^/]*)", 1)


def email_domain(value: Column | str) -> Column:
    """Text after the last ``@`` of a normalized email; null when there is none."""
    found = F.regexp_extract(normalize_email(value), r"@([^@]*)$", 1)
    return F.when(found != "", found)


def company_domain(domain: Column | str) -> Column:
    """The domain, or null when it belongs to a public mailbox provider."""
    domain = as_col(domain)
    return F.when(~domain.isin(*PUBLIC_EMAIL_DOMAINS), domain)


def clean_phone(value: Column | str) -> Column:
    """Digits only, with one leading ``+`` kept. Null stays null, empty stays empty."""
    value = as_col(value)
    plus = F.when(F.trim(value).startswith("+"), "+").otherwise("")
    return F.concat(plus, F.regexp_replace(value, "[^0-9]", ""))
