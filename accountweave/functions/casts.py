"""Casts of text that came from outside: a bad value becomes null, it never fails the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from accountweave.functions._cols import as_col


def to_amount(value: Column | str, precision: int = 18, scale: int = 2) -> Column:
    return as_col(value).try_cast(f"decimal({precision},{scale})")


def to_whole(value: Column | str) -> Column:
    """Integer part; goes through double so that the text ``12.5`` gives 12, not null."""
    return as_col(value).try_cast("double").try_cast("int")


def to_flag(value: Column | str, default: bool) -> Column:
    return F.coalesce(as_col(value).try_cast("boolean"), F.lit(default))


def to_instant(value: Column | str) -> Column:
    return as_col(value).try_cast("timestamp")


def to_day(value: Column | str) -> Column:
    return as_col(value).try_cast("date")
