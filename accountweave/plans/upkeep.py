"""Upkeep of the daily intent mart: only the days that events touch are made again."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountweave.plans import marts
from accountweave.plans.runs import EVENT_DAY, FILES
from accountweave.sources import versions
from accountweave.sources.tables import read_table, write_counted, write_mart

INTENT = "intent_engagement"


def days_of(events: DataFrame) -> list[date]:
    """The days of some resolved events, for ``refresh_days``; one row per day passes the driver."""
    rows = events.where(F.col("account_id").isNotNull()).select(F.to_date("event_timestamp").alias("day")).distinct()
    return sorted(r.day for r in rows.where("day is not null").collect())


def refresh_days(spark: SparkSession, silver: str, gold: str, days: Iterable[date]) -> int:
    """Make the given days of the mart again from the canonical events and return the rows written.

    The events of these days alone are read (they lie in a folder per day), and the folders of these days alone are
    replaced in the mart's current version, each by a rename when all are written. A day without resolved events loses
    its folder. Days are whole, however late their events came; a refresh that failed or is repeated changes nothing else.
    """
    days = sorted(set(days))
    if not days:
        return 0
    events = read_table(spark, silver, "customer_event").where(F.col(EVENT_DAY).isin(days))
    mart = marts.intent_engagement(events)
    folder = versions.current(spark, f"{gold}/{INTENT}")
    if folder is None:
        return write_mart(mart, gold, INTENT, **FILES[INTENT])
    now = F.lit(datetime.now(timezone.utc))
    stamped = mart.withColumn("gold_processed_at", now)
    rows = write_counted(stamped, folder, mode="overwrite", partitionOverwriteMode="dynamic", **FILES[INTENT])
    # Folders of days without rows were not replaced; what they hold is older than this run.
    old = spark.read.parquet(folder).where(F.col("event_date").isin(days) & (F.col("gold_processed_at") < now))
    for r in old.select("event_date").distinct().collect():
        versions.delete(spark, f"{folder}/event_date={r.event_date}")
    return rows
