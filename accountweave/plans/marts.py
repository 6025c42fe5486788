"""The five marts. Facts are aggregated per key first and joined to the (one row per key) entity afterwards."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountweave.functions import ScoreRules, event_weight, priority_band, priority_score
from accountweave.operators.joins import HOT_KEY_ROWS, lookup_join

UNKNOWN_DAYS = 999


def as_day(value: str | date) -> Column:
    return F.lit(str(value)).cast("date")


def _money(total: Column) -> Column:
    """Sums stay exact (decimal) and become double last; nothing summed is 0.0."""
    return F.coalesce(total.cast("double"), F.lit(0.0))


def _since(day: Column, as_of: Column, days: int, upper_bound: bool) -> Column:
    """``day`` not before ``as_of - days``; by default there is no upper end, later activity counts too."""
    inside = day >= F.date_sub(as_of, days)
    return inside & (day < F.date_add(as_of, 1)) if upper_bound else inside


def contacts_per_account(contacts: DataFrame) -> DataFrame:
    return (
        contacts.where(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(F.count("contact_id").alias("contact_count"))
    )


def opportunities_per_account(opportunities: DataFrame) -> DataFrame:
    is_open, is_won = ~F.col("is_closed"), F.col("is_won")
    return (
        opportunities.where(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(
            F.count_if(is_open).alias("open_opportunity_count"),
            _money(F.sum(F.when(is_open, F.col("amount")))).alias("open_pipeline_value"),
            F.count_if(is_won).alias("won_opportunity_count"),
            _money(F.sum(F.when(is_won, F.col("amount")))).alias("won_pipeline_value"),
            F.count_if(~is_open & ~is_won).alias("lost_opportunity_count"),
        )
    )


def activity_per_account(events: DataFrame, as_of: str | date, upper_bound: bool = False) -> DataFrame:
    at = F.col("event_timestamp")
    day = as_day(as_of)
    return (
        events.where(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(
            F.max(at).alias("last_activity_at"),
            F.count_if(_since(at, day, 7, upper_bound)).alias("events_last_7d"),
            F.count_if(_since(at, day, 30, upper_bound)).alias("events_last_30d"),
        )
    )


def customer_360(
    accounts: DataFrame,
    contacts: DataFrame,
    opportunities: DataFrame,
    sales_reps: DataFrame,
    events: DataFrame,
    as_of: str | date,
    upper_bound: bool = False,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """One row per account: contacts, pipeline, recent activity and owner.

    The owner lookup comes first, on accounts only; the three aggregates share the account key, so that accounts are
    shuffled once for all of them.
    """
    profile = accounts.select(
        "account_id",
        "account_name",
        "industry",
        "employee_count",
        "annual_revenue",
        "website",
        F.col("owner_id").alias("sales_rep_id"),
    )
    reps = sales_reps.select(
        "sales_rep_id", F.col("name").alias("sales_rep_name"), F.col("email").alias("sales_rep_email")
    )
    owned = lookup_join(profile, reps, "sales_rep_id", ["account_id"], hot_rows=hot_rows)
    joined = (
        owned.join(contacts_per_account(contacts), "account_id", "left")
        .join(opportunities_per_account(opportunities), "account_id", "left")
        .join(activity_per_account(events, as_of, upper_bound), "account_id", "left")
    )
    counts = [
        "contact_count",
        "open_opportunity_count",
        "won_opportunity_count",
        "lost_opportunity_count",
        "events_last_7d",
        "events_last_30d",
    ]
    filled = joined.fillna({c: 0 for c in counts} | {"open_pipeline_value": 0.0, "won_pipeline_value": 0.0})
    return filled.select(
        "account_id", "account_name", "industry", "employee_count", "annual_revenue", "website", "contact_count",
        "open_opportunity_count", "open_pipeline_value", "won_opportunity_count", "won_pipeline_value",
        "lost_opportunity_count", "last_activity_at", "events_last_7d", "events_last_30d", "sales_rep_id",
        "sales_rep_name", "sales_rep_email",
    )


# Mart column -> event type it counts.
DAILY_COUNTERS = {
    "website_visits": "website_visit",
    "product_views": "product_page_view",
    "pricing_views": "pricing_page_view",
    "documentation_views": "documentation_view",
    "brochure_downloads": "brochure_download",
    "demo_requests": "demo_request",
}


def intent_measures() -> list[Column]:
    """The aggregates of one account day (also used by the streaming form)."""
    kind = F.col("event_type")
    return [
        *(F.count_if(kind == event_type).alias(name) for name, event_type in DAILY_COUNTERS.items()),
        F.coalesce(F.sum("duration_seconds"), F.lit(0)).cast("bigint").alias("total_duration_seconds"),
        F.count("event_id").alias("engagement_score"),
        F.sum(event_weight(kind)).alias("intent_score"),
    ]


def intent_engagement(events: DataFrame) -> DataFrame:
    """One row per account and day with resolved events."""
    return (
        events.where(F.col("account_id").isNotNull())
        .groupBy("account_id", F.to_date("event_timestamp").alias("event_date"))
        .agg(*intent_measures())
    )


def recent_intent(intent: DataFrame, as_of: str | date, days: int = 14, upper_bound: bool = False) -> DataFrame:
    """Daily mart -> sums per account over the trailing days."""
    return (
        intent.where(_since(F.col("event_date"), as_day(as_of), days, upper_bound))
        .groupBy("account_id")
        .agg(
            F.sum("intent_score").cast("bigint").alias("intent_score"),
            F.sum("engagement_score").cast("bigint").alias("engagement_score"),
        )
    )


def sales_prioritization(
    c360: DataFrame,
    intent: DataFrame,
    as_of: str | date,
    rules: ScoreRules = ScoreRules(),
    upper_bound: bool = False,
) -> DataFrame:
    """One scored and banded row per account."""
    base = c360.select(
        "account_id", "account_name", "sales_rep_id", "sales_rep_name", "open_pipeline_value", "open_opportunity_count",
        F.coalesce(F.datediff(as_day(as_of), F.to_date("last_activity_at")), F.lit(UNKNOWN_DAYS)).alias(
            "days_since_last_activity"
        ),
    )
    joined = base.join(recent_intent(intent, as_of, upper_bound=upper_bound), "account_id", "left").fillna(
        {"intent_score": 0, "engagement_score": 0}
    )
    score = priority_score(
        "intent_score", "open_pipeline_value", "days_since_last_activity", "open_opportunity_count", rules
    )
    return (
        joined.withColumn("priority_score", score)
        .withColumn("priority_band", priority_band("priority_score"))
        .select(
            "account_id", "account_name", "sales_rep_id", "sales_rep_name", "intent_score", "engagement_score",
            "open_pipeline_value", "open_opportunity_count", "days_since_last_activity", "priority_score",
            "priority_band",
        )
    )


def _ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` to two places, 0.0 when there is nothing to divide by."""
    return F.when(whole > 0, F.round(part / whole, 2)).otherwise(0.0)


def sales_performance(opportunities: DataFrame, sales_reps: DataFrame) -> DataFrame:
    """One row per rep and month of the close date. Owners that are not reps drop out.

    ``opportunities_closed`` and ``pipeline_closed`` cover all opportunities of the month, open ones too;
    ``open_revenue`` is the money of the open ones.
    """
    is_won = F.col("is_won")
    monthly = (
        opportunities.where(F.col("owner_id").isNotNull())
        .groupBy(F.col("owner_id").alias("sales_rep_id"), F.date_format("close_date", "yyyy-MM").alias("month"))
        .agg(
            F.count("opportunity_id").alias("opportunities_closed"),
            F.count_if(is_won).alias("won_opportunities"),
            F.count_if(F.col("is_closed") & ~is_won).alias("lost_opportunities"),
            _money(F.sum("amount")).alias("pipeline_closed"),
            _money(F.sum(F.when(is_won, F.col("amount")))).alias("won_revenue"),
            _money(F.sum(F.when(~F.col("is_closed"), F.col("amount")))).alias("open_revenue"),
        )
    )
    reps = sales_reps.select("sales_rep_id", F.col("name").alias("sales_rep_name"))
    return monthly.join(reps, "sales_rep_id").select(
        "sales_rep_id",
        "sales_rep_name",
        "month",
        "opportunities_closed",
        "won_opportunities",
        "lost_opportunities",
        "pipeline_closed",
        "won_revenue",
        "open_revenue",
        _ratio(F.col("won_opportunities") * 100.0, F.col("opportunities_closed")).alias("win_rate"),
        _ratio(F.col("won_revenue"), F.col("won_opportunities")).alias("average_deal_size"),
    )


def lead_attribution(leads: DataFrame, opportunities: DataFrame, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """One row per lead with its conversion and the money behind it.

    The conversion day is the day of the last update, the only trace that the source keeps.
    """
    deals = opportunities.select(
        F.col("opportunity_id").alias("converted_opportunity_id"),
        F.col("amount").cast("double").alias("deal_amount"),
        F.col("is_won").alias("deal_won"),
    )
    converted_on = F.when(F.col("is_converted"), F.to_date("updated_at"))
    joined = lookup_join(leads, deals, "converted_opportunity_id", ["lead_id"], hot_rows=hot_rows)
    return joined.select(
        "lead_id",
        "lead_source",
        "status",
        "rating",
        "created_at",
        "is_converted",
        "converted_account_id",
        "converted_contact_id",
        "converted_opportunity_id",
        converted_on.alias("conversion_date"),
        F.datediff(converted_on, F.to_date("created_at")).alias("days_to_conversion"),
        F.coalesce("deal_amount", F.lit(0.0)).alias("converted_opportunity_amount"),
        F.coalesce("deal_won", F.lit(False)).alias("is_won_deal"),
    )
