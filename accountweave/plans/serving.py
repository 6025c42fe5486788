"""Queries on the marts: filters, point lookups, top-N, paging and key figures. Results stay DataFrames.

Filters are written so that Spark pushes them into the Parquet scan. Text that is compared whatever its case has a folded
copy in a written mart (``FOLDED``, see ``plans.runs``); a frame without that copy is compared by an expression.

Pages. A list has an order by its key. ``after`` names the last row of the page before, by its key: the next page
starts behind it, and the bound on the first key column is a predicate for the scan, so a page deep in a list costs what
the first one costs. ``offset`` is there too; it sorts out offset + limit rows in each task, so it is for the first pages.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from accountweave.plans.marts import DAILY_COUNTERS

DEFAULT_PAGE, MAX_PAGE = 50, 500

#: Order of each list: key column and whether it descends.
CUSTOMER_KEY = (("account_id", False),)
PRIORITY_KEY = (("priority_score", True), ("account_id", False))
PERFORMANCE_KEY = (("sales_rep_id", False), ("month", False))
LEAD_KEY = (("lead_id", False),)

#: Columns that are compared whatever their case; a written mart has each of them folded too, under this suffix.
FOLDED = {"customer_360": ("industry",), "sales_prioritization": ("priority_band",), "lead_attribution": ("lead_source",)}
FOLDED_SUFFIX = "_folded"

Key = Sequence[tuple[str, bool]]
After = Row | Mapping | Sequence | None
LARGEST = 1.7976931348623157e308


def clean_nonfinite(df: DataFrame) -> DataFrame:
    """NaN and infinities of all floating-point columns become null."""
    infinite = (float("inf"), float("-inf"))
    floating = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns(
        {c: F.when(~(F.isnan(c) | F.col(c).isin(*infinite)), F.col(c)) for c in floating} if floating else {}
    )


def folded(text: Column) -> Column:
    """Text for comparison whatever its case, null as empty text."""
    return F.lower(F.coalesce(text, F.lit("")))


def with_folded(mart: DataFrame, columns: Sequence[str]) -> DataFrame:
    return mart.withColumns({c + FOLDED_SUFFIX: folded(F.col(c)) for c in columns}) if columns else mart


def _same_text(df: DataFrame, column: str, wanted: str | None) -> Column | None:
    """Case-insensitive equality, null taken as empty text; a plain comparison where the folded column is there."""
    if not wanted:
        return None
    known = column + FOLDED_SUFFIX
    return (F.col(known) if known in df.columns else folded(F.col(column))) == F.lower(F.lit(wanted))


def _flag(column: str, wanted: bool | None) -> Column | None:
    """Boolean equality, null taken as false."""
    if wanted is None:
        return None
    return F.col(column) == F.lit(True) if wanted else (F.col(column) == F.lit(False)) | F.col(column).isNull()


def after_values(key: Key, after: After) -> tuple | None:
    """The values of the key columns in ``after``: a served row, a mapping, or the values themselves."""
    if after is None:
        return None
    if isinstance(after, Row):
        after = after.asDict()
    values = tuple(after[c] for c, _ in key) if isinstance(after, Mapping) else tuple([after] if isinstance(after, str) else after)
    if len(values) != len(key):
        raise ValueError(f"after must have the columns {[c for c, _ in key]}, got {after!r}")
    return values


def _behind(column: Column, value, descending: bool) -> Column:
    """Behind ``value`` in the order; nulls come first in an ascending order and last in a descending one."""
    if value is None:
        return F.lit(False) if descending else column.isNotNull()
    return (column < F.lit(value)) | column.isNull() if descending else column > F.lit(value)


def _not_before(column: Column, value, descending: bool) -> Column:
    if value is None:
        return column.isNull() if descending else F.lit(True)
    return (column <= F.lit(value)) | column.isNull() if descending else column >= F.lit(value)


def behind(key: Key, values: Sequence, columns: Mapping[str, Column] | None = None) -> Column:
    """Rows behind the one with these key values. A bound on the first column stands by itself, for the scan."""
    at = [(columns or {}).get(c, F.col(c)) for c, _ in key]
    parts, same = F.lit(False), F.lit(True)
    for column, value, (_, descending) in zip(at, values, key, strict=True):
        parts |= same & _behind(column, value, descending)
        same &= column.eqNullSafe(F.lit(value))
    return parts if len(at) == 1 else _not_before(at[0], values[0], key[0][1]) & parts


def page(
    df: DataFrame,
    order: Sequence[Column | str],
    limit: int = DEFAULT_PAGE,
    offset: int = 0,
    after: Column | None = None,
) -> DataFrame:
    """The rows of a page. ``after`` is a condition (see ``behind``) and takes the place of an offset."""
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be in 1..{MAX_PAGE}, got {limit}")
    if offset < 0:
        raise ValueError(f"offset must not be negative, got {offset}")
    if after is not None and offset:
        raise ValueError("a page starts after a row or at an offset, not both")
    ordered = df.orderBy(*order)
    return (ordered.offset(offset) if offset else ordered).limit(limit)


def _where(df: DataFrame, *conditions: Column | None) -> DataFrame:
    for condition in conditions:
        if condition is not None:
            df = df.where(condition)
    return df


def _beyond(key: Key, after: After) -> Column | None:
    values = after_values(key, after)
    return None if values is None else behind(key, values)


def _equals(column: str, wanted: str | None) -> Column | None:
    return F.col(column) == wanted if wanted else None


def customers(
    c360: DataFrame,
    account_id: str | None = None,
    industry: str | None = None,
    limit: int = DEFAULT_PAGE,
    offset: int = 0,
    after: After = None,
) -> DataFrame:
    beyond = _beyond(CUSTOMER_KEY, after)
    found = _where(c360, _equals("account_id", account_id), _same_text(c360, "industry", industry), beyond)
    served = found.select(
        "account_id", "account_name", "industry", "employee_count", "annual_revenue", "contact_count",
        "open_opportunity_count", "open_pipeline_value", "won_opportunity_count", "won_pipeline_value",
        "lost_opportunity_count",
    )
    return page(clean_nonfinite(served), ["account_id"], limit, offset, beyond)


def customer(c360: DataFrame, account_id: str) -> DataFrame:
    """The account, or no row when it does not exist."""
    return customers(c360, account_id=account_id, limit=1)


def intent_windows(
    intent: DataFrame,
    account_id: str | None = None,
    limit: int = DEFAULT_PAGE,
    offset: int = 0,
    after: After = None,
) -> DataFrame:
    """Per account: first and last day with activity and the sums in between."""
    beyond = _beyond(CUSTOMER_KEY, after)
    counters = [c for c in DAILY_COUNTERS if c != "brochure_downloads"]
    summed = (
        _where(intent, _equals("account_id", account_id), beyond)
        .groupBy("account_id")
        .agg(
            F.min("event_date").alias("window_start_date"),
            F.max("event_date").alias("window_end_date"),
            *(F.sum(c).cast("bigint").alias(c) for c in counters),
            F.sum("intent_score").cast("double").alias("intent_score"),
        )
    )
    return page(summed, ["account_id"], limit, offset, beyond)


def latest_intent(intent: DataFrame, account_id: str | None = None) -> DataFrame:
    """The newest day of every account (or of one)."""
    measures = F.struct(*(c for c in intent.columns if c != "account_id"))
    newest = (
        _where(intent, _equals("account_id", account_id))
        .groupBy("account_id")
        .agg(F.max_by(measures, "event_date").alias("d"))
    )
    return newest.select("account_id", "d.*")


def priorities(
    prioritization: DataFrame,
    band: str | None = None,
    sales_rep_id: str | None = None,
    limit: int = DEFAULT_PAGE,
    offset: int = 0,
    after: After = None,
) -> DataFrame:
    """Accounts by score, best first; equal scores by account. A score that is null or no number counts as 0.0."""
    found = _where(
        prioritization,
        _same_text(prioritization, "priority_band", band),
        _equals("sales_rep_id", sales_rep_id),
    )
    beyond, values = None, after_values(PRIORITY_KEY, after)
    if values is not None:
        score, raw = values[0] or 0.0, F.col("priority_score")
        # Scores to be read as 0.0: null, and beyond the largest number (infinite, or no number).
        found = found.where((raw <= F.lit(score)) | raw.isNull() | (raw > F.lit(LARGEST)))
        counted = F.coalesce(F.when(F.abs(raw) <= F.lit(LARGEST), raw), F.lit(0.0))
        beyond = behind(PRIORITY_KEY, (score, values[1]), {"priority_score": counted})
        found = found.where(beyond)
    served = found.select(
        "account_id", "account_name", "sales_rep_id", "sales_rep_name", F.col("intent_score").cast("double"),
        "open_pipeline_value", "priority_score", "priority_band",
    )
    best_first = F.coalesce("priority_score", F.lit(0.0)).desc()
    return page(clean_nonfinite(served), [best_first, "account_id"], limit, offset, beyond)


def published_performance(performance: DataFrame) -> DataFrame:
    """Mart columns under their published names."""
    return performance.select(
        "sales_rep_id",
        "sales_rep_name",
        "month",
        F.col("opportunities_closed").alias("total_opportunities"),
        "won_opportunities",
        "lost_opportunities",
        F.col("open_revenue").alias("open_pipeline_value"),
        F.col("won_revenue").alias("won_pipeline_value"),
        "win_rate",
        F.col("average_deal_size").alias("avg_deal_size"),
    )


def performance_by_rep(
    performance: DataFrame,
    sales_rep_id: str | None = None,
    month: str | None = None,
    limit: int = DEFAULT_PAGE,
    offset: int = 0,
    after: After = None,
) -> DataFrame:
    beyond = _beyond(PERFORMANCE_KEY, after)
    found = _where(performance, _equals("sales_rep_id", sales_rep_id), _equals("month", month), beyond)
    return page(clean_nonfinite(published_performance(found)), ["sales_rep_id", "month"], limit, offset, beyond)


def published_leads(attribution: DataFrame) -> DataFrame:
    return attribution.select(
        "lead_id",
        "lead_source",
        "is_converted",
        F.col("converted_account_id").alias("account_id"),
        F.col("converted_opportunity_id").alias("opportunity_id"),
        F.col("converted_opportunity_amount").alias("opportunity_amount"),
        F.col("is_won_deal").alias("is_won"),
    )


def leads(
    attribution: DataFrame,
    lead_source: str | None = None,
    is_converted: bool | None = None,
    limit: int = DEFAULT_PAGE,
    offset: int = 0,
    after: After = None,
) -> DataFrame:
    beyond = _beyond(LEAD_KEY, after)
    found = _where(
        attribution, _same_text(attribution, "lead_source", lead_source), _flag("is_converted", is_converted), beyond
    )
    return page(clean_nonfinite(published_leads(found)), ["lead_id"], limit, offset, beyond)


def account_names(c360: DataFrame) -> DataFrame:
    """Distinct names for a pick list."""
    return c360.select("account_name").where(F.col("account_name").isNotNull()).distinct()


def account_intent(c360: DataFrame, intent: DataFrame, account_name: str) -> DataFrame:
    """Newest intent day of the account with this name (the smallest id, should several share it).

    The id is a scalar subquery: it is known before the intent mart is opened, so it is a bound for the scan there, which
    skips what a sorted file or a bloom filter shows not to hold it.
    """
    chosen = c360.where(F.col("account_name") == account_name).agg(F.min("account_id")).scalar()
    days = intent.where(F.col("account_id") == chosen)
    return latest_intent(days).select(
        "account_id",
        F.lit(account_name).alias("account_name"),
        "event_date",
        "website_visits",
        "product_views",
        "pricing_views",
        "documentation_views",
        "demo_requests",
        F.col("intent_score").cast("double").alias("intent_score"),
    )


def executive_kpis(c360: DataFrame, prioritization: DataFrame) -> DataFrame:
    """One row: accounts, open pipeline, won revenue, accounts in the top band. One aggregate over both marts."""
    none = F.lit(0.0)
    accounts = c360.select(
        F.lit(1).alias("account"), "open_pipeline_value", "won_pipeline_value", F.lit(0).alias("tier_1")
    )
    banded = prioritization.select(
        F.lit(0).alias("account"),
        none.alias("open_pipeline_value"),
        none.alias("won_pipeline_value"),
        F.when(F.col("priority_band") == "Tier 1", 1).otherwise(0).alias("tier_1"),
    )
    return accounts.unionByName(banded).agg(
        F.coalesce(F.sum("account"), F.lit(0)).cast("bigint").alias("total_accounts"),
        _total("open_pipeline_value").alias("total_open_pipeline"),
        _total("won_pipeline_value").alias("total_won_revenue"),
        F.coalesce(F.sum("tier_1"), F.lit(0)).cast("bigint").alias("tier_1_accounts"),
    )


def count_by(df: DataFrame, column: str, name: str = "row_count") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(name))


def _total(column: str) -> Column:
    """Exact sum of a money column held as double."""
    return F.coalesce(F.sum(F.col(column).cast("decimal(28,2)")).cast("double"), F.lit(0.0))


def rep_revenue(performance: DataFrame) -> DataFrame:
    """Per rep over all months: won and open money as published, and the money of all its opportunities.

    Reps are told apart by id: two of one name stay two rows.
    """
    return performance.groupBy("sales_rep_id", "sales_rep_name").agg(
        _total("won_revenue").alias("won_pipeline_value"),
        _total("open_revenue").alias("open_pipeline_value"),
        _total("pipeline_closed").alias("all_pipeline_value"),
    )


def lead_sources(attribution: DataFrame) -> DataFrame:
    """Leads, conversions, won deals and money per lead source; leads without a source are left out."""
    return (
        published_leads(attribution)
        .where(F.col("lead_source").isNotNull())
        .groupBy("lead_source")
        .agg(
            F.count("lead_id").alias("total_leads"),
            F.count_if("is_converted").alias("converted_leads"),
            F.count_if("is_won").alias("won_deals"),
            _total("opportunity_amount").alias("won_revenue"),
        )
    )
