"""Referential integrity and mart audits. All results are small tables, none is printed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphan_keys(child: DataFrame, link: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Values of a foreign key that have no parent row, and how many child rows carry each. Null links are fine.

    Children are counted per key before the anti join, so a frequent key is one row there.
    """
    counted = child.where(F.col(link).isNotNull()).groupBy(link).agg(F.count("*").alias("orphan_rows"))
    parents = parent.select(F.col(parent_key).alias(link))
    return counted.join(parents, link, "left_anti")


def _rule(name: str, orphans: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("orphan_rows"), F.lit(0)).cast("bigint")
    return orphans.agg(total.alias("orphan_rows")).select(F.lit(name).alias("rule"), "orphan_rows")


def integrity_report(contacts: DataFrame, accounts: DataFrame, opportunities: DataFrame, roles: DataFrame) -> DataFrame:
    """One row per foreign-key rule with the number of orphan rows (0 for a clean or an empty table)."""
    checks = {
        "contact_account": orphan_keys(contacts, "account_id", accounts, "account_id"),
        "opportunity_account": orphan_keys(opportunities, "account_id", accounts, "account_id"),
        "role_opportunity": orphan_keys(roles, "opportunity_id", opportunities, "opportunity_id"),
        "role_contact": orphan_keys(roles, "contact_id", contacts, "contact_id"),
    }
    return reduce(DataFrame.unionByName, (_rule(name, orphans) for name, orphans in checks.items()))


def mart_audit(marts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``{mart: (frame, key column)}`` -> rows and distinct keys per mart."""
    return reduce(
        DataFrame.unionByName,
        (
            df.agg(F.count("*").alias("row_count"), F.count_distinct(key).alias("distinct_keys")).select(
                F.lit(mart).alias("mart"), F.lit(key).alias("key_column"), "row_count", "distinct_keys"
            )
            for mart, (df, key) in marts.items()
        ),
    )
