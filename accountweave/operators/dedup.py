"""Keep-latest deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sortable(df: DataFrame, name: str) -> Column:
    """A column in a form that has an order."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.MapType):
        return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(name))))
    if isinstance(kind, T.VariantType):
        return F.to_json(name)
    return F.col(name)


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """64 bits over the values of some columns, the same in every run and engine session."""
    return F.xxhash64(*(sortable(df, c) for c in columns))


def keep_latest(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by the ``newest`` columns, nulls last.

    Ties are broken by one hash over the remaining columns, so the survivor does not depend on the order in which rows
    arrive, and rows are sorted by key, ``newest`` and that hash alone. The rank filter is ``= 1``, which Spark turns
    into a group limit on both sides of the shuffle: each map task sends at most one row per key, so a key that holds
    a large share of all rows does not reach one task whole.
    """
    newest = [c for c in newest if c in df.columns]
    rest = [c for c in df.columns if c not in set(keys) | set(newest)]
    order = [sortable(df, c).desc_nulls_last() for c in newest]
    tie = [F.col("_tie").desc()] if rest else []
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *tie))
    ranked = df.withColumn("_tie", row_hash(df, rest)) if rest else df
    return ranked.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank", "_tie")
