"""Left lookups that stay balanced when a key is null or very frequent."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountweave.sources.staging import stage

HOT_KEY_ROWS = 2_000_000
NULL_BUCKETS = 100_000
#: Groups of keys that rows are counted by before any key is counted by itself.
KEY_BUCKETS = 1 << 16


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, as ``_n``."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("_n"))


def hot_counts(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """``key_counts`` of the keys that have more than ``hot_rows`` rows.

    Where most keys differ, counting each of them shuffles a row per row. So rows are counted by a hash of the key first, at
    most ``KEY_BUCKETS`` rows per task. A bucket of up to ``hot_rows`` rows holds no hot key; only keys of the other
    buckets are counted one by one, and where there is no such bucket the rows are not read again.
    """
    known = df.dropna(subset=list(keys)).select(*keys, F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).alias("_bucket"))
    full = known.groupBy("_bucket").agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows).select("_bucket")
    counts = key_counts(known.join(F.broadcast(full), "_bucket", "left_semi"), keys)
    return counts.where(F.col("_n") > hot_rows)


def hot_keys(counts: DataFrame, keys: Sequence[str], hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Every key of more than ``hot_rows`` rows and the number of chunks it is to be split into.

    Fewer than one row per ``hot_rows`` rows counted. Counts are exact, so a recomputed task sees the same chunks.
    """
    chunks = F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_chunks")
    return counts.where(F.col("_n") > hot_rows).select(*keys, chunks)


def _is_small(df: DataFrame) -> bool:
    """Whether Spark would broadcast ``df``, by the size that it estimates."""
    session = df.sparkSession._jsparkSession.sessionState().conf()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= session.autoBroadcastJoinThreshold()


def _is_table(df: DataFrame) -> bool:
    """Whether ``df`` only filters and projects the rows of files."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().head()
    return plan.nodeName().startswith(("LogicalRelation", "Relation"))


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    key: str | Sequence[str],
    spread_by: Sequence[str],
    counts: DataFrame | None = None,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Left join of ``left`` to ``lookup``, which has one row per key; key columns have one name on both sides.

    The join is on the key and a slot: rows with a null key, which match nothing, are dealt over many slots; rows of a
    hot key are dealt over its chunks, and the one lookup row of that key is repeated once per chunk. All other keys
    have slot 0. Slots come from a hash of ``spread_by`` (columns that tell the rows of one key apart), never from a
    random number: a task that is run again deals the same way. Hot keys and the repeats of their rows are written
    first, so Spark knows the true sizes of all sides and chooses broadcast or shuffle by them.

    ``counts`` gives the rows per key (key columns and ``_n``, one row per key) where the caller has them already, of the
    hot keys at least; else these are counted on ``left``. That reads its key columns once more, so a ``left`` that is no
    table yet but the result of joins or aggregations is written first and not computed twice. Counts only set the chunk
    numbers.

    A ``lookup`` that Spark's own estimate puts below its broadcast threshold is broadcast, and nothing is counted,
    dealt or written: no row of ``left`` moves then, so no key can be hot.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if _is_small(lookup):
        return left.join(lookup, keys, "left")
    if counts is None and not _is_table(left):
        left = stage(left, "lookup-left")
    hot = stage(hot_keys(hot_counts(left, keys, hot_rows) if counts is None else counts, keys, hot_rows), "hot-keys")
    deal = F.xxhash64(*spread_by)
    no_match = reduce(or_, (F.col(k).isNull() for k in keys))
    slotted = (
        left.join(hot, keys, "left")
        .withColumn(
            "_slot",
            F.when(no_match, F.pmod(deal, F.lit(NULL_BUCKETS)))
            .when(F.col("_chunks").isNotNull(), F.pmod(deal, F.col("_chunks")))
            .otherwise(0)
            .cast("int"),
        )
        .drop("_chunks")
    )
    # Always 0, but no literal: Spark folds a literal out of the join, whose rows are then shuffled by the key alone, so
    # that all null keys reach one task.
    first_slot = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")
    repeated = lookup.withColumn("_slot", first_slot)
    if not hot.isEmpty():
        # A hot key has two chunks at least.
        others = lookup.join(hot, keys).withColumn("_slot", F.explode(F.sequence(F.lit(1), F.col("_chunks") - 1)))
        repeated = repeated.unionByName(stage(others.drop("_chunks"), "hot-lookups"))
    return slotted.join(repeated, [*keys, "_slot"], "left").drop("_slot")
