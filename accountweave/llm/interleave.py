"""Sharding by proportional stratified interleaving: every shard holds the mixture of the whole.

Rows of a stratum (a source) are put into a seeded random order, the hash of seed, id and text. The row at place ``k`` of
``n`` gets the fraction ``(k + 0.5) / n``. All rows are sorted by fraction, so that each stretch of the order holds the
strata in proportion, and the order is cut into shards whose counts differ by one at most. Of each stratum a shard gets
its exact share, give or take one row.

Both ranks, within the stratum and over all rows, are taken by ``numbered``: rows are dealt by range, each part is counted,
and a row's number is its place in its part after the counts of the parts before. A stratum with a third of all rows
lies in as many parts as its size asks for, and no task sees more than a part. Only ids, sizes and hashes move, never
texts, until shards are written. Built-in functions only.

Defined cases: a null text has size 1 and the checksum of nothing; a null source is a stratum of its own; null ids
count as one value; rows that agree in all columns used here are each placed, in any order among them; an empty table
gives no rows; with fewer rows than shards some shards are empty. Other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountweave.llm.common import KEY, ROW, stage, text_of

#: Seed of the order within a stratum, and the number of shards.
SEED, SHARDS = 20_240_601, 8
PART = "__aw_part"


def shown(column: Column) -> Column:
    """A text that tells null from any value."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("-"))


def numbered(rows: DataFrame, order: list[str], group: str | None = None, name: str = "number") -> DataFrame:
    """``rows`` with ``number``, the place from 0 in the ``order`` (within ``group``, which has no nulls), and ``total``.

    Rows are dealt by range of all these columns and written with their part, so that parts are the same for all that
    follows. Counts per part are at most one row per part and group.
    """
    own = [group] if group else []
    parts = stage(rows.repartitionByRange(*own, *order).withColumn(PART, F.spark_partition_id()), name)
    counts = parts.groupBy(*own, PART).agg(F.count("*").alias("n"))
    whole = Window.partitionBy(*own)
    before = F.coalesce(F.sum("n").over(whole.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*own, PART, before.alias("before"), F.sum("n").over(whole).alias("total"))
    place = F.row_number().over(Window.partitionBy(*own, PART).orderBy(*order)) - 1
    return parts.withColumn("place", place).join(counts, [*own, PART]).withColumn("number", F.col("place") + F.col("before")).drop(PART, "place", "before")


def narrow(
    seed: int = SEED, id_column: str = "doc_id", text_column: str = "text", stratum_column: str = "source"
) -> list[Column]:
    """All that placing a row needs, without its text: ``id, size, text_crc32, stratum, shuffled``."""
    text, own = text_of(text_column), shown(F.col(id_column))
    return [
        F.col(id_column).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shown(F.col(stratum_column)).alias("stratum"),
        F.unhex(F.md5(F.concat(F.lit(f"{seed} "), own, F.lit(" "), text).cast("binary"))).alias("shuffled"),
    ]


def placed(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, a row's place in its shard, from ``stratum``, ``shuffled`` and a row number.

    The row number only splits rows that agree in all else over parts.
    """
    within = numbered(rows, ["shuffled", KEY], "stratum", "within-strata")
    within = within.withColumn("fraction", (F.col("number") + F.lit(0.5)) / F.col("total")).drop("number", "total")
    over = numbered(within, ["fraction", "stratum", "shuffled", KEY], name="over-all")
    shard = over.withColumn("shard", F.expr(f"number * {shards} div total"))
    slot = F.col("number") - F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return shard.withColumn("slot", slot).withColumn("shard", F.col("shard").cast("int")).drop("number", "total", "fraction")


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, **columns: str) -> DataFrame:
    """``id, size, text_crc32, shard, slot`` of every row of ``docs``; ``columns`` as in ``narrow``."""
    rows = stage(docs.select(*narrow(seed, **columns), F.monotonically_increasing_id().alias(KEY)), "narrow")
    return placed(rows, shards).select("id", "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, **columns: str) -> None:
    """Whole rows as Parquet below ``path``: a column ``slot``, the row as struct ``row``, a folder per ``shard``.

    The files of a folder are sorted by slot and hold ranges of slots. Rows are numbered in a staged copy, placed by
    their narrow columns, and moved once.
    """
    marked = stage(docs.select(*narrow(seed, **columns), F.struct("*").alias(ROW), F.monotonically_increasing_id().alias(KEY)), "marked")
    places = placed(marked.drop(ROW), shards).select(KEY, "shard", "slot")
    moved = marked.select(KEY, F.col(ROW).alias("row")).join(places, KEY).drop(KEY)
    moved.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
