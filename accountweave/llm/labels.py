"""Labels of documents: folds by checksum, one label per id, bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_column: str, folds: int) -> Column:
    """Checksum of the id as text, by ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % folds


def known(labels: DataFrame, column: str, folds: int, held_out: int, id_column: str = "doc_id") -> DataFrame:
    """``label_id, label`` of the ids outside the held-out fold. Of several labels of an id the mean decides, a tie for 1."""
    rows = labels.where(F.col(id_column).isNotNull() & F.col(column).isNotNull() & (fold(id_column, folds) != held_out))
    label = (F.avg(F.col(column).cast("double")) >= 0.5).cast("int").alias("label")
    return rows.groupBy(F.col(id_column).alias("label_id")).agg(label)


def sampled(id_column: str | Column, share: float) -> Column:
    """The same ids each time: about ``share`` of them."""
    return F.pmod(F.xxhash64(id_column, F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20))
