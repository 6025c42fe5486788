"""Incremental landing of CRM objects, with a high-water mark per object.

The source is anything that yields a DataFrame for an object name (a table, files, JDBC). One object is landed as:
filter by mark -> project -> add batch columns -> write the batch where no reader looks -> look at what was counted ->
publish the batch by one rename, or drop it when it is empty -> commit the new mark. The source is read once, and rows, count
and mark are those of one reading. The mark is committed only after the batch was published; a run that is repeated
after a failure lands rows again, and keep-latest in the canonical tables makes that harmless.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from accountweave.functions import to_instant
from accountweave.schemas import CRM_COLUMNS, WATERMARK_LOG
from accountweave.sources import versions

log = logging.getLogger(__name__)

MODIFIED = "SystemModstamp"
SOURCE_SYSTEM = "salesforce"
#: Folder of a table for batches that are not published.
UNPUBLISHED = "_unpublished"


def projection(object_name: str, df: DataFrame) -> list[Column]:
    """The landed columns of an object; the nested role title is flattened."""
    if object_name not in CRM_COLUMNS:
        raise ValueError(f"unknown object {object_name!r}, known: {sorted(CRM_COLUMNS)}")
    nested_role = "UserRole" in df.columns
    return [
        F.col("UserRole.Name").alias(c) if c == "UserRole_Name" and nested_role else F.col(c)
        for c in CRM_COLUMNS[object_name]
    ]


def modified_after(df: DataFrame, mark: str | None, overlap: timedelta = timedelta()) -> DataFrame:
    """Rows modified strictly after ``mark`` (text of an instant), all rows without one.

    Instants are compared, not text. A source column that is a timestamp already is compared as it is, so that the
    filter reaches the scan. ``overlap`` re-reads a stretch before the mark, for sources whose rows show up late.
    """
    if mark is None:
        return df
    modified = F.col(MODIFIED) if df.schema[MODIFIED].dataType.typeName() == "timestamp" else to_instant(MODIFIED)
    return df.where(modified > F.lit(mark).cast("timestamp") - F.lit(overlap))


def extract(
    source: DataFrame,
    object_name: str,
    mark: str | None,
    batch_id: str,
    overlap: timedelta = timedelta(),
) -> DataFrame:
    """New or changed rows of one object, with the batch columns."""
    return modified_after(source, mark, overlap).select(
        *projection(object_name, source),
        F.current_timestamp().alias("_ingested_at"),
        F.lit(SOURCE_SYSTEM).alias("_source_system"),
        F.lit(batch_id).alias("_batch_id"),
    )


def high_water(previous: str | None = None) -> Column:
    """Aggregate: greatest modification time, or the previous mark when that is later (``greatest`` skips nulls)."""
    return F.greatest(F.max(to_instant(MODIFIED)), F.lit(previous).cast("timestamp"))


class MarkLog:
    """Committed marks: an append-only log, a file per commit, and now and then a snapshot that takes files in.

    The newest entry of an object counts. Appending one row is atomic through the file committer. Marks are handed
    around as text in session time (UTC), which keeps their microseconds and no machine's own time zone.

    Once ``compact_after`` files have gathered, a commit writes all entries as a new snapshot, and only when that is
    complete removes the files and snapshots in it. Wherever that stops, each entry is in a file or in a complete snapshot,
    perhaps in both, which changes nothing. So at most ``compact_after`` files and a few snapshots are ever read.
    One writer at a time.
    """

    SNAPSHOTS = "_snapshots"

    def __init__(self, spark: SparkSession, path: str, compact_after: int = 100):
        self.spark, self.path, self.compact_after = spark, path, compact_after

    def _files(self) -> list[str]:
        return [f"{self.path}/{n}" for n in versions.children(self.spark, self.path) if n[0] not in "._"]

    def _snapshots(self) -> list[str]:
        """Complete snapshots."""
        folder = f"{self.path}/{self.SNAPSHOTS}"
        found = [f"{folder}/{n}" for n in versions.children(self.spark, folder)]
        return [f for f in found if versions.exists(self.spark, f"{f}/_SUCCESS")]

    def _read(self, paths: Sequence[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], WATERMARK_LOG)
        reader = self.spark.read.schema(WATERMARK_LOG).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
        return reader.parquet(*paths)

    def entries(self) -> DataFrame:
        """All entries, each once; a file that cannot be read is passed over, then an older mark counts."""
        snapshots = self._snapshots()
        return self._read([*self._files(), *snapshots]).distinct() if snapshots else self._read(self._files())

    def latest(self, object_name: str) -> str | None:
        """The committed mark; None (a full load) when there is none."""
        newest = F.max_by("high_water", "updated_at").cast("string").alias("high_water")
        return self.entries().where(F.col("object_name") == object_name).agg(newest).first()["high_water"]

    def commit(self, object_name: str, mark: str, batch_id: str, row_count: int) -> None:
        entry = self.spark.range(1).select(
            F.lit(object_name).alias("object_name"),
            F.lit(mark).cast("timestamp").alias("high_water"),
            F.lit(batch_id).alias("batch_id"),
            F.lit(row_count).cast("bigint").alias("row_count"),
            F.lit("SUCCESS").alias("status"),
            F.current_timestamp().alias("updated_at"),
        )
        entry.coalesce(1).write.mode("append").parquet(self.path)
        if len(self._files()) >= self.compact_after:
            self.compact()

    def compact(self) -> None:
        """Put all entries into one snapshot, then remove what it holds."""
        files, snapshots = self._files(), self._snapshots()
        whole = f"{self.path}/{self.SNAPSHOTS}/{uuid.uuid4().hex}"
        self._read([*files, *snapshots]).distinct().coalesce(1).write.parquet(whole)
        self._drop([*files, *snapshots])

    def _drop(self, paths: Sequence[str]) -> None:
        for path in paths:
            versions.delete(self.spark, path)


@dataclass(frozen=True)
class LandingResult:
    object_name: str
    status: str  # landed, unchanged or failed
    row_count: int = 0
    mark: str | None = None
    batch_id: str | None = None
    error: str | None = None


def land_object(
    source: DataFrame,
    object_name: str,
    bronze: str,
    marks: MarkLog,
    full_load: bool = False,
    overlap: timedelta = timedelta(),
) -> LandingResult:
    """Land one object, as a folder ``_batch_id=..`` of its table. Without new rows the table stays as it is.

    Rows and mark are observed while the batch is written; nothing else reads the source. What a run that died leaves in
    the hidden folder is read by nobody.
    """
    mark = None if full_load else marks.latest(object_name)
    batch_id = str(uuid.uuid4())
    batch = extract(source, object_name, mark, batch_id, overlap).drop("_batch_id")

    spark, table = source.sparkSession, f"{bronze}/{object_name}"
    hidden = f"{table}/{UNPUBLISHED}/{batch_id}"
    seen = Observation(f"land {object_name}")
    reached = high_water(mark).cast("string").alias("mark")
    batch.observe(seen, F.count(F.lit(1)).alias("row_count"), reached).write.parquet(hidden)
    row_count, new_mark = seen.get["row_count"], seen.get["mark"]
    if not row_count:
        versions.delete(spark, hidden)
        return LandingResult(object_name, "unchanged", mark=mark)
    versions.rename(spark, hidden, f"{table}/_batch_id={batch_id}")
    if new_mark is not None:
        marks.commit(object_name, new_mark, batch_id, row_count)
    return LandingResult(object_name, "landed", row_count, new_mark, batch_id)


def land_all(
    source: Callable[[str], DataFrame],
    bronze: str,
    marks: MarkLog,
    objects: Sequence[str] | None = None,
    full_load: bool = False,
    overlap: timedelta = timedelta(),
) -> list[LandingResult]:
    """Land the objects in their fixed order; a failing object is reported and the others go on."""
    results = []
    for object_name in objects or tuple(CRM_COLUMNS):
        try:
            results.append(land_object(source(object_name), object_name, bronze, marks, full_load, overlap))
        except Exception as error:  # noqa: BLE001 - any failure belongs to this object only
            log.exception("landing of %s failed", object_name)
            results.append(LandingResult(object_name, "failed", error=str(error)))
    return results
