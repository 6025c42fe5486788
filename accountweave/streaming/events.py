"""Customer events from a message stream to the landed table, and the streaming forms of dedup and daily intent."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from accountweave.functions import to_instant
from accountweave.operators.contract import split_by_contract, with_violations
from accountweave.operators.dedup import row_hash, sortable
from accountweave.plans.marts import intent_measures
from accountweave.schemas import EVENT_MESSAGE
from accountweave.sources.tables import write_counted

SOURCE_SYSTEM = "digital_events"
TRIGGER = "5 seconds"
TOPIC = "customer-events"


def kafka_messages(
    spark: SparkSession, servers: str, topic: str = TOPIC, max_offsets_per_trigger: int | None = None
) -> DataFrame:
    """Topic from its beginning; lost offsets do not stop the stream.

    ``max_offsets_per_trigger`` bounds a micro-batch, the first one after a long stop in particular.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def decode(messages: DataFrame) -> DataFrame:
    """Message envelope -> JSON text with its position in the topic."""
    return messages.selectExpr(
        "cast(value as string) as json_payload",
        "offset as _kafka_offset",
        "partition as _kafka_partition",
    )


def parse_events(decoded: DataFrame) -> DataFrame:
    """JSON text -> landed event. Narrow and stateless; the same for a batch and for a stream.

    Text that is not valid JSON gives a row of nulls, which the canonical table drops; see ``contract`` for the
    quarantine.
    """
    message = F.from_json("json_payload", EVENT_MESSAGE)
    return decoded.select(message.alias("m"), "_kafka_offset", "_kafka_partition").select(
        "m.event_id",
        "m.event_type",
        to_instant("m.timestamp").alias("timestamp"),
        "m.identity_resolution",
        "m.attributes",
        "_kafka_offset",
        "_kafka_partition",
        F.current_timestamp().alias("_ingested_at"),
        F.lit(SOURCE_SYSTEM).alias("_source_system"),
    )


def _append(df: DataFrame, name: str, path: str, checkpoint: str, available_now: bool) -> StreamingQuery:
    if not checkpoint:
        raise ValueError("name a lasting folder for the checkpoint: with a new one the sink skips batches it has seen the numbers of")
    trigger = {"availableNow": True} if available_now else {"processingTime": TRIGGER}
    return (
        df.writeStream.queryName(name)
        .format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def land_events(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    name: str = "events_to_bronze",
) -> StreamingQuery:
    """Append the parsed messages to a Parquet table; checkpoint and sink log make each file count once.

    ``checkpoint`` belongs to ``path`` for good: a restart must name the same one.
    """
    return _append(parse_events(decode(messages)), name, path, checkpoint, available_now)


def quarantine_events(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    name: str = "events_quarantine",
) -> StreamingQuery:
    """Append the raw text of messages that break the contract, with the codes of the broken rules."""
    _, rejected = split_by_contract(decode(messages))
    return _append(rejected, name, path, checkpoint, available_now)


#: Folder columns of what ``land_checked`` writes: the day of the event (of landing, for broken messages) and the batch.
DAY, BATCH = "event_day", "batch_no"


def _write_batch(df: DataFrame, path: str, number: int) -> int:
    """Put the rows of one micro-batch in place, over what an earlier attempt at the same batch may have left.

    Rows go to folders by day and batch, and only folders of this batch are replaced, each by a rename of Spark's
    committer. The same batch has the same rows, so an attempt that is repeated ends in the same files' content.
    """
    rows = df.withColumn(BATCH, F.lit(number).cast("long"))
    return write_counted(rows, path, [DAY, BATCH], "overwrite", partitionOverwriteMode="dynamic")


def land_checked(
    messages: DataFrame,
    landed: str,
    quarantine: str,
    checkpoint: str,
    available_now: bool = False,
    name: str = "events_checked",
    trigger: str = TRIGGER,
    check_format: bool = True,
    put: Callable[[DataFrame, str, int], int] = _write_batch,
) -> StreamingQuery:
    """One pass over the messages into two tables: those that keep the contract parsed, the others as raw text with codes.

    Each micro-batch is read and checked once, kept on the executors (spilled to their disks, computed again where one is
    lost) and written to both tables. A batch that failed between the two is written again under its number, so every
    message is in one table, once. Files lie by event day, brought together before they are written.
    """
    if not checkpoint:
        raise ValueError("name a lasting folder for the checkpoint: batch numbers start anew with a new one")

    def write(batch: DataFrame, number: int) -> None:
        checked = with_violations(decode(batch), check_format=check_format).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            kept = parse_events(checked.where(F.size("violations") == 0))
            put(kept.withColumn(DAY, F.to_date("timestamp")), landed, number)
            broken = checked.where(F.size("violations") > 0).withColumn("_ingested_at", F.current_timestamp())
            put(broken.withColumn(DAY, F.to_date("_ingested_at")), quarantine, number)
        finally:
            checked.unpersist()

    how = {"availableNow": True} if available_now else {"processingTime": trigger}
    return messages.writeStream.queryName(name).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**how).start()


def run_until_stopped(query: StreamingQuery) -> None:
    """Wait for the stream; stop it on an interrupt or an error."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        pass
    finally:
        query.stop()


def first_copies(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Stream without repeated event ids within the delay. Keeps the first copy seen, the batch form the newest.

    Rows without an id are dropped first: they would all be one key. The state holds ids only, for ``delay``.
    """
    return (
        events.where(F.col("event_id").isNotNull())
        .withWatermark("timestamp", delay)
        .dropDuplicatesWithinWatermark(["event_id"])
    )


def newest_copies(events: DataFrame, newest: Sequence[str], delay: str = "1 hour") -> DataFrame:
    """Stream with the newest copy of each event id, as the batch dedup keeps it.

    Copies of an id whose times lie within ``delay`` of each other are a session, and a session comes out once no further
    copy can join it. Copies are ordered as ``keep_latest`` orders them. With
    ``LOCAL_SESSIONS`` set, copies are combined in each task before the shuffle: a task sends one row per id and session,
    so an id with a third of all messages is a row per task. The state holds one copy per id, for twice the delay.
    """
    newest = [c for c in newest if c in events.columns]
    rest = [c for c in events.columns if c not in newest and c != "event_id"]
    order = F.struct(*(sortable(events, c).alias(f"o{i}") for i, c in enumerate(newest)), row_hash(events, rest).alias("tie"))
    return (
        events.where(F.col("event_id").isNotNull() & F.col("timestamp").isNotNull())
        .withWatermark("timestamp", delay)
        .groupBy("event_id", F.session_window("timestamp", delay).alias("_session"))
        .agg(F.max_by(F.struct(*(c for c in events.columns if c != "event_id")), order).alias("_copy"))
        .select("event_id", "_copy.*")
        .select(*events.columns)
    )


#: Setting that lets Spark merge the sessions of a task before the shuffle; a stream takes it from its session.
LOCAL_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def keep_daily_intent(
    events: DataFrame, refresh: Callable[[list], None], checkpoint: str, available_now: bool = False, name: str = "daily_intent"
) -> StreamingQuery:
    """Call ``refresh`` (see ``plans.upkeep``) with the days that each micro-batch of resolved events touches, late ones too.

    Only the days pass the driver. A batch that is repeated refreshes the same days, which changes nothing.
    """

    def touched(batch: DataFrame, _: int) -> None:
        rows = batch.where(F.col("account_id").isNotNull()).select(F.to_date("event_timestamp").alias("day")).distinct()
        days = sorted(r.day for r in rows.where("day is not null").collect())
        if days:
            refresh(days)

    how = {"availableNow": True} if available_now else {"processingTime": TRIGGER}
    return events.writeStream.queryName(name).foreachBatch(touched).option("checkpointLocation", checkpoint).trigger(**how).start()


def daily_intent(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Stream of resolved events -> the daily intent mart, each day once it is complete."""
    return (
        events.where(F.col("account_id").isNotNull())
        .withWatermark("event_timestamp", delay)
        .groupBy("account_id", F.window("event_timestamp", "1 day").alias("w"))
        .agg(*intent_measures())
        .withColumn("event_date", F.to_date("w.start"))
        .drop("w")
    )
