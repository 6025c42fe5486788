import time

import pytest
from pyspark.sql import functions as F

from accountweave.operators.contract import split_by_contract
from accountweave.plans.marts import intent_engagement
from accountweave.operators.contract import with_violations
from accountweave.operators.dedup import keep_latest
from accountweave.operators.events import NEWEST
from accountweave.streaming import events as stream_events
from accountweave.streaming.events import (
    LOCAL_SESSIONS,
    daily_intent,
    decode,
    first_copies,
    keep_daily_intent,
    land_checked,
    land_events,
    newest_copies,
    parse_events,
    quarantine_events,
)
from checks.tables import Tables

SCHEMA = "value binary, offset bigint, partition int"


@pytest.fixture(scope="module")
def envelope(spark, small_dir):
    """Messages in the envelope of the topic, in two files."""
    return Tables(spark, small_dir).messages.selectExpr(
        "cast(json_payload as binary) as value", "_kafka_offset as offset", "_kafka_partition as partition"
    )


def as_stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def rows(df):
    return sorted(map(repr, df.drop("_ingested_at").collect()))


def test_stream_lands_what_the_batch_parses_and_goes_on_from_its_checkpoint(spark, envelope, tmp_path):
    source, bronze, checkpoint = (str(tmp_path / n) for n in ("in", "bronze", "checkpoint"))
    envelope.where("offset % 2 = 0").coalesce(2).write.parquet(source)
    land_events(as_stream(spark, source), bronze, checkpoint, available_now=True).awaitTermination()
    landed = spark.read.parquet(bronze)
    assert rows(landed) == rows(parse_events(decode(envelope.where("offset % 2 = 0"))))

    envelope.where("offset % 2 = 1").coalesce(1).write.mode("append").parquet(source)
    land_events(as_stream(spark, source), bronze, checkpoint, available_now=True).awaitTermination()
    landed = spark.read.parquet(bronze)
    assert landed.count() == envelope.count()
    assert rows(landed) == rows(parse_events(decode(envelope)))
    assert landed.where("_ingested_at is null or _source_system <> 'digital_events'").count() == 0


@pytest.mark.parametrize("start", [land_events, quarantine_events])
def test_a_stream_names_its_checkpoint(spark, envelope, tmp_path, start):
    source = str(tmp_path / "in")
    envelope.limit(5).write.parquet(source)
    with pytest.raises(TypeError):
        start(as_stream(spark, source), str(tmp_path / "out"))
    with pytest.raises(ValueError):
        start(as_stream(spark, source), str(tmp_path / "out"), "")


def test_quarantine_holds_the_broken_messages(spark, envelope, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    envelope.coalesce(2).write.parquet(source)
    quarantine_events(as_stream(spark, source), out, str(tmp_path / "c"), available_now=True).awaitTermination()
    _, rejected = split_by_contract(decode(envelope))
    assert rows(spark.read.parquet(out)) == rows(rejected)
    assert spark.read.parquet(out).where("array_contains(violations, 'malformed')").count() > 0


def test_every_message_lands_in_one_of_two_tables(spark, envelope, tmp_path):
    """A stream that dies between the two writes, is started again, and gets more messages after that."""
    source, landed, quarantine, checkpoint = (str(tmp_path / n) for n in ("in", "landed", "quarantine", "checkpoint"))
    envelope.where("offset % 3 > 0").coalesce(2).write.parquet(source)
    calls = []

    def dies(df, path, number):
        calls.append((path, number))
        if len(calls) == 4:
            raise OSError("lost the driver")
        return stream_events._write_batch(df, path, number)

    with pytest.raises(Exception, match="lost the driver"):
        land_checked(as_stream(spark, source), landed, quarantine, checkpoint, available_now=True, check_format=False, put=dies).awaitTermination()
    assert calls == [(landed, 0), (quarantine, 0), (landed, 1), (quarantine, 1)]
    land_checked(as_stream(spark, source), landed, quarantine, checkpoint, available_now=True, check_format=False).awaitTermination()
    envelope.where("offset % 3 = 0").coalesce(1).write.mode("append").parquet(source)
    land_checked(as_stream(spark, source), landed, quarantine, checkpoint, available_now=True, check_format=False).awaitTermination()

    checked = with_violations(decode(envelope), check_format=False)
    good, broken = checked.where("size(violations) = 0"), checked.where("size(violations) > 0")
    kept, set_aside = spark.read.parquet(landed), spark.read.parquet(quarantine)
    assert kept.count() + set_aside.count() == envelope.count() and set_aside.count() > 0 < kept.count()
    assert rows(kept.drop("event_day", "batch_no")) == rows(parse_events(good).select(*kept.drop("event_day", "batch_no").columns))
    assert rows(set_aside.select("json_payload", "_kafka_offset", "violations")) == rows(broken.select("json_payload", "_kafka_offset", "violations"))
    assert kept.where("event_day <> to_date(timestamp)").isEmpty() and {r.batch_no for r in kept.select("batch_no").distinct().collect()} == {0, 1, 2}
    with pytest.raises(ValueError):
        land_checked(as_stream(spark, source), landed, quarantine, "")


def test_messages_are_read_once(spark, envelope, tmp_path):
    """Both tables are written from one reading of a batch."""
    source = str(tmp_path / "in")
    envelope.coalesce(1).write.parquet(source)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    messages = as_stream(spark, source).mapInArrow(counted, SCHEMA)
    land_checked(messages, str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "c"), available_now=True).awaitTermination()
    assert read.value == envelope.count()


def test_the_real_trigger(spark, envelope, tmp_path):
    """Micro-batches by time: a file that comes while the stream runs is in the next one."""
    source, landed = str(tmp_path / "in"), str(tmp_path / "landed")
    envelope.where("offset % 2 = 0").coalesce(1).write.parquet(source)
    query = land_checked(as_stream(spark, source), landed, str(tmp_path / "q"), str(tmp_path / "c"), trigger=stream_events.TRIGGER, check_format=False)
    try:
        query.processAllAvailable()
        first = spark.read.parquet(landed).count()
        envelope.where("offset % 2 = 1").coalesce(1).write.mode("append").parquet(source)
        query.processAllAvailable()
    finally:
        query.stop()
    good = with_violations(decode(envelope), check_format=False).where("size(violations) = 0").count()
    assert 0 < first < spark.read.parquet(landed).count() == good
    starts = [p.timestamp for p in query.recentProgress if p.numInputRows]
    assert len(starts) == 2 and stream_events.TRIGGER == "5 seconds" and all(s[17:19] in {f"{k:02d}" for k in range(0, 60, 5)} for s in starts[1:])


def run_into_table(spark, df, tmp_path, name):
    query = (
        df.writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / name))
        .option("checkpointLocation", str(tmp_path / f"{name}-checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(str(tmp_path / name))


def test_streaming_dedup_keeps_one_copy_per_id(spark, envelope, tmp_path):
    parse_events(decode(envelope)).coalesce(1).write.parquet(str(tmp_path / "events"))
    events = spark.readStream.schema(spark.read.parquet(str(tmp_path / "events")).schema).parquet(str(tmp_path / "events"))
    kept = run_into_table(spark, first_copies(events, "60 days"), tmp_path, "kept")
    ids = [r.event_id for r in kept.select("event_id").collect()]
    assert len(ids) == len(set(ids)) and None not in ids
    assert set(ids) == {r.event_id for r in parse_events(decode(envelope)).select("event_id").collect()} - {None}


def test_newest_copies_are_those_of_the_batch(spark, envelope, tmp_path):
    """Equal to the batch dedup but for the last ids, whose copies may still come; a frequent id is a row per task."""
    parsed = parse_events(decode(envelope)).where("timestamp is not null")
    last = parsed.selectExpr("max(timestamp) as t").first().t
    hot = parsed.where("event_id is not null").limit(1).drop("_kafka_offset").join(spark.range(2000).withColumnRenamed("id", "_kafka_offset"))
    source = str(tmp_path / "events")
    every = parsed.unionByName(hot.select(*parsed.columns))
    cuts = [r.t for r in every.selectExpr("explode(percentile_approx(timestamp, array(0.3, 0.6))) as t").collect()]
    third = F.when(F.col("timestamp") < F.lit(cuts[0]), 0).when(F.col("timestamp") < F.lit(cuts[1]), 1).otherwise(2)
    for k in range(3):  # in the order of time, as topics are
        every.where(third == k).coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)
    events = spark.readStream.schema(parsed.schema).option("maxFilesPerTrigger", 1).parquet(source)
    before = spark.conf.get(LOCAL_SESSIONS)
    spark.conf.set(LOCAL_SESSIONS, "true")
    try:
        kept = newest_copies(events, NEWEST, "2 hours")
        got = run_into_table(spark, kept, tmp_path, "newest")
    finally:
        spark.conf.set(LOCAL_SESSIONS, before)
    want = keep_latest(spark.read.parquet(source).where("event_id is not null"), ["event_id"], NEWEST)
    assert got.count() == got.select("event_id").distinct().count() > 0.9 * want.count()
    shown = [df.select(*got.columns).withColumn("attributes", F.to_json("attributes")) for df in (got, want)]
    assert shown[0].exceptAll(shown[1]).isEmpty()
    missing = want.join(got, "event_id", "left_anti").selectExpr("min(timestamp) as t").first().t
    assert missing is None or (last - missing).total_seconds() < 6 * 3600


def test_copies_are_combined_before_the_shuffle(spark):
    """The stream's plan has the merge of sessions below the exchange."""
    before = spark.conf.get(LOCAL_SESSIONS)
    spark.conf.set(LOCAL_SESSIONS, "true")
    rate = spark.readStream.format("rate").load().selectExpr("cast(value % 3 as string) as event_id", "timestamp", "value")
    query = newest_copies(rate, ["timestamp"], "1 second").writeStream.format("memory").queryName("plan").outputMode("append").start()
    try:
        query.processAllAvailable()
        lines = query._jsq.explainInternal(False).splitlines()
    finally:
        query.stop()
        spark.conf.set(LOCAL_SESSIONS, before)
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert any("MergingSessions" in line or "UpdatingSessions" in line for line in lines[exchange:])


def test_days_that_late_events_touch(spark, small_dir, tmp_path):
    events = Tables(spark, small_dir).events.selectExpr("* except (event_timestamp)", "cast(event_timestamp as timestamp) as event_timestamp")
    source = str(tmp_path / "events")
    events.where("day(event_timestamp) in (3, 4)").coalesce(1).write.parquet(source)
    stream, seen = spark.readStream.schema(events.schema).parquet(source), []
    keep_daily_intent(stream, seen.append, str(tmp_path / "c"), available_now=True).awaitTermination()
    events.where("day(event_timestamp) = 2").coalesce(1).write.mode("append").parquet(source)
    keep_daily_intent(stream, seen.append, str(tmp_path / "c"), available_now=True).awaitTermination()
    assert [[d.day for d in days] for days in seen] == [[3, 4], [2]]


def test_daily_intent_of_complete_days_equals_the_batch_mart(spark, small_dir, tmp_path):
    events = Tables(spark, small_dir).events.selectExpr("* except (event_timestamp)", "cast(event_timestamp as timestamp) as event_timestamp")
    events.coalesce(1).write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "events"))
    got = run_into_table(spark, daily_intent(stream, "1 hour"), tmp_path, "intent")
    last = got.selectExpr("max(event_date) as d").first().d
    want = intent_engagement(events).where(f"event_date <= '{last}'").select(*got.columns)
    assert got.count() > 100
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
