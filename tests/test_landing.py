from datetime import timedelta

import pytest

from accountweave.operators.crm import ACCOUNT, SALES_REP, canonical
from accountweave.schemas import CRM_COLUMNS, LANDED_EVENT
from accountweave.sources.landing import MarkLog, land_all, land_object, modified_after
from accountweave.sources import versions
from accountweave.sources.tables import first_table_or_empty, read_table, write_mart, write_table


def source_of(spark, *rows, object_name="account"):
    columns = CRM_COLUMNS[object_name]
    return spark.createDataFrame(
        [tuple({"Id": i, "SystemModstamp": m, "CreatedDate": m}.get(c) for c in columns) for i, m in rows],
        ", ".join(f"{c} string" for c in columns),
    )


@pytest.fixture
def place(spark, tmp_path):
    return str(tmp_path / "bronze"), MarkLog(spark, str(tmp_path / "marks"))


def test_full_load_then_changes_then_nothing(spark, place):
    bronze, marks = place
    assert marks.latest("account") is None
    first = land_object(source_of(spark, ("1", "2026-01-01T00:00:00Z"), ("2", "2026-01-02T00:00:00.5Z")), "account", bronze, marks)
    assert (first.status, first.row_count, first.mark) == ("landed", 2, "2026-01-02 00:00:00.5")
    changed = source_of(spark, ("1", "2026-01-01T00:00:00Z"), ("2", "2026-01-02T00:00:00.5Z"), ("1", "2026-01-03T00:00:00+01:00"))
    second = land_object(changed, "account", bronze, marks)
    assert (second.status, second.row_count, second.mark) == ("landed", 1, "2026-01-02 23:00:00")
    assert land_object(changed, "account", bronze, marks).status == "unchanged"
    assert marks.entries().count() == 2

    landed = spark.read.parquet(f"{bronze}/account")
    assert landed.count() == 3
    assert landed.where("_ingested_at is null or _batch_id is null or _source_system <> 'salesforce'").count() == 0
    assert {r._batch_id for r in landed.select("_batch_id").collect()} == {first.batch_id, second.batch_id}


def test_replays_are_harmless(spark, place):
    bronze, marks = place
    rows = source_of(spark, ("1", "2026-01-01T00:00:00Z"), ("2", "2026-01-02T00:00:00Z"))
    for _ in range(2):
        assert land_object(rows, "account", bronze, marks, full_load=True).row_count == 2
    assert canonical(ACCOUNT, spark.read.parquet(f"{bronze}/account")).count() == 2


def test_overlap_reads_again(spark):
    rows = source_of(spark, ("1", "2026-01-01T00:00:00Z"), ("2", "2026-01-02T00:00:00Z"))
    assert modified_after(rows, "2026-01-02T00:00:00Z").count() == 0
    assert modified_after(rows, "2026-01-02T00:00:00Z", timedelta(hours=1)).count() == 1
    assert modified_after(rows, None).count() == 2


def test_mark_does_not_go_back_and_timestamp_sources_are_pushed_down(spark, place, tmp_path):
    bronze, marks = place
    marks.commit("account", "2026-05-01 00:00:00", "b", 1)
    source_of(spark, ("1", "2026-05-02T00:00:00Z"), ("2", "2026-01-01T00:00:00Z")).selectExpr(
        "* except (SystemModstamp)", "cast(SystemModstamp as timestamp) as SystemModstamp"
    ).write.parquet(str(tmp_path / "src"))
    source = spark.read.parquet(str(tmp_path / "src"))
    plan = modified_after(source, "2026-05-01 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(SystemModstamp" in plan
    assert land_object(source, "account", bronze, marks).row_count == 1
    assert land_object(source, "account", bronze, marks, overlap=timedelta(days=365)).mark == "2026-05-02 00:00:00"


def test_the_source_is_read_once(spark, place):
    """A batch and its count, its mark and its being empty come from one reading."""
    bronze, marks = place
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = source_of(spark, ("1", "2026-01-01T00:00:00Z"), ("2", "2026-01-02T00:00:00Z"))
    source = rows.mapInArrow(counted, rows.schema)
    assert land_object(source, "account", bronze, marks).row_count == 2 and read.value == 2
    assert land_object(source, "account", bronze, marks).status == "unchanged" and read.value == 4
    assert spark.read.parquet(f"{bronze}/account").count() == 2


def test_a_batch_shows_when_it_is_whole(spark, place, monkeypatch):
    """A run that dies before the batch is published, or before its mark is committed."""
    bronze, marks = place
    rows = source_of(spark, ("1", "2026-01-01T00:00:00Z"), ("2", "2026-01-02T00:00:00Z"))
    land_object(rows, "account", bronze, marks)

    def dies(*_):
        raise OSError("lost the driver")

    more = rows.union(source_of(spark, ("3", "2026-01-03T00:00:00Z")))
    with monkeypatch.context() as m:
        m.setattr(versions, "rename", dies)
        with pytest.raises(OSError):
            land_object(more, "account", bronze, marks)
    assert spark.read.parquet(f"{bronze}/account").count() == 2
    with monkeypatch.context() as m:
        m.setattr(MarkLog, "commit", dies)
        with pytest.raises(OSError):
            land_object(more, "account", bronze, marks)
    assert spark.read.parquet(f"{bronze}/account").count() == 3 and marks.latest("account") == "2026-01-02 00:00:00"
    assert land_object(more, "account", bronze, marks).row_count == 1
    assert canonical(ACCOUNT, spark.read.parquet(f"{bronze}/account")).count() == 3


def test_a_thousand_marks_are_few_files(spark, tmp_path):
    """Commits by hand, as files, then through the log: what is read stays bounded and nothing is lost."""
    path = str(tmp_path / "marks")
    marks = MarkLog(spark, path, compact_after=20)
    for k in range(10):
        old = spark.range(100).selectExpr(
            "'account' as object_name", f"timestamp'2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, {k}, id) as high_water",
            "cast(id as string) as batch_id", "id as row_count", "'SUCCESS' as status", f"timestamp'2026-01-02 00:00:00' + make_interval(0, 0, 0, 0, 0, {k}, id) as updated_at",
        )
        old.repartition(100).write.mode("append").parquet(path)
    assert len(marks._files()) > 500 and marks.latest("account") == "2026-01-01 00:10:39"
    for k in range(25):
        marks.commit("lead", f"2026-02-01 00:00:{k:02d}", str(k), k)
        assert len(marks._files()) < 20 and len(marks._snapshots()) == 1
        assert marks.latest("lead") == "2026-02-01 00:00:" + (f"{k:02d}" if k else "00")
    assert marks.entries().count() == 1025 and marks.latest("account") == "2026-01-01 00:10:39"


@pytest.mark.parametrize("kept", [0, 1, 3])
def test_a_crash_while_compacting_loses_no_mark(spark, tmp_path, monkeypatch, kept):
    """Stopped in the middle of the snapshot, or after some of what it holds is removed."""
    path = str(tmp_path / "marks")
    marks = MarkLog(spark, path)
    for k in range(5):
        marks.commit("account", f"2026-02-01 00:00:0{k}", str(k), k)
    marks.compact()
    for k in range(5, 8):
        marks.commit("account", f"2026-02-01 00:00:0{k}", str(k), k)
    half = tmp_path / "marks" / MarkLog.SNAPSHOTS / "half"
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"half a file")
    drop = MarkLog._drop

    def dies(self, paths):
        drop(self, paths[:kept])
        raise OSError("lost the driver")

    monkeypatch.setattr(MarkLog, "_drop", dies)
    with pytest.raises(OSError):
        marks.compact()
    monkeypatch.undo()
    assert marks.latest("account") == "2026-02-01 00:00:07" and marks.entries().count() == 8
    marks.compact()
    assert marks.latest("account") == "2026-02-01 00:00:07" and marks.entries().count() == 8
    assert len(marks._files()) == 0 and len(marks._snapshots()) == 1


def test_unreadable_mark_means_an_older_one_or_a_full_load(spark, tmp_path):
    path = tmp_path / "marks"
    path.mkdir()
    (path / "part-0.parquet").write_bytes(b"not parquet")
    marks = MarkLog(spark, str(path))
    assert marks.latest("account") is None
    marks.commit("account", "2026-05-01 00:00:00", "b", 1)
    assert marks.latest("account") == "2026-05-01 00:00:00"
    assert marks.latest("lead") is None


def test_one_failing_object_does_not_stop_the_others(spark, place):
    bronze, marks = place

    def source(name):
        if name == "contact":
            raise OSError("no network")
        return source_of(spark, ("1", "2026-01-01T00:00:00Z"), object_name=name)

    results = {r.object_name: r for r in land_all(source, bronze, marks)}
    assert list(results) == list(CRM_COLUMNS)
    assert results["contact"].status == "failed" and "no network" in results["contact"].error
    assert all(r.status == "landed" for name, r in results.items() if name != "contact")
    assert [r.status for r in land_all(source, bronze, marks, objects=["unknown"])] == ["failed"]


def test_nested_role_is_flattened(spark, place):
    bronze, marks = place
    users = source_of(spark, ("1", "2026-01-01T00:00:00Z"), object_name="user").selectExpr(
        "* except (UserRole_Name)", "named_struct('Name', 'East') as UserRole"
    )
    land_object(users, "user", bronze, marks)
    assert canonical(SALES_REP, spark.read.parquet(f"{bronze}/user")).first().role_name == "East"


def test_tables(spark, tmp_path):
    base = str(tmp_path)
    df = spark.range(10).selectExpr("id", "id % 2 as p")
    assert write_table(df, base, "t") == 10
    assert write_mart(df, base, "m", partition_by=["p"]) == 10
    mart = read_table(spark, base, "m")
    assert "gold_processed_at" in mart.columns and mart.where("p = 1").count() == 5
    assert first_table_or_empty(spark, [f"{base}/none", f"{base}/t"], LANDED_EVENT).count() == 10
    empty = first_table_or_empty(spark, [f"{base}/none"], LANDED_EVENT)
    assert empty.schema == LANDED_EVENT and empty.isEmpty()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, base, "none")
