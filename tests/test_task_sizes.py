"""Tasks stay small as tables grow: sizes of splits and shuffles, row groups of staged tables, dealt sources."""

import pytest

from accountweave.session import INITIAL_PARTITIONS, SHUFFLED_INPUT, TASK_BYTES, use_runtime_settings
from accountweave.sources import staging
from checks import tables
from checks.tables import Tables


@pytest.fixture
def settings(spark):
    names = (*TASK_BYTES, INITIAL_PARTITIONS)
    before = {n: spark.conf.get(n, None) for n in names}
    yield spark.conf
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_larger_sizes_are_lowered_and_smaller_ones_stay(spark, settings):
    files, shuffles = TASK_BYTES
    settings.set(files, "128m")
    settings.set(shuffles, "64k")
    use_runtime_settings(spark)
    assert settings.get(files) == f"{8 << 20}b" and settings.get(shuffles) == "64k"


def test_partitions_of_a_shuffle_grow_with_the_input(spark, settings, tmp_path):
    settings.unset(INITIAL_PARTITIONS)
    use_runtime_settings(spark, str(tmp_path))
    assert settings.get(INITIAL_PARTITIONS, None) is None
    with open(tmp_path / "t.parquet", "wb") as f:
        f.truncate(1000 * SHUFFLED_INPUT)
    use_runtime_settings(spark, str(tmp_path))
    assert settings.get(INITIAL_PARTITIONS) == "1000"


def test_a_staged_file_can_be_split(spark, tmp_path, monkeypatch, settings):
    monkeypatch.setattr(staging, "ROW_GROUP", 256 << 10)
    settings.set("spark.sql.files.maxPartitionBytes", "256k")
    rows = spark.range(0, 400_000, 1, 1).selectExpr("id", "sha2(string(id), 256) as text")
    staged = staging.stage(rows, "one", str(tmp_path))
    filled = staged.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).filter(bool).count()
    assert staged.count() == 400_000 and filled > 4


@pytest.mark.parametrize("task_rows", [300, 1_000_000])
def test_a_source_of_one_row_group_is_dealt_by_rows(spark, tmp_path, monkeypatch, task_rows):
    monkeypatch.setattr(tables, "TASK_ROWS", task_rows)
    spark.range(0, 12_000, 1, 1).write.parquet(str(tmp_path / "t.parquet"))
    dealt = Tables(spark, str(tmp_path)).spread_source("t")
    assert dealt.count() == 12_000
    assert dealt.rdd.getNumPartitions() == max(spark.sparkContext.defaultParallelism, 12_000 // task_rows)


def test_an_empty_source_is_dealt_too(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "t.parquet"))
    assert Tables(spark, str(tmp_path)).spread_source("t").count() == 0
