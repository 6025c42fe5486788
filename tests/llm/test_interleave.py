import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from accountweave.llm import interleave
from accountweave.llm.common import KEY


def placed(docs, **options):
    return interleave.interleave(docs, **options).collect()


def by_source(spark, counts, seed=3):
    rows = [(i, f"text {i}", s) for i, s in enumerate(s for s, n in counts.items() for _ in range(n))]
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("counts", [{"a": 700, "b": 41, "c": 8, None: 13}, {"a": 3}, {"a": 1, "b": 1}, {f"s{i}": 1 + i % 4 for i in range(60)}])
def test_each_shard_matches_the_mixture(spark, counts):
    docs = by_source(spark, counts)
    source = {r.doc_id: r.source for r in docs.collect()}
    got = placed(docs)
    total = sum(counts.values())
    assert sorted(r.id for r in got) == list(range(total))
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(8)) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    if len(counts) < 10:
        for name, n in counts.items():
            for s, m in sizes.items():
                assert abs(sum(r.shard == s and source[r.id] == name for r in got) - n * m / total) <= 2


def test_same_as_plain_sort(spark):
    docs = by_source(spark, {"a": 500, "b": 70, "c": 9})
    rows = docs.select(F.col("doc_id").alias("id"), *interleave.narrow()[3:]).collect()
    strata = Counter(r.stratum for r in rows)
    order = []
    for s in strata:
        mine = sorted((r for r in rows if r.stratum == s), key=lambda r: bytes(r.shuffled))
        order += [((k + 0.5) / strata[s], s, bytes(r.shuffled), r.id) for k, r in enumerate(mine)]
    want = {r[-1]: g * 8 // len(rows) for g, r in enumerate(sorted(order))}
    assert {r.id: r.shard for r in placed(docs)} == want


def test_seed_and_files_decide_nothing_else(spark):
    docs = by_source(spark, {"a": 300, "b": 60})
    key = lambda rows: sorted((r.id, r.shard, r.slot) for r in rows)
    assert key(placed(docs)) == key(placed(docs.repartition(7).orderBy(F.desc("doc_id"))))
    assert key(placed(docs)) != key(placed(docs, seed=1))


def test_odd_rows(documents, odd):
    texts = odd + [(None, None)] * 30
    got = placed(documents(texts, extra=True).withColumns({"stratum": F.lit(1), "shard": F.lit(2), "slot": F.lit(3), "size": F.lit("x"), KEY: F.lit(0)}))
    want = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    data = lambda t: (t or "").encode()
    assert Counter((r.id, r.size, r.text_crc32) for r in got) == Counter((i, len(data(t)) + 1, zlib.crc32(data(t))) for i, t in want)
    assert sorted((r.shard, r.slot) for r in got) == sorted((g * 8 // len(got), g - -(-(g * 8 // len(got)) * len(got) // 8)) for g in range(len(got)))


def test_empty_table(documents):
    assert placed(documents([])) == []


def test_repeated_rows_lie_in_many_parts(spark):
    """Rows that agree in all columns are still dealt over parts."""
    rows = spark.range(20_000).select(F.lit("=s").alias("stratum"), F.lit(b"same").alias("shuffled"), F.col("id").alias(KEY))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = rows.repartitionByRange("stratum", "shuffled", KEY).groupBy(F.spark_partition_id()).count().collect()
        got = interleave.placed(rows).groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("m"), F.max("slot").alias("top")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(parts) == 4 and max(r["count"] for r in parts) < 8000
    assert {(r.n, r.m, r.top) for r in got} == {(2500, 2500, 2499)}


def test_written_shards(spark, documents, tmp_path):
    docs = documents([f"t{i % 50}" for i in range(200)] + [None], extra=True).withColumns({"shard": F.lit(9), "row": F.lit("r")})
    path = str(tmp_path / "shards")
    interleave.write_shards(docs, path)
    read = spark.read.parquet(path)
    got = {(r.row.doc_id, r.shard, r.slot) for r in read.collect()}
    assert got == {(r.id, r.shard, r.slot) for r in placed(docs)}
    assert read.select("row.*").exceptAll(docs).isEmpty() and docs.exceptAll(read.select("row.*")).isEmpty()
