from collections import Counter

import pytest
from pyspark.sql import functions as F

from accountweave.operators import joins
from accountweave.operators.joins import hot_counts, hot_keys, key_counts, lookup_join


@pytest.fixture
def skewed(spark):
    """A third of the rows has one key, a third has none, the rest is spread; some keys have no lookup row."""
    return spark.range(3000).selectExpr("id", "case id % 3 when 0 then 'hot' when 2 then concat('k', id % 500) end as key")


@pytest.fixture
def lookup(spark):
    return spark.range(400).selectExpr("concat('k', id) as key", "id as value").union(
        spark.range(1).selectExpr("'hot'", "cast(-1 as bigint)")
    )


def brute_force(skewed, lookup):
    table = {r.key: r.value for r in lookup.collect()}
    return Counter((r.id, r.key, table.get(r.key)) for r in skewed.collect())


def found(df):
    return Counter(tuple(r) for r in df.select("id", "key", "value").collect())


@pytest.mark.parametrize("hot_rows", [50, 1000, 10_000])
def test_lookup_that_spark_broadcasts(skewed, lookup, hot_rows):
    joined = lookup_join(skewed, lookup, "key", ["id"], hot_rows=hot_rows)
    assert found(joined) == brute_force(skewed, lookup)
    assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot_rows", [50, 1000, 10_000])
def test_lookup_that_is_shuffled(skewed, lookup, no_broadcast, hot_rows):
    joined = lookup_join(skewed, lookup, "key", ["id"], hot_rows=hot_rows)
    assert found(joined) == brute_force(skewed, lookup)
    counted = lookup_join(skewed, lookup, "key", ["id"], key_counts(skewed, ["key"]), hot_rows)
    assert found(counted) == brute_force(skewed, lookup)


def test_chunks_of_hot_keys(skewed):
    chunks = {r.key: r._chunks for r in hot_keys(key_counts(skewed, ["key"]), ["key"], 50).collect()}
    assert chunks == {"hot": 20}


def test_two_thousand_hot_keys_are_all_split(spark, no_broadcast):
    """Every key holds 11 rows, and more than 5 are hot: three chunks each, whatever their number."""
    df = spark.range(22_000).selectExpr("id", "concat('k', id % 2000) as key")
    lookup = spark.range(2000).selectExpr("concat('k', id) as key", "id as value")
    chunks = hot_keys(key_counts(df, ["key"]), ["key"], 5)
    assert chunks.count() == 2000 and {r._chunks for r in chunks.collect()} == {3}
    joined = lookup_join(df, lookup, "key", ["id"], hot_rows=5)
    assert found(joined) == brute_force(df, lookup)


def test_the_largest_task_of_a_hot_key_is_a_small_share(spark, no_broadcast):
    """All rows have one key; after the join no partition holds a large part of them."""
    before = {n: spark.conf.get(n) for n in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(20_000).selectExpr("id", "'hot' as key")
        joined = lookup_join(df, spark.createDataFrame([("hot", 1)], "key string, value long"), "key", ["id"], hot_rows=100)
        per_task = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(per_task) == 20_000 and max(per_task) < 4_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_null_keys_are_dealt_over_tasks_when_no_key_is_hot(spark, no_broadcast):
    """All rows have a null key and no key is hot, so that the slot of every lookup row is 0."""
    before = {n: spark.conf.get(n) for n in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(20_000).selectExpr("id", "cast(null as string) as key")
        joined = lookup_join(df, spark.createDataFrame([("k", 1)], "key string, value long"), "key", ["id"])
        per_task = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(per_task) == 20_000 and max(per_task) < 4_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_two_key_columns(spark, no_broadcast):
    left = spark.range(300).selectExpr("id", "case when id % 4 > 0 then id % 2 end as a", "id % 3 as b")
    right = spark.createDataFrame([(0, 0, "x"), (1, 2, "y")], "a long, b long, v string")
    got = {r.id: r.v for r in lookup_join(left, right, ["a", "b"], ["id"], hot_rows=10).collect()}
    table = {(0, 0): "x", (1, 2): "y"}
    assert got == {i: table.get((i % 2 if i % 4 else None, i % 3)) for i in range(300)}


def test_lookup_columns_stay_null_without_a_match(skewed, lookup, no_broadcast):
    joined = lookup_join(skewed, lookup.where(F.lit(False)), "key", ["id"])
    assert joined.count() == 3000
    assert joined.where(F.col("value").isNotNull()).count() == 0


@pytest.mark.parametrize("buckets", [1, 7, 1 << 16])
def test_hot_counts_are_the_counts_of_the_hot_keys(skewed, monkeypatch, buckets):
    """Also where keys that are not hot share a bucket with one that is."""
    monkeypatch.setattr(joins, "KEY_BUCKETS", buckets)
    for rows in (1, 2, 999, 1000):
        expected = {(r.key, r._n) for r in key_counts(skewed, ["key"]).collect() if r._n > rows}
        assert {(r.key, r._n) for r in hot_counts(skewed, ["key"], rows).collect()} == expected


def test_hot_counts_of_different_keys_shuffle_no_row_per_key(spark, monkeypatch):
    monkeypatch.setattr(joins, "KEY_BUCKETS", 16)
    counted = hot_counts(spark.range(0, 20_000, 1, 2).selectExpr("id", "concat('k', id) as key"), ["key"])
    assert counted.collect() == []
    plan = counted._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
    assert "Exchange" not in final or "key" not in final
