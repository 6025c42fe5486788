import re

from accountweave.operators.dedup import keep_latest


def test_newest_wins_and_nulls_come_last(spark):
    df = spark.createDataFrame([("a", "2", "x"), ("a", "3", "y"), ("a", None, "z"), ("b", None, "q")], "k string, t string, v string")
    assert {tuple(r) for r in keep_latest(df, ["k"], ["t"]).collect()} == {("a", "3", "y"), ("b", None, "q")}


def test_ties_do_not_depend_on_row_order(spark):
    rows = [("a", "1", v, {"m": v, "n": "x"}) for v in ("p", "r", "q")]
    schema = "k string, t string, v string, m map<string,string>"
    kept = [keep_latest(spark.createDataFrame(order, schema), ["k"], ["t"]).collect() for order in (rows, rows[::-1], rows[1:] + rows[:1])]
    assert len(kept[0]) == 1 and kept[0] == kept[1] == kept[2]


def test_rows_are_sorted_by_key_newest_and_one_hash(spark):
    schema = "k string, t string, " + ", ".join(f"c{i} string" for i in range(20)) + ", m map<string,string>"
    plan = keep_latest(spark.createDataFrame([], schema), ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    sorts = [line.split("[", 1)[1].split("]")[0] for line in plan.splitlines() if "Sort [" in line]
    assert sorts and all([re.sub(r"#.*", "", c) for c in s.split(", ")] == ["k", "t", "_tie"] for s in sorts)


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(10_000).selectExpr("case when id % 3 = 0 then 0 else id end as k", "id as t")
    kept = keep_latest(df, ["k"], ["t"])
    assert {tuple(r) for r in kept.collect()} == {(0, 9999)} | {(i, i) for i in range(10_000) if i % 3}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
