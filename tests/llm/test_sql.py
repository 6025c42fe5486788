import pytest

from accountweave.llm.queries import QUERIES, SQL
from checks.compare import compare, connect


@pytest.mark.parametrize("name", list(SQL))
def test_same_rows(spark, small_dir, name):
    assert compare(spark, connect(small_dir), small_dir, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"op3_nearest_vectors"}))
def test_a_row_per_document(spark, small_dir, name):
    rows = QUERIES[name](spark, small_dir)
    ids = [r.doc_id for r in rows.select("doc_id").collect()]
    want = [r.doc_id for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id").collect()]
    assert sorted(ids) == sorted(want)
