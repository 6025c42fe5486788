import random

import pytest

import corpus_pipeline
from accountweave.llm.common import BATCH_SETTING


def words(r, n):
    return " ".join("".join(r.choices("abcdefghijkl", k=r.randint(3, 8))) for _ in range(n))


def test_stages_take_effect_and_clean_documents_stay(spark, documents, tmp_path):
    r = random.Random(11)
    clean = [(i, words(r, 80)) for i in range(60)]
    toxic = [(100 + i, words(r, 20) + " vexling grubnar idiot slurmish " + words(r, 20)) for i in range(40)]
    passage = "\n".join(words(r, 9) for _ in range(40))
    repeated = [(200 + i, f"{words(r, 60)}\n{passage}\n{words(r, 60)}") for i in range(3)]
    original = words(r, 200).split()
    near = [(300, " ".join(original)), (301, " ".join([*original[:100], "changed", *original[101:]])), (302, " ".join(original))]
    item = words(r, 25)
    leak = [(400, f"{words(r, 50)} {item} {words(r, 50)}")]
    empty = [(500, None), (501, "")]
    docs = documents([*clean, *toxic, *repeated, *near, *leak, *empty])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(
        [(i, 1, int(100 <= i < 200)) for i, _ in clean + toxic], "doc_id long, quality int, toxic int"
    ).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    out = {x.doc_id: x for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    # Two empty texts are copies of each other.
    assert set(out) == {i for i, _ in clean} | {200, 201, 202, 300} | ({500, 501} & set(out))
    assert len({500, 501} & set(out)) == 1
    assert all(out[i].text == t for i, t in clean)
    assert passage in out[200].text
    assert all(len(out[i].text) < len(t) - len(passage) // 2 for i, t in repeated[1:])
    assert all(x.n_tokens == len(x.token_ids) // 4 for x in out.values())


def test_stage_names_and_columns(spark, documents):
    assert len(corpus_pipeline.STAGES) == 5
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_tables(spark, documents, tmp_path):
    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize(("before", "after"), [("64m", f"{4 << 20}b"), ("1m", "1m")])
def test_batches_for_workers_are_bounded(spark, documents, small_dir, before, after):
    own = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, before)
    try:
        corpus_pipeline.bpe(spark, documents(["one text"]), small_dir)
        assert spark.conf.get(BATCH_SETTING) == after
    finally:
        spark.conf.set(BATCH_SETTING, own)
