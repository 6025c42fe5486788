import random
import zlib

import numpy as np
import pytest

from accountweave.llm import weak_toxicity as W

CALM = "river stone table window garden paper light music letter winter bridge market".split()
RUDE = "vexling grubnar idiot slurmish hatebag scornful".split()


def corpus(r, n):
    """Texts and labels; a third is rude."""
    out = []
    for i in range(n):
        rude = i % 3 == 0
        words = r.choices(CALM, k=30) + r.choices(RUDE, k=4) * rude
        r.shuffle(words)
        out.append((i, " ".join(words), int(rude)))
    return out


def labels_of(spark, rows):
    return spark.createDataFrame([(i, 0, y, "x") for i, _, y in rows], "doc_id long, quality int, toxic int, score string")


def held_out(i):
    return zlib.crc32(str(i).encode()) % W.FOLDS == W.HELD_OUT


def scores(docs, labels):
    return docs.select("doc_id", W.scorer(docs, W.fit(docs, labels)).alias("score_")).collect()


def test_held_out_texts_are_told_apart(spark, documents):
    rows = corpus(random.Random(3), 600)
    out = {r.doc_id: r.score_ for r in scores(documents([x[:2] for x in rows], extra=True), labels_of(spark, rows))}
    unseen = [(out[i], y) for i, _, y in rows if held_out(i)]
    assert len(unseen) > 100
    assert all((s >= W.THRESHOLD) == bool(y) for s, y in unseen)


def test_labels_of_the_held_out_fold_are_never_used(spark, documents):
    rows = corpus(random.Random(4), 300)
    docs = documents([x[:2] for x in rows])
    turned = [(i, t, 1 - y if held_out(i) else y) for i, t, y in rows]
    assert scores(docs, labels_of(spark, rows)) == scores(docs, labels_of(spark, turned))


def test_label_model_gives_copies_of_one_voter_the_weight_of_one():
    r = np.random.default_rng(5)
    truth = r.random(4000) < 0.4
    good = [np.where(r.random(4000) < 0.85, truth, ~truth) for _ in range(3)]
    one = np.stack([*good, good[0]] + [good[0]] * 8, 1).astype(float)
    q, chance, together = W.label_model(one, truth * 0.6 + 0.2)
    assert ((q > 0.5) == truth).mean() > 0.9
    assert np.allclose(chance[1][:3], 0.85, atol=0.05) and np.allclose(chance[0][:3], 0.15, atol=0.05)
    assert together[0, 3] > 0.99 and abs(together[0, 1]) < 0.3


def test_odd_rows(spark, documents, odd):
    rows = corpus(random.Random(6), 90)
    docs = documents([*odd, *((1000 + i, t) for i, t, _ in rows)], extra=True)
    given = labels_of(spark, [(1000 + i, t, y) for i, t, y in rows] + [(None, "", 1), (3, "", None), (3, "", 0), (3, "", 0)])
    out = scores(docs, given)
    assert len(out) == docs.count()
    assert all(0 <= r.score_ <= 1 for r in out)
    kept = W.without_toxic(docs, given)
    assert kept.schema == docs.schema
    assert kept.where("doc_id is null or doc_id < 1000").count() == len(odd)


@pytest.mark.parametrize("given", [[], [(1, "", 0), (2, "", 0)]])
def test_without_toxic_labels_the_list_of_insults_votes(spark, documents, given):
    docs = documents(["a garden by the river", "you pathetic worthless idiot", "", None, *("stone table light " * 5 for _ in range(20))])
    out = {r.doc_id: r.score_ for r in scores(docs, labels_of(spark, given))}
    assert len(out) == 24 and all(0 <= s <= 1 for s in out.values())


def test_empty_table(spark, documents):
    assert scores(documents([]), labels_of(spark, [])) == []
