import math
import random
import zlib

import numpy as np

from accountweave.llm import discriminant as D
from accountweave.llm.common import stage


def text(r, good):
    if good:
        return ". ".join(" ".join("".join(r.choices("abcdefghijklmn", k=r.randint(2, 9))) for _ in range(r.randint(6, 14))).capitalize() for _ in range(r.randint(3, 9)))
    return "\n".join(" | ".join(r.choices(["BUY", "now!!!", "$9.99", "click", "HERE"], k=r.randint(2, 6))) for _ in range(r.randint(3, 9)))


def rows_of(n, seed=1):
    r = random.Random(seed)
    return [(i, text(r, i % 2 == 0), int(i % 2 == 0)) for i in range(n)]


def labels_of(spark, rows):
    return spark.createDataFrame([(i, y, 0, "x") for i, _, y in rows], "doc_id long, quality int, toxic int, score string")


def held_out(i):
    return zlib.crc32(str(i).encode()) % D.FOLDS == D.HELD_OUT


def test_held_out_texts_are_told_apart(spark, documents):
    rows = rows_of(400)
    out = {r.id: r.score for r in D.scored(documents([x[:2] for x in rows], extra=True), labels_of(spark, rows)).collect()}
    unseen = [(out[i], y) for i, _, y in rows if held_out(i)]
    assert len(unseen) > 50
    assert sum((s >= 0.5) == bool(y) for s, y in unseen) >= 0.97 * len(unseen)


def test_labels_of_the_held_out_fold_are_never_used(spark, documents):
    rows = rows_of(200)
    docs = documents([x[:2] for x in rows])
    turned = [(i, t, 1 - y if held_out(i) else y) for i, t, y in rows]
    get = lambda given: {r.id: r.score for r in D.scored(docs, labels_of(spark, given)).collect()}
    a, b = get(rows), get(turned)
    assert all(math.isclose(a[i], b[i], rel_tol=1e-9, abs_tol=1e-12) for i in a)


def test_scores_are_those_of_the_densities(spark):
    """Against the plain formula: density of each class by its full covariance."""
    r = np.random.default_rng(2)
    mix = r.standard_normal((D.SIZE, D.SIZE)) / 5 + np.eye(D.SIZE)
    x = {i: (r.standard_normal(D.SIZE) @ mix + (i % 2) * 0.7).tolist() for i in range(300)}
    given = [(i, "", i % 2) for i in x]
    measures = stage(spark.createDataFrame(list(x.items()), "id long, x array<double>"), "measures")
    model = D.fit(measures, labels_of(spark, given))
    used = [i for i in x if not held_out(i)]
    points = {k: np.array([x[i] for i in used if i % 2 == k]) for k in (0, 1)}
    scatter = {k: np.cov(p.T, bias=True) for k, p in points.items()}
    pooled = sum(len(points[k]) / len(used) * scatter[k] for k in (0, 1))
    density = []
    for k in (0, 1):
        share = D.SIZE / (D.SIZE + len(points[k]))
        c = 0.95 * ((1 - share) * scatter[k] + share * pooled) + 0.05 * np.diag(np.diag(pooled) + 1e-6)
        off = np.array(list(x.values())) - points[k].mean(0)
        density.append(math.log(len(points[k]) / len(used)) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,jk,ik->i", off, np.linalg.inv(c), off))
    d = density[1] - density[0]
    assert np.allclose(model.score(np.array(list(x.values()))), 1 / (1 + np.exp(-d / (1 + np.abs(d) / 30))), atol=1e-9)


def test_odd_rows(spark, documents, odd):
    rows = rows_of(60)
    docs = documents([*odd, *((1000 + i, t) for i, t, _ in rows)], extra=True)
    given = labels_of(spark, [(1000 + i, t, y) for i, t, y in rows] + [(None, "", 1), (3, "", None)])
    out = D.scored(docs, given).collect()
    assert len(out) == docs.count()
    assert all(0 <= r.score <= 1 for r in out)


def test_one_class_only_and_empty_tables(spark, documents):
    assert {r.score for r in D.scored(documents(["a b c", None]), labels_of(spark, [(0, "", 1)])).collect()} == {0.5}
    assert D.scored(documents([]), labels_of(spark, [])).collect() == []
