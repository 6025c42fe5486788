import numpy as np
from pyspark.sql import functions as F

from accountweave.llm import rotated_codes as C

SCHEMA = "vec_id long, embedding array<float>, label int, v int, dim int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, 2) for i, v in rows], SCHEMA)


def brute(rows, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for i, q in zip(ids, x, strict=True):
        if i % 20 == 0:
            s = (x * q).sum(1)
            keep = ids != i
            order = np.lexsort((ids[keep], -s[keep]))[:k]
            out[int(i)] = list(zip(ids[keep][order].tolist(), s[keep][order].tolist(), strict=True))
    return out


def test_same_as_brute_force(spark):
    r = np.random.default_rng(3)
    base = r.standard_normal((40, 24))
    rows = [(i, (base[i % 40] + 0.6 * r.standard_normal(24)).astype(np.float32).tolist()) for i in range(1500)]
    rows += [(1500 + i, rows[7][1]) for i in range(120)]  # one frequent vector
    got = C.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, k=20, code_block=256, query_block=16).collect()
    found = {}
    for g in sorted(got, key=lambda g: (g.query_id, g.rank)):
        found.setdefault(g.query_id, []).append((g.vec_id, g.score))
    want = brute(rows, 20)
    assert set(found) == set(want)
    met = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))
    assert met >= 0.99
    assert all(found[q] == want[q] for q in list(want)[:5])


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 2]), (1, [1, 1]), (2, None), (3, [0, 0]), (4, [nan, 1]), (5, [inf, 1]), (6, [None, 1]), (20, []), (7, [3, 0]), (None, [1, 1]), (7, [4, 0]), (40, [1, 2, 3])]
    got = sorted((g.query_id, g.rank, g.vec_id, g.score) for g in C.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, k=20).collect())
    assert got == [(0, 1, 1, 3.0), (0, 2, 7, 3.0)]


def test_empty_table(spark):
    assert C.nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0
