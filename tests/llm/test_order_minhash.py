import random

import numpy as np
import pytest

from accountweave.llm import order_minhash as O
from accountweave.llm.components import components


def words(r, n):
    return ["".join(r.choices("abcdefghij", k=4)) for _ in range(n)]


def edited(r, w, n):
    w = list(w)
    for _ in range(n):
        at = r.randrange(len(w) or 1)
        kind = r.random() if w else 1.0
        if kind < 0.4:
            w[at] = "new" + str(r.randrange(10**6))
        elif kind < 0.7:
            del w[at]
        else:
            w.insert(at, "ins" + str(r.randrange(10**6)))
    return w


def grams(text):
    w = O._WORD.findall((text or "").lower())
    return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def similar(a, b):
    x, y = grams(a), grams(b)
    return distance(x, y) <= int(max(len(x), len(y)) * 0.2 + 1e-9)


def corpus(seed):
    r = random.Random(seed)
    out = []
    for n in (6, 30, 60, 120, 200):
        base = words(r, n)
        out.append(base)
        out += [edited(r, base, k) for k in (1, 1, 2, 3, 6, n // 8, n // 2)]
    loop = words(r, 12) * 12
    out += [loop, edited(r, loop, 2), edited(r, loop, 4), loop[60:] + words(r, 60)]
    out += [words(r, 50) for _ in range(20)] + [out[3], out[9][::-1]]
    return [" ".join(w) for w in out]


def test_verification_is_exact():
    texts = corpus(1)
    pairs = [(a, b) for i, a in enumerate(texts) for b in texts[:i]]
    got = O.verify([a for a, _ in pairs], [b for _, b in pairs])
    assert got.tolist() == [similar(a, b) for a, b in pairs]


def test_banded_alignment_is_exact():
    r = random.Random(2)
    pairs = []
    for _ in range(200):
        a = [r.randrange(6) for _ in range(r.randint(0, 40))]
        b = edited(r, a, r.randint(0, 12)) if a and r.random() < 0.7 else [r.randrange(6) for _ in range(r.randint(0, 40))]
        pairs.append(tuple(np.array([hash(x) % 1000 for x in s], np.int64) for s in (a, b)))
    d = np.array([distance(a.tolist(), b.tolist()) for a, b in pairs])
    for most in (0, 3, 10, 40):
        assert O.distances_within(pairs, np.full(len(pairs), most)).tolist() == (d <= most).tolist()


def brute_classes(texts):
    head = list(range(len(texts)))

    def root(i):
        while head[i] != i:
            i = head[i]
        return i

    for i, a in enumerate(texts):
        for j in range(i):
            same = (a or "") == (texts[j] or "")
            if same or O._WORD.search(a or "") and O._WORD.search(texts[j] or "") and similar(a, texts[j]):
                x, y = sorted((root(i), root(j)))
                head[y] = x
    return {i: root(i) for i in range(len(texts))}


@pytest.mark.parametrize("hot", [20_000, 3])
def test_same_classes_as_brute_force(spark, documents, monkeypatch, hot):
    monkeypatch.setattr(O, "HOT_PAIRS", hot)
    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(broadcast)
    # Without broadcasts the pairs of frequent rows are dealt over repeats.
    spark.conf.set(broadcast, before if hot > 3 else "-1")
    texts = [*corpus(3), None, "", "!!", "!!", "a b", "a b", "A b"]
    try:
        got = {r.own: r.class_id for r in O.groups(documents(texts, extra=True)).collect()}
    finally:
        spark.conf.set(broadcast, before)
    assert got == brute_classes(texts)


def test_one_large_group_of_near_copies(documents):
    r = random.Random(4)
    base = words(r, 150)
    texts = [" ".join(edited(r, base, 2)) for _ in range(150)] + [" ".join(base)] * 50 + [" ".join(words(r, 150)) for _ in range(10)]
    rows = O.groups(documents(texts)).collect()
    assert {r.class_id for r in rows if r.own < 200} == {0} and all(r.class_size == 200 for r in rows if r.own < 200)
    assert {r.class_id for r in rows if r.own >= 200} == set(range(200, 210))


def test_planted_pairs_in_a_large_family_just_below_the_threshold(documents):
    r = random.Random(6)
    new = lambda n: ["".join(r.choices("klmnopqrst", k=7)) for _ in range(n)]
    base = words(r, 163)
    page = lambda block: " ".join([*base[:80], *block, *base[80:]])
    blocks = [new(37) for _ in range(300)]
    planted = {300 + i: r.randrange(10 * i, 10 * i + 10) for i in range(30)}
    blocks += [[*blocks[of][:2], *new(35)] for of in planted.values()]
    texts = [page(b) for b in blocks]
    assert all(similar(texts[i], texts[of]) for i, of in planted.items())
    assert not any(similar(texts[i], texts[i + 1]) for i in range(20))
    got = {x.own: x.class_id for x in O.groups(documents(texts)).collect()}
    assert got == {i: planted.get(i, i) for i in range(330)}


def test_pairs_at_the_threshold_share_a_rare_shingle():
    texts = corpus(5)
    own = [O.labelled(O.shingles(O.word_ids(t))) for t in texts]
    counts = np.bincount(O._slots(np.concatenate(own)), minlength=1 << O.SLOT_BITS)
    rare = [O.rarest(x, counts, 0.8) for x in own]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if similar(texts[i], texts[j])]
    assert len(pairs) > 20 and all(len(np.intersect1d(rare[i][0], rare[j][0])) for i, j in pairs)
    for i, j in pairs:
        _, x, y = np.intersect1d(rare[i][0], rare[j][0], return_indices=True)
        sizes, last = (len(own[i]), len(own[j])), (rare[i][1][x].max(), rare[j][1][y].max())
        need = max(sizes) - int(max(sizes) * 0.2 + 1e-9)
        # The bound that keeps a pair holds for every pair at the threshold.
        assert len(x) + min(n - p for n, p in zip(sizes, last)) - 1 >= need


def test_parities_keep_pairs_at_the_threshold_and_drop_others():
    texts = corpus(9)
    own = [O.labelled(O.shingles(O.word_ids(t))) for t in texts]
    bits = [O.parities(x).view(np.uint8) for x in own]
    kept = dropped = 0
    for i in range(len(texts)):
        for j in range(i):
            apart = np.unpackbits(bits[i] ^ bits[j]).sum()
            assert apart <= len(own[i]) + len(own[j]) - 2 * len(np.intersect1d(own[i], own[j]))
            longer = max(len(own[i]), len(own[j]))
            near = apart <= len(own[i]) + len(own[j]) - 2 * (longer - int(longer * 0.2 + 1e-9))
            if similar(texts[i], texts[j]):
                assert near
                kept += 1
            else:
                dropped += not near
    assert kept > 20 and dropped > 500


def test_few_pairs_of_a_large_group_are_compared(documents, monkeypatch):
    verified, compared = O._verified, []

    def counted(pairs, texts, threshold):
        compared.append(pairs.count())
        return verified(pairs, texts, threshold)

    monkeypatch.setattr(O, "_verified", counted)
    r = random.Random(8)
    base = words(r, 150)
    texts = [" ".join(edited(r, base, 2)) for _ in range(150)]
    assert {x.class_id for x in O.groups(documents(texts)).collect()} == {0}
    assert sum(compared) < 2 * len(texts)


def test_one_row_of_each_class_stays(documents, odd):
    docs = documents(odd, extra=True)
    out = O.one_of_each(docs)
    assert out.schema == docs.schema
    texts = sorted(r.text or "" for r in out.collect())
    assert texts == sorted({(t[1] if isinstance(t, tuple) else t) or "" for t in odd})


def test_empty_table(documents):
    assert O.one_of_each(documents([])).count() == 0
    assert O.groups(documents([])).count() == 0


def test_components(spark):
    r = random.Random(7)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(r.randrange(200, 400), r.randrange(200, 400)) for _ in range(120)]
    head = {n: n for e in links for n in e}

    def root(i):
        while head[i] != i:
            i = head[i]
        return i

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        head[y] = x
    alone = {a for a, b in links if a == b and sum(a in e for e in links) == 1}
    got = {x.node: x.component for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: root(n) for n in head if n not in alone}
