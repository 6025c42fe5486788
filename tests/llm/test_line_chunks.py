import hashlib
import random
from collections import Counter

import pytest

from accountweave.llm import line_chunks as L


def cut(lines):
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    back = lambda i: h[i] if i >= 0 else 0
    out, at = [], 0
    for i in range(len(lines)):
        if (h[i] + 31 * back(i - 1) + 961 * back(i - 2)) % 1_000_000_007 % 4 == 0 or i == len(lines) - 1:
            out.append(lines[at : i + 1])
            at = i + 1
    return out


def brute(rows):
    """Kept text per row; rows: (id, text), ids unique."""
    cuts = [(i, cut((t or "").split("\n"))) for i, t in rows]
    can = lambda c: sum(bool(x.strip(" ")) for x in c) >= 2
    seen = Counter("\n".join(c) for _, chunks in cuts for c in chunks if can(c))
    first, out = set(), {}
    for i, chunks in sorted(cuts, key=lambda c: c[0]):
        kept = []
        for c in chunks:
            text = "\n".join(c)
            if can(c) and seen[text] > 1 and text in first:
                continue
            if can(c):
                first.add(text)
            kept.append(text)
        out[i] = "\n".join(kept)
    return out


def texts(seed):
    r = random.Random(seed)
    line = lambda: "".join(r.choices("abc ", k=r.randint(0, 12)))
    passages = [[line() for _ in range(r.randint(5, 30))] for _ in range(4)]
    out = []
    for _ in range(60):
        body = []
        for _ in range(r.randint(1, 4)):
            body += r.choice(passages) if r.random() < 0.5 else [line() for _ in range(r.randint(1, 8))]
        out.append("\n".join(body))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(documents, seed):
    rows = list(enumerate([*texts(seed), None, "", "one"]))
    got = {r["__aw_row"].doc_id: r.kept for r in L.dedup_lines(documents(rows, extra=True)).collect()}
    want = brute(rows)
    assert got == want
    assert sum(len(want[i]) < len(t or "") for i, t in rows) > 10


def test_columns_stay(documents):
    docs = documents(texts(1), extra=True)
    out = L.without_repeats(docs)
    assert out.schema == docs.schema
    for r in out.collect():
        assert r.n_chars == len(r.text)


def test_odd_rows(documents, odd):
    out = L.without_repeats(documents(odd)).collect()
    assert len(out) == len(odd)


def test_one_very_frequent_passage(documents):
    passage = "\n".join(f"line number {i}" for i in range(40))
    out = L.dedup_lines(documents([f"own {i}\n{passage}\nend {i}" for i in range(300)])).collect()
    lost = [r.n_removed for r in out]
    assert sorted(lost)[0] == 0 and sorted(lost)[1] >= 20


def test_built_in_functions_only(documents):
    plan = L.dedup_lines(documents(["a\nb"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(documents):
    assert L.without_repeats(documents([])).count() == 0


def whole_rule(rows):
    """Kept text per row by the rule of every repeated passage of two lines and more; rows: (id, text), ids unique."""
    first, out = {}, {}
    for i, t in sorted(rows):
        lines = (t or "").split("\n")
        filled = [k for k, x in enumerate(lines) if x.strip(" ")]
        gone = set()
        for at, end in zip(filled, filled[1:]):
            own = first.setdefault(tuple(lines[at : end + 1]), (i, at, end))
            if own[0] != i or at > own[2]:
                gone |= set(range(at, end + 1))
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_pipeline_stage_same_as_whole_rule(documents, seed):
    rows = list(enumerate([*texts(seed), "a\na\na\na\na", "b\n\n \nc\nb\n\n \nc", None, "", "one"]))
    got = {r.doc_id: r.text or "" for r in L.without_repeats(documents(rows, extra=True)).collect()}
    assert got == whole_rule(rows)


def test_short_passages_in_other_surroundings_go(documents):
    r = random.Random(3)
    line = lambda n: " ".join("".join(r.choices("abcdefgh", k=5)) for _ in range(n))
    rows, want = [], []
    for n in range(2, 11):
        passage = [line(60 // n + 1) for _ in range(n)]
        for copy in range(3):
            before, after = [line(8) for _ in range(r.randint(1, 4))], [line(8) for _ in range(r.randint(1, 4))]
            rows.append("\n".join([*before, *passage, *after]))
            want.append("\n".join([*before, *(passage if copy == 0 else []), *after]))
    out = L.without_repeats(documents(rows))
    assert [x.text for x in sorted(out.collect(), key=lambda x: x.doc_id)] == want
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
