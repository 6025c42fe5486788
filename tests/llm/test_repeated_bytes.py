import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from accountweave.llm import repeated_bytes as R


def brute(texts, length, keep):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    first, out = set(), []
    for d in data:
        mask = bytearray(len(d))
        for i in range(len(d) - length + 1):
            w = d[i : i + length]
            if seen[w] > 1 and (keep == "none" or w in first):
                mask[i : i + length] = b"\1" * length
            first.add(w)
        kept = bytes(b for b, m in zip(d, mask, strict=True) if not m)
        spans = sum(1 for i, m in enumerate(mask) if m and (i == 0 or not mask[i - 1]))
        out.append((len(d), len(d) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def mixed(seed):
    r = random.Random(seed)
    letters = "abcdefgh é\n"
    unique = lambda n: "".join(r.choices(letters, k=n))
    passage, line = unique(700), unique(420)
    texts = [unique(r.randint(0, 900)) for _ in range(8)]
    texts += [unique(r.randint(0, 300)) + passage[r.randint(0, 100) : r.randint(550, 700)] + unique(r.randint(0, 300)) for _ in range(8)]
    texts += [unique(50) + line + unique(60), line, line * 3, "ab" * 900, "x" * 1500, texts[0], texts[9], None, ""]
    copy = list(texts[10] + unique(900))
    texts.append("".join(copy))
    copy[300] = "z"
    texts.append("".join(copy))
    return texts


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("group", [4096, 2])
def test_same_as_brute_force(spark, documents, monkeypatch, keep, group):
    monkeypatch.setattr(R, "GROUP", group)
    texts = mixed(4)
    out = R.remove_repeats(documents(texts, extra=True), keep=keep)
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()}
    assert got == dict(enumerate(brute(texts, 400, keep)))


def test_later_copies_in_the_first_text_of_a_large_group(documents, monkeypatch):
    monkeypatch.setattr(R, "GROUP", 2)
    r = random.Random(7)
    unique = lambda n: "".join(r.choices("abcdefgh", k=n))
    passage = unique(600)
    texts = [unique(200) + passage + unique(500) + passage + unique(200), *(unique(150) + passage + unique(150) for _ in range(4))]
    got = {x.id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in R.remove_repeats(documents(texts), keep="first").collect()}
    assert got == dict(enumerate(brute(texts, 400, "first")))


def test_pieces_of_a_long_text_agree(monkeypatch):
    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    whole = R.stretches(data)
    monkeypatch.setattr(R, "PIECE", 700)
    parts = R.stretches(data)
    assert set(zip(whole[0], whole[4], strict=True)) == set(zip(parts[0], parts[4], strict=True))
    assert sum(whole[3] - whole[2] + 1) == sum(parts[3] - parts[2] + 1) == 5000 - 399


def test_odd_rows(spark, documents, odd):
    out = R.remove_repeats(documents(odd), keep="none").collect()
    assert len(out) == len(odd)
    assert sorted(r.n_bytes for r in out) == sorted(len(((t[1] if isinstance(t, tuple) else t) or "").encode()) for t in odd)
    assert all(r.n_removed == r.n_bytes for r in out if r.n_bytes > 100_000)


def test_empty_table(spark, documents):
    assert R.remove_repeats(documents([("0", "x")][:0])).count() == 0
