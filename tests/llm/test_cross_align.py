import base64
import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from accountweave.llm import cross_align
from accountweave.llm.tokens import vocabulary_path


def plain(texts):
    """Token by token, without windows; the first tokenizer by its own library."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        a_bytes = {int(i): base64.b64decode(t) for t, i in map(bytes.split, f)}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    found, docs = [], defaultdict(int)
    for text in texts:
        text = text or ""
        x, y = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        data = b" " + text.encode()
        if b"".join(a_bytes[i] for i in x) != data or b"".join(map(piece, y)) != data:
            x, y = [], []
        groups, i, j = [], 0, 0
        while i < len(x):
            one, two = [x[i]], [y[j]]
            m, n = len(a_bytes[x[i]]), len(piece(y[j]))
            i, j = i + 1, j + 1
            while m != n:
                if m < n:
                    one.append(x[i])
                    m += len(a_bytes[x[i]])
                    i += 1
                else:
                    two.append(y[j])
                    n += len(piece(y[j]))
                    j += 1
            groups.append((one, two))
        links = Counter((p, q) for one, two in groups for p in one for q in two)
        for pair in links:
            docs[pair] += 1
        found.append((x, y, groups, links))
    highest = defaultdict(int)
    for (p, _), n in docs.items():
        highest[p] = max(highest[p], n)
    for x, y, groups, links in found:
        shown = ";".join(f"{','.join(map(str, one))}|{','.join(map(str, two))}" for one, two in groups)
        best = sum(k for pair, k in links.items() if docs[pair] == highest[pair[0]])
        yield len(x), len(y), len(groups), sum(links.values()), best, sum(k * docs[p] for p, k in links.items()), shown


def got(docs, **options):
    rows = cross_align.cross_align(docs, **options).collect()
    return Counter((r.id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in rows)


def same(documents, texts, **options):
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    want = Counter((i, *r) for (i, _), r in zip(pairs, plain([t for _, t in pairs]), strict=True))
    assert got(documents(texts, **options), digest=False) == want


ODD = [
    "plain words, twice. plain words", "  two  spaces ", "\n\nlines\n \tand tabs\r\n", "日本語 の text", "\U0001f600\U0001f601 x́", "▁marked ▁",
    "<|endoftext|> and </s><unk><0x0A>", "x" * 5000, "a\u0000b", "  wide　", "1234567 12 3", "don't can't", "﻿bom", "ﬁ Å", " ", "word " * 3000 + "end",
]


def test_same_as_token_by_token(documents, odd):
    same(documents, ODD + odd)
    same(documents, ODD + odd, extra=True)


def test_random_texts(documents):
    r = random.Random(5)
    letters = "abcdeé \n  .,'1日▁😀"
    same(documents, ["".join(r.choices(letters, k=r.randint(0, 80))) for _ in range(300)])


def test_small_pages(documents):
    """Pages change nothing; a pair of one page counts in all."""
    r = random.Random(6)
    words = ["".join(r.choices("abcdefghijklmnop", k=r.randint(1, 9))) for _ in range(60)]
    texts = [" ".join(r.choices(words, k=30)) for _ in range(200)] + [None, "", "▁"]
    aligned = cross_align.align(documents(texts).repartition(5), digest=False, page_documents=7)
    assert aligned.where(f"kind = {cross_align.PAGE}").count() >= 200 // 64
    rows = cross_align.documents(aligned, cross_align.pair_counts(aligned)).collect()
    assert Counter((q.id, q.n_a, q.n_b, q.n_groups, q.n_links, q.n_best, q.count_sum, q.groups) for q in rows) == Counter(
        (i, *row) for i, row in enumerate(plain(texts))
    )


def test_page_limits():
    both = cross_align.tokenizers(vocabulary_path(cross_align.A), vocabulary_path(cross_align.B))
    page = cross_align.Page(both)
    for _ in range(2):
        (windows, _), (again, _), (empty, _), (more, _) = page.documents_of(list(both.ids(["one two three"] * 2 + ["", "three"])))
    assert windows.tolist() == again.tolist() and more.tolist() == windows.tolist()[2:] and not len(empty)
    assert len(windows) == 3 == len(page.shown) and set(page.counts.values()) == {4, 6}
    assert not page.full()
    page.documents = cross_align.PAGE_DOCUMENTS
    assert page.full()


def test_fingerprints_that_clash_in_one_half():
    one, other = np.array([5, 5, 5, 7], np.uint64), np.array([1, 2, 1, 1], np.uint64)
    first, kind = cross_align.first_and_same(one, other)
    assert len(first) == 3 and kind[0] == kind[2] and len(set(kind.tolist())) == 3
    assert all(one[first[k]] == x and other[first[k]] == y for k, x, y in zip(kind, one, other, strict=True))


def test_digest_and_pairs(documents):
    docs = documents(["the cat", "the dog", "the", None])
    shown = {r[0]: r[-1] for r in got(docs, digest=False)}
    assert {r[0]: r[-1] for r in got(docs)} == {i: hashlib.sha256(s.encode()).hexdigest() if s else "" for i, s in shown.items()}
    counts = cross_align.pair_counts(cross_align.align(docs)).collect()
    assert max((r.n_docs, r.best) for r in counts) == (3, True)
    assert all(r.pair == r.a_id << 32 | r.b_id for r in counts)


def test_empty_table(documents):
    assert not got(documents([]))


@pytest.mark.parametrize("first", range(0, 0x3000, 0x400))
def test_ids_of_the_named_library(first):
    """All characters of this range get the ids that the vocabulary's own library gives them."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path(cross_align.A))
    library.encode_special_tokens = True
    both = cross_align.tokenizers(vocabulary_path(cross_align.A), vocabulary_path(cross_align.B))
    for c in map(chr, range(first, first + 0x400)):
        text = f" a{c}b {c}{c} 1{c}2 {c}. .{c}  {c}\n"
        assert both.a.encode_ordinary(text) == library.encode(text, add_special_tokens=False).ids


def test_groups_of_texts_are_bounded_in_number_and_characters():
    long, short = "x" * (cross_align.CHARACTERS // 3), "y"
    texts = [long] * 7 + [long * 4] + [short] * (2 * cross_align.TEXTS)
    groups = list(cross_align.grouped(texts))
    assert [t for i, j in groups for t in texts[i:j]] == texts
    assert all(j - i <= cross_align.TEXTS and (j - i == 1 or sum(map(len, texts[i:j])) <= cross_align.CHARACTERS) for i, j in groups)
    assert [j - i for i, j in groups[:3]] == [3, 3, 1] and len(groups) < 9
    assert list(cross_align.grouped([])) == []
