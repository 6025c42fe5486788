import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from accountweave.llm import token_files as T
from accountweave.llm.tokens import SegmentEncoder, vocabulary_path

TEXTS = ["Hello  world.\nAnd  the  the", "a<|endoftext|>b", "²½ x́ 'll don't 12 345", " lead", "trail ", "\n \t x", "", None, "Été, naïve; ça va!", "x\x1cy \x1c z", "<|endof text|>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_segments_give_the_ids_of_the_library(library):
    coder = SegmentEncoder(vocabulary_path())
    for _ in range(2):
        for t in TEXTS:
            assert coder.encode(t or "") == np.array(ids(library, t), "<u4").tobytes()


@pytest.mark.parametrize("values", [[], [0], [255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1], list(range(0, 70000, 7))])
def test_coding_round_trip(values):
    control, data = T.pack(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert T.unpack(control, data, len(values)).tolist() == values


def test_files_hold_all_ids_in_order(spark, documents, library, tmp_path):
    texts = TEXTS * 3
    docs = documents([(100 - i, t) for i, t in enumerate(texts)], extra=True)
    T.write_ids(docs, str(tmp_path))
    rows = T.read_ids(spark, str(tmp_path))
    start, want = 0, {}
    for i, t in sorted((100 - i, t) for i, t in enumerate(texts)):
        own = [*ids(library, t), 0]
        want[i] = (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)
    assert {r.doc_id: list(r.ids) for r in rows.collect()} == {i: [*ids(library, t), 0] for i, t in ((100 - i, t) for i, t in enumerate(texts))}
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in T.with_starts(rows.drop("ids")).collect()} == want
    counted = sorted(spark.read.parquet(f"{tmp_path}/ranks").collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in counted] == list(range(len(counted)))
    assert all(a.n > b.n or a.n == b.n and a.id < b.id for a, b in zip(counted, counted[1:], strict=False))


def test_odd_rows(spark, documents, odd, tmp_path):
    T.write_ids(documents(odd), str(tmp_path))
    rows = T.with_starts(T.read_ids(spark, str(tmp_path), ids=False)).collect()
    assert len(rows) == len(odd)
    at = 0
    for r in sorted(rows, key=lambda r: (r.start, r.n_tokens)):
        assert r.start == at
        at += r.n_tokens


def test_empty_table(spark, documents, tmp_path):
    T.write_ids(documents([]), str(tmp_path))
    assert T.read_ids(spark, str(tmp_path)).count() == 0


def test_plain_words_go_to_the_model_without_the_pattern(monkeypatch):
    """ASCII words, points behind them, and repeats with other points, at the start of a text and after a space."""
    coder = SegmentEncoder(vocabulary_path())
    texts = ["plain words, and. more!? plain: words; plain.", "words", "Zz.,", "a a. a", "x" * 70 + " " + "x" * 70 + "."]
    expected = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]

    def never(self, text):
        raise AssertionError(text)

    monkeypatch.setattr(SegmentEncoder, "_encode", never)
    assert [np.frombuffer(coder.encode(t), "<u4").tolist() for t in texts] == expected


def test_words_next_to_plain_ones_are_encoded_as_by_the_library():
    coder = SegmentEncoder(vocabulary_path())
    for text in ["it's. don't, \u00e9t\u00e9. na\u00efve", "... , a.b a.\nb c\nd. 12. x2, _a_ .", ".a a.. \u00aa. 1st \ta.", "a.\n", "\u4e00. \u4e00 b"]:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("rows", [[], [[]], [[], [300], [], [1, 2, 3, 4, 70000], [1 << 24]], [list(range(0, 70000, 7)), [0, 256, 65536]]])
def test_rows_are_packed_as_one_by_one(rows):
    begins = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    control, data = T.pack_rows(np.array([v for r in rows for v in r], np.uint32), begins)
    assert list(zip(control.to_pylist(), data.to_pylist(), strict=True)) == [T.pack(np.array(r, np.uint32)) for r in rows]
    values, again = T.unpack_rows(control, data, np.diff(begins))
    assert [values[a:b].tolist() for a, b in zip(again, again[1:], strict=False)] == rows
    if len(rows) > 2:
        values, again = T.unpack_rows(control[1:], data[1:], np.diff(begins)[1:])
        assert [values[a:b].tolist() for a, b in zip(again, again[1:], strict=False)] == rows[1:]


def test_a_worker_remembers_more_than_half_a_million_segments(monkeypatch):
    """Words seen once stay known while as many others pass as a worker's share of documents holds."""
    coder = SegmentEncoder(vocabulary_path(), T.SEGMENTS)
    monkeypatch.setattr(SegmentEncoder, "_word", lambda self, word, memory: b"\0\0\0\0")
    for at in range(0, 600_000, 50_000):
        coder.encode(" ".join(map(str, range(at, at + 50_000))))
    coder.encode("last")
    assert len(coder.known) > 500_000
