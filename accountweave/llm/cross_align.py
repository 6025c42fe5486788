"""Which tokens of two tokenizers cover the same text, and how often over the corpus.

Every whole text is encoded by both tokenizers, A (byte-level, with a space before the text) and B (pieces, which adds
that space itself). Byte offsets at which tokens of both end cut a text into groups; each A token of a group is linked to
each B token of it.

Windows. A space-marked token of A and one of B that start at the same byte are an anchor: all tokens before end there on
both sides. The offsets come from the lengths of the tokens, after it is verified that the tokens of each side join to
the text. Between anchors lies a window, the A ids and the B ids of about a word; its groups and links depend on these
ids alone and are remembered by them. A document is then a list of window numbers.

Corpus counts. A task keeps its windows and their id pairs in pages of bounded size: a page holds its windows, their
pairs, and in how many of its documents each pair is linked. Pages send each of their pairs once, so a pair that all
documents hold is one row per page, not one per document. Counts are summed by pair, joined back to the pages that asked,
and a page turns them into one number per window; a document adds up its windows. Nothing but the highest count per A
id, at most one row per id of the vocabulary, is broadcast.

Defined cases: null and empty texts, and texts whose tokens of A or B do not join to a space and the text (U+2581 in the
text, for instance), have no tokens: zeros, and an empty text for the groups. Special tokens inside texts are plain text.
Ids may be null or repeated; each row is a document. Other columns, whatever their names, are left alone. Empty tables
give no rows.
"""

from __future__ import annotations

import gc
import hashlib
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountweave.llm.common import stage, text_of
from accountweave.llm.tokens import SPECIAL, token_bytes, vocabulary_path

#: Vocabularies of A and B.
A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A page is closed at so many windows, links or documents; that bounds the memory of a task and changes no result.
PAGE_WINDOWS, PAGE_LINKS, PAGE_DOCUMENTS = 150_000, 1_500_000, 50_000
#: Texts that are encoded at a time, and their characters; characters of words that a worker remembers the ids of. Only speed
#: and memory depend on these: a window that several texts of a group hold is looked up once.
TEXTS, CHARACTERS, MEMORY = 512, 2_000_000, 4_000_000
_ODD_SPACE = re.compile(r" (?:\s|\Z)")
_SEPARATOR = b"\xff\xff\xff\xff"

PAGE, DOCUMENT, ANSWER = 0, 2, 1
_FIELDS = pa.schema(
    [("page", pa.int64()), ("kind", pa.int32())]
    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups", pa.string())]
    + [(c, pa.binary()) for c in ("windows", "sizes", "links", "times", "pairs", "counts")]
)
_SCHEMA = "page long, kind int, n_a long, n_b long, n_groups long, n_links long, groups string, windows binary, sizes binary, links binary, times binary, pairs binary, counts binary"


class Tokenizers:
    """Both tokenizers of a worker, with the bytes of each id."""

    def __init__(self, a_path: str, b_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.a_bytes = token_bytes(a_path)
        # The ids of the vocabulary are its merge order, and no text reaches the special token.
        ranks = {token: i for i, token in enumerate(self.a_bytes) if token != SPECIAL.encode()}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.words: dict[str, tuple[bytes, bytes] | None] = {}
        self.size = 0  # characters of these words
        self.a_length, self.b_length = (np.array([len(t) for t in table]) for table in (self.a_bytes, self.b_bytes))
        self.a_space, self.b_space = (np.array([t[:1] == b" " for t in table]) for table in (self.a_bytes, self.b_bytes))

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _words(self, words: list[str]) -> None:
        """Encode words, each with the space before it, and keep the ids where they join to the word."""
        for word, b in zip(words, self.b.encode(words, num_threads=1), strict=True):
            a = self.a.encode_ordinary(" " + word)
            self.words[word] = (array("I", a).tobytes(), array("I", b).tobytes()) if self._whole(word, a, b) else None
            self.size += len(word)

    def _whole(self, text: str, a: list[int], b: list[int]) -> bool:
        data = b" " + text.encode()
        return b"".join([self.a_bytes[i] for i in a]) == data and b"".join([self.b_bytes[i] for i in b]) == data

    def ids(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Ids of A and B for each text, 32 bits each; none where one of them does not join to a space and the text.

        No token of A reaches over a space that a non-space follows, and no piece of B has a space behind another character.
        So where single spaces stand between words, the ids of a text are those of its words, which are remembered.
        """
        if self.size > MEMORY:
            self.words, self.size = {}, 0
        split = [None if not t or t[0] == " " or _ODD_SPACE.search(t) else t.split(" ") for t in texts]
        self._words(list({w for words in split if words for w in words if w not in self.words}))
        for text, words in zip(texts, split, strict=True):
            if words:
                found = [self.words[w] for w in words]
                yield (b"", b"") if None in found else (b"".join([f[0] for f in found]), b"".join([f[1] for f in found]))
            else:
                a, b = (self.a.encode_ordinary(" " + text), self.b.encode(text)) if text else ([], [])
                yield (array("I", a).tobytes(), array("I", b).tobytes()) if self._whole(text, a, b) else (b"", b"")

    def cuts(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the space-marked tokens of A and B that start at the same byte."""
        at_a, at_b = np.flatnonzero(self.a_space[a]), np.flatnonzero(self.b_space[b])
        starts_a = (np.cumsum(self.a_length[a]) - self.a_length[a])[at_a]
        starts_b = (np.cumsum(self.b_length[b]) - self.b_length[b])[at_b]
        found = np.minimum(np.searchsorted(starts_b, starts_a), len(starts_b) - 1)
        shared = starts_b[found] == starts_a
        return at_a[shared], at_b[found[shared]]

    def shared_ends(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Offsets at which tokens of both sides end, and the numbers of tokens of A and of B up to each."""
        ends_a, ends_b = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        found = np.searchsorted(ends_b, ends_a)
        shared = ends_b[found] == ends_a
        return ends_a[shared], np.flatnonzero(shared) + 1, found[shared] + 1


class Fingerprints:
    """128 bits for runs of ids: sums of ids times a random number for each place, for two sets of such numbers."""

    def __init__(self):
        self.random, self.factors = np.random.default_rng(1), np.zeros((4, 0), np.uint64)

    def __call__(self, a: np.ndarray, cut_a: np.ndarray, b: np.ndarray, cut_b: np.ndarray) -> list[np.ndarray]:
        places = [np.arange(len(x)) - np.repeat(cut, np.diff(cut, append=len(x))) for x, cut in ((a, cut_a), (b, cut_b))]
        longest = max(int(p.max()) + 1 for p in places)
        if longest > self.factors.shape[1]:
            more = self.random.integers(0, 1 << 64, (4, max(longest, 1024)), np.uint64, endpoint=False)
            self.factors = np.concatenate([self.factors, more], axis=1)
        ids = [x.astype(np.uint64) + np.uint64(1) for x in (a, b)]
        sums = [np.add.reduceat(self.factors[i][places[i % 2]] * ids[i % 2], (cut_a, cut_b)[i % 2]) for i in range(4)]
        return [sums[0] + sums[1], sums[2] + sums[3]]


def first_and_same(one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows that agree in both columns the place of one, and for each row the number of its kind."""
    _, first, kind = np.unique(one, return_index=True, return_inverse=True)
    if (other[first][kind] != other).any():
        _, first, kind = np.unique(np.stack([one, other], axis=1), axis=0, return_index=True, return_inverse=True)
    return first, kind.ravel()


def grouped(texts: list[str]) -> Iterator[tuple[int, int]]:
    """First and last (excluded) place of texts that are taken together: one at least, else within both bounds."""
    first = size = 0
    for i, text in enumerate(texts):
        if i > first and (i - first >= TEXTS or size + len(text) > CHARACTERS):
            yield first, i
            first, size = i, 0
        size += len(text)
    if texts:
        yield first, len(texts)


@cache
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


class Page:
    """Windows of some documents, the id pairs that they link, and in how many of the documents each pair is linked."""

    def __init__(self, both: Tokenizers):
        self.both = both
        self.fingerprints = Fingerprints()
        self.number: dict[bytes, int] = {}  # of a window, by its ids
        self.shown: list[str] = []  # of each window: its groups as text,
        self.n_groups: list[int] = []
        self.n_links: list[int] = []
        self.links: list[list[int]] = []  # the numbers of the pairs of its groups,
        self.times: list[list[int]] = []  # and how often a group links each
        self.groups: dict[int | tuple, tuple[str, int, list[int], list[int]]] = {}  # the same of a group, by its ids
        self.pairs: dict[int, int] = {}
        self.counts: Counter[int] = Counter()
        self.documents = self.size = 0

    def full(self, documents: int = PAGE_DOCUMENTS) -> bool:
        return len(self.shown) >= PAGE_WINDOWS or self.size >= PAGE_LINKS or self.documents >= documents

    def _group(self, a: tuple[int, ...], b: tuple[int, ...]) -> tuple[str, int, list[int], list[int]]:
        # Each different pair once, however often its ids occur.
        linked = [(i << 32 | j, m * n) for i, m in Counter(a).items() for j, n in Counter(b).items()]
        shown = f"{','.join(map(str, a))}|{','.join(map(str, b))}"
        return shown, len(a) * len(b), [self.pairs.setdefault(p, len(self.pairs)) for p, _ in linked], [n for _, n in linked]

    def _add(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> None:
        """New windows, one after the other; ``n_a`` and ``n_b`` tell how many ids belong to each."""
        ends, to_a, to_b = self.both.shared_ends(a, b)
        from_a, from_b = np.concatenate([[0], to_a[:-1]]), np.concatenate([[0], to_b[:-1]])
        single = (to_a - from_a == 1) & (to_b - from_b == 1)
        keys: list[int | tuple] = (a[from_a].astype(np.int64) << 32 | b[from_b]).tolist()
        for g in np.flatnonzero(~single).tolist():
            keys[g] = tuple(a[from_a[g] : to_a[g]].tolist()), tuple(b[from_b[g] : to_b[g]].tolist())
        known = self.groups
        for key in set(keys).difference(known):
            known[key] = self._group(*key) if isinstance(key, tuple) else self._group((key >> 32,), (key & 0xFFFFFFFF,))
        found = [known[key] for key in keys]
        window_ends = np.cumsum(self.both.a_length[a])[np.cumsum(n_a) - 1]
        first = 0
        for last in (np.searchsorted(ends, window_ends) + 1).tolist():
            own = found[first:last]
            first = last
            self.shown.append(";".join([g[0] for g in own]))
            self.n_groups.append(len(own))
            self.n_links.append(sum([g[1] for g in own]))
            self.links.append([x for g in own for x in g[2]])
            self.times.append([x for g in own for x in g[3]])
            self.size += len(self.links[-1])

    def documents_of(self, ids: list[tuple[bytes, bytes]]) -> list[tuple[np.ndarray, str]]:
        """For each document, given by its ids: its windows, by number, and its groups."""
        self.documents += len(ids)
        data_a, data_b = b"".join([x for x, _ in ids]), b"".join([y for _, y in ids])
        if not data_a:
            return [(np.zeros(0, np.uint32), "")] * len(ids)
        a, b = np.frombuffer(data_a, np.uint32), np.frombuffer(data_b, np.uint32)
        # Both sides of each document have the same bytes, so the documents in a row are one text, each starting at a cut.
        cut_a, cut_b = self.both.cuts(a, b)
        n_a, n_b = np.diff(cut_a, append=len(a)), np.diff(cut_b, append=len(b))
        first, kind = first_and_same(*self.fingerprints(a, cut_a, b, cut_b))
        spans = [x.tolist() for x in (cut_a[first] * 4, (cut_a + n_a)[first] * 4, cut_b[first] * 4, (cut_b + n_b)[first] * 4)]
        keys = [data_a[i:j] + _SEPARATOR + data_b[k:m] for i, j, k, m in zip(*spans, strict=True)]
        new = [w for w, key in enumerate(keys) if key not in self.number]
        if new:
            at = first[new]
            for w in new:
                self.number[keys[w]] = len(self.number)
            picked = [np.repeat(cut[at] - np.cumsum(n[at]) + n[at], n[at]) + np.arange(n[at].sum()) for cut, n in ((cut_a, n_a), (cut_b, n_b))]
            self._add(a[picked[0]], n_a[at], b[picked[1]], n_b[at])
        numbers = np.fromiter(map(self.number.__getitem__, keys), np.uint32, len(keys))[kind]
        ends = np.searchsorted(cut_a, np.cumsum([len(x) // 4 for x, _ in ids])).tolist()
        out, start = [], 0
        for end in ends:
            windows, start = numbers[start:end], end
            own = windows.tolist()
            self.counts.update(set().union(*map(self.links.__getitem__, set(own))))
            out.append((windows, ";".join(map(self.shown.__getitem__, own))))
        return out

    def row(self) -> dict[str, bytes]:
        flat = lambda lists: np.fromiter(chain.from_iterable(lists), np.int64).tobytes()
        pairs = np.fromiter(self.pairs, np.int64, len(self.pairs))
        return {
            "sizes": np.fromiter(map(len, self.links), np.int64, len(self.links)).tobytes(),
            "links": flat(self.links),
            "times": flat(self.times),
            "pairs": pairs.tobytes(),
            "counts": np.fromiter(map(self.counts.__getitem__, range(len(pairs))), np.int64, len(pairs)).tobytes(),
        }


def align(docs: DataFrame, a: str | None = None, b: str | None = None, id_column: str = "doc_id", text_column: str = "text", digest: bool = True, page_documents: int = PAGE_DOCUMENTS) -> DataFrame:
    """The written table of documents and pages. ``groups`` is the text of a document's groups, or with ``digest`` its SHA-256."""
    a, b = a or vocabulary_path(A), b or vocabulary_path(B)
    rows = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    fields = _FIELDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # pages hold very many small objects, and no cycles
        both = tokenizers(a, b)
        page, number, kind = Page(both), TaskContext.get().partitionId() << 32, None

        def closed() -> pa.RecordBatch:
            made = {"page": number, "kind": PAGE} | page.row()
            columns = [pa.nulls(1, kind)] + [pa.array([made.get(f.name)], f.type) for f in fields]
            return pa.record_batch(columns, names=["id", *fields.names])

        for batch in batches:
            kind, texts = batch.column("id").type, batch.column("text").to_pylist()
            for i, j in grouped(texts):
                out: list[dict] = []
                ids = list(both.ids(texts[i:j]))
                for (x, y), (windows, groups) in zip(ids, page.documents_of(ids), strict=True):
                    n_groups, n_links = (sum(map(s.__getitem__, windows.tolist())) for s in (page.n_groups, page.n_links))
                    if digest and groups:
                        groups = hashlib.sha256(groups.encode()).hexdigest()
                    out.append({"page": number, "kind": DOCUMENT, "n_a": len(x) // 4, "n_b": len(y) // 4, "n_groups": n_groups, "n_links": n_links, "groups": groups, "windows": windows.tobytes()})
                columns = [batch.column("id").slice(i, j - i)] + [pa.array([r.get(f.name) for r in out], f.type) for f in fields]
                yield pa.record_batch(columns, names=["id", *fields.names])
                if page.full(page_documents):
                    yield closed()
                    page, number = Page(both), number + 1
        if page.documents:
            yield closed()

    id_type = rows.schema["id"].dataType.simpleString()
    return stage(rows.mapInArrow(run, f"id {id_type}, {_SCHEMA}"), "aligned", compression="zstd")


def _page_pairs(aligned: DataFrame) -> DataFrame:
    """``page, place, pair, n`` of every pair of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page, pairs, counts in zip(*(batch.column(c).to_pylist() for c in ("page", "pairs", "counts")), strict=True):
                pairs, counts = np.frombuffer(pairs, np.int64), np.frombuffer(counts, np.int64)
                for i in range(0, len(pairs), 1 << 16):
                    part = pairs[i : i + (1 << 16)]
                    columns = [np.full(len(part), page), np.arange(i, i + len(part)), part, counts[i : i + (1 << 16)]]
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["page", "place", "pair", "n"])

    return aligned.where(f"kind = {PAGE}").select("page", "pairs", "counts").mapInArrow(run, "page long, place long, pair long, n long")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, a_id, b_id, n_docs, best``: documents that link the two ids, and whether no other id is linked to ``a_id`` by more."""
    counts = _page_pairs(aligned).groupBy("pair").agg(F.sum("n").alias("n_docs"))
    counts = counts.withColumn("a_id", F.shiftright("pair", 32)).withColumn("b_id", F.col("pair").bitwiseAND(0xFFFFFFFF))
    # At most one row per id of the vocabulary of A.
    highest = counts.groupBy("a_id").agg(F.max("n_docs").alias("highest"))
    return counts.join(F.broadcast(highest), "a_id").select("pair", "a_id", "b_id", "n_docs", (F.col("n_docs") == F.col("highest")).alias("best"))


def documents(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` of every document."""
    id_type = aligned.schema["id"].dataType.simpleString()
    answers = _page_pairs(aligned).drop("n").join(counts.select("pair", "n_docs", "best"), "pair")
    answers = answers.select("page", F.lit(ANSWER).alias("kind"), "place", "n_docs", F.col("best").cast("long").alias("best"))
    rows = aligned.drop("pairs", "counts").unionByName(answers, allowMissingColumns=True)
    sent = ["id", "n_a", "n_b", "n_groups", "n_links", "groups"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = best = sums = bests = np.zeros(0, np.int64)
        ends = links = times = n_docs
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            cut = np.flatnonzero(np.diff(kinds)) + 1
            for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(kinds)], strict=True):
                part = batch.slice(i, j - i)
                if kinds[i] == PAGE:
                    for r in range(j - i):  # pages without pairs may follow each other
                        sizes, links, times = (np.frombuffer(part.column(c)[r].as_py(), np.int64) for c in ("sizes", "links", "times"))
                    ends, n_docs, best = np.cumsum(sizes), *np.zeros((2, int(links.max(initial=-1)) + 1), np.int64)
                    sums = None
                elif kinds[i] == ANSWER:
                    place = part.column("place").to_numpy()
                    n_docs[place], best[place] = part.column("n_docs").to_numpy(), part.column("best").to_numpy()
                else:
                    if sums is None:
                        totals = [np.concatenate([[0], np.cumsum(times * x[links])])[np.concatenate([[0], ends])] for x in (n_docs, best)]
                        sums, bests = (np.diff(t) for t in totals)
                    windows = [np.frombuffer(w, np.uint32) for w in part.column("windows").to_pylist()]
                    columns = [part.column(c) for c in sent]
                    columns += [pa.array([int(x[w].sum()) for w in windows], pa.int64()) for x in (bests, sums)]
                    yield pa.record_batch(columns, names=[*sent, "n_best", "count_sum"])

    paged = rows.repartition("page").sortWithinPartitions("page", "kind")
    schema = f"id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long"
    return paged.mapInArrow(run, schema)


def cross_align(docs: DataFrame, a: str | None = None, b: str | None = None, id_column: str = "doc_id", text_column: str = "text", digest: bool = True) -> DataFrame:
    """All steps: what ``documents`` gives for every row of ``docs``."""
    aligned = align(docs, a, b, id_column, text_column, digest)
    return documents(aligned, pair_counts(aligned))
