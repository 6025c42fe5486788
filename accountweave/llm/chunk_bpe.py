"""Byte-level BPE with reuse of text chunks: what many texts share is encoded once.

A rolling hash over 32 bytes cuts each text where it is a multiple of ``MODULUS``, so a passage is cut alike wherever it
stands. Chunks that occur at least twice are encoded once and their ids sent to the texts that hold them; all other
chunks are encoded where they are. A chunk's ids are right but for its ends, where a token might reach over the cut. At
each join the text is therefore encoded again, from the last place in the chunk to the left where no token can reach
over to the first such place in the chunk to the right (further, if a chunk has no such place): there both encodings
agree, and the chunk's own ids go on. The result is that of one encoding of the whole text.

Places where no token can reach over are those before a space that a non-space follows: the pattern of the vocabulary
starts a new piece there whatever came before.

Plan: hashes of chunks are counted without their texts. Texts are shuffled by key only if they hold a shared chunk; a bit
field of fixed size finds those, and all others are encoded in place. Counts are combined before they are shuffled, so a
chunk in a third of all texts is one row per task; its ids are joined by a plain join that Spark splits where needed.

Defined cases: a null text is empty and has no ids; repeated rows get the same ids; a text without any cut is one chunk;
texts with the special token are given to the library whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountweave.llm.common import KEY, maybe_in, row_key, stage, text_of
from accountweave.llm.tokens import SPECIAL, SegmentEncoder, encoder, token_bytes, vocabulary_path

WINDOW, MODULUS = 32, 512
#: A text without cuts is cut after so many bytes from its last cut.
LONGEST = 1 << 16
_TABLE = np.random.default_rng(43).integers(1, 1 << 63, 256, np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def cuts(data: bytes) -> list[int]:
    """Ends of chunks, always between characters; the last is the end of the text."""
    n = len(data)
    b = np.frombuffer(data, np.uint8)
    found = np.zeros(0, np.int64)
    if n > WINDOW:
        h, size = _TABLE[b], 1
        while size < WINDOW:
            h = (h[:-size] ^ (h[:-size] >> np.uint64(31))) * _MIX + h[size:]
            size *= 2
        at = np.flatnonzero((h ^ (h >> np.uint64(33))) % np.uint64(MODULUS) == 0) + WINDOW
        found = at[at < n]
        found = found[(b[found] & 0xC0) != 0x80]
    out, last = [], 0
    for at in [*found.tolist(), n]:
        while at - last > LONGEST:
            last += LONGEST
            while last > 0 and b[last] & 0xC0 == 0x80:
                last -= 1
            out.append(last)
        if at > last or at == n:
            out.append(at)
            last = at
    return out


def pieces(data: bytes) -> list[tuple[int, int, int]]:
    """Start, end and hash of each chunk."""
    ends = cuts(data)
    return [(s, e, xxhash.xxh3_64_intdigest(data[s:e]) - (1 << 63)) for s, e in zip([0, *ends[:-1]], ends, strict=True)]


def outer(text: str) -> tuple[int, int] | None:
    """First and last safe place of a chunk; none if it has fewer than two."""
    first = next((i for i in _places(text, 1)), -1)
    if first < 0:
        return None
    last = len(text)
    while True:
        last = text.rfind(" ", first + 1, last)
        if last < 0:
            return None
        if last + 1 < len(text) and not text[last + 1].isspace():
            return first, last


def _places(text: str, start: int) -> Iterator[int]:
    """Spaces that a non-space follows, from ``start`` on."""
    at = text.find(" ", start)
    while at >= 0:
        if at + 1 < len(text) and not text[at + 1].isspace():
            yield at
        at = text.find(" ", at + 1)


def inner_ids(coder: SegmentEncoder, text: str) -> bytes | None:
    """Ids of a chunk between its outer safe places; none where there are not two."""
    place = outer(text)
    return coder.encode(text[place[0] : place[1]]) if place else None


def joined(coder: SegmentEncoder, text: str, data: bytes, ids_of: dict[int, bytes | None], chunks: list[tuple[int, int, int]]) -> bytes:
    """Ids of the whole text from ids of its chunks; what lies between two inner parts is encoded again."""
    if SPECIAL in text or len(chunks) < 2:
        return coder.encode(text)
    out, open_ = [], []
    for s, e, h in chunks:
        part = data[s:e].decode()
        place = outer(part)
        if place is None:
            open_.append(part)
            continue
        open_.append(part[: place[0]])
        out.append(coder.encode("".join(open_)))
        known = ids_of.get(h)
        out.append(coder.encode(part[place[0] : place[1]]) if known is None else known)
        open_ = [part[place[1] :]]
    out.append(coder.encode("".join(open_)))
    return b"".join(out)


def _narrow(ids: bytes, wide: bool) -> bytes:
    """16 bits per id for the way, where the vocabulary allows."""
    return ids if wide else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def _wide(ids: bytes, wide: bool) -> bytes:
    return ids if wide else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def _chunk_rows(rows: DataFrame) -> DataFrame:
    """``KEY, no, h`` of every chunk, without its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, nos, hs = [], [], []
            for key, text in zip(batch.column(KEY).to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = pieces(text.encode())
                keys += [key] * len(own)
                nos += range(len(own))
                hs += [h for _, _, h in own]
            if keys:
                yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(nos, pa.int32()), pa.array(hs, pa.int64())], names=[KEY, "no", "h"])

    return rows.mapInArrow(run, f"{KEY} binary, no int, h long")


def encode_shared(docs: DataFrame, vocabulary: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each row's id, text and ``shared``: hash and ids of the chunks of it that others share."""
    vocabulary = vocabulary or vocabulary_path()
    rows = docs.select(row_key(id_column, text_column).alias(KEY), text_of(text_column).alias("text"))
    chunks = stage(_chunk_rows(rows), "chunks", compression="zstd")
    counted = chunks.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct(KEY, "no")).alias("one")).where("n > 1")
    counted = stage(counted.select("h", "one.*"), "shared-chunks")
    wanted = counted.groupBy(KEY).agg(F.collect_list("no").alias("nos"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        wide = coder.wide
        for batch in batches:
            out: dict[int, bytes | None] = {}
            for text, nos in zip(batch.column("text").to_pylist(), batch.column("nos").to_pylist(), strict=True):
                data = text.encode()
                own = pieces(data)
                for s, e, h in (own[no] for no in nos):
                    if h not in out:
                        part = data[s:e].decode()
                        ids = None if SPECIAL in part else inner_ids(coder, part)
                        out[h] = None if ids is None else _narrow(ids, wide)
            kept = {h: ids for h, ids in out.items() if ids is not None}
            if kept:
                yield pa.record_batch([pa.array(kept.keys(), pa.int64()), pa.array(kept.values(), pa.binary())], names=["h", "ids"])

    few = maybe_in(counted.select(F.xxhash64(KEY)))
    found = rows.where(few(F.xxhash64(KEY))).join(wanted, KEY)
    encoded = stage(found.select("text", "nos").mapInArrow(run, "h long, ids binary"), "encoded-chunks", compression="zstd")
    # A repeated row encodes its chunks as often; one of each counts.
    holds = chunks.select(KEY, "h").distinct().join(encoded.dropDuplicates(["h"]), "h")
    return holds.groupBy(KEY).agg(F.collect_list(F.struct("h", "ids")).alias("shared"))


def _encoded(rows: DataFrame, shared: DataFrame, vocabulary: str, finish, fields: str, kinds: tuple) -> DataFrame:
    """``rows`` (``KEY``, ``text``, ``own``) as ``own`` and what ``finish`` makes of the ids of each."""
    kind = rows.schema["own"].dataType.simpleString()
    names = ["own", *(f.split()[0] for f in fields.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                out = []
                for text, shared in zip(part.column("text").to_pylist(), part.column("shared").to_pylist(), strict=True):
                    data = text.encode()
                    known = {x["h"]: _wide(x["ids"], coder.wide) for x in shared or ()}
                    ids = joined(coder, text, data, known, pieces(data)) if known else coder.encode(text)
                    out.append(finish(ids, vocabulary))
                yield pa.record_batch([part.column("own"), *(pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True))], names=names)

    some = maybe_in(shared.select(F.xxhash64(KEY)))(F.xxhash64(KEY))
    with_shared = rows.where(some).join(shared, KEY, "left").select("own", "text", "shared")
    none = F.lit(None).cast(with_shared.schema["shared"].dataType).alias("shared")
    every = rows.where(~some).select("own", "text", none).unionByName(with_shared)
    return every.mapInArrow(run, f"own {kind}, {fields}")


def with_ids(docs: DataFrame, vocabulary: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``token_ids`` (little-endian unsigned 32-bit) of every whole text."""
    vocabulary = vocabulary or vocabulary_path()
    shared = stage(encode_shared(docs, vocabulary, id_column, text_column), "shared-ids", compression="zstd")
    rows = docs.select(row_key(id_column, text_column).alias(KEY), text_of(text_column).alias("text"), F.struct("*").alias("own"))
    fields, kinds = "n_tokens long, token_ids binary", (pa.int64(), pa.binary())
    out = _encoded(rows, shared, vocabulary, lambda ids, _: (len(ids) // 4, ids), fields, kinds)
    return out.select("own.*", "n_tokens", "token_ids")


_SHOWN: dict[str, list[str]] = {}


def decode(ids: np.ndarray, vocabulary: str) -> str:
    """The text of the ids; bytes that are no characters become the replacement character, as the library has it."""
    table = token_bytes(vocabulary)
    return b"".join(map(table.__getitem__, ids.tolist())).decode("utf-8", "replace")


def digests(ids: bytes, vocabulary: str) -> tuple[int, str, str]:
    """Number of ids, digest of the decimal ids joined by commas, digest of the decoded text."""
    values = np.frombuffer(ids, "<u4")
    shown = _SHOWN.get(vocabulary) or _SHOWN.setdefault(vocabulary, [str(i) for i in range(len(token_bytes(vocabulary)))])
    listed = ",".join(map(shown.__getitem__, values.tolist()))
    return len(values), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(decode(values, vocabulary).encode()).hexdigest()


def round_trip(docs: DataFrame, vocabulary: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` of every whole text."""
    vocabulary = vocabulary or vocabulary_path()
    shared = stage(encode_shared(docs, vocabulary, id_column, text_column), "shared-ids", compression="zstd")
    rows = docs.select(row_key(id_column, text_column).alias(KEY), text_of(text_column).alias("text"), F.col(id_column).alias("own"))
    fields, kinds = "n_tokens long, ids_sha256 string, decoded_sha256 string", (pa.int64(), pa.string(), pa.string())
    return _encoded(rows, shared, vocabulary, digests, fields, kinds).withColumnRenamed("own", "id")
