"""Removal of long repeated byte strings, by longest-previous-factor arrays over suffixes that can match at all.

A string of ``LENGTH`` bytes that occurs twice has the same least 128-byte hash (its anchor) at the same place in both
occurrences. So suffixes are grouped by anchor before they are sorted: what can be equal is in one group, and a group is
a small part of the corpus. Per group the suffixes that begin a window are put in suffix order; in a run of suffixes
that agree in ``LENGTH`` bytes, in order of position, the neighbours are the previous and next smaller position, so the
longest-previous-factor value reaches ``LENGTH`` for all but the first, and the same array from the other end for all
but the last. Values are cut off at ``LENGTH``, which is all that removal needs.

``keep="first"`` removes what has an earlier occurrence (in order of ids, then key, then position);
``keep="none"`` removes every occurrence of what occurs twice.

Plan: windows that share an anchor are neighbours and form one stretch; only hashes of stretches are shuffled, about one
per 137 bytes. Equal stretches are counted before they are compared, so copies, however many, are one stretch. Texts are
fetched for stretches that share an anchor but differ. A group with more than ``GROUP`` different stretches (a passage
in many surroundings) is not brought to one task: its windows are dealt by a 128-bit hash of their bytes and counted.

Defined cases: null texts are empty; texts below ``LENGTH`` bytes lose nothing; repeated rows are copies of each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountweave.llm.common import KEY, row_key, stage, text_of

LENGTH, GRAM = 400, 128
#: Different stretches of a group that one task compares: at most 3 MB.
GROUP = 4096
#: Distance of the shorter windows by which larger groups are dealt first.
GRID = 16
#: Bytes of texts that are looked at in one go.
PIECE = 1 << 20
_LAST = 9223372036854775807
_TABLE = np.random.default_rng(41).integers(1, 1 << 63, 256, np.uint64)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _join(left: np.ndarray, right: np.ndarray, factor: np.uint64 = _A) -> np.ndarray:
    h = left ^ (left >> np.uint64(29))
    h *= factor
    h += right
    h ^= h >> np.uint64(32)
    return h


def gram_hashes(data: np.ndarray, *sizes: int, factor: np.uint64 = _A) -> list[np.ndarray]:
    """Hashes of all runs of each of ``sizes`` (ascending) bytes, joined from those of half the size."""
    h, size, out = _TABLE[data], 1, []
    for wanted in sizes:
        while size * 2 <= wanted:
            h = _join(h[:-size], h[size:], factor)
            size *= 2
        out.append(h if size == wanted else _join(h[: len(h) - (wanted - size)], h[wanted - size :], factor))
    return out


def stretches(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: anchor hash, hash of the stretch, first and last window, anchor position."""
    n = len(data)
    parts = []
    for at in range(0, max(0, n - length + 1), PIECE):
        piece = data[at : min(n, at + PIECE + length - 1)]
        grams, wide = gram_hashes(piece, gram, 2 * gram)
        least = (grams & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(grams), dtype=np.uint64)
        span, have = length - gram + 1, 1
        while have * 2 <= span:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < span:
            least = np.minimum(least[: len(least) - (span - have)], least[span - have :])
        where = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
        last = np.r_[first[1:], len(where)] - 1
        anchor, end = where[first], last + length
        # Three overlapping wide runs cover a stretch, whose length is below three times theirs.
        middle = np.minimum(first + 2 * gram, end - 2 * gram)
        own = _join(_join(wide[first], wide[middle]), wide[end - 2 * gram])
        own = _join(own, ((end - first) * 4096 + anchor - first).astype(np.uint64) * _B)
        parts.append((grams[anchor].view(np.int64), own.view(np.int64), first + at, last + at, anchor + at))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _stretch_rows(rows: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "stretch", "first", "last", "at"]
        for batch in batches:
            keys, ids = batch.column(KEY).to_pylist(), batch.column("id").to_pylist()
            found, owner = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                own = stretches(np.frombuffer(text.encode(), np.uint8), length)
                if len(own[0]):
                    found.append(own)
                    owner.append(np.full(len(own[0]), i))
            if found:
                at = pa.array(np.concatenate(owner))
                columns = [np.concatenate(c) for c in zip(*found, strict=True)]
                yield pa.record_batch(
                    [pa.array(keys, pa.binary()).take(at), pa.array(ids, pa.int64()).take(at), *map(pa.array, columns)], names=[KEY, "id", *names]
                )

    return rows.mapInArrow(run, f"{KEY} binary, id long, anchor long, stretch long, first long, last long, at long")


def _fetched(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted stretches. ``wanted``: a row per text, with an array of its stretches."""
    fields = ["id", "anchor", "stretch", "first", "at", "copies", "different"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for key, text, parts in zip(*(batch.column(c).to_pylist() for c in (KEY, "text", "parts")), strict=True):
                data = text.encode()
                for p in parts:
                    out.append((key, *(p[f] for f in fields), data[p["first"] : p["last"] + length]))
                    size += p["last"] - p["first"] + length
                if size > 1 << 23:
                    yield table(out)
                    out, size = [], 0
            if out:
                yield table(out)

    def table(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.binary(), *[pa.int64()] * 7, pa.binary()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)], names=[KEY, *fields, "data"])

    schema = f"{KEY} binary, " + ", ".join(f"{f} long" for f in fields) + ", data binary"
    return rows.select(KEY, "text").join(wanted, KEY).select(KEY, "text", "parts").mapInArrow(run, schema)


def factors(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For windows at ``starts`` (in order of position): whether one before, and one after, has equal bytes.

    These are the longest-previous-factor values and those of the reversed order, cut off at ``length`` and compared
    with it. Windows without an equal hash are set aside first, the rest is sorted as suffixes, byte by byte.
    """
    before, after = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    if len(starts):
        h = gram_hashes(data, length)[0][starts]
        order = np.argsort(h, kind="stable")
        same = h[order][1:] == h[order][:-1]
        near = np.sort(order[np.r_[same, False] | np.r_[False, same]])
        # Hash classes are sorted in parts of bounded size; a class is never cut.
        for part in _classes(near, h, 1 << 15):
            suffixes = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, length)[starts[part]]).view(f"S{length}").ravel()
            rank = np.argsort(suffixes, kind="stable")
            equal = suffixes[rank][1:] == suffixes[rank][:-1]
            before[part[rank[1:][equal]]] = True
            after[part[rank[:-1][equal]]] = True
    return before, after


def _classes(near: np.ndarray, h: np.ndarray, size: int) -> Iterator[np.ndarray]:
    if len(near) <= size:
        if len(near):
            yield near
        return
    order = near[np.argsort(h[near], kind="stable")]
    new = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]])
    at = 0
    while at < len(order):
        cut = new[np.searchsorted(new, min(at + size, len(order)))] if at + size < new[-1] else len(order)
        cut = cut if cut > at else len(order)
        yield np.sort(order[at:cut])
        at = cut


def _spans(first: np.ndarray, length: int) -> list[dict[str, int]]:
    """Byte spans that windows at ``first`` (ascending) cover."""
    if not len(first):
        return []
    cut = np.flatnonzero(first[1:] > first[:-1] + length)
    begin, end = first[np.r_[0, cut + 1]], first[np.r_[cut, len(first) - 1]] + length
    return [{"s": int(s), "e": int(e)} for s, e in zip(begin, end, strict=True)]


def _compared(fetched: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """``KEY, s, e``: spans of the stretches whose windows occur in another stretch of the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "copies", KEY, "first", "data")), strict=True):
                if held and row[:4] == held[-1][:4]:
                    continue  # a repeated row
                if size > 1 << 22 and row[0] != held[-1][0]:
                    yield from done(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield from done(held)

    def done(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        data = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
        sizes = np.array([len(r[4]) for r in rows])
        begins = np.cumsum(sizes) - sizes
        counts = sizes - length + 1
        owner = np.repeat(np.arange(len(rows)), counts)
        starts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + begins[owner]
        before, after = factors(data, starts, length)
        hit = before if keep_first else before | after
        out = []
        at = np.flatnonzero(hit)
        cuts = np.flatnonzero(np.r_[True, owner[at][1:] != owner[at][:-1]]) if len(at) else []
        for a, b in zip(cuts, [*cuts[1:], len(at)], strict=True):
            i = owner[at[a]]
            _, copies, key, first, _ = rows[i]
            if keep_first or copies == 1:
                out += [(key, first + s["s"], first + s["e"]) for s in _spans(starts[at[a:b]] - begins[i], length)]
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.int64()), strict=True)], names=[KEY, "s", "e"])

    ordered = fetched.repartition("anchor").sortWithinPartitions("anchor", "id", KEY, "first")
    return ordered.select("anchor", "copies", KEY, "first", "data").mapInArrow(run, f"{KEY} binary, s long, e long")


def _window_rows(rows: DataFrame, length: int, step: int = 1) -> DataFrame:
    """A row with a 128-bit hash per window of ``length`` bytes; only those at a multiple of ``step`` from the anchor.

    Where ``rows`` have ``near`` (window positions at that step), only windows that begin at most ``GRID - 1`` before one.
    """
    some = "near" in rows.columns
    names = [KEY, "id", "copies", "first", "s", "h", "g"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [KEY, "id", "copies", "first", "at", "data", *["near"] * some]
        for batch in batches:
            for key, ident, copies, first, anchor, data, *near in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                own = np.frombuffer(data, np.uint8)
                if len(own) < length:
                    continue
                h, g = gram_hashes(own, length)[0], gram_hashes(own, length, factor=_B)[0]
                at = np.arange(len(h)) + first
                if some:
                    wanted = np.zeros(len(h) + GRID, bool)
                    for back in range(GRID):
                        t = np.array(near[0]) - first - back
                        wanted[t[(t >= 0) & (t < len(h))]] = True
                    keep = wanted[: len(h)]
                else:
                    keep = (anchor - at) % step == 0
                n = int(keep.sum())
                same = [pa.array([key] * n, pa.binary()), *(pa.array(np.full(n, v)) for v in (ident, copies, first))]
                yield pa.record_batch([*same, pa.array(at[keep]), pa.array(h[keep].view(np.int64)), pa.array(g[keep].view(np.int64))], names=names)

    return rows.mapInArrow(run, f"{KEY} binary, id long, copies long, first long, s long, h long, g long")


def _dealt(fetched: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """The same for groups of any size: windows are dealt by a hash of their bytes and counted before they meet.

    Every window holds a slightly shorter one that stands at a multiple of ``GRID`` from the anchor. Those are dealt first;
    whole windows are only made next to those that occur again.
    """
    coarse = stage(_window_rows(fetched, length - GRID + 1, GRID), "coarse-windows", compression="zstd")
    again = coarse.groupBy("h", "g").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    near = coarse.join(stage(again, "repeated-coarse"), ["h", "g"]).groupBy(KEY, "first").agg(F.collect_set("s").alias("near"))
    windows = stage(_window_rows(fetched.join(near, [KEY, "first"]), length), "windows", compression="zstd")
    again = windows.groupBy("h", "g").agg(F.count("*").alias("n"), F.min(F.struct("id", KEY, "s")).alias("low")).where("n > 1").drop("n")
    met = windows.join(stage(again, "repeated-windows"), ["h", "g"])
    met = met.where(F.struct("id", KEY, "s") > F.col("low")) if keep_first else met.where("copies = 1")
    return met.select(KEY, "s", (F.col("s") + length).alias("e"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, keep: str = "first", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``KEY, spans``: per row that loses something, byte spans (``s``, ``e``), not merged yet."""
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    keep_first = keep == "first"
    own_id = F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST))
    rows = docs.select(row_key(id_column, text_column).alias(KEY), own_id.alias("id"), text_of(text_column).alias("text"))
    found = stage(_stretch_rows(rows, length), "stretches", compression="zstd")
    anchors = found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("stretch").alias("a"), F.max("stretch").alias("b")).where("n > 1")
    anchors = stage(anchors.select("anchor", (F.col("a") != F.col("b")).alias("mixed")), "anchors")
    shared = stage(found.join(anchors, "anchor"), "shared-stretches", compression="zstd")
    counts = shared.groupBy("anchor", "stretch").agg(F.count("*").alias("copies"), F.min(F.struct("id", KEY, "first", "last", "at")).alias("one"), F.max("mixed").alias("mixed"))
    counts = stage(counts, "stretch-counts", compression="zstd")
    # Whole stretches that occur again.
    copied = shared.join(stage(counts.where("copies > 1").select("anchor", "stretch", "one"), "copied"), ["anchor", "stretch"])
    if keep_first:
        copied = copied.where((F.col(KEY) != F.col(f"one.{KEY}")) | (F.col("first") != F.col("one.first")))
    copied = copied.select(KEY, F.col("first").alias("s"), (F.col("last") + length).alias("e"))
    # Stretches that share an anchor with different ones.
    mixed = counts.where("mixed").select("anchor", "stretch", "copies", "one.*")
    sizes = stage(mixed.groupBy("anchor").agg(F.count("*").alias("different")), "group-sizes")
    mixed = mixed.join(sizes, "anchor")
    part = F.struct("id", "anchor", "stretch", "first", "last", "at", "copies", "different")
    wanted = mixed.groupBy(KEY).agg(F.collect_list(part).alias("parts"))
    fetched = stage(_fetched(rows, wanted, length), "fetched", compression="zstd")
    compared = _compared(fetched.where(F.col("different") <= GROUP), length, keep_first)
    dealt = _dealt(fetched.where(F.col("different") > GROUP), length, keep_first)
    spans = copied.unionByName(compared).unionByName(dealt)
    return spans.distinct().groupBy(KEY).agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def merged(spans: list, size: int) -> list[tuple[int, int]]:
    """Maximal runs."""
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, min(e, size)) for s, e in out]


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "first", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, removed (spans), kept (bytes), kept_sha256`` per row.

    What stays need not be whole characters, so it is returned as bytes.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ident, text, spans in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "spans")), strict=True):
                data = text.encode()
                gone = merged(spans or [], len(data))
                at, kept = 0, []
                for s, e in gone:
                    kept.append(data[at:s])
                    at = e
                left = b"".join([*kept, data[at:]])
                out.append((ident, len(data), len(data) - len(left), len(gone), [{"s": s, "e": e} for s, e in gone], left, hashlib.sha256(left).hexdigest()))
            if out:
                columns = list(zip(*out))
                kinds = [batch.schema.field("id").type, *[pa.int64()] * 3, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])), pa.binary(), pa.string()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    names = ["id", "n_bytes", "n_removed", "n_spans", "removed", "kept", "kept_sha256"]
    rows = docs.select(row_key(id_column, text_column).alias(KEY), F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    joined = rows.join(repeated_spans(docs, length, keep, id_column, text_column), KEY, "left").select("id", "text", "spans")
    schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, removed array<struct<s: bigint, e: bigint>>, kept binary, kept_sha256 string"
    return joined.mapInArrow(run, schema)
