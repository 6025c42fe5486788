"""Benchmark decontamination by templates: what is left of a passage when its numbers, names and units are slots.

Words are canonicalised: a number becomes ``<num>``, a unit right after a number ``<unit>``, a capitalised word inside a
sentence, or a run of them, ``<name>``; all else is lower case. Windows of five template words of the benchmark items are
hash-joined with those of the texts. Windows with a name have a second form with names as lower-case words, so that case and
line breaks don't matter in a copy. Windows along one diagonal (same offset between text and item) are a line if its slots
are consistent: each slot value of the item always stands for the same value of the text. Inserted or dropped words start a
new line; lines of neighbouring offsets whose slots agree are added up. An item is found in a text when at least
``MIN_COVER`` of its windows are, in the template form or over both forms.

Windows of texts are many and those of the benchmark few, so a bit field of fixed size (2 MB), filled from all benchmark
windows, drops windows of texts before anything is shuffled. It never drops a match, whatever the size of the benchmark.

Defined cases: null texts and null items are empty; items of fewer than five words can't be told from chance and match
nothing; rows that are repeated get the same result; an empty benchmark leaves all texts clean.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountweave.llm.common import KEY, ROW, bit_field, hits, keyed, row_key, stage, text_of

WINDOW = 5
MIN_COVER = 0.5
#: Units that count as such after a number.
UNITS = frozenset(
    """% $ € £ ° mm cm m km in inch inches ft foot feet yd mi mile miles mg g kg t oz lb lbs ton tons ml cl l litre litres liter liters
    s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years ms hz khz mhz ghz b kb mb gb tb
    w kw mw v kv a ma j kj cal kcal pa kpa n c f k dollar dollars cent cents euro euros pound pounds percent degree degrees meter meters
    metre metres gram grams kilogram kilograms kilometer kilometers kilometre kilometres""".split()
)
_WORD = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[%$€£°]|[.!?\n]")
_END = frozenset(".!?\n")


def _slots(text: str) -> tuple[list[str], list[str]]:
    """Template words with a slot per word, and the lower-case value of each slot (empty where the word is itself)."""
    words, slots, opens, number = [], {}, True, False
    for w in _WORD.findall(text):
        if w.islower() and w.isalpha():  # most words; as below, for lower-case ones that are no number and no name
            if number and w in UNITS:
                slots[len(words)] = w
                w = "<unit>"
            words.append(w)
            opens = number = False
            continue
        if w in _END:
            opens, number = True, False
            continue
        low = w.lower()
        if w[0].isdigit():
            slots[len(words)] = w
            words.append("<num>")
            number = True
        else:
            if number and low in UNITS:
                slots[len(words)] = low
                low = "<unit>"
            elif not opens and w[0].isupper() and not (len(w) > 1 and w.isupper()):
                slots[len(words)] = low
                low = "<name>"
            words.append(low)
            number = False
        opens = False
    values = [""] * len(words)
    for i, value in slots.items():
        values[i] = value
    return words, values


def _joined_names(words: list[str], values: list[str]) -> tuple[list[str], list[str], list[int]]:
    """A run of names as one slot; and where each word of the result stood."""
    out, own, starts = [], [], []
    for i, (w, v) in enumerate(zip(words, values, strict=True)):
        if w == "<name>" and starts and words[i - 1] == w:
            own[-1] += " " + v
        else:
            out.append(w)
            own.append(v)
            starts.append(i)
    return out, own, starts


def template(text: str) -> tuple[list[str], list[str]]:
    """Template words, and the value of each slot (empty where the word is itself)."""
    return _joined_names(*_slots(text))[:2]


def windows(words: list[str]) -> np.ndarray:
    """64-bit hashes of all runs of ``WINDOW`` template words."""
    if len(words) < WINDOW:
        return np.zeros(0, np.int64)
    known = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    own = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    h = own[: len(own) - WINDOW + 1].copy()
    for i in range(1, WINDOW):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + own[i : len(own) - WINDOW + 1 + i]
    h ^= h >> np.uint64(32)
    return (h * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


#: Kinds of windows: without a name, with a name slot, and the same with names as plain words.
_PLAIN, _NAMED, _LOWER = 0, 1, 2


def window_forms(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[str]], np.ndarray, int, int]:
    """Hash, position (in words) and kind of each window; values of both forms, and where to look in them; sizes of both."""
    words, values = _slots(text)
    if "<name>" not in words:
        h = windows(words)
        at = np.arange(len(h))
        return h, at, np.full(len(h), _PLAIN), [values, values], at, len(h), len(h)
    slots, own, starts = _joined_names(words, values)
    named = lambda ws, n: np.convolve([w == "<name>" for w in ws], np.ones(WINDOW, int))[WINDOW - 1 :][:n] > 0
    h = windows(slots)
    kind = np.where(named(slots, len(h)), _NAMED, _PLAIN) if len(h) else np.zeros(0, int)
    names = [w == "<name>" for w in words]
    plain = windows([v if n else w for w, v, n in zip(words, values, names, strict=True)])
    more = np.flatnonzero(named(words, len(plain))) if len(plain) else np.zeros(0, int)
    without = ["" if n else v for v, n in zip(values, names, strict=True)]
    return (
        np.r_[h, plain[more]], np.r_[np.array(starts, int)[: len(h)], more], np.r_[kind, np.full(len(more), _LOWER)],
        [own, without], np.r_[np.arange(len(h)), more], len(h), len(plain),
    )


_WINDOWS = "id binary, size int, plain int, h long, pos int, kind int, v0 string, v1 string, v2 string, v3 string, v4 string"


def _window_rows(rows: DataFrame, field=None) -> DataFrame:
    """A row per window (of those whose bit is set in ``field``) with its slot values; ``rows``: ``id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, plains, hs, at, kinds, slots = [], [], [], [], [], [], [[] for _ in range(WINDOW)]
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                h, pos, kind, values, where, size, plain = window_forms(text)
                own = np.arange(len(h)) if field is None else np.flatnonzero(hits(field.value, h))
                if len(own):
                    ids += [key] * len(own)
                    sizes += [size] * len(own)
                    plains += [plain] * len(own)
                    hs.append(h[own])
                    at.append(pos[own])
                    kinds.append(kind[own])
                    places = [(values[k == _LOWER], p) for k, p in zip(kind[own].tolist(), where[own].tolist(), strict=True)]
                    for i in range(WINDOW):
                        slots[i] += [v[p + i] for v, p in places]
            if ids:
                numbers = [pa.array(np.concatenate(x).astype(np.int32)) for x in (at, kinds)]
                yield pa.record_batch(
                    [pa.array(ids, pa.binary()), pa.array(sizes, pa.int32()), pa.array(plains, pa.int32()), pa.array(np.concatenate(hs)), *numbers, *map(pa.array, slots)],
                    names=[f.split()[0] for f in _WINDOWS.split(", ")],
                )

    return rows.mapInArrow(run, _WINDOWS)


def combined(lines: list[dict], size: int, plain: int, min_cover: float) -> tuple[float, bool] | None:
    """Best cover of an item over ``lines`` (``shift, hits, slots``), and whether all its slots are equal; or none.

    From each line on, those with a shift of at most half the item more or less are added, largest first, as long as all
    slots stay consistent. Windows of the item count once, in the template form and over both forms.
    """

    def cover(found: set) -> float:
        slotted = len({p for p, k in found if k != _LOWER}) / size if size else 0.0
        return max(slotted, len({p for p, _ in found}) / plain)

    own = [(x["shift"], {(h["pos"], h["kind"]) for h in x["hits"]}, {s["b"]: s["d"] for s in x["slots"]}) for x in lines]
    own.sort(key=lambda x: x[0])
    shifts = [x[0] for x in own]
    reach = (plain + WINDOW - 1) // 2
    best = None
    for shift, found, values in own:
        near = own[bisect_left(shifts, shift - reach) : bisect_right(shifts, shift + reach)]
        if cover(set().union(*(x[1] for x in near))) < max(min_cover, best[0] if best else 0.0):
            continue
        found, values = set(found), dict(values)
        for _, more, slots in sorted(near, key=lambda x: (-len(x[1]), abs(x[0] - shift), x[0])):
            if not more <= found and all(values.get(b, d) == d for b, d in slots.items()):
                found |= more
                values |= slots
        now = (cover(found), all(b == d for b, d in values.items()))
        if now[0] >= min_cover and (best is None or now > best):
            best = now
    return best


def _combined(pairs: DataFrame, min_cover: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, item, size, plain, lines in zip(*(batch.column(c).to_pylist() for c in (KEY, "item", "size", "plain", "lines")), strict=True):
                best = combined(lines, size, plain, min_cover)
                if best:
                    out.append((key, item, *best))
            if out:
                kinds = (pa.binary(), pa.string(), pa.float64(), pa.bool_())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)], names=[KEY, "item", "cover", "same"])

    return pairs.mapInArrow(run, f"{KEY} binary, item string, cover double, same boolean")


def matches(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_cover: float = MIN_COVER) -> DataFrame:
    """``KEY, item, cover, same``: items found in a row, the share of their windows, and whether all slots are equal.

    A window that is frequent in the texts and stands in few items is split by Spark's skew handling (plain join of
    two shuffled sides). Rows per text and item are at most the windows of the text that match it.
    """
    spark = docs.sparkSession
    of_items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).cast("binary").alias("id"), text_of().alias("text"))
    items = stage(_window_rows(of_items.distinct()), "item-windows")
    field = spark.sparkContext.broadcast(bit_field(items.select("h")))
    slots = [f"v{i}" for i in range(WINDOW)]
    own = _window_rows(docs.select(row_key(id_column, text_column).alias("id"), text_of(text_column).alias("text")), field)
    own = own.select(F.col("id").alias(KEY), "h", F.col("pos").alias("at"), *(F.col(v).alias(f"d{v}") for v in slots))
    met = own.join(items, "h").select(
        KEY, F.col("id").alias("item"), "size", "plain", (F.col("at") - F.col("pos")).alias("shift"), "pos", "kind",
        F.filter(F.array(*(F.struct(F.col(v).alias("b"), F.col(f"d{v}").alias("d")) for v in slots)), lambda s: s["b"] != "").alias("slots"),
    )
    # Copies of a row give equal matches. Windows with name slots are a line of their own, so names that don't fit leave the rest.
    named = (F.col("kind") == _NAMED).alias("named")
    line = met.groupBy(KEY, "item", "size", "plain", "shift", named).agg(F.collect_set(F.struct("pos", "kind")).alias("hits"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    line = line.where(F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda s: s["b"]))))
    pairs = line.groupBy(KEY, F.col("item").cast("string").alias("item"), "size", "plain").agg(F.collect_list(F.struct("shift", "hits", "slots")).alias("lines"))
    # Windows found anywhere in the text bound what can be found together.
    most = F.size(F.array_distinct(F.flatten(F.transform("lines", lambda x: F.transform(x["hits"], lambda h: h["pos"])))))
    least = F.when(F.col("size") > 0, F.least("size", "plain")).otherwise(F.col("plain")) * F.lit(min_cover)
    found = _combined(pairs.where(most >= least), min_cover)
    return found.groupBy(KEY, "item").agg(F.max("cover").alias("cover"), F.max("same").alias("same"))


def flag(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each row as one struct with ``n_items`` (found in it), ``cover`` (the largest) and ``items`` (ids, sorted)."""
    found = matches(docs, benchmark, id_column, text_column)
    per_row = found.groupBy(KEY).agg(F.count("*").alias("n_items"), F.max("cover").alias("cover"), F.sort_array(F.collect_set("item")).alias("items"))
    return keyed(docs, id_column, text_column).join(per_row, KEY, "left").select(
        ROW, F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("cover", F.lit(0.0)).alias("cover"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""
    found = matches(docs, benchmark, id_column, text_column).select(KEY).distinct()
    return keyed(docs, id_column, text_column).join(found, KEY, "left_anti").select(f"{ROW}.*")
