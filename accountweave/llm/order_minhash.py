"""Near-duplicate groups by order min-hash, verified by banded alignment.

A text is a sequence of five-word shingles. A shingle that occurs several times is labelled with its occurrence number,
so each labelled shingle is unique in its text. One sketch takes the ``ELL`` labelled shingles with the least hashes and
keeps them in text order, so it agrees only where both content and order do; that makes it sensitive to edit similarity,
not to set overlap alone. ``SKETCHES`` sketches are joined ``ROWS`` by ``ROWS`` to bucket keys.

Similarity of two texts is 1 - (edit distance of their shingle sequences) / (the longer length), computed exactly by a
banded alignment whose band doubles until it holds the distance or passes what the threshold allows. A pair at the
threshold shares a bucket with a chance of 0.999, pairs above it more.

Equal texts are one class from the start: the class has one representative, so a group of copies of any size is one row.
In a bucket each representative is to be compared with the first one, in an order of which there are ``CENTRES``; that is linear
in the rows, settles buckets of two and joins most groups. Each is first compared with the one that it meets in most buckets; of
the other pairs those that are not in one component by then.

The rows of larger buckets that then still hold several components are settled exactly. A pair at the threshold shares most
labelled shingles, so it shares one of the rarest: as many as it may differ in, and one more. Each row is listed by those with
their places, rarest first. Rows of different components that meet in one are a candidate pair, and before texts are fetched it
must pass bounds that no pair at the threshold fails: the lengths, the number of shingles that can still be shared given the
places of those that are, and the parities of hashed shingles, which differ in no more slots than there are shingles in only one
of the two. What is not compared can't reach the threshold, whatever the size of the bucket.

Defined cases: null texts are empty; texts of fewer than five words have one shingle, all their words; texts
without any word are copies of each other only if they are equal; rows with equal id and text are copies.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountweave.llm.common import KEY, ROW, keyed, maybe_in, row_key, stage, text_of
from accountweave.llm.components import components, joined
from accountweave.operators.joins import lookup_join

SHINGLE, THRESHOLD = 5, 0.8
ELL, ROWS, BANDS = 2, 2, 32
#: Orders that set the first row of a bucket.
CENTRES = 4
#: Pairs of one text above which its row is repeated, so that they are dealt over several tasks.
HOT_PAIRS = 20_000
#: Slots, as a power of two, by which shingles are counted to tell rare ones: 4 MB, whatever the number of texts.
SLOT_BITS = 20
#: Slots whose parity is kept for each text, as a power of two: 128 bytes.
PARITY_BITS = 10
_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


_known: dict[str, int] = {}


def word_ids(text: str) -> np.ndarray:
    """64-bit hashes of the lower-case words; a worker remembers those of frequent words."""
    words = _WORD.findall(text.lower())
    if len(_known) > 300_000:
        _known.clear()
    out = [*map(_known.get, words)]
    if None in out:
        for i, h in enumerate(out):
            if h is None:
                w = words[i]
                h = _known.get(w)
                out[i] = _known.setdefault(w, xxhash.xxh3_64_intdigest(w)) if h is None else h
    return np.array(out, np.uint64)


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of all words, if they are fewer."""
    size = max(1, min(size, len(words)))
    n = max(1, len(words) - size + 1)
    h = words[:n].copy() if len(words) else np.zeros(1, np.uint64)
    for i in range(1, size):
        h = (h ^ (h >> np.uint64(31))) * _MIX + words[i : i + n]
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def occurrences(h: np.ndarray) -> np.ndarray:
    """How often the same shingle came before, for each shingle."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    starts = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    count = np.arange(len(s)) - np.repeat(starts, np.diff(np.r_[starts, len(s)]))
    out = np.empty(len(s), np.uint64)
    out[order] = count
    return out


def labelled(h: np.ndarray) -> np.ndarray:
    x = h + occurrences(h) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) * _MIX


@cache
def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    own = np.random.default_rng(29).integers(1, 1 << 63, n, np.uint64) | np.uint64(1)
    return (own >> np.uint64(32)).astype(np.uint32)[:, None], own.astype(np.uint32)[:, None]


def buckets(text: str, bands: int = BANDS, rows: int = ROWS, ell: int = ELL) -> np.ndarray:
    """One 64-bit key per band. All sketches of a text are drawn at once, piece by piece for a long one."""
    x = labelled(shingles(word_ids(text)))
    high, low = (x >> np.uint64(32)).astype(np.uint32), x.astype(np.uint32)
    turn, factor = _seeds(bands * rows)
    every = np.arange(bands * rows)
    best = []
    for at in range(0, len(x), 1 << 13):
        # A 32-bit hash per sketch of both halves of a labelled shingle; equal values go by text order.
        v = high[at : at + (1 << 13)] ^ turn
        v *= factor
        v ^= v >> np.uint32(15)
        v ^= low[at : at + (1 << 13)]
        v *= np.uint32(0x85EBCA6B)
        for _ in range(min(ell, v.shape[1])):
            least = v.argmin(1)
            best.append((v[every, least].copy(), least + at))
            v[every, least] = 0xFFFFFFFF
    values, where = np.stack([b[0] for b in best], 1), np.stack([b[1] for b in best], 1)
    chosen = np.take_along_axis(where, np.argsort(values, axis=1, kind="stable")[:, :ell], 1)
    chosen.sort(axis=1)
    sketches = (every // rows + 1).astype(np.uint64)
    for i in range(chosen.shape[1]):
        sketches = (sketches ^ (sketches >> np.uint64(30))) * np.uint64(0x100000001B3) + x[chosen[:, i]]
    keys = np.zeros(bands, np.uint64)
    for r in range(rows):
        keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB) + sketches[r::rows]
    return keys


def distances_within(pairs: list[tuple[np.ndarray, np.ndarray]], most: np.ndarray) -> np.ndarray:
    """Whether the edit distance of each pair is at most ``most``; many pairs are aligned at once.

    Each pair is aligned within a band of diagonals around the main one. A distance that the band's half width holds is
    exact, so the band starts narrow and doubles for the pairs that need it.
    """
    out = np.zeros(len(pairs), bool)
    todo = np.arange(len(pairs))
    half = 8
    while len(todo):
        again = []
        todo = todo[np.argsort([len(pairs[i][0]) for i in todo], kind="stable")]
        sizes = np.array([len(pairs[i][0]) for i in todo])
        at = 0
        while at < len(todo):
            # Pairs of like length together, as many as fit in a few MB.
            step = max(1, min(512, 1_000_000 // (2 * half + 1)))
            part = todo[at : at + min(step, max(1, int(np.searchsorted(sizes[at:], sizes[at] * 1.25 + 16, side="right"))))]
            at += len(part)
            d = _banded([pairs[i] for i in part], half)
            out[part] = d <= np.minimum(most[part], half)
            again += [i for i, x in zip(part, d, strict=True) if x > half and most[i] > half]
        todo = np.array(again, int)
        half *= 2
    return out


def _banded(pairs: list[tuple[np.ndarray, np.ndarray]], half: int) -> np.ndarray:
    """Edit distances along ``2 * half + 1`` diagonals; over ``half`` means over ``half``."""
    n = np.array([len(a) for a, _ in pairs])
    m = np.array([len(b) for _, b in pairs])
    width, rows = 2 * half + 1, int(n.max())
    far = np.int32(1 << 28)
    a = np.zeros((len(pairs), rows), np.int64)
    # Column j of b stands at j + half, so that row i sees b[i - half .. i + half] as one slice.
    b = np.full((len(pairs), rows + 2 * half + 1), -1, np.int64)
    for k, (x, y) in enumerate(pairs):
        a[k, : len(x)] = x
        y = y[: rows + half + 1]
        b[k, half : half + len(y)] = y
    offset = np.arange(width, dtype=np.int32)
    j = offset - half
    row = np.where(j >= 0, j, far).astype(np.int32)[None].repeat(len(pairs), 0)
    result = np.full(len(pairs), far, np.int32)

    def finish(i: int) -> None:
        done = np.flatnonzero((n == i) & (np.abs(m - n) <= half))
        result[done] = row[done, (m - n)[done] + half]

    finish(0)
    for i in range(1, rows + 1):
        step = row + (a[:, i - 1 : i] != b[:, i - 1 : i - 1 + width])
        np.minimum(step[:, :-1], row[:, 1:] + 1, out=step[:, :-1])
        step[:, j + i < 0] = far
        if i <= half:
            step[:, half - i] = i
        row = np.minimum.accumulate(step - offset, axis=1) + offset
        finish(i)
    return result


def chain(at: list[int]) -> list[int]:
    """Indices of a longest increasing run of ``at``, in order."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(at)
    for i, v in enumerate(at):
        k = bisect_left(tails, v)
        if k:
            before[i] = ends[k - 1]
        if k == len(tails):
            tails.append(v)
            ends.append(i)
        else:
            tails[k] = v
            ends[k] = i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def bounds(lx: np.ndarray, ly: np.ndarray, most: int) -> tuple[int, int]:
    """Least and greatest possible edit distance of two sequences of labelled shingles; the first alone if over ``most``.

    Equal labelled shingles that stand in the same order align; between two of them the longer gap is an upper bound.
    Labels are unique, so the chain is a longest one, and where no shingle repeats no alignment matches more.
    """
    longer = max(len(lx), len(ly))
    _, ix, iy = np.intersect1d(lx, ly, assume_unique=True, return_indices=True)
    if longer - len(ix) > most:
        return longer - len(ix), longer
    order = np.argsort(ix)
    ix, iy = ix[order], iy[order]
    kept = chain(iy.tolist())
    gx = np.diff(np.r_[-1, ix[kept], len(lx)]) - 1
    gy = np.diff(np.r_[-1, iy[kept], len(ly)]) - 1
    return longer - len(kept), int(np.maximum(gx, gy).sum())


def verify(a: list[str], b: list[str], threshold: float = THRESHOLD) -> np.ndarray:
    """Whether each pair of texts is at least ``threshold`` similar; aligned where bounds leave it open."""
    cache: dict[str, tuple[np.ndarray, np.ndarray, bool]] = {}

    def of(text: str) -> tuple[np.ndarray, np.ndarray, bool]:
        if text not in cache:
            s = shingles(word_ids(text))
            cache[text] = s.view(np.int64), labelled(s), len(np.unique(s)) == len(s)
        return cache[text]

    same, rest, allowed, where = np.zeros(len(a), bool), [], [], []
    for i, (s, t) in enumerate(zip(a, b, strict=True)):
        (x, lx, once), (y, ly, once_too) = of(s), of(t)
        longer = max(len(x), len(y))
        most = int(longer * (1 - threshold) + 1e-9)
        if abs(len(x) - len(y)) > most:
            continue
        low, high = bounds(lx, ly, most)
        if high <= most:
            same[i] = True
        elif low <= most or not (once and once_too) and longer - len(np.intersect1d(lx, ly, assume_unique=True)) <= most:
            rest.append((x, y))
            allowed.append(most)
            where.append(i)
    if rest:
        same[where] = distances_within(rest, np.array(allowed))
    return same


def _keys(rows: DataFrame, bands: int) -> DataFrame:
    """``cls, bucket`` for each band of each distinct text; copies within a batch are hashed once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = dict(zip(batch.column("cls").to_pylist(), batch.column("text").to_pylist(), strict=True))
            # A text without words is like no other text.
            keys = {c: buckets(t, bands) for c, t in own.items() if _WORD.search(t)}
            if keys:
                ids = pa.array(list(keys), pa.binary()).take(pa.array(np.repeat(np.arange(len(keys)), bands)))
                yield pa.record_batch([ids, pa.array(np.concatenate(list(keys.values())).view(np.int64))], names=["cls", "bucket"])

    return rows.select("cls", "text").mapInArrow(run, "cls binary, bucket long").distinct()


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The ``pairs`` (``a, b``) that are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                good = verify(part.column("ta").to_pylist(), part.column("tb").to_pylist(), threshold)
                yield pa.record_batch([part.column(c).filter(pa.array(good)) for c in ("a", "b")], names=["a", "b"])

    # Most texts have no pair in later rounds; they are dropped before any text moves.
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cls"))
    texts = texts.where(maybe_in(ends.select(F.xxhash64("cls")).distinct())(F.xxhash64("cls")))
    # The first row of many buckets has very many pairs; it is repeated, and its pairs are dealt over the repeats.
    for end, other in ("a", "b"), ("b", "a"):
        text = texts.select(F.col("cls").alias(end), F.col("text").alias(f"t{end}"))
        counts = pairs.groupBy(end).agg(F.count("*").alias("_n"))
        pairs = lookup_join(pairs, text, end, [other], counts=counts, hot_rows=HOT_PAIRS)
    return pairs.select("a", "b", "ta", "tb").mapInArrow(run, "a binary, b binary")


def classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``KEY, own, cls``: of each row its key, its id and its class, which is named by the digest of one of its texts."""
    text = text_of(text_column)
    digest = F.unhex(F.md5(text.cast("binary")))
    rows = docs.select(row_key(id_column, text_column).alias(KEY), F.col(id_column).alias("own"), digest.alias("cls"), text.alias("text"))
    copies = stage(rows.select(KEY, "own", "cls"), "copies")
    keys = stage(_keys(rows, bands), "buckets")
    counts = stage(keys.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "bucket-sizes")
    shared = stage(keys.join(counts, "bucket"), "shared-buckets")
    heads = copies.groupBy("cls").agg(F.min(KEY).alias(KEY))
    heads = stage(heads.join(shared.select("cls").distinct(), "cls", "left_semi"), "heads")
    # Texts that share no bucket don't move. A class has one key here, and a key one class.
    some = rows.select(KEY, "text").where(maybe_in(heads.select(F.xxhash64(KEY)))(F.xxhash64(KEY)))
    texts = stage(some.join(heads, KEY).dropDuplicates([KEY]).select("cls", "text"), "candidates", compression="zstd")
    star = stage(_star(shared), "star")
    best = stage(_best(star), "pairs")
    found = stage(components(stage(_verified(best, texts, threshold), "links")), "components")
    others = stage(_apart(_pairs(star).join(best, ["a", "b"], "left_anti"), found), "pairs")
    if not others.isEmpty():
        found = stage(joined(found, stage(_verified(others, texts, threshold), "links")), "components")
    left = stage(_unsettled(shared.where("n > 2"), found), "left")
    if not left.isEmpty():
        fresh = stage(_verified(stage(_rest(left, texts, threshold), "rest"), texts, threshold), "links")
        found = stage(joined(found, fresh), "components")
    named = copies.join(found.select(F.col("node").alias("cls"), "component"), "cls", "left")
    return named.select(KEY, "own", F.coalesce("component", "cls").alias("cls"))


def _star(shared: DataFrame) -> DataFrame:
    """``cls, first, n``: each row with the first ones of its buckets, in ``CENTRES`` orders, and in how many they meet."""
    order = F.xxhash64("cls", F.pmod("bucket", F.lit(CENTRES)))
    first = stage(shared.groupBy("bucket").agg(F.min_by("cls", order).alias("first")), "first-rows")
    return shared.join(first, "bucket").where("cls != first").groupBy("cls", "first").agg(F.count("*").alias("n"))


def _pairs(star: DataFrame) -> DataFrame:
    return star.select(F.least("first", "cls").alias("a"), F.greatest("first", "cls").alias("b")).distinct()


def _best(star: DataFrame) -> DataFrame:
    """Each row with the first one that it meets in most buckets."""
    return _pairs(star.groupBy("cls").agg(F.max_by("first", F.struct("n", "first")).alias("first")))


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The ``pairs`` whose ends are in different components of ``found``."""
    for end, name in ("a", "x"), ("b", "y"):
        pairs = pairs.join(found.select(F.col("node").alias(end), F.col("component").alias(name)), end, "left")
    return pairs.where(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b")


def _unsettled(shared: DataFrame, found: DataFrame) -> DataFrame:
    """``cls, component`` of the rows of all buckets that hold several components."""
    named = shared.select("cls", "bucket").join(found.select(F.col("node").alias("cls"), "component"), "cls", "left")
    named = stage(named.withColumn("component", F.coalesce("component", "cls")), "named")
    mixed = named.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    return named.join(stage(mixed.select("bucket"), "mixed-buckets"), "bucket").select("cls", "component").distinct()


def _slots(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def rarest(x: np.ndarray, counts: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the labelled shingles ``x`` of a text those of which any text at the threshold has one, and their places.

    A partner shares all but ``most`` at least. With all shingles in one order (rare slots first), two such texts share one
    of their first ``most + 1`` each. A slot that was filled once holds no shared shingle.
    """
    most = int(len(x) * (1 - threshold) + 1e-9)
    n = counts[_slots(x)]
    first = np.lexsort((x, n))[: most + 1]
    places = np.flatnonzero(n[first] > 1)
    return x[first[places]], places


def parities(x: np.ndarray) -> np.ndarray:
    """For each slot whether an odd number of the labelled shingles ``x`` is in it, as bits of 64-bit integers."""
    slots = (x >> np.uint64(64 - SLOT_BITS - PARITY_BITS)) & np.uint64((1 << PARITY_BITS) - 1)
    return np.packbits(np.bincount(slots.astype(np.int64), minlength=1 << PARITY_BITS) & 1).view(np.int64)


def _rest(left: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: all pairs of rows of ``left`` (``cls, component``) in different components that may reach the threshold."""
    rows = texts.join(left, "cls").select("cls", "component", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                np.add.at(total, _slots(labelled(shingles(word_ids(text)))), 1)
        some = np.flatnonzero(total)
        for at in range(0, len(some), 1 << 16):
            part = some[at : at + (1 << 16)]
            yield pa.record_batch([pa.array(part), pa.array(total[part])], names=["slot", "n"])

    # At most a number per slot reaches the driver, as columns and not as row objects.
    per_slot = rows.select("text").mapInArrow(count, "slot long, n long").groupBy("slot")
    counted = per_slot.agg(F.least(F.sum("n"), F.lit(2147483647)).cast("int").alias("n")).toArrow()
    counts = np.zeros(1 << SLOT_BITS, np.int32)
    counts[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(counts)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [labelled(shingles(word_ids(t))) for t in batch.column("text").to_pylist()]
            rare = [rarest(x, shared.value, threshold) for x in own]
            if own:
                at = pa.array(np.repeat(np.arange(len(own)), [len(r) for r, _ in rare]))
                sizes = pa.array([len(x) for x in own], pa.int32())
                columns = [c.take(at) for c in (batch.column("cls"), batch.column("component"), sizes)]
                columns.append(pa.array(np.concatenate([p for _, p in rare]).astype(np.int32)))
                columns.append(pa.array(np.concatenate([r for r, _ in rare]).view(np.int64)))
                columns.append(pa.array([parities(x) for x in own], pa.list_(pa.int64())).take(at))
                yield pa.record_batch(columns, names=["cls", "component", "size", "place", "token", "parity"])

    schema = "cls binary, component binary, size int, place int, token long, parity array<long>"
    tokens = stage(rows.mapInArrow(listed, schema), "rare-shingles", compression="zstd")
    per = tokens.groupBy("token", "component").agg(F.count("*").alias("n"))
    mixed = per.groupBy("token").agg(F.count("*").alias("several"), F.max_by("component", "n").alias("main")).where("several > 1")
    met = stage(tokens.join(mixed.select("token", "main"), "token"), "met-shingles", compression="zstd")
    # One of a pair is outside the largest component of a shingle, so that one is never paired with itself.
    own = F.struct("cls", "size", "place")
    other = met.where("component != main").select("token", own.alias("p"), F.col("component").alias("x"), F.col("parity").alias("p_parity"))
    in_main = (F.col("component") == F.col("main")).alias("in_main")
    every = met.select("token", own.alias("q"), F.col("component").alias("y"), in_main, F.col("parity").alias("q_parity"))
    once = F.col("in_main") | (F.col("p.cls") < F.col("q.cls"))
    bound = _may_share(1 + F.least("p.place", "q.place"), F.col("p"), F.col("q"), threshold)
    two = other.join(every, (other["token"] == every["token"]) & (F.col("x") != F.col("y")) & once & bound)
    two = two.where(_near(F.col("p.size"), F.col("q.size"), threshold)).select(F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q"))
    size = [F.col(f"{e}.size").alias(f"{e}_size") for e in "pq"]
    two = two.groupBy(F.col("p.cls").alias("a"), F.col("q.cls").alias("b"), *size).agg(
        F.count("*").alias("n"), F.max("p.place").alias("p_place"), F.max("q.place").alias("q_place")
    )
    ends = [F.struct(F.col(f"{e}_size").alias("size"), F.col(f"{e}_place").alias("place")) for e in "pq"]
    two = two.select("a", "b", "n", ends[0].alias("p"), ends[1].alias("q"))
    return two.where(_may_share(F.col("n"), F.col("p"), F.col("q"), threshold)).select("a", "b")


def _may_share(known: Column, p: Column, q: Column, threshold: float) -> Column:
    """Whether two texts can share enough labelled shingles, if ``known`` at most are shared up to their ``place``.

    Both are listed in one order of all shingles, so what they share beyond a shared shingle stands behind it in both.
    """
    need = _need(p["size"], q["size"], threshold)
    return known + F.least(p["size"] - p["place"], q["size"] - q["place"]) - 1 >= need


def _need(p_size: Column, q_size: Column, threshold: float) -> Column:
    """How many labelled shingles two texts at the threshold share at least."""
    longer = F.greatest(p_size, q_size)
    return longer - F.floor(longer * F.lit(1 - threshold) + F.lit(1e-9))


def _near(p_size: Column, q_size: Column, threshold: float) -> Column:
    """Whether the parities of two texts differ in no more slots than they may have shingles that the other lacks.

    A shared shingle turns the same slot of both, and any other at most one slot of one.
    """
    differ = F.zip_with("p_parity", "q_parity", lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    apart = F.aggregate(differ, F.lit(0), lambda n, d: n + d)
    return apart <= p_size + q_size - 2 * _need(p_size, q_size, threshold)


def groups(docs: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``own, class_id, class_size``: the class of each row is the smallest id of its rows."""
    found = stage(classes(docs, threshold, id_column=id_column, text_column=text_column), "classes")
    named = found.groupBy("cls").agg(F.min("own").alias("class_id"), F.count("*").alias("class_size"))
    return found.join(stage(named, "class-names"), "cls").select("own", "class_id", "class_size")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the smallest id, nulls last; of rows that are equal in id and text, one."""
    found = classes(docs, threshold, id_column=id_column, text_column=text_column)
    order = F.struct(F.col("own").isNull().alias("no_id"), F.col("own"), F.col(KEY))
    stay = found.groupBy("cls").agg(F.min(order).alias("first")).select(F.col(f"first.{KEY}").alias(KEY))
    return keyed(docs, id_column, text_column).join(stay, KEY, "left_semi").dropDuplicates([KEY]).select(f"{ROW}.*")
