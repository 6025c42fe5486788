"""The trie of conversation prefixes: which conversations start alike, for how many turns, and what that saves.

A node is a distinct sequence of first turns; its members are the conversations that start with it. A node is named by
its smallest member and its depth. The root has depth 0 and all conversations as members, also those without turns.

1. ``paths``: turns are dealt by range of (conversation, order), and every prefix gets a 127-bit digest, a polynomial
   over the hashes of its turns. Such digests can be continued: a conversation that lies in several parts is digested
   part by part, and what a part needs of those before it is one row. So no task has to hold a conversation.
2. ``screened``: a count-min sketch over all prefix digests. Its cells hold counts up to two and are merged in blocks,
   so its size has a bound. An estimate of one proves that a prefix has one member. Such nodes need no shuffle: all about
   them is known from the conversation. Only prefixes that may be shared are grouped; an estimate that is too
   high sends a row there that it need not, and nothing else.
3. Grouping, twice, with partial sums: first members, smallest member and whether any goes on. From that a conversation
   knows from which depth on it is the smallest member (it owns those nodes). Then everything about a subtree is a sum over
   the members of its top: each adds the bytes of its turns from there on, takes off those of the nodes that it owns (each
   node of the subtree has one owner), and adds the child and the leaf that it owns. No pass over levels is needed.
4. Look-ups whose key may be hot (the parent of very many nodes, a very long conversation) take the hot keys, at most
   ``HOT_KEYS`` by their share, from a broadcast, and join the others.

The lists of conversations that end at a node are hashed as a stream, from pieces that are made in parts of a global
order; a list of any length takes the memory of a piece.

Defined cases: null roles and texts are empty; rows without a conversation id take no part; equal places in a
conversation are put in an order by the hash of role and text; repeated rows are turns of their own; an empty table has no
nodes. Other columns, whatever their names, are left alone. Conversation ids are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountweave.llm.common import stage

#: Digests are values at this point of the polynomial over the hashes of turns, modulo this prime.
PRIME, POINT = (1 << 127) - 1, 0x5DEECE66D1CE4E5B9BF58476D1CE4E5
#: Rows of the sketch; cells per prefix that are aimed at; least and greatest width, as powers of two. The greatest
#: takes 16 MB as bits.
SKETCH_ROWS, CELLS, WIDTHS = 2, 8, (10, 26)
#: Cells of a block of the sketch, as a power of two.
BLOCK = 16
#: A key with more than this part of all rows is hot; so there are fewer hot keys than this.
HOT_KEYS = 1000
#: Bytes of a piece of a list of ids.
PIECE = 1 << 16
_MIX = np.array([[0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], [0xD6E8FEB86659FD93, 0xA0761D6478BD642F]], np.uint64)
_PATHS = pa.schema(
    [("part", pa.int32()), ("conv", pa.int64()), ("depth", pa.int64()), ("before", pa.int64()), ("n_bytes", pa.int64())]
    + [("x", pa.binary())]
    + [(c, pa.int64()) for c in ("k1", "k2", "q1", "q2")]
    + [("last", pa.bool_())]
)
_PATHS_DDL = "part int, conv long, depth long, before long, n_bytes long, x binary, k1 long, k2 long, q1 long, q2 long, last boolean"


def turn_hashes(turns: DataFrame, conv: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, place, x, n_bytes``: a hash of role and text, and the bytes of the text."""
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    both = F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_)
    x = F.unhex(F.substring(F.sha2(both.cast("binary"), 256), 1, 32)).alias("x")
    kept = turns.where(F.col(conv).isNotNull())
    return kept.select(F.col(conv).cast("long").alias("conv"), F.col(order).alias("place"), x, F.octet_length(text_).cast("long").alias("n_bytes"))


def _halves(value: int) -> tuple[int, int]:
    low = value & (1 << 64) - 1
    return value >> 64, low - (1 << 64) if low >> 63 else low


def _whole(high: int, low: int) -> int:
    return high << 64 | low & (1 << 64) - 1


def paths(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """A row per prefix of every conversation, the empty one too.

    ``conv, depth, before`` (bytes of the texts before the last turn), ``n_bytes`` and ``x`` of the last turn,
    ``k1, k2`` (digest), ``q1, q2`` (that of the prefix before), ``ends`` (the whole conversation). ``ids`` (``conv``)
    names the conversations, where some have no turns.
    """
    ids = turns.select("conv").distinct() if ids is None else ids
    roots = ids.select("conv", F.lit(0).alias("inner"), F.lit(b"").alias("x"), F.lit(0).cast("long").alias("n_bytes"))
    rows = turns.withColumn("inner", F.lit(1)).unionByName(roots, allowMissingColumns=True)
    order = ["conv", "inner", "place", "x", "n_bytes"]
    dealt = stage(rows.select(*order), "turns").repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, conv = None, None
        digest = depth = total = 0
        for batch in batches:
            out = []
            for part, c, x, n in zip(*(batch.column(name).to_pylist() for name in ("part", "conv", "x", "n_bytes")), strict=True):
                if held:
                    held[-1] = c != conv
                    out.append(held)
                if c != conv:
                    conv, digest, depth, total, before = c, 1, -1, 0, (None, None)
                else:
                    before = held[6], held[7]
                digest, depth = (digest * POINT + int.from_bytes(x, "big")) % PRIME, depth + 1
                held = [part, c, depth, total, n, x, *_halves(digest), *before, False]
                total += n
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PATHS, strict=True)], schema=_PATHS)
        if held:
            held[-1] = True
            yield pa.record_batch([pa.array([c], f.type) for c, f in zip(held, _PATHS, strict=True)], schema=_PATHS)

    numbered = dealt.withColumn("part", F.spark_partition_id()).select("part", "conv", "x", "n_bytes")
    return _continued(stage(numbered.mapInArrow(run, _PATHS_DDL), "paths"))


def _continued(parts: DataFrame) -> DataFrame:
    """Paths of conversations that lie in several parts, put together. One row per part passes the driver."""
    state = F.max(F.struct("conv", "depth", (F.col("before") + F.col("n_bytes")).alias("total"), "k1", "k2")).alias("end")
    ends = sorted(parts.groupBy("part").agg(F.min("conv").alias("first"), state).collect(), key=lambda r: r.part)
    carried: dict[int, tuple[int, int, int, int]] = {}  # part: conversation, depth, bytes, digest at the end of the part before
    open_at: dict[int, int] = {}  # part: conversation that the next one goes on with
    now, at = None, None
    for r in ends:
        own = (r.end.conv, r.end.depth, r.end.total, _whole(r.end.k1, r.end.k2))
        if now and now[0] == r.first:
            carried[r.part], open_at[at] = now, r.first
            if own[0] == r.first:
                digest = ((now[3] - 1) * pow(POINT, own[1] + 1, PRIME) + own[3]) % PRIME
                own = (own[0], now[1] + 1 + own[1], now[2] + own[2], digest)
        now, at = own, r.part
    if not carried:
        return parts.withColumnRenamed("last", "ends").drop("part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part, conv, depth, before, n, x, k1, k2, q1, q2, last = row
                if part in carried and carried[part][0] == conv:
                    _, deeper, more, digest = carried[part]
                    step = pow(POINT, depth, PRIME)
                    q1, q2 = _halves(((digest - 1) * step + _whole(q1, q2)) % PRIME) if depth else _halves(digest)
                    k1, k2 = _halves(((digest - 1) * step * POINT + _whole(k1, k2)) % PRIME)
                    depth, before = depth + deeper + 1, before + more
                rows.append((part, conv, depth, before, n, x, k1, k2, q1, q2, last and open_at.get(part) != conv))
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PATHS, strict=True)], schema=_PATHS)

    spanning = parts.where(F.col("part").isin(list({*carried, *open_at})) & F.col("conv").isin([c[0] for c in carried.values()]))
    others = parts.where(~(F.col("part").isin(list({*carried, *open_at})) & F.col("conv").isin([c[0] for c in carried.values()])))
    return spanning.mapInArrow(run, _PATHS_DDL).unionByName(others).withColumnRenamed("last", "ends").drop("part")


def _cells(high: np.ndarray, low: np.ndarray, bits: int) -> np.ndarray:
    """A cell per row of the sketch and digest; the rows of the sketch lie one after the other."""
    high, low = high.view(np.uint64), low.view(np.uint64)
    rows = [((high * a ^ low * b) * _MIX[0, 0]) >> np.uint64(64 - bits) for a, b in _MIX]
    return np.stack([r + np.uint64(i << bits) for i, r in enumerate(rows)])


def sketch(keys: DataFrame, bits: int) -> bytes:
    """For each cell of a sketch of ``1 << bits`` cells a row, a bit that says if it counts two or more of ``k1, k2``."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, n = np.unique(_cells(batch.column("k1").to_numpy(), batch.column("k2").to_numpy(), bits), return_counts=True)
            blocks, starts = np.unique(found >> np.uint64(BLOCK), return_index=True)
            places, more = (found & np.uint64((1 << BLOCK) - 1)).astype(np.uint16), n > 1
            split = [(p[~m].tobytes(), p[m].tobytes()) for p, m in zip(np.split(places, starts[1:]), np.split(more, starts[1:]), strict=True)]
            if len(blocks):
                columns = [pa.array(blocks.astype(np.int64))] + [pa.array([s[i] for s in split], pa.binary()) for i in (0, 1)]
                yield pa.record_batch(columns, names=["block", "once", "more"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, once, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                count = counts.setdefault(block, np.zeros(1 << BLOCK, np.uint8))
                at = np.frombuffer(once, np.uint16)
                count[at] = np.minimum(count[at] + 1, 2)
                count[np.frombuffer(more, np.uint16)] = 2
        for block, count in counts.items():
            packed = np.packbits(count > 1, bitorder="little").tobytes()
            yield pa.record_batch([pa.array([block], pa.int64()), pa.array([packed], pa.binary())], names=["block", "bits"])

    made = keys.select("k1", "k2").mapInArrow(cells, "block long, once binary, more binary")
    out = np.zeros(max(SKETCH_ROWS << bits >> 3, 1 << BLOCK - 3), np.uint8)
    size = 1 << BLOCK - 3
    for r in made.repartition("block").mapInArrow(merged, "block long, bits binary").collect():
        out[r.block * size : (r.block + 1) * size] = np.frombuffer(r.bits, np.uint8)
    return out.tobytes()


def maybe_shared(field: bytes, bits: int, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """False where the sketch proves that a digest occurs once."""
    cells = _cells(high, low, bits)
    set_ = np.frombuffer(field, np.uint8)[cells >> np.uint64(3)] >> (cells & np.uint64(7)).astype(np.uint8) & 1
    return set_.all(axis=0)


def screened(rows: DataFrame) -> DataFrame:
    """``rows`` (of ``paths``) with ``shared`` and ``from_shared``: whether the prefix, and the one before, may have several members."""
    rows = rows.drop("x")
    bits = min(max((rows.count() * CELLS - 1).bit_length(), WIDTHS[0]), WIDTHS[1])
    field = rows.sparkSession.sparkContext.broadcast(sketch(rows, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [[batch.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in names] for names in (("k1", "k2"), ("q1", "q2"))]
            own, before = (maybe_shared(field.value, bits, *p) for p in pairs)
            before &= batch.column("q1").is_valid().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own), pa.array(before)], names=[*batch.schema.names, "shared", "from_shared"])

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return stage(rows.mapInArrow(run, f"{ddl}, shared boolean, from_shared boolean"), "screened")


def attach(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of ``rows`` to ``table``, which has a row per key. Keys with a large share of the rows are broadcast."""
    keys = list(keys)
    counts = rows.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n"))
    hot = counts.where(F.col("n") * HOT_KEYS > max(rows.count(), HOT_KEYS)).select(*keys)
    hot = stage(table.join(F.broadcast(stage(hot, "hot-keys")), keys, "left_semi"), "hot-rows")
    if hot.isEmpty():
        return rows.join(table, keys, "left")
    frequent = rows.join(F.broadcast(hot), keys)
    return frequent.unionByName(rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(table, keys, "left"))


def list_hashes(ends: DataFrame) -> DataFrame:
    """``k1, k2, ends_sha256``: SHA-256 of the ids ``conv`` of each ``k1, k2``, in ascending order, with commas between."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, shown, size = None, None, [], 0
        names, types = ["k1", "k2", "first", "ids"], [pa.int64()] * 3 + [pa.string()]
        for batch in batches:
            out = []
            for k1, k2, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shown and ((k1, k2) != key or size > PIECE):
                    out.append((*key, first, ",".join(shown)))
                    shown, size = [], 0
                if not shown:
                    key, first = (k1, k2), conv
                shown.append(str(conv))
                size += len(shown[-1]) + 1
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
        if shown:
            yield pa.record_batch([pa.array([c], t) for c, t in zip((*key, first, ",".join(shown)), types, strict=True)], names=names)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        names, types = ["k1", "k2", "ends_sha256"], [pa.int64()] * 2 + [pa.string()]
        for batch in batches:
            out = []
            for k1, k2, shown in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids")), strict=True):
                if (k1, k2) != key:
                    if key:
                        out.append((*key, digest.hexdigest()))
                    key, digest = (k1, k2), hashlib.sha256(shown.encode())
                else:
                    digest.update(b"," + shown.encode())
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
        if key:
            yield pa.record_batch([pa.array([c], t) for c, t in zip((*key, digest.hexdigest()), types, strict=True)], names=names)

    order = ["k1", "k2", "conv"]
    dealt = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    cut = dealt.mapInArrow(pieces, "k1 long, k2 long, first long, ids string")
    return cut.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(hashes, "k1 long, k2 long, ends_sha256 string")


def _owners(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Per conversation: its length and bytes, the depth ``own`` from which on it owns its nodes, the bytes of its turns from there
    on, the owner ``above`` of the node before, and whether it owns a leaf."""
    start = F.struct("depth", "before", "q1", "q2")
    none = F.lit(None)
    parts = [
        groups.select(F.col("conv_id").alias("conv"), start.alias("start"), (~F.col("more")).alias("leaf"), none.cast("long").alias("length"), none.cast("long").alias("total")),
        rows.where("not shared").select("conv", start.alias("start"), F.col("ends").alias("leaf"), none.cast("long").alias("length"), none.cast("long").alias("total")),
        rows.where("ends").select("conv", none.alias("start"), none.cast("boolean").alias("leaf"), F.col("depth").alias("length"), (F.col("before") + F.col("n_bytes")).alias("total")),
    ]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2])
    by_conv = merged.groupBy("conv").agg(F.min("start").alias("s"), F.max("leaf").alias("leaf"), F.max("length").alias("length"), F.max("total").alias("total"))
    owned = F.coalesce(F.col("total") - F.col("s.before"), F.lit(0)).alias("owned")
    leaf = F.coalesce("leaf", F.lit(False)).alias("leaf")
    found = stage(by_conv.select("conv", F.col("s.depth").alias("own"), owned, leaf, "length", "total", F.col("s.q1").alias("k1"), F.col("s.q2").alias("k2")), "owners")
    names = groups.select("k1", "k2", F.col("conv_id").alias("above"))
    return stage(attach(found, names, ["k1", "k2"]).drop("k1", "k2"), "owners")


def trie(rows: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_bytes, ends_sha256`` per node, from ``paths``.

    ``saved_bytes`` is what members share: for each node of the subtree, members but one, times the bytes of its last
    text. ``ends_sha256`` is of the list of conversations that end at the node.
    """
    rows = screened(rows)
    shared = rows.where("shared")
    keys = ["k1", "k2"]
    same = [F.min(c).alias(c) for c in ("depth", "before", "q1", "q2")]
    groups = stage(shared.groupBy(*keys).agg(F.min("conv").alias("conv_id"), F.max(~F.col("ends")).alias("more"), *same), "shared-nodes")
    owners = _owners(rows, groups)

    def number(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    mine = F.col("own") <= F.col("depth")
    whole = F.col("total") - F.col("before")
    members = attach(shared.select("conv", "depth", "before", *keys), owners, ["conv"])
    nodes = members.groupBy(*keys).agg(
        F.min("conv").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.max(F.when(mine, F.col("own"))).alias("own"),
        F.max(F.when(mine, F.col("above"))).alias("above"),
        F.count("*").alias("n_convs"),
        number((F.col("own") <= F.col("depth") + 1) & (F.col("length") > F.col("depth"))).alias("n_children"),
        number(F.col("leaf")).alias("n_leaves"),
        F.sum(whole - F.when(mine, whole).otherwise(F.col("owned"))).alias("saved_bytes"),
    )
    lists = list_hashes(shared.where("ends"))
    parent = F.when(F.col("depth") > 0, F.when(F.col("own") < F.col("depth"), F.col("conv_id")).otherwise(F.col("above")))
    no_ends = F.lit(hashlib.sha256(b"").hexdigest())
    grouped = nodes.join(lists, keys, "left").withColumn("parent_conv_id", parent).withColumn("ends_sha256", F.coalesce("ends_sha256", no_ends))

    # Nodes of one member, made where the conversation is; the first of them may hang on a node of another owner.
    first = attach(rows.where("not shared and from_shared").select("conv", "depth", "ends"), owners.select("conv", "own", "above"), ["conv"])
    first = first.withColumn("parent_conv_id", F.when(F.col("own") < F.col("depth"), F.col("conv")).otherwise(F.col("above")))
    rest = rows.where("not shared and not from_shared").select("conv", "depth", "ends", F.when(F.col("depth") > 0, F.col("conv")).alias("parent_conv_id"))
    alone = first.select(*rest.columns).unionByName(rest).select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.lit(1).cast("long").alias("n_convs"),
        F.when(F.col("ends"), 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_bytes"),
        F.when(F.col("ends"), F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(no_ends).alias("ends_sha256"),
    )
    return grouped.select(*alone.columns).unionByName(alone)


def prefix_trie(conversations: DataFrame, conv: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``trie`` of a table of turns."""
    return trie(paths(turn_hashes(conversations, conv, order, role, text)))


def rebuilt(turns: DataFrame, block: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of conversations that start as the first of their ``block`` does.

    Conversation c keeps its own turns but for the first h = crc32(c) % ``most``; before them stand the first h turns of
    conversation c - c % ``block`` (all if it has fewer, none if there is no such conversation).
    """
    numbered = paths(turns).select("conv", F.col("depth").alias("place"), "x", "n_bytes", "ends")
    ids = numbered.where("ends").select("conv")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    own = numbered.where((F.col("place") > 0) & (F.col("place") > h)).drop("ends")
    heads = numbered.where(F.col("place").between(1, most - 1)).select(F.col("conv").alias("base"), "place", "x", "n_bytes")
    starts = ids.withColumn("base", F.col("conv") - F.col("conv") % block).join(heads, "base").where(F.col("place") <= h)
    return own.unionByName(starts.select(*own.columns)), ids
