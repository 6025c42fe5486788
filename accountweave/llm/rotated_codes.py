"""Nearest neighbours by inner product with randomly rotated one-bit codes.

Each vector is centred on the mean, scaled to length one and rotated by a fixed random rotation; its code is the sign of
each coordinate, packed eight to a byte, with three scalars: the length ``r`` of the centred vector, its inner product
with the centre, and ``f``, the inner product of the unit vector with its own code. For a query ``q`` with rotated form
``q'``, ``<q, o>`` is estimated without bias as ``<q, centre> + r <code, q'> / f`` and, but for a chance that ``SIGMAS``
sets, is off by at most ``r |q| sqrt((1 - f^2) / f^2) SIGMAS / sqrt(d - 1)``. Per block of codes, the vectors with the
best estimates give a first exact k-th best value; every vector whose upper bound reaches it is compared exactly, in
double precision on the original components. Only that exact value is ever returned or ranked by.

The query set is stated by the caller and searched against all rows in blocks: codes and queries are packed into blocks
of a fixed number of rows, every query block visits every code block, and what leaves a visit is at most ``k`` rows
per query. Nothing is broadcast but the rotation and the centre, whose size depends on the dimension alone.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do null ids; of rows
that share an id the least vector counts; vectors are compared within their own dimension; ties go to the smaller id.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountweave.llm.common import stage

SIGMAS = 3.0
#: Rows of a block; a block of 128 dimensions is 4 MB.
CODE_BLOCK, QUERY_BLOCK = 8192, 1024


@cache
def rotation(dim: int, seed: int = 17) -> np.ndarray:
    """A random orthogonal matrix, the same in every process."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, dim, v``: rows that take part, one per id."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where("vec_id is not null and v is not null").where(finite & F.exists(v, lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), dim)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = np.asarray(batch.column("dim"))
    for dim in np.unique(dims):
        yield int(dim), batch.filter(pa.array(dims == dim))


def centres(rows: DataFrame) -> dict[int, np.ndarray]:
    """Mean vector of each dimension; the driver gets one row per dimension and coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, part in _by_dim(batch):
                m = _matrix(part.column("v"), dim)
                sums[dim] = sums.get(dim, np.zeros(dim + 1)) + np.append(m.sum(0), len(m))
        for dim, s in sums.items():
            yield pa.record_batch(
                [pa.array(np.full(dim, dim), pa.int32()), pa.array(range(dim), pa.int32()), pa.array(s[:-1]), pa.array(np.full(dim, s[-1]))],
                names=["dim", "pos", "s", "n"],
            )

    parts = rows.select("dim", "v").mapInArrow(run, "dim int, pos int, s double, n double")
    means = parts.groupBy("dim", "pos").agg((F.sum("s") / F.sum("n")).alias("m"))
    out: dict[int, np.ndarray] = {}
    for r in means.collect():
        out.setdefault(r.dim, np.zeros(r.dim))[r.pos] = r.m
    return out


def encode(x: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Packed bits, length, inner product with the centre, and inner product with the own code."""
    dim = x.shape[1]
    off = x - centre
    length = np.sqrt((off * off).sum(1))
    turned = (off / np.where(length > 0, length, 1)[:, None]) @ rotation(dim)
    own = np.abs(turned).sum(1) / np.sqrt(dim)
    return np.packbits(turned > 0, axis=1), length, x @ centre, np.where(own > 0, own, 1.0)


def rows_within(rows: int, dim: int) -> int:
    """Fewer rows a block where vectors are long: no block holds more than 8 MB of components."""
    return max(1, min(rows, (1 << 20) // dim))


def code_blocks(rows: DataFrame, centre: dict[int, np.ndarray], size: int) -> DataFrame:
    """One row per block: ids, packed bits, scalars and the original components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}
        task, made = TaskContext.get().partitionId(), itertools.count()

        def block(dim: int) -> pa.RecordBatch:
            parts = held.pop(dim)
            ids = np.concatenate([np.asarray(p.column("vec_id")) for p in parts]).astype("<i8")
            x = np.concatenate([_matrix(p.column("v"), dim) for p in parts]).astype("<f8")
            bits, length, _, own = encode(x, centre[dim])
            scalars = np.stack([length, own]).astype("<f4")
            packed = [a.tobytes() for a in (ids, bits, scalars, x)]
            columns = [pa.array([dim], pa.int32()), pa.array([task], pa.int32()), pa.array([next(made)], pa.int32())]
            return pa.record_batch([*columns, *(pa.array([b], pa.binary()) for b in packed)], names=["dim", "task", "seq", "ids", "bits", "scalars", "x"])

        for batch in batches:
            for dim, part in _by_dim(batch):
                most = rows_within(size, dim)
                for at in range(0, len(part), most):
                    held.setdefault(dim, []).append(part.slice(at, most))
                    if sum(map(len, held[dim])) >= most:
                        yield block(dim)
        for dim in list(held):
            yield block(dim)

    return rows.select("vec_id", "dim", "v").mapInArrow(run, "dim int, task int, seq int, ids binary, bits binary, scalars binary, x binary")


def query_blocks(rows: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_dim(batch):
                most = rows_within(size, dim)
                for at in range(0, len(part), most):
                    p = part.slice(at, most)
                    ids, q = np.asarray(p.column("vec_id")).astype("<i8"), _matrix(p.column("v"), dim).astype("<f8")
                    yield pa.record_batch(
                        [pa.array([dim], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([q.tobytes()], pa.binary())],
                        names=["dim", "q_ids", "q"],
                    )

    return rows.select("vec_id", "dim", "v").mapInArrow(run, "dim int, q_ids binary, q binary")


def search_block(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, bits: np.ndarray, scalars: np.ndarray, x: np.ndarray, centre: np.ndarray, k: int):
    """The ``k`` best of one block for each query: positions of queries, ids and exact inner products."""
    dim = q.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    turned = (q @ rotation(dim)).astype(np.float32)
    length, own = scalars
    scale = length / own
    estimate = (turned @ signs.T) * (scale / np.sqrt(dim)) + (q @ centre).astype(np.float32)[:, None]
    bound = length * np.sqrt(np.maximum(0, 1 - own**2)) / own * (SIGMAS / np.sqrt(max(1, dim - 1))) + 1e-5 * (length + 1)
    norms = np.sqrt((q * q).sum(1))
    found = []
    for i in range(len(q)):
        e = estimate[i]
        e[ids == q_ids[i]] = -np.inf
        first = np.argpartition(-e, k - 1)[:k] if len(e) > k else np.arange(len(e))
        first = first[e[first] > -np.inf]
        if not len(first):
            continue
        least = (x[first] * q[i]).sum(1).min() if len(first) == k else -np.inf
        near = np.flatnonzero((e + bound * norms[i] >= least) & (e > -np.inf))
        exact = (x[near] * q[i]).sum(1)
        if len(near) > k:
            keep = exact >= np.partition(exact, -k)[-k]
            near, exact = near[keep], exact[keep]
        best = np.lexsort((ids[near], -exact))[:k]
        found.append((np.full(len(best), q_ids[i]), ids[near[best]], exact[best]))
    return found


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    code_block: int = CODE_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: of each row that ``is_query`` (a condition on ``vec_id``) the ``k`` rows
    with the largest inner product, its own row left out.
    """
    spark = vectors.sparkSession
    rows = stage(usable(vectors, id_column, vector_column), "vectors")
    means = centres(rows)
    shared = spark.sparkContext.broadcast(means)
    codes = stage(code_blocks(rows, means, code_block), "codes")
    queries = query_blocks(rows.where(is_query), query_block)
    # Every query block visits every block of its dimension: blocks are numbered, and queries repeated per number.
    name = ["dim", "task", "seq"]
    numbers = codes.select(*name).withColumn("block", F.row_number().over(Window.partitionBy("dim").orderBy("task", "seq")))
    per_dim = codes.groupBy("dim").agg(F.count("*").cast("int").alias("blocks"))
    repeated = queries.join(per_dim, "dim").withColumn("block", F.explode(F.sequence(F.lit(1), "blocks")))
    visits = repeated.join(codes.join(numbers, name), ["dim", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                get = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                dim = get["dim"]
                ids = np.frombuffer(get["ids"], "<i8")
                found = search_block(
                    np.frombuffer(get["q_ids"], "<i8"),
                    np.frombuffer(get["q"], "<f8").reshape(-1, dim),
                    ids,
                    np.frombuffer(get["bits"], np.uint8).reshape(len(ids), -1),
                    np.frombuffer(get["scalars"], "<f4").reshape(2, -1),
                    np.frombuffer(get["x"], "<f8").reshape(-1, dim),
                    shared.value[dim],
                    k,
                )
                if found:
                    yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=["query_id", "vec_id", "score"])

    near = visits.select("dim", "q_ids", "q", "ids", "bits", "scalars", "x").mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
