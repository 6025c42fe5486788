"""Token ids in files: frequency-ranked, byte-aligned variable-length coding with separate control bytes.

An id is replaced by its rank among all ids of the corpus (most frequent first, ties to the smaller id), and the rank is
written in the fewest whole bytes, 1 to 4. Two bits per id tell how many; four such pairs make a control byte, kept
apart from the data bytes. Reading is a table lookup per control byte and a gather, no branches.

Files are Parquet below ``path``: ``ranks`` (one row per id of the vocabulary that occurs) and ``ids``, a folder per
range of documents (``part``, ascending) with one row per document in ascending id order (null ids first; equal ids in
an order set by a hash of the text): ``seq``, ``doc_id``, ``n``, ``control``, ``data``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accountweave.llm.common import stage, text_of
from accountweave.llm.tokens import encoder, vocabulary_path

#: Segments that a worker remembers here, where encoding is most of the work and nothing else needs the memory.
SEGMENTS = 690_000
#: For each control byte the lengths of its four ids.
LENGTHS = np.array([[(c >> (2 * i) & 3) + 1 for i in range(4)] for c in range(256)], dtype=np.uint8)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    values = values.astype("<u4")
    n = len(values)
    codes = np.searchsorted([1 << 8, 1 << 16, 1 << 24], values, side="right").astype(np.uint8)
    padded = np.zeros(-(-n // 4) * 4, np.uint8)
    padded[:n] = codes
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    planes = values.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), planes[np.arange(4) <= codes[:, None]].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values that ``pack`` was given."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    planes = np.zeros((n, 4), np.uint8)
    planes[np.arange(4) < lengths[:, None]] = np.frombuffer(data, np.uint8)
    return planes.view("<u4").reshape(-1)


def _joined(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of a column of bytes, one after the other, and where each row begins, with the end."""
    column = column.cast(pa.large_binary())
    _, begins, data = column.buffers()
    begins = np.frombuffer(begins, np.int64)[column.offset : column.offset + len(column) + 1]
    size = np.dtype(kind).itemsize
    data = np.frombuffer(data or b"", np.uint8)[begins[0] : begins[-1]]
    return data.view(kind), (begins - begins[0]) // size


def _cut(data: np.ndarray, begins: np.ndarray) -> pa.Array:
    """Bytes as a column, a row from each of ``begins`` to the next."""
    buffers = [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins) - 1, buffers).cast(pa.binary())


def _places(begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each row's control bytes begin, and the place of each value's bits among those of all rows."""
    sizes = np.diff(begins)
    quads = np.concatenate([[0], np.cumsum(-(-sizes // 4))])
    return quads, np.arange(begins[-1]) + np.repeat(4 * quads[:-1] - begins[:-1], sizes)


def pack_rows(values: np.ndarray, begins: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """``pack`` of each row, where rows are runs of ``values`` from each of ``begins`` to the next."""
    values = values.astype("<u4")
    codes = np.zeros(len(values), np.uint8)
    for bits in (8, 16, 24):
        codes += values >= 1 << bits
    quads, place = _places(begins)
    padded = np.zeros(4 * quads[-1], np.uint8)
    padded[place] = codes
    padded = padded.reshape(-1, 4)
    control = padded[:, 0] | padded[:, 1] << 2 | padded[:, 2] << 4 | padded[:, 3] << 6
    ends = np.concatenate([[0], np.cumsum(codes, dtype=np.int64)])[begins] + begins
    return _cut(control, quads), _cut(values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= codes[:, None]], ends)


def unpack_rows(control: pa.Array, data: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values and begins of rows that ``pack_rows`` was given."""
    begins = np.concatenate([[0], np.cumsum(sizes)])
    lengths = LENGTHS[_joined(control, "u1")[0]].reshape(-1)[_places(begins)[1]]
    planes = np.zeros((begins[-1], 4), np.uint8)
    planes[np.arange(4) < lengths[:, None]] = _joined(data, "u1")[0]
    return planes.view("<u4").reshape(-1), begins


def encode_sorted(docs: DataFrame, vocabulary: str, end_id: int, id_column: str, text_column: str) -> DataFrame:
    """``part, seq, doc_id, ids`` (little-endian, 16 bits where the vocabulary allows) in ascending order of ids."""
    tie = F.xxhash64("text")
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    kind = ordered.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end, seq = encoder(vocabulary, SEGMENTS), np.array([end_id], "<u4").tobytes(), 0
        wide = coder.wide
        for batch in batches:
            rows = [coder.encode(t) + end for t in batch.column("text").to_pylist()]
            own = pa.array(range(seq, seq + len(rows)), pa.int64())
            seq += len(rows)
            ids = pa.array(rows, pa.binary())
            if not wide:
                values, begins = _joined(ids, "<u4")
                ids = _cut(values.astype("<u2").view(np.uint8), 2 * begins)
            yield pa.record_batch([own, batch.column("doc_id"), batch.column("part"), ids], names=["seq", "doc_id", "part", "ids"])

    return ordered.withColumn("part", F.spark_partition_id()).select("part", "doc_id", "text").mapInArrow(
        run, f"seq long, doc_id {kind}, part int, ids binary"
    )


def id_counts(encoded: DataFrame, width: int) -> DataFrame:
    """How often each id occurs in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            part = np.bincount(_joined(batch.column("ids"), f"<u{width}")[0])
            if len(part) > len(total):
                part[: len(total)] += total
                total = part
            else:
                total[: len(part)] += part
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    return encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(
    docs: DataFrame,
    path: str,
    vocabulary: str | None = None,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Encode every whole text, append ``end_id`` to each, and write the files.

    Null texts are empty and hold the end id only. The rank table has at most one row per id of the vocabulary, and
    is the only thing that passes the driver.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or vocabulary_path()
    width = 4 if encoder(vocabulary, SEGMENTS).wide else 2
    encoded = stage(encode_sorted(docs, vocabulary, end_id, id_column, text_column), "token-ids", compression="zstd")
    counted = id_counts(encoded, width).orderBy(F.desc("n"), "id").collect()
    spark.createDataFrame([(rank, r.id, r.n) for rank, r in enumerate(counted)], "rank long, id long, n long").coalesce(1).write.parquet(
        f"{path}/ranks"
    )
    rank_of = np.zeros(max([r.id for r in counted], default=0) + 1, "<u4")
    rank_of[[r.id for r in counted]] = np.arange(len(counted))
    shared = spark.sparkContext.broadcast(rank_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        for batch in batches:
            ids, begins = _joined(batch.column("ids"), f"<u{width}")
            columns = [batch.column("part"), batch.column("seq"), batch.column("doc_id"), pa.array(np.diff(begins), pa.int64())]
            yield pa.record_batch([*columns, *pack_rows(ranks[ids], begins)], names=["part", "seq", "doc_id", "n", "control", "data"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    written = encoded.mapInArrow(run, f"part int, seq long, doc_id {kind}, n long, control binary, data binary")
    written.sortWithinPartitions("part", "seq").write.partitionBy("part").parquet(f"{path}/ids")


def read_ids(spark: SparkSession, path: str, ids: bool = True, id_type: str = "long") -> DataFrame:
    """``part, seq, doc_id, n_tokens, ids_crc32`` and the ``ids`` (array of int) from the files."""
    table = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    shared = spark.sparkContext.broadcast(np.array([r.id for r in table], "<u4"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_of = shared.value
        for batch in batches:
            ranks, begins = unpack_rows(batch.column("control"), batch.column("data"), batch.column("n").to_numpy())
            flat = id_of[ranks]
            values = [flat[a:b] for a, b in pairwise(begins.tolist())]
            crc = pa.array([zlib.crc32(v) for v in values], pa.int64())
            columns = [batch.column("part"), batch.column("seq"), batch.column("doc_id"), batch.column("n"), crc]
            names = ["part", "seq", "doc_id", "n_tokens", "ids_crc32"]
            if ids:
                columns.append(pa.array([v.astype("<i4") for v in values], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(columns, names=names)

    files = spark.read.schema(f"part int, seq long, doc_id {id_type}, n long, control binary, data binary").parquet(f"{path}/ids")
    out = f"part int, seq long, doc_id {id_type}, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids
    return files.select("part", "seq", "doc_id", "n", "control", "data").mapInArrow(run, out)


def with_starts(rows: DataFrame) -> DataFrame:
    """``start``: the ids of all documents before this one. Sums within a part, then over the few parts."""
    rows = stage(rows, "token-lengths")
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = sums.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    start = (F.coalesce(F.sum("n_tokens").over(within), F.lit(0)) + F.col("before")).alias("start")
    return rows.join(before, "part").select("doc_id", start, "n_tokens", "ids_crc32")
