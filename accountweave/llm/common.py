"""What the text operators share: row identity, whole rows carried past a join, staging."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountweave.sources.staging import stage

__all__ = ["KEY", "ROW", "bit_field", "hits", "keyed", "maybe_in", "row_key", "ship", "small_batches", "stage", "text_of"]

#: Working columns. Rows of the caller travel as one struct, so its own columns can have any name.
KEY, ROW = "__aw_key", "__aw_row"
#: Bits of a bit field, as a power of two: 2 MB, whatever it is filled from.
FIELD_BITS = 24


#: Bytes of a batch of rows that goes to a Python worker, and the setting for it. Spark's 64 MB are held by the worker and by
#: the executor's JVM outside its heap, more than once, and are kept by both for later stages.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the batches of this session by ``BATCH_BYTES``; a smaller size stays. No result depends on it."""
    own = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_SETTING))
    if own > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this library, once per application: they need not have it installed."""
    name = spark.sparkContext.applicationId
    if name not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(package)}.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, files in os.walk(package):
                for f in files:
                    if f.endswith(".py"):
                        z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), os.path.dirname(package)))
        spark.sparkContext.addPyFile(path)
        _shipped.add(name)


def text_of(name: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_key(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """16 bytes that name a row by its id and whole text.

    Ids may be null or repeated. Rows that agree in both are told apart by nothing and get the same result; their
    number still counts wherever copies are counted.
    """
    shown = F.coalesce(F.concat(F.lit("="), F.col(id_column).cast("string")), F.lit("-"))
    return F.unhex(F.md5(F.concat(shown, F.lit("\u0000"), text_of(text_column)).cast("binary")))


def keyed(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Key and whole row, the row as one struct."""
    return df.select(row_key(id_column, text_column).alias(KEY), F.struct("*").alias(ROW))


def bit_field(hashes: DataFrame) -> bytes:
    """A bit set for each 64-bit hash in the only column of ``hashes``.

    It drops rows that can't match before they are shuffled, and never one that can. Its size is fixed, so it may be
    broadcast; filled from very many hashes it only drops less. Bits are combined by word before they reach the driver.
    """
    hashes = hashes.toDF("h")
    shift = 64 - FIELD_BITS
    word = F.expr(f"shiftrightunsigned(h, {shift + 6})").alias("w")
    bit = F.expr(f"shiftleft(1L, cast(pmod(shiftrightunsigned(h, {shift}), 64) as int))").alias("b")
    words = hashes.select(word, bit).groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    field = np.zeros(1 << (FIELD_BITS - 6), np.int64)
    field[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64)
    return field.tobytes()


def hits(field: bytes, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    at = hashes.view(np.uint64) >> np.uint64(64 - FIELD_BITS)
    return (np.frombuffer(field, np.uint8)[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def maybe_in(hashes: DataFrame) -> Callable[[Column], Column]:
    """A condition on a column of 64-bit hashes: false only where the hash is not among ``hashes``."""
    shared = hashes.sparkSession.sparkContext.broadcast(bit_field(hashes))

    @F.pandas_udf("boolean")
    def check(h: pd.Series) -> pd.Series:
        return pd.Series(hits(shared.value, h.to_numpy(np.int64)))

    return check
