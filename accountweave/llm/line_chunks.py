"""Removal of repeated multi-line passages, by content-defined chunks of lines. Built-in functions only.

Each line has a hash; a rolling value over the last three line hashes ends a chunk where it is a multiple of
``MODULUS``. Where chunks end depends on the lines just before only, so a passage that is shared by two texts is cut
alike in both from the first boundary inside it, whatever stands before it. A chunk of at least two lines that are not
blank, which occurs again anywhere (same text or another), is a repeat once its bytes are found equal; its first
occurrence stays (smallest document id, then position) and all others go.

Plan: chunk hashes without texts are counted first; only chunks whose hash occurs twice are cut out as text and compared.
Counts are combined before each shuffle, so a passage that stands in a third of all texts is one row per task. Joins on
the chunk are plain joins of shuffled sides, which Spark splits where a chunk is frequent.

``dedup_lines`` follows that rule, which the SQL of ``op9_line_chunks`` fixes too; a short passage in other surroundings is
seldom cut alike and stays there. ``without_repeats``, the stage of the pipeline, takes every passage of at least two lines
that are not blank (``repeated_lines``).

Defined cases: a null text is empty and has one blank line; a null id counts as the largest; rows that share the
smallest id of a repeat each keep their first occurrence; a text of which nothing is left stays as an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountweave.llm.common import KEY, ROW, keyed, row_key, stage, text_of
from accountweave.operators.joins import lookup_join

MODULUS = 4
MIN_LINES = 2
_LAST = 9223372036854775807
#: Fixed values of the rolling sum.
_BASE, _PRIME = 31, 1_000_000_007


def line_hash(line: Column) -> Column:
    """32 bits of a digest, which any SQL engine can compute too."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Key, id and text."""
    own_id = F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST))
    return docs.select(row_key(id_column, text_column).alias(KEY), own_id.alias("id"), text_of(text_column).alias("text"))


def _cut(rows: DataFrame) -> DataFrame:
    """``rows`` with ``lines`` and ``chunks`` (``at``: lines before it, ``n``: its lines) of their ``text``."""
    rows = rows.withColumn("lines", F.split("text", "\n", -1)).withColumn("hashes", F.transform("lines", line_hash))
    before = lambda i, back: F.coalesce(F.get("hashes", i - back), F.lit(0))
    rolled = F.transform("hashes", lambda h, i: (h + before(i, 1) * _BASE + before(i, 2) * (_BASE * _BASE)) % _PRIME)
    rows = rows.withColumn("rolled", rolled)
    ends = F.filter(
        F.transform("rolled", lambda r, i: F.when((r % MODULUS == 0) | (i == F.size("rolled") - 1), i + 1)),
        lambda e: e.isNotNull(),
    )
    rows = rows.withColumn("ends", ends)
    start = lambda i: F.coalesce(F.get("ends", i - 1), F.lit(0))
    chunks = F.transform("ends", lambda e, i: F.struct(start(i).alias("at"), (e - start(i)).alias("n")))
    return rows.withColumn("chunks", chunks).drop("hashes", "rolled", "ends")


def _text(chunk: Column) -> Column:
    return F.array_join(F.slice("lines", chunk["at"] + 1, chunk["n"]), "\n")


def _several_lines(chunk: Column) -> Column:
    lines = F.slice("lines", chunk["at"] + 1, chunk["n"])
    return (chunk["n"] >= MIN_LINES) & (F.size(F.filter(lines, lambda line: F.trim(line) != "")) >= MIN_LINES)


def repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``KEY, removed``: per row that has repeats to lose, the numbers of those chunks."""
    rows = _rows(docs, id_column, text_column)
    # The outer form: for the inner one Spark puts a filter on the size of the array below all that computes it.
    every = _cut(rows).select(KEY, "lines", F.posexplode_outer("chunks").alias("no", "c")).where(_several_lines(F.col("c")))
    hashed = every.select(KEY, "no", F.xxhash64(_text(F.col("c"))).alias("h"))
    again = hashed.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    where = hashed.join(again, "h", "left_semi").groupBy(KEY).agg(F.collect_set("no").alias("nos"))
    texts = _cut(rows.join(where, KEY)).select(KEY, "id", "lines", "chunks", F.explode_outer("nos").alias("no"))
    texts = texts.select(KEY, "id", "no", _text(F.get("chunks", F.col("no"))).alias("chunk"))
    own = texts.groupBy(KEY, "id", "chunk").agg(F.sort_array(F.collect_set("no")).alias("nos"), F.count("*").alias("times"))
    own = stage(own.withColumn("h", F.xxhash64("chunk")), "repeated-chunks")
    # Equal bytes are what groups here; the hash only deals the rows out.
    first = own.groupBy("h", "chunk").agg(F.min("id").alias("first"), F.sum("times").alias("n")).where("n > 1").drop("n")
    lost = F.when(F.col("id") == F.col("first"), F.slice("nos", 2, F.size("nos"))).otherwise(F.col("nos"))
    lost = own.join(first, ["h", "chunk"]).select(KEY, F.explode(lost).alias("no"))
    return lost.groupBy(KEY).agg(F.collect_set("no").alias("removed"))


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` as one struct, with ``n_lines``, ``n_removed`` (lines), ``n_chunks`` (removed) and ``kept`` (text)."""
    rows = docs.select(row_key(id_column, text_column).alias(KEY), F.struct("*").alias(ROW), text_of(text_column).alias("whole"))
    found = rows.join(repeats(docs, id_column, text_column), KEY, "left")
    cut = _cut(found.withColumn("text", F.when(F.col("removed").isNotNull(), F.col("whole")).otherwise("")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("chunks") - 1), "removed")
    cut = cut.withColumn("stay", stay)
    kept = F.array_join(F.transform("stay", lambda no: _text(F.get("chunks", no))), "\n")
    gone = F.aggregate("removed", F.lit(0), lambda total, no: total + F.get("chunks", no)["n"])
    changed = F.col("removed").isNotNull()
    n_lines = F.length("whole") - F.length(F.replace(F.col("whole"), F.lit("\n"), F.lit(""))) + 1
    return cut.select(
        ROW,
        n_lines.cast("long").alias("n_lines"),
        F.when(changed, gone).otherwise(0).cast("long").alias("n_removed"),
        F.when(changed, F.size("removed")).otherwise(0).cast("long").alias("n_chunks"),
        F.when(changed, kept).otherwise(F.col("whole")).alias("kept"),
    )


def repeated_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``KEY, gone``: per row that has any, the numbers of the lines that stand in a repeated passage, wherever chunks end.

    Every line that is not blank makes a window with the next such line and the blank ones between them. Passages of two
    or more lines are runs of windows, so a passage of any length is found whole in whatever surroundings. A window is a
    repeat if it has an earlier occurrence (in order of id, key and position) that it doesn't overlap. Windows are equal
    if their 256-bit digests are.
    """
    rows = _rows(docs, id_column, text_column).withColumn("lines", F.split("text", "\n", -1))
    filled = F.filter(F.transform("lines", lambda line, i: F.when(F.trim(line) != "", i)), lambda i: i.isNotNull())
    rows = rows.withColumn("filled", filled)
    # Digests are made inside the array: rows of single windows must not carry the whole text.
    window = lambda i, end: F.unhex(F.sha2(F.array_join(F.slice("lines", i + 1, end - i + 1), "\n").cast("binary"), 256))
    every = F.transform("filled", lambda i, k: F.struct(i.alias("at"), F.get("filled", k + 1).alias("end")))
    every = F.filter(every, lambda w: w["end"].isNotNull())
    every = F.transform(every, lambda w: F.struct(w["at"].alias("at"), w["end"].alias("end"), window(w["at"], w["end"]).alias("d")))
    windows = rows.withColumn("every", every).select(KEY, "id", F.explode("every").alias("w")).select(KEY, "id", "w.*")
    windows = stage(windows, "line-windows", compression="zstd").withColumn("h", F.xxhash64("d"))
    # Most windows occur once. A count of 8-byte hashes tells them, so only the others move with key, place and digest.
    again = stage(windows.groupBy("h").agg(F.count("*").alias("_n")).where("_n > 1"), "window-hashes")
    met = lookup_join(windows, again.select("h", F.lit(True).alias("again")), "h", [KEY, "at"], counts=again)
    met = stage(met.where("again").select(KEY, "id", "at", "end", "d"), "met-windows", compression="zstd")
    first = met.groupBy("d").agg(F.min(F.struct("id", KEY, "at", "end")).alias("first"), F.count("*").alias("_n")).where("_n > 1")
    first = stage(first, "first-windows", compression="zstd")
    met = lookup_join(met, first.select("d", "first"), "d", [KEY, "at"], counts=first.select("d", "_n"))
    later = (F.col(KEY) != F.col(f"first.{KEY}")) | (F.col("at") > F.col("first.end"))
    lost = met.where(later).select(KEY, F.explode(F.sequence("at", "end")).alias("no"))
    return lost.groupBy(KEY).agg(F.collect_set("no").alias("gone"))


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the same columns; ``text`` without repeated lines, and ``n_chars`` to match where there is one."""
    # The text moves once, inside its row.
    out = keyed(docs, id_column, text_column).join(repeated_lines(docs, id_column, text_column), KEY, "left")
    whole = F.coalesce(F.col(ROW)[text_column].cast("string"), F.lit(""))
    out = out.withColumn("lines", F.when(F.col("gone").isNotNull(), F.split(whole, "\n", -1)))
    out = out.withColumn("stay", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone"))
    out = out.withColumn("kept", F.array_join(F.transform("stay", lambda no: F.get("lines", no)), "\n"))
    columns = []
    for name in docs.columns:
        own = F.col(ROW)[name]
        changed = F.col("gone").isNotNull()
        if name == text_column:
            own = F.when(changed, F.col("kept")).otherwise(own)
        elif name == "n_chars":
            own = F.when(changed, F.length("kept")).otherwise(own).cast(docs.schema[name].dataType)
        columns.append(own.alias(name))
    return out.select(*columns)
