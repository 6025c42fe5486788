"""Tables in versions: a folder per version, and a small pointer file that names the one that counts.

A version is written whole beside the others; then the pointer is replaced by one rename. Readers see the old version or the
new one, never a part of either, and a writer that dies leaves the old one as it was. What such a writer left behind is
a folder that no pointer names, removed after the next version is published. A version may hold one table or several that
belong together. One writer per table at a time.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

POINTER, VERSION = "_current", "version-"
#: Versions that stay besides the current one, for readers that opened them before.
KEPT = 1


def hadoop_path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of a path, and the path in it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = hadoop_path(spark, path)
    return files.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    files, at = hadoop_path(spark, path)
    files.delete(at, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no such folder."""
    files, at = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder to a name that is free."""
    files, at = hadoop_path(spark, source)
    if not files.rename(at, hadoop_path(spark, target)[1]):
        raise OSError(f"cannot rename {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file at once: written under another name, then renamed over the old one."""
    jvm, draft = spark.sparkContext._jvm, f"{path}.{uuid.uuid4().hex}"
    files, at = hadoop_path(spark, draft)
    out = files.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(kind, 1)
    over[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(at, hadoop_path(spark, path)[1], over)


def read_text(spark: SparkSession, path: str) -> str | None:
    """First line of a small file; None where it does not exist."""
    files, at = hadoop_path(spark, path)
    if not files.exists(at):
        return None
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(files.open(at), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def current(spark: SparkSession, table: str) -> str | None:
    """Folder of the version that counts; None for a table without versions."""
    name = read_text(spark, f"{table}/{POINTER}")
    return f"{table}/{name}" if name else None


def new_version(table: str) -> str:
    """A folder for the next version; names sort by time."""
    return f"{table}/{VERSION}{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, table: str, folder: str, kept: int = KEPT) -> None:
    """Let ``folder`` be the version that counts, then remove older ones but for ``kept``."""
    name = folder.rpartition("/")[2]
    write_text(spark, f"{table}/{POINTER}", name)
    old = [c for c in children(spark, table) if c.startswith(VERSION) and c < name]
    for version in old[: len(old) - kept]:
        delete(spark, f"{table}/{version}")
