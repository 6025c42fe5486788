"""Intermediate tables: written once, read by several later steps.

A result that several branches of a plan need is written to a folder and read back. That cuts the lineage: a lost
executor costs a re-read, not a recomputation of everything before. It also gives Spark true sizes to plan with.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from accountweave.session import checkpoint_folder

#: Bytes of a row group. Files are split between row groups only, and rows of these are many times larger in memory.
ROW_GROUP = 8 << 20


def stage(df: DataFrame, name: str, folder: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` and return the written table.

    With ``folder`` the table has a fixed place there, which the next run overwrites. Without, it gets a new place
    below the shared checkpoint folder of the cluster, which ``drop_staged`` removes. ``options`` go to the writer.
    """
    path = f"{folder}/{name}" if folder else checkpoint_folder(df.sparkSession, f"staged/{name}-{uuid.uuid4().hex}")
    options = {"parquet.block.size": str(ROW_GROUP)} | options
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
