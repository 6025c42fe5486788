"""Describe documents: one JSON file per CRM object, with a ``fields`` array, and a global one with all objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELD = "struct<name:string,label:string,type:string,nillable:boolean>"
DESCRIBE_SCHEMA = f"name string, label string, fields array<{FIELD}>"


def read_describes(spark: SparkSession, path: str) -> DataFrame:
    """Directory of describe files -> (object_name, fields); the object is named by its file."""
    file_name = F.col("_metadata.file_name")
    return (
        spark.read.schema(DESCRIBE_SCHEMA)
        .option("multiLine", True)
        .json(path)
        .select(F.regexp_replace(file_name, r"\.json$", "").alias("object_name"), "fields")
    )


def parse_describes(df: DataFrame, name: str, payload: str) -> DataFrame:
    """The same from documents held as text in a column."""
    parsed = F.from_json(payload, DESCRIBE_SCHEMA)
    return df.select(F.col(name).alias("object_name"), parsed["fields"].alias("fields"))


OBJECT = "struct<name:string,label:string,queryable:boolean,retrieveable:boolean,createable:boolean,updateable:boolean,custom:boolean>"
GLOBAL_SCHEMA = f"sobjects array<{OBJECT}>"


def _objects(documents: DataFrame) -> DataFrame:
    return documents.select(F.explode("sobjects").alias("o")).select("o.*").withColumnRenamed("name", "object_name")


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """Global describe documents -> one row per object: object_name, label and its flags."""
    return _objects(spark.read.schema(GLOBAL_SCHEMA).option("multiLine", True).json(path))


def parse_objects(df: DataFrame, payload: str) -> DataFrame:
    """The same from documents held as text in a column."""
    return _objects(df.select(F.from_json(payload, GLOBAL_SCHEMA)["sobjects"].alias("sobjects")))
