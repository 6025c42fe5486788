"""Schema discovery: object classes, field inventory, counts and name lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountweave.functions._cols import as_col
from accountweave.operators.joins import lookup_join
from accountweave.schemas import CRM_COLUMNS

# Fixed values: (name suffix, object class), first match wins.
OBJECT_CLASSES = (
    ("__c", "Custom Object"),
    ("__change_event", "CDC Event Object"),
    ("__Share", "System / Security"),
    ("__History", "System / Security"),
)
OTHER_OBJECT = "Standard Object"

# Selection flags, and how fields of related objects are shown.
REQUIRED, OPTIONAL = "Required", "Optional / Evaluate"
DIRECT, RELATIONSHIP = "Direct", "Relationship Traversal"
RELATIONSHIP_LABEL = " (SOQL Relationship Traversal)"

#: Flags of an object in a global describe document -> inventory column.
OBJECT_FLAGS = ("queryable", "retrieveable", "createable", "updateable", "custom")


def object_class(name: Column | str) -> Column:
    name = as_col(name)
    chosen = [F.when(name.endswith(suffix), label) for suffix, label in OBJECT_CLASSES]
    return F.coalesce(*chosen, F.lit(OTHER_OBJECT))


def api_name(object_name: str) -> str:
    """Name of a landed object in describe documents."""
    return "".join(part.capitalize() for part in object_name.split("_"))


def required_fields(spark: SparkSession) -> DataFrame:
    """The selection for ``field_inventory``: what the landing projects, fields of related objects by their path."""
    rows = [
        (api_name(name), c.replace("_", "."), RELATIONSHIP if "_" in c else DIRECT) for name, columns in CRM_COLUMNS.items() for c in columns
    ]
    return spark.createDataFrame(rows, "object_name string, field_name string, field_type string")


def object_inventory(objects: DataFrame) -> DataFrame:
    """Objects of a global describe document (see ``sources.describe``) -> one row each, with class and flags."""
    return objects.select("object_name", "label", object_class("object_name").alias("object_type"), *OBJECT_FLAGS)


def custom_objects(inventory: DataFrame) -> DataFrame:
    return inventory.where(F.col("custom")).select("object_name", "label")


def field_inventory(described: DataFrame, selected: DataFrame) -> DataFrame:
    """Describe documents -> one row per field, flagged by membership in the selection.

    ``described``: object_name, fields array<struct<name,label,type,nillable>>.
    ``selected``: object_name, field_name, field_type; ``Direct`` entries flag described fields, all other entries
    are relationship fields, which describe documents do not list and which are added.
    """
    direct = (
        selected.where(F.col("field_type") == DIRECT)
        .select("object_name", "field_name", F.lit(REQUIRED).alias("selection"))
        .distinct()
    )
    listed = described.select("object_name", F.explode("fields").alias("f")).select(
        "object_name",
        F.col("f.name").alias("field_name"),
        F.lit(DIRECT).alias("field_type"),
        F.col("f.label").alias("label"),
        F.col("f.type").alias("data_type"),
        F.col("f.nillable").alias("nillable"),
    )
    flagged = lookup_join(listed, direct, ["object_name", "field_name"], ["label", "data_type"]).withColumn(
        "selection", F.coalesce("selection", F.lit(OPTIONAL))
    )
    related = (
        selected.where(F.col("field_type") != DIRECT)
        .join(described.select("object_name").distinct(), "object_name", "left_semi")
        .select(
            "object_name",
            "field_name",
            "field_type",
            F.concat("field_name", F.lit(RELATIONSHIP_LABEL)).alias("label"),
            F.lit("reference_field").alias("data_type"),
            F.lit(True).alias("nillable"),
            F.lit(REQUIRED).alias("selection"),
        )
    )
    return flagged.unionByName(related)


def count_pivot(df: DataFrame, row: str, column: str, values: Sequence[str], total: str) -> DataFrame:
    """Counts by two keys with the second one as columns, 0 for none, and a row total. One aggregation."""
    cells = [F.count_if(F.col(column) == v).alias(v) for v in values]
    summed = sum((F.col(v) for v in values[1:]), F.col(values[0]))
    return df.groupBy(row).agg(*cells).withColumn(total, summed)


def names_per_group(df: DataFrame, group: str, name: str, separator: str = ", ") -> DataFrame:
    """Ordered distinct names of each group as one text, and their number.

    Meant for names from a vocabulary (fields of an object). Repeats are removed by an aggregation first, so what is
    collected per group is bounded by the vocabulary and not by the rows.
    """
    distinct = df.select(group, name).where(F.col(name).isNotNull()).distinct()
    return distinct.groupBy(group).agg(
        F.array_join(F.array_sort(F.collect_list(name)), separator).alias("names"),
        F.count("*").alias("name_count"),
    )
