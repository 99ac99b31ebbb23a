"""Inventory of a source database from its catalogue views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import fixed

TABLE_COLUMNS = ("owner", "table_name", "num_rows", "last_analyzed", "last_ddl_time")
COLUMN_COLUMNS = (
    "owner", "table_name", "object_type", "column_id", "column_name",
    "data_type", "data_length", "data_precision", "data_scale", "nullable",
)


def user_owner(owner: str = "owner") -> Column:
    """True for owners that are no system owners; null owners drop out."""
    return ~F.col(owner).isin(*fixed.SYSTEM_OWNERS)


def object_kind(kind: str = "object_type") -> Column:
    return F.col(kind).isin(*fixed.OBJECT_KINDS)


def schema_inventory(objects: DataFrame) -> DataFrame:
    """Objects, tables and views per owner."""
    kept = objects.where(object_kind() & user_owner())
    counts = kept.groupBy("owner").agg(
        F.count(F.lit(1)).alias("total_objects"),
        F.count_if(F.col("object_type") == "TABLE").alias("tables"),
        F.count_if(F.col("object_type") == "VIEW").alias("views"),
    )
    return counts.orderBy("owner")


def table_inventory(tables: DataFrame, objects: DataFrame) -> DataFrame:
    """Every user table, with the time of its last definition change where an object entry has one."""
    kind = objects.where((F.col("object_type") == "TABLE") & user_owner()).select(
        "owner", F.col("object_name").alias("table_name"), "last_ddl_time"
    )
    joined = tables.where(user_owner()).join(kind, ["owner", "table_name"], "left")
    return joined.select(*TABLE_COLUMNS).orderBy("owner", "table_name")


def column_inventory(columns: DataFrame, objects: DataFrame) -> DataFrame:
    """Columns of user tables and views."""
    kind = objects.where(object_kind() & user_owner()).select(
        "owner", F.col("object_name").alias("table_name"), "object_type"
    )
    joined = columns.where(user_owner()).join(kind, ["owner", "table_name"], "inner")
    return joined.select(*COLUMN_COLUMNS).orderBy("owner", "table_name", "column_id")


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    return df.limit(rows)
