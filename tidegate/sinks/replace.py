"""Putting a new content in a target table's place."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidegate.session import remove_folder


def _fresh_folder(root: str, version: str) -> str:
    # Unique: a repeated run must not write over the folder that the table still reads.
    return f"{root}/{version}-{uuid.uuid4().hex[:8]}"


def create_versioned(rows: DataFrame, table: str, root: str, version: str, parts: Sequence[str] = ()) -> None:
    """A table over a version folder, to be replaced by :func:`swap_location` or :func:`swap_partitions`."""
    spark = rows.sparkSession
    path = _fresh_folder(root, version)
    if not parts:
        rows.write.parquet(path)
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    listed = ", ".join(f"`{p}`" for p in parts)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({listed}) LOCATION '{path}'")
    swap_partitions(rows, table, [], root, version)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _location(spark: SparkSession, table: str, partition: str = "") -> str:
    described = spark.sql(f"DESCRIBE FORMATTED {table} {f'PARTITION {partition}' if partition else ''}")
    return described.where(F.col("col_name") == "Location").first()["data_type"]


def swap_location(rows: DataFrame, table: str, root: str, version: str, keep_old: bool = True) -> None:
    """Write a new version folder, then point the table at it in one catalogue step.

    Readers see the old content or the new. A failed write leaves the table as it was. The old folder stays for a
    way back and for readers that are under way, unless ``keep_old`` is off.
    """
    spark = rows.sparkSession
    path, before = _fresh_folder(root, version), _location(spark, table)
    rows.write.parquet(path)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    if not keep_old:
        remove_folder(spark, before)


def _partition(row: Row, parts: Sequence[str]) -> str:
    def literal(value: object) -> str:
        if value is None:
            return "NULL"
        text = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"'{text}'"

    return "(" + ", ".join(f"`{p}` = {literal(row[p])}" for p in parts) + ")"


def _journal(table: str, root: str) -> str:
    return f"{root}/_switch/{table}"


def _take(spark: SparkSession, table: str, steps: Sequence[str]) -> None:
    for statement in steps:
        spark.sql(statement)
    spark.catalog.refreshTable(table)


def finish_switch(spark: SparkSession, table: str, root: str) -> bool:
    """Complete a switch of partitions that broke off: each step may be done again. Tells whether there was one."""
    journal = spark._jvm.org.apache.hadoop.fs.Path(_journal(table, root))
    system = journal.getFileSystem(spark._jsc.hadoopConfiguration())
    # Without the mark of a finished write no step was taken yet.
    if not system.exists(spark._jvm.org.apache.hadoop.fs.Path(journal, "_SUCCESS")):
        return False
    noted = spark.read.schema("step long, statement string").json(_journal(table, root)).orderBy("step").collect()
    _take(spark, table, [r["statement"] for r in noted])
    remove_folder(spark, _journal(table, root))
    return True


def swap_partitions(
    rows: DataFrame, table: str, old: Sequence[Row], root: str, version: str, keep_old: bool = True
) -> None:
    """Write new content for some partitions, then point each of them at its new folder.

    ``old`` names the partitions that ``rows`` stands for; those without rows any more are dropped. Partitions not
    named are neither read nor written. Each step switches one partition from its old content to its new one. All steps
    are noted below ``root`` before the first is done: :func:`finish_switch` does them again where a run broke off, and
    a load calls it before it reads the table.
    """
    spark = rows.sparkSession
    finish_switch(spark, table, root)
    parts = partition_columns(spark, table)
    path = _fresh_folder(root, version)
    before = [] if keep_old else [_location(spark, table, _partition(row, parts)) for row in old]
    rows.hint("rebalance", *(F.col(f"`{p}`") for p in parts)).write.partitionBy(*parts).parquet(path)
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    folder = F.regexp_replace(file, "/[^/]+$", "").alias("__folder")
    new = spark.read.schema(rows.schema).parquet(path).select(*parts, folder).distinct().collect()
    steps = []
    for row in new:
        spec = _partition(row, parts)
        target = row["__folder"].replace("\\", "\\\\").replace("'", "\\'")
        steps.append(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION {spec} LOCATION '{target}'")
        steps.append(f"ALTER TABLE {table} PARTITION {spec} SET LOCATION '{target}'")
    kept = {_partition(row, parts) for row in new}
    gone = [_partition(row, parts) for row in old if _partition(row, parts) not in kept]
    if gone:
        steps.append(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION {p}" for p in gone))
    journal = _journal(table, root)
    noted = spark.createDataFrame(list(enumerate(steps)), "step long, statement string")
    noted.coalesce(1).write.mode("overwrite").json(journal)
    _take(spark, table, steps)
    remove_folder(spark, journal)
    for folder in before:
        remove_folder(spark, folder)


def replace_table(rows: DataFrame, table: str) -> None:
    """Full replacement by renaming: fill ``tmp_``, live to ``_bk``, new to live, drop ``_bk``."""
    spark: SparkSession = rows.sparkSession
    schema, _, name = table.rpartition(".")
    prefix = f"{schema}." if schema else ""
    fresh, old = f"{prefix}tmp_{name}", f"{prefix}{name}_bk"
    spark.sql(f"CREATE TABLE {fresh} LIKE {table} USING parquet")
    rows.write.mode("append").insertInto(fresh)
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    spark.sql(f"DROP TABLE {old}")
