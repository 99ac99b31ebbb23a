"""Appending to a database table through Spark's JDBC sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tidegate import fixed


def insert_options(
    url: str, table: str, *, properties: Mapping[str, str] | None = None, writers: int = 8
) -> dict[str, str]:
    """Writer options: blocks of a fixed number of rows, from at most ``writers`` connections."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(fixed.BLOCK_ROWS),
        "numPartitions": str(writers),
        **(properties or {}),
    }


def bulk_insert(rows: DataFrame, options: Mapping[str, str]) -> None:
    rows.write.format("jdbc").options(**options).mode("append").save()
