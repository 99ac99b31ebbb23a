"""Reading from a database through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidegate import fixed
from tidegate.model import RunContext


def jdbc_options(
    url: str,
    table: str,
    *,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower: object | None = None,
    upper: object | None = None,
    partitions: int = 16,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options. ``table`` is a table name or ``(SELECT ...) alias``; login data comes in ``properties``.

    With a partition column the read is cut into parallel ranges. The bounds only place the cuts: rows outside
    them are read by the outer ranges.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partition column needs both bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": _bound(lower),
            "upperBound": _bound(upper),
            "numPartitions": str(partitions),
        }
    return options


def _bound(value: object) -> str:
    return value.strftime("%Y-%m-%d %H:%M:%S") if isinstance(value, datetime) else str(value)


def incremental_options(url: str, table: str, ctx: RunContext, time: str = fixed.UPDATE_TIME, **more: object) -> dict[str, str]:
    """Options that read an incremental extract in parallel slices of its change time."""
    return jdbc_options(url, table, partition_column=time, lower=ctx.cutoff, upper=ctx.run_ts, **more)


def jdbc_query_scan(
    spark: SparkSession, options: Mapping[str, str], predicates: Sequence[str] | None = None
) -> DataFrame:
    """Rows of a table or sub-query. ``predicates`` (disjoint and complete conditions) give one partition each, for
    tables whose rows crowd at few values of any one column."""
    if not predicates:
        return spark.read.format("jdbc").options(**options).load()
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=list(predicates), properties=rest)
