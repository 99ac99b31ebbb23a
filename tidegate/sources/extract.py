"""Time-bounded extracts of a source table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import fixed
from tidegate.functions.text import wall_time
from tidegate.model import RunContext


def _bound(source: DataFrame, time: str, moment: datetime) -> Column:
    # In the column's own type: a cast on the column's side would keep the filter out of the scan.
    return wall_time(moment).cast(source.schema[time].dataType)


def incremental_extract(source: DataFrame, ctx: RunContext, time: str = fixed.UPDATE_TIME) -> DataFrame:
    """Rows changed at or after the cutoff; rows without a change time drop out."""
    return source.where(F.col(time) >= _bound(source, time, ctx.cutoff))


def bounded_extract(source: DataFrame, ctx: RunContext, time: str = fixed.UPDATE_TIME) -> DataFrame:
    """Rows changed between the cutoff and the run, both included."""
    return source.where(F.col(time).between(_bound(source, time, ctx.cutoff), _bound(source, time, ctx.run_ts)))


def sample_extract(source: DataFrame, rows: int = 1000) -> DataFrame:
    return source.limit(rows)


def external_scan(
    spark: SparkSession, path: str, columns: Sequence[str], partitions: Column | None = None
) -> DataFrame:
    """Named columns of a date-partitioned Parquet folder; ``partitions`` filters on partition columns."""
    scan = spark.read.parquet(path)
    if partitions is not None:
        scan = scan.where(partitions)
    return scan.select(*columns)
