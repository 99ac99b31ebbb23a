"""Inventory output."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidegate.model import RunContext


def run_dt_path(base: str, ctx: RunContext) -> str:
    return f"{base.rstrip('/')}/run_dt={ctx.run_dt}"


def write_inventory_csv(rows: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with a header, one file per task. ``one_file`` is for listings that are known to be short."""
    (rows.coalesce(1) if one_file else rows).write.mode("overwrite").option("header", True).csv(path)
