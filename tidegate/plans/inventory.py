"""Inventory job: three catalogue views in, three listings out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidegate.model import RunContext
from tidegate.operators import inventory
from tidegate.sinks.inventory import run_dt_path, write_inventory_csv


def run_inventory(objects: DataFrame, tables: DataFrame, columns: DataFrame, base: str, ctx: RunContext) -> str:
    """Write schemas, tables and columns below ``run_dt=``; returns that folder."""
    folder = run_dt_path(base, ctx)
    write_inventory_csv(inventory.schema_inventory(objects), f"{folder}/schemas")
    write_inventory_csv(inventory.table_inventory(tables, objects), f"{folder}/tables")
    write_inventory_csv(inventory.column_inventory(columns, objects), f"{folder}/columns")
    return folder
