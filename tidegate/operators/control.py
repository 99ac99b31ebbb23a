"""Control rows: which tables to load, by which columns and rules, and whether they are complete."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate import fixed
from tidegate.model import ControlColumn, LoadSpec, TargetType

_KNOWN_RULES = r"^(" + "|".join(fixed.VALUE_RULES) + r"|,)*\z"


def target_tables(controls: DataFrame) -> DataFrame:
    return controls.select("aurora_table").distinct()


def load_controls(controls: DataFrame, table: str | None = None) -> DataFrame:
    """Control rows in column order, of one table or of all."""
    if table is None:
        return controls.orderBy("aurora_table", "seq")
    return controls.where(F.col("aurora_table") == table).orderBy("seq")


def _lacks(rule: str, limit: str) -> Column:
    return F.count_if(F.col("validation").contains(rule) & F.col(limit).isNull())


def control_check_counts(controls: DataFrame) -> DataFrame:
    """All control checks of all tables in one aggregate."""
    unknown = (F.col("validation") != "") & ~F.col("validation").rlike(_KNOWN_RULES)
    return controls.groupBy("aurora_table").agg(
        F.count_if(F.col("search_key")).alias("key_rows"),
        _lacks(fixed.MAX_LENGTH, "max_length").alias("max_length_missing"),
        _lacks(fixed.MIN_LENGTH, "min_length").alias("min_length_missing"),
        _lacks(fixed.MAX_VALUE, "max_value").alias("max_value_missing"),
        _lacks(fixed.MIN_VALUE, "min_value").alias("min_value_missing"),
        F.count_if(unknown).alias("unknown_rules"),
    )


# (message text, counted column, item that tells apart checks sharing a code)
_CHECKS = (
    ("Fatal010", "key_rows", None),
    ("Fatal011", "unknown_rules", None),
    ("Fatal012", "max_length_missing", fixed.MAX_LENGTH),
    ("Fatal013", "min_length_missing", fixed.MIN_LENGTH),
    ("Fatal016max", "max_value_missing", fixed.MAX_VALUE),
    ("Fatal016min", "min_value_missing", fixed.MIN_VALUE),
)


def control_errors(controls: DataFrame) -> DataFrame:
    """One row per failed check: ``aurora_table, ordinal, code, item, message``."""
    found = []
    for ordinal, (text, column, item) in enumerate(_CHECKS, start=1):
        failed = F.col(column) == 0 if column == "key_rows" else F.col(column) > 0
        error = F.struct(
            F.lit(ordinal).alias("ordinal"),
            F.lit(text[:8]).alias("code"),
            F.lit(item).cast("string").alias("item"),
            F.lit(fixed.MESSAGES[text]).alias("message"),
        )
        found.append(F.when(failed, error))
    errors = F.explode(F.array_compact(F.array(*found))).alias("e")
    return control_check_counts(controls).select("aurora_table", errors).select("aurora_table", "e.*")


def target_column_types(target: DataFrame, named: Mapping[str, TargetType] | None = None) -> dict[str, TargetType]:
    """Catalogue type per lower-case column; ``named`` overrides types that Spark holds as text."""
    types = {f.name.lower(): TargetType.of(f.dataType) for f in target.schema.fields}
    return {**types, **(named or {})}


def load_specs(
    controls: DataFrame, types: Mapping[str, Mapping[str, TargetType]]
) -> Iterator[LoadSpec]:
    """Load specs of all tables in ``types``, by source table name.

    Control rows are configuration: one per target column. They are read once, for all tables.
    """
    rows = load_controls(controls).where(F.col("aurora_table").isin(*types)).collect()
    for table, group in itertools.groupby(rows, key=lambda r: r["aurora_table"]):
        own = list(group)
        columns = []
        for row in own:
            name = row["target_column"].lower()
            columns.append(
                ControlColumn(
                    name,
                    types[table].get(name, TargetType.of(T.StringType())),
                    bool(row["search_key"]),
                    row["validation"] or "",
                    row["max_length"],
                    row["min_length"],
                    row["max_value"],
                    row["min_value"],
                    row["target_column"],
                )
            )
        first = own[0]
        yield LoadSpec(
            table,
            tuple(columns),
            target_table=first["target_table"],
            target_schema=first["target_schema"],
            work_table=first["target_work_table"],
            work_schema=first["target_work_schema"],
            source_schema=first["aurora_schema"],
        )
