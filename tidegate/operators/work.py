"""Work rows: every business column as text, plus the system columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import fixed
from tidegate.functions.text import as_text, normalise_null_text, strip_backslash, wall_time
from tidegate.model import LoadSpec, RunContext


def to_text_row(source: DataFrame, names: list[str], strip: bool = True) -> DataFrame:
    """The control columns in control order as normalised text. Column names match in lower case."""
    fields = {f.name.lower(): f for f in source.schema.fields}
    columns = []
    for name in names:
        field = fields[name.lower()]
        text = normalise_null_text(as_text(F.col(f"`{field.name}`"), field.dataType))
        columns.append((strip_backslash(text) if strip else text).alias(name))
    extra = [F.col(f"`{f.name}`").alias(n) for n, f in fields.items() if n == "process_div" and n not in names]
    return source.select(*columns, *extra)


def stamp_system_columns(work: DataFrame, ctx: RunContext) -> DataFrame:
    """System columns of freshly loaded rows: an upsert unless the source names a division, no error yet."""
    now = wall_time(ctx.run_ts)
    division = F.col("process_div") if "process_div" in work.columns else F.lit(fixed.UPSERT)
    return work.withColumns(
        {
            "process_div": division,
            "create_id": F.lit(fixed.ETL_ID),
            "create_dtt": now,
            "last_upd_id": F.lit(fixed.ETL_ID),
            "last_upd_dtt": now,
            "error_flg": F.lit(False),
        }
    )


def to_work(source: DataFrame, spec: LoadSpec, ctx: RunContext) -> DataFrame:
    return stamp_system_columns(to_text_row(source, spec.names), ctx)


def is_live() -> Column:
    return F.col("process_div").isNotNull() & (F.col("process_div") != "")


def live_rows(work: DataFrame) -> DataFrame:
    return work.where(is_live())


def rows_of_division(work: DataFrame, division: str, error_free: bool = False) -> DataFrame:
    rows = work.where(F.col("process_div") == division)
    return rows.where(~F.col("error_flg")) if error_free else rows


def invalid_division(work: DataFrame) -> DataFrame:
    return live_rows(work).where(~F.col("process_div").isin(*fixed.DIVISIONS))


def division_columns(count_error: bool = True) -> list[Column]:
    """Row counts per division U, D, L and of invalid divisions, as aggregate columns."""
    counted = F.lit(True) if count_error else ~F.col("error_flg")
    division = F.col("process_div")
    return [
        F.count_if((division == fixed.UPSERT) & counted).alias("update_num"),
        F.count_if((division == fixed.DELETE) & counted).alias("delete_num"),
        F.count_if((division == fixed.REPLACE) & counted).alias("laundering_num"),
        F.count_if(is_live() & ~division.isin(*fixed.DIVISIONS) & counted).alias("invalid_num"),
    ]


def work_columns() -> list[Column]:
    """All rows, rows in error, rows to apply and live rows, as aggregate columns."""
    applied = F.col("process_div").isin(*fixed.DIVISIONS) & ~F.col("error_flg")
    return [
        F.count(F.lit(1)).alias("total_num"),
        F.count_if(F.col("error_flg")).alias("error_num"),
        F.count_if(applied).alias("normal_num"),
        F.count_if(is_live()).alias("live_num"),
    ]


def division_counts(work: DataFrame, count_error: bool = True) -> DataFrame:
    return work.agg(*division_columns(count_error))


def work_counts(work: DataFrame) -> DataFrame:
    return work.agg(*work_columns())


def file_divisions(counts: DataFrame) -> DataFrame:
    """Division check of a whole load: the Fatal code that stops it, or null."""
    update, delete, replace = F.col("update_num"), F.col("delete_num"), F.col("laundering_num")
    return counts.withColumn(
        "code",
        F.when((update + delete + replace == 0) & (F.col("invalid_num") != 0), "Fatal018").when(
            (replace != 0) & (update + delete != 0), "Fatal019"
        ),
    )
