"""The error and run log: its rows, notices, profile, summary and timings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import fixed
from tidegate.functions.text import (
    action_text,
    fill,
    format_message,
    key_text,
    level_of_code,
    null_if_blank,
    wall_time,
)
from tidegate.model import LOG_SCHEMA, LoadSpec, RunContext
from tidegate.operators.neighbours import ROWS_PER_SLOT, with_neighbour
from tidegate.operators.rules import ERRORS
from tidegate.operators.work import division_columns, work_columns


def _log_columns(ctx: RunContext, **values: Column) -> list[Column]:
    now = wall_time(ctx.run_ts)
    fixed_values = {
        "process_id": F.lit(ctx.process_id),
        "create_id": F.lit(fixed.ETL_ID),
        "create_dtt": now,
        "last_upd_id": F.lit(fixed.ETL_ID),
        "last_upd_dtt": now,
        "customer_id": F.lit(ctx.customer_id),
    }
    given = {**fixed_values, **values}
    return [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA.fields]


def error_log(work: DataFrame, spec: LoadSpec, ctx: RunContext, kept: Sequence[str] = ()) -> DataFrame:
    """One log row per error of a checked work frame, with the ``kept`` columns of its row."""
    rows = work.where(F.size(ERRORS) > 0).select(
        key_text(spec.keys).alias("key"), F.explode(ERRORS).alias("e"), *kept
    )
    level = level_of_code(F.col("e.code"))
    message = format_message(ctx, level, F.col("e.message"), F.lit(spec.table), F.col("key"))
    return rows.select(
        *_log_columns(
            ctx,
            level=level,
            message_cd=F.col("e.code"),
            message=message,
            target_file=F.lit(spec.table),
            item=null_if_blank(F.col("e.item")),
            occurred_key=null_if_blank(F.col("key")),
            seq=F.col("e.ordinal"),
        ),
        *kept,
    )


def run_lines(spark: SparkSession, ctx: RunContext, lines: Sequence[dict], kept: Sequence[str] = ()) -> DataFrame:
    """Log rows of a run's own steps: dicts of ``code, message`` and any of
    ``file, item, total, normal, error, seq``. Zero counts are kept, missing ones are null. ``kept`` names further texts
    of the dicts that become columns."""
    schema = "code string, message string, file string, item string, total long, normal long, error long, seq int"
    schema += "".join(f", {name} string" for name in kept)
    names = [part.split()[0] for part in schema.split(", ")]
    rows = spark.createDataFrame([tuple(line.get(n) for n in names) for line in lines], schema)
    level = level_of_code(F.col("code"))
    return rows.select(
        *_log_columns(
            ctx,
            level=level,
            message_cd=F.col("code"),
            message=format_message(ctx, level, F.col("message"), F.col("file")),
            target_file=null_if_blank(F.col("file")),
            item=null_if_blank(F.col("item")),
            total_num=F.col("total"),
            normal_num=F.col("normal"),
            error_num=F.col("error"),
            seq=F.col("seq"),
        ),
        *kept,
    )


def collect_errors(*logs: DataFrame) -> DataFrame:
    """All logs of a run in one."""
    whole = logs[0]
    for log in logs[1:]:
        whole = whole.unionByName(log)
    return whole


def first_alert_per_table(log: DataFrame) -> DataFrame:
    """The first Error and the first Fatal line of each table: the lines that send a notice.

    An aggregate rather than a window: it combines before the shuffle, whatever the number of lines per table.
    """
    alerts = log.where(F.col("level").isin("Error", "Fatal"))
    first = F.min(F.struct("seq", "occurred_key", "message_cd", "item", "message")).alias("first")
    return alerts.groupBy("target_file", "level").agg(first).select("target_file", "level", "first.*")


def error_profile(log: DataFrame) -> DataFrame:
    return log.groupBy("level", "message_cd", "item").agg(F.count(F.lit(1)).alias("lines"))


def run_summary(work: DataFrame, spec: LoadSpec, by: Sequence[str] = ()) -> DataFrame:
    """One row for a checked table, or for each of its parts: counts, what was done, and the two closing messages."""
    counts = work.groupBy(*by).agg(*work_columns(), *division_columns(count_error=False))
    action = action_text(F.col("laundering_num") > 0, F.col("update_num") > 0, F.col("delete_num") > 0)
    done = counts.withColumn("action", action)
    text = {n: F.col(f"{n}_num").cast("string") for n in ("total", "normal", "error")}
    target = spec.target_table or spec.table
    return done.select(
        *by,
        F.lit(spec.table).alias("target_file"),
        "total_num",
        "normal_num",
        "error_num",
        "action",
        fill(fixed.MESSAGES["Info004"], table=target, count=text["normal"], action=F.col("action")).alias("applied"),
        fill(fixed.MESSAGES["Info005"], **text).alias("totals"),
    )


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def step_elapsed(
    lines: DataFrame, run: str, time: str, ties: Sequence[str], rows_per_slot: int = ROWS_PER_SLOT
) -> DataFrame:
    """Add ``elapsed_s``: seconds since the run's previous line; zero for its first."""
    before = with_neighbour(lines, [run], time, ties, F.col(time), "__before", rows_per_slot=rows_per_slot)
    elapsed = (_micros(time) - _micros("__before")) / F.lit(1_000_000)
    return before.withColumn("elapsed_s", F.coalesce(elapsed, F.lit(0.0))).drop("__before")


def span_totals(
    marks: DataFrame, run: str, title: str, status: str, time: str, ties: Sequence[str], rows_per_slot: int = ROWS_PER_SLOT
) -> DataFrame:
    """Total seconds per run and title. Each ``end`` mark counts from the last ``start`` mark before it."""
    start = F.when(F.col(status) == "start", F.col(time))
    marked = with_neighbour(marks, [run, title], time, ties, start, "__start", rows_per_slot=rows_per_slot)
    spent = F.when((F.col(status) == "end") & F.col("__start").isNotNull(), _micros(time) - _micros("__start"))
    sums = marked.groupBy(run, title).agg(F.sum(spent).alias("us"), F.count(spent).alias("spans"))
    return sums.select(run, title, "spans", (F.col("us") / F.lit(1_000_000)).alias("total_s"))
