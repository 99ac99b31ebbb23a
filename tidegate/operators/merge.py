"""Applying work rows to a target: update, insert, delete, all three at once, full replacement.

The work side has to be unique by converted key, which the duplicate check ensures by flagging every copy. The
target may be far larger than the work rows, so it stays on the left of its join: small work sides are broadcast
by their measured size and the target is not shuffled at all, larger ones are joined by shuffle with hot target
keys split at run time. A full outer join would allow neither.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import fixed
from tidegate.functions.convert import to_target
from tidegate.functions.text import wall_time
from tidegate.model import LoadSpec, RunContext
from tidegate.operators.skew import present_keys
from tidegate.operators.work import rows_of_division

_DIVISION = "process_div"

RENEW = "renew"
"""An optional column of work rows: an upsert that takes the place of a deleted row, as a new one."""


def project_typed(work: DataFrame, spec: LoadSpec, ctx: RunContext, *kept: Column) -> DataFrame:
    """Control columns in the target's types, with fresh stamps, the division and the error flag."""
    flag = F.col("error_flg")
    now = wall_time(ctx.run_ts)
    return work.select(
        *(to_target(F.col(f"`{c.name}`"), c.type, flag).alias(c.name) for c in spec.columns),
        F.lit(fixed.ETL_ID).alias("create_id"),
        now.alias("create_dtt"),
        F.lit(fixed.ETL_ID).alias("last_upd_id"),
        now.alias("last_upd_dtt"),
        F.col(_DIVISION),
        flag,
        *kept,
    )


def _applied(work: DataFrame, target: DataFrame, spec: LoadSpec, ctx: RunContext, divisions: Sequence[str]) -> DataFrame:
    """Error-free typed rows of some divisions, in the target's own column types."""
    rows = work.where(F.col(_DIVISION).isin(*divisions) & ~F.col("error_flg"))
    renewed = F.col(RENEW) if RENEW in work.columns else F.lit(False)
    typed = project_typed(rows, spec, ctx, renewed.alias(RENEW))
    kinds = {f.name.lower(): f.dataType for f in target.schema.fields}
    return typed.select(
        *(F.col(f"`{n}`").try_cast(kinds[n.lower()]).alias(n) for n in spec.names),
        *fixed.STAMP_COLUMNS,
        _DIVISION,
        RENEW,
    )


def applied(work: DataFrame, target: DataFrame, spec: LoadSpec, ctx: RunContext) -> DataFrame:
    """The error-free rows that a merge applies, typed as the target is; of ``target`` only the schema counts."""
    return _applied(work, target, spec, ctx, [fixed.UPSERT, fixed.DELETE])


def _on(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"t.`{key}`") == F.col(f"w.`{key}`"))
    return condition


def _updated(target: DataFrame, rows: DataFrame, spec: LoadSpec) -> DataFrame:
    """Target rows left-joined to work rows: changed where an upsert matches, dropped where a delete does or a row that is
    to be renewed."""
    joined = target.alias("t").join(rows.alias("w"), _on(spec.keys), "left")
    division = F.col(f"w.{_DIVISION}")
    taken = {n.lower() for n in spec.names} | set(fixed.UPDATE_COLUMNS)
    columns = []
    for name in target.columns:
        own = F.col(f"t.`{name}`")
        if name.lower() in taken:
            own = F.when(division == fixed.UPSERT, F.col(f"w.`{name.lower()}`")).otherwise(own)
        columns.append(own.alias(name))
    return joined.where(division.isNull() | ((division != fixed.DELETE) & ~F.col(f"w.{RENEW}"))).select(*columns)


def new_rows(target: DataFrame, work: DataFrame, spec: LoadSpec, ctx: RunContext) -> DataFrame:
    """Error-free upserts whose key the target lacks, in the target's columns."""
    rows = _applied(work, target, spec, ctx, [fixed.UPSERT])
    keyless = F.lit(False)
    for key in spec.keys:
        keyless = keyless | F.col(key).isNull()
    keyed = rows.where(~keyless)
    present = present_keys(target, keyed.where(~F.col(RENEW)), spec.keys)
    # Rows without a key match nothing; they stay out of the join, where they would all meet in one task.
    fresh = keyed.join(present, spec.keys, "left_anti").unionByName(rows.where(keyless))
    names = {c.lower() for c in fresh.columns} - {_DIVISION, RENEW}
    return fresh.select(
        *(
            F.col(f"`{f.name}`") if f.name.lower() in names else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        )
    )


def update_from(target: DataFrame, work: DataFrame, spec: LoadSpec, ctx: RunContext) -> DataFrame:
    """The target with matching rows replaced by error-free upserts; creation stamps stay."""
    return _updated(target, _applied(work, target, spec, ctx, [fixed.UPSERT]), spec)


def insert_missing(target: DataFrame, work: DataFrame, spec: LoadSpec, ctx: RunContext) -> DataFrame:
    """The target plus the error-free upserts it lacks."""
    return target.unionByName(new_rows(target, work, spec, ctx))


def delete_using(target: DataFrame, work: DataFrame, spec: LoadSpec, ctx: RunContext) -> DataFrame:
    """The target without the rows that an error-free delete names."""
    rows = _applied(work, target, spec, ctx, [fixed.DELETE])
    return target.alias("t").join(rows.select(*spec.keys).alias("w"), _on(spec.keys), "left_anti")


def merge_work(target: DataFrame, work: DataFrame, spec: LoadSpec, ctx: RunContext) -> DataFrame:
    """Update, insert and delete in one plan; same result as the three in turn."""
    rows = applied(work, target, spec, ctx)
    return _updated(target, rows, spec).unionByName(new_rows(target, work, spec, ctx))


def touched_values(target: DataFrame, work: DataFrame, spec: LoadSpec, ctx: RunContext, part: str) -> DataFrame:
    """The values of a partition column whose partitions a merge changes: where matching target rows lie, and
    where updated and new rows go."""
    rows = applied(work, target, spec, ctx)
    matched = target.select(part, *spec.keys).join(rows.select(*spec.keys), spec.keys, "left_semi").select(part)
    incoming = rows.where(F.col(_DIVISION) == fixed.UPSERT).select(part)
    return matched.union(incoming).distinct()


def merge_partitions(
    target: DataFrame, work: DataFrame, spec: LoadSpec, ctx: RunContext, part: str, touched: Sequence[object]
) -> DataFrame:
    """The merged content of the touched partitions only. New rows are those whose key no partition holds."""
    rows = applied(work, target, spec, ctx)
    inside = _updated(target.where(in_values(part, touched)), rows, spec)
    return inside.unionByName(new_rows(target, work, spec, ctx))


def in_values(column: str, values: Sequence[object]) -> Column:
    """Membership in a literal list that may hold null."""
    known = [v for v in values if v is not None]
    condition = F.col(column).isin(*known) if known else F.lit(False)
    return condition | F.col(column).isNull() if len(known) < len(values) else condition


def replacement_rows(target: DataFrame, work: DataFrame, spec: LoadSpec, ctx: RunContext) -> DataFrame:
    """The whole new content of a target under full replacement."""
    rows = project_typed(rows_of_division(work, fixed.REPLACE, error_free=True), spec, ctx)
    names = {c.lower() for c in rows.columns}
    return rows.select(
        *(
            (F.col(f"`{f.name}`") if f.name.lower() in names else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        )
    )
