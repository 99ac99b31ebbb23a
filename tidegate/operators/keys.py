"""Checks by key: duplicates within a load, deletes without a target row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import fixed
from tidegate.functions.convert import canonical_key, typed_key
from tidegate.model import INT_CASTS, LoadSpec
from tidegate.operators import skew
from tidegate.operators.rules import (
    DUPLICATE_AT,
    NO_TARGET_AT,
    duplicate_message,
    with_error_if,
)
from tidegate.operators.work import is_live, live_rows, rows_of_division
from tidegate.session import written

_COUNT = "row_cnt"
_ALL = "__all"
_FOUND = "__found"
_GONE = "__gone"


def duplicate_keys(work: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one live row, with the number of rows. Copies collapse before the shuffle."""
    counts = live_rows(work).groupBy(*keys).agg(F.count(F.lit(1)).alias(_COUNT))
    return counts.where(F.col(_COUNT) > 1)


def with_duplicate_count(
    work: DataFrame,
    keys: Sequence[str],
    counted: DataFrame | None = None,
    rows_per_group: int = skew.ROWS_PER_GROUP,
    broadcast_bytes: int = skew.BROADCAST_BYTES,
) -> DataFrame:
    """Add ``row_cnt``, the size of the row's duplicate group; null where the key is unique or null.

    ``counted`` may give the same rows before other columns were added, to keep the count's own plan short.
    """
    rows = work if counted is None else counted
    counts = rows.groupBy(*keys).agg(F.count_if(is_live()).alias(_COUNT), F.count(F.lit(1)).alias(_ALL))
    repeated = F.col(_COUNT) > 1
    # Rows without a division are joined too, so they count for the layout.
    lookup = counts.where(repeated | (F.col(_ALL) > rows_per_group)).withColumn(_COUNT, F.when(repeated, F.col(_COUNT)))
    return skew.lookup_join(work, lookup, keys, [_COUNT], _ALL, rows_per_group, broadcast_bytes)


def rows_with_duplicate_key(work: DataFrame, keys: Sequence[str], **layout: int) -> DataFrame:
    """All copies of rows whose key occurs more than once."""
    return with_duplicate_count(work, keys, **layout).where(F.col(_COUNT).isNotNull()).drop(_COUNT)


def check_duplicates(
    work: DataFrame, spec: LoadSpec, counted: DataFrame | None = None, typed: bool = True, within: Sequence[str] = (),
    **layout: int,
) -> DataFrame:
    """Add the duplicate-key error to all copies; ``within`` names columns that copies share besides the key.

    Keys compare in the spelling they convert to, so that ``1`` and ``01`` cannot both reach the target. With ``typed``
    off, no type rule keeps ill-typed keys out, and they compare as what they convert to.
    """
    canonical = {f"__key{i}": canonical_key(spec.column(k), typed) for i, k in enumerate(spec.keys)}
    names = list(canonical)
    marked = with_duplicate_count(
        work.withColumns(canonical), [*names, *within], None if counted is None else counted.withColumns(canonical), **layout
    )
    found = F.col(_COUNT).isNotNull()
    checked = with_error_if(marked, found, DUPLICATE_AT, "Error004", None, duplicate_message(spec.key_labels))
    return checked.drop(_COUNT, *names)


def delete_keys(spec: LoadSpec) -> dict[str, Column]:
    """Typed keys of delete rows; null for all other rows."""
    is_delete = F.col("process_div") == fixed.DELETE
    return {
        f"__key{i}": F.when(is_delete, typed_key(F.col(f"`{k}`"), spec.column(k).type))
        for i, k in enumerate(spec.keys)
    }


def target_keys(target: DataFrame, spec: LoadSpec, *kept: Column | str) -> DataFrame:
    """Target keys in the types that work keys are compared in, and the ``kept`` columns."""
    columns = []
    for i, key in enumerate(spec.keys):
        family = spec.column(key).type.family
        value = F.col(f"`{key}`")
        if family in INT_CASTS:
            value = value.cast("bigint")
        elif family in ("float", "decimal"):
            value = value.cast("double")
        columns.append(value.alias(f"__key{i}"))
    return target.select(*columns, *kept)


def _with_missing(
    work: DataFrame,
    target: DataFrame,
    spec: LoadSpec,
    counted: DataFrame | None = None,
    rows_per_group: int = skew.ROWS_PER_GROUP,
    broadcast_bytes: int = skew.BROADCAST_BYTES,
) -> tuple[DataFrame, Column, list[str]]:
    """Rows with helper columns, and the condition that a row is a delete without a target row."""
    typed = delete_keys(spec)
    names = list(typed)
    unreadable = F.lit(False)
    for name in names:
        unreadable = unreadable | F.col(name).isNull()
    rows = work if counted is None else counted
    wanted = written(rows.withColumns(typed).groupBy(*names).agg(F.count(F.lit(1)).alias(_ALL)), "wanted")
    present = skew.present_keys(target_keys(target, spec), wanted.where(~unreadable), names)
    found = wanted.join(present.withColumn(_FOUND, F.lit(True)), names, "left")
    gone = ~unreadable & F.col(_FOUND).isNull()
    lookup = found.select(*names, _ALL, F.when(gone, True).alias(_GONE)).where(
        F.col(_GONE) | (F.col(_ALL) > rows_per_group)
    )
    marked = skew.lookup_join(work.withColumns(typed), lookup, names, [_GONE], _ALL, rows_per_group, broadcast_bytes)
    missing = (F.col("process_div") == fixed.DELETE) & (unreadable | F.col(_GONE).isNotNull())
    return marked, missing, [_GONE, *names]


def delete_target_missing(work: DataFrame, target: DataFrame, spec: LoadSpec, **layout: int) -> DataFrame:
    """Delete rows whose key has no target row. A key that cannot be read as the target's type has none."""
    deletes = rows_of_division(work, fixed.DELETE)
    marked, missing, helpers = _with_missing(deletes, target, spec, **layout)
    return marked.where(missing).drop(*helpers)


def check_delete_targets(
    work: DataFrame, target: DataFrame, spec: LoadSpec, counted: DataFrame | None = None, **layout: int
) -> DataFrame:
    """Add the missing-target error to delete rows."""
    marked, missing, helpers = _with_missing(work, target, spec, counted, **layout)
    label = ",".join(k.upper() for k in spec.keys)
    checked = with_error_if(marked, missing, NO_TARGET_AT, "Error001", label, fixed.MESSAGES["Error001"])
    return checked.drop(*helpers)


def customer_errors(work: DataFrame, customer_id: str, column: str = "customer_id") -> DataFrame:
    """Live rows of another customer than the run's; any such row stops the load."""
    return live_rows(work).where(F.col(column) != customer_id)


def flag_by_row_id(work: DataFrame, ids: DataFrame, row_id: str, **layout: int) -> DataFrame:
    """Set the error flag of the rows whose id is listed."""
    listed = ids.groupBy(row_id).agg(F.count(F.lit(1)).alias(_ALL)).withColumn(_FOUND, F.lit(True))
    marked = skew.lookup_join(work, listed, [row_id], [_FOUND], _ALL, **layout)
    return marked.withColumn("error_flg", F.col("error_flg") | F.coalesce(_FOUND, F.lit(False))).drop(_FOUND)
