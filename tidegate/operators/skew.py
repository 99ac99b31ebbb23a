"""Joins against a unique lookup that stay even when one key holds a large share of the rows.

The lookup is written first, so its exact size is known: an empty one needs no join, a small one is broadcast and
the rows are not shuffled at all. A large one is joined by shuffle. Its counts tell which keys are hot; rows of a
hot key are dealt over several join groups and the lookup row is repeated once per group, so no task gets a whole
hot key. Which keys are treated as hot changes the layout only, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.session import written

ROWS_PER_GROUP = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_BYTES = 64
_ONCE = "__once"

_GROUPS = "__groups"
_GROUP = "__group"
_HASH = "__hash"


def _same(left: str, right: str, keys: Sequence[str], null_safe: bool = False) -> Column:
    condition = F.lit(True)
    for key in keys:
        ours, theirs = F.col(f"{left}.`{key}`"), F.col(f"{right}.`{key}`")
        condition = condition & (ours.eqNullSafe(theirs) if null_safe else ours == theirs)
    return condition


def _width(columns: Sequence[str]) -> Column:
    widths = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in columns]
    return sum(widths, F.lit(_ROW_BYTES))


def size_of(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes in memory of a (written) frame."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_width(df.columns)), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def hot_keys(counts: DataFrame, keys: Sequence[str], count: str, rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """All keys of more than ``rows_per_group`` rows, as a hash, with the number of groups each is dealt into.

    Twelve bytes for at least ``rows_per_group`` rows, 12 MB for 10^12 rows, so it can be broadcast. A key that shares a
    hot key's hash is dealt out on both sides like it, which changes nothing.
    """
    groups = F.ceil(F.col(count) / F.lit(rows_per_group)).cast("int")
    hot = counts.where(F.col(count) > rows_per_group).select(_hash(keys).alias(_HASH), groups.alias(_GROUPS))
    return hot.groupBy(_HASH).agg(F.max(_GROUPS).alias(_GROUPS))


def _hash(keys: Sequence[str]) -> Column:
    # The places of nulls count: a hash leaves them out.
    return F.xxhash64(*(F.col(f"`{k}`") for k in keys), *(F.col(f"`{k}`").isNull() for k in keys))


def _with_groups(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Null keys match nothing later on, yet they share a hash: a hot null is dealt out like any other key.
    marked = df.withColumn(_HASH, _hash(keys)).join(F.broadcast(hot), _HASH, "left").drop(_HASH)
    return marked.withColumn(_GROUPS, F.coalesce(_GROUPS, F.lit(1)))


def _dealt_join(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], values: Sequence[str], count: str, rows_per_group: int
) -> DataFrame:
    hot = hot_keys(lookup, keys, count, rows_per_group)
    # Full copies of a row share a hash, their task does not: the partition number deals them apart and is the
    # same again when a task is repeated.
    plain = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.AtomicType)]
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *(F.col(f"`{c}`") for c in plain)), F.col(_GROUPS))
    left = _with_groups(rows, hot, keys).withColumn(_GROUP, spread.cast("int")).drop(_GROUPS)
    right = _with_groups(lookup, hot, keys)
    right = right.withColumn(_GROUP, F.explode(F.sequence(F.lit(0), F.col(_GROUPS) - 1))).drop(_GROUPS)
    condition = _same("l", "r", keys) & (F.col(f"l.{_GROUP}") == F.col(f"r.{_GROUP}"))
    joined = left.alias("l").join(right.alias("r"), condition, "left")
    return joined.select(*(F.col(f"l.`{c}`") for c in rows.columns), *(F.col(f"r.`{v}`") for v in values))


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    count: str,
    rows_per_group: int = ROWS_PER_GROUP,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join of ``rows`` to a lookup that is unique by ``keys``, adding ``values``.

    ``count`` is the lookup's column with the number of ``rows`` that share the key; hot keys belong in the lookup
    even if they have no value to give. Null keys match nothing.
    """
    table = written(lookup, "lookup")
    held, size = size_of(table)
    if not held:
        kinds = {f.name: f.dataType for f in lookup.schema.fields}
        return rows.withColumns({v: F.lit(None).cast(kinds[v]) for v in values})
    if size > broadcast_bytes:
        return _dealt_join(rows, table, keys, values, count, rows_per_group)
    small = F.broadcast(table.select(*keys, *values))
    joined = rows.alias("l").join(small.alias("r"), _same("l", "r", keys), "left")
    return joined.select("l.*", *(F.col(f"r.`{v}`") for v in values))


def present_keys(target: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct ``wanted`` keys that occur in ``target``.

    Target keys collapse by partial counts first, so a hot key is one row per task before anything is shuffled. The
    result is no larger than ``wanted``.
    """
    names = list(keys)
    once = target.select(*names).groupBy(*names).agg(F.count(F.lit(1)).alias(_ONCE))
    return once.join(wanted.select(*names), names, "left_semi").select(*names)
