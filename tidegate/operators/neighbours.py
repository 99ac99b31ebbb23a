"""Previous and next values along an order, without giving one task a whole key.

Rows are cut into slots of similar size along the time axis. Within a slot an ordinary window finds the
neighbour; across slots the last value of each (key, slot) is carried over from a small aggregate. Where too many
rows of a key share one moment, or slots are too many for a list of bounds, slots are ranges of the whole order
instead, ties included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.session import written

ROWS_PER_SLOT = 2_000_000
MAX_SLOTS = 4_096
CROWDED = 10

_SLOT = "__slot"
_VALUE = "__value"
_ORDER = "__order"
_NEAR = "__near"
_CARRY = "__carry"


def _seconds(time: str) -> Column:
    return F.unix_micros(F.col(f"`{time}`").cast("timestamp")) / F.lit(1_000_000)


def slot_bounds(df: DataFrame, time: str, slots: int) -> list[float]:
    """Times that cut the rows into about ``slots`` slots."""
    if slots < 2:
        return []
    shares = [i / slots for i in range(1, slots)]
    bounds = df.agg(F.percentile_approx(_seconds(time), shares, 10 * MAX_SLOTS).alias("b")).first()["b"]
    return sorted(set(bounds or []))


def _slot(time: str, bounds: list[float]) -> Column:
    """Number of bounds at or below the time; -1 for no time, which comes first in the order."""
    return F.when(F.col(f"`{time}`").isNull(), F.lit(-1)).otherwise(_place(time, bounds))


def _place(time: str, bounds: list[float]) -> Column:
    """Number of bounds at or below the time, as a balanced tree of comparisons on a literal list."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(_seconds(time) < bounds[middle], search(low, middle)).otherwise(search(middle + 1, high))

    if len(bounds) <= 64:
        return search(0, len(bounds))
    # Two levels: a coarse tree picks a short list that is then counted.
    step = -(-len(bounds) // 64)
    chunks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    slot = None
    for start, chunk in zip(range(0, len(bounds), step), chunks):
        count = start + F.size(F.filter(F.lit(chunk), lambda b: b <= _seconds(time)))
        inside = _seconds(time) < F.lit(chunk[-1])
        slot = F.when(inside, count) if slot is None else slot.when(inside, count)
    return slot.otherwise(F.lit(len(bounds)))


def _slotted(rows: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str], rows_per_slot: int) -> DataFrame | None:
    """Rows with a slot number that grows along the order, or None if they are few enough for plain windows."""
    total = rows.count()
    if total <= rows_per_slot:
        return None
    slots = -(-total // rows_per_slot)
    if slots <= MAX_SLOTS:
        slotted = rows.withColumn(_SLOT, _slot(time, slot_bounds(rows, time, slots)))
        sizes = slotted.groupBy(*keys, _SLOT).agg(F.count(F.lit(1)).alias("n"))
        if sizes.agg(F.max("n")).first()[0] <= CROWDED * rows_per_slot:
            return slotted
    # Written, so that every later reader sees the same ranges.
    order = [F.col(f"`{c}`") for c in (*keys, time, *ties)]
    ranges = rows.repartitionByRange(slots, *order)
    return written(ranges.withColumn(_SLOT, F.spark_partition_id()), "ranges")


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    ties: Sequence[str],
    value: Column,
    name: str,
    following: bool = False,
    rows_per_slot: int = ROWS_PER_SLOT,
) -> DataFrame:
    """Add ``name``: the nearest non-null ``value`` strictly before (or after) each row of its key.

    ``time`` and ``ties`` must order the rows of a key completely.
    """
    columns = df.columns
    order = [F.col(f"`{c}`").desc() if following else F.col(f"`{c}`").asc() for c in (time, *ties)]
    near = F.last(_VALUE, ignorenulls=True)
    rows = df.withColumn(_VALUE, value)
    slotted = _slotted(rows, keys, time, ties, rows_per_slot)
    if slotted is None:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.select(*columns, near.over(window).alias(name))

    window = Window.partitionBy(*keys, _SLOT).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = slotted.withColumn(_NEAR, near.over(window))
    # The value a slot hands on is its outermost non-null one: a partial aggregate, one row per key and slot.
    rank = F.struct(*(F.col(f"`{c}`") for c in (time, *ties)))
    edge = F.min_by if following else F.max_by
    ends = slotted.groupBy(*keys, _SLOT).agg(
        edge(F.col(_VALUE), F.when(F.col(_VALUE).isNotNull(), rank)).alias(_VALUE)
    )
    slot_order = F.col(_SLOT).desc() if following else F.col(_SLOT).asc()
    across = Window.partitionBy(*keys).orderBy(slot_order).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, _SLOT, near.over(across).alias(_CARRY))
    same = F.lit(True)
    for key in (*keys, _SLOT):
        same = same & F.col(f"l.`{key}`").eqNullSafe(F.col(f"r.`{key}`"))
    joined = inside.alias("l").join(carried.alias("r"), same, "left")
    return joined.select(
        *(F.col(f"l.`{c}`") for c in columns),
        F.coalesce(F.col(f"l.{_NEAR}"), F.col(f"r.{_CARRY}")).alias(name),
    )
