"""Warehouse layers: marts, history, views that survive schema changes, row and layer access."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import fixed
from tidegate.operators.neighbours import ROWS_PER_SLOT, with_neighbour
from tidegate.session import written


def build_mart(
    facts: DataFrame,
    fact_key: str,
    period: Column,
    measures: dict[str, Column],
    dimension: DataFrame,
    dimension_key: str,
    groups: Sequence[str],
) -> DataFrame:
    """Sums of fact measures and a row count per period and dimension attributes.

    Facts are summed per key and period before they meet the dimension: a key with a large share of the facts
    crosses the shuffle as one row per task and period.
    """
    partial = facts.groupBy(F.col(fact_key).alias("__key"), period.alias("period")).agg(
        F.count(F.lit(1)).alias("__rows"), *(F.sum(m).alias(n) for n, m in measures.items())
    )
    attributes = dimension.select(F.col(dimension_key).alias("__key"), *groups)
    return (
        partial.join(attributes, "__key")
        .groupBy("period", *groups)
        .agg(F.sum("__rows").alias("row_cnt"), *(F.sum(n).alias(n) for n in measures))
    )


def keep_history(
    snapshots: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    time: str,
    ties: Sequence[str],
    rows_per_slot: int = ROWS_PER_SLOT,
) -> DataFrame:
    """Validity periods of a key's attribute values: a new period starts where any attribute changes.

    Result: keys, attributes, ``valid_from``, ``valid_to`` (null for the current period) and ``is_current``.
    """
    state = F.struct(*(F.col(a) for a in attributes))
    before = with_neighbour(snapshots, keys, time, ties, state, "__before", rows_per_slot=rows_per_slot)
    changed = F.col("__before").isNull()
    for name in attributes:
        changed = changed | ~F.col(name).eqNullSafe(F.col(f"__before.{name}"))
    starts = written(before.where(changed).select(*keys, *attributes, time, *ties), "starts")
    ended = with_neighbour(
        starts, keys, time, ties, F.col(time), "valid_to", following=True, rows_per_slot=rows_per_slot
    )
    return ended.select(
        *keys, *attributes, F.col(time).alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current")
    )


def _in_keys(rows: DataFrame, keys: DataFrame, names: Sequence[str], how: str = "left_semi") -> DataFrame:
    same = F.lit(True)
    for name in names:
        same = same & F.col(f"l.`{name}`").eqNullSafe(F.col(f"r.`{name}`"))
    return rows.alias("l").join(keys.select(*names).alias("r"), same, how)


def extend_history(
    history: DataFrame,
    stored: DataFrame,
    snapshots: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    time: str,
    ties: Sequence[str],
    rows_per_slot: int = ROWS_PER_SLOT,
) -> DataFrame:
    """The history of ``stored`` and new ``snapshots``, from the history of ``stored``.

    Keys without new snapshots keep their periods as they are. Of a key whose new snapshots all come after the stored
    ones only the open period takes part. A key with a late snapshot, at or before one that is stored, is made anew from
    all of its snapshots: a late one may split a period whose later confirmations left no trace in the history.
    """
    names = [*keys, *attributes, time, *ties]
    last = stored.groupBy(*keys).agg(F.max(time).alias("__last"))
    first = snapshots.groupBy(*keys).agg(F.min(time).alias("__first"), F.bool_or(F.col(time).isNull()).alias("__open"))
    same = F.lit(True)
    for name in keys:
        same = same & F.col(f"f.`{name}`").eqNullSafe(F.col(f"s.`{name}`"))
    late = F.coalesce(F.col("__open") | (F.col("__first") <= F.col("__last")), F.lit(False))
    touched = first.alias("f").join(last.alias("s"), same, "left").select(*(F.col(f"f.`{k}`") for k in keys), late.alias("__late"))
    touched = written(touched, "touched")
    late_keys, others = touched.where("__late"), touched.where("NOT __late")

    again = _in_keys(stored.select(*names).unionByName(snapshots.select(*names)), late_keys, keys)
    going_on = _in_keys(history.where("is_current"), others, keys).withColumn(time, F.col("valid_from"))
    missing = {t: F.lit(None).cast(snapshots.schema[t].dataType) for t in ties}
    going_on = going_on.withColumns(missing).select(*names).unionByName(_in_keys(snapshots.select(*names), others, keys))
    untouched = _in_keys(history, touched, keys, "left_anti")
    closed = _in_keys(history.where("NOT is_current"), others, keys)
    made = keep_history(going_on.unionByName(again), keys, attributes, time, ties, rows_per_slot)
    return untouched.unionByName(closed).unionByName(made)


def evolving_view(spark: SparkSession, name: str, table: str) -> None:
    """A catalogue view of a table that is resolved whenever it is read: columns the table gains, loses or changes after
    the view was made are the view's as well."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} WITH SCHEMA EVOLUTION AS SELECT * FROM {table}")


def late_binding_view(spark: SparkSession, name: str, *readers: Callable[[], DataFrame]) -> DataFrame:
    """(Re)define a view over datasets whose schemas may have moved on; missing columns read as null."""
    whole = readers[0]()
    for reader in readers[1:]:
        whole = whole.unionByName(reader(), allowMissingColumns=True)
    whole.createOrReplaceTempView(name)
    return whole


def row_level_filter(rows: DataFrame, entitlements: DataFrame, principal: str, on: Sequence[str]) -> DataFrame:
    """The rows a principal may see: those whose ``on`` values the entitlement table lists for it."""
    allowed = entitlements.where(F.col("principal") == principal).select(*on)
    return rows.join(allowed, list(on), "left_semi")


def layer_access(requests: DataFrame) -> DataFrame:
    """Add ``allowed``: whether the request's ``role`` holds ``privilege`` on ``layer``."""
    granted = F.lit(False)
    for role, layer, privilege in fixed.LAYER_GRANTS:
        granted = granted | (
            (F.col("role") == role) & (F.col("layer") == layer) & (F.col("privilege") == privilege)
        )
    return requests.withColumn("allowed", F.coalesce(granted, F.lit(False)))
