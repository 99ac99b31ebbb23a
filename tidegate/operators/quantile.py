"""Exact interpolated quantiles, overall or per group, without a single-task sort of all values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.session import written

LAST_STEP_VALUES = 1_000_000
SPLITS = 200

_ONE = "__all"


def _on_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Add per-group values; a null group is a group."""
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"l.`{key}`").eqNullSafe(F.col(f"r.`{key}`"))
    return rows.alias("l").join(groups.alias("r"), same).select("l.*", *(F.col(f"r.`{v}`") for v in values))


def _widest(rows: DataFrame, keys: Sequence[str]) -> int:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("d")).agg(F.max("d")).first()[0] or 0


def exact_quantile(
    df: DataFrame,
    value: str,
    share: float,
    name: str,
    by: Sequence[str] = (),
    last_step_values: int = LAST_STEP_VALUES,
) -> DataFrame:
    """Per group, or in one row: ``name`` (the ``share`` quantile, linear between neighbours) and ``n`` (values counted).

    Equal values collapse first. The distinct values of each group are then narrowed to the range that holds the
    wanted rank, about a hundredfold per round, until few enough are left for a running sum per group.
    """
    keys = list(by) or [_ONE]
    column = F.col(f"`{value}`").cast("double")
    grouped = df if by else df.withColumn(_ONE, F.lit(1))
    counts = grouped.where(column.isNotNull()).groupBy(*keys, column.alias("v")).agg(F.count(F.lit(1)).alias("c"))
    counts = written(counts, "counts")
    rank = F.lit(share) * (F.col("n") - 1)
    totals = counts.groupBy(*keys).agg(F.sum("c").alias("n")).withColumns(
        {"low": F.floor(rank), "high": F.ceil(rank), "part": rank - F.floor(rank), "before": F.lit(0).cast("bigint")}
    )
    inside = _on_groups(counts, written(totals, "totals"), keys, ["n", "low", "high", "part", "before"])

    distinct, splits = _widest(inside, keys), SPLITS
    while distinct > last_step_values:
        inside = written(_narrowed(inside, keys, splits), "inside")
        left = _widest(inside, keys)
        # Cuts too coarse to narrow the range are made finer.
        splits = splits if left < distinct else 2 * splits
        distinct = left

    running = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside.withColumn("upto", F.sum("c").over(running) + F.col("before"))
    found = ranked.groupBy(*keys, "n", "part").agg(
        F.min(F.when(F.col("upto") > F.col("low"), F.col("v"))).alias("a"),
        F.min(F.when(F.col("upto") > F.col("high"), F.col("v"))).alias("b"),
    )
    result = found.select(*keys, (F.col("a") + (F.col("b") - F.col("a")) * F.col("part")).alias(name), "n")
    if by:
        return result
    return result.agg(F.max(name).alias(name), F.coalesce(F.max("n"), F.lit(0).cast("bigint")).alias("n"))


def _narrowed(inside: DataFrame, keys: Sequence[str], splits: int = SPLITS) -> DataFrame:
    """The slots of each group's values that hold the wanted ranks; ``before`` counts the values below them."""
    shares = [i / splits for i in range(1, splits)]
    cuts = inside.groupBy(*keys).agg(F.percentile_approx("v", shares, 100 * splits).alias("cuts"))
    cuts = cuts.withColumn("cuts", F.array_distinct("cuts"))
    slot = F.size(F.filter("cuts", lambda cut: cut < F.col("v")))
    slotted = written(_on_groups(inside, written(cuts, "cuts"), keys, ["cuts"]).withColumn("slot", slot).drop("cuts"), "slots")
    sizes = slotted.groupBy(*keys, "slot", "low", "high", "before").agg(F.sum("c").alias("held"))
    # At most one row per slot and group.
    below = Window.partitionBy(*keys).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("before") + F.coalesce(F.sum("held").over(below), F.lit(0))
    placed = sizes.withColumn("first", first)
    wanted = placed.where((F.col("first") + F.col("held") > F.col("low")) & (F.col("first") <= F.col("high")))
    chosen = wanted.groupBy(*keys).agg(
        F.min("slot").alias("from_slot"), F.max("slot").alias("to_slot"), F.min("first").alias("below")
    )
    kept = _on_groups(slotted, written(chosen, "chosen"), keys, ["from_slot", "to_slot", "below"])
    return kept.where(F.col("slot").between(F.col("from_slot"), F.col("to_slot"))).select(
        *keys, "v", "c", "n", "low", "high", "part", F.col("below").alias("before")
    )
