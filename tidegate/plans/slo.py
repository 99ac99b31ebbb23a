"""Service-level reports over query, job, alert, key and snapshot logs.

What has not ended or was never sent counts if the report is told how far it looks: ``as_of`` ends open intervals, and leaves
out what begins later; ``expected`` names the sources there ought to be; ``span`` is a calendar without gaps.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.operators.neighbours import ROWS_PER_SLOT, with_neighbour
from tidegate.operators.quantile import exact_quantile
from tidegate.session import written

GIB = 1024**3


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def _until(column: str, as_of: datetime | None) -> Column:
    """The end of an interval, in microseconds; an open one, or one that ends later, ends at ``as_of``."""
    if as_of is None:
        return _micros(column)
    now = F.lit(as_of).cast("timestamp")
    return F.unix_micros(F.least(F.coalesce(F.col(column).cast("timestamp"), now), now))


def _begun(rows: DataFrame, column: str, as_of: datetime | None) -> DataFrame:
    return rows if as_of is None else rows.where(F.col(column) <= F.lit(as_of).cast("timestamp_ntz"))


def _of_expected(found: DataFrame, expected: DataFrame | None, source: str) -> DataFrame:
    """A row for every source that was found or is expected."""
    if expected is None:
        return found
    names = expected.select(source).distinct().withColumnRenamed(source, "__expected")
    joined = found.join(names, F.col(source).eqNullSafe(F.col("__expected")), "full_outer")
    return joined.withColumn(source, F.coalesce(source, "__expected")).drop("__expected")


def quantile_slo(
    rows: DataFrame, value: str, name: str, limit: float, share: float = 0.95, by: Sequence[str] = ()
) -> DataFrame:
    """Overall or per group: the quantile, the number of values and whether the limit is met."""
    found = exact_quantile(rows, value, share, name, by)
    return found.select(*by, name, "n", (F.col(name) <= limit).alias("met"))


def slo_query_p95(queries: DataFrame, limit_s: float = 10.0, by: Sequence[str] = ()) -> DataFrame:
    """Response time of mart queries."""
    return quantile_slo(queries.where(F.col("layer") == "dm"), "elapsed_s", "p95_s", limit_s, by=by)


def slo_scan_p95(queries: DataFrame, limit_bytes: float = GIB, by: Sequence[str] = ()) -> DataFrame:
    """Bytes scanned per query."""
    return quantile_slo(queries, "scan_bytes", "p95_bytes", limit_bytes, by=by)


def slo_etl_window(
    runs: DataFrame, least_success: float = 0.99, late_minutes: int = 15, as_of: datetime | None = None
) -> DataFrame:
    """Per day: share of successful runs, runs that ended later than allowed after ``due_ts``, and both verdicts.

    With ``as_of`` a run that has not ended by then is late once the allowed time has passed.
    """
    late = _until("end_ts", as_of) - _micros("due_ts") > late_minutes * 60 * 1_000_000
    days = _begun(runs, "due_ts", as_of).groupBy(F.to_date("due_ts").alias("day")).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("outcome") == "ok").alias("ok_runs"),
        F.count_if(late).alias("late_runs"),
    )
    share = F.col("ok_runs") / F.col("runs")
    return days.select(
        "day",
        "runs",
        "ok_runs",
        "late_runs",
        share.alias("success_share"),
        ((share >= least_success) & (F.col("late_runs") == 0)).alias("met"),
    )


def slo_log_complete(
    logs: DataFrame, source: str, time: str, first: date, last: date, expected: DataFrame | None = None
) -> DataFrame:
    """Per source: expected and delivered days and the missing ones' share. Target: no day missing.

    An ``expected`` source that sent nothing lacks all days.
    """
    day = F.to_date(time)
    days = (last - first).days + 1
    seen = logs.select(source, F.when(day.between(F.lit(first), F.lit(last)), day).alias("day")).distinct()
    delivered = _of_expected(seen.groupBy(source).agg(F.count("day").alias("delivered_days")), expected, source)
    delivered = delivered.withColumn("delivered_days", F.coalesce("delivered_days", F.lit(0).cast("bigint")))
    return delivered.select(
        source,
        F.lit(days).cast("bigint").alias("expected_days"),
        "delivered_days",
        (F.lit(days) - F.col("delivered_days")).alias("missing_days"),
        (F.col("delivered_days") == days).alias("met"),
    )


def missing_log_days(
    logs: DataFrame, source: str, time: str, first: date, last: date, expected: DataFrame | None = None
) -> DataFrame:
    """The days without a log, per source. A source keeps one set of at most as many days as the span has."""
    day = F.to_date(time)
    delivered = F.collect_set(F.when(day.between(F.lit(first), F.lit(last)), day))
    days = F.sequence(F.lit(first), F.lit(last))
    seen = _of_expected(logs.groupBy(source).agg(delivered.alias("delivered")), expected, source)
    seen = seen.withColumn("delivered", F.coalesce("delivered", F.array().cast("array<date>")))
    return seen.select(source, F.explode(F.array_except(days, "delivered")).alias("day"))


def abort_trend(
    queries: DataFrame, unit: str = "month", better_by: float = 0.10, span: tuple[date, date] | None = None
) -> DataFrame:
    """Abort share per period, the change against the period before, and whether it fell by the wanted part.

    Without ``span`` the period before is the last one with queries. With it every period from its first to its last day
    has a row, one without queries has no share, and only the period right before is compared with.
    """
    period = F.to_date(F.date_trunc(unit, F.col("start_ts"))).alias("period")
    shares = queries.groupBy(period).agg(
        F.count(F.lit(1)).alias("queries"), F.count_if(F.col("outcome") == "abort").alias("aborts")
    )
    # One row per period from here on.
    if span is not None:
        edges = [F.to_date(F.date_trunc(unit, F.lit(day))) for day in span]
        calendar = queries.sparkSession.range(1).select(F.explode(F.sequence(*edges, F.expr(f"interval 1 {unit}"))).alias("period"))
        shares = calendar.join(shares, "period", "left").na.fill(0, ["queries", "aborts"])
    share = F.try_divide("aborts", F.col("queries")).cast("double")
    helpers = {"abort_share": share, "__all": F.lit(1), "__at": F.col("period").cast("timestamp")}
    before = with_neighbour(
        written(shares.withColumns(helpers), "periods"),
        ["__all"],
        "__at",
        [],
        # Wrapped: a period that has no share is still the one before.
        F.struct("abort_share") if span else F.when(F.col("abort_share").isNotNull(), F.struct("abort_share")),
        "before",
    ).withColumn("before", F.col("before.abort_share"))
    change = F.when(F.col("before") > 0, F.col("abort_share") / F.col("before") - 1)
    return before.select(
        "period", "queries", "aborts", "abort_share", change.alias("change"), (change <= -better_by).alias("improved")
    )


def classify_queries(
    queries: DataFrame,
    abort_at: tuple[float, float, float] = (300.0, 10 * GIB, 10.0),
    log_at: tuple[float, float, float] = (60.0, GIB, 4.0),
) -> DataFrame:
    """Add ``reason`` and ``action`` for long, big-scan and skewed queries; limits are (s, bytes, skew ratio)."""
    values = [F.col("elapsed_s"), F.col("scan_bytes"), F.col("skew_ratio")]
    names = ["long", "big_scan", "skewed"]

    def first_over(limits: Sequence[float]) -> Column:
        reason = F.when(values[0] > limits[0], names[0])
        for value, limit, name in zip(values[1:], limits[1:], names[1:]):
            reason = reason.when(value > limit, name)
        return reason

    worst, noted = first_over(abort_at), first_over(log_at)
    return queries.withColumns(
        {
            "reason": F.coalesce(worst, noted),
            "action": F.when(worst.isNotNull(), "abort").when(noted.isNotNull(), "log"),
        }
    )


def alert_response(
    alerts: DataFrame, least_severity: float = 5.0, ack_minutes: float = 10.0, fix_minutes: float = 120.0,
    as_of: datetime | None = None,
) -> DataFrame:
    """One row: mean minutes to acknowledge and to resolve severe alerts, and both verdicts.

    With ``as_of`` open alerts count with the time they have been open until then.
    """
    minute = 60_000_000

    def mean(until: str) -> Column:
        ended = _until(until, as_of)
        return F.sum(ended - _micros("opened_ts")) / F.count(ended) / F.lit(minute)

    severe = _begun(alerts, "opened_ts", as_of).where(F.col("severity") >= least_severity)
    means = severe.agg(
        F.count(F.lit(1)).alias("alerts"), mean("acked_ts").alias("mtta_min"), mean("resolved_ts").alias("mttr_min")
    )
    return means.select(
        "*",
        (F.col("mtta_min") <= ack_minutes).alias("mtta_met"),
        (F.col("mttr_min") <= fix_minutes).alias("mttr_met"),
    )


def log_retention_tier(logs: DataFrame, day: str, as_of: date, hot_days: int = 365, keep_days: int = 3 * 365) -> DataFrame:
    """Add ``age_days`` and ``tier``: hot, archive or expired."""
    age = F.datediff(F.lit(as_of), F.col(day))
    tier = F.when(age <= hot_days, "hot").when(age <= keep_days, "archive").otherwise("expired")
    return logs.withColumns({"age_days": age, "tier": tier})


def stale_keys(uses: DataFrame, key: str, time: str, as_of: date, idle_days: int = 90) -> DataFrame:
    """Access keys whose last use lies more than ``idle_days`` back."""
    last = uses.groupBy(key).agg(F.to_date(F.max(time)).alias("last_used"))
    idle = F.datediff(F.lit(as_of), F.col("last_used"))
    return last.withColumn("idle_days", idle).where(F.col("idle_days") > idle_days)


def mfa_rate(users: DataFrame, flag: str = "mfa") -> DataFrame:
    """One row: users, users with a second factor, their share and whether it is all of them."""
    counts = users.agg(F.count(F.lit(1)).alias("users"), F.count_if(F.col(flag)).alias("with_mfa"))
    return counts.select(
        "*", (F.col("with_mfa") / F.col("users")).alias("mfa_share"), (F.col("with_mfa") == F.col("users")).alias("met")
    )


def rpo_check(
    snapshots: DataFrame, source: str, time: str, ties: Sequence[str], limit_hours: float = 24.0,
    rows_per_slot: int = ROWS_PER_SLOT, as_of: datetime | None = None, expected: DataFrame | None = None,
) -> DataFrame:
    """Per source: snapshots, the longest gap in hours between two in a row, and whether it keeps the limit.

    With ``as_of`` the time since the last snapshot is a gap as well. An ``expected`` source without a snapshot has no gap
    and does not keep the limit.
    """
    snapshots = _begun(snapshots, time, as_of)
    before = with_neighbour(snapshots, [source], time, ties, F.col(time), "__before", rows_per_slot=rows_per_slot)
    gap = _micros(time) - _micros("__before")
    longest = F.max(gap)
    if as_of is not None:
        longest = F.greatest(longest, F.unix_micros(F.lit(as_of).cast("timestamp")) - F.max(_micros(time)))
    worst = before.groupBy(source).agg(F.count(F.lit(1)).alias("snapshots"), longest.alias("us"))
    worst = _of_expected(worst, expected, source)
    hours = F.col("us") / F.lit(3_600_000_000)
    met = hours <= limit_hours
    if expected is not None:
        worst, met = worst.na.fill(0, ["snapshots"]), F.when(F.col("snapshots") == 0, False).otherwise(met)
    return worst.select(source, "snapshots", hours.alias("worst_gap_h"), met.alias("met"))
