"""The load of one table and of all tables of a control master."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import fixed
from tidegate.model import LoadSpec, RunContext, TargetType
from tidegate.operators import control, keys, log, merge, rules, work
from tidegate.session import scratch_scope, written
from tidegate.sinks.listed import for_deletes, is_listed, merge_listed, replace_listed
from tidegate.sinks.replace import finish_switch, partition_columns, swap_location, swap_partitions
from tidegate.sinks.tables import append_log, truncate_and_load
from tidegate.sources.extract import incremental_extract

# Positions of the run's own lines before and after the row errors.
START_AT = 1
STOP_AT = 990_000
END_AT = 999_000


@dataclass(frozen=True)
class LoadOptions:
    row_rules: Sequence[str] = rules.ROW_RULES
    check_duplicates: bool = True
    check_delete_targets: bool = True
    require_keys: bool = True
    customer_column: str | None = None
    whole_source: bool = False
    stop_on_bad_control: bool = False
    stop_on_failure: bool = True
    parallel_tables: int = 1
    keep_old_content: bool = True
    named_types: Mapping[str, Mapping[str, TargetType]] = field(default_factory=dict)


@dataclass(frozen=True)
class TableResult:
    table: str
    status: str
    total_num: int = 0
    normal_num: int = 0
    error_num: int = 0

    @property
    def good(self) -> bool:
        return self.status in ("loaded", "Info010")


class LoadStopped(Exception):
    """A load stopped as a whole, by a Fatal code."""

    def __init__(self, code: str):
        super().__init__(f"{code}: {fixed.MESSAGES[code]}")
        self.code = code


def check_work(
    staged: DataFrame,
    target: DataFrame,
    spec: LoadSpec,
    options: LoadOptions = LoadOptions(),
    has_updates: bool = True,
    has_deletes: bool = False,
    has_replace: bool = False,
) -> DataFrame:
    """Staged rows with ``errors`` and the error flag: row rules and the checks by key, in one pass over the rows.

    The key checks count over the staged rows first, which therefore have to be a written table.
    """
    found = rules.row_rules(spec, options.row_rules, options.require_keys)
    found += rules.division_rules(has_updates or has_deletes, has_replace)
    checked = rules.with_errors(staged, found)
    if options.check_duplicates:
        checked = keys.check_duplicates(checked, spec, staged, rules.TYPE in options.row_rules)
    if has_deletes and options.check_delete_targets:
        checked = keys.check_delete_targets(checked, target, spec, staged)
    return rules.flag_rows(checked)


def load_rows(
    source: DataFrame, target: DataFrame, spec: LoadSpec, ctx: RunContext, options: LoadOptions = LoadOptions()
) -> tuple[DataFrame, DataFrame]:
    """Extract, check and merge without touching any named table: ``(checked work rows, new target)``.

    Staged and checked rows go to the shared scratch folder. The same checks as in :func:`load_table`; one that stops
    the whole load raises :class:`LoadStopped`.
    """
    staged = written(_staged(source, spec, ctx, options), "staged")
    stop, counts = _stop_code(staged, ctx, options)
    if stop:
        raise LoadStopped(stop)
    checked = written(_flagged(staged, target, spec, options, counts), "checked")
    combine = merge.replacement_rows if counts["laundering_num"] else merge.merge_work
    return checked, combine(target, checked, spec, ctx)


def _staged(source: DataFrame, spec: LoadSpec, ctx: RunContext, options: LoadOptions) -> DataFrame:
    return work.to_work(source if options.whole_source else incremental_extract(source, ctx), spec, ctx)


def _flagged(staged: DataFrame, target: DataFrame, spec: LoadSpec, options: LoadOptions, counts: dict) -> DataFrame:
    """The checks that the staged rows' divisions call for."""
    return check_work(
        staged,
        target,
        spec,
        options,
        has_updates=counts["update_num"] > 0,
        has_deletes=counts["delete_num"] > 0,
        has_replace=counts["laundering_num"] > 0,
    )


def load_table(
    ctx: RunContext,
    spec: LoadSpec,
    source: DataFrame,
    target_table: str,
    work_root: str,
    target_root: str,
    log_root: str,
    options: LoadOptions = LoadOptions(),
) -> TableResult:
    """:func:`_load_table` in a scratch scope of its own."""
    with scratch_scope(source.sparkSession):
        return _load_table(ctx, spec, source, target_table, work_root, target_root, log_root, options)


def _load_table(
    ctx: RunContext,
    spec: LoadSpec,
    source: DataFrame,
    target_table: str,
    work_root: str,
    target_root: str,
    log_root: str,
    options: LoadOptions,
) -> TableResult:
    """Load one table: stage, check, log the errors, apply, log the counts.

    Staged and checked rows are written tables: the source is read once, and neither the log nor the merge has to
    repeat a check when executors are lost. ``whole_source`` takes all rows instead of those since the cutoff, as for
    dropped files.
    """
    spark = source.sparkSession
    lines = [log_line("Info003", spec, seq=START_AT)]
    folder = f"{work_root}/{spec.work_table or spec.table}"

    def finish(result: TableResult) -> TableResult:
        append_log(log.run_lines(spark, ctx, lines), log_root, ctx, spec.table, "lines")
        return result

    try:
        staged = truncate_and_load(_staged(source, spec, ctx, options), f"{folder}/staged")
    except Exception as failure:  # noqa: BLE001 - any source failure skips this table only
        lines.append(log_line("Fatal007", spec, seq=STOP_AT, reason=_brief(failure)))
        lines.append(log_line("Info006", spec, seq=END_AT))
        return finish(TableResult(spec.table, "Fatal007"))

    if staged.isEmpty():
        lines.append(log_line("Info010", spec, seq=STOP_AT))
        return finish(TableResult(spec.table, "Info010"))

    stop, counts = _stop_code(staged, ctx, options)
    if stop:
        if stop == "Fatal003":
            truncate_and_load(staged.limit(0), f"{folder}/checked")
        lines.append(log_line(stop, spec, seq=STOP_AT))
        lines.append(log_line("Info006", spec, seq=END_AT, text=fixed.MESSAGES["Info006stopped"]))
        return finish(TableResult(spec.table, stop, total_num=counts["total_num"]))

    finish_switch(spark, target_table, target_root)
    # Another session may have switched the table since this one last read it.
    spark.catalog.refreshTable(target_table)
    target = spark.table(target_table)
    if is_listed(spark, target_table) and counts["delete_num"] and options.check_delete_targets:
        target = for_deletes(spark, target_table, staged, spec)
    checked = truncate_and_load(_flagged(staged, target, spec, options, counts), f"{folder}/checked")
    append_log(log.error_log(checked, spec, ctx), log_root, ctx, spec.table, "errors")
    summary = log.run_summary(checked, spec).first()
    if summary["normal_num"] > 0:
        apply_rows(ctx, spec, checked, target_table, target_root, counts["laundering_num"] > 0, options.keep_old_content)

    numbers = {n: summary[f"{n}_num"] for n in ("total", "normal", "error")}
    lines.append(log_line("Info004", spec, seq=END_AT, text=summary["applied"]))
    lines.append(log_line("Info005", spec, seq=END_AT + 1, text=summary["totals"], **numbers))
    lines.append(log_line("Info006", spec, seq=END_AT + 2))
    return finish(TableResult(spec.table, "loaded", **{f"{n}_num": v for n, v in numbers.items()}))


def apply_rows(
    ctx: RunContext,
    spec: LoadSpec,
    checked: DataFrame,
    target_table: str,
    target_root: str,
    replacing: bool,
    keep_old: bool,
) -> None:
    """Put the new content in place: of the touched files of a listed target, of the touched partitions if the target has
    any, else of the whole table."""
    spark = checked.sparkSession
    version = f"{spec.target_table or spec.table}-{ctx.process_id}"
    if is_listed(spark, target_table):
        change = replace_listed if replacing else merge_listed
        change(target_table, checked, spec, ctx, target_root, version, keep_old)
        return
    target = spark.table(target_table)
    parts = partition_columns(spark, target_table)
    if not parts or parts[0] not in spec.names:
        content = (merge.replacement_rows if replacing else merge.merge_work)(target, checked, spec, ctx)
        if parts:
            every = target.select(*parts).distinct().collect()
            swap_partitions(content, target_table, every, target_root, version, keep_old)
        else:
            swap_location(content, target_table, target_root, version, keep_old)
        return
    # Partition values: bounded by the number of partitions of the table.
    if replacing:
        content, old = merge.replacement_rows(target, checked, spec, ctx), target
    else:
        touched = [r[0] for r in merge.touched_values(target, checked, spec, ctx, parts[0]).collect()]
        content = merge.merge_partitions(target, checked, spec, ctx, parts[0], touched)
        old = target.where(merge.in_values(parts[0], touched))
    swap_partitions(content, target_table, old.select(*parts).distinct().collect(), target_root, version, keep_old)


def _brief(failure: Exception) -> str:
    return str(failure)  # the log clips messages to their full length


def log_line(code: str, spec: LoadSpec, seq: int, reason: str = "", text: str | None = None, **numbers: int) -> dict:
    message = text if text is not None else fixed.MESSAGES[code].replace("{reason}", reason)
    return {"code": code, "message": message, "file": spec.table, "seq": seq, **numbers}


def _stop_code(staged: DataFrame, ctx: RunContext, options: LoadOptions) -> tuple[str | None, dict]:
    """The check of the whole load, in one aggregate: a Fatal code or None, and the counts."""
    foreign = F.lit(0)
    if options.customer_column:
        foreign = F.count_if(work.is_live() & (F.col(options.customer_column) != ctx.customer_id))
    counts = staged.agg(*work.division_columns(), *work.work_columns(), foreign.alias("foreign_num"))
    row = work.file_divisions(counts).first().asDict()
    return ("Fatal003" if row["foreign_num"] else row["code"]), row


def run_tables(
    spark: SparkSession,
    ctx: RunContext,
    controls: DataFrame,
    source_of: Callable[[str], DataFrame],
    target_of: Callable[[str], str],
    work_root: str,
    target_root: str,
    log_root: str,
    options: LoadOptions = LoadOptions(),
) -> tuple[bool, list[TableResult]]:
    """Load every table of the control master: ``(all well, results)``.

    Tables are independent of each other. A table with incomplete control rows is skipped, or ends the run if
    ``stop_on_bad_control`` is set. A failure inside the database work ends the run, or with ``stop_on_failure`` off
    only that table's load; ``parallel_tables`` then says how many go at once, and has no say in the outcome.
    """
    tables = sorted(r["aurora_table"] for r in control.target_tables(controls).collect())
    head = [{"code": "Info001", "message": fixed.MESSAGES["Info001"], "seq": 1}]
    if not tables:
        head.append({"code": "Info007", "message": fixed.MESSAGES["Info007"], "seq": 2})
    bad: dict[str, list] = {}
    for row in control.control_errors(controls).orderBy("aurora_table", "ordinal").collect():
        if row["code"] == "Fatal011" and not _checks_names(options):
            continue
        bad.setdefault(row["aurora_table"], []).append(row)

    chosen = []
    for table in tables:
        if table not in bad:
            chosen.append(table)
        elif options.stop_on_bad_control:
            break
    for table, errors in bad.items():
        for row in errors:
            head.append(
                {"code": row["code"], "message": row["message"], "file": table, "item": row["item"], "seq": 10 + row["ordinal"]}
            )

    types = {
        t: control.target_column_types(spark.table(target_of(t)), options.named_types.get(t)) for t in chosen
    }
    results = [TableResult(t, errors[0]["code"]) for t, errors in bad.items()]

    def load(spec: LoadSpec) -> TableResult:
        return load_table(
            ctx, spec, source_of(spec.table), target_of(spec.table), work_root, target_root, log_root, options
        )

    specs = list(control.load_specs(controls, types)) if chosen else []
    with scratch_scope(spark):
        # A run that stops at a failure goes table by table, however many may run at once.
        if not options.stop_on_failure:
            with ThreadPoolExecutor(max_workers=max(1, options.parallel_tables)) as pool:
                futures = [(s.table, pool.submit(load, s)) for s in specs]
            for table, future in futures:
                failure = future.exception()
                results.append(_failed(table, failure, head) if failure else future.result())
        else:
            for spec in specs:
                try:
                    results.append(load(spec))
                except Exception as failure:  # noqa: BLE001 - logged as Fatal008, ends the run
                    results.append(_failed(spec.table, failure, head))
                    break
    head.append({"code": "Info002", "message": fixed.MESSAGES["Info002"], "seq": 1_000_000})
    append_log(log.run_lines(spark, ctx, head), log_root, ctx, "-run", "lines")
    return all(r.good for r in results), results


def _failed(table: str, failure: BaseException, head: list[dict]) -> TableResult:
    message = fixed.MESSAGES["Fatal008"].replace("{reason}", _brief(failure))
    head.append({"code": "Fatal008", "message": message, "file": table, "seq": 900})
    return TableResult(table, "Fatal008")


def _checks_names(options: LoadOptions) -> bool:
    return bool(set(options.row_rules) & set(fixed.VALUE_RULES))
