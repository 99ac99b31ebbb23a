"""Many dropped files in one pass: each is checked and logged as a load of its own, and all are applied by one merge.

The outcome is that of loading the files one after the other:

- Counts, the checks of a whole load and duplicates are grouped by file. A file that stops takes no further part.
- A delete is checked against the target as the files before it leave it. For a key that is its last change in an earlier
  file; without one, the last full replacement before, and else the target.
- A key's last change is what the target gets. An upsert after a delete makes a new row, with new creation stamps.
- Of full replacements the last one counts; changes after it are merged into it.

A key has at most one applied row a file, so what is ordered within a key is bounded by the number of files. The driver
holds a row a file.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate import fixed
from tidegate.functions.convert import to_target
from tidegate.model import LoadSpec, RunContext
from tidegate.operators import keys, log, merge, rules, skew, work
from tidegate.plans.load import (
    END_AT,
    START_AT,
    STOP_AT,
    LoadOptions,
    TableResult,
    apply_rows,
    log_line,
)
from tidegate.session import scratch_scope, written
from tidegate.sinks.listed import for_deletes, is_listed
from tidegate.sinks.replace import finish_switch
from tidegate.sinks.tables import append_logs, truncate_and_load

FILE = "file_no"
_RUN = "run"


def load_files(
    rows: DataFrame, files: Sequence[str], runs: Sequence[RunContext], spec: LoadSpec, target_table: str, work_root: str,
    target_root: str, log_root: str, options: LoadOptions = LoadOptions(), column: str = "source_file",
) -> list[TableResult]:
    """Load ``files`` in this order; ``column`` of ``rows`` names each row's file, ``runs`` has the run of each file.

    One result a file. Runs share their time and differ in their tags.
    """
    if not files:
        return []
    with scratch_scope(rows.sparkSession):
        return _Drop(rows, files, runs, spec, target_table, work_root, target_root, log_root, options, column).load()


class _Drop:
    def __init__(self, rows, files, runs, spec, target_table, work_root, target_root, log_root, options, column):
        self.rows, self.files, self.runs, self.column = rows, files, runs, column
        self.spec, self.options, self.ctx = spec, options, runs[0]
        self.target_table, self.target_root, self.log_root = target_table, target_root, log_root
        self.folder = f"{work_root}/{spec.work_table or spec.table}"
        self.spark = rows.sparkSession

    def load(self) -> list[TableResult]:
        staged = truncate_and_load(self._staged(), f"{self.folder}/staged")
        counts = self._counts(staged)
        good = [n for n, c in counts.items() if not c["code"]]
        finish_switch(self.spark, self.target_table, self.target_root)
        self.spark.catalog.refreshTable(self.target_table)
        checked = self._checked(staged.where(F.col(FILE).isin(good)), counts, good)
        self._write_errors(checked)
        sums = {r[FILE]: r.asDict() for r in log.run_summary(checked, self.spec, [FILE]).collect()}
        self._apply(checked, [n for n in good if counts[n]["laundering_num"] and sums[n]["normal_num"]])
        return self._finish(counts, sums)

    def _staged(self) -> DataFrame:
        names = {name: number for number, name in enumerate(self.files)}
        # No more names than files in a batch.
        listed = self.spark.createDataFrame(list(names.items()), f"__name string, {FILE} int")
        numbered = self.rows.join(F.broadcast(listed), F.col(self.column) == F.col("__name")).drop("__name", self.column)
        text = work.to_text_row(numbered, [*self.spec.names, FILE])
        return work.stamp_system_columns(text, self.ctx).withColumn(FILE, F.col(FILE).cast("int"))

    def _counts(self, staged: DataFrame) -> dict[int, dict]:
        """Per file the counts and the Fatal code that stops it; files without rows count nothing."""
        foreign = F.lit(0)
        if self.options.customer_column:
            other = F.col(self.options.customer_column) != self.ctx.customer_id
            foreign = F.count_if(work.is_live() & other)
        counted = staged.groupBy(FILE).agg(*work.division_columns(), *work.work_columns(), foreign.alias("foreign_num"))
        found = {r[FILE]: r.asDict() for r in work.file_divisions(counted).collect()}
        for one in found.values():
            one["code"] = "Fatal003" if one["foreign_num"] else one["code"]
        return found

    # ------------------------------------------------------------ checks

    def _checked(self, staged: DataFrame, counts: dict[int, dict], good: list[int]) -> DataFrame:
        updating = [n for n in good if counts[n]["update_num"] or counts[n]["delete_num"]]
        replacing = [n for n in good if counts[n]["laundering_num"]]
        found = rules.row_rules(self.spec, self.options.row_rules, self.options.require_keys)
        found += [
            replace(rule, condition=F.col(FILE).isin(of) & rule.condition)
            for rule, of in zip(rules.division_rules(True, True), (updating, replacing), strict=True)
        ]
        checked = rules.with_errors(staged, found)
        if self.options.check_duplicates:
            typed = rules.TYPE in self.options.row_rules
            checked = keys.check_duplicates(checked, self.spec, staged, typed, within=[FILE])
        checked = rules.flag_rows(checked)
        deleting = [n for n in good if counts[n]["delete_num"]]
        if deleting and self.options.check_delete_targets:
            checked = rules.flag_rows(self._with_missing(written(checked, "flagged"), replacing))
        return truncate_and_load(checked, f"{self.folder}/checked")

    def _with_missing(self, checked: DataFrame, replacing: list[int]) -> DataFrame:
        """Add the missing-target error to deletes whose key is not there when their file's turn comes."""
        typed = keys.delete_keys(self.spec)
        names = list(typed)
        target = self.spark.table(self.target_table)
        is_delete = F.col("process_div") == fixed.DELETE
        deletes = checked.where(is_delete).withColumns(typed)
        unreadable = F.lit(False)
        for name in names:
            unreadable = unreadable | F.col(name).isNull()
        wanted = written(deletes.groupBy(*names, FILE).agg(F.count(F.lit(1)).alias("__all")), "wanted")

        sure = checked.where(~F.col("error_flg") & F.col("process_div").isin(*fixed.DIVISIONS))
        applied = merge.project_typed(sure, self.spec, self.ctx, F.col(FILE))
        made = F.col("process_div") != fixed.DELETE
        changes = keys.target_keys(applied, self.spec, F.struct(F.col(FILE).alias("at"), made.alias("there")).alias("__change"), FILE)
        asked = wanted.where(~unreadable).select(*names, F.lit(None).alias("__change"), FILE)
        before = Window.partitionBy(*names).orderBy(FILE).rangeBetween(Window.unboundedPreceding, -1)
        last = F.last("__change", ignorenulls=True).over(before)
        states = changes.unionByName(asked).withColumn("__last", last).where("__change IS NULL").drop("__change")
        # Replacements that applied rows, as file numbers: the last one before each delete.
        full = sorted(r[0] for r in sure.where(F.col(FILE).isin(replacing)).select(FILE).distinct().collect())
        renewed = F.array_max(F.filter(F.array(*map(F.lit, full)).cast("array<int>"), lambda n: n < F.col(FILE)))
        known = F.when(F.col("__last.at") >= F.coalesce(renewed, F.lit(-1)), F.col("__last.there")).when(renewed.isNotNull(), F.lit(False))
        states = written(states.select(*names, FILE, known.alias("__there")), "states")

        if is_listed(self.spark, self.target_table):
            target = for_deletes(self.spark, self.target_table, checked, self.spec)
        open_keys = states.where("__there IS NULL").select(*names).distinct()
        present = skew.present_keys(keys.target_keys(target, self.spec), open_keys, names)
        found = states.join(present.withColumn("__base", F.lit(True)), names, "left")
        gone = found.where(~F.coalesce("__there", "__base", F.lit(False))).select(*names, FILE).withColumn("__gone", F.lit(True))
        lookup = wanted.join(gone, [*names, FILE], "left")
        lookup = lookup.where(F.col("__gone") | (F.col("__all") > skew.ROWS_PER_GROUP))
        marked = skew.lookup_join(checked.withColumns(typed), lookup, [*names, FILE], ["__gone"], "__all")
        missing = is_delete & (unreadable | F.col("__gone").isNotNull())
        label = ",".join(k.upper() for k in self.spec.keys)
        done = rules.with_error_if(marked, missing, rules.NO_TARGET_AT, "Error001", label, fixed.MESSAGES["Error001"])
        return done.drop("__gone", *names)

    # ------------------------------------------------------------ applying

    def _apply(self, checked: DataFrame, full: list[int]) -> None:
        """The last full replacement, if any, then the last change of every key since."""
        since = max(full, default=-1)
        sure = checked.where(~F.col("error_flg") & (F.col(FILE) >= since))
        if full:
            self._put(sure.where(F.col(FILE) == since), replacing=True)
        changes = sure.where((F.col(FILE) > since) & F.col("process_div").isin(fixed.UPSERT, fixed.DELETE))
        last = written(self._last_changes(changes), "changes")
        if not last.isEmpty():
            self._put(last, replacing=False)

    def _put(self, rows: DataFrame, replacing: bool) -> None:
        apply_rows(self.ctx, self.spec, rows, self.target_table, self.target_root, replacing, self.options.keep_old_content)

    def _last_changes(self, changes: DataFrame) -> DataFrame:
        """One row a key: its last change, to be renewed if it was deleted before. Rows without a key are all kept."""
        kinds = {f.name.lower(): f.dataType for f in self.spark.table(self.target_table).schema.fields}
        typed = {
            f"__key{i}": to_target(F.col(f"`{k}`"), self.spec.column(k).type).try_cast(kinds[k.lower()])
            for i, k in enumerate(self.spec.keys)
        }
        keyless = F.lit(not typed)
        for name in typed:
            keyless = keyless | F.col(name).isNull()
        columns = [c for c in changes.columns if c != rules.ERRORS]
        keyed = changes.withColumns(typed)
        deleted = F.max(F.when(F.col("process_div") == fixed.DELETE, F.col(FILE)))
        # A key has one row a file, so the file number alone decides.
        row: Column = F.max(F.struct(FILE, *(F.col(f"`{c}`").alias(c) for c in columns if c != FILE)))
        last = keyed.where(~keyless).groupBy(*typed).agg(row.alias("row"), deleted.alias("deleted"))
        renew = (F.col("process_div") == fixed.UPSERT) & F.col("deleted").isNotNull()
        chosen = last.select("row.*", "deleted").withColumn(merge.RENEW, renew).drop("deleted")
        others = keyed.where(keyless).select(*columns).withColumn(merge.RENEW, F.lit(False))
        return chosen.unionByName(others)

    # ------------------------------------------------------------ log

    def _run_of(self, number: Column) -> Column:
        names = F.array(*(F.lit(r.run_name) for r in self.runs))
        return F.get(names, number)

    def _write_errors(self, checked: DataFrame) -> None:
        errors = log.error_log(checked, self.spec, self.ctx, [FILE]).withColumn(_RUN, self._run_of(F.col(FILE)))
        append_logs(errors.drop(FILE), self.log_root, self.spec.table, "errors")

    def _finish(self, counts: dict[int, dict], sums: dict[int, dict]) -> list[TableResult]:
        lines, results = [], []
        for number, run in enumerate(self.runs):
            spec, own = self.spec, [log_line("Info003", self.spec, seq=START_AT)]
            if number not in counts:
                own.append(log_line("Info010", spec, seq=STOP_AT))
                results.append(TableResult(spec.table, "Info010"))
            elif code := counts[number]["code"]:
                own.append(log_line(code, spec, seq=STOP_AT))
                own.append(log_line("Info006", spec, seq=END_AT, text=fixed.MESSAGES["Info006stopped"]))
                results.append(TableResult(spec.table, code, total_num=counts[number]["total_num"]))
            else:
                numbers = {n: sums[number][f"{n}_num"] for n in ("total", "normal", "error")}
                own.append(log_line("Info004", spec, seq=END_AT, text=sums[number]["applied"]))
                own.append(log_line("Info005", spec, seq=END_AT + 1, text=sums[number]["totals"], **numbers))
                own.append(log_line("Info006", spec, seq=END_AT + 2))
                results.append(TableResult(spec.table, "loaded", **{f"{n}_num": v for n, v in numbers.items()}))
            lines += [{**line, _RUN: run.run_name} for line in own]
        append_logs(log.run_lines(self.spark, self.ctx, lines, [_RUN]), self.log_root, self.spec.table, "lines")
        return results
