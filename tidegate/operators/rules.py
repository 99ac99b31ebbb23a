"""Row rules: all checks of a row in one pass, as an array of errors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate import fixed
from tidegate.functions import conditions as C
from tidegate.functions.text import fill, key_label
from tidegate.model import ControlColumn, LoadSpec
from tidegate.operators.work import is_live

ERRORS = "errors"
ERROR_TYPE = T.StructType(
    [
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("code", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

# Rule names for `only=`; the control table's value rules keep their own names.
TYPE = "Type"
ROW_RULES = (TYPE, *fixed.VALUE_RULES)

# Positions of the checks in a run; log rows carry them as seq.
_TYPES_FROM = 1_000
DUPLICATE_AT = 2_000
_DIVISION_AT = 2_001
_VALUES_FROM = 3_000
NO_TARGET_AT = 900_000


@dataclass(frozen=True)
class RowRule:
    ordinal: int
    code: str
    item: str | None
    message: Column
    condition: Column

    def error(self) -> Column:
        return F.struct(
            F.lit(self.ordinal).alias("ordinal"),
            F.lit(self.code).alias("code"),
            F.lit(self.item).cast("string").alias("item"),
            self.message.alias("message"),
        )


def limit_text(limit: object) -> str:
    """A limit as it reads in a message: plain digits, no trailing zeros of the control column's scale."""
    number = Decimal(str(limit))
    return format(number.to_integral_value() if number == number.to_integral_value() else number.normalize(), "f")


def type_rule(column: ControlColumn, ordinal: int = _TYPES_FROM) -> RowRule | None:
    condition = C.bad_type(F.col(f"`{column.name}`"), column.type)
    if condition is None:
        return None
    message = fill(fixed.MESSAGES["Error010"], item=column.shown, type=column.type.name)
    return RowRule(ordinal, "Error010", column.shown, message, condition)


def value_rules(column: ControlColumn, only: Sequence[str] = fixed.VALUE_RULES, ordinal: int = _VALUES_FROM) -> list[RowRule]:
    text = F.col(f"`{column.name}`")
    length = F.length(text).cast("string")
    found = []

    def add(rule: str, code: str, condition: Column, actual: Column | None = None, limit: object = "") -> None:
        parts = {"item": column.shown, "limit": limit_text(limit) if limit != "" else ""}
        if actual is not None:
            parts["actual"] = actual
        message = fill(fixed.MESSAGES[code], **parts)
        position = ordinal + fixed.VALUE_RULES.index(rule)
        found.append(RowRule(position, code, column.shown, message, condition))

    limits = {
        fixed.MAX_LENGTH: column.max_length,
        fixed.MIN_LENGTH: column.min_length,
        fixed.MAX_VALUE: column.max_value,
        fixed.MIN_VALUE: column.min_value,
    }
    for rule in fixed.VALUE_RULES:
        if rule not in only or not column.has(rule) or limits.get(rule, 0) is None:
            continue
        if rule == fixed.REQUIRED:
            add(rule, "Error003", C.missing(text))
        elif rule == fixed.MAX_LENGTH:
            add(rule, "Error006", C.too_long(text, column.max_length), length, column.max_length)
        elif rule == fixed.MIN_LENGTH:
            add(rule, "Error007", C.too_short(text, column.min_length), length, column.min_length)
        elif rule == fixed.MAX_VALUE:
            add(rule, "Error008", C.above(text, column.max_value), text, column.max_value)
        elif rule == fixed.MIN_VALUE:
            add(rule, "Error009", C.below(text, column.min_value), text, column.min_value)
    return found


def division_rules(has_updates: bool, has_replace: bool) -> list[RowRule]:
    """Rows whose division does not belong to the kind of load the file is."""
    division = F.col("process_div")
    found = []
    if has_updates:
        wrong = ~division.isin(fixed.UPSERT, fixed.DELETE)
        found.append(
            RowRule(_DIVISION_AT, "Error015", "PROCESS_DIV", F.lit(fixed.MESSAGES["Error015"]), wrong)
        )
    if has_replace:
        wrong = division != fixed.REPLACE
        found.append(
            RowRule(_DIVISION_AT + 1, "Error016", "PROCESS_DIV", F.lit(fixed.MESSAGES["Error016"]), wrong)
        )
    return found


def row_rules(spec: LoadSpec, only: Sequence[str] = ROW_RULES, require_keys: bool = False) -> list[RowRule]:
    """Type and value rules of all control columns, in the order of a run.

    ``require_keys`` makes key columns required whatever their control rows say: a blank key would be inserted anew by
    every run.
    """
    found = []
    for position, column in enumerate(spec.columns):
        chosen = only
        if require_keys and column.search_key:
            column = replace(column, rules=f"{column.rules or ''},{fixed.REQUIRED}")
            chosen = (*only, fixed.REQUIRED)
        if TYPE in only:
            rule = type_rule(column, _TYPES_FROM + position)
            if rule is not None:
                found.append(rule)
        found += value_rules(column, chosen, _VALUES_FROM + 10 * position)
    return sorted(found, key=lambda r: r.ordinal)


def _no_errors() -> Column:
    return F.array().cast(T.ArrayType(ERROR_TYPE))


def with_errors(work: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Add the errors of live rows, after those a row already has.

    The rules give one flag each first; the array is built from the flags, and only where one is set.
    """
    if not rules:
        return work if ERRORS in work.columns else work.withColumn(ERRORS, _no_errors())
    flags = [f"__rule{i}" for i in range(len(rules))]
    flagged = work.withColumns({f: F.coalesce(r.condition, F.lit(False)) for f, r in zip(flags, rules)})
    fails = F.lit(False)
    for flag in flags:
        fails = fails | F.col(flag)
    found = F.array_compact(F.array(*(F.when(F.col(f), r.error()) for f, r in zip(flags, rules))))
    errors = F.when(is_live() & fails, found).otherwise(_no_errors())
    if ERRORS in work.columns:
        errors = F.concat(F.col(ERRORS), errors)
    return flagged.withColumn(ERRORS, errors).drop(*flags)


def with_error_if(work: DataFrame, condition: Column, ordinal: int, code: str, item: str | None, message: str) -> DataFrame:
    """Add one error found by a join."""
    error = RowRule(ordinal, code, item, F.lit(message), condition).error()
    extra = F.when(F.coalesce(condition, F.lit(False)), F.array(error)).otherwise(_no_errors())
    kept = F.concat(F.col(ERRORS), extra) if ERRORS in work.columns else extra
    return work.withColumn(ERRORS, kept)


def flag_rows(work: DataFrame) -> DataFrame:
    """Set the error flag of live rows that have an error."""
    return work.withColumn("error_flg", F.col("error_flg") | (is_live() & (F.size(ERRORS) > 0)))


def duplicate_message(keys: Sequence[str]) -> str:
    return fixed.MESSAGES["Error004"].replace("{item}", key_label(keys))
