"""Text to the target's type, one expression per column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate import fixed
from tidegate.functions.dates import as_date, as_timestamp
from tidegate.functions.text import is_blank
from tidegate.model import INT_CASTS, ControlColumn, TargetType

def _number(text: Column, good: Column, zero: Column) -> Column:
    """Blank is null, text that is no number is zero."""
    return F.when(is_blank(text), None).when(~text.rlike(fixed.DECIMAL_PATTERN), zero).otherwise(good)


def to_int(text: Column, family: str = "bigint") -> Column:
    """The integer part of a number text; null beyond the type's range."""
    name = INT_CASTS[family]
    whole = F.substring_index(text, ".", 1).try_cast(name)
    return _number(text, whole, F.lit(0).cast(name))


def to_float(text: Column) -> Column:
    return _number(text, text.try_cast("double"), F.lit(0.0))


def to_decimal(text: Column, precision: int, scale: int, error_flg: Column | None = None) -> Column:
    """A row in error gives zero. (18,0) is widened to (19,0)."""
    if (precision, scale) == (18, 0):
        precision = 19
    name = f"decimal({precision},{scale})"
    zero = F.lit(0).cast(name)
    if error_flg is None:
        return _number(text, text.try_cast(name), zero)
    return F.when(~is_blank(text) & error_flg, zero).otherwise(_number(text, text.try_cast(name), zero))


def to_date(text: Column) -> Column:
    """Blank and unreadable texts are null."""
    return as_date(text)


def to_timestamp(text: Column, zoned: bool = False) -> Column:
    return as_timestamp(text, zoned)


def to_string(text: Column) -> Column:
    """Line feeds become CR LF."""
    return F.replace(F.nullif(text, F.lit("")), F.lit("\n"), F.lit("\r\n"))


def to_time(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def to_bool(text: Column) -> Column:
    return F.when(text.isin(*fixed.TRUE_TEXTS), True).when(text.isin(*fixed.FALSE_TEXTS), False)


def to_target(text: Column, kind: TargetType, error_flg: Column | None = None) -> Column:
    """The conversion that belongs to a target type; unknown types pass through."""
    family = kind.family
    if family in INT_CASTS:
        return to_int(text, family)
    if family == "float":
        return to_float(text)
    if family == "decimal":
        return to_decimal(text, kind.precision, kind.scale, error_flg)
    if family == "date":
        return to_date(text)
    if family == "timestamp":
        return to_timestamp(text, zoned=kind.name.lower().endswith("with time zone"))
    if family == "time":
        return to_time(text)
    if family == "string":
        return to_string(text)
    if family == "boolean":
        return to_bool(text)
    return text


def typed_key(text: Column, kind: TargetType) -> Column:
    """A key value for matching against a target; null, hence no match, where the text does not fit."""
    family = kind.family
    if family in INT_CASTS:
        return F.when(text.rlike(fixed.INT_PATTERN), text.try_cast("bigint"))
    if family in ("float", "decimal"):
        return F.when(text.rlike(fixed.DECIMAL_PATTERN), text.try_cast("double"))
    if family == "date":
        return as_date(text)
    if family == "timestamp":
        return as_timestamp(text, zoned=kind.name.lower().endswith("with time zone"))
    if family == "boolean":
        return to_bool(text)
    return text


def canonical_key(column: ControlColumn, checked: bool = True) -> Column:
    """One text for all spellings that convert to the same key value (``01`` and ``1``).

    Where types are ``checked``, a text that does not fit the type is an error of its own and stands for itself: ``abc``
    is no duplicate of the ``0`` that conversion would make of it. Unchecked, it would be loaded as that ``0``.
    """
    text = F.col(f"`{column.name}`")
    converted = to_target(text, column.type).cast("string")
    if checked:
        converted = F.when(typed_key(text, column.type).isNotNull(), converted)
    return F.coalesce(converted, text)
