"""Error conditions of the row rules. Every builder answers "is this text wrong?", never null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate import fixed
from tidegate.functions.dates import bound, is_date, is_time_or_blank, is_timestamp
from tidegate.functions.text import is_blank
from tidegate.model import INT_CASTS, TargetType


def _unlike(text: Column, pattern: str) -> Column:
    """Not of the pattern. Blank texts are left to the Required rule."""
    body = pattern.removeprefix("^").removesuffix(r"\z")
    return F.coalesce(~text.rlike(rf"^(?:{body})?\z"), F.lit(False))


def bad_int(text: Column) -> Column:
    return _unlike(text, fixed.INT_PATTERN)


def bad_decimal(text: Column) -> Column:
    return _unlike(text, fixed.DECIMAL_PATTERN)


def bad_bool(text: Column) -> Column:
    return F.coalesce(~text.isin("", *fixed.TRUE_TEXTS, *fixed.FALSE_TEXTS), F.lit(False))


def not_single_byte(text: Column) -> Column:
    return _unlike(text, fixed.PRINTABLE_PATTERN)


def bad_date(text: Column) -> Column:
    return bound(text, lambda t: ~is_blank(t) & ~is_date(t))


def bad_timestamp(text: Column) -> Column:
    return bound(text, lambda t: ~is_blank(t) & ~is_timestamp(t))


def bad_time(text: Column) -> Column:
    return bound(text, lambda t: F.coalesce(~is_time_or_blank(t), F.lit(False)))


def _overflows(text: Column, beyond: Column) -> Column:
    """20 or more characters always overflow; shorter number texts are compared."""
    number = text.rlike(fixed.DECIMAL_PATTERN)
    return F.coalesce((F.length(text) >= fixed.LONG_NUMBER) | (number & beyond), F.lit(False))


def int_overflow(text: Column, family: str = "bigint") -> Column:
    whole = F.substring_index(text, ".", 1).try_cast(INT_CASTS[family])
    return _overflows(text, whole.isNull())


def decimal_overflow(text: Column, precision: int, scale: int) -> Column:
    return _overflows(text, ~text.rlike(_fits_decimal(precision, scale)))


def float_overflow(text: Column) -> Column:
    return _overflows(text, F.abs(text.try_cast("double")) > F.lit(fixed.FLOAT_LIMIT))


def _fits_decimal(precision: int, scale: int) -> str:
    whole = r"[0-9]{1,%d}" % (precision - scale) if precision > scale else "0"
    fraction = r"(?:\.[0-9]{1,%d})?" % scale if scale else ""
    return rf"^-?{whole}{fraction}\z"


def bad_type(text: Column, kind: TargetType) -> Column | None:
    """Wrong spelling or overflow for a target type; None where the type accepts any text.

    For numbers this is the spelling rule or the overflow rule of the family, in one test each.
    """
    family = kind.family
    too_wide = F.coalesce(F.length(text) >= fixed.LONG_NUMBER, F.lit(False))
    if family in INT_CASTS:
        unread = F.nullif(text, F.lit("")).isNotNull() & text.try_cast(INT_CASTS[family]).isNull()
        return bad_int(text) | too_wide | unread
    if family == "decimal":
        return _unlike(text, _fits_decimal(kind.precision, kind.scale)) | too_wide
    if family == "float":
        return bad_decimal(text) | too_wide
    if family == "boolean":
        return bad_bool(text)
    if family == "date":
        return bad_date(text)
    if family == "timestamp":
        return bad_timestamp(text)
    if family == "time":
        return bad_time(text)
    if kind.single_byte:
        return not_single_byte(text)
    return None


def missing(text: Column) -> Column:
    return is_blank(text)


def too_long(text: Column, limit: int) -> Column:
    return F.coalesce(F.length(text) > limit, F.lit(False))


def too_short(text: Column, limit: int) -> Column:
    return F.coalesce(F.length(text) < limit, F.lit(False))


# Texts shorter than fixed.LONG_NUMBER fit whole, up to 18 decimal places.
_EXACT = "decimal(38,18)"


def _limit(limit: object) -> Column:
    return F.lit(str(limit)).cast(_EXACT)


def _value(text: Column) -> Column:
    """The number a limit is compared with, in all its digits; long or non-numeric texts have none and pass."""
    return F.when(
        (F.length(text) < fixed.LONG_NUMBER) & text.rlike(fixed.DECIMAL_PATTERN), text.try_cast(_EXACT)
    )


def above(text: Column, limit: object) -> Column:
    return F.coalesce(_value(text) > _limit(limit), F.lit(False))


def below(text: Column, limit: object) -> Column:
    return F.coalesce(_value(text) < _limit(limit), F.lit(False))
