"""Date and time texts.

A text that reads just as its value is written by a cast is that value. Any other goes through one regular expression, once, that cuts it into an
ISO date and the parts of a time, or into empty parts; a cast then decides about the calendar, and hours, minutes, seconds
and offsets are compared with their limits.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate import fixed

_ANY_YEAR = r"[0-9]{4}"
_CHECKED_YEAR = r"19[0-9]{2}|2[0-9]{3}"


def _date(year: str) -> str:
    """Groups 1-5: two-digit month and day with optional separators, or one or two digits between separators."""
    return rf"({year})(?:[/-]?([0-9]{{2}})[/-]?([0-9]{{2}})|[/-]([0-9]{{1,2}})[/-]([0-9]{{1,2}}))"


# Digits only; whether they are a time of day is tested as numbers.
_ZONE = r"(Z|[+-][0-9]{2}:?[0-9]{2})?"
_CLOCK = r"([0-9]{2}):?([0-9]{2})"
# Groups 6-10: hour, minute, second, fraction, zone.
_MOMENT = r"(?:[ T]" + _CLOCK + r"(?::?([0-9]{2})(\.[0-9]{1,6})?)?" + _ZONE + r")?"
# Groups 1-4: hour, minute, second, zone.
_TIME = _CLOCK + r":?([0-9]{2})(?:\.[0-9]{1,3})?" + _ZONE

# What a matching text is rewritten to: ISO date, hour, minute, second, fraction and zone. Unset groups are empty.
_MOMENT_PARTS = "$1-$2$4-$3$5|$6|$7|$8|$9|$10"
_TIME_PARTS = "|$1|$2|$3||$4"
_DAY, _CLOCK_AT, _FRACTION, _ZONE_AT = 0, 1, 4, 5


def _whole(pattern: str) -> str:
    """The pattern, or any other text with all groups unset."""
    return rf"(?s)^(?:{pattern}|.*)\z"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once.

    The value is bound to a variable: however often ``use`` names it, and wherever a plan copies the expression to, as
    a filter pushed below a projection does, what the value is made of appears once.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _with_parts(text: Column, pattern: str, parts: str, use: Callable[[Column], Column]) -> Column:
    """``use`` of a text's parts, which one run of the regular expression makes."""
    return bound(F.split(F.regexp_replace(text, _whole(pattern), parts), r"\|"), use)


def _on_the_clock(parts: Column) -> Column:
    """Hour, minute, second and offset are within their limits; unset ones are. Two digits compare as texts."""
    fits = F.lit(True)
    for place, limit in enumerate(fixed.CLOCK_LIMITS, _CLOCK_AT):
        fits = fits & (parts[place] <= f"{limit:02d}")
    zone = parts[_ZONE_AT]
    minutes = F.right(zone, F.lit(2)) <= f"{fixed.OFFSET_MINUTES:02d}"
    within = F.lit(False)
    for mark, limit in fixed.OFFSET_HOURS.items():
        within = within | ((F.substring(zone, 1, 1) == mark) & (F.substring(zone, 2, 2) <= f"{limit:02d}") & minutes)
    return fits & (zone.isin("", "Z") | within)


def _plain(text: Column, kind: str) -> Column:
    """The value of a text that is just how a value of that kind is written, of a year of four digits; else null."""
    value = text.try_cast(kind)
    return F.when((F.length(text) == _WRITTEN[kind]) & (value.cast("string") == text), value)


_WRITTEN = {"date": len("0000-00-00"), "timestamp_ntz": len("0000-00-00 00:00:00")}


def _read(text: Column, use: Callable[[Column], Column], kind: str) -> Column:
    """The day or time of a text: by a cast if it is plain, otherwise from its parts."""

    def value(given: Column) -> Column:
        other = _with_parts(given, _date(_ANY_YEAR) + _MOMENT, _MOMENT_PARTS, use)
        return F.coalesce(*(_plain(given, k).cast(kind) for k in _WRITTEN), other)

    return bound(text, value)


def _checked(text: Column, kinds: Sequence[str], other: Column) -> Column:
    """Whether a text is a plain one of the years 1900 to 2999, or else ``other``."""
    plain = F.lit(False)
    for kind in kinds:
        plain = plain | _plain(text, kind).isNotNull()
    return F.coalesce(F.when(plain, (text >= "1900") & (text < "3000")).otherwise(other), F.lit(False))


def _day(parts: Column) -> Column:
    return F.when(_on_the_clock(parts), parts[_DAY].try_cast("date"))


def as_date(text: Column) -> Column:
    """The day of a date or timestamp text such as ``2024-01-31``, ``2024/1/31`` or ``20240131``; else null."""
    return _read(text, _day, "date")


def as_timestamp(text: Column, zoned: bool = False) -> Column:
    """The time of a date or timestamp text; missing parts are zero. A zone counts for zoned columns only."""

    def moment(parts: Column) -> Column:
        clock = [F.lpad(parts[_CLOCK_AT + i], 2, "0") for i in range(len(fixed.CLOCK_LIMITS))]
        rest = F.concat(parts[_FRACTION], parts[_ZONE_AT]) if zoned else parts[_FRACTION]
        iso = F.concat(parts[_DAY], F.lit(" "), F.concat_ws(":", *clock), rest)
        return F.when(_on_the_clock(parts), iso.try_cast("timestamp" if zoned else "timestamp_ntz"))

    return _read(text, moment, "timestamp" if zoned else "timestamp_ntz")


def is_date(text: Column) -> Column:
    """A calendar day of the years 1900 to 2999. Name ``text`` by a bound variable: it is used several times."""
    other = F.regexp_replace(text, _whole(_date(_CHECKED_YEAR)), "$1-$2$4-$3$5").try_cast("date").isNotNull()
    return _checked(text, ["date"], other)


def is_timestamp(text: Column) -> Column:
    """Such a day, with or without a time of day. ``text`` as for :func:`is_date`."""
    other = _with_parts(text, _date(_CHECKED_YEAR) + _MOMENT, _MOMENT_PARTS, lambda parts: _day(parts).isNotNull())
    return _checked(text, list(_WRITTEN), other)


def is_time_or_blank(text: Column) -> Column:
    """A time of day, or the empty text; null for null. ``text`` as for :func:`is_date`."""
    given = _with_parts(text, _TIME, _TIME_PARTS, lambda parts: (parts[_CLOCK_AT] != "") & _on_the_clock(parts))
    return (text == "") | given
