"""Text values of source rows and of log lines."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate import fixed
from tidegate.model import RunContext


def wall_time(moment: datetime) -> Column:
    """A literal without a zone; independent of the zones of the driver and the session."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def as_text(value: Column, data_type: T.DataType) -> Column:
    """A source value as plain text.

    Booleans read ``True`` / ``False``. Floats keep plain digits between 1e-4 and 1e16: exponent notation
    would fail the number patterns later on.
    """
    if isinstance(data_type, T.BooleanType):
        return F.when(value, "True").when(~value, "False")
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        short = value.cast("string")
        size = F.abs(value)
        digits = F.regexp_replace(short.try_cast("decimal(38,21)").cast("string"), r"(\.[0-9]+?)0+\z", "$1")
        plain = F.when(short.contains("E") & (size >= 1e-4) & (size < 1e16), digits).otherwise(short)
        return F.when(F.isnan(value), "nan").otherwise(plain)
    return value.cast("string")


def normalise_null_text(text: Column) -> Column:
    """Null, blank, ``nan`` and ``NaT`` all become the blank text."""
    return F.when(text.isNull() | text.isin(*fixed.NULL_TEXTS), "").otherwise(text)


def strip_backslash(text: Column) -> Column:
    return F.replace(text, F.lit("\\"), F.lit(""))


def is_blank(text: Column) -> Column:
    return text.isNull() | (text == "")


def key_text(keys: Sequence[str], alias: str | None = None) -> Column:
    """``KEY1=v1,KEY2=v2`` with upper-case names."""
    prefix = f"{alias}." if alias else ""
    parts = [F.concat(F.lit(f"{k.upper()}="), F.coalesce(F.col(f"{prefix}`{k}`"), F.lit(""))) for k in keys]
    return F.concat_ws(",", *parts)


def key_label(keys: Sequence[str]) -> str:
    return fixed.KEY_JOINER.join(keys)


def level_of_code(code: Column) -> Column:
    level = F.when(code.contains(fixed.LEVELS[0]), fixed.LEVELS[0])
    for name in fixed.LEVELS[1:]:
        level = level.when(code.contains(name), name)
    return level.otherwise(fixed.LEVELS[0])


def format_message(
    ctx: RunContext, level: Column, message: Column, file: Column | None = None, key: Column | None = None
) -> Column:
    """``【level】 [time] message(file)(key)``; blank or missing parts fall away. Clipped to the log's length."""
    parts = [F.lit("【"), F.rpad(level, 5, " "), F.lit(f"】 [{ctx.log_stamp}] "), message]
    for extra in (file, key):
        if extra is not None:
            parts.append(F.when(is_blank(extra), "").otherwise(F.concat(F.lit("("), extra, F.lit(")"))))
    return clip_message(F.concat(*parts))


def clip_message(message: Column) -> Column:
    return F.substring(message, 1, fixed.MESSAGE_LENGTH)


def null_if_blank(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def action_text(inserted: Column, upserted: Column, deleted: Column) -> Column:
    """Wording of what a load did to its target."""
    applied = F.when(inserted, fixed.ACTION_INSERT).when(upserted, fixed.ACTION_UPSERT)
    text = F.concat_ws("/", applied, F.when(deleted, fixed.ACTION_DELETE))
    return F.when(text == "", fixed.ACTION_DEFAULT).otherwise(text)


def wall_stamp(utc_time: Column, zone: str = "+09:00", form: str = "yyyy/MM/dd HH:mm:ss") -> Column:
    """Text of a UTC time on the clock of another zone."""
    return F.date_format(F.from_utc_timestamp(utc_time, zone), form)


def run_id(utc_time: Column, zone: str = "+09:00") -> Column:
    return wall_stamp(utc_time, zone, "yyyyMMddHHmmss")


def fill(template: str, **parts: Column | str) -> Column:
    """Fill the braces of a message text with columns or literals."""
    pieces: list[Column] = []
    rest = template
    while "{" in rest:
        head, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        if head:
            pieces.append(F.lit(head))
        part = parts[name]
        pieces.append(part if isinstance(part, Column) else F.lit(str(part)))
    if rest:
        pieces.append(F.lit(rest))
    return F.concat(*pieces)
