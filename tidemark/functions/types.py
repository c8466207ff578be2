"""Types a range load can run on, their literals, and their integer axis.

A splittable type is one with an order and a fixed step: whole numbers, dates
and timestamps.  Each has an integer *axis* (the number itself, the day number,
or microseconds since 1970), on which ranges and strides are computed exactly.

Literals are always built from text or integers, never from Python ``datetime``
objects: those would pick up the time zone of the driver's machine.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import LoadError, OptionError
from tidemark.functions.timestamps import has_zone, is_date_text, is_timestamp_text

WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1
MICROS = 1_000_000


def is_number(dtype: T.DataType) -> bool:
    whole_decimal = isinstance(dtype, T.DecimalType) and dtype.scale == 0
    return isinstance(dtype, WHOLE_NUMBERS) or whole_decimal


def is_timestamp(dtype: T.DataType) -> bool:
    return isinstance(dtype, TIMESTAMPS)


def is_splittable(dtype: T.DataType) -> bool:
    """True for types that can drive a range: whole numbers, dates, timestamps."""
    return is_number(dtype) or is_timestamp(dtype) or isinstance(dtype, T.DateType)


def quoted(name: str) -> Column:
    """A top-level column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def holds(dtype: T.DataType, kinds: type | tuple[type, ...]) -> bool:
    """Whether a type is one of ``kinds`` or has one inside."""
    if isinstance(dtype, kinds):
        return True
    if isinstance(dtype, T.StructType):
        return any(holds(f.dataType, kinds) for f in dtype)
    if isinstance(dtype, T.ArrayType):
        return holds(dtype.elementType, kinds)
    if isinstance(dtype, T.MapType):
        return holds(dtype.keyType, kinds) or holds(dtype.valueType, kinds)
    return False


def require_splittable(field: T.StructField) -> T.StructField:
    if not is_splittable(field.dataType):
        raise OptionError(
            f"column {field.name!r} has type {field.dataType.simpleString()}; a range needs "
            "a whole number, date or timestamp column"
        )
    return field


def splittable_field(df: DataFrame, column: str) -> T.StructField:
    """The field Spark resolves ``column`` to; an error unless it is splittable."""
    return require_splittable(df.select(quoted(column)).schema[0])


def number_literal(n: int) -> Column:
    """A whole-number literal; beyond the long range it becomes a decimal."""
    if LONG_MIN <= n <= LONG_MAX:
        return F.lit(n).cast("bigint")
    return F.lit(str(n)).cast("decimal(38,0)")


def offset_literal(text: str, dtype: T.DataType) -> Column:
    """Check an offset given as text and turn it into a literal of ``dtype``."""
    shown = f"offset {text!r} for a {dtype.simpleString()} column"
    if is_number(dtype):
        digits = text[1:] if text[:1] in ("+", "-") else text
        if not (digits.isascii() and digits.isdigit()):
            raise OptionError(f"{shown} is not a whole number")
        n = int(text)
        if not isinstance(dtype, T.DecimalType) and not LONG_MIN <= n <= LONG_MAX:
            raise OptionError(f"{shown} does not fit a 64-bit number")
        if abs(n) >= 10**38:
            raise OptionError(f"{shown} does not fit a 38-digit number")
        return number_literal(n)
    if isinstance(dtype, T.DateType):
        if not is_date_text(text):
            raise OptionError(f"{shown} is not of the form yyyy-MM-dd")
        return F.lit(text).cast(dtype)
    # A zone is meaningful only for timestamps that denote an instant.
    if not is_timestamp_text(text, zoned=isinstance(dtype, T.TimestampType)):
        raise OptionError(f"{shown} is not of the form yyyy-MM-dd[( |T)HH:mm:ss[.ffffff]]")
    if isinstance(dtype, T.TimestampType) and not has_zone(text):
        raise OptionError(
            f"{shown} denotes an instant and needs a zone: yyyy-MM-dd HH:mm:ss+HH:mm, or the "
            "option offsetZone"
        )
    return F.lit(text).cast(dtype)


def check_years(text: str | None, dtype: T.DataType) -> None:
    """Refuse a value that could not be the next offset: years have four digits there."""
    if text and not is_number(dtype) and not text[:1].isdigit():
        raise LoadError(f"the largest value {text} lies past the year 9999, which no offset can name")


def in_zone(text: str, zone: str, dtype: T.DataType) -> str:
    """Offset text with ``zone`` (``Z`` or ``+HH:mm``), where it is an instant without one."""
    if not zone or not isinstance(dtype, T.TimestampType) or has_zone(text):
        return text
    return f"{text if len(text) > 10 else text + ' 00:00:00'}{zone}"


def axis(c: Column, dtype: T.DataType) -> Column:
    """Position of a value on the integer axis of its type.

    Meant for the one or two values of a range; strides over whole columns use
    the cheaper differences of ``plans.strides``.
    """
    if is_number(dtype):
        return c.cast("decimal(38,0)")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("decimal(38,0)")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("decimal(38,0)")
    # The difference of two zone-less timestamps does not depend on the session
    # time zone, unlike a cast to an instant.
    since_epoch = c - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = since_epoch.cast("interval second").cast("decimal(38,6)")
    return (seconds * MICROS).cast("decimal(38,0)")


def axis_text(n: int, dtype: T.DataType) -> str:
    """Text of the value at position ``n``: a number, ISO date or ISO timestamp (UTC)."""
    if is_number(dtype):
        return str(n)
    if isinstance(dtype, T.DateType):
        return (date(1970, 1, 1) + timedelta(days=n)).isoformat()
    moment = datetime(1970, 1, 1) + timedelta(microseconds=n)
    return moment.isoformat(sep=" ", timespec="microseconds")


def axis_literal(n: int, dtype: T.DataType) -> Column:
    """Literal of ``dtype`` at position ``n``."""
    if is_number(dtype):
        return number_literal(n)
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.lit(n).cast("bigint"))
    return F.lit(axis_text(n, dtype)).cast(dtype)


def offset_text(c: Column, dtype: T.DataType) -> Column:
    """A value as offset text that :func:`offset_literal` reads back exactly.

    Instants carry their zone offset, since local text is ambiguous when clocks
    are set back.
    """
    if isinstance(dtype, T.TimestampType):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    return c.cast("string")
