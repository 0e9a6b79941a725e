"""Composite keys as one binary value that compares as the key does.

Sorting, range partitioning and keyset paging then need a single term, whatever the types
and the number of the columns. Bytes compare unsigned, from the left: numbers become
big-endian with the sign turned round, texts and bytes end in a mark that is smaller than
any character, and every value is led by a byte that puts nulls first.

Two styles of order are known. ``SPARK`` is that of ``ORDER BY``. ``JAVA`` is that of
Java's own comparisons: texts by UTF-16 units, bytes signed, -0.0 before 0.0.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keygroup.names import quoted

SPARK, JAVA = "spark", "java"
_DIGITS = "0123456789"
# Characters of single bytes, with the sign bit turned round; 0x80 is kept apart, since
# the character it would become cannot be a replacement.
_SIGNED = "".join(chr(b) for b in range(256) if b != 0x80)
_TURNED = "".join(chr(b ^ 0x80) for b in range(256) if b != 0x80)


def order_key(names: Sequence[str], schema: T.StructType, style: str = SPARK, uuids: Sequence[str] = ()) -> Column:
    """One binary value per row that orders rows as the columns ``names`` do, one after the other.

    ``uuids`` are text columns in the usual form of a UUID, compared as two signed longs.
    Equal keys have equal values: both zeros in the style of Spark, and every NaN, the
    greatest number. Booleans, numbers, decimals, dates, timestamps, texts and bytes are known.
    """
    if style not in (SPARK, JAVA):
        raise ValueError(f"the style of an order is {SPARK!r} or {JAVA!r}, not {style!r}")
    parts = []
    for name in names:
        column, dtype = F.col(quoted(name)), schema[name].dataType
        value = _uuid(column) if name in uuids else _encoded(column, dtype, style)
        parts.append(F.when(column.isNull(), _bytes(b"\x00")).otherwise(F.concat(_bytes(b"\x01"), value)))
    return F.concat(*parts) if parts else _bytes(b"")


def _bytes(value: bytes) -> Column:
    return F.lit(bytearray(value))


def _encoded(column: Column, dtype: T.DataType, style: str) -> Column:
    if isinstance(dtype, T.BooleanType):
        return F.when(column, _bytes(b"\x01")).otherwise(_bytes(b"\x00"))
    if isinstance(dtype, T.IntegralType):
        return _long(column.cast("bigint"))
    if isinstance(dtype, T.DateType):
        return _long(F.unix_date(column).cast("bigint"))
    if isinstance(dtype, T.TimestampType):
        return _long(F.unix_micros(column))
    if isinstance(dtype, T.TimestampNTZType):
        seconds = F.unix_date(column.cast("date")).cast("bigint") * 86_400 + F.hour(column) * 3_600 + F.minute(column) * 60
        return _long(seconds * 1_000_000 + (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("bigint"))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return _double(column.cast("double"), style)
    if isinstance(dtype, T.DecimalType):
        return _decimal(column, dtype)
    if isinstance(dtype, T.StringType):
        return _text(column, style)
    if isinstance(dtype, T.BinaryType):
        return _binary(column, style)
    raise ValueError(f"values of the type {dtype.simpleString()} cannot be ordered as bytes")


def _long(column: Column) -> Column:
    """Eight bytes, the sign turned round."""
    return F.unhex(F.lpad(F.hex(column.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))


def _double(column: Column, style: str) -> Column:
    """The bits of the number; those of negative ones grow the other way."""
    if style == SPARK:
        column = F.when(column == 0, F.lit(0.0)).otherwise(column)
    text = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), column)
    bits = text.cast("bigint")
    # The lowest number is below all longs that are not negative; _long turns the sign bit.
    return _long(F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit((1 << 63) - 1))))


def _decimal(column: Column, dtype: T.DecimalType) -> Column:
    """Sign and digits; the digits of negative numbers are turned round."""
    form = "S" + "0" * (dtype.precision - dtype.scale) + ("D" + "0" * dtype.scale if dtype.scale else "")
    digits = F.translate(F.to_char(column, F.lit(form)), "+-.", "")
    turned = F.translate(digits, _DIGITS, _DIGITS[::-1])
    return F.encode(F.when(column < 0, F.concat(F.lit("-"), turned)).otherwise(F.concat(F.lit("1"), digits)), "utf-8")


def _text(column: Column, style: str) -> Column:
    """UTF-8 or UTF-16 units, the zero character marked, and two zeros behind."""
    marked = F.replace(column, F.lit("\x00"), F.lit("\x00\x01"))
    return F.encode(F.concat(marked, F.lit("\x00\x00")), "utf-8" if style == SPARK else "utf-16be")


def _binary(column: Column, style: str) -> Column:
    text = F.decode(column, "iso-8859-1")
    if style == JAVA:
        text = F.translate(F.replace(text, F.lit("\x80"), F.lit("Ā")), _SIGNED, _TURNED)
        zero = F.lit("Ā")
    else:
        zero = F.lit("\x00")
    return F.encode(F.concat(F.replace(text, zero, F.lit("\x00\xff")), F.lit("\x00\x00")), "iso-8859-1")


def _uuid(column: Column) -> Column:
    """Sixteen bytes, with the signs of both halves turned round."""
    digits = F.lower(F.replace(column, F.lit("-"), F.lit("")))
    turn: Callable[[Column], Column] = lambda digit: F.translate(digit, "0123456789abcdef", "89abcdef01234567")
    halves = (F.concat(turn(F.substring(digits, at, 1)), F.substring(digits, at + 1, 15)) for at in (1, 17))
    return F.unhex(F.concat(*halves))
