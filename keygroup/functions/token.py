"""Tokens: a deterministic hash of the partition key that cuts the key space.

A token only balances and slices. Groups are always formed by the key itself, so
two keys that share a token never meet in one group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from os.path import commonprefix

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keygroup.names import quoted

_LOW_32 = (1 << 32) - 1
MAX_SLICES = (1 << 31) - 1


@dataclass(frozen=True)
class Tokenizer:
    """A token expression and the range of its values.

    ``digits`` is a text that begins with the hexadecimal digits of the token, counted from
    the lowest one, if there is one that costs less than the token itself.
    """

    name: str
    expression: Callable[[Sequence[Column]], Column]
    bits: int
    low: int
    digits: Callable[[Sequence[Column]], Column] | None = None

    @property
    def high(self) -> int:
        return self.low + (1 << self.bits) - 1

    def column(self, *key: str | Column) -> Column:
        """The token of the partition-key columns, in key order.

        Columns of a table are best given as ``key_columns`` makes them.
        """
        token = self.expression([F.col(k) if isinstance(k, str) else k for k in key])
        # A null key has a token too, so that every row is in some slice.
        return F.coalesce(token, F.lit(self.low))

    def within(self, low: int, high: int, *key: str | Column) -> Column:
        """Whether the token of the key lies between ``low`` and ``high``, both included.

        Where the token has digits, they are compared in its place, since their order is the same.
        """
        low, high = max(low, self.low), min(high, self.high)
        if self.digits is None or low > high:
            return self.column(*key).between(low, high)
        digits = self.digits([F.col(k) if isinstance(k, str) else k for k in key])
        first, last = (f"{token - self.low:0{self.bits // 4}x}" for token in (low, high))
        shared = commonprefix([first, last])
        if set(first[len(shared) :]) <= {"0"} and set(last[len(shared) :]) <= {"f"}:
            inside = digits.startswith(shared)
        else:
            # Whatever follows the digits of the last token comes before this letter.
            inside = digits.between(first, last + "g")
        # A null key has the lowest token.
        return F.coalesce(inside, F.lit(low == self.low))

    def bounds(self, n: int) -> list[tuple[int, int]]:
        """``n`` gap-free, disjoint slices, inclusive at both ends."""
        _check_count(n)
        size = 1 << self.bits
        starts = [self.low - (-i * size // n) for i in range(n + 1)]
        return [(lo, nxt - 1) for lo, nxt in zip(starts, starts[1:])]

    def slice_of(self, token: str | Column, n: int) -> Column:
        """Index of the equal slice that holds ``token``: ``floor(offset * n / size)``.

        The product does not fit 64 bits, so the two halves of the offset are
        multiplied apart; everything stays in plain long arithmetic.
        """
        _check_count(n)
        offset = self._offset(token)
        upper = F.shiftrightunsigned(offset, 32) * F.lit(n).cast("bigint")
        lower = F.shiftrightunsigned(offset.bitwiseAND(F.lit(_LOW_32)) * F.lit(n).cast("bigint"), 32)
        return F.shiftright(upper + lower, 32).cast("int")

    def prefix(self, token: str | Column, bits: int) -> Column:
        """The first ``bits`` bits of the token's offset in the key space.

        That is the index of one of ``2^bits`` equal slices; with 64 bits it is to be
        read as unsigned.
        """
        if not 1 <= bits <= self.bits:
            raise ValueError(f"a token of {self.name} has 1 to {self.bits} bits, not {bits}")
        return F.shiftrightunsigned(self._offset(token), 64 - bits) if bits < 64 else self._offset(token)

    def _offset(self, token: str | Column) -> Column:
        """The distance from the lowest token, in the uppermost bits of an unsigned long."""
        token = F.col(token) if isinstance(token, str) else token
        if self.bits == 64:
            return token.bitwiseXOR(F.lit(self.low))
        return F.shiftleft(token - F.lit(self.low) if self.low else token, 64 - self.bits)


def key_columns(names: Sequence[str], schema: T.StructType) -> list[Column]:
    """Key columns in a form of which equal keys have one text and one hash.

    Both zeros are one number, and a moment is counted from the epoch, since its text
    depends on the time zone of the session.
    """
    return [_canonical(F.col(quoted(name)), schema[name].dataType) for name in names]


def _canonical(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(column == 0, F.lit(0.0).cast(dtype)).otherwise(column)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column)
    return column


def _check_count(n: int) -> None:
    if not 1 <= n <= MAX_SLICES:
        raise ValueError(f"the number of slices must be between 1 and {MAX_SLICES}, not {n}")


def _xxhash(key: Sequence[Column]) -> Column:
    return F.xxhash64(*key)


def _md5(key: Sequence[Column]) -> Column:
    text = F.concat_ws("\x1f", *[k.cast("string") for k in key]) if len(key) > 1 else key[0].cast("string")
    return F.md5(text)


def _md5_60(key: Sequence[Column]) -> Column:
    return F.conv(F.substring(_md5(key), 1, 15), 16, 10).cast("bigint")


XXHASH_64 = Tokenizer("xxhash64", _xxhash, bits=64, low=-(1 << 63))
"""The default: one built-in call over the whole signed 64-bit range."""

MD5_60 = Tokenizer("md5_60", _md5_60, bits=60, low=0, digits=_md5)
"""The first 60 bits of the key's MD5, for tokens that other engines must reproduce."""


def named_tokenizer(name: str) -> Tokenizer:
    """A tokenizer of this module, for layouts that are opened again."""
    for one in (XXHASH_64, MD5_60):
        if one.name == name:
            return one
    raise ValueError(f"a layout cannot be opened again with the tokenizer {name}")
