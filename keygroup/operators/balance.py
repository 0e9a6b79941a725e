"""Slices of the key space that weigh the same, from a summary of where the weight lies.

The summary is a histogram over equal stretches of the token space. It holds a number per
stretch, is aggregated before it is shuffled, and those of two tables, or of a table and what
was appended to it, are added up without reading a row again. A stretch that is too heavy
for the tolerance is looked at again in finer stretches, unless it is a single token: the
rows of one key cannot be parted by token.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keygroup.functions.token import XXHASH_64, Tokenizer, key_columns
from keygroup.names import TOKEN
from keygroup.operators.slices import TokenRanges
from keygroup.plans.shape import row_size
from keygroup.sources.tables import KeyedTable

# Stretches that the tolerated part of a slice is spread over.
FINENESS = 8
# Bits by which a stretch that is too heavy is cut finer at a time.
STEP_BITS = 10
# Stretches that are named in a condition; more are joined.
LISTED = 100
MOST_SLICES = 1 << 14
LEAST_TOLERANCE = 0.01


@dataclass(frozen=True)
class Stretch:
    """Tokens from ``low`` to ``high``: what they weigh, and the least and greatest that occurs."""

    low: int
    high: int
    weight: int
    least: int
    most: int

    @property
    def single(self) -> bool:
        return self.least == self.most


@dataclass
class TokenWeights:
    """Weights of stretches of the token space; one entry per stretch that holds rows."""

    tokenizer: Tokenizer
    bits: int
    stretches: list[Stretch]
    finest: int | None = None

    @classmethod
    def of(
        cls,
        table: KeyedTable,
        n: int,
        weight: Column | str | None = None,
        tolerance: float = 0.1,
        tokenizer: Tokenizer = XXHASH_64,
    ) -> TokenWeights:
        """Weigh ``table`` for up to ``n`` slices.

        A row weighs one; with ``"bytes"``, the bytes of its values; or what a column of
        whole numbers says. Stretches are as many as ``n`` slices within the tolerance
        need, about ``8 n / tolerance`` to twice that, and are held on the driver.
        """
        _check(n, tolerance)
        bits = max(1, (int(n / tolerance * FINENESS) - 1).bit_length())
        rows = _weighed(table, weight, tokenizer)
        return cls(tokenizer, bits, _histogram(rows, tokenizer, bits))

    def merge(self, other: TokenWeights) -> TokenWeights:
        """The summary of the rows of both; to be made before stretches are looked at again."""
        same = (self.tokenizer.name, self.bits) == (other.tokenizer.name, other.bits)
        if not same or any(w.finest not in (None, w.bits) for w in (self, other)):
            raise ValueError("only weights over the same stretches can be added")
        found = {s.low: s for s in self.stretches}
        for s in other.stretches:
            mine = found.get(s.low)
            found[s.low] = s if mine is None else Stretch(
                s.low, s.high, s.weight + mine.weight, min(s.least, mine.least), max(s.most, mine.most)
            )
        return TokenWeights(self.tokenizer, self.bits, sorted(found.values(), key=lambda s: s.low))

    @property
    def total(self) -> int:
        return sum(s.weight for s in self.stretches)

    def refined(self, table: KeyedTable, limit: float, weight: Column | str | None = None) -> TokenWeights:
        """Look at the stretches above ``limit`` again until they are light or one token.

        Each pass reads the rows of those stretches only, as far as files can be pruned,
        and needs the keys and the weight alone.
        """
        now, bits = list(self.stretches), self.bits
        rows = _weighed(table, weight, self.tokenizer)
        while bits < self.tokenizer.bits:
            # Only stretches of the last cut can be heavy: at most total / limit of them, a
            # number that does not grow with the rows.
            heavy = [s for s in now if s.weight > limit and not s.single]
            if not heavy:
                break
            width = 1 << (self.tokenizer.bits - bits)
            places = [(s.low - self.tokenizer.low) // width for s in heavy]
            place = self.tokenizer.prefix(TOKEN, bits)
            if len(places) <= LISTED:
                kept = rows.where(place.isin(places))
            else:
                listed = rows.sparkSession.createDataFrame([(p,) for p in places], "_place bigint")
                kept = rows.join(F.broadcast(listed), place == F.col("_place"), "left_semi")
            bits = min(bits + STEP_BITS, self.tokenizer.bits)
            found = {s.low for s in heavy}
            light = [s for s in now if s.low not in found]
            now = sorted([*light, *_histogram(kept, self.tokenizer, bits)], key=lambda s: s.low)
        return TokenWeights(self.tokenizer, self.bits, now, bits)

    def slices(self, n: int) -> list[tuple[int, int]]:
        """Up to ``n`` slices, gap-free, disjoint and inclusive, of about the same weight.

        A stretch goes where its middle falls in the order of all weight, so a slice weighs
        no more than the mean and half of its first and last stretch. A token heavier than
        two slices is alone in its own and takes the place of several.
        """
        _check(n, 1)
        total, before, slices, last = self.total, 0, [], None
        for s in self.stretches:
            place = min(n - 1, (2 * before + s.weight) * n // (2 * total))
            if place != last:
                slices.append(s.high)
                last = place
            slices[-1] = s.high
            before += s.weight
        ends = [*slices[:-1], self.tokenizer.high]
        return list(zip([self.tokenizer.low, *(end + 1 for end in ends[:-1])], ends))

    def weights(self, slices: Sequence[tuple[int, int]]) -> list[int]:
        """What each of the slices made from this summary weighs."""
        sums, at = [0] * len(slices), 0
        for s in self.stretches:
            while slices[at][1] < s.low:
                at += 1
            sums[at] += s.weight
        return sums


def balanced_slices(
    table: KeyedTable,
    n: int,
    weight: Column | str | None = None,
    tolerance: float = 0.1,
    tokenizer: Tokenizer = XXHASH_64,
) -> list[tuple[int, int]]:
    """Up to ``n`` slices of about the same weight, by ``TokenWeights``.

    Where no single token weighs more than the tolerated part of the mean, no slice exceeds
    the mean by more than that part; a heavier token adds at most its own weight to the one
    slice that it is in. The table is read once for its keys (and weights), and once more for
    each finer look at the few stretches that a hot key makes heavy. An empty table gives
    one slice.
    """
    found = TokenWeights.of(table, n, weight, tolerance, tokenizer)
    found = found.refined(table, found.total / n * tolerance, weight)
    return found.slices(n)


def balanced_ranges(table: KeyedTable, n: int, *args, tokenizer: Tokenizer = XXHASH_64, **kwargs) -> TokenRanges:
    """``balanced_slices`` as ranges that rows can be assigned to."""
    slices = balanced_slices(table, n, *args, tokenizer=tokenizer, **kwargs)
    return TokenRanges.of(table.df.sparkSession, [high for _, high in slices], tokenizer)


def _check(n: int, tolerance: float) -> None:
    if not 1 <= n <= MOST_SLICES:
        raise ValueError(f"the number of slices must be between 1 and {MOST_SLICES}, not {n}")
    if not LEAST_TOLERANCE <= tolerance <= 1:
        raise ValueError(f"the tolerance must be between {LEAST_TOLERANCE} and 1, not {tolerance}")


def _weighed(table: KeyedTable, weight: Column | str | None, tokenizer: Tokenizer) -> DataFrame:
    """Token and weight of every row; nothing else is read."""
    if weight is None:
        weight = F.lit(1)
    elif isinstance(weight, str):
        if weight != "bytes":
            raise ValueError(f"rows weigh 'bytes' or what a column says, not {weight!r}")
        weight = row_size(table.df.schema)
    token = tokenizer.column(*key_columns(table.partition_key, table.df.schema))
    return table.rows.select(token.alias(TOKEN), F.greatest(weight.cast("bigint"), F.lit(0).cast("bigint")).alias("_w"))


def _histogram(rows: DataFrame, tokenizer: Tokenizer, bits: int) -> list[Stretch]:
    """The stretches of ``2^bits`` equal ones that weigh something, in order."""
    place = tokenizer.prefix(TOKEN, bits)
    sums = rows.where("_w > 0").groupBy(place.alias("place")).agg(
        F.sum("_w").alias("weight"), F.min(TOKEN).alias("least"), F.max(TOKEN).alias("most")
    )
    width = 1 << (tokenizer.bits - bits)
    found = []
    for r in sums.collect():
        # Places are unsigned numbers of as many bits.
        low = tokenizer.low + (r.place % (1 << bits)) * width
        found.append(Stretch(low, low + width - 1, r.weight, r.least, r.most))
    return sorted(found, key=lambda s: s.low)
