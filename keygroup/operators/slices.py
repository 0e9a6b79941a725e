"""Cutting the token space into slices, and reading a table slice by slice."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keygroup.functions.token import XXHASH_64, Tokenizer, key_columns
from keygroup.names import TOKEN, quoted
from keygroup.operators.hot import BROADCAST_BYTES
from keygroup.sources.tables import KeyedTable

# Limits to the number of coarse buckets that bring tokens and ranges together.
MIN_BUCKETS = 64
MAX_BUCKETS = 1 << 20

# Size of one range in a broadcast: index, both ends, bucket and overhead.
_RANGE_BYTES = 64


def with_token(table: KeyedTable, tokenizer: Tokenizer = XXHASH_64) -> DataFrame:
    return table.rows.withColumn(TOKEN, tokenizer.column(*key_columns(table.partition_key, table.df.schema)))


def read_slice(table: KeyedTable, low: int, high: int, tokenizer: Tokenizer = XXHASH_64) -> DataFrame:
    """Rows whose token lies in the slice, both ends included."""
    key = key_columns(table.partition_key, table.df.schema)
    return with_token(table, tokenizer).where(tokenizer.within(low, high, *key))


def iterate_slices(
    table: KeyedTable, slices: Sequence[tuple[int, int]], tokenizer: Tokenizer = XXHASH_64
) -> Iterator[tuple[tuple[int, int], DataFrame]]:
    """One lazy frame per slice, in order, for work done slice after slice.

    Each frame scans the table; a table read this way more than once should be
    laid out by slice first (``SlicedTable``), so that a slice reads its own files.
    """
    for low, high in slices:
        yield (low, high), read_slice(table, low, high, tokenizer)


def slice_profile(table: KeyedTable, n: int, tokenizer: Tokenizer = XXHASH_64) -> DataFrame:
    """Per equal slice: ``n_rows``, ``n_keys`` and ``largest_group``.

    Rows shrink to one per key before the shuffle, so hot keys do no harm.
    """
    key = [F.col(quoted(c)) for c in table.partition_key]
    token_key = key_columns(table.partition_key, table.df.schema)
    per_key = table.rows.groupBy(*key).agg(F.count("*").alias("_n"))
    return (
        per_key.groupBy(tokenizer.slice_of(tokenizer.column(*token_key), n).alias("slice"))
        .agg(
            F.sum("_n").alias("n_rows"),
            F.count("*").alias("n_keys"),
            F.max("_n").alias("largest_group"),
        )
    )


class TokenRanges:
    """Ranges between boundary tokens: gap-free, disjoint, inclusive at both ends.

    The first range starts at the lowest token, every other one after a boundary;
    the last ends at the highest token. ``table`` holds ``slice`` (0, 1, …), ``lo``
    and ``hi``.
    """

    def __init__(self, boundaries: DataFrame, tokenizer: Tokenizer = XXHASH_64):
        """``boundaries`` has one column of tokens; order and repeats do not matter."""
        self._tokenizer = tokenizer
        tokens = boundaries.select(F.col(quoted(boundaries.columns[0])).cast("bigint").alias("hi"))
        last = tokens.sparkSession.range(1).select(F.lit(tokenizer.high).alias("hi"))
        tokens = tokens.where(F.col("hi").between(tokenizer.low, tokenizer.high)).unionByName(last).distinct()
        count = tokens.count()
        self._buckets = min(MAX_BUCKETS, max(MIN_BUCKETS, 1 << (count - 1).bit_length()))
        self._largest = count + self._buckets
        self.table = self._ranges(tokens)

    @classmethod
    def of(cls, spark: SparkSession, boundaries: Sequence[int], tokenizer: Tokenizer = XXHASH_64) -> TokenRanges:
        frame = spark.createDataFrame([(int(b),) for b in boundaries], "boundary bigint")
        return cls(frame, tokenizer)

    def _ranges(self, tokens: DataFrame) -> DataFrame:
        # Only one row per bucket passes the unpartitioned window.
        bucket = self._tokenizer.slice_of("hi", self._buckets)
        tokens = tokens.withColumn("bucket", bucket)
        borders = tokens.groupBy("bucket").agg(F.max("hi").alias("top"), F.count("*").alias("n"))
        in_order = Window.orderBy("bucket")
        borders = borders.select(
            "bucket",
            F.lag("top").over(in_order).alias("before"),
            F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
            "n",
        )
        inside = Window.partitionBy("bucket").orderBy("hi")
        previous = F.coalesce(F.lag("hi").over(inside), F.col("before"))
        return tokens.join(borders, "bucket").select(
            (F.col("upto") - F.col("n") + F.row_number().over(inside) - 1).alias("slice"),
            F.coalesce(previous + 1, F.lit(self._tokenizer.low)).alias("lo"),
            "hi",
        )

    def assign(self, rows: DataFrame, token: str = TOKEN) -> DataFrame:
        """Add ``slice`` to every row.

        An equality on coarse buckets brings rows and ranges together. The ranges
        are broadcast while their counted number allows it; past that, the sides
        are shuffled by bucket and hot buckets are split at run time.
        """
        first = self._tokenizer.slice_of("lo", self._buckets)
        last = self._tokenizer.slice_of("hi", self._buckets)
        ranges = self.table.select("slice", "lo", "hi", F.explode(F.sequence(first, last)).alias("_bucket"))
        if self._largest * _RANGE_BYTES <= BROADCAST_BYTES:
            ranges = F.broadcast(ranges)
        keyed = rows.withColumn("_bucket", self._tokenizer.slice_of(token, self._buckets))
        return (
            keyed.join(ranges, "_bucket")
            .where(F.col(quoted(token)).between(F.col("lo"), F.col("hi")))
            .select(*(keyed[quoted(c)] for c in rows.columns), "slice")
        )

    def profile(self, table: KeyedTable) -> DataFrame:
        """``n_rows`` and ``n_keys`` per range; rows shrink to one per key first."""
        key = [F.col(quoted(c)) for c in table.partition_key]
        token = self._tokenizer.column(*key_columns(table.partition_key, table.df.schema))
        per_key = table.rows.groupBy(*key).agg(F.count("*").alias("_n")).select("_n", token.alias(TOKEN))
        return (
            self.assign(per_key)
            .groupBy("slice")
            .agg(F.sum("_n").alias("n_rows"), F.count("*").alias("n_keys"))
        )
