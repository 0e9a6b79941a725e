"""What slices of the key space hold, as summaries that are added up.

Per slice: the number of rows, a HyperLogLog sketch of the keys, and a sample of keys with
their exact numbers of rows. The sample holds every key whose hash is below a bound, so
whatever part of a table a key is in, it is sampled there as well: summaries of parts, of
appended rows or of neighbouring slices give the summary of the whole without reading a row.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keygroup.functions.token import XXHASH_64, Tokenizer, key_columns
from keygroup.sources.tables import KeyedTable
from keygroup.workspace import materialise

# Two to this many registers in a sketch: a standard error of 1.04 / sqrt(2^12), 1.6 %.
SKETCH_BITS = 12
# Keys that a slice samples, about.
SAMPLED_KEYS = 2_000
# Hashes of the sample are numbers below this.
_HASHES = 1 << 62
SCHEMA = "slice int, n_rows bigint, sketch binary, below bigint, sample array<struct<hash:bigint,n:bigint>>"


@dataclass(frozen=True)
class SliceProfile:
    """A summary of every slice that holds rows; ``table`` has the columns of ``SCHEMA``."""

    table: DataFrame
    n: int

    @classmethod
    def of(
        cls,
        table: KeyedTable,
        n: int,
        tokenizer: Tokenizer = XXHASH_64,
        sampled_keys: int = SAMPLED_KEYS,
        paths: list[str] | None = None,
    ) -> SliceProfile:
        """Summarise a table in ``n`` equal slices.

        Two passes over the key columns. The first sums up rows and sketches, a row per
        slice and task; the second counts the rows of the sampled keys alone. So what is
        shuffled depends on slices and samples, and not on the number of keys.
        """
        if sampled_keys < 1:
            raise ValueError(f"sampled_keys must be positive, not {sampled_keys}")
        key = key_columns(table.partition_key, table.df.schema)
        # Not the hash that tokens are made of, which would sample the beginning of a slice.
        mixed = F.xxhash64(F.lit("sample"), *key)
        rows = table.rows.select(
            tokenizer.slice_of(tokenizer.column(*key), n).alias("slice"),
            F.shiftrightunsigned(mixed, 2).alias("hash"),
        )
        sums = rows.groupBy("slice").agg(F.count("*").alias("n_rows"), F.hll_sketch_agg("hash", SKETCH_BITS).alias("sketch"))
        share = F.least(F.lit(1.0), F.lit(float(sampled_keys)) / F.greatest(F.hll_sketch_estimate("sketch"), F.lit(1)))
        sums = materialise(sums.withColumn("below", (share * F.lit(float(_HASHES))).cast("bigint")), "profile", paths)
        # A row per slice: bounded by the number of slices, not by the table.
        bounds = sums.select("slice", "below")
        near = rows.join(F.broadcast(bounds) if n <= 1 << 20 else bounds, "slice").where("hash < below")
        counts = near.groupBy("slice", "hash").agg(F.count("*").alias("n"))
        samples = counts.groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("hash", "n"))).alias("sample"))
        joined = sums.join(samples, "slice", "left")
        empty = F.array().cast("array<struct<hash:bigint,n:bigint>>")
        return cls(joined.select("slice", "n_rows", "sketch", "below", F.coalesce("sample", empty).alias("sample")), n)

    def merge(self, *others: SliceProfile) -> SliceProfile:
        """The summary of all rows of several tables with the same slices."""
        if any(other.n != self.n for other in others):
            raise ValueError("only profiles of the same slices can be added")
        parts = reduce(DataFrame.unionByName, [other.table for other in others], self.table)
        return SliceProfile(_added(parts, F.col("slice")), self.n)

    def write(self, path: str) -> None:
        """Add this summary to those below ``path``."""
        self.table.withColumn("slices", F.lit(self.n)).write.mode("append").parquet(path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> SliceProfile:
        """The sum of all summaries written below ``path``."""
        parts = spark.read.schema(f"{SCHEMA}, slices int").parquet(path)
        found = [row[0] for row in parts.select("slices").distinct().limit(2).collect()]
        if len(found) > 1:
            raise ValueError(f"the profiles below {path} are of different slices")
        return cls(_added(parts, F.col("slice")), found[0] if found else 0)

    def report(self, together: int = 1) -> DataFrame:
        """``slice, n_rows, n_keys``, and the sizes that half, 90 % and 99 % of the groups do not exceed.

        ``n_rows`` is exact; ``n_keys`` is, too, where the sample holds every key, and has the
        error of the sketch elsewhere; sizes are those of the sampled keys. With ``together``,
        so many neighbouring slices are summed up to one, numbered anew.
        """
        if together < 1:
            raise ValueError(f"together must be positive, not {together}")
        parts = self.table if together == 1 else _added(self.table, F.expr(f"slice div {together}").cast("int"))
        sizes = F.array_sort(F.transform("sample", lambda s: s["n"]))
        every = F.col("below") >= F.lit(_HASHES)
        keys = F.when(every, F.size("sample").cast("bigint")).otherwise(F.hll_sketch_estimate("sketch"))

        def upto(share: float) -> Column:
            # The least size that this share of the sampled groups does not exceed.
            return F.get(sizes, F.ceil(F.size("sample") * F.lit(share)).cast("int") - 1)

        return parts.select(
            "slice", "n_rows", keys.alias("n_keys"),
            upto(0.5).alias("size_50"), upto(0.9).alias("size_90"), upto(0.99).alias("size_99"),
        )


def _added(parts: DataFrame, slot: Column) -> DataFrame:
    """Summaries with the same slot, as one: sketches joined, samples cut at the least bound and summed."""
    sums = parts.withColumn("slice", slot).groupBy("slice").agg(
        F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("sketch"), F.min("below").alias("below")
    )
    # The samples move as rows, so that no list holds those of all parts.
    sampled = parts.select(slot.alias("slice"), F.explode("sample").alias("one"))
    kept = sampled.join(sums.select("slice", "below"), "slice").where("one.hash < below")
    counts = kept.groupBy("slice", F.col("one.hash").alias("hash")).agg(F.sum("one.n").alias("n"))
    samples = counts.groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("hash", "n"))).alias("sample"))
    empty = F.array().cast("array<struct<hash:bigint,n:bigint>>")
    return sums.join(samples, "slice", "left").select(
        "slice", "n_rows", "sketch", "below", F.coalesce("sample", empty).alias("sample")
    )
