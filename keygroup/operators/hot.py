"""Groups too large for one task: finding them and numbering their rows.

One key may hold a large share of all rows. Such a group is never sorted, numbered
or collected as a whole: its rows are range-partitioned by key and order, numbered
inside each partition, and shifted by the sizes of the partitions before.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keygroup.names import quoted
from keygroup.operators.heavy import heavy_values
from keygroup.sources.tables import KeyedTable
from keygroup.workspace import materialise, temporary

# Largest key table, in bytes, that is shipped to every executor.
BROADCAST_BYTES = 32 << 20

# Room that a row of such a table takes beside its values.
ROW_BYTES = 64

# Rows, and bytes of their selected values, of hot groups per sort task.
ROWS_PER_TASK = 1_000_000
BYTES_PER_TASK = 256 << 20


@dataclass(frozen=True)
class HotKeys:
    """Keys whose rows outgrow a page, and measures of them."""

    keys: list[str]
    table: DataFrame
    n_keys: int
    n_rows: int
    largest: int
    total: int
    key_bytes: int
    widest_key: int

    def matches(self, rows: DataFrame, kind: str) -> DataFrame:
        """Rows of hot groups (``left_semi``) or of all others (``left_anti``)."""
        table = _aside(self.table, self.keys)
        if self.key_bytes <= BROADCAST_BYTES:
            table = F.broadcast(table)
        return rows.join(table, _same_key(self.keys), kind)

    def with_numbers(self, rows: DataFrame) -> DataFrame:
        """Rows of hot groups, with ``_n``, the number of rows of their group."""
        table = _aside(self.table, self.keys, "_n")
        if self.key_bytes <= BROADCAST_BYTES:
            table = F.broadcast(table)
        return rows.join(table, _same_key(self.keys)).select(*rows.columns, "_n")


def find_hot_keys(
    rows: DataFrame, keys: list[str], limit: int, weight: Column | None = None, paths: list[str] | None = None
) -> HotKeys | None:
    """Sum up the weight of the rows per key, one each unless given; keep the keys
    above the limit.

    Each task summarises the hashes of its keys in a bounded number of counters, eight
    bytes a row on their way there. Only the rows of the few hashes that may be above the
    limit are summed by key, so what is shuffled does not grow with the number of keys.
    Where the rows are so many that the summaries prove nothing for the limit, sums are
    made per hash, sixteen bytes each; partial sums shrink before the shuffle, so a hot key
    costs no more than any other. Unweighted, only the key columns are read.
    """
    number = F.count("*")
    total = number if weight is None else F.sum(weight)
    hashed = _hashed(keys)
    with heavy_values(rows, hashed, limit, weight) as found:
        if found is None:
            found = rows.groupBy(hashed.alias("value")).agg(total.alias("_w")).where(F.col("_w") > limit)
        heavy = found.select(F.col("value").alias("_kh"))
        # Kept between the count and its use, so that the rows are hashed once.
        heavy.persist()
        try:
            n_heavy = heavy.count()
            if not n_heavy:
                return None
            wanted = F.broadcast(heavy) if n_heavy * ROW_BYTES <= BROADCAST_BYTES else heavy
            near = rows.join(wanted, hashed == F.col("_kh"), "left_semi")
            return _exact(near, keys, limit, number, total, paths)
        finally:
            heavy.unpersist()


def heavy_keys(table: KeyedTable, limit: int, weight: Column | None = None) -> DataFrame:
    """The partition keys with more than ``limit`` rows, or weight, with ``n_rows`` and ``weight``.

    Exact, and found as ``find_hot_keys`` does; null keys are a key, too.
    """
    if limit < 0:
        raise ValueError(f"limit must not be negative, but is {limit}")
    names = table.partition_key
    inner = [f"_g{i}" for i in range(len(names))]
    weighed = [] if weight is None else [weight.cast("bigint").alias("_weight")]
    rows = table.rows.select(*(F.col(quoted(c)).alias(k) for c, k in zip(names, inner)), *weighed)
    found = find_hot_keys(rows, inner, limit, None if weight is None else F.col("_weight"))
    if found is None:
        found_rows = rows.limit(0).select(*inner, F.lit(0).cast("bigint").alias("_n"), F.lit(0).cast("bigint").alias("_w"))
    else:
        found_rows = found.table
    return found_rows.select(
        *(F.col(k).alias(c) for c, k in zip(names, inner)), F.col("_n").alias("n_rows"), F.col("_w").alias("weight")
    )


def _hashed(keys: Sequence[str]) -> Column:
    """A hash of the key, the same for equal keys."""
    return F.xxhash64(*keys)


def _exact(
    rows: DataFrame, keys: list[str], limit: int, number: Column, total: Column, paths: list[str] | None
) -> HotKeys | None:
    """Keys above the limit, among the rows of hashes that are."""
    hot = rows.groupBy(*keys).agg(number.alias("_n"), total.alias("_w")).where(F.col("_w") > limit)
    width = reduce(lambda a, b: a + b, [_width(rows, k) for k in keys])
    # The few keys found are measured and then, if there are any, stored; they are
    # kept between the two so that the rows are counted once.
    hot.persist()
    try:
        found = hot.agg(
            F.count("*").alias("n_keys"),
            F.sum("_n").alias("n_rows"),
            F.max("_w").alias("largest"),
            F.sum("_w").alias("total"),
            F.sum(width).alias("key_bytes"),
            F.max(width).alias("widest_key"),
        ).first()
        return HotKeys(keys, materialise(hot, "hot-keys", paths), **found.asDict()) if found.n_keys else None
    finally:
        hot.unpersist()


def number_rows(
    rows: DataFrame,
    order: Sequence[str],
    hot: HotKeys,
    distinct: Sequence[str] | None = None,
    weight: Column | None = None,
    paths: list[str] | None = None,
) -> DataFrame:
    """Add ``_pos``, the 1-based position of a row in its hot group, and ``_before``,
    the weight of the rows before it.

    ``distinct`` are terms that tell rows of equal key and order apart.
    """
    columns = [c for c in rows.columns if c not in (distinct or ())]
    if weight is not None:
        rows = rows.withColumn("_w", weight)
    terms = [*hot.keys, *order]
    n = sort_tasks(rows, hot)
    if distinct is not None:
        placed = _placed(rows, [*terms, *distinct], n, unneeded=distinct, paths=paths)
    else:
        # Copies of a row cannot be split by value. A row id does it, and since it is
        # written out before it is used, a repeated task cannot change it.
        with temporary(rows.withColumn("_rid", F.monotonically_increasing_id()), "hot-rows") as stored:
            placed = _placed(stored, [*terms, "_rid"], n, unneeded=["_rid"], paths=paths)

    # A run is the part of a group in one partition: at most one per hot key, and one
    # more per partition border.
    measures = {"_n": F.count("*")} if weight is None else {"_n": F.count("*"), "_w": F.sum("_w")}
    runs = placed.groupBy(*hot.keys, "_part").agg(
        F.min("_idx").alias("_start"), *(total.alias(name) for name, total in measures.items())
    )
    earlier = Window.partitionBy(*hot.keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = (F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_earlier{name}") for name in measures)
    runs = _aside(runs, hot.keys, F.col("_part").alias("_run"), "_start", *sums)
    if hot.key_bytes + n * hot.widest_key + (hot.n_keys + n) * ROW_BYTES <= BROADCAST_BYTES:
        runs = F.broadcast(runs)
    numbered = placed.join(runs, _same_key(hot.keys) & (F.col("_part") == F.col("_run")))
    position = F.col("_idx") - F.col("_start") + F.col("_earlier_n") + 1
    before = position - 1
    if weight is not None:
        inside = Window.partitionBy(*hot.keys, "_part").orderBy("_idx").rowsBetween(Window.unboundedPreceding, -1)
        before = F.col("_earlier_w") + F.coalesce(F.sum("_w").over(inside), F.lit(0))
    return numbered.select(*columns, position.alias("_pos"), before.alias("_before"))


def sort_tasks(rows: DataFrame, hot: HotKeys) -> int:
    """Tasks that sort the rows of hot groups: as many as their number and width ask for.

    The width is Spark's estimate for a row of these columns, or more where the summed
    weights are bytes and tell so.
    """
    width = sum(_field_bytes(f.dataType) for f in rows.schema.fields)
    size = max(hot.n_rows * width, hot.total)
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-hot.n_rows // ROWS_PER_TASK), -(-size // BYTES_PER_TASK))


def _field_bytes(dtype: T.DataType) -> int:
    """A guess at the bytes of a value; texts and lists count for a short one."""
    if isinstance(dtype, T.StructType):
        return 8 + sum(_field_bytes(f.dataType) for f in dtype.fields)
    if isinstance(dtype, (T.StringType, T.BinaryType, T.ArrayType, T.MapType)):
        return 64
    return 8


def _placed(
    rows: DataFrame, terms: Sequence[str], n: int, unneeded: Sequence[str], paths: list[str] | None
) -> DataFrame:
    """Rows in ``n`` sorted partitions, with the partition and an index that grows in it."""
    ordered = rows.repartitionByRange(n, *terms).sortWithinPartitions(*terms).drop(*unneeded)
    indexed = ordered.withColumn("_part", F.spark_partition_id()).withColumn("_idx", F.monotonically_increasing_id())
    return materialise(indexed, "hot-order", paths)


def _aside(df: DataFrame, keys: Sequence[str], *others: Column | str) -> DataFrame:
    """The keys under other names, for a join with rows that bear them."""
    return df.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), *others)


def _same_key(keys: Sequence[str]) -> Column:
    """Keys are equal; nulls form a group of their own."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])


def _width(rows: DataFrame, key: str) -> Column:
    if isinstance(rows.schema[key].dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(key), F.lit(0)).cast("bigint") + F.lit(ROW_BYTES)
    return F.lit(ROW_BYTES).cast("bigint")
