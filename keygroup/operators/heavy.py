"""Heavy hitters: the keys of which a table may have more than a given weight.

Every task keeps a Misra-Gries summary of the hashes it meets, a bounded number of counters.
When they run over, the weight of the least one to keep is taken off all, and the task
notes how much that was: no hash is undercounted by more. Summaries are added up. A hash
whose sum, with all that tasks took off, stays below the limit cannot be heavy; the few
others are candidates, to be counted exactly. So what is shuffled is bounded by the
summaries, however many distinct keys there are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The summary travels to the executors by value, which then need no copy of this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Counters of a task, sixteen bytes each.
COUNTERS = 1 << 17
# The part of the limit that all tasks together may take off to hand on fewer counters.
TRIMMED = 0.25


class Summary:
    """A Misra-Gries summary of weighted numbers.

    ``taken`` is the most by which any number is undercounted.
    """

    def __init__(self, counters: int):
        self.counters = counters
        self.values = np.empty(0, np.int64)
        self.weights = np.empty(0, np.int64)
        self.taken = 0
        self._held: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def add(self, values: np.ndarray, weights: np.ndarray | None = None) -> None:
        """Take in a batch; it is counted once enough have come to make that worth it."""
        if weights is None:
            values, weights = np.unique(values, return_counts=True)
        self._held.append((values, weights.astype(np.int64)))
        self._size += len(values)
        if self._size >= self.counters:
            self.settle()

    def settle(self) -> None:
        values = np.concatenate([self.values, *(v for v, _ in self._held)])
        weights = np.concatenate([self.weights, *(w for _, w in self._held)])
        self._held, self._size = [], 0
        self.values, place = np.unique(values, return_inverse=True)
        sums = np.zeros(len(self.values), np.int64)
        np.add.at(sums, place, weights)
        off = 0
        if len(sums) > self.counters:
            # The greatest weight that does not fit; at least counters + 1 numbers give it up.
            off = int(np.partition(sums, len(sums) - self.counters - 1)[len(sums) - self.counters - 1])
        self.weights = sums
        self.take(off)

    def take(self, off: int) -> None:
        """Take ``off`` from every counter and drop those that have no more."""
        self.taken += off
        kept = self.weights > off
        self.values, self.weights = self.values[kept], self.weights[kept] - off


def summarised(
    rows: DataFrame, value: Column, weight: Column | None = None, counters: int = COUNTERS, spare: int = 0
) -> DataFrame:
    """``value, weight`` of each task's summary, and per task a row without value: what it took off.

    In the end a task takes off up to ``spare`` in all, so that light values go no further.
    Only the two columns reach Python, in Arrow batches. Weights must not be negative.
    """
    columns = [value.alias("value")] + ([] if weight is None else [weight.cast("bigint").alias("weight")])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(counters)
        for batch in stream:
            arrays = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            summary.add(*arrays)
        summary.settle()
        summary.take(max(0, spare - summary.taken))
        values = pa.array(np.r_[summary.values, 0], mask=np.r_[np.zeros(len(summary.values), bool), True])
        yield pa.RecordBatch.from_arrays(
            [values, pa.array(np.r_[summary.weights, summary.taken])], names=["value", "weight"]
        )

    return rows.select(*columns).mapInArrow(run, "value bigint, weight bigint")


@contextmanager
def heavy_values(
    rows: DataFrame, value: Column, limit: int, weight: Column | None = None, counters: int | None = None
) -> Iterator[DataFrame | None]:
    """The values that may weigh more than ``limit``, in a column ``value``; for use in a ``with`` block.

    ``value`` is a bigint, such as the hash of a key. None if the counters are too few for
    the limit, so that a value that no summary kept could be heavy.
    """
    tasks = max(1, rows.rdd.getNumPartitions())
    kept = summarised(rows, value, weight, counters or COUNTERS, int(limit * TRIMMED / tasks)).persist()
    try:
        taken = kept.where("value IS NULL").agg(F.sum("weight")).first()[0] or 0
        heavy = kept.where("value IS NOT NULL").groupBy("value").agg(F.sum("weight").alias("weight"))
        yield heavy.where(F.col("weight") > limit - taken).select("value") if taken <= limit else None
    finally:
        kept.unpersist()
