"""Functions that see the rows of every query of a group apart, as streams.

The rows of a group come to one task in the order of their queries. They are handed on
as Arrow batches, one iterator per query, and never gathered: a group of any size passes
through in the memory of a batch.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle

# The functions travel to the executors by value, which then need no copy of this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A stretch of rows: their key, the position of their query, and their payload.
Stretch = tuple[tuple, int, pa.RecordBatch]


def stretches(stream: Iterable[pa.RecordBatch], n_keys: int, batch_rows: int) -> Iterator[Stretch]:
    """Cut sorted batches where the key or the query changes.

    Columns are the keys, ``_q`` and a struct per query. A stretch has the columns of its
    own query only, so that nulls of the others change no type, and ``batch_rows`` rows at most.
    """
    for batch in stream:
        if not batch.num_rows:
            continue
        codes = [_codes(column) for column in batch.columns[: n_keys + 1]]
        changes = np.zeros(batch.num_rows, bool)
        for code in codes:
            changes[1:] |= code[1:] != code[:-1]
        starts = np.r_[0, np.flatnonzero(changes), batch.num_rows]
        queries = batch.column(n_keys)
        sides: dict[int, pa.RecordBatch] = {}
        for start, stop in zip(starts, starts[1:]):
            start, stop = int(start), int(stop)
            key = tuple(_one(batch.column(i)[start].as_py()) for i in range(n_keys))
            query = queries[start].as_py()
            if query not in sides:
                sides[query] = _unfolded(batch.column(n_keys + 1 + query))
            for at in range(start, stop, batch_rows):
                yield key, query, sides[query].slice(at, min(batch_rows, stop - at))


def _codes(column: pa.Array) -> np.ndarray:
    """Numbers that are equal in neighbouring rows of equal values, nulls and NaN included."""
    try:
        encoded = column.dictionary_encode()
    except pa.ArrowNotImplementedError:
        values, codes = [_one(v) for v in column.to_pylist()], [0]
        for a, b in zip(values, values[1:]):
            codes.append(codes[-1] + (a != b))
        return np.array(codes)
    return encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False)


class _NotANumber:
    """One value that equals itself, for comparing keys."""


_NAN = _NotANumber()


def _one(value):
    """The value, or one that equals itself for those that do not."""
    unequal = value is pd.NaT or (isinstance(value, (float, np.floating)) and value != value)
    return _NAN if unequal else value


def _unfolded(column: pa.StructArray) -> pa.RecordBatch:
    fields = [column.type.field(i) for i in range(column.type.num_fields)]
    # Rows of other queries are null here, but no slice reaches them.
    return pa.RecordBatch.from_arrays([column.field(i) for i in range(len(fields))], schema=pa.schema(fields))


class Sides:
    """The rows of one group, as one iterator per query that all draw on a single stream."""

    def __init__(self, rows: Iterator[Stretch]):
        self._rows = rows
        self._held: Stretch | None = next(rows, None)
        self._reached = 0

    def side(self, query: int) -> Iterator[pa.RecordBatch]:
        """Batches of one query, in group order.

        Sides are read one after the other. A side may be left out or left early; but what
        a later one has passed is gone, and to ask for it is an error.
        """
        while True:
            if self._reached > query:
                raise RuntimeError(f"side {query} was passed when side {self._reached} was read")
            self._reached = query
            while self._held is not None and self._held[1] < query:
                self._held = next(self._rows, None)
            if self._held is None or self._held[1] > query:
                return
            batch, self._held = self._held[2], next(self._rows, None)
            yield batch


def run_sides(
    stream: Iterable[pa.RecordBatch],
    function: Callable,
    n_keys: int,
    n_sides: int,
    schema: pa.Schema,
    batch_rows: int,
) -> Iterator[pa.RecordBatch]:
    """Call ``function(key, *sides)`` for every group; its results, in batches of ``schema``."""
    held: list[pa.RecordBatch] = []
    size = 0
    for key, rows in groupby(stretches(stream, n_keys, batch_rows), key=lambda s: s[0]):
        sides = Sides(rows)
        plain = tuple(float("nan") if v is _NAN else v for v in key)
        for result in function(plain, *(sides.side(i) for i in range(n_sides))) or ():
            for batch in _batches(result, schema):
                held.append(batch)
                size += batch.num_rows
                # Small results of many groups travel together.
                if size >= batch_rows:
                    yield from pa.Table.from_batches(held, schema).combine_chunks().to_batches(batch_rows)
                    held, size = [], 0
    if size:
        yield from pa.Table.from_batches(held, schema).combine_chunks().to_batches(batch_rows)


def _batches(result, schema: pa.Schema) -> list[pa.RecordBatch]:
    """A result of the user's function in the declared schema; columns go by name."""
    if isinstance(result, pd.DataFrame):
        result = pa.Table.from_pandas(result, preserve_index=False)
    elif isinstance(result, pa.RecordBatch):
        result = pa.Table.from_batches([result])
    elif isinstance(result, dict):
        return [pa.RecordBatch.from_arrays([pa.array(result[f.name], f.type) for f in schema], schema=schema)]
    missing = [name for name in schema.names if name not in result.column_names]
    if missing:
        raise ValueError(f"the result has no columns {missing}")
    return result.select(schema.names).cast(schema).to_batches()


def merged_in_order(
    stream: Iterable[pd.DataFrame], merge: Callable, keys: list[str], most_rows: int
) -> Iterator[pd.DataFrame]:
    """Join the results of pages, sorted by ``keys`` and ``_page``, to one per key.

    Results of whole pages are held until they have ``most_rows`` rows and are then merged
    with what came before; a frame holds no more than these, one more page and one merged
    result. A batch of the stream may hold many keys, and a key many batches.
    """
    key, page, first, held, size = None, None, 0, [], 0

    def joined() -> pd.DataFrame:
        return merge(pd.concat(held, ignore_index=True))

    for frame in stream:
        if not len(frame):
            continue
        changes = np.zeros(len(frame), bool)
        for name in (*keys, "_page"):
            codes = _frame_codes(frame[name])
            changes[1:] |= codes[1:] != codes[:-1]
        starts = np.r_[0, np.flatnonzero(changes), len(frame)]
        for start, stop in zip(starts, starts[1:]):
            own = tuple(_one(frame[name].iloc[start]) for name in keys)
            if held and own != key:
                yield joined().assign(_page=first)
                held, size = [], 0
            elif size >= most_rows and frame["_page"].iloc[start] != page:
                held = [joined()]
                size = len(held[0])
            page = frame["_page"].iloc[start]
            if not held:
                key, first = own, page
            held.append(frame.iloc[start:stop].drop(columns="_page"))
            size += stop - start
    if held:
        yield joined().assign(_page=first)


def _frame_codes(column: pd.Series) -> np.ndarray:
    try:
        return pd.factorize(column)[0]
    except TypeError:
        return pd.factorize(column.map(repr))[0]
