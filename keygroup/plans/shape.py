"""The common row shape in which the rows of several queries meet.

Columns: ``_g0``, ``_g1``, … (the group key), ``_q`` (position of the query),
``s0``, ``s1``, … (the selected columns per query), ``_o0``, ``_o1``, … (clustering
columns that were not selected but give the order) and ``_h`` (hash of the other
columns, which settles ties). Of a series per query, only that of the row's own
query is not null.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keygroup.names import quoted
from keygroup.plans.scan import filtered, selected
from keygroup.plans.spec import QuerySpec
from keygroup.sources.tables import KeyedTable


@dataclass(frozen=True)
class Shaped:
    """All rows of a job, not yet shuffled.

    ``names`` are the users' names of the key columns. ``order`` holds, per query,
    the terms that order its rows inside a group. ``unique`` says that every table's
    rows are told apart by their keys. ``identified`` builds the same rows with
    ``_rid``, a lasting number that tells copies apart, if the tables have one; it is
    kept aside because reading it is not free. ``single`` says per query that the declared
    keys allow it one row in a group. ``in_place`` are the same rows, read by bucket, if all
    tables are stored in the same number of buckets.
    """

    rows: DataFrame
    names: list[str]
    n_partition_key: int
    payloads: list[str]
    order: list[list[str]]
    unique: bool
    identified: Callable[[], DataFrame | None]
    single: list[bool]
    in_place: DataFrame | None

    @property
    def keys(self) -> list[str]:
        return [f"_g{i}" for i in range(len(self.names))]

    @property
    def sort_terms(self) -> list[str]:
        """Order of all rows inside a group: query, clustering columns, tie hash."""
        clustering = [term for terms in self.order for term in terms if term != "_h"]
        return ["_q", *clustering, "_h"]

    @property
    def row_bytes(self) -> Column:
        """Size of the selected values of a row, near enough to bound a page."""
        sizes = [
            _bytes(F.col(f"{payload}.{quoted(field.name)}"), field.dataType)
            for payload in self.payloads
            for field in self.rows.schema[payload].dataType.fields
        ]
        return reduce(lambda a, b: a + b, sizes)

    @property
    def sortable(self) -> bool:
        """Whether the selected columns have an order of their own."""
        return not any(_holds_map(self.rows.schema[p].dataType) for p in self.payloads)


def shape(queries: Sequence[QuerySpec], tables: Sequence[KeyedTable], group_by: Sequence[str]) -> Shaped:
    keys = list(dict.fromkeys([*tables[0].partition_key, *group_by]))
    rows, order = _union(queries, tables, keys, group_by)
    # Grouped by a whole primary key, a query has at most one row in a group.
    single = [t.unique and set(t.clustering) <= set(group_by) for t in tables]

    def identified() -> DataFrame | None:
        lasting = all(t.unique or t.row_id is not None for t in tables)
        return _union(queries, tables, keys, group_by, True)[0] if lasting else None

    clustered = tables[0].buckets > 0 and len({t.buckets for t in tables}) == 1
    return Shaped(
        rows=rows,
        names=keys,
        n_partition_key=len(tables[0].partition_key),
        payloads=[f"s{index}" for index in range(len(queries))],
        order=order,
        unique=all(t.unique for t in tables),
        identified=identified,
        single=single,
        in_place=_union(queries, [t.in_place for t in tables], keys, group_by)[0] if clustered else None,
    )


def _union(
    queries: Sequence[QuerySpec],
    tables: Sequence[KeyedTable],
    keys: list[str],
    group_by: Sequence[str],
    identified: bool = False,
) -> tuple[DataFrame, list[list[str]]]:
    """All queries' rows in the common shape, and per query the terms of their order."""
    parts, order = [], []
    for index, (query, table) in enumerate(zip(queries, tables)):
        part, terms = _part(index, query, table, keys, group_by, identified)
        parts.append(part)
        order.append(terms)

    # Null placeholders give every part the columns of all the others.
    types = {f.name: f.dataType for part in parts for f in part.schema.fields}
    aligned = [
        part.select(
            *(F.col(quoted(c)) if c in part.columns else F.lit(None).cast(types[c]).alias(c) for c in types)
        )
        for part in parts
    ]
    return reduce(DataFrame.unionByName, aligned), order


def _part(
    index: int, query: QuerySpec, table: KeyedTable, keys: list[str], group_by: Sequence[str], identified: bool
) -> tuple[DataFrame, list[str]]:
    """One query's rows in the common shape, and the terms of their order."""
    output = selected(query, table, group_by)
    payload = {name: column for name, (column, _) in output.items() if name not in keys}
    clustering = [c for c in table.clustering if c not in keys]
    plain = {*group_by, *(query.columns or table.df.columns)}
    unselected = [c for c in clustering if c not in plain]
    order = [f"_o{index}.{quoted(c)}" if c in unselected else f"s{index}.{quoted(c)}" for c in clustering]
    ties = [
        _hashable(column, output[name][1])
        for name, column in payload.items()
        if name not in clustering and not table.unique
    ]
    # Under a name of its own a key column keeps the bucketing of its table known
    # through the union.
    terms = [F.col(quoted(c)).alias(f"_g{i}") for i, c in enumerate(keys)]
    terms.append(F.lit(index).alias("_q"))
    terms.append((F.xxhash64(*ties) if ties else F.lit(0).cast("bigint")).alias("_h"))
    row_id = []
    if identified:
        row_id = [(F.lit(0).cast("bigint") if table.unique else table.row_id).alias("_rid")]
        terms.append(F.col("_rid"))
    if unselected:
        terms.append(F.struct(*(F.col(quoted(c)) for c in unselected)).alias(f"_o{index}"))
    fields = [column.alias(name) for name, column in payload.items()]
    # A query for key columns alone still needs a value that marks its rows.
    terms.append(F.struct(*(fields or [F.lit(True).alias("present")])).alias(f"s{index}"))
    return filtered(query, table, *row_id).select(*terms), [*order, "_h"]


def row_size(schema: T.StructType) -> Column:
    """Size of the values of a row, near enough to weigh rows by."""
    return reduce(lambda a, b: a + b, [_bytes(F.col(quoted(f.name)), f.dataType) for f in schema.fields])


def _bytes(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        size = F.octet_length(column)
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        size = F.octet_length(F.to_json(F.struct(column)))
    else:
        return F.lit(8).cast("bigint")
    return F.coalesce(size, F.lit(0)).cast("bigint") + F.lit(8)


def _hashable(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.MapType):
        return F.map_entries(column)
    return F.to_json(F.struct(column)) if _holds_map(dtype) else column


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    return isinstance(dtype, (T.MapType, T.VariantType))
