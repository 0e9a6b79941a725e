"""Checks of a job against the schemas of its tables; no job is started."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keygroup.errors import JobError
from keygroup.names import is_reserved
from keygroup.plans.binding import check_types
from keygroup.plans.spec import QuerySpec
from keygroup.sources.tables import Catalog, KeyedTable

_GROUPABLE = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
    T.StringType,
    T.CharType,
    T.VarcharType,
    T.BinaryType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


def check_job(catalog: Catalog, queries: Sequence[QuerySpec], group_by: Sequence[str]) -> list[KeyedTable]:
    """Run every check and return the tables in query order."""
    if not queries:
        raise JobError("a job needs at least one query")
    tables = [catalog.lookup(q.keyspace, q.table) for q in queries]
    check_partition_keys(queries, tables)
    check_grouping(queries, tables, group_by)
    for query, table in zip(queries, tables):
        check_columns(query, table, group_by)
        check_arguments(query, table)
    return tables


def check_partition_keys(queries: Sequence[QuerySpec], tables: Sequence[KeyedTable]) -> None:
    """All tables have the same partition key: count, names and types by position."""
    first = [(c, tables[0].type_of(c)) for c in tables[0].partition_key]
    for query, table in zip(queries, tables):
        key = [(c, table.type_of(c)) for c in table.partition_key]
        if len(key) != len(first):
            raise JobError(f"{query.name} has {len(key)} partition-key columns, {queries[0].name} has {len(first)}")
        for (name, dtype), (first_name, first_type) in zip(key, first):
            if name != first_name:
                raise JobError(f"partition-key column {name} of {query.name} should be named {first_name}")
            if dtype != first_type:
                raise JobError(
                    f"partition-key column {name} is {dtype.simpleString()} in {query.name}"
                    f" but {first_type.simpleString()} in {queries[0].name}"
                )
            check_groupable(query, name, dtype)


def check_grouping(queries: Sequence[QuerySpec], tables: Sequence[KeyedTable], group_by: Sequence[str]) -> None:
    """Grouping columns are clustering columns of every table, of one groupable type."""
    for query, table in zip(queries, tables):
        unknown = [c for c in group_by if c not in table.clustering]
        if unknown:
            raise JobError(f"grouping columns {unknown} are no clustering columns of {query.name}")
        for column in group_by:
            dtype = table.type_of(column)
            check_groupable(query, column, dtype)
            if dtype != tables[0].type_of(column):
                raise JobError(f"grouping column {column} has another type in {query.name} than in {queries[0].name}")
        clash = [c for c in (*table.partition_key, *group_by) if is_reserved(c)]
        if clash:
            raise JobError(f"key columns {clash} of {query.name} bear reserved names")


def check_groupable(query: QuerySpec, column: str, dtype: T.DataType) -> None:
    collated = isinstance(dtype, T.StringType) and not dtype.isUTF8BinaryCollation()
    if collated or not isinstance(dtype, _GROUPABLE):
        raise JobError(f"cannot group {query.name} by {column} of type {dtype.simpleString()}")


def check_columns(query: QuerySpec, table: KeyedTable, group_by: Sequence[str]) -> None:
    """Every selected term is a column of the table or an expression over its columns,
    and an expression has a name of its own."""
    taken = {*table.partition_key, *group_by, *(c for c in query.columns if c in table.df.columns)}
    for term in dict.fromkeys(query.columns):
        if term in table.df.columns:
            continue
        try:
            names = table.df.select(F.expr(term)).columns
        except AnalysisException as error:
            raise JobError(f"{query.name} has no column {term}") from error
        if len(names) != 1 or names[0] in taken:
            raise JobError(f"{query.name} needs one new name for {term}")
        taken.update(names)


def check_arguments(query: QuerySpec, table: KeyedTable) -> None:
    """As many arguments as placeholders, each of its column's type, without coercion."""
    where = query.where
    if where is None:
        return
    if len(where.placeholders) != len(where.args):
        raise JobError(f"{query.name} has {len(where.placeholders)} placeholders but {len(where.args)} arguments")
    check_types(query.name, where, table.df)
