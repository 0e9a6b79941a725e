"""From one query to one filtered, projected DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keygroup.functions.token import XXHASH_64, Tokenizer, key_columns
from keygroup.errors import JobError
from keygroup.names import TOKEN, quoted
from keygroup.plans.binding import placeholder_types
from keygroup.plans.checks import check_job
from keygroup.plans.spec import QuerySpec, WhereClause
from keygroup.sources.tables import Catalog, KeyedTable

def filtered(query: QuerySpec, table: KeyedTable, *more: Column) -> DataFrame:
    """The rows of ``table`` that satisfy the query's predicate: all columns and any
    ``more``.

    The predicate is bound and analysed by Spark, so it reaches the scan.
    """
    rows = table.rows.select("*", *more)
    if query.where is None:
        return rows
    predicate, args = _bound(query.where, table)
    # Braces mark DataFrame placeholders in spark.sql and are doubled to stay text.
    predicate = predicate.replace("{", "{{").replace("}", "}}")
    return table.df.sparkSession.sql(
        f"SELECT * FROM {{source}} WHERE ({predicate}\n)", args=args, source=rows
    )


def _bound(where: WhereClause, table: KeyedTable) -> tuple[str, list[Any]]:
    """The predicate and the arguments that Spark should bind.

    Python has no value for some column types. Bound as the next wider type, such
    an argument would turn the comparison away from the column and keep the filter
    from the scan, so it becomes a literal of the column's own type.
    """
    text, args = where.predicate, []
    literals = []
    for at, dtype, value in zip(where.placeholders, placeholder_types(where, table.df), where.args):
        if isinstance(dtype, T.FloatType):
            literals.append((at, f"CAST('{value!r}' AS FLOAT)"))
        elif isinstance(dtype, T.TimestampNTZType):
            literals.append((at, f"TIMESTAMP_NTZ'{value.replace(tzinfo=None).isoformat(sep=' ')}'"))
        else:
            args.append(bytes(value) if isinstance(value, bytearray) else value)
    for at, literal in reversed(literals):
        text = text[:at] + literal + text[at + 1 :]
    return text, args


def selected(query: QuerySpec, table: KeyedTable, group_by: Sequence[str]) -> dict[str, tuple[Column, T.DataType]]:
    """Output columns by name, with their types: the grouping columns first, then the
    query's own columns, repeats dropped."""
    terms = dict.fromkeys([*group_by, *query.columns]) if query.columns else table.df.columns
    found = {}
    for term in terms:
        if term in table.df.columns:
            found[term] = F.col(quoted(term)), table.type_of(term)
        else:
            [field] = table.df.select(F.expr(term)).schema.fields
            found[field.name] = F.expr(term), field.dataType
    return found


def scan(
    catalog: Catalog,
    query: QuerySpec,
    group_by: Sequence[str] = (),
    tokenizer: Tokenizer | None = XXHASH_64,
    token_range: tuple[int, int] | None = None,
) -> DataFrame:
    """Read one query as flat rows.

    The token comes first, then any partition-key column that the query does not
    select itself, the grouping columns and the selected columns. ``token_range``
    keeps one slice of the key space, both ends included. Without a tokenizer
    there is no token column, and the columns are those of the query alone.
    """
    [table] = check_job(catalog, [query], group_by)
    df = filtered(query, table)
    output = selected(query, table, group_by)
    columns = [column.alias(name) for name, (column, _) in output.items()]
    if tokenizer is None:
        if token_range is not None:
            raise ValueError("a token range needs a tokenizer")
        return df.select(*columns)
    token = tokenizer.column(*key_columns(table.partition_key, table.df.schema))
    if token_range is not None:
        df = df.where(token.between(*token_range))
    extra = [F.col(quoted(c)) for c in table.partition_key if c not in output]
    clash = [name for name in output if name.lower() == TOKEN]
    if clash:
        raise JobError(f"{query.name} selects {clash}, the name of the token; give it another one")
    return df.select(token.alias(TOKEN), *extra, *columns)
