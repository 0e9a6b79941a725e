"""The type that each parameter of a predicate is compared with.

Spark decides it: the predicate is analysed over an empty frame with a column in place
of each parameter, once per type that the column could have. The type of a parameter is
the one for which the analysis has to add the fewest casts.
"""

from __future__ import annotations

import datetime
import decimal
import json
import re
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keygroup.errors import JobError
from keygroup.plans.spec import WhereClause

_BASIC = (
    T.BooleanType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(),
    T.StringType(), T.BinaryType(), T.DateType(), T.TimestampType(), T.TimestampNTZType(),
)
_INTEGER_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}

# Conditions of which the column is plain to see, joined by AND; they need no analysis.
_COLUMN = r"(?:`[^`]+`|[A-Za-z_]\w*)"
_CONDITION = (
    rf"{_COLUMN}\s*(?:(?:<=>|<=|>=|<>|!=|==|=|<|>)\s*\?"
    r"|(?:\bnot\s+)?\bin\s*\(\s*\?(?:\s*,\s*\?)*\s*\)"
    r"|(?:\bnot\s+)?\bbetween\s+\?\s+and\s+\?)"
)
# What stands before the first parameter of a list.
_IN = re.compile(r"\bin\s*\(\s*$", re.IGNORECASE)
_PLAIN = re.compile(rf"\s*{_CONDITION}(?:\s+and\s+{_CONDITION})*\s*", re.IGNORECASE)


def placeholder_types(where: WhereClause, df: DataFrame) -> list[T.DataType | None]:
    """A type per placeholder; None where any type is as good as another."""
    if _PLAIN.fullmatch(where.predicate):
        columns = where.compared_columns()
        if all(c in df.columns for c in columns):
            return [df.schema[c].dataType for c in columns]
    return _analysed(where, df)


def _analysed(where: WhereClause, df: DataFrame) -> list[T.DataType | None]:
    spark = df.sparkSession
    empty = spark.createDataFrame([], df.schema)
    candidates = list(dict.fromkeys([f.dataType for f in df.schema.fields] + list(_BASIC)))
    # One column stands for all the parameters of a list, between which there are only commas.
    groups = _lists(where)
    text = where.predicate
    marks = [f"__parameter_{i}" for i in range(len(groups))]
    for group, mark in reversed(list(zip(groups, marks))):
        first, last = where.placeholders[group.start], where.placeholders[group.stop - 1]
        text = f"{text[:first]}{mark}{text[last + 1:]}"
    text = text.replace("{", "{{").replace("}", "}}")

    def casts(types: list[T.DataType]) -> int | None:
        source = empty.select("*", *(F.lit(None).cast(t).alias(m) for m, t in zip(marks, types)))
        try:
            found = spark.sql(f"SELECT * FROM {{source}} WHERE ({text}\n)", source=source)
        except AnalysisException:
            return None
        plan = json.loads(found._jdf.queryExecution().analyzed().toJSON())
        [condition] = [node["condition"] for node in plan if node["class"].endswith(".Filter")][:1]
        # Nodes come parent first. A cast of a column to its own type changes nothing, and
        # that of a decimal to one of other digits does not count.
        kind = lambda node: str(node.get("dataType")).partition("(")[0]
        return sum(
            node["class"].endswith("expressions.Cast") and kind(node) != kind(child)
            for node, child in zip(condition, condition[1:])
        )

    # Each is varied with the others held; they are told by their arguments first.
    values = [[where.args[i] for i in group] for group in groups]
    types = [next((t for t in candidates if all(accepts(t, v) for v in own)), T.StringType()) for own in values]
    result: list[T.DataType | None] = []
    for i, own in enumerate(values):
        counts = {}
        for candidate in candidates:
            n = casts([*types[:i], candidate, *types[i + 1 :]])
            if n is not None:
                counts[candidate] = n
        if counts:
            least = [t for t, n in counts.items() if n == min(counts.values())]
            types[i] = next((t for t in least if all(accepts(t, v) for v in own)), least[0])
            found = None if len(least) == len(counts) > 1 else types[i]
        else:
            found = None if all(accepts(T.StringType(), v) for v in own) else T.StringType()
        result += [found] * len(own)
    return result


def _lists(where: WhereClause) -> list[range]:
    """Numbers of the parameters, those of one IN list together."""
    groups: list[range] = []
    last = None
    for i, at in enumerate(where.placeholders):
        between = "" if last is None else where.predicate[last + 1 : at]
        if groups and between.strip() == "," and _IN.search(where.predicate[: where.placeholders[groups[-1].start]]):
            groups[-1] = range(groups[-1].start, i + 1)
        else:
            groups.append(range(i, i + 1))
        last = at
    return groups


def check_types(name: str, where: WhereClause, df: DataFrame) -> None:
    """Every argument is a value of its parameter's type, without coercion."""
    for at, (dtype, value) in enumerate(zip(placeholder_types(where, df), where.args)):
        if dtype is not None and not accepts(dtype, value):
            raise JobError(
                f"cannot bind {value!r} ({type(value).__name__}) to parameter {at + 1} of {name}"
                f" of type {dtype.simpleString()}"
            )


def accepts(dtype: T.DataType, value: Any) -> bool:
    """Whether a Python value is one of the type as it stands."""
    for integer, bits in _INTEGER_BITS.items():
        if isinstance(dtype, integer):
            plain = isinstance(value, int) and not isinstance(value, bool)
            return plain and -(1 << bits - 1) <= value < 1 << bits - 1
    if isinstance(dtype, T.BooleanType):
        return isinstance(value, bool)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return isinstance(value, float)
    if isinstance(dtype, T.DecimalType):
        return isinstance(value, decimal.Decimal)
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return isinstance(value, str)
    if isinstance(dtype, T.BinaryType):
        return isinstance(value, (bytes, bytearray))
    if isinstance(dtype, T.TimestampNTZType):
        return isinstance(value, datetime.datetime) and value.tzinfo is None
    if isinstance(dtype, T.TimestampType):
        return isinstance(value, datetime.datetime)
    if isinstance(dtype, T.DateType):
        return isinstance(value, datetime.date) and not isinstance(value, datetime.datetime)
    return True
