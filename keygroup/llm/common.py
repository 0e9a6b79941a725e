"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keygroup.names import quoted


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def others(df: DataFrame, added: Iterable[str]) -> list[str]:
    """Columns of ``df`` that no added column replaces; names compare without case."""
    taken = {name.lower() for name in added}
    return [c for c in df.columns if c.lower() not in taken]


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names of the arguments."""
    return df.select(*(F.col(quoted(source)).alias(name) for name, source in columns.items()))


def batches(schema: pa.Schema, rows: Iterable[tuple], size: int = 2048) -> Iterator[pa.RecordBatch]:
    """Arrow batches of ``size`` rows at most; none for no rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch(schema, held)
            held = []
    if held:
        yield batch(schema, held)


def batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([] for _ in schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(columns, schema)], schema=schema
    )
