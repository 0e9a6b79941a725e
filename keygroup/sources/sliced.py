"""A table laid out by token slice, so that reading a slice opens only its files."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keygroup.functions.token import XXHASH_64, Tokenizer, key_columns, named_tokenizer
from keygroup.names import SLICE
from keygroup.sources.tables import KeyedTable
from keygroup.workspace import delete

# Spark's listing of a table passes over names that begin with an underscore.
_NOTE = "_keygroup"
# So that the tasks that read a slice are as many as its rows ask for.
ROWS_PER_FILE = 1_000_000


@dataclass(frozen=True)
class SlicedTable:
    """Parquet files under one folder per slice of the key space.

    A note beside the files holds what is needed to open them again: the keys, the
    schema, the number of slices, the tokenizer and the slices that hold rows, at most
    ``n`` of them. The files are listed once per object.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    n: int
    partition_key: tuple[str, ...]
    clustering: tuple[str, ...] = ()
    unique: bool = False
    require_keys: bool = False
    tokenizer: Tokenizer = XXHASH_64
    slices: tuple[int, ...] = ()

    @classmethod
    def write(cls, table: KeyedTable, path: str, n: int, tokenizer: Tokenizer = XXHASH_64) -> SlicedTable:
        """Write ``table`` once, cut into ``n`` equal slices.

        Rows are rebalanced by slice: small slices share a writer, and a slice
        swollen by a hot key is spread over several writers and files.
        """
        named_tokenizer(tokenizer.name)
        spark = table.df.sparkSession
        token = tokenizer.column(*key_columns(table.partition_key, table.df.schema))
        sliced = table.rows.withColumn(SLICE, tokenizer.slice_of(token, n))
        spread = sliced.hint("rebalance", F.col(SLICE))
        spread.write.option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(SLICE).parquet(path)
        schema = T.StructType([*table.df.schema.fields, T.StructField(SLICE, T.IntegerType())])
        # The folders tell which slices there are; no file has to be opened.
        present = spark.read.schema(schema).parquet(path).select(SLICE).distinct().collect()
        note = {
            "schema": schema.jsonValue(), "n": n, "partition_key": table.partition_key, "clustering": table.clustering,
            "unique": table.unique, "require_keys": table.require_keys, "tokenizer": tokenizer.name,
            "slices": sorted(row[0] for row in present),
        }
        spark.createDataFrame([(json.dumps(note),)], "note string").coalesce(1).write.text(f"{path}/{_NOTE}")
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> SlicedTable:
        """A layout written before, by any session."""
        note = json.loads(spark.read.text(f"{path}/{_NOTE}", wholetext=True).first()[0])
        schema = T.StructType.fromJson(note.pop("schema"))
        names = {key: tuple(note.pop(key)) for key in ("partition_key", "clustering", "slices")}
        tokenizer = named_tokenizer(note.pop("tokenizer"))
        return cls(spark, path, schema, tokenizer=tokenizer, **names, **note)

    def read(self, first: int = 0, last: int | None = None) -> KeyedTable:
        """Slices ``first`` to ``last``, both included; the other folders are pruned."""
        last = self.n - 1 if last is None else last
        df = self._frame
        if (first, last) != (0, self.n - 1):
            df = df.where(F.col(SLICE).between(first, last))
        return KeyedTable(df.drop(SLICE), self.partition_key, self.clustering, self.unique, self.require_keys)

    def present(self) -> list[int]:
        """Indexes of the slices that hold rows."""
        return list(self.slices)

    def __iter__(self) -> Iterator[tuple[int, KeyedTable]]:
        """One slice after the other, empty ones skipped."""
        for index in self.slices:
            yield index, self.read(index, index)

    def delete(self) -> bool:
        """Delete the files; whether there were any."""
        return delete(self.spark, self.path)

    @cached_property
    def _frame(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)
