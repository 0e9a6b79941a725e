"""A table in files sorted by token, with a manifest, so that any token range is read alone."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keygroup.functions.token import XXHASH_64, Tokenizer, key_columns, named_tokenizer
from keygroup.names import TOKEN, quoted
from keygroup.sources.tables import KeyedTable
from keygroup.workspace import delete

# Names that begin with an underscore are passed over when folders are listed.
_NOTE, _MANIFEST = "_keygroup", "_manifest"
ROWS_PER_FILE = 1_000_000
MANIFEST = "folder string, name string, low bigint, high bigint, n_rows bigint, n_bytes bigint"


@dataclass(frozen=True)
class TokenFiles:
    """Parquet files that hold the token of every row, ordered by token, key and clustering.

    A manifest names every file with its least and greatest token, its rows and its bytes.
    Reading a range opens the files that meet it, and in them, by the statistics of the
    stored token, the row groups that do; so a range costs what it holds, whatever slices
    anyone had in mind when the table was written. The rows of a key lie in as few files as
    hold them; a hot key fills several files of its own.

    Rows are added by ``append``. What is not in the manifest is never read, so files of a
    write that failed halfway do no harm.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    partition_key: tuple[str, ...]
    clustering: tuple[str, ...] = ()
    unique: bool = False
    require_keys: bool = False
    tokenizer: Tokenizer = XXHASH_64
    rows_per_file: int = ROWS_PER_FILE

    @classmethod
    def write(
        cls,
        table: KeyedTable,
        path: str,
        tokenizer: Tokenizer = XXHASH_64,
        rows_per_file: int = ROWS_PER_FILE,
        partitions: int | None = None,
    ) -> TokenFiles:
        """Lay ``table`` out below ``path``; an error if something is there.

        ``partitions`` are the sorting tasks, ``spark.sql.shuffle.partitions`` of them
        unless given; each writes files of ``rows_per_file`` rows at most.
        """
        named_tokenizer(tokenizer.name)
        if rows_per_file < 1:
            raise ValueError(f"rows_per_file must be positive, not {rows_per_file}")
        spark = table.df.sparkSession
        schema = T.StructType([*table.df.schema.fields, T.StructField(TOKEN, T.LongType())])
        note = {
            "schema": schema.jsonValue(), "partition_key": table.partition_key, "clustering": table.clustering,
            "unique": table.unique, "require_keys": table.require_keys, "tokenizer": tokenizer.name,
            "rows_per_file": rows_per_file,
        }
        spark.createDataFrame([(json.dumps(note),)], "note string").coalesce(1).write.text(f"{path}/{_NOTE}")
        files = cls.open(spark, path)
        files.append(table, partitions)
        return files

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> TokenFiles:
        """A layout written before, by any session."""
        note = json.loads(spark.read.text(f"{path}/{_NOTE}", wholetext=True).first()[0])
        schema = T.StructType.fromJson(note.pop("schema"))
        names = {key: tuple(note.pop(key)) for key in ("partition_key", "clustering")}
        return cls(spark, path, schema, tokenizer=named_tokenizer(note.pop("tokenizer")), **names, **note)

    def append(self, table: KeyedTable, partitions: int | None = None) -> None:
        """Add the rows of another table with the same columns; seen once its manifest is written."""
        if table.df.schema.names != self.schema.names[:-1] or table.partition_key != self.partition_key:
            raise ValueError(f"the rows to add need the columns {self.schema.names[:-1]} and the key {self.partition_key}")
        folder = f"rows-{uuid.uuid4().hex}"
        n = partitions or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        token = self.tokenizer.column(*key_columns(self.partition_key, table.df.schema))
        # The range also takes the clustering columns in, so that a hot key fills several partitions.
        terms = [TOKEN, *(quoted(c) for c in (*self.partition_key, *self.clustering))]
        ordered = table.rows.withColumn(TOKEN, token).repartitionByRange(n, *terms).sortWithinPartitions(*terms)
        ordered.write.option("maxRecordsPerFile", self.rows_per_file).parquet(f"{self.path}/{folder}")
        # The files tell what they hold; only their tokens are read.
        written = self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}")
        per_file = written.groupBy("_metadata.file_name", "_metadata.file_size").agg(
            F.min(TOKEN).alias("low"), F.max(TOKEN).alias("high"), F.count("*").alias("n_rows")
        )
        entries = per_file.select(
            F.lit(folder).alias("folder"), F.col("file_name").alias("name"), "low", "high", "n_rows",
            F.col("file_size").alias("n_bytes"),
        )
        # One file, so that a reader sees all of an addition or nothing.
        entries.coalesce(1).write.mode("append").parquet(f"{self.path}/{_MANIFEST}")

    def manifest(self, low: int | None = None, high: int | None = None) -> DataFrame:
        """The files that may hold tokens from ``low`` to ``high``, a row each."""
        entries = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/{_MANIFEST}")
        low, high = self._range(low, high)
        return entries.where((F.col("high") >= low) & (F.col("low") <= high))

    def read(self, low: int | None = None, high: int | None = None) -> KeyedTable:
        """The rows with a token from ``low`` to ``high``, both included."""
        return self._keyed(self.tokens(low, high).drop(TOKEN))

    def tokens(self, low: int | None = None, high: int | None = None) -> DataFrame:
        """The same rows as a frame that also has their stored ``_token``.

        The names of the files of the range are held on the driver.
        """
        found = self.manifest(low, high).select("folder", "name").collect()
        if not found:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}/{name}" for f, name in sorted(found)))
        first, last = self._range(low, high)
        if (first, last) == (self.tokenizer.low, self.tokenizer.high):
            return rows
        return rows.where(F.col(TOKEN).between(first, last))

    def iterate(self, slices) -> Iterator[tuple[tuple[int, int], KeyedTable]]:
        """One lazy table per slice, each over its own files; the manifest is read once."""
        names = ("folder", "name", "low", "high")
        entries = sorted(tuple(r) for r in self.manifest().select(*names).collect())
        for low, high in slices:
            paths = [f"{self.path}/{f}/{name}" for f, name, least, most in entries if most >= low and least <= high]
            if paths:
                rows = self.spark.read.schema(self.schema).parquet(*paths).where(F.col(TOKEN).between(low, high))
            else:
                rows = self.spark.createDataFrame([], self.schema)
            yield (low, high), self._keyed(rows.drop(TOKEN))

    def delete(self) -> bool:
        """Delete the files; whether there were any."""
        return delete(self.spark, self.path)

    def _range(self, low: int | None, high: int | None) -> tuple[int, int]:
        return self.tokenizer.low if low is None else low, self.tokenizer.high if high is None else high

    def _keyed(self, df: DataFrame) -> KeyedTable:
        return KeyedTable(df, self.partition_key, self.clustering, self.unique, self.require_keys)
