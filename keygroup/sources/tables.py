"""Keyed tables and the catalog that names them."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property, reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keygroup.errors import JobError, UnknownTableError
from keygroup.names import quoted


@dataclass(frozen=True)
class KeyedTable:
    """A relation with a declared partition key and clustering columns.

    File formats carry no keys, so they are declared here. The clustering columns
    give the order of rows under one partition key. ``unique`` says that both
    together identify a row, so that no other column is needed to settle the order;
    ``require_keys`` leaves out rows with a null in the partition key.

    A table stored in ``buckets`` of its partition key has a second frame for the
    same rows, ``bucketed``, that reads a bucket per task.
    """

    df: DataFrame
    partition_key: tuple[str, ...]
    clustering: tuple[str, ...] = ()
    unique: bool = False
    require_keys: bool = False
    bucketed: DataFrame | None = None
    buckets: int = 0

    def __post_init__(self) -> None:
        object.__setattr__(self, "partition_key", _names(self.partition_key))
        object.__setattr__(self, "clustering", _names(self.clustering))
        if not self.partition_key:
            raise JobError("a keyed table needs at least one partition-key column")
        primary = [*self.partition_key, *self.clustering]
        if len(set(primary)) != len(primary):
            raise JobError(f"a key column is declared twice: {primary}")
        if len(set(self.df.columns)) != len(self.df.columns):
            raise JobError(f"a column name occurs twice: {self.df.columns}")
        missing = [c for c in primary if c not in self.df.columns]
        if missing:
            raise JobError(f"key columns {missing} are not among {self.df.columns}")

    @classmethod
    def of(
        cls,
        df: DataFrame,
        partition_key: str | Sequence[str],
        clustering: str | Sequence[str] = (),
        rename: Mapping[str, str] | None = None,
        unique: bool = False,
        require_keys: bool = False,
    ) -> KeyedTable:
        """Declare the keys of ``df``; ``rename`` aligns key names between tables."""
        renamed = df.withColumnsRenamed(dict(rename)) if rename else df
        return cls(renamed, partition_key, clustering, unique, require_keys)

    @classmethod
    def stored(cls, spark: SparkSession, relation: str, **keys: Any) -> KeyedTable:
        """A table or view that the session knows by name, with its keys.

        Keys that are not given are those that ``declare_keys`` has put into the catalog.
        If the table is bucketed by its partition key, groups may be read in place.
        """
        if not keys.get("partition_key"):
            keys = {**declared_keys(spark, relation, keys.get("rename")), **keys}
        named = cls.of(spark.table(relation), **keys)
        described = [tuple(r)[:2] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {relation}").collect()]
        heads = [i for i, (name, _) in enumerate(described) if name.startswith("# Detailed")]
        details = dict(described[heads[-1] :]) if heads else {}
        rename = keys.get("rename") or {}
        columns = [rename.get(c, c) for c in details.get("Bucket Columns", "").strip("[]").replace("`", "").split(", ")]
        # Raw files stand for the table only if no partition can be elsewhere or dropped.
        partitioned = any(name.startswith("# Partition") for name, _ in described)
        if partitioned or columns != list(named.partition_key) or details["Provider"].lower() != "parquet":
            return named
        files = spark.read.schema(spark.table(relation).schema).parquet(details["Location"])
        plain = cls.of(files, **keys)
        return replace(plain, bucketed=named.df, buckets=int(details["Num Buckets"]))

    @property
    def in_place(self) -> KeyedTable:
        """The same table, read bucket by bucket."""
        return replace(self, df=self.bucketed)

    @property
    def rows(self) -> DataFrame:
        """The table's rows, without null partition keys if those are barred."""
        if not self.require_keys:
            return self.df
        present = reduce(lambda a, b: a & b, [F.col(quoted(c)).isNotNull() for c in self.partition_key])
        return self.df.where(present)

    @cached_property
    def row_id(self) -> Column | None:
        """A number that tells rows apart and never changes: a hash of the place in a
        file, for frames that read Parquet directly."""
        place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
        try:
            self.df.select(place)
        except AnalysisException:
            return None
        return place

    def type_of(self, column: str) -> T.DataType:
        return self.df.schema[column].dataType


@dataclass
class Catalog:
    """Keyed tables under two-part, case-sensitive names.

    Files and relations are looked at when a query first names them, not before.
    """

    spark: SparkSession
    _tables: dict[str, dict[str, KeyedTable | Callable[[], KeyedTable]]] = field(default_factory=dict)

    def add(self, keyspace: str, table: str, keyed: KeyedTable) -> Catalog:
        self._tables.setdefault(keyspace, {})[table] = keyed
        return self

    def add_files(
        self,
        keyspace: str,
        table: str,
        path: str | list[str],
        format: str = "parquet",
        schema: T.StructType | str | None = None,
        options: Mapping[str, str] | None = None,
        **keys: Any,
    ) -> Catalog:
        """Register files of any format that ``spark.read`` knows.

        ``keys`` are the arguments of ``KeyedTable.of``.
        """

        def load() -> KeyedTable:
            reader = self.spark.read.format(format).options(**(options or {}))
            if schema is not None:
                reader = reader.schema(schema)
            return KeyedTable.of(reader.load(path), **keys)

        return self._add_later(keyspace, table, load)

    def add_table(self, keyspace: str, table: str, relation: str, **keys: Any) -> Catalog:
        """Register a table or view that the session knows by name; without keys, by its declared ones."""
        return self._add_later(keyspace, table, lambda: KeyedTable.stored(self.spark, relation, **keys))

    def _add_later(self, keyspace: str, table: str, load: Callable[[], KeyedTable]) -> Catalog:
        self._tables.setdefault(keyspace, {})[table] = load
        return self

    def lookup(self, keyspace: str, table: str) -> KeyedTable:
        if keyspace not in self._tables:
            raise UnknownTableError(f"cannot find keyspace {keyspace}")
        if table not in self._tables[keyspace]:
            raise UnknownTableError(f"cannot find table {table} in keyspace {keyspace}")
        found = self._tables[keyspace][table]
        if not isinstance(found, KeyedTable):
            try:
                found = found()
            except AnalysisException as error:
                raise UnknownTableError(f"cannot read table {keyspace}.{table}: {error}") from error
            self._tables[keyspace][table] = found
        return found


# The property of a table under which its keys are kept.
_PROPERTY = "keygroup.keys"


def declare_keys(
    spark: SparkSession,
    relation: str,
    partition_key: str | Sequence[str],
    clustering: str | Sequence[str] = (),
    unique: bool = False,
    require_keys: bool = False,
) -> KeyedTable:
    """Keep the keys of a stored table in the catalog, as a property of the table.

    They are checked against its columns here, and again whenever the table is opened.
    """
    keys = dict(
        partition_key=_names(partition_key), clustering=_names(clustering), unique=unique, require_keys=require_keys
    )
    KeyedTable.of(spark.table(relation), **keys)
    text = json.dumps(keys).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {relation} SET TBLPROPERTIES ('{_PROPERTY}' = '{text}')")
    return KeyedTable.stored(spark, relation)


def declared_keys(spark: SparkSession, relation: str, rename: Mapping[str, str] | None = None) -> dict[str, Any]:
    """The keys that the catalog holds for a table, under their new names; an error if there are none."""
    found = dict(tuple(row)[:2] for row in spark.sql(f"SHOW TBLPROPERTIES {relation}").collect())
    if _PROPERTY not in found:
        raise JobError(f"no keys are declared for {relation}; name them or use declare_keys")
    keys = json.loads(found[_PROPERTY])
    for kind in ("partition_key", "clustering"):
        keys[kind] = tuple((rename or {}).get(c, c) for c in keys[kind])
    return keys


def _names(value: str | Sequence[str]) -> tuple[str, ...]:
    return (value,) if isinstance(value, str) else tuple(value)
