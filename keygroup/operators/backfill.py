"""Work done slice by slice, with a ledger that survives the driver.

The slices of a run are written down before anything else. The result of a slice is
written aside and put in its place by a single rename, which fails if another has been put
there; so every slice is in the result once or not at all, whatever died on the way, and a
later session goes on with the slices that are missing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keygroup.names import SLICE
from keygroup.workspace import delete

# Names that begin with an underscore are passed over when folders are listed.
_PLAN, _ASIDE, _DONE = "_plan", "_aside", "done"


@dataclass(frozen=True)
class Backfill:
    """A run over slices below ``path``, in any store with an atomic rename of folders."""

    spark: SparkSession
    path: str
    slices: tuple[tuple[int, int], ...]
    schema: T.StructType

    @classmethod
    def start(
        cls, spark: SparkSession, path: str, slices: Sequence[tuple[int, int]], schema: T.StructType | str
    ) -> Backfill:
        """A new run, or the run that was started below ``path`` with the same slices and schema.

        The slices are held on the driver.
        """
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        wanted = cls(spark, path, tuple((int(a), int(b)) for a, b in slices), schema)
        if not _exists(spark, f"{path}/{_PLAN}"):
            note = json.dumps({"slices": wanted.slices, "schema": schema.jsonValue()})
            aside = f"{path}/{_ASIDE}/plan-{uuid.uuid4().hex}"
            spark.createDataFrame([(note,)], "note string").coalesce(1).write.text(aside)
            if not _put(spark, aside, f"{path}/{_PLAN}"):
                delete(spark, aside)
        found = cls.open(spark, path)
        if (found.slices, found.schema) != (wanted.slices, wanted.schema):
            raise ValueError(f"another run was started below {path}, with other slices or another schema")
        return found

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Backfill:
        """The run that was started below ``path``."""
        note = json.loads(spark.read.text(f"{path}/{_PLAN}", wholetext=True).first()[0])
        return cls(spark, path, tuple(map(tuple, note["slices"])), T.StructType.fromJson(note["schema"]))

    def done(self) -> list[int]:
        """Indexes of the slices whose results are in place."""
        return sorted(int(name) for name in _listed(self.spark, f"{self.path}/{_DONE}"))

    def pending(self) -> list[int]:
        """Indexes of the others."""
        done = set(self.done())
        return [i for i in range(len(self.slices)) if i not in done]

    def run(self, work: Callable[[int, int, int], DataFrame], most: int | None = None) -> int:
        """Call ``work(index, low, high)`` for the pending slices, ``most`` of them; how many were put in place.

        What a call returns is written down at once, with the columns of the schema. An
        error in it, or in writing, ends the run; the slices before are kept.
        """
        put = 0
        for index in self.pending()[:most]:
            low, high = self.slices[index]
            aside = f"{self.path}/{_ASIDE}/{index}-{uuid.uuid4().hex}"
            result = work(index, low, high)
            columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields]
            kept = False
            try:
                result.select(*columns).write.parquet(aside)
                # Another run of the same slices may have been faster; its result is as good.
                kept = _put(self.spark, aside, f"{self.path}/{_DONE}/{index}")
            finally:
                if not kept:
                    delete(self.spark, aside)
            put += kept
        return put

    def read(self, partial: bool = False) -> DataFrame:
        """All results, with ``_slice``; an error while slices are missing, unless ``partial``."""
        done = self.done()
        if len(done) < len(self.slices) and not partial:
            raise RuntimeError(f"{len(self.slices) - len(done)} of {len(self.slices)} slices are missing")
        schema = T.StructType([*self.schema.fields, T.StructField(SLICE, T.IntegerType())])
        if not done:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{_DONE}/{i}" for i in done))
        folder = F.regexp_extract("_metadata.file_path", f"/{_DONE}/([0-9]+)/", 1)
        return rows.select("*", folder.cast("int").alias(SLICE))

    def clear(self) -> bool:
        """Delete the run with its results; whether there was one."""
        return delete(self.spark, self.path)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _exists(spark: SparkSession, path: str) -> bool:
    target = _path(spark, path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _listed(spark: SparkSession, path: str) -> list[str]:
    target = _path(spark, path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(target)] if files.exists(target) else []


def _put(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder; false if the target is there already."""
    jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    old, new = _path(spark, source), _path(spark, target)
    files = old.getFileSystem(configuration)
    files.mkdirs(new.getParent())
    old, new = files.makeQualified(old), files.makeQualified(new)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    none = spark.sparkContext._gateway.new_array(rename, 1)
    none[0] = getattr(rename, "NONE")
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(old.toUri(), configuration).rename(old, new, none)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception) or _exists(spark, target):
            return False
        raise
    return True
