"""Keys that the catalog holds, and orders of keys as one term."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from keygroup import Catalog, JobError, KeyedTable, MultiQuery, QuerySpec, UnknownTableError, declare_keys, write_clustered


@pytest.fixture
def stored(spark, tmp_path):
    name = f"stored_{uuid.uuid4().hex}"
    rows = [(1, "b", 2), (1, "a", 1), (2, "a", 3), (None, "c", 4)]
    spark.createDataFrame(rows, "`o'key` int, c string, v int").write.option("path", str(tmp_path / "t")).saveAsTable(name)
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_another_session_finds_the_keys(spark, stored):
    declared = declare_keys(spark, stored, "o'key", "c", unique=True, require_keys=True)
    assert (declared.partition_key, declared.clustering, declared.unique, declared.require_keys) == (("o'key",), ("c",), True, True)
    other = spark.newSession()
    catalog = Catalog(other).add_table("t", "x", stored)
    groups = MultiQuery(catalog).add(QuerySpec("t", "x")).read().merged().collect()
    assert sorted((r["o'key"], [row["s0"]["c"] for row in r["rows"]]) for r in groups) == [(1, ["a", "b"]), (2, ["a"])]
    # Names of one's own go before, and keys follow a new name.
    renamed = KeyedTable.stored(other, stored, rename={"o'key": "id"})
    assert renamed.partition_key == ("id",) and renamed.clustering == ("c",)
    assert KeyedTable.stored(other, stored, partition_key="c").partition_key == ("c",)


def test_keys_are_checked_against_the_columns(spark, stored):
    with pytest.raises(JobError, match="no keys are declared"):
        KeyedTable.stored(spark, stored)
    with pytest.raises(JobError, match="not among"):
        declare_keys(spark, stored, "missing")
    declare_keys(spark, stored, "o'key", "c")
    # The table is written anew without one of them.
    spark.sql(f"CREATE OR REPLACE TEMP VIEW narrow AS SELECT c FROM {stored}")
    with pytest.raises(JobError, match="no keys are declared"):
        KeyedTable.stored(spark, "narrow")
    spark.sql(f"ALTER TABLE {stored} SET TBLPROPERTIES ('keygroup.keys' = '{{\"partition_key\": [\"gone\"], \"clustering\": []}}')")
    with pytest.raises(JobError, match="gone"):
        KeyedTable.stored(spark, stored)
    with pytest.raises(UnknownTableError):
        Catalog(spark).add_table("t", "x", "no_such_table").lookup("t", "x")


def test_clustered_tables_declare_their_keys(spark, stored, tmp_path):
    name = f"clustered_{uuid.uuid4().hex}"
    table = KeyedTable.of(spark.table(stored).toDF("k", "c", "v"), "k", "c", unique=True)
    write_clustered(table, name, 2, str(tmp_path / "c"))
    again = KeyedTable.stored(spark.newSession(), name)
    assert (again.partition_key, again.clustering, again.unique, again.buckets) == (("k",), ("c",), True, 2)
    spark.sql(f"DROP TABLE {name}")


def test_slices_sorted_by_bytes_of_the_key(spark):
    keys = ["￮", "😀", "a", "b", "\x00"]
    table = KeyedTable.of(spark.createDataFrame([(k, i) for i in range(3) for k in keys], "k string, c int"), "k", "c")
    groups = MultiQuery(Catalog(spark).add("t", "x", table)).add(QuerySpec("t", "x")).read()
    # One token for all keys, so that their own order shows.
    from keygroup import Tokenizer

    same = Tokenizer("same", lambda key: F.when(key[0].isNotNull(), F.lit(3).cast("bigint")), bits=8, low=0)
    found = {}
    for style in (None, "spark", "java"):
        rows = groups.sorted_slices(1, same, style).select("k", "s0.c").collect()
        assert [r.c for r in rows] == [0, 1, 2] * len(keys)
        found[style] = [r.k for r in rows[::3]]
    assert found[None] == found["spark"] == sorted(keys, key=str.encode)
    assert found["java"] == sorted(keys, key=lambda k: k.encode("utf-16-be"))
