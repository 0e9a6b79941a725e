"""Sources, a wide composite key, and groups against brute force."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from keygroup import Catalog, KeyedTable, MultiQuery, QuerySpec, WhereClause, drop_workspace, scan, workspace_dir


@pytest.mark.parametrize("format", ["parquet", "orc", "json", "csv"])
def test_any_file_format(spark, tmp_path, format):
    schema = "k int, c string, v double"
    rows = [(1, "a", 0.5), (1, "b", 1.5), (2, "a", 2.5)]
    path = str(tmp_path / format)
    spark.createDataFrame(rows, schema).write.format(format).option("header", "true").save(path)
    catalog = Catalog(spark).add_files(
        "f", "t", path, format, schema, {"header": "true"}, partition_key="k", clustering="c"
    )
    got = MultiQuery(catalog).add(QuerySpec("f", "t")).read().merged().collect()
    assert {r["k"]: [tuple(x["s0"]) for x in r["rows"]] for r in got} == {1: [("a", 0.5), ("b", 1.5)], 2: [("a", 2.5)]}


def test_views_and_renames(spark):
    spark.createDataFrame([(1, 2)], "x int, y int").createOrReplaceTempView("named")
    catalog = Catalog(spark).add_table("v", "t", "named", partition_key="k", rename={"x": "k"})
    assert scan(catalog, QuerySpec("v", "t"), tokenizer=None).collect() == [(1, 2)]


def test_select_terms(spark):
    df = spark.createDataFrame([(1, "b", 3), (1, "a", 4)], "k int, c string, v int")
    catalog = Catalog(spark).add("t", "x", KeyedTable.of(df, "k", "c"))
    spec = QuerySpec("t", "x", ("v", "upper(c) AS big", "v"))
    assert scan(catalog, spec, group_by=["c"], tokenizer=None).columns == ["c", "v", "big"]
    [group] = MultiQuery(catalog).add(spec).read().merged().collect()
    assert [tuple(r["s0"]) for r in group["rows"]] == [(4, "A"), (3, "B")]


def test_expression_named_like_an_unselected_clustering_column(spark):
    df = spark.createDataFrame([(1, c) for c in (3, 1, 2)], "k int, c int")
    catalog = Catalog(spark).add("t", "x", KeyedTable.of(df, "k", "c"))
    [group] = MultiQuery(catalog).add(QuerySpec("t", "x", ("-c AS c",))).read().merged().collect()
    assert [r["s0"]["c"] for r in group["rows"]] == [-1, -2, -3]


def test_names_with_dots_and_spaces(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 1, 4)], "`a.b` int, `c d` int, `e``f` int")
    catalog = Catalog(spark).add("t", "x", KeyedTable.of(df, "a.b", "c d"))
    groups = MultiQuery(catalog).add(QuerySpec("t", "x")).read(1)
    got = sorted(groups.merged().collect(), key=lambda r: r["_page"])
    assert [(r["a.b"], tuple(r["rows"][0]["s0"])) for r in got] == [(1, (1, 4)), (1, (2, 3))]
    assert groups.sorted_slices(3).count() == 2 and groups.flat().count() == 2


def test_query_for_key_columns_only(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    catalog = Catalog(spark).add("t", "x", KeyedTable.of(df, "k"))
    for page_rows in (1, 10):
        pages = MultiQuery(catalog).add(QuerySpec("t", "x")).read(page_rows).merged().collect()
        assert sorted((r["k"], len(r["rows"])) for r in pages) == ([(1, 1), (1, 1), (2, 1)] if page_rows == 1 else [(1, 2), (2, 1)])


def test_empty_table(spark):
    df = spark.createDataFrame([], "k int, c int, v string")
    catalog = Catalog(spark).add("t", "x", KeyedTable.of(df, "k", "c"))
    groups = MultiQuery(catalog).add(QuerySpec("t", "x")).read()
    assert groups.merged().collect() == [] and groups.flat().collect() == [] and groups.presence().collect() == []


def test_declared_primary_keys_spare_the_count(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "k int, c int")
    catalog = Catalog(spark).add("t", "x", KeyedTable.of(df, "k", "c", unique=True))
    job = MultiQuery(catalog).add(QuerySpec("t", "x"), QuerySpec("t", "x"))
    assert job.group_by("c").read(2).hot is None
    assert job.group_by("c").read(1).hot.n_keys == 2
    assert job.read(2).hot.largest == 4


@pytest.fixture(scope="module")
def wide(spark):
    """100,000 rows under a composite key of two ints, with a short text after it."""
    letter = lambda seed: F.chr(65 + F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(26)))
    df = spark.range(100_000).select(
        F.pmod(F.xxhash64("id", F.lit(61)), F.lit(300)).cast("int").alias("x"),
        F.pmod(F.xxhash64("id", F.lit(62)), F.lit(300)).cast("int").alias("y"),
        F.concat(letter(1), letter(2), letter(3)).alias("code"),
        F.col("id").cast("int").alias("n"),
    )
    return Catalog(spark).add("grid", "cells", KeyedTable.of(df, ["x", "y"], "code"))


def test_each_wide_key_is_one_group(wide):
    got = MultiQuery(wide).add(QuerySpec("grid", "cells")).read().merged()
    rows = wide.lookup("grid", "cells").df
    assert got.count() == rows.select("x", "y").distinct().count() == got.select("x", "y").distinct().count()
    assert got.agg(F.sum(F.size("rows"))).first()[0] == 100_000


def test_rows_of_a_wide_group_agree_on_the_clustering_column(wide):
    job = MultiQuery(wide).add(QuerySpec("grid", "cells", ("n",))).group_by("code")
    rows = wide.lookup("grid", "cells").df
    got = job.read().merged()
    flat = got.select("x", "y", "code", F.explode("rows.s0.n").alias("n"))
    assert got.count() == rows.select("x", "y", "code").distinct().count()
    assert flat.exceptAll(rows.select(flat.columns)).count() == 0 and flat.count() == 100_000


def test_closed_range_on_the_clustering_column(wide):
    spec = QuerySpec("grid", "cells", (), WhereClause("WHERE code >= ? AND code <= ?", ("A", "M")))
    rows = MultiQuery(wide).add(spec).read().rows.select("s0.code")
    expected = wide.lookup("grid", "cells").df.where("code BETWEEN 'A' AND 'M'").count()
    assert rows.count() == expected > 0
    assert rows.where("NOT (code BETWEEN 'A' AND 'M')").count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_random_jobs_against_brute_force(spark, seed):
    rng = random.Random(seed)
    tables = {}
    catalog = Catalog(spark)
    for name in ("a", "b", "c"):
        rows = [
            (rng.choice(["x"] * 30 + [None, "y", "z", "é"]), rng.choice([None, 1, 2]), rng.randrange(4), rng.randrange(3))
            for _ in range(rng.choice([0, 40, 120]))
        ]
        tables[name] = rows
        catalog.add("r", name, KeyedTable.of(spark.createDataFrame(rows, "k string, g int, c int, v int"), "k", ["g", "c"]))
    names = [rng.choice("abc") for _ in range(3)]
    limit = rng.randrange(4)
    specs = [QuerySpec("r", n, (), WhereClause("WHERE c <= ?", (limit,)) if i == 1 else None) for i, n in enumerate(names)]
    grouping = rng.choice([(), ("g",)])

    expected = defaultdict(list)
    for q, name in enumerate(names):
        for k, g, c, v in tables[name]:
            if q != 1 or c <= limit:
                expected[(k, g) if grouping else (k,)].append((q, g, c, v))

    none_first = lambda r: (r[0], r[1] is not None, r[1] or 0, r[2])
    for page_rows in (7, 1000):
        groups = MultiQuery(catalog).add(*specs).group_by(*grouping).read(page_rows)
        found = defaultdict(list)
        for r in sorted(groups.merged().collect(), key=lambda r: r["_page"]):
            key = (r["k"], r["g"]) if grouping else (r["k"],)
            for x in r["rows"]:
                s = x[f"s{x['_q']}"]
                found[key].append((x["_q"], r["g"] if grouping else s["g"], s["c"], s["v"]))
        assert found.keys() == expected.keys()
        for key, rows in found.items():
            assert sorted(map(repr, rows)) == sorted(map(repr, expected[key]))
            assert [none_first(r) for r in rows] == sorted(none_first(r) for r in rows)


def test_workspace_is_below_the_configured_folder_and_can_be_dropped(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        assert workspace_dir(spark).startswith(root.rstrip("/"))
    df = spark.range(50).selectExpr("0 AS k", "id AS c")
    catalog = Catalog(spark).add("t", "x", KeyedTable.of(df, "k", "c"))
    assert MultiQuery(catalog).add(QuerySpec("t", "x")).read(10).merged().count() == 5
    assert drop_workspace(spark)
    assert not drop_workspace(spark)
