"""Groups of several pages: the results must equal those of one whole group."""

from __future__ import annotations

import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from keygroup import Catalog, KeyedTable, MultiQuery, QuerySpec, WhereClause
from keygroup.operators import hot as hot_module


def read(catalog, *specs, page_rows, group_by=()):
    return MultiQuery(catalog).add(*specs).group_by(*group_by).read(page_rows)


def paged_lists(groups, *keys):
    """Rows per group, its pages joined in order, with the page sizes."""
    lists, pages = defaultdict(list), defaultdict(list)
    for r in sorted(groups.merged().collect(), key=lambda r: r["_page"]):
        key = tuple(r[k] for k in keys)
        lists[key].extend(r["rows"])
        pages[key].append((r["_page"], len(r["rows"])))
    return lists, pages


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of 6,000 rows bears one key; another third are copies of one row."""
    clicks = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit("copies"))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("k"),
        F.when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000))).cast("int").alias("c"),
        F.when(F.col("id") % 3 == 1, F.lit(0)).otherwise(F.col("id")).alias("v"),
    )
    views = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.lit("k1")).alias("k"),
        (F.col("id") % 10).cast("int").alias("c"),
        F.col("id").cast("string").alias("w"),
    )
    return (
        Catalog(spark)
        .add("t", "clicks", KeyedTable.of(clicks, "k", "c"))
        .add("t", "views", KeyedTable.of(views, "k", "c"))
    )


CLICKS, VIEWS = QuerySpec("t", "clicks"), QuerySpec("t", "views")


@pytest.mark.parametrize("broadcast", [True, False])
def test_pages_hold_the_same_rows_in_the_same_order(skewed, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(hot_module, "BROADCAST_BYTES", 0)
    whole, _ = paged_lists(read(skewed, CLICKS, VIEWS, page_rows=10_000), "k")
    groups = read(skewed, CLICKS, VIEWS, page_rows=70)
    cut, pages = paged_lists(groups, "k")
    assert groups.hot.n_keys == 3 and groups.hot.largest == 2300
    assert cut.keys() == whole.keys()
    for key in whole:
        assert cut[key] == whole[key]
        sizes = dict(pages[key])
        n = len(whole[key])
        assert sizes == {p: min(70, n - 70 * p) for p in range(math.ceil(n / 70))}


def test_flat_positions_match(skewed):
    def positions(page_rows):
        rows = read(skewed, CLICKS, VIEWS, page_rows=page_rows).flat().collect()
        return sorted(map(repr, rows))

    assert positions(100) == positions(10_000)


def test_cogrouped_lists_match(skewed):
    def lists(page_rows):
        found = defaultdict(lambda: ([], []))
        for r in sorted(read(skewed, CLICKS, VIEWS, page_rows=page_rows).cogrouped().collect(), key=lambda r: r["_page"]):
            found[r["k"]][0].extend(r["s0"])
            found[r["k"]][1].extend(r["s1"])
        return dict(found)

    assert lists(100) == lists(10_000)


def test_group_by_clustering_column(skewed):
    whole, _ = paged_lists(read(skewed, CLICKS, VIEWS, page_rows=10_000, group_by=["c"]), "k", "c")
    cut, pages = paged_lists(read(skewed, CLICKS, VIEWS, page_rows=50, group_by=["c"]), "k", "c")
    assert cut == whole
    assert len(pages[("copies", 7)]) == 40


def test_sorted_slices_keep_pages_together_and_spread_hot_groups(skewed):
    rows = read(skewed, CLICKS, VIEWS, page_rows=50).sorted_slices(6)
    assert rows.rdd.getNumPartitions() == 6
    placed = rows.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")).collect()
    assert len(placed) == 6900
    homes = defaultdict(set)
    for r in placed:
        homes[r["k"], r["_page"]].add(r["part"])
    assert all(len(parts) == 1 for parts in homes.values())
    assert {p for (k, _), parts in homes.items() if k == "hot" for p in parts} == set(range(6))
    for part in range(6):
        own = sorted((r for r in placed if r["part"] == part), key=lambda r: r["at"])
        keys = [(r["_token"], r["k"], r["_page"], r["_q"]) for r in own]
        assert keys == sorted(keys)


def test_partitioned_is_exact_and_whole(skewed):
    rows = read(skewed, CLICKS, VIEWS, page_rows=50).partitioned(5)
    assert rows.rdd.getNumPartitions() == 5
    placed = rows.select("k", "_page", F.spark_partition_id().alias("part"))
    homes = placed.groupBy("k", "_page").agg(F.count("*").alias("n"), F.countDistinct("part").alias("p"))
    assert homes.agg(F.sum("n"), F.max("p")).first()[:] == (6900, 1)


def test_null_and_special_keys(spark):
    values = [None] * 30 + [0.0, -0.0] * 10 + [float("nan")] * 25 + [1.5] * 3
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k double, c int")
    catalog = Catalog(spark).add("t", "x", KeyedTable.of(df, "k", "c", unique=True))
    found = defaultdict(list)
    for r in read(catalog, QuerySpec("t", "x"), page_rows=7).flat().collect():
        found["nan" if r["k"] is not None and math.isnan(r["k"]) else r["k"]].append((r["_pos"], r["s0"]["c"]))
    assert {k: len(v) for k, v in found.items()} == {None: 30, 0.0: 20, "nan": 25, 1.5: 3}
    for group in found.values():
        group.sort()
        assert [p for p, _ in group] == list(range(1, len(group) + 1))
        assert [c for _, c in group] == sorted(c for _, c in group)


def test_required_keys_leave_out_nulls(spark):
    df = spark.createDataFrame([(None, 1), (1, 2), (1, 3)], "k int, c int")
    catalog = Catalog(spark).add("t", "x", KeyedTable.of(df, "k", "c", require_keys=True))
    assert [(r["k"], len(r["rows"])) for r in read(catalog, QuerySpec("t", "x"), page_rows=10).merged().collect()] == [(1, 2)]


@pytest.mark.parametrize("page_rows", [2, 100])
def test_maps_and_lists_as_payload(spark, page_rows):
    rows = [(1, c, {"a": c, "b": -c}, [c], bytearray([255 - c])) for c in (3, 1, 2)]
    df = spark.createDataFrame(rows, "k int, c int, m map<string,int>, l array<int>, b binary")
    catalog = Catalog(spark).add("t", "x", KeyedTable.of(df, "k", "c"))
    groups = read(catalog, QuerySpec("t", "x"), page_rows=page_rows)
    [(_, got)] = paged_lists(groups, "k")[0].items()
    assert [r["s0"]["c"] for r in got] == [1, 2, 3]
    assert got[0]["s0"].asDict() == {"c": 1, "m": {"a": 1, "b": -1}, "l": [1], "b": bytearray([254])}
    assert sorted((r["_pos"], r["s0"]["c"]) for r in groups.flat().collect()) == [(1, 1), (2, 2), (3, 3)]


def test_binary_and_composite_keys(spark):
    rows = [(bytearray([i % 2]), i % 3, i) for i in range(60)]
    df = spark.createDataFrame(rows, "a binary, b int, c int")
    catalog = Catalog(spark).add("t", "x", KeyedTable.of(df, ["a", "b"], "c"))
    found = defaultdict(list)
    for r in read(catalog, QuerySpec("t", "x"), page_rows=4).merged().collect():
        found[bytes(r["a"]), r["b"]].extend(x["s0"]["c"] for x in r["rows"])
    assert len(found) == 6 and all(len(v) == 10 for v in found.values())


def test_order_without_selecting_the_clustering_column(skewed):
    spec = QuerySpec("t", "clicks", ("v",))
    [whole] = [r for r in read(skewed, spec, page_rows=10_000).merged().collect() if r["k"] == "hot"]
    by_c = sorted(
        skewed.lookup("t", "clicks").df.where("k = 'hot'").collect(), key=lambda r: r["c"]
    )
    got = [x["s0"]["v"] for x in whole["rows"]]
    assert whole["rows"][0]["s0"].asDict().keys() == {"v"}
    order = {r["v"]: r["c"] for r in by_c}
    assert [order[v] for v in got] == sorted(order.values())
    cut, _ = paged_lists(read(skewed, spec, page_rows=64), "k")
    assert [x["s0"]["v"] for x in cut[("hot",)]] == got


def test_same_table_twice_keeps_every_row(skewed):
    lists, _ = paged_lists(read(skewed, VIEWS, VIEWS, page_rows=10_000), "k")
    assert {k: len(v) for k, v in lists.items()} == {("hot",): 600, ("k1",): 1200}


def test_presence(skewed):
    rows = read(skewed, CLICKS, VIEWS, page_rows=100).presence().collect()
    found = {r["k"]: (r["in_s0"], r["in_s1"]) for r in rows}
    assert found["hot"] == (True, True) and found["copies"] == (True, False)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_unique_rows_need_no_row_id(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("k"), F.col("id").alias("c"))
    catalog = Catalog(spark).add("t", "x", KeyedTable.of(df, "k", "c", unique=True))
    lists, _ = paged_lists(read(catalog, QuerySpec("t", "x"), page_rows=30), "k")
    assert {k: [r["s0"]["c"] for r in v] for k, v in lists.items()} == {
        (0,): list(range(0, 500, 2)), (1,): list(range(1, 500, 2))
    }


@pytest.fixture(scope="module")
def clustered(spark, skewed):
    from keygroup import write_clustered

    catalog = Catalog(spark)
    for name in ("clicks", "views"):
        catalog.add("t", name, write_clustered(skewed.lookup("t", name), f"clustered_{name}", 6))
    yield catalog
    for name in ("clicks", "views"):
        spark.sql(f"DROP TABLE clustered_{name}")


def test_clustered_tables_are_grouped_without_a_shuffle(spark, skewed, clustered):
    groups = read(clustered, CLICKS, VIEWS, page_rows=10_000)
    for form in (groups.merged(), groups.cogrouped(), groups.flat()):
        assert "Exchange" not in plan_of(form)
    assert paged_lists(groups, "k") == paged_lists(read(skewed, CLICKS, VIEWS, page_rows=10_000), "k")
    by_c = read(clustered, CLICKS, VIEWS, page_rows=10_000, group_by=["c"])
    assert "Exchange" not in plan_of(by_c.merged())
    some = QuerySpec("t", "clicks", ("v",), WhereClause("WHERE v > ?", (10,)))
    assert "Exchange" not in plan_of(read(clustered, some, VIEWS, page_rows=10_000).merged())


def test_hot_groups_of_clustered_tables_are_read_in_even_splits(skewed, clustered):
    groups = read(clustered, CLICKS, VIEWS, page_rows=70)
    assert paged_lists(groups, "k") == paged_lists(read(skewed, CLICKS, VIEWS, page_rows=70), "k")
    assert "Bucketed: true" not in plan_of(groups.merged())


def test_tables_of_unequal_buckets_are_shuffled(spark, skewed, clustered):
    catalog = Catalog(spark).add("t", "clicks", clustered.lookup("t", "clicks"))
    catalog.add("t", "views", skewed.lookup("t", "views"))
    groups = read(catalog, CLICKS, VIEWS, page_rows=10_000)
    assert plan_of(groups.merged()).count("Exchange ") == 1
    assert paged_lists(groups, "k")[0] == paged_lists(read(skewed, CLICKS, VIEWS, page_rows=10_000), "k")[0]


def test_pages_bounded_by_bytes(spark):
    """Long texts among short ones: no page holds more than its bytes and one row."""
    text = F.repeat(F.lit("é"), F.when(F.col("id") % 50 == 0, 4000).otherwise(F.col("id") % 30).cast("int"))
    df = spark.range(3000).select((F.col("id") % 3 > 0).cast("int").alias("k"), F.col("id").alias("c"), text.alias("t"))
    catalog = Catalog(spark).add("t", "x", KeyedTable.of(df, "k", "c", unique=True))
    spec = QuerySpec("t", "x", ("t",))
    whole, _ = paged_lists(read(catalog, spec, page_rows=10_000), "k")
    groups = MultiQuery(catalog).add(spec).read(page_rows=100, page_bytes=20_000)
    cut, pages = paged_lists(groups, "k")
    assert cut == whole and {k: len(v) for k, v in whole.items()} == {(0,): 1000, (1,): 2000}
    for key, numbers in pages.items():
        assert len(numbers) == len(set(p for p, _ in numbers)) > 10
        at = 0
        for _, size in numbers:
            weights = [max(200, len(r["s0"]["t"].encode()) + 8) for r in cut[key][at : at + size]]
            assert size <= 100 and sum(weights[:-1]) < 20_000
            at += size
    positions = sorted((r["k"], r["_pos"]) for r in groups.flat().collect())
    assert positions == [(0, i) for i in range(1, 1001)] + [(1, i) for i in range(1, 2001)]
    small = MultiQuery(catalog).add(spec).read(page_bytes=10**9)
    assert small.hot is None and small.merged().count() == 2


@pytest.mark.parametrize("bad", [dict(page_rows=0), dict(page_bytes=0)])
def test_page_sizes_are_checked(skewed, bad):
    with pytest.raises(ValueError):
        MultiQuery(skewed).add(CLICKS).read(**bad)


def test_copies_in_files_are_told_apart_by_their_place(spark, skewed, tmp_path, monkeypatch):
    """No row is written to give it a number, and the scan of small groups reads none."""
    catalog = Catalog(spark)
    for name in ("clicks", "views"):
        path = str(tmp_path / name)
        skewed.lookup("t", name).df.withColumnRenamed("k", "key").write.parquet(path)
        catalog.add_files("t", name, path, partition_key="k", clustering="c", rename={"key": "k"})
    tags = []
    monkeypatch.setattr(hot_module, "temporary", lambda df, tag: tags.append(tag))
    filtered = QuerySpec("t", "clicks", (), WhereClause("WHERE v >= ?", (0,)))
    groups = read(catalog, filtered, VIEWS, page_rows=70)
    cut, _ = paged_lists(groups, "k")
    expected, _ = paged_lists(read(skewed, CLICKS, VIEWS, page_rows=10_000), "k")
    assert cut == expected and tags == []
    whole = read(catalog, filtered, VIEWS, page_rows=10_000)
    assert "_metadata" not in plan_of(whole.merged()) and "_rid" not in plan_of(whole.merged())


@pytest.mark.parametrize("hashes", [1, 2, 5])
def test_hot_keys_are_found_among_keys_of_one_hash(spark, skewed, monkeypatch, hashes):
    few = lambda keys: F.pmod(F.xxhash64(*keys), F.lit(hashes))
    monkeypatch.setattr(hot_module, "_hashed", few)
    hot = read(skewed, CLICKS, page_rows=70).hot
    assert sorted(r["_g0"] for r in hot.table.collect()) == ["copies", "hot"]
    assert (hot.n_keys, hot.n_rows, hot.largest) == (2, 4000, 2000)
    assert read(skewed, CLICKS, page_rows=2000).hot is None
    assert read(skewed, CLICKS, page_rows=1999).hot.n_keys == 2


def test_wide_rows_get_more_sort_tasks(spark, monkeypatch):
    monkeypatch.setattr(hot_module, "BYTES_PER_TASK", 10_000)
    found = hot_module.HotKeys(["k"], spark.range(1), 1, 5_000, 5_000, 5_000, 64, 64)
    narrow, wide = spark.range(1), spark.range(1).selectExpr("id", "'a' AS t", "'b' AS u")
    assert hot_module.sort_tasks(narrow, found) < hot_module.sort_tasks(wide, found)
    # There is no largest number of tasks.
    huge = hot_module.HotKeys(["k"], spark.range(1), 1, 10**11, 10**11, 10**11, 64, 64)
    assert hot_module.sort_tasks(narrow, huge) >= 100_000
