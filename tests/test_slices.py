"""Tokens, slices and the sliced layout."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF
from keygroup import (
    MD5_60, XXHASH_64, Catalog, KeyedTable, MultiQuery, QuerySpec, SlicedTable, TokenRanges, iterate_slices, read_slice, scan,
    slice_profile, with_token,
)
from keygroup.operators import slices as slices_module

TOKENIZERS = pytest.mark.parametrize("tokenizer", [XXHASH_64, MD5_60], ids=lambda t: t.name)


@pytest.fixture(scope="module")
def orders(spark):
    return KeyedTable.of(spark.read.parquet(f"{SF}/orders.parquet"), "o_orderkey")


@pytest.fixture(scope="module")
def big(spark):
    """Ten rows of single-column keys, each to be read exactly once."""
    values = random.Random(77).sample(range(-(1 << 31), 1 << 31), 10)
    df = spark.createDataFrame([(v, v) for v in values], "k int, v int")
    return KeyedTable.of(df, "k"), values


@TOKENIZERS
@pytest.mark.parametrize("n", [1, 2, 7, 16, 257, 1000])
def test_bounds_cover_without_gap_or_overlap(tokenizer, n):
    bounds = tokenizer.bounds(n)
    assert len(bounds) == n
    assert bounds[0][0] == tokenizer.low and bounds[-1][1] == tokenizer.high
    assert all(hi + 1 == lo for (_, hi), (lo, _) in zip(bounds, bounds[1:]))


@TOKENIZERS
@pytest.mark.parametrize("n", [1, 2, 7, 16, 257, (1 << 31) - 1])
def test_index_agrees_with_bounds(spark, tokenizer, n):
    picks = random.Random(n).sample(range(n), min(n, 50))
    size = 1 << tokenizer.bits
    tokens = {}
    for i in {0, n - 1, *picks}:
        lo = tokenizer.low - (-i * size // n)
        hi = tokenizer.low - (-(i + 1) * size // n) - 1
        tokens |= {lo: i, hi: i, (lo + hi) // 2: i}
    df = spark.createDataFrame([(t, i) for t, i in tokens.items()], "t bigint, i bigint")
    assert df.where(tokenizer.slice_of("t", n) != F.col("i")).collect() == []


@pytest.mark.parametrize("n", [0, -1, 1 << 31])
def test_slice_count_is_checked(n):
    with pytest.raises(ValueError):
        XXHASH_64.bounds(n)


def test_token_comes_first_and_keys_are_carried(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, v double")
    catalog = Catalog(spark).add("t", "x", KeyedTable.of(df, ["a", "b"]))
    rows = scan(catalog, QuerySpec("t", "x", ("v",)))
    assert rows.columns == ["_token", "a", "b", "v"]
    assert rows.first()["_token"] == df.select(F.xxhash64("a", "b")).first()[0]
    assert scan(catalog, QuerySpec("t", "x")).columns == ["_token", "a", "b", "v"]
    with pytest.raises(ValueError):
        scan(catalog, QuerySpec("t", "x"), tokenizer=None, token_range=(0, 1))


@TOKENIZERS
def test_null_keys_have_a_token(spark, tokenizer):
    df = spark.createDataFrame([(None, 1), (5, 2)], "k int, v int")
    table = KeyedTable.of(df, "k")
    assert sum(rows.count() for _, rows in iterate_slices(table, tokenizer.bounds(3), tokenizer)) == 2


@TOKENIZERS
def test_every_value_is_read_once(big, tokenizer):
    table, values = big
    seen = [r.v for _, rows in iterate_slices(table, tokenizer.bounds(4), tokenizer) for r in rows.collect()]
    assert sorted(seen) == sorted(values)


def test_slices_are_inclusive(orders):
    tokens = [r[0] for r in with_token(orders).select("_token").orderBy("_token").collect()]
    assert read_slice(orders, tokens[3], tokens[8]).count() == 6


def test_profile(orders):
    got = slice_profile(orders, 5).agg(F.count("*"), F.sum("n_rows"), F.sum("n_keys"), F.max("largest_group")).first()
    assert tuple(got) == (5, 1500, 1500, 1)


@TOKENIZERS
@pytest.mark.parametrize("broadcast", [True, False])
def test_boundary_ranges(spark, orders, tokenizer, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(slices_module, "BROADCAST_BYTES", 0)
    tokens = [r[0] for r in with_token(orders, tokenizer).select("_token").collect()]
    rng = random.Random(1)
    boundaries = rng.sample(tokens, 40) + [tokenizer.low, tokenizer.low, tokens[0], tokens[0] + 1, tokens[0]]
    ranges = TokenRanges.of(spark, boundaries, tokenizer)
    table = sorted((r["slice"], r["lo"], r["hi"]) for r in ranges.table.collect())
    distinct = sorted({*boundaries, tokenizer.high})
    assert [hi for _, _, hi in table] == distinct
    assert [i for i, _, _ in table] == list(range(len(distinct)))
    assert table[0][1] == tokenizer.low
    assert all(hi + 1 == lo for (_, _, hi), (_, lo, _) in zip(table, table[1:]))

    assigned = ranges.assign(with_token(orders, tokenizer)).select("_token", "slice").collect()
    assert len(assigned) == len(tokens)
    bounds = {i: (lo, hi) for i, lo, hi in table}
    assert all(bounds[r["slice"]][0] <= r["_token"] <= bounds[r["slice"]][1] for r in assigned)
    assert ranges.profile(orders).agg(F.sum("n_rows")).first()[0] == len(tokens)


def test_no_boundary_means_one_range(spark, orders):
    ranges = TokenRanges.of(spark, [])
    assert [tuple(r) for r in ranges.table.collect()] == [(0, XXHASH_64.low, XXHASH_64.high)]
    assert ranges.assign(with_token(orders)).count() == 1500


def test_four_small_ranges(spark):
    """Boundaries of four short ranges, kept as given."""
    ranges = TokenRanges.of(spark, [1, 3, 5, 7], MD5_60)
    got = sorted((r["lo"], r["hi"]) for r in ranges.table.collect())
    assert got == [(0, 1), (2, 3), (4, 5), (6, 7), (8, MD5_60.high)]


def test_sliced_layout_prunes_and_is_whole(spark, orders, tmp_path):
    sliced = SlicedTable.write(orders, str(tmp_path / "orders"), 8)
    assert sliced.read().df.exceptAll(orders.df).count() == 0 and sliced.read().df.count() == 1500
    part = sliced.read(2, 3)
    plan = part.df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_slice" in plan
    bounds = XXHASH_64.bounds(8)
    expected = read_slice(orders, bounds[2][0], bounds[3][1]).drop("_token")
    assert part.df.exceptAll(expected).count() == 0 and part.df.count() == expected.count()
    assert [index for index, _ in sliced] == list(range(8))
    assert part.partition_key == ("o_orderkey",)


def test_sliced_layout_skips_empty_slices(spark, big, tmp_path):
    table, values = big
    sliced = SlicedTable.write(table, str(tmp_path / "big"), 64)
    read = [(i, r.v) for i, part in sliced for r in part.df.collect()]
    assert sorted(v for _, v in read) == sorted(values)
    assert {i for i, _ in read} == set(sliced.present()) and len(sliced.present()) < 64


@TOKENIZERS
def test_equal_keys_have_one_token(spark, tokenizer):
    rows = [(z, float("nan")) for z in (0.0, -0.0) * 3]
    df = spark.createDataFrame(rows, "k double, l double")
    table = KeyedTable.of(df, ["k", "l"])
    assert with_token(table, tokenizer).select("_token").distinct().count() == 1
    profile = slice_profile(table, 8, tokenizer).collect()
    assert [(r.n_rows, r.n_keys, r.largest_group) for r in profile] == [(6, 1, 6)]
    groups = MultiQuery(Catalog(spark).add("t", "x", table)).add(QuerySpec("t", "x")).read()
    placed = groups.sorted_slices(16, tokenizer).select(F.spark_partition_id()).distinct()
    assert placed.count() == 1


@TOKENIZERS
def test_tokens_do_not_depend_on_the_time_zone(spark, tokenizer):
    df = spark.sql("SELECT timestamp_seconds(1700000000) AS k, timestamp_ntz'2024-01-01 00:00:00' AS l")
    found = set()
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            found.add(with_token(KeyedTable.of(df, ["k", "l"]), tokenizer).first()["_token"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(found) == 1


def test_a_layout_is_opened_again(spark, orders, tmp_path, monkeypatch):
    table = KeyedTable.of(orders.df, "o_orderkey", unique=True)
    SlicedTable.write(table, str(tmp_path / "laid"), 8, MD5_60)
    again = SlicedTable.open(spark, str(tmp_path / "laid"))
    assert (again.n, again.tokenizer, again.partition_key, again.unique) == (8, MD5_60, ("o_orderkey",), True)
    assert again.read().unique and again.read().df.count() == orders.df.count()
    listed = []
    read = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *a: listed.append(a) or read(self, *a))
    fresh = SlicedTable.open(spark, again.path)
    assert sum(part.df.count() for _, part in fresh) == orders.df.count()
    assert len(listed) == 1
    assert again.delete() and not again.delete()
