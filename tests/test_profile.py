"""Summaries of slices that are added up, against exact counts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from keygroup import MD5_60, KeyedTable, SliceProfile, slice_profile


@pytest.fixture(scope="module")
def rows(spark):
    """30,000 keys with one to nine rows, and one with 5,000."""
    many = spark.range(30_000).select(
        F.col("id").alias("k"), F.explode(F.sequence(F.lit(1), 1 + F.pmod(F.xxhash64("id"), F.lit(9)).cast("int"))).alias("v")
    )
    return many.unionByName(spark.range(5_000).select(F.lit(-1).cast("bigint").alias("k"), F.lit(0).alias("v")))


def exact(df, n):
    sizes = df.groupBy("k").count()
    token = MD5_60.slice_of(MD5_60.column("k"), n)
    share = lambda p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY count)")
    found = sizes.groupBy(token.alias("slice")).agg(
        F.sum("count").alias("n_rows"), F.count("*").alias("n_keys"), *(share(p).alias(f"s{p}") for p in (0.5, 0.9, 0.99))
    )
    return {r["slice"]: tuple(r)[1:] for r in found.collect()}


def close(report, expected):
    got = {r["slice"]: tuple(r)[1:] for r in report.collect()}
    assert got.keys() == expected.keys()
    for slot, (n_rows, n_keys, *sizes) in got.items():
        e_rows, e_keys, *e_sizes = expected[slot]
        # Five standard errors of the sketch; a place or so in the order of sizes.
        assert n_rows == e_rows and abs(n_keys - e_keys) <= 0.08 * e_keys
        assert all(abs(a - b) <= 1 for a, b in zip(sizes[:2], e_sizes)) and sizes[2] <= 9


def test_a_profile_is_close(rows):
    table = KeyedTable.of(rows, "k")
    close(SliceProfile.of(table, 6, MD5_60, sampled_keys=600).report(), exact(rows, 6))
    # With room for every key all is exact.
    whole = SliceProfile.of(table, 6, MD5_60, sampled_keys=100_000)
    assert {r["slice"]: tuple(r)[1:] for r in whole.report().collect()} == exact(rows, 6)
    plain = {r["slice"]: (r.n_rows, r.n_keys) for r in slice_profile(table, 6, MD5_60).collect()}
    assert plain == {s: v[:2] for s, v in exact(rows, 6).items()}


def test_profiles_of_parts_are_added(rows, spark, tmp_path):
    # Keys with rows in several parts, and a part that leaves slices empty.
    parts = [rows.where("v % 3 = 0"), rows.where("v % 3 = 1"), rows.where("v % 3 = 2")]
    one, two, three = (SliceProfile.of(KeyedTable.of(p, "k"), 6, MD5_60, sampled_keys=500) for p in parts)
    added = one.merge(two, three)
    close(added.report(), exact(rows, 6))
    # What is sampled in the sum has the sizes of the whole table.
    hashed = rows.groupBy("k").count().select(F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "k"), 2).alias("hash"), "count")
    sampled = added.table.select(F.explode("sample").alias("s")).select("s.*").join(hashed, "hash")
    assert sampled.count() > 1_000 and sampled.where("n <> count").count() == 0
    path = str(tmp_path / "profile")
    for part in (one, two):
        part.write(path)
    three.write(path)
    again = SliceProfile.open(spark.newSession(), path)
    assert again.n == 6 and sorted(again.report().collect()) == sorted(added.report().collect())
    close(again.report(together=2), exact(rows, 3))
    with pytest.raises(ValueError, match="same slices"):
        one.merge(SliceProfile.of(KeyedTable.of(rows, "k"), 5))
    SliceProfile.of(KeyedTable.of(rows, "k"), 5).write(path)
    with pytest.raises(ValueError, match="different slices"):
        SliceProfile.open(spark, path)


def test_profiles_of_odd_tables(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), ("x", None)], "`k 1` string, k2 string")
    table = KeyedTable.of(df, ["k 1", "k2"])
    found = SliceProfile.of(table, 1).report().collect()
    assert [tuple(r) for r in found] == [(0, 3, 2, 1, 2, 2)]
    assert SliceProfile.of(KeyedTable.of(df.limit(0), "k2"), 4).report().count() == 0
    for bad in (lambda: SliceProfile.of(table, 1, sampled_keys=0), lambda: SliceProfile.of(table, 1).report(0)):
        with pytest.raises(ValueError, match="positive"):
            bad()
