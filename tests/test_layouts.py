"""Files sorted by token, and slices of equal weight."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF
from keygroup import MD5_60, XXHASH_64, KeyedTable, TokenFiles, TokenRanges, TokenWeights, balanced_ranges, balanced_slices
from keygroup.functions.token import Tokenizer
from keygroup.operators import balance
from keygroup.operators.slices import with_token


@pytest.fixture(scope="module")
def lines(spark):
    return KeyedTable.of(spark.read.parquet(f"{SF}/lineitem.parquet"), "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"])


def names(frame):
    return {path.rsplit("/", 1)[1] for path in frame.inputFiles()}


@pytest.mark.parametrize("tokenizer", [XXHASH_64, MD5_60])
def test_any_range_reads_its_files_alone(spark, lines, tokenizer, tmp_path):
    files = TokenFiles.write(lines, str(tmp_path / "t"), tokenizer, rows_per_file=200, partitions=4)
    entries = files.manifest().collect()
    total = lines.df.count()
    assert sum(e.n_rows for e in entries) == total and all(e.n_rows <= 200 for e in entries) and len(entries) >= total // 200
    assert all(e.n_bytes > 0 for e in entries)
    every = {r[0]: r.n for r in with_token(lines, tokenizer).groupBy("_token").agg(F.count("*").alias("n")).collect()}
    size = tokenizer.high - tokenizer.low + 1
    rng = random.Random(1)
    for _ in range(6):
        low = tokenizer.low + rng.randrange(size)
        high = min(tokenizer.high, low + rng.randrange(size // rng.choice([3, 50, 10**6])))
        frame = files.tokens(low, high)
        met = {e.name for e in entries if e.high >= low and e.low <= high}
        assert (names(frame) if met else set()) == met
        got = {r[0]: r.n for r in frame.groupBy("_token").agg(F.count("*").alias("n")).collect()}
        assert got == {t: n for t, n in every.items() if low <= t <= high}
        # Whole files of rows beyond the range are rare: at most one at either end.
        assert sum(e.n_rows for e in entries if e.name in met) <= sum(got.values()) + 400
    narrow = tokenizer.low + size // 3
    assert len(names(files.tokens(narrow, narrow + size // 1000))) <= 2


def test_a_layout_is_opened_again_and_grows(spark, lines, tmp_path):
    path = str(tmp_path / "t")
    TokenFiles.write(lines, path, MD5_60, rows_per_file=500, partitions=3)
    files = TokenFiles.open(spark.newSession(), path)
    assert (files.partition_key, files.tokenizer, files.rows_per_file) == (("l_orderkey",), MD5_60, 500)
    n = lines.df.count()
    assert files.read().df.columns == lines.df.columns and files.read().df.count() == n
    more = KeyedTable.of(lines.df.where("l_orderkey < 100"), lines.partition_key, lines.clustering)
    added = more.df.count()
    files.append(more)
    assert files.read().df.count() == n + added
    # What no manifest names is not there.
    lines.df.limit(5).withColumn("_token", F.lit(1).cast("bigint")).write.parquet(f"{path}/rows-lost")
    assert files.read().df.count() == n + added
    parts = [part.df.count() for _, part in files.iterate(MD5_60.bounds(5))]
    assert len(parts) == 5 and sum(parts) == n + added
    assert files.read(5, 4).df.count() == 0
    with pytest.raises(ValueError, match="columns"):
        files.append(KeyedTable.of(lines.df.drop("l_tax"), "l_orderkey"))
    with pytest.raises(ValueError, match="positive"):
        TokenFiles.write(lines, str(tmp_path / "u"), rows_per_file=0)
    assert files.delete() and not files.delete()


def test_odd_tables_in_files(spark, tmp_path):
    # Null keys, a key with most rows, copies of a row, columns with odd names, no rows.
    rows = [(None, 1, "a")] * 5 + [("hot", i, "b`c") for i in range(700)] + [(f"k{i}", 0, None) for i in range(50)] + [("hot", 1, "b`c")] * 9
    table = KeyedTable.of(spark.createDataFrame(rows, "`a key` string, `b.c` int, `x``y` string"), "a key", "b.c")
    files = TokenFiles.write(table, str(tmp_path / "t"), rows_per_file=100, partitions=5)
    assert Counter(map(tuple, files.read().df.collect())) == Counter(rows)
    token = with_token(table).where("`a key` = 'hot'").first()["_token"]
    hot = files.manifest(token, token).collect()
    assert len(hot) >= 7 and files.read(token, token).df.count() == 709
    empty = TokenFiles.write(KeyedTable.of(table.df.limit(0), "a key"), str(tmp_path / "e"))
    assert empty.manifest().count() == 0 and empty.read().df.count() == 0


# -- slices of equal weight -----------------------------------------------------------


def sizes_of(table, cut, tokenizer, weight=None):
    rows = with_token(table, tokenizer).withColumn("_w", F.lit(1) if weight is None else weight)
    ranges = TokenRanges.of(rows.sparkSession, [high for _, high in cut], tokenizer)
    return {r["slice"]: r.w for r in ranges.assign(rows).groupBy("slice").agg(F.sum("_w").alias("w")).collect()}


def check_cover(cut, tokenizer):
    assert cut[0][0] == tokenizer.low and cut[-1][1] == tokenizer.high
    assert all(a <= b for a, b in cut) and all(b + 1 == c for (_, b), (c, _) in zip(cut, cut[1:]))


@pytest.fixture(scope="module")
def skewed(spark):
    """Keys of very unequal weight, none of it heavy, beside one key with a third of all rows."""
    light = spark.range(60_000).select((F.col("id") % 20_000).cast("string").alias("k"), (F.col("id") % 97).alias("w"))
    light = light.unionByName(light.where("cast(k as int) < 6000").withColumn("w", F.col("w") * 9))
    hot = spark.range(39_000).select(F.lit("hot").alias("k"), F.lit(1).cast("bigint").alias("w"))
    return KeyedTable.of(light, "k"), KeyedTable.of(light.unionByName(hot), "k")


@pytest.mark.parametrize("tokenizer", [XXHASH_64, MD5_60])
@pytest.mark.parametrize("weighed", [False, True])
def test_slices_weigh_the_same(skewed, tokenizer, weighed):
    table, n, weight = skewed[0], 12, F.col("w") if weighed else None
    cut = balanced_slices(table, n, weight, tokenizer=tokenizer)
    check_cover(cut, tokenizer)
    sizes = sizes_of(table, cut, tokenizer, weight)
    mean = sum(sizes.values()) / n
    assert len(cut) == n and max(sizes.values()) <= 1.1 * mean and min(sizes.values()) >= 0.9 * mean


def test_a_hot_key_has_a_slice_of_its_own(skewed):
    table, n = skewed[1], 12
    weights = TokenWeights.of(table, n)
    refined = weights.refined(table, weights.total / n * 0.1)
    cut = refined.slices(n)
    check_cover(cut, XXHASH_64)
    sizes = sizes_of(table, cut, XXHASH_64)
    assert refined.weights(cut) == [sizes[i] for i in range(len(cut))]
    mean = sum(sizes.values()) / n
    assert max(sizes.values()) == 39_000 and sorted(sizes.values())[-2] <= 1.1 * mean and len(cut) <= n
    ranges = balanced_ranges(table, n)
    assert ranges.profile(table).where("n_rows = 39000").first().n_keys == 1
    assert ranges.profile(table).agg(F.sum("n_rows")).first()[0] == table.df.count()


def test_weights_are_added_without_rows(skewed, spark):
    first, second = skewed[0].df.where("w < 40"), skewed[0].df.where("w >= 40")
    parts = [TokenWeights.of(KeyedTable.of(df, "k"), 8, "bytes") for df in (first, second)]
    whole = TokenWeights.of(skewed[0], 8, "bytes")
    assert parts[0].merge(parts[1]).stretches == whole.stretches and whole.total > 0
    with pytest.raises(ValueError, match="same stretches"):
        whole.merge(TokenWeights.of(skewed[0], 100, "bytes"))


def test_few_bits_and_odd_tables(spark, monkeypatch):
    # Tokens of eight bits: stretches end up as single tokens, with several keys each.
    short = Tokenizer("short", lambda key: F.pmod(F.xxhash64(*key), F.lit(256)), bits=8, low=0)
    table = KeyedTable.of(spark.range(5_000).select(F.col("id").alias("k")), "k")
    monkeypatch.setattr(balance, "STEP_BITS", 1)
    monkeypatch.setattr(balance, "LISTED", 0)
    cut = balanced_slices(table, 5, tolerance=1, tokenizer=short)
    check_cover(cut, short)
    assert max(sizes_of(table, cut, short).values()) <= 1.2 * 1000
    empty = KeyedTable.of(table.df.limit(0), "k")
    assert balanced_slices(empty, 4) == [(XXHASH_64.low, XXHASH_64.high)]
    nulls = KeyedTable.of(spark.createDataFrame([(None, 1), (None, -5), (1, None)], "k int, w int"), "k")
    assert len(balanced_slices(nulls, 2, F.col("w"))) >= 1
    for n, tolerance in ((0, 0.1), (1 << 20, 0.1), (4, 0), (4, 2)):
        with pytest.raises(ValueError):
            balanced_slices(empty, n, tolerance=tolerance)
    with pytest.raises(ValueError, match="bytes"):
        balanced_slices(empty, 4, "chars")
