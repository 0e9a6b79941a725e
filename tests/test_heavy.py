"""Summaries of heavy keys, against exact counts."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from keygroup import KeyedTable, heavy_keys
from keygroup.operators import heavy, hot


@pytest.mark.parametrize("counters", [1, 5, 40, 1_000])
@pytest.mark.parametrize("weighted", [False, True])
def test_no_value_is_undercounted_by_more_than_was_taken(counters, weighted):
    rng = random.Random(counters)
    summary, exact = heavy.Summary(counters), Counter()
    for _ in range(60):
        values = [rng.choice([rng.randrange(5), rng.randrange(400)]) - 100 for _ in range(rng.randrange(90))]
        weights = [rng.randrange(9) if weighted else 1 for _ in values]
        summary.add(np.array(values, np.int64), np.array(weights, np.int64) if weighted else None)
        for v, w in zip(values, weights):
            exact[v] += w
    summary.settle()
    assert len(summary.values) <= counters
    # What is taken off is bounded by the weight of all, shared among the counters.
    assert summary.taken <= sum(exact.values()) / (counters + 1)
    found = dict(zip(summary.values.tolist(), summary.weights.tolist()))
    for v, w in exact.items():
        assert w - summary.taken <= found.get(v, 0) <= w
    summary.take(10)
    found = dict(zip(summary.values.tolist(), summary.weights.tolist()))
    assert all(w - summary.taken <= found.get(v, 0) <= w for v, w in exact.items())


@pytest.fixture(scope="module")
def rows(spark):
    """Two heavy keys, one just at the limit, and many light ones, over ten partitions."""
    light = spark.range(40_000).select(F.col("id").alias("k"))
    heavy_ones = spark.range(4_501).select(F.when(F.col("id") < 3_000, -1).when(F.col("id") < 4_000, -2).otherwise(-3).alias("k"))
    weighed = light.unionByName(heavy_ones).repartition(10).withColumn("w", F.pmod(F.xxhash64("k"), F.lit(3)) + 1)
    weighed.persist().count()
    yield weighed
    weighed.unpersist()


def found(rows, limit, weight=None):
    hot_keys = hot.find_hot_keys(rows, ["k"], limit, weight)
    return {} if hot_keys is None else {r["k"]: (r["_n"], r["_w"]) for r in hot_keys.table.collect()}


@pytest.mark.parametrize("counters", [3, 50, 1 << 17])
def test_hot_keys_are_the_same_with_any_summary(rows, counters, monkeypatch):
    monkeypatch.setattr(heavy, "COUNTERS", counters)
    assert found(rows, 999) == {-1: (3_000, 3_000), -2: (1_000, 1_000)}
    assert found(rows, 1_000) == {-1: (3_000, 3_000)}
    assert found(rows, 3_000) == {}
    exact = {r["k"]: (r.n, r.w) for r in rows.groupBy("k").agg(F.count("*").alias("n"), F.sum("w").alias("w")).where("w > 700").collect()}
    assert found(rows, 700, F.col("w")) == exact and len(exact) >= 2
    assert found(rows.limit(0), 1) == {}


def test_what_is_shuffled_is_bounded_by_the_summaries(rows):
    kept = heavy.summarised(rows, F.col("k"), counters=64)
    tasks = rows.rdd.getNumPartitions()
    assert kept.count() <= tasks * 65 and kept.where("value IS NULL").count() == tasks
    # With counters to spare, light values are left out all the same.
    trimmed = heavy.summarised(rows, F.col("k"), spare=20)
    assert trimmed.where("value IS NOT NULL").count() <= tasks * 3
    with heavy.heavy_values(rows, F.col("k"), 999) as candidates:
        assert {-1, -2} <= {r[0] for r in candidates.collect()} and candidates.count() <= 3
    with heavy.heavy_values(rows, F.col("k"), 5, counters=20) as candidates:
        assert candidates is None


def test_heavy_keys_of_a_table(spark):
    rows = [(None, "x", 5)] * 30 + [("a", "x", 1)] * 30 + [("a", "y", 100)] + [("b", None, None)] * 40
    table = KeyedTable.of(spark.createDataFrame(rows, "`k.1` string, k2 string, w int"), ["k.1", "k2"])
    assert {tuple(r) for r in heavy_keys(table, 29).collect()} == {(None, "x", 30, 30), ("a", "x", 30, 30), ("b", None, 40, 40)}
    weights = heavy_keys(table, 99, F.coalesce("w", F.lit(0)))
    assert {tuple(r) for r in weights.collect()} == {(None, "x", 30, 150), ("a", "y", 1, 100)}
    assert heavy_keys(table, 10**9).collect() == [] and heavy_keys(table, 10**9).columns == ["k.1", "k2", "n_rows", "weight"]
    with pytest.raises(ValueError, match="negative"):
        heavy_keys(table, -1)
