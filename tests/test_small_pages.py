"""Many groups of a few small pages each: a task cuts them where their key is."""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from keygroup import Catalog, KeyedTable, MultiQuery, QuerySpec
from keygroup.operators import groups as module

HEADS, LINES = QuerySpec("t", "heads", ("name",)), QuerySpec("t", "lines", ("v",))


@pytest.fixture(scope="module")
def catalog(spark):
    """Groups of up to 12 lines, one of 300, copies of lines, keys that are null or NaN, heads without lines."""
    key = F.when(F.col("id") < 300, F.lit(-1.0)).when(F.col("id") % 37 == 0, F.lit(None))
    key = key.when(F.col("id") % 41 == 0, F.lit(float("nan"))).otherwise((F.sqrt("id") * 3).cast("int").cast("double"))
    lines = spark.range(2_000).select(key.alias("k"), (F.col("id") % 7).alias("c"), (F.col("id") % 5).alias("v"))
    heads = spark.range(-1, 160).select(
        F.when(F.col("id") == 0, F.lit(None)).when(F.col("id") == 1, F.lit(float("nan")))
        .otherwise(F.col("id").cast("double")).alias("k"), F.col("id").alias("name"),
    )
    return (
        Catalog(spark)
        .add("t", "heads", KeyedTable.of(heads, "k", unique=True))
        .add("t", "lines", KeyedTable.of(lines, "k", "c"))
    )


def read(catalog):
    return MultiQuery(catalog).add(HEADS, LINES).read(page_rows=3)


def forms(catalog):
    """What every form returns, comparable."""

    def count(pdf):
        return pd.DataFrame({"k": pdf["k"].iloc[:1], "n": [len(pdf)], "heads": [pdf["s0_name"].notna().sum()]})

    def add(pdf):
        return pdf.groupby("k", as_index=False, dropna=False).sum()

    frames = {
        "merged": read(catalog).merged(),
        "carried": read(catalog).merged(carry=[HEADS]),
        "cogrouped": read(catalog).cogrouped(carry=[0]),
        "flat": read(catalog).flat(),
        "sorted": read(catalog).sorted_slices(4).drop("_token"),
        "partitioned": read(catalog).partitioned(5),
        "fold": read(catalog).fold(cogrouped=True, carry=[HEADS], n=(F.size("s1"), F.sum), name=(F.get("s0", 0)["name"], F.max)),
        "apply": read(catalog).apply_groups(count, add, "k double, n bigint, heads bigint", carry=[HEADS], partitions=3),
    }
    return {form: Counter(map(repr, df.collect())) for form, df in frames.items()}


def test_groups_in_a_task_and_groups_over_several_have_the_same_pages(catalog, monkeypatch):
    found = forms(catalog)
    # Now the group of 300 is too large for a task.
    monkeypatch.setattr(module, "TASK_ROWS", 20)
    assert forms(catalog) == found
    heads = catalog.lookup("t", "heads").df
    lines = catalog.lookup("t", "lines").df
    sizes = {repr(r.k): r["count"] for r in lines.groupBy("k").count().collect()}
    keys = {repr(r.k) for r in heads.collect()} | set(sizes)
    pages = Counter(repr(r.k) for r in read(catalog).merged(carry=[HEADS]).collect())
    assert pages == {k: max(1, math.ceil(sizes.get(k, 0) / 3)) for k in keys} and max(pages.values()) >= 60


def test_rows_of_small_groups_move_once(spark, monkeypatch):
    """Nothing is written on the way, and one shuffle serves pages, lists and the fold over pages."""

    def refused(*_, **__):
        raise AssertionError("no group here is too large for a task")

    monkeypatch.setattr(module, "number_rows", refused)
    dear = F.size(F.filter("s1", lambda line: line["v"] > F.get("s0", 0)["name"]))
    heads = KeyedTable.of(spark.range(110).select(F.col("id").alias("k"), F.col("id").alias("name")), "k", unique=True)
    lines = KeyedTable.of(spark.range(900).select((F.col("id") % 100).alias("k"), F.col("id").alias("v")), "k")
    groups = read(Catalog(spark).add("t", "heads", heads).add("t", "lines", lines))
    folded = groups.fold(cogrouped=True, carry=[HEADS], n=(dear, F.sum))
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and groups._paths == []
    found = {r.k: r.n for r in folded.collect()}
    assert found == {k: sum(i > k for i in range(k, 900, 100)) if k < 100 else 0 for k in range(110)}
