"""Functions that see the rows of every query of a group apart."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from keygroup import Catalog, JobError, KeyedTable, MultiQuery, QuerySpec
from keygroup.operators import sides

HARBOURS, SAILINGS = QuerySpec("sea", "harbours", ("berths",)), QuerySpec("sea", "sailings", ("boat",))


def test_both_sides_of_a_group(coasts):
    def per_pier(key, harbours, sailings):
        berths = [b for batch in harbours for b in batch.column("berths").to_pylist()]
        boats = [b for batch in sailings for b in batch.column("boat").to_pylist()]
        return [{"coast": [key[0]], "pier": [key[2]], "berths": [sum(berths)], "boats": [",".join(boats)]}]

    groups = MultiQuery(coasts).add(HARBOURS, SAILINGS).group_by("bay", "pier").read()
    got = {tuple(r) for r in groups.apply_sides(per_pier, "coast string, pier string, berths int, boats string").collect()}
    assert got == {
        ("north", "Old Pier", 4, "Curlew,Tern"), ("north", "New Pier", 6, "Plover"), ("north", "Mill Pier", 2, "Avocet,Dunlin,Knot"),
        ("east", "Long Pier", 9, "Fulmar,Petrel"), ("east", "Ropewalk", 1, ""), ("south", "Stone Pier", 3, "Shag"),
        ("west", "Ferry Steps", 5, "Gannet,Skua"), ("isles", "Slipway", 0, "Auk,Puffin"),
    }


@pytest.fixture(scope="module")
def two_tables(spark):
    """A key with a third of all rows on both sides, keys on one side only, and odd keys."""
    left = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.0)).when(F.col("id") % 3 == 1, F.lit(float("nan")))
        .when(F.col("id") == 2, F.lit(None)).otherwise((F.col("id") % 700).cast("double")).alias("k"),
        F.col("id").alias("at"),
        (F.lit(1 << 60) + F.col("id")).alias("big"),
    )
    right = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-0.0)).otherwise((F.col("id") % 900).cast("double")).alias("k"),
        F.col("id").alias("place"),
        F.concat(F.lit("r"), "id").alias("name"),
    )
    return (
        Catalog(spark)
        .add("t", "left", KeyedTable.of(left, "k", "at", unique=True))
        .add("t", "right", KeyedTable.of(right, "k", "place", unique=True))
    )


def test_a_hot_group_is_streamed(two_tables):
    def measured(key, left, right):
        n, most, last, total = 0, 0, -1, 0
        for batch in left:
            assert batch.schema.names == ["at", "big"] and batch.schema.field("big").type == pa.int64()
            at = batch.column("at").to_pylist()
            assert at == sorted(at) and at[0] > last
            last = at[-1]
            n, most, total = n + len(at), max(most, len(at)), total + sum(b - (1 << 60) for b in batch.column("big").to_pylist())
        names = [name for batch in right for name in batch.column("name").to_pylist()]
        assert names == sorted(names, key=lambda x: int(x[1:]))
        yield pa.table({"k": pa.array([key[0]], pa.float64()), "n": [n], "most": [most], "total": [total], "m": [len(names)]})

    groups = MultiQuery(two_tables).add(QuerySpec("t", "left"), QuerySpec("t", "right")).read()
    # A column of the function's own order and more columns than asked for do no harm.
    rows = groups.apply_sides(measured, "m long, n long, k double, most long, total long", batch_rows=100).collect()
    assert all(r.most <= 100 for r in rows)
    name = lambda k: "nan" if k is not None and math.isnan(k) else k
    expected = Counter()
    for i in range(9_000):
        expected[0.0 if i % 3 == 0 else "nan" if i % 3 == 1 else None if i == 2 else float(i % 700)] += 1
    others = Counter(0.0 if i % 3 == 0 else float(i % 900) for i in range(3_000))
    assert {name(r.k): r.n for r in rows if r.n} == expected
    assert {name(r.k): r.m for r in rows if r.m} == others
    assert len(rows) == len(expected | others) and sum(r.total for r in rows) == sum(range(9_000))


def test_pages_share_a_hot_group(two_tables):
    def per_page(key, left, right):
        n = sum(batch.num_rows for batch in left)
        yield pd.DataFrame({"k": [key[0]], "n": [n], "m": [sum(batch.num_rows for batch in right)]})

    groups = MultiQuery(two_tables).add(QuerySpec("t", "left"), QuerySpec("t", "right")).read(page_rows=250)
    rows = groups.apply_sides(per_page, "k double, n long, m long", paged=True).collect()
    sizes = [r.n + r.m for r in rows if r.k == 0.0]
    assert len(sizes) == 17 and max(sizes) == 250 and sum(sizes) == 4_004
    whole = groups.apply_sides(per_page, "k double, n long, m long").where("k = 0.0").collect()
    assert [(r.n, r.m) for r in whole] == [(3_004, 1_000)]


def test_carried_rows_come_with_every_page(spark):
    heads = spark.createDataFrame([(1, 10), (2, 20)], "k int, price int")
    lines = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 1)], "k int, n int")
    catalog = (
        Catalog(spark).add("t", "heads", KeyedTable.of(heads, "k", unique=True)).add("t", "lines", KeyedTable.of(lines, "k", "n"))
    )

    def worth(key, heads, lines):
        price = next(heads).column("price")[0].as_py()
        yield {"k": [key[0]], "worth": [price * sum(batch.num_rows for batch in lines)]}

    head = QuerySpec("t", "heads")
    groups = MultiQuery(catalog).add(head, QuerySpec("t", "lines")).read(page_rows=10)
    rows = groups.apply_sides(worth, "k int, worth int", paged=True, carry=[head]).collect()
    total = defaultdict(list)
    for r in rows:
        total[r.k].append(r.worth)
    assert sorted(total[1]) == [100] * 5 and total[2] == [20]
    with pytest.raises(JobError, match="carried"):
        groups.apply_sides(worth, "k int, worth int", carry=[head])


def test_sides_are_read_in_order(coasts):
    groups = MultiQuery(coasts).add(HARBOURS, SAILINGS).group_by("bay", "pier").read()

    def later_alone(key, harbours, sailings):
        return [{"n": [sum(batch.num_rows for batch in sailings)]}]

    assert groups.apply_sides(later_alone, "n int").agg(F.sum("n")).first()[0] == 13
    assert groups.apply_sides(lambda key, *sides: None, "n int").count() == 0

    def back_again(key, harbours, sailings):
        list(sailings)
        list(harbours)

    with pytest.raises(PythonException, match="side 0 was passed"):
        groups.apply_sides(back_again, "n int").collect()
    with pytest.raises(PythonException, match="no columns"):
        groups.apply_sides(lambda key, *sides: [pd.DataFrame({"x": [1]})], "n int").collect()
    with pytest.raises(ValueError, match="positive"):
        groups.apply_sides(later_alone, "n int", batch_rows=0)


def test_keys_that_arrow_cannot_encode():
    struct = pa.array([{"a": 1.0}, {"a": 1.0}, None, None, {"a": 2.0}])
    batch = pa.RecordBatch.from_arrays(
        [struct, pa.array([0, 0, 0, 0, 0]), pa.array([{"x": i} for i in range(5)])], names=["k", "_q", "s0"]
    )
    assert [s[2].num_rows for s in sides.stretches([batch], 1, 10)] == [2, 2, 1]


def test_results_are_merged_in_bounded_frames():
    sizes = []

    def merge(frame):
        sizes.append(len(frame))
        return frame.groupby("k", dropna=False, as_index=False).agg(v=("v", "sum"), first=("first", "first"))

    rows = [(k, page, v) for k in (None, 1.0, 2.0) for page in range(20) for v in range(10)]
    frame = pd.DataFrame(rows, columns=["k", "_page", "v"])
    frame["first"] = frame["_page"]
    # Batches that end within a page.
    stream = (frame.iloc[at : at + 7] for at in range(0, len(frame), 7))
    merged = pd.concat(sides.merged_in_order(stream, merge, ["k"], 25))
    assert merged["v"].tolist() == [900] * 3 and merged["first"].tolist() == [0] * 3 and merged["_page"].tolist() == [0] * 3
    assert max(sizes) <= 25 + 10 + 1 and merged["k"].isna().sum() == 1
