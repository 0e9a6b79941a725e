"""Work that goes on after a failure: backfills slice by slice, and cursors over groups."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from itertools import islice

import pytest
from pyspark.sql import functions as F

from conftest import SF
from keygroup import MD5_60, Backfill, Catalog, GroupCursor, KeyedTable, MultiQuery, QuerySpec, TokenFiles
from keygroup.operators import backfill as backfill_module
from keygroup.operators import cursor as cursor_module
from keygroup.operators.slices import read_slice

SCHEMA = "n bigint, total bigint"


@pytest.fixture(scope="module")
def orders(spark):
    return KeyedTable.of(spark.read.parquet(f"{SF}/orders.parquet"), "o_orderkey")


def test_a_killed_run_goes_on(spark, orders, tmp_path):
    path, slices = str(tmp_path / "run"), MD5_60.bounds(8)
    calls = Counter()

    def work(index, low, high, broken=()):
        calls[index] += 1
        rows = read_slice(orders, low, high, MD5_60)
        if index in broken:
            # It fails while the result is being written, in a task.
            rows = rows.where(F.assert_true(F.col("o_orderkey") < 0).isNull())
        return rows.agg(F.sum("o_orderkey").alias("total"), F.count("*").alias("n"))

    run = Backfill.start(spark, path, slices, SCHEMA)
    assert run.pending() == list(range(8)) and run.read(partial=True).count() == 0
    with pytest.raises(Exception, match="not true"):
        run.run(lambda *slot: work(*slot, broken={5}))
    assert run.done() == [0, 1, 2, 3, 4] and run.read(partial=True).count() == 5
    with pytest.raises(RuntimeError, match="3 of 8"):
        run.read()

    # Another session, which knows the path only.
    again = Backfill.open(spark.newSession(), path)
    assert again.slices == run.slices and again.run(work, most=1) == 1 and again.pending() == [6, 7]
    assert Backfill.start(spark, path, slices, SCHEMA).run(work) == 2 and again.run(work) == 0
    assert calls == Counter({i: 2 if i == 5 else 1 for i in range(8)})
    got = {r["_slice"]: (r.n, r.total) for r in again.read().collect()}
    expected = {i: tuple(work(i, *slices[i]).select("n", "total").first()) for i in range(8)}
    assert got == expected and sum(n for n, _ in got.values()) == orders.df.count()
    with pytest.raises(ValueError, match="other slices"):
        Backfill.start(spark, path, slices[:4], SCHEMA)
    assert run.clear() and not run.clear()


def test_two_runs_put_a_slice_in_place_once(spark, tmp_path):
    path = str(tmp_path / "run")
    first, second = (Backfill.start(spark, path, [(0, 1), (2, 3)], "v int") for _ in range(2))

    def slow(index, low, high):
        # The other run is done before this one's result is written.
        assert second.run(lambda *_: spark.range(3).selectExpr("int(id) v")) == 2
        return spark.range(99).selectExpr("int(id) v")

    assert first.run(slow, most=1) == 0
    assert first.read().groupBy("_slice").count().orderBy("_slice").collect() == [(0, 3), (1, 3)]
    assert backfill_module._listed(spark, f"{path}/_aside") == []
    nothing = Backfill.start(spark, str(tmp_path / "none"), [(0, 1)], "v int")
    assert nothing.run(lambda *_: spark.range(0).selectExpr("id v")) == 1 and nothing.read().count() == 0


# -- cursors --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def catalog(spark):
    left = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.5)).when(F.col("id") % 50 == 1, F.lit(float("nan")))
        .when(F.col("id") % 50 == 2, F.lit(None)).otherwise((F.col("id") % 90).cast("double")).alias("k"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("c"), F.col("id") % 4)).alias("c.d"),
        F.col("id").alias("at"),
    )
    right = spark.range(60).select((F.col("id") + 60).cast("double").alias("k"), F.lit("c1").alias("c.d"), F.col("id").alias("name"))
    return (
        Catalog(spark)
        .add("t", "left", KeyedTable.of(left, "k", ["c.d", "at"], unique=True))
        .add("t", "right", KeyedTable.of(right, "k", ["c.d", "name"], unique=True))
    )


def pages_of(groups, **options):
    return sorted(map(repr, groups.merged(**options).collect()))


def flat(page):
    return (*page.key, page.number, page.rows)


@pytest.mark.parametrize("prefetch", [1, 10**6])
def test_a_cursor_gives_every_page_with_its_key(catalog, prefetch):
    job = MultiQuery(catalog).add(QuerySpec("t", "left"), QuerySpec("t", "right")).group_by("c.d")
    with job.read(page_rows=40) as groups:
        cursor = groups.cursor(prefetch_rows=prefetch, rows_per_file=30, partitions=4)
        if prefetch == 1:
            # A page at a time, from the middle of a large group on.
            pages = list(islice(cursor, 12))
            assert len({page.position for page in pages}) == 12
            assert [p.position for p in islice(cursor.pages(after=pages[4].position), 7)] == [p.position for p in pages[5:]]
            return
        pages = list(cursor)
        assert sorted(repr(p.key.asDict() | {"_page": p.number, "rows": p.rows}) for p in pages) == sorted(
            repr(r.asDict()) for r in groups.merged().collect()
        )
        # Pages of a group follow each other, by number.
        numbers = defaultdict(list)
        for at, page in enumerate(pages):
            numbers[repr(page.key)].append((at, page.number))
        for found in numbers.values():
            assert [at - found[0][0] for at, _ in found] == [number for _, number in found] == list(range(len(found)))
        assert max(len(found) for found in numbers.values()) > 4


def test_a_cursor_goes_on_from_any_position(catalog, spark, tmp_path):
    job = MultiQuery(catalog).add(QuerySpec("t", "left")).group_by("c.d")
    path = str(tmp_path / "pages")
    with job.read(page_rows=25) as groups:
        groups.lay_out(path, rows_per_file=20, partitions=5)
    whole = list(GroupCursor(TokenFiles.open(spark, path)))
    in_the_middle = next(i for i, p in enumerate(whole) if p.number == 3)
    for at in (in_the_middle, len(whole) - 1):
        later = GroupCursor(TokenFiles.open(spark.newSession(), path), prefetch_rows=2_000)
        rest = list(later.pages(after=whole[at].position))
        assert [repr(flat(p)) for p in rest] == [repr(flat(p)) for p in whole[at + 1 :]]
    assert any(p.key[0] is not None and math.isnan(p.key[0]) for p in whole) and any(p.key[0] is None for p in whole)
    with pytest.raises(ValueError, match="position"):
        next(later.pages(after=(1, 2)))
    with pytest.raises(ValueError, match="positive"):
        GroupCursor(TokenFiles.open(spark, path), 0)


def test_a_fetch_is_bounded(catalog, monkeypatch):
    fetched = []
    fetch = GroupCursor._fetch

    def counted(self, after):
        rows = fetch(self, after)
        fetched.append(sum(len(r["s0"]) + len(r["s1"]) for r in rows))
        return rows

    monkeypatch.setattr(GroupCursor, "_fetch", counted)
    monkeypatch.setattr(cursor_module, "PREFETCH_PAGES", 30)
    groups = MultiQuery(catalog).add(QuerySpec("t", "left"), QuerySpec("t", "right")).read(page_rows=100)
    pages = list(groups.cursor(prefetch_rows=250, cogrouped=True))
    assert sum(len(p.lists["s0"]) + len(p.lists["s1"]) for p in pages) == 3_060 and sum(fetched) == 3_060
    assert max(fetched) <= 250 and fetched[-1] == 0
    groups.close()


def test_a_cursor_over_nothing(catalog):
    groups = MultiQuery(catalog).add(QuerySpec.builder().keyspace("t").table("left").where("WHERE at < 0").build()).read()
    assert list(groups.cursor()) == []
