"""A small fixture of two tables; what is expected is worked out from its rows."""

from __future__ import annotations

from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import HARBOURS, SAILINGS
from keygroup import JobError, MultiQuery, QuerySpec, scan, workspace_dir

PIERS = QuerySpec("sea", "harbours")
BOATS = QuerySpec("sea", "sailings")
PAGES = pytest.mark.parametrize("page_rows", [1, 3, 10_000])


def job(coasts, *specs, by=()):
    return MultiQuery(coasts).add(*specs).group_by(*by)


def sizes(df, *keys):
    return {tuple(r[k] for k in keys): len(r["rows"]) for r in df.collect()}


@pytest.mark.parametrize("by", [(), ("bay",), ("bay", "pier"), ("pier",)])
def test_groups_hold_the_rows_of_their_key(coasts, by):
    columns = ["coast", *by]
    place = [["coast", "bay", "pier"].index(c) for c in columns]
    expected = Counter(tuple(r[i] for i in place) for r in HARBOURS + SAILINGS)
    assert sizes(job(coasts, PIERS, BOATS, by=by).read().merged(), *columns) == expected
    alone = Counter(tuple(r[i] for i in place) for r in HARBOURS)
    assert sizes(job(coasts, PIERS, by=by).read().merged(), *columns) == alone


@pytest.mark.parametrize("where, args", [("WHERE bay < 'Heron'", ()), ("bay < ? -- up to the herons", ("Heron",))])
def test_predicate(coasts, where, args):
    spec = QuerySpec.builder().keyspace("sea").table("harbours").where(where, *args).build()
    kept = [r for r in HARBOURS if r[1] < "Heron"]
    assert {tuple(r) for r in scan(coasts, spec, tokenizer=None).collect()} == set(kept)
    assert sizes(job(coasts, spec).read().merged(), "coast") == Counter((r[0],) for r in kept)


def test_all_columns(coasts):
    assert scan(coasts, PIERS, tokenizer=None).columns == ["coast", "bay", "pier", "berths"]
    [first, *_] = job(coasts, PIERS).read().merged().collect()
    assert first["rows"][0]["s0"].asDict().keys() == {"bay", "pier", "berths"}


@PAGES
def test_lists_by_pier(coasts, page_rows):
    pages = job(coasts, PIERS, BOATS, by=("bay", "pier")).read(page_rows).merged()
    groups = {}
    for page in pages.orderBy("coast", "bay", "pier", "_page").collect():
        assert len(page["rows"]) <= page_rows
        groups.setdefault((page["coast"], page["bay"], page["pier"]), []).extend(page["rows"])
    assert len(groups) == 8
    for key, rows in groups.items():
        berths = [r[3] for r in HARBOURS if r[:3] == key]
        boats = sorted(r[3] for r in SAILINGS if r[:3] == key)
        assert [r["_q"] for r in rows] == [0] * len(berths) + [1] * len(boats)
        assert [r["s0"]["berths"] for r in rows if r["_q"] == 0] == berths
        assert [r["s1"]["boat"] for r in rows if r["_q"] == 1] == boats
        assert all(r["s1" if r["_q"] == 0 else "s0"] is None for r in rows)


@PAGES
def test_cogrouped_lists(coasts, page_rows):
    got = {}
    for r in job(coasts, PIERS, BOATS).read(page_rows).cogrouped().orderBy("coast", "_page").collect():
        berths, boats = got.setdefault(r["coast"], ([], []))
        berths += [x["berths"] for x in r["s0"]]
        boats += [x["boat"] for x in r["s1"]]
    for coast in {r[0] for r in HARBOURS + SAILINGS}:
        assert got[coast] == (
            [r[3] for r in sorted(HARBOURS) if r[0] == coast], [r[3] for r in sorted(SAILINGS) if r[0] == coast]
        )


@PAGES
def test_flat_positions(coasts, page_rows):
    per_coast = {}
    for r in job(coasts, PIERS, BOATS).read(page_rows).flat().collect():
        per_coast.setdefault(r["coast"], {})[r["_pos"]] = r
    for coast, group in per_coast.items():
        names = [(r["s0"] or r["s1"])["pier"] for _, r in sorted(group.items())]
        ordered = [r for r in sorted(HARBOURS) if r[0] == coast] + [r for r in sorted(SAILINGS) if r[0] == coast]
        assert sorted(group) == list(range(1, len(ordered) + 1))
        assert names == [r[2] for r in ordered]


# -- results that must not depend on the size of groups ------------------------------


def both(coasts, make, *specs, by=()):
    """What ``make`` makes of groups in small pages, after comparing it with one page."""
    made = [make(job(coasts, *specs, by=by).read(n)) for n in (3, 10_000)]
    assert made[0].schema == made[1].schema
    small, large = (sorted(map(tuple, df.collect()), key=repr) for df in made)
    assert small == large
    return small


def test_fold_joins_pages_of_any_number(coasts):
    berths = F.aggregate("rows", F.lit(0), lambda total, r: total + F.coalesce(r["s0"]["berths"], F.lit(0)))
    boats = F.size(F.filter("rows", lambda r: r["_q"] == 1))
    got = both(coasts, lambda g: g.fold(n=(F.size("rows"), F.sum), berths=(berths, F.sum), boats=(boats, F.sum)), PIERS, BOATS)
    for coast, n, total, sailing in got:
        assert total == sum(r[3] for r in HARBOURS if r[0] == coast)
        assert sailing == sum(r[0] == coast for r in SAILINGS)
        assert n == sailing + sum(r[0] == coast for r in HARBOURS)


@pytest.mark.parametrize("join, kind", [(F.sum, "bigint"), (F.avg, "double"), (F.count, "bigint")])
def test_fold_has_one_schema(coasts, join, kind):
    for page_rows in (3, 10_000):
        folded = job(coasts, PIERS, BOATS).read(page_rows).fold(x=(F.size("rows"), join))
        assert dict(folded.dtypes)["x"] == kind
    one_page = job(coasts, PIERS, BOATS).read().fold(x=(F.size("rows"), F.count))
    assert {r.x for r in one_page.collect()} == {1}


def test_fold_adds_no_exchange(coasts):
    folded = job(coasts, PIERS, BOATS).read().fold(n=(F.size("rows"), F.sum))
    assert folded._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def wide(spark):
    """A header per key with a limit, and many lines, some keys without one or the other."""
    from keygroup import Catalog, KeyedTable

    heads = spark.createDataFrame([(k, 10 * k) for k in range(1, 6)], "k int, bound int")
    lines = spark.createDataFrame([(k, i, (7 * i) % 50) for k in range(2, 8) for i in range(5 * k)], "k int, i int, v int")
    catalog = Catalog(spark).add("t", "heads", KeyedTable.of(heads, "k", unique=True))
    return catalog.add("t", "lines", KeyedTable.of(lines, "k", "i", unique=True))


HEADS, LINES = QuerySpec("t", "heads"), QuerySpec("t", "lines")
EXPECTED = {
    k: sum((7 * i) % 50 > 10 * k for i in range(5 * k)) if 2 <= k <= 5 else 0 for k in range(1, 8)
}


def test_a_carried_row_comes_with_every_page(spark):
    catalog = wide(spark)
    above = F.size(F.filter("s1", lambda r: r["v"] > F.get("s0", 0)["bound"]))
    got = both(catalog, lambda g: g.fold(cogrouped=True, carry=[HEADS], n=(above, F.sum)), HEADS, LINES)
    assert dict(got) == EXPECTED
    pages = job(catalog, HEADS, LINES).read(3)
    lists = pages.cogrouped(carry=[0]).collect()
    assert all(len(r["s0"]) == (1 if r["k"] <= 5 else 0) and len(r["s1"]) <= 3 for r in lists)
    merged = pages.merged(carry=[HEADS]).where("k = 4").collect()
    assert len(merged) == 7 and all(r["rows"][0]["_q"] == 0 for r in merged)


def test_carried_rows_reach_functions(spark):
    def above(pdf):
        bound = pdf["s0_bound"].max()
        return pd.DataFrame({"k": pdf["k"].iloc[:1], "n": [int((pdf["s1_v"] > bound).sum())]})

    def total(pdf):
        return pd.DataFrame({"k": pdf["k"].iloc[:1], "n": [pdf["n"].sum()]})

    catalog = wide(spark)
    got = both(catalog, lambda g: g.apply_groups(above, total, "k int, n bigint", carry=[HEADS], partitions=3), HEADS, LINES)
    assert dict(got) == EXPECTED


def test_a_group_of_carried_rows_alone(spark):
    catalog = wide(spark)
    groups = job(catalog, HEADS, HEADS, LINES).read(1)
    pages = groups.cogrouped(carry=[0, 1]).where("k = 1").collect()
    assert [(len(r["s0"]), len(r["s1"]), len(r["s2"])) for r in pages] == [(1, 1, 0)]


def test_queries_with_many_rows_cannot_be_carried(spark, coasts):
    for carry in ([LINES], [1], [7], [PIERS]):
        with pytest.raises(JobError):
            job(wide(spark), HEADS, LINES).read().merged(carry=carry)
    with pytest.raises(JobError):
        job(coasts, PIERS, BOATS).read().merged(carry=[PIERS])
    assert job(coasts, PIERS, BOATS, by=("bay", "pier")).read().merged(carry=[PIERS]).count() == 8


def test_merge_runs_for_one_page_too(coasts):
    def count(pdf):
        return pd.DataFrame({"coast": pdf["coast"].iloc[:1], "n": [len(pdf)]})

    def finish(pdf):
        return pd.DataFrame({"coast": pdf["coast"].iloc[:1], "n": [min(1000, 1000 + pdf["n"].sum())]})

    got = both(coasts, lambda g: g.apply_groups(count, finish, "coast string, n bigint"), PIERS, BOATS)
    assert {n for _, n in got} == {1000}


@pytest.mark.parametrize("page_rows, fan_in", [(1, 2), (2, 1000), (10_000, 1000)])
def test_user_function_per_group(coasts, page_rows, fan_in, monkeypatch):
    from keygroup.operators import groups as module

    monkeypatch.setattr(module, "MERGE_FAN_IN", fan_in)

    # Nested, so that they travel to the workers by value.
    def line_up(pdf):
        names = pdf["s1_boat"].dropna().tolist()
        return pd.DataFrame({"coast": [pdf["coast"].iloc[0]], "n": [len(pdf)], "names": [names]})

    def join(pdf):
        names = [x for part in pdf["names"] for x in part]
        return pd.DataFrame({"coast": [pdf["coast"].iloc[0]], "n": [pdf["n"].sum()], "names": [names]})

    groups = job(coasts, PIERS, BOATS).read(page_rows)
    got = {r.coast: r for r in groups.apply_groups(line_up, join, "coast string, n bigint, names array<string>").collect()}
    assert {c: r.n for c, r in got.items()} == Counter(r[0] for r in HARBOURS + SAILINGS)
    assert all(list(r.names) == [x[3] for x in sorted(SAILINGS) if x[0] == c] for c, r in got.items())


def test_pages_reach_the_function_in_order(coasts):
    def seen(pdf):
        return pdf[["coast", "_page", "_q"]].assign(at=range(len(pdf)), pier=pdf["s0_pier"].fillna(pdf["s1_pier"]))

    rows = job(coasts, PIERS, BOATS).read(4).apply_pages(seen, "coast string, _page bigint, _q int, at int, pier string")
    in_order = sorted((r for r in rows.collect() if r.coast == "north"), key=lambda r: (r._page, r.at))
    expected = [(0, r[2]) for r in sorted(HARBOURS) if r[0] == "north"] + [(1, r[2]) for r in sorted(SAILINGS) if r[0] == "north"]
    assert [(r._q, r.pier) for r in in_order] == expected


def test_closing_leaves_no_table_behind(spark, coasts):
    import os

    before = set(os.listdir(workspace_dir(spark))) if os.path.isdir(workspace_dir(spark)) else set()
    with job(coasts, PIERS, BOATS).read(2) as groups:
        assert groups.merged().count() > 5 and groups.flat().count() == 20
        assert set(os.listdir(workspace_dir(spark))) - before
    assert set(os.listdir(workspace_dir(spark))) == before
