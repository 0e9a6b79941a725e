"""Jobs that must be refused before any data are read, and bound arguments."""

from __future__ import annotations

import datetime as dt
import decimal
import pickle

import pytest

from keygroup import Catalog, JobError, KeyedTable, MultiQuery, QuerySpec, UnknownTableError, WhereClause, scan


@pytest.fixture(scope="module")
def catalog(spark):
    def table(schema, key, clustering=()):
        return KeyedTable.of(spark.createDataFrame([], schema), key, clustering)

    return (
        Catalog(spark)
        .add("a", "base", table("k int, c string, v long", "k", "c"))
        .add("a", "two_keys", table("k int, l int, c string", ["k", "l"], "c"))
        .add("a", "other_name", table("kk int, c string", "kk", "c"))
        .add("a", "other_type", table("k long, c string", "k", "c"))
        .add("a", "no_clustering", table("k int, c string", "k"))
        .add("a", "clustering_type", table("k int, c int", "k", "c"))
        .add("a", "lists", table("k int, c array<int>", "k", "c"))
        .add("a", "map_key", table("k struct<x:int>, c int", "k", "c"))
        .add("a", "reserved", table("_page int, c int", "_page", "c"))
        .add("a", "reserved_too", table("s0 int, c int", "s0", "c"))
    )


def spec(name, *columns, where=None):
    return QuerySpec("a", name, columns, where)


def refused(catalog, *specs, group_by=(), match=None, error=JobError):
    with pytest.raises(error, match=match):
        MultiQuery(catalog).add(*specs).group_by(*group_by).read()


def test_no_query(catalog):
    refused(catalog, match="at least one query")


def test_unknown_names(catalog, spark):
    refused(catalog, QuerySpec("nowhere", "base"), match="keyspace nowhere", error=UnknownTableError)
    refused(catalog, spec("nothing"), match="table nothing", error=UnknownTableError)
    refused(catalog, spec("Base"), error=UnknownTableError)
    files = Catalog(spark).add_files("a", "gone", "/nonexistent/x.parquet", partition_key="k")
    refused(files, spec("gone"), match="a.gone", error=UnknownTableError)
    relation = Catalog(spark).add_table("a", "gone", "no_such_view", partition_key="k")
    refused(relation, spec("gone"), error=UnknownTableError)


def test_partition_keys_must_agree(catalog):
    refused(catalog, spec("base"), spec("two_keys"), match="2 partition-key columns")
    refused(catalog, spec("base"), spec("other_name"), match="should be named k")
    refused(catalog, spec("base"), spec("other_type"), match="is bigint")


def test_grouping_columns_must_be_clustering_columns_everywhere(catalog):
    refused(catalog, spec("base"), group_by=["v"], match="no clustering columns")
    refused(catalog, spec("base"), spec("no_clustering"), group_by=["c"], match="a.no_clustering")
    refused(catalog, spec("base"), spec("clustering_type"), group_by=["c"], match="another type")


def test_grouping_types(catalog):
    refused(catalog, spec("lists"), group_by=["c"], match="array<int>")
    refused(catalog, spec("map_key"), match="struct<x:int>")


def test_reserved_key_names(catalog):
    refused(catalog, spec("reserved"), match="reserved")
    refused(catalog, spec("reserved_too"), match="reserved")


def test_columns_must_exist(catalog):
    refused(catalog, spec("base", "v", "nope"), match="no column nope")
    assert scan(catalog, spec("base", "v + 1 AS w"), tokenizer=None).columns == ["w"]
    for terms in (("v", "c AS v"), ("upper(c) AS k",), ("v + 1 AS w", "v + 2 AS w")):
        refused(catalog, spec("base", *terms), match="new name")


def test_keyed_table_declaration(spark):
    df = spark.createDataFrame([], "k int, c int")
    with pytest.raises(JobError, match="twice"):
        KeyedTable.of(df, "k", rename={"c": "k"})
    for key, clustering in ([], "c"), ("x", ()), ("k", "x"), (["k", "k"], ()), ("k", "k"):
        with pytest.raises(JobError):
            KeyedTable.of(df, key, clustering)
    assert KeyedTable.of(df, "kk", rename={"k": "kk"}).df.columns == ["kk", "c"]


def test_builder_guards():
    new = QuerySpec.builder
    for bad in (
        lambda: new().keyspace("a").keyspace("b"),
        lambda: new().table("a").table("b"),
        lambda: new().where("WHERE a = 1").where("WHERE b = 1"),
        lambda: new().keyspace(None),
        lambda: new().table(None),
        lambda: new().where(None),
        lambda: new().where("WHERE "),
        lambda: new().columns(),
        lambda: new().columns_csv(None),
        lambda: new().table("t").build(),
        lambda: new().keyspace("k").build(),
        lambda: new().keyspace("k").table("t").columns("").build(),
    ):
        with pytest.raises(JobError):
            bad()


def test_builder_columns():
    build = QuerySpec.builder().keyspace("k").table("t")
    assert build.build().columns == ()
    assert build.columns_csv("*").build().columns == ()
    assert build.columns("A", "B").columns_csv("c, d").build().columns == ("A", "B", "c", "d")


def test_spec_is_a_value():
    built = (
        QuerySpec.builder().keyspace("k").table("t").columns("A", "B")
        .where("WHERE depth > ? AND label <> ?", 2.5, "shoal").build()
    )
    again = pickle.loads(pickle.dumps(built))
    assert again == built and hash(again) == hash(built)
    assert [type(a) for a in again.where.args] == [float, str]


def test_placeholders_outside_quotes_only():
    where = WhereClause("where a = '?' AND `b?` = ? AND c IN (?, ?) AND d BETWEEN ? AND ? AND f(?) = e", range(6))
    assert len(where.placeholders) == 6
    assert where.compared_columns() == ["b?", "c", "c", "d", "d", None]


@pytest.fixture(scope="module")
def typed(spark):
    columns = "k int, l long, s short, t string, b boolean, d double, f float, n decimal(10,2), x binary, ts timestamp, tn timestamp_ntz, dy date"
    when = dt.datetime(2024, 1, 2, 3, 4, 5, 600)
    row = (1, 2, 3, "a{b}'?", True, 0.1, 0.1, decimal.Decimal("1.50"), bytearray(b"\x00\xff"), when, when, when.date())
    other = (9, 9, 9, "z", False, 9.0, 9.0, decimal.Decimal(9), bytearray(b"z"), dt.datetime(1999, 1, 1), dt.datetime(1999, 1, 1), dt.date(1999, 1, 1))
    return Catalog(spark).add("a", "typed", KeyedTable.of(spark.createDataFrame([row, other], columns), "k")), dict(
        k=1, l=2, s=3, t="a{b}'?", b=True, d=0.1, f=0.1, n=decimal.Decimal("1.50"), x=b"\x00\xff", ts=when, tn=when, dy=when.date()
    )


def test_every_type_binds(typed):
    catalog, values = typed
    for column, value in values.items():
        where = WhereClause(f"WHERE {column} = ?", (value,))
        assert scan(catalog, spec("typed", "k", where=where), tokenizer=None).collect() == [(1,)], column
    both = WhereClause("f = ? AND t = 'a{b}\\'?' AND x = ? AND tn BETWEEN ? AND ?",
                       (0.1, bytearray(b"\x00\xff"), values["tn"], values["tn"]))
    assert scan(catalog, spec("typed", "k", where=both), tokenizer=None).collect() == [(1,)]


@pytest.mark.parametrize("column, value", [
    ("k", "1"), ("k", 1.0), ("k", True), ("k", 1 << 31), ("l", "12"), ("l", 1 << 63), ("s", 40_000), ("t", 1), ("b", 1),
    ("d", 1), ("f", 1), ("n", 1.5), ("x", "a"), ("ts", "2024-01-01"), ("dy", dt.datetime(2024, 1, 1)), ("t", None),
])
def test_arguments_are_not_coerced(typed, column, value):
    refused(typed[0], spec("typed", where=WhereClause(f"WHERE {column} = ?", (value,))), match="cannot bind")
    refused(typed[0], spec("typed", where=WhereClause(f"WHERE {column} IN (?)", (value,))), match="cannot bind")


@pytest.mark.parametrize("args", [(), (1,), (1, 2, 3)])
def test_argument_count(typed, args):
    refused(typed[0], spec("typed", where=WhereClause("WHERE k > ? AND l < ?", args)), match="2 placeholders")


def test_predicates_reach_the_scan(spark):
    from conftest import SF

    catalog = Catalog(spark).add_files(
        "s", "lines", f"{SF}/lineitem.parquet", partition_key="l_orderkey", clustering="l_linenumber"
    )
    where = WhereClause("WHERE l_shipdate >= ? AND l_quantity < ?", (dt.datetime(1996, 1, 1), 10.0))
    rows = scan(catalog, QuerySpec("s", "lines", ("l_tax",), where), tokenizer=None)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_quantity,10.0)" in plan
    assert "ReadSchema: struct<l_quantity:double,l_tax:double,l_shipdate:timestamp_ntz>" in plan


def test_group_filter_and_pruning_reach_the_scans(spark):
    from conftest import SF

    catalog = Catalog(spark)
    catalog.add_files("s", "o", f"{SF}/orders.parquet", partition_key="k", rename={"o_orderkey": "k"})
    catalog.add_files("s", "l", f"{SF}/lineitem.parquet", partition_key="k", rename={"l_orderkey": "k"})
    groups = MultiQuery(catalog).add(QuerySpec("s", "o"), QuerySpec("s", "l")).read()
    plan = groups.merged().where("k = 7")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(o_orderkey,7)") == 1 and plan.count("EqualTo(l_orderkey,7)") == 1
    plan = groups.merged()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    plan = groups.merged().select("k")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan and "ReadSchema: struct<l_orderkey:bigint>" in plan


@pytest.mark.parametrize("clause, right, wrong", [
    ("? = l", 1, "1"), ("L = ?", 1, "1"), ("(l) = ?", 1, "1"), ("l + 0 = ?", 1, "1"), ("l > -?", 1, "1"),
    ("l BETWEEN 1 AND ?", 1, "1"), ("l IN (abs(1), ?)", 1, "1"), ("t LIKE ?", "a%", 1), ("abs(?) < d", 0.5, 1),
    ("k = 1 OR d < ?", 0.5, 1), ("n IN (?, 2)", decimal.Decimal("1.50"), 1.5), ("coalesce(x, x'00') = ?", b"a", "a"),
    ("NOT b <> ?", True, 1), ("upper(t) = ?", "A", b"A"),
])
def test_every_placeholder_has_a_type(typed, clause, right, wrong):
    catalog, _ = typed
    assert scan(catalog, spec("typed", "k", where=WhereClause(clause, (right,))), tokenizer=None).columns == ["k"]
    refused(catalog, spec("typed", where=WhereClause(clause, (wrong,))), match="cannot bind")


def test_a_long_list_is_analysed_as_one_parameter(typed, monkeypatch):
    catalog, _ = typed
    analysed = []
    sql = type(catalog.spark).sql
    monkeypatch.setattr(type(catalog.spark), "sql", lambda self, *a, **k: analysed.append(a) or sql(self, *a, **k))
    marks = ", ".join("?" * 200)
    clause = f"abs(l) IN ({marks}) AND abs(l) IN(?,?) AND coalesce(?, ?) = l"
    found = scan(catalog, spec("typed", "k", where=WhereClause(clause, (*range(-198, 2), 1, 2, 2, 3))), tokenizer=None)
    assert found.columns == ["k"] and len(analysed) < 200
    wrong = WhereClause(f"abs(l) IN ({marks})", (*range(199), "x"))
    refused(catalog, spec("typed", where=wrong), match="parameter 200")


def test_parameters_of_other_forms_find_their_rows(typed):
    catalog, values = typed
    where = WhereClause("? = l AND f + 0 <= ? AND tn >= ? /* late */ AND (t LIKE ?) -- end", (2, 0.5, values["tn"], "a%"))
    assert scan(catalog, spec("typed", "k", where=where), tokenizer=None).collect() == [(1,)]


def test_a_zone_is_not_dropped(typed):
    aware = dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc)
    for clause in ("tn = ?", "? <= tn"):
        refused(typed[0], spec("typed", where=WhereClause(clause, (aware,))), match="cannot bind")


def test_collated_keys_are_refused(spark):
    table = KeyedTable.of(spark.createDataFrame([], "k string collate UTF8_LCASE, v int"), "k")
    refused(Catalog(spark).add("a", "folded", table), spec("folded"), match="cannot group")


def test_no_column_may_hide_the_token(spark):
    table = KeyedTable.of(spark.createDataFrame([(1, 2)], "k int, _token int"), "k")
    catalog = Catalog(spark).add("a", "t", table)
    with pytest.raises(JobError, match="token"):
        scan(catalog, spec("t"))
    assert scan(catalog, spec("t"), tokenizer=None).columns == ["k", "_token"]
