"""Queries over the driver's tables, each with the SQL that gives the same result."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from functools import reduce
from itertools import islice
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keygroup import (
    MD5_60,
    Backfill,
    Catalog,
    KeyedTable,
    MultiQuery,
    QuerySpec,
    SliceProfile,
    SlicedTable,
    TokenFiles,
    TokenRanges,
    balanced_ranges,
    declare_keys,
    heavy_keys,
    iterate_slices,
    order_key,
    read_slice,
    scan,
    slice_profile,
)
from keygroup.operators.slices import with_token
from keygroup.workspace import new_path

# The subpackage llm and the pipeline built on it may be absent.
try:
    import corpus_pipeline
    from keygroup.llm import registry as llm
except ImportError:
    llm = None

SLICES = 16

# Page sizes of the queries whose groups span several pages even in small data.
HOT_PAGE_ROWS = 5_000
CARRY_PAGE_ROWS = 3
TEXT_PAGE_ROWS, TEXT_PAGE_BYTES = 500, 1_000_000

# Ranges of tokens with odd ends, a wide one, a narrow one and one of a single token among them.
TOKEN_CUTS = [(10**17 + 7, 4 * 10**17), (4 * 10**17 + 1, 4 * 10**17 + 10**13), (0, 123_456_789_012_345_678), (5, 5)]
BYTE_SLICES = 4
# Enough to sample every key of a slice, so that the figures are exact.
SAMPLED_KEYS = 1_000_000
# Sum of line numbers above which a supplier is heavy.
HEAVY_ROWS = 2_400

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]


def tables(spark: SparkSession, sf_dir: str) -> Catalog:
    """The driver's tables with their keys; renames align the key names."""
    catalog = Catalog(spark)

    def add(keyspace, name, file, key, clustering=(), unique=False, **rename):
        path = f"{sf_dir}/{file}.parquet"
        keys = dict(partition_key=key, clustering=clustering, unique=unique, rename=rename)
        catalog.add_files(keyspace, name, path, **keys)

    add("chat", "conversations", "conversations", "conv_id", "turn", True)
    add("web", "events", "events", "user_id", ["event_type", "ts", "event_id"], True)
    add("docs", "documents", "documents", "doc_id", (), True)
    add("docs", "labels", "labels", "doc_id", (), True)
    add("docs", "by_language", "documents", "lang", "doc_id", True)
    add("sales", "orders", "orders", "orderkey", "status", True, o_orderkey="orderkey", o_orderstatus="status")
    add("sales", "orders_by_key", "orders", "orderkey", (), True, o_orderkey="orderkey")
    add("sales", "lines", "lineitem", "orderkey", ["status", *LINE_ORDER], l_orderkey="orderkey", l_linestatus="status")
    add("sales", "lines_by_supplier", "lineitem", ["orderkey", "suppkey"], l_orderkey="orderkey", l_suppkey="suppkey")
    add("sales", "lines_by_status", "lineitem", "l_linestatus", ["l_orderkey", *LINE_ORDER])
    add("geo", "nations", "nation", "nationkey", (), True, n_nationkey="nationkey")
    add("geo", "customers", "customer", "nationkey", "c_custkey", True, c_nationkey="nationkey")
    add("geo", "suppliers", "supplier", "nationkey", "s_suppkey", True, s_nationkey="nationkey")
    add("geo", "suppliers_by_key", "supplier", "s_suppkey", (), True)
    return catalog


def job(catalog: Catalog, *specs: QuerySpec) -> MultiQuery:
    return MultiQuery(catalog).add(*specs)


def orders_and_lines(catalog: Catalog, orders: str = "*", lines: str = "*") -> MultiQuery:
    """Orders and their lines under one key, with the columns named as comma-separated text."""
    return job(
        catalog,
        QuerySpec.builder().keyspace("sales").table("orders").columns_csv(orders).build(),
        QuerySpec.builder().keyspace("sales").table("lines").columns_csv(lines).build(),
    )


def rows_of(q: int):
    """Number of rows of query ``q`` in a group."""
    return F.size(F.filter("rows", lambda r: r["_q"] == q)).cast("bigint"), F.sum


def n_rows():
    return F.size("rows").cast("bigint"), F.sum


# -- reading one table ------------------------------------------------------------


def q_scan_star(spark, sf_dir):
    return scan(tables(spark, sf_dir), QuerySpec("geo", "suppliers"), tokenizer=None)


def q_project_dedup(spark, sf_dir):
    spec = (
        QuerySpec.builder()
        .keyspace("sales")
        .table("lines")
        .columns("l_partkey", "status", "l_quantity")
        .columns_csv("l_partkey,l_linenumber")
        .build()
    )
    return scan(tables(spark, sf_dir), spec, group_by=["status"], tokenizer=None)


def q_where_raw(spark, sf_dir):
    clause = "WHERE status = 'F' AND o_totalprice >= 1000.0 AND o_totalprice <= 250000.0"
    spec = QuerySpec.builder().keyspace("sales").table("orders").columns("orderkey", "status", "o_totalprice")
    return scan(tables(spark, sf_dir), spec.where(clause).build(), tokenizer=None)


def q_where_bound(spark, sf_dir):
    clause = "WHERE status = ? AND o_totalprice BETWEEN ? AND ? AND o_custkey > ?"
    spec = QuerySpec.builder().keyspace("sales").table("orders").columns("orderkey", "o_custkey", "o_totalprice")
    return scan(tables(spark, sf_dir), spec.where(clause, "O", 20000.0, 300000.0, 10).build(), tokenizer=None)


def q_where_binary(spark, sf_dir):
    """Types of events, as bytes, against a binary parameter."""
    events = table_of_codes(spark, sf_dir)
    spec = QuerySpec.builder().keyspace("web").table("codes").columns("user_id", "event_id")
    return scan(events, spec.where("WHERE code = ?", b"click").build(), tokenizer=None)


def table_of_codes(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    coded = events.select("user_id", "event_id", F.encode("event_type", "utf-8").alias("code"))
    return Catalog(spark).add("web", "codes", KeyedTable.of(coded, "user_id", "event_id", unique=True))


# -- groups of one table ----------------------------------------------------------


def q_group_pk(spark, sf_dir):
    groups = job(tables(spark, sf_dir), QuerySpec("chat", "conversations", ("turn", "role"))).read()
    return groups.fold(
        n_turns=n_rows(),
        first_role=(F.element_at("rows", 1)["s0"]["role"], lambda c: F.min_by(c, "_page")),
        last_role=(F.element_at("rows", -1)["s0"]["role"], lambda c: F.max_by(c, "_page")),
    )


def q_group_composite_pk(spark, sf_dir):
    groups = job(tables(spark, sf_dir), QuerySpec("sales", "lines_by_supplier", ("l_partkey",))).read()
    partkeys = F.aggregate("rows", F.lit(0).cast("bigint"), lambda total, r: total + r["s0"]["l_partkey"])
    return groups.fold(n_rows=n_rows(), sum_partkey=(partkeys, F.sum))


def q_group_pk_clustering(spark, sf_dir):
    events = QuerySpec("web", "events", ("event_id",))
    groups = job(tables(spark, sf_dir), events).group_by("event_type").read()
    return groups.fold(
        n_rows=n_rows(),
        first_event=(F.element_at("rows", 1)["s0"]["event_id"], lambda c: F.min_by(c, "_page")),
        last_event=(F.element_at("rows", -1)["s0"]["event_id"], lambda c: F.max_by(c, "_page")),
    )


# -- groups over several tables ---------------------------------------------------


def q_merge_two(spark, sf_dir):
    """Rows per order and table, from the full rows of both."""
    groups = orders_and_lines(tables(spark, sf_dir)).read()
    return groups.fold(n_rows=n_rows(), n_orders=rows_of(0), n_lines=rows_of(1))


def q_merge_three(spark, sf_dir):
    columns = {"nations": "n_name", "customers": "c_custkey", "suppliers": "s_suppkey"}
    specs = [QuerySpec("geo", table, (column,)) for table, column in columns.items()]
    return job(tables(spark, sf_dir), *specs).read().fold(
        n_rows=n_rows(), n_nations=rows_of(0), n_customers=rows_of(1), n_suppliers=rows_of(2)
    )


def q_merge_filtered(spark, sf_dir):
    errors = QuerySpec.builder().keyspace("web").table("events").columns("ts").where("WHERE event_type = ?", "error")
    large = QuerySpec.builder().keyspace("web").table("events").columns("value").where("WHERE value > ?", 100.0)
    groups = job(tables(spark, sf_dir), errors.build(), large.build()).read()
    return groups.fold(n_rows=n_rows(), n_errors=rows_of(0), n_large=rows_of(1))


def q_merge_two_clustering(spark, sf_dir):
    groups = orders_and_lines(tables(spark, sf_dir), "o_custkey", "l_partkey").group_by("status").read()
    return groups.fold(n_rows=n_rows(), n_orders=rows_of(0), n_lines=rows_of(1))


def q_cogroup_arrays(spark, sf_dir):
    documents = QuerySpec("docs", "documents", ("lang", "n_chars"))
    groups = job(tables(spark, sf_dir), documents, QuerySpec("docs", "labels")).read()
    return groups.fold(
        cogrouped=True,
        n_documents=(F.size("s0").cast("bigint"), F.sum),
        n_labels=(F.size("s1").cast("bigint"), F.sum),
        n_chars=(F.aggregate("s0", F.lit(0).cast("bigint"), lambda total, d: total + d["n_chars"]), F.sum),
        n_toxic=(F.size(F.filter("s1", lambda x: x["toxic"] == 1)).cast("bigint"), F.sum),
    )


def q_merge_contents(spark, sf_dir):
    """Every value of every list, by its place."""
    groups = orders_and_lines(tables(spark, sf_dir), "o_custkey,o_totalprice", "l_linenumber,l_partkey,l_suppkey").read()
    rows = groups.merged().select("orderkey", F.posexplode("rows").alias("pos", "row"))
    return rows.select(
        "orderkey",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("row._q").cast("bigint").alias("q"),
        "row.s0.o_custkey",
        "row.s0.o_totalprice",
        "row.s1.l_linenumber",
        "row.s1.l_partkey",
        "row.s1.l_suppkey",
    )


def q_cogroup_contents(spark, sf_dir):
    """The lists of lines beside their orders, by place."""
    groups = orders_and_lines(tables(spark, sf_dir), "o_custkey", "l_linenumber,l_partkey,l_suppkey").read()
    lists = groups.cogrouped()
    lines = lists.select("orderkey", F.size("s0").cast("bigint").alias("n_orders"), F.posexplode("s1").alias("pos", "line"))
    return lines.select("orderkey", "n_orders", F.col("pos").cast("bigint").alias("pos"), "line.l_linenumber", "line.l_partkey", "line.l_suppkey")


def q_cogroup_carry(spark, sf_dir):
    """Lines that cost a third of their order, in groups of several pages."""
    catalog = tables(spark, sf_dir)
    orders = QuerySpec("sales", "orders_by_key", ("o_totalprice",))
    lines = QuerySpec("sales", "lines", ("l_extendedprice",))
    total = F.get("s0", 0)["o_totalprice"]
    dear = F.filter("s1", lambda line: line["l_extendedprice"] * 3 > total)
    return job(catalog, orders, lines).read(CARRY_PAGE_ROWS).fold(
        cogrouped=True,
        carry=[orders],
        n_lines=(F.size("s1").cast("bigint"), F.sum),
        n_dear=(F.size(dear).cast("bigint"), F.sum),
        total=(total, F.max),
    )


def q_key_presence(spark, sf_dir):
    present = orders_and_lines(tables(spark, sf_dir)).read().presence()
    return present.where("NOT (in_s0 AND in_s1)")


def q_rows_flat(spark, sf_dir):
    groups = orders_and_lines(tables(spark, sf_dir), "o_custkey", "l_linenumber,l_partkey,l_suppkey").read()
    return groups.flat().select(
        "orderkey",
        F.col("_pos").alias("pos"),
        F.col("_q").cast("bigint").alias("q"),
        F.col("s0.o_custkey"),
        F.col("s1.l_linenumber"),
        F.col("s1.l_partkey"),
        F.col("s1.l_suppkey"),
    )


# -- groups that span several pages -----------------------------------------------


def q_rows_flat_hot(spark, sf_dir):
    lines = QuerySpec("sales", "lines_by_status", ("l_orderkey", "l_linenumber", "l_partkey"))
    rows = job(tables(spark, sf_dir), lines).read(HOT_PAGE_ROWS).flat()
    return rows.select(
        "l_linestatus", F.col("_pos").alias("pos"), "s0.l_orderkey", "s0.l_linenumber", "s0.l_partkey"
    )


def q_fold_hot(spark, sf_dir):
    """One row per status from many pages."""
    lines = QuerySpec("sales", "lines_by_status", ("l_orderkey", "l_suppkey", "l_linenumber"))
    value = lambda name: F.transform("rows", lambda r: r["s0"][name])
    suppliers = F.aggregate(value("l_suppkey"), F.lit(0).cast("bigint"), lambda total, x: total + x)
    return job(tables(spark, sf_dir), lines).read(HOT_PAGE_ROWS).fold(
        n_rows=n_rows(),
        n_pages=(F.col("_page"), F.count),
        sum_suppkey=(suppliers, F.sum),
        max_linenumber=(F.array_max(value("l_linenumber")), F.max),
        first_orderkey=(F.element_at("rows", 1)["s0"]["l_orderkey"], lambda c: F.min_by(c, "_page")),
        last_orderkey=(F.element_at("rows", -1)["s0"]["l_orderkey"], lambda c: F.max_by(c, "_page")),
    )


def q_pages_hot(spark, sf_dir):
    lines = QuerySpec("sales", "lines_by_status", ("l_orderkey", "l_suppkey"))
    pages = job(tables(spark, sf_dir), lines).read(HOT_PAGE_ROWS).merged()
    suppliers = F.aggregate("rows", F.lit(0).cast("bigint"), lambda total, r: total + r["s0"]["l_suppkey"])
    return pages.select(
        "l_linestatus",
        F.col("_page").alias("page"),
        F.size("rows").cast("bigint").alias("n_rows"),
        F.element_at("rows", 1)["s0"]["l_orderkey"].alias("first_orderkey"),
        F.element_at("rows", -1)["s0"]["l_orderkey"].alias("last_orderkey"),
        suppliers.alias("sum_suppkey"),
    )


def q_pages_bytes(spark, sf_dir):
    """Texts by language, in pages bounded by rows and by bytes."""
    texts = job(tables(spark, sf_dir), QuerySpec("docs", "by_language", ("doc_id", "text")))
    pages = texts.read(TEXT_PAGE_ROWS, TEXT_PAGE_BYTES).merged()
    size = F.aggregate(
        "rows", F.lit(0).cast("bigint"), lambda total, r: total + F.octet_length(r["s0"]["text"]).cast("bigint")
    )
    return pages.select(
        "lang",
        F.col("_page").alias("page"),
        F.size("rows").cast("bigint").alias("n_rows"),
        size.alias("n_bytes"),
        F.element_at("rows", 1)["s0"]["doc_id"].alias("first_doc"),
        F.element_at("rows", -1)["s0"]["doc_id"].alias("last_doc"),
    )


def q_heavy_keys(spark, sf_dir):
    """Suppliers with many lines: candidates from bounded summaries, counted exactly."""
    lines = KeyedTable.of(tables(spark, sf_dir).lookup("sales", "lines").df, "l_suppkey")
    return heavy_keys(lines, HEAVY_ROWS, F.col("l_linenumber")).select("l_suppkey", "n_rows", "weight")


# -- ordered and partitioned delivery ---------------------------------------------


def _partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def q_sorted_slices(spark, sf_dir):
    """Rows per coarse slice, and rows that come before their predecessor's token."""
    groups = orders_and_lines(tables(spark, sf_dir), "o_custkey", "l_partkey").read()
    rows = groups.sorted_slices(_partitions(spark), MD5_60)
    placed = rows.select(
        "_token",
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("at"),
    )
    previous = F.expr("lag(_token) OVER (PARTITION BY part ORDER BY at)")
    checked = placed.withColumn("late", F.coalesce(F.col("_token") < previous, F.lit(False)))
    return checked.groupBy(MD5_60.slice_of("_token", SLICES).alias("slice")).agg(
        F.count("*").alias("n_rows"),
        F.count_if("late").alias("n_late"),
        F.min("_token").alias("min_token"),
        F.max("_token").alias("max_token"),
    )


def q_key_order(spark, sf_dir):
    """Places of events in the order of a key of four types, by one term."""
    events = tables(spark, sf_dir).lookup("web", "events").df
    key = order_key(["event_type", "value", "ts", "event_id"], events.schema)
    place = F.row_number().over(Window.partitionBy("user_id").orderBy(key))
    return events.select("event_id", place.cast("bigint").alias("place"))


def q_declared_keys(spark, sf_dir):
    """A stored table whose keys another session finds in the catalog."""
    name = f"keyed_{uuid.uuid4().hex}"
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_type", "event_id")
    events.write.option("path", new_path(spark, "declared")).saveAsTable(name)
    try:
        declare_keys(spark, name, "user_id", ["event_type", "event_id"], unique=True)
        other = spark.newSession()
        groups = job(Catalog(other).add_table("web", "events", name), QuerySpec("web", "events")).group_by("event_type")
        done = groups.read().fold(n_rows=n_rows()).groupBy("event_type").agg(
            F.count("*").alias("n_groups"), F.sum("n_rows").alias("n_rows")
        ).collect()
    finally:
        spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(done, "event_type string, n_groups bigint, n_rows bigint")


def q_group_integrity(spark, sf_dir):
    """Groups, rows, and groups whose rows lie in more than one partition."""
    groups = orders_and_lines(tables(spark, sf_dir), "o_custkey", "l_partkey").read()
    rows = groups.partitioned(_partitions(spark))
    # The partition is read off the delivered rows, before they move again.
    placed = rows.select("orderkey", "_page", F.spark_partition_id().alias("part"))
    groups = placed.groupBy("orderkey", "_page").agg(
        F.count("*").alias("n"), (F.min("part") < F.max("part")).alias("split")
    )
    return groups.agg(
        F.count("*").alias("n_groups"),
        F.sum("n").alias("n_rows"),
        F.count_if("split").alias("n_split"),
    )


# -- tokens and slices ------------------------------------------------------------


def q_token(spark, sf_dir):
    rows = scan(tables(spark, sf_dir), QuerySpec("sales", "orders", ("o_custkey",)), tokenizer=MD5_60)
    return rows.withColumnRenamed("_token", "token")


def q_token_slice(spark, sf_dir):
    low, high = MD5_60.bounds(SLICES)[3]
    spec = QuerySpec("sales", "orders", ("o_custkey", "o_totalprice"))
    rows = scan(tables(spark, sf_dir), spec, tokenizer=MD5_60, token_range=(low, high))
    return rows.withColumnRenamed("_token", "token")


def q_token_composite(spark, sf_dir):
    spec = QuerySpec("sales", "lines_by_supplier", ("l_partkey", "l_linenumber"))
    rows = scan(tables(spark, sf_dir), spec, tokenizer=MD5_60)
    return rows.withColumnRenamed("_token", "token")


def q_slice_cover(spark, sf_dir):
    rows = with_token(tables(spark, sf_dir).lookup("sales", "lines"), MD5_60)
    return rows.groupBy(MD5_60.slice_of("_token", SLICES).alias("slice")).agg(F.count("*").alias("n_rows"))


def q_slice_boundaries(spark, sf_dir):
    """Lines per token range, with the suppliers' own tokens as boundaries."""
    catalog = tables(spark, sf_dir)
    boundaries = with_token(catalog.lookup("geo", "suppliers_by_key"), MD5_60).select("_token")
    return TokenRanges(boundaries, MD5_60).profile(catalog.lookup("sales", "lines"))


def q_slice_assign(spark, sf_dir):
    """Range of every order, with the suppliers' own tokens as boundaries."""
    catalog = tables(spark, sf_dir)
    boundaries = with_token(catalog.lookup("geo", "suppliers_by_key"), MD5_60).select("_token")
    orders = with_token(catalog.lookup("sales", "orders"), MD5_60).select("orderkey", "_token")
    return TokenRanges(boundaries, MD5_60).assign(orders).select("orderkey", "slice")


def q_slice_profile(spark, sf_dir):
    return slice_profile(tables(spark, sf_dir).lookup("sales", "lines"), SLICES, MD5_60)


def q_slice_profile_sums(spark, sf_dir):
    """Rows, keys and the median group of every slice, added up from summaries of two halves of the lines."""
    lines = tables(spark, sf_dir).lookup("sales", "lines")
    halves = (
        SliceProfile.of(KeyedTable.of(lines.df.where(half), "orderkey"), SLICES, MD5_60, SAMPLED_KEYS)
        for half in ("l_linenumber % 2 = 0", "l_linenumber % 2 = 1")
    )
    return next(halves).merge(*halves).report().select("slice", "n_rows", "n_keys", "size_50")


def q_slice_backfill(spark, sf_dir):
    """One aggregate per slice, each reading the files of its slice only."""
    lines = KeyedTable.of(tables(spark, sf_dir).lookup("sales", "lines").df.select("orderkey", "l_partkey"), "orderkey")
    sliced = SlicedTable.write(lines, new_path(spark, "backfill"), SLICES, MD5_60)
    try:
        # A row per slice comes back, so that the copy of the table can go.
        done = [row for index, part in sliced for row in _sums(part.df, index).collect()]
    finally:
        sliced.delete()
    return spark.createDataFrame(done, "slice int, n_rows bigint, sum_orderkey bigint, sum_partkey bigint")


def _sums(lines, index):
    return lines.agg(
        F.lit(index).alias("slice"),
        F.count("*").alias("n_rows"),
        F.sum("orderkey").alias("sum_orderkey"),
        F.sum("l_partkey").alias("sum_partkey"),
    )


def q_slice_resume(spark, sf_dir):
    """The same aggregates from a run that stopped after some slices and was opened again."""
    lines = KeyedTable.of(tables(spark, sf_dir).lookup("sales", "lines").df.select("orderkey", "l_partkey"), "orderkey")
    slices = MD5_60.bounds(SLICES)
    schema = "slice int, n_rows bigint, sum_orderkey bigint, sum_partkey bigint"
    path, files = new_path(spark, "resume"), new_path(spark, "resume-lines")
    # The lines are laid out once, for both runs, so that a slice reads its own files.
    sliced = SlicedTable.write(lines, files, SLICES, MD5_60)

    def work(index, low, high):
        part = SlicedTable.open(spark, files).read(index, index)
        return _sums(read_slice(part, low, high, MD5_60).drop("_token"), index)

    try:
        run = Backfill.start(spark, path, slices, schema)
        run.run(work, most=SLICES // 2 - 1)
        again = Backfill.open(spark, path)
        again.run(work)
        done = again.read().drop("_slice").collect()
        again.clear()
    finally:
        sliced.delete()
    return spark.createDataFrame(done, schema)


def q_slice_iterate(spark, sf_dir):
    """One aggregate per slice, each of them a scan of the table."""
    lines = tables(spark, sf_dir).lookup("sales", "lines")
    parts = enumerate(iterate_slices(lines, MD5_60.bounds(SLICES), MD5_60))
    return reduce(DataFrame.unionByName, [_sums(part, index) for index, (_, part) in parts])


def q_token_ranges(spark, sf_dir):
    """One aggregate per range of tokens that no layout foresaw, each reading the files of its range only."""
    lines = KeyedTable.of(tables(spark, sf_dir).lookup("sales", "lines").df.select("orderkey", "l_partkey"), "orderkey")
    files = TokenFiles.write(lines, new_path(spark, "token-files"), MD5_60, rows_per_file=20_000)
    try:
        done = [row for i, (_, part) in enumerate(files.iterate(TOKEN_CUTS)) for row in _sums(part.df, i).collect()]
    finally:
        files.delete()
    return spark.createDataFrame(done, "slice int, n_rows bigint, sum_orderkey bigint, sum_partkey bigint")


def q_slice_balanced(spark, sf_dir):
    """Rows and keys of slices that weigh the same."""
    lines = tables(spark, sf_dir).lookup("sales", "lines")
    return balanced_ranges(lines, SLICES, tokenizer=MD5_60).profile(lines)


def q_slice_balanced_bytes(spark, sf_dir):
    """Tokens at the ends of slices with the same bytes of text, and what they hold."""
    texts = tables(spark, sf_dir).lookup("docs", "documents")
    texts = KeyedTable.of(texts.df, "doc_id")
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    ranges = balanced_ranges(texts, BYTE_SLICES, size, 1.0, tokenizer=MD5_60)
    return (
        ranges.assign(with_token(texts, MD5_60)).groupBy("slice")
        .agg(F.sum(size.cast("bigint")).alias("n_bytes"), F.count("*").alias("n_rows"))
    )


# -- user functions ---------------------------------------------------------------


def q_group_hof(spark, sf_dir):
    groups = orders_and_lines(tables(spark, sf_dir), "o_custkey", "l_linenumber,l_partkey,l_returnflag").read()
    lines = F.filter("rows", lambda r: r["_q"] == 1)
    returned = F.filter(lines, lambda r: r["s1"]["l_returnflag"] == "R")
    partkeys = F.aggregate(lines, F.lit(0).cast("bigint"), lambda total, r: total + r["s1"]["l_partkey"])
    highest = F.array_max(F.transform(lines, lambda r: r["s1"]["l_linenumber"]))
    return groups.fold(
        n_lines=(F.size(lines).cast("bigint"), F.sum),
        n_returned=(F.size(returned).cast("bigint"), F.sum),
        sum_partkey=(partkeys, F.sum),
        max_linenumber=(highest, F.max),
    )


def q_group_apply(spark, sf_dir):
    """Turns, characters and changes of speaker per conversation, in Python."""

    def per_page(pdf):
        roles = pdf["s0_role"]
        return pd.DataFrame({
            "conv_id": pdf["conv_id"].iloc[:1],
            "n_turns": len(pdf),
            "n_chars": pdf["s0_text"].str.len().sum(),
            "n_changes": (roles != roles.shift()).iloc[1:].sum(),
            "first_role": roles.iloc[0],
            "last_role": roles.iloc[-1],
        })

    def merge(pdf):
        borders = (pdf["first_role"] != pdf["last_role"].shift()).iloc[1:].sum()
        return pd.DataFrame({
            "conv_id": pdf["conv_id"].iloc[:1],
            "n_turns": pdf["n_turns"].sum(),
            "n_chars": pdf["n_chars"].sum(),
            "n_changes": pdf["n_changes"].sum() + borders,
            "first_role": pdf["first_role"].iloc[0],
            "last_role": pdf["last_role"].iloc[-1],
        })

    groups = job(tables(spark, sf_dir), QuerySpec("chat", "conversations")).read()
    schema = "conv_id bigint, n_turns bigint, n_chars bigint, n_changes bigint, first_role string, last_role string"
    return groups.apply_groups(per_page, merge, schema)


def q_cogroup_apply(spark, sf_dir):
    """Every order's lines that cost a third of it, by a function that sees orders and lines apart."""

    def dear_lines(key, orders, lines):
        total = max((t for batch in orders for t in batch.column("o_totalprice").to_pylist()), default=None)
        n_lines = n_dear = 0
        for batch in lines:
            n_lines += batch.num_rows
            if total is not None:
                n_dear += int((batch.column("l_extendedprice").to_numpy() * 3 > total).sum())
        yield {"orderkey": [key[0]], "n_lines": [n_lines], "n_dear": [n_dear], "total": [total]}

    groups = orders_and_lines(tables(spark, sf_dir), "o_totalprice", "l_extendedprice").read()
    return groups.apply_sides(dear_lines, "orderkey bigint, n_lines bigint, n_dear bigint, total double")


def q_cogroup_apply_hot(spark, sf_dir):
    """Nations' customers held against the best supplier of the nation: few keys, streamed groups."""

    def richer(key, suppliers, customers):
        best = max((b for batch in suppliers for b in batch.column("s_acctbal").to_pylist()), default=None)
        for batch in customers:
            balance = batch.column("c_acctbal").to_numpy()
            found = balance > best if best is not None else balance == balance
            ids = batch.column("c_custkey").filter(pa.array(found))
            yield {"nationkey": [key[0]] * len(ids), "c_custkey": ids}

    suppliers, customers = QuerySpec("geo", "suppliers", ("s_acctbal",)), QuerySpec("geo", "customers", ("c_acctbal", "c_custkey"))
    groups = job(tables(spark, sf_dir), suppliers, customers).read()
    return groups.apply_sides(richer, "nationkey int, c_custkey bigint", batch_rows=1_000)


def q_group_cursor(spark, sf_dir):
    """Conversations met by a cursor, which is dropped on the way and goes on from its last position."""
    groups = job(tables(spark, sf_dir), QuerySpec("chat", "conversations", ("turn", "role"))).read(CARRY_PAGE_ROWS)
    met, position, order = [], None, 0
    with groups:
        cursor = groups.cursor(prefetch_rows=2_000)
        for stop in (5, None):
            for page in islice(cursor.pages(after=position), stop):
                position = page.position
                roles = [row["s0"]["role"] for row in page.rows]
                met.append((page.key["conv_id"], page.number, len(roles), roles[0], roles[-1], order))
                order += 1
    found = spark.createDataFrame(met, "conv_id bigint, page bigint, n int, first string, last string, at int")
    return found.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.min_by("first", "page").alias("first_role"),
        F.max_by("last", "page").alias("last_role"),
        # The pages of a group follow each other.
        (F.max("at") - F.min("at") + 1 == F.count("*")).alias("together"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by name."""
    own = {name: f for name, f in globals().items() if name.startswith("q_")}
    return own | (llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {})


def entry(spark: SparkSession) -> DataFrame:
    """Orders and their lines, grouped by order without a join."""
    return q_merge_two(spark, "/root/testdata/sf0.001")


# -- the same results in SQL ------------------------------------------------------


def _token_sql(key: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 15) AS BIGINT)"


def _slice_sql(token: str) -> str:
    return f"CAST((CAST({token} AS HUGEINT) * {SLICES}) // 1152921504606846976 AS INTEGER)"


_ORDERS_AND_LINES = """
    SELECT o_orderkey AS orderkey, o_orderstatus AS status, 0 AS q, o_custkey,
           o_totalprice, NULL::INTEGER AS l_linenumber, NULL::BIGINT AS l_partkey, NULL::BIGINT AS l_suppkey,
           NULL::TIMESTAMP AS l_shipdate, NULL::DOUBLE AS l_quantity, NULL::DOUBLE AS l_extendedprice
    FROM orders
    UNION ALL
    SELECT l_orderkey, l_linestatus, 1, NULL, NULL, l_linenumber, l_partkey, l_suppkey,
           l_shipdate, l_quantity, l_extendedprice
    FROM lineitem
"""

_LINE_ORDER = ", ".join(f"{c} NULLS FIRST" for c in LINE_ORDER)

_RANGES = f"""
    bounds AS (
        SELECT {_token_sql('s_suppkey')} AS hi FROM supplier
        UNION SELECT 1152921504606846975
    ),
    ranges AS (
        SELECT row_number() OVER (ORDER BY hi) - 1 AS slice,
               coalesce(lag(hi) OVER (ORDER BY hi) + 1, 0) AS lo, hi
        FROM bounds
    )
"""


def _balanced_sql(rows: str, n: int, bits: int) -> str:
    """Stretches of the token space with the slice in which their middle falls by weight."""
    return f"""
            WITH stretches AS (
                SELECT token >> {60 - bits} AS stretch, CAST(sum(w) AS BIGINT) AS w, count(*) AS n, count(DISTINCT k) AS keys
                FROM ({rows}) GROUP BY stretch),
            running AS (SELECT *, sum(w) OVER (ORDER BY stretch) AS upto, sum(w) OVER () AS total FROM stretches),
            placed AS (SELECT *, least({n - 1}, (2 * upto - w) * {n} // (2 * total)) AS place FROM running)"""


def oracle_sql() -> dict[str, str]:
    """The result of every query that SQL can express, as SQL over the same tables."""
    return _own_sql() | (llm.oracle_sql() if llm else {})


def _own_sql() -> dict[str, str]:
    low, high = MD5_60.bounds(SLICES)[3]
    order_token, line_token = _token_sql("o_orderkey"), _token_sql("l_orderkey")
    return {
        "q_scan_star": """
            SELECT s_suppkey, s_name, s_nationkey AS nationkey, s_acctbal FROM supplier""",
        "q_project_dedup": """
            SELECT l_linestatus AS status, l_partkey, l_quantity, l_linenumber FROM lineitem""",
        "q_where_raw": """
            SELECT o_orderkey AS orderkey, o_orderstatus AS status, o_totalprice FROM orders
            WHERE o_orderstatus = 'F' AND o_totalprice >= 1000.0 AND o_totalprice <= 250000.0""",
        "q_where_bound": """
            SELECT o_orderkey AS orderkey, o_custkey, o_totalprice FROM orders
            WHERE o_orderstatus = 'O' AND o_totalprice BETWEEN 20000.0 AND 300000.0 AND o_custkey > 10""",
        "q_where_binary": """
            SELECT user_id, event_id FROM events WHERE event_type = 'click'""",
        "q_merge_contents": f"""
            SELECT orderkey,
                   row_number() OVER (
                       PARTITION BY orderkey ORDER BY q, status NULLS FIRST, {_LINE_ORDER}) - 1 AS pos,
                   CAST(q AS BIGINT) AS q, o_custkey, o_totalprice, l_linenumber, l_partkey, l_suppkey
            FROM ({_ORDERS_AND_LINES})""",
        "q_cogroup_contents": f"""
            SELECT orderkey, n_orders, pos, l_linenumber, l_partkey, l_suppkey
            FROM (SELECT *, count(*) FILTER (q = 0) OVER (PARTITION BY orderkey) AS n_orders,
                         row_number() OVER (
                             PARTITION BY orderkey, q ORDER BY status NULLS FIRST, {_LINE_ORDER}) - 1 AS pos
                  FROM ({_ORDERS_AND_LINES}))
            WHERE q = 1""",
        "q_cogroup_carry": """
            SELECT orderkey, count(l_orderkey) AS n_lines,
                   count(*) FILTER (l_extendedprice * 3 > o_totalprice) AS n_dear, max(o_totalprice) AS total
            FROM (SELECT coalesce(o_orderkey, l_orderkey) AS orderkey, l_orderkey, l_extendedprice, o_totalprice
                  FROM orders FULL JOIN lineitem ON o_orderkey = l_orderkey)
            GROUP BY orderkey""",
        "q_fold_hot": f"""
            SELECT l_linestatus, count(*) AS n_rows, CAST(ceil(count(*) / {HOT_PAGE_ROWS}) AS BIGINT) AS n_pages,
                   CAST(sum(l_suppkey) AS BIGINT) AS sum_suppkey, max(l_linenumber) AS max_linenumber,
                   min(l_orderkey) AS first_orderkey, max(l_orderkey) AS last_orderkey
            FROM lineitem GROUP BY l_linestatus""",
        "q_group_pk": """
            SELECT conv_id, count(*) AS n_turns, arg_min(role, turn) AS first_role, arg_max(role, turn) AS last_role
            FROM conversations GROUP BY conv_id""",
        "q_group_composite_pk": """
            SELECT l_orderkey AS orderkey, l_suppkey AS suppkey, count(*) AS n_rows,
                   CAST(sum(l_partkey) AS BIGINT) AS sum_partkey
            FROM lineitem GROUP BY l_orderkey, l_suppkey""",
        "q_group_pk_clustering": """
            SELECT user_id, event_type, count(*) AS n_rows,
                   arg_min(event_id, (ts, event_id)) AS first_event, arg_max(event_id, (ts, event_id)) AS last_event
            FROM events GROUP BY user_id, event_type""",
        "q_merge_two": f"""
            SELECT orderkey, count(*) AS n_rows, count(*) FILTER (q = 0) AS n_orders,
                   count(*) FILTER (q = 1) AS n_lines
            FROM ({_ORDERS_AND_LINES}) GROUP BY orderkey""",
        "q_merge_three": """
            SELECT nationkey, count(*) AS n_rows, count(*) FILTER (q = 0) AS n_nations,
                   count(*) FILTER (q = 1) AS n_customers, count(*) FILTER (q = 2) AS n_suppliers
            FROM (SELECT n_nationkey AS nationkey, 0 AS q FROM nation
                  UNION ALL SELECT c_nationkey, 1 FROM customer
                  UNION ALL SELECT s_nationkey, 2 FROM supplier)
            GROUP BY nationkey""",
        "q_merge_filtered": """
            SELECT user_id, count(*) AS n_rows, count(*) FILTER (q = 0) AS n_errors,
                   count(*) FILTER (q = 1) AS n_large
            FROM (SELECT user_id, 0 AS q FROM events WHERE event_type = 'error'
                  UNION ALL SELECT user_id, 1 FROM events WHERE value > 100)
            GROUP BY user_id""",
        "q_merge_two_clustering": f"""
            SELECT orderkey, status, count(*) AS n_rows, count(*) FILTER (q = 0) AS n_orders,
                   count(*) FILTER (q = 1) AS n_lines
            FROM ({_ORDERS_AND_LINES}) GROUP BY orderkey, status""",
        "q_cogroup_arrays": """
            SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, coalesce(d.n, 0) AS n_documents,
                   coalesce(l.n, 0) AS n_labels, coalesce(d.n_chars, 0) AS n_chars, coalesce(l.n_toxic, 0) AS n_toxic
            FROM (SELECT doc_id, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars
                  FROM documents GROUP BY doc_id) d
            FULL JOIN (SELECT doc_id, count(*) AS n, count(*) FILTER (toxic = 1) AS n_toxic
                       FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id""",
        "q_key_presence": """
            SELECT coalesce(o.k, l.k) AS orderkey, o.k IS NOT NULL AS in_s0, l.k IS NOT NULL AS in_s1
            FROM (SELECT DISTINCT o_orderkey AS k FROM orders) o
            FULL JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) l ON o.k = l.k
            WHERE o.k IS NULL OR l.k IS NULL""",
        "q_rows_flat": f"""
            SELECT orderkey,
                   row_number() OVER (
                       PARTITION BY orderkey ORDER BY q, status NULLS FIRST, {_LINE_ORDER}) AS pos,
                   CAST(q AS BIGINT) AS q, o_custkey, l_linenumber, l_partkey, l_suppkey
            FROM ({_ORDERS_AND_LINES})""",
        "q_rows_flat_hot": f"""
            SELECT l_linestatus,
                   row_number() OVER (
                       PARTITION BY l_linestatus ORDER BY l_orderkey NULLS FIRST, {_LINE_ORDER}) AS pos,
                   l_orderkey, l_linenumber, l_partkey
            FROM lineitem""",
        "q_pages_hot": f"""
            SELECT l_linestatus, (pos - 1) // {HOT_PAGE_ROWS} AS page, count(*) AS n_rows,
                   arg_min(l_orderkey, pos) AS first_orderkey, arg_max(l_orderkey, pos) AS last_orderkey,
                   CAST(sum(l_suppkey) AS BIGINT) AS sum_suppkey
            FROM (SELECT *, row_number() OVER (
                      PARTITION BY l_linestatus ORDER BY l_orderkey NULLS FIRST, {_LINE_ORDER}) AS pos
                  FROM lineitem)
            GROUP BY l_linestatus, page""",
        "q_pages_bytes": f"""
            SELECT lang, page, count(*) AS n_rows, CAST(sum(size) AS BIGINT) AS n_bytes,
                   min(doc_id) AS first_doc, max(doc_id) AS last_doc
            FROM (SELECT *, CAST(coalesce(sum(weight) OVER (
                             PARTITION BY lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                         // {TEXT_PAGE_BYTES} AS BIGINT) AS page
                  FROM (SELECT lang, doc_id, strlen(text) AS size,
                               greatest(strlen(text) + 16, {TEXT_PAGE_BYTES // TEXT_PAGE_ROWS}) AS weight
                        FROM documents))
            GROUP BY lang, page""",
        "q_sorted_slices": f"""
            SELECT {_slice_sql('token')} AS slice, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_late,
                   min(token) AS min_token, max(token) AS max_token
            FROM (SELECT {_token_sql('orderkey')} AS token FROM ({_ORDERS_AND_LINES}))
            GROUP BY slice""",
        "q_group_integrity": f"""
            SELECT count(DISTINCT orderkey) AS n_groups, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_split
            FROM ({_ORDERS_AND_LINES})""",
        "q_token": f"""
            SELECT {order_token} AS token, o_orderkey AS orderkey, o_custkey FROM orders""",
        "q_token_composite": f"""
            SELECT {_token_sql("CAST(l_orderkey AS VARCHAR) || chr(31) || CAST(l_suppkey AS VARCHAR)")} AS token,
                   l_orderkey AS orderkey, l_suppkey AS suppkey, l_partkey, l_linenumber
            FROM lineitem""",
        "q_token_slice": f"""
            SELECT {order_token} AS token, o_orderkey AS orderkey, o_custkey, o_totalprice FROM orders
            WHERE {order_token} BETWEEN {low} AND {high}""",
        "q_slice_cover": f"""
            SELECT {_slice_sql(line_token)} AS slice, count(*) AS n_rows FROM lineitem GROUP BY slice""",
        "q_slice_boundaries": f"""
            WITH {_RANGES}
            SELECT slice, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_keys
            FROM lineitem JOIN ranges ON {line_token} BETWEEN lo AND hi
            GROUP BY slice""",
        "q_slice_assign": f"""
            WITH {_RANGES}
            SELECT o_orderkey AS orderkey, slice
            FROM orders JOIN ranges ON {order_token} BETWEEN lo AND hi""",
        "q_slice_profile": f"""
            SELECT {_slice_sql(_token_sql('k'))} AS slice, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
                   max(n) AS largest_group
            FROM (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY k)
            GROUP BY slice""",
        "q_slice_profile_sums": f"""
            SELECT {_slice_sql(_token_sql('k'))} AS slice, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
                   list_sort(list(n))[CAST(ceil(count(*) / 2) AS BIGINT)] AS size_50
            FROM (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY k)
            GROUP BY slice""",
        "q_slice_backfill": f"""
            SELECT {_slice_sql(line_token)} AS slice, count(*) AS n_rows,
                   CAST(sum(l_orderkey) AS BIGINT) AS sum_orderkey, CAST(sum(l_partkey) AS BIGINT) AS sum_partkey
            FROM lineitem GROUP BY slice""",
        "q_slice_resume": f"""
            SELECT {_slice_sql(line_token)} AS slice, count(*) AS n_rows,
                   CAST(sum(l_orderkey) AS BIGINT) AS sum_orderkey, CAST(sum(l_partkey) AS BIGINT) AS sum_partkey
            FROM lineitem GROUP BY slice""",
        "q_group_cursor": """
            SELECT conv_id, count(*) AS n_turns, arg_min(role, turn) AS first_role, arg_max(role, turn) AS last_role,
                   true AS together
            FROM conversations GROUP BY conv_id""",
        "q_slice_iterate": f"""
            SELECT s AS slice, count(l_orderkey) AS n_rows,
                   CAST(sum(l_orderkey) AS BIGINT) AS sum_orderkey, CAST(sum(l_partkey) AS BIGINT) AS sum_partkey
            FROM (SELECT CAST(unnest(range({SLICES})) AS INTEGER) AS s) LEFT JOIN lineitem ON {_slice_sql(line_token)} = s
            GROUP BY s""",
        "q_heavy_keys": f"""
            SELECT l_suppkey, count(*) AS n_rows, CAST(sum(l_linenumber) AS BIGINT) AS weight
            FROM lineitem GROUP BY l_suppkey HAVING sum(l_linenumber) > {HEAVY_ROWS}""",
        "q_key_order": """
            SELECT event_id, row_number() OVER (
                       PARTITION BY user_id
                       ORDER BY event_type NULLS FIRST, value NULLS FIRST, ts NULLS FIRST, event_id NULLS FIRST) AS place
            FROM events""",
        "q_declared_keys": """
            SELECT event_type, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows
            FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type)
            GROUP BY event_type""",
        "q_token_ranges": f"""
            SELECT i AS slice, count(l_orderkey) AS n_rows,
                   CAST(sum(l_orderkey) AS BIGINT) AS sum_orderkey, CAST(sum(l_partkey) AS BIGINT) AS sum_partkey
            FROM (VALUES {", ".join(f"(CAST({i} AS INTEGER), {low}, {high})" for i, (low, high) in enumerate(TOKEN_CUTS))})
                 AS cuts(i, low, high)
            LEFT JOIN lineitem ON {line_token} BETWEEN low AND high
            GROUP BY i""",
        "q_slice_balanced": f"""
            {_balanced_sql(f"SELECT {line_token} AS token, l_orderkey AS k, 1 AS w FROM lineitem", SLICES, 11)}
            SELECT dense_rank() OVER (ORDER BY place) - 1 AS slice, CAST(sum(n) AS BIGINT) AS n_rows,
                   CAST(sum(keys) AS BIGINT) AS n_keys
            FROM placed GROUP BY place""",
        "q_slice_balanced_bytes": f"""
            {_balanced_sql(
                f"SELECT {_token_sql('doc_id')} AS token, doc_id AS k, coalesce(strlen(text), 0) AS w FROM documents",
                BYTE_SLICES, 5)}
            SELECT dense_rank() OVER (ORDER BY place) - 1 AS slice, CAST(sum(w) AS BIGINT) AS n_bytes,
                   CAST(sum(n) AS BIGINT) AS n_rows
            FROM placed GROUP BY place""",
        "q_group_hof": f"""
            SELECT orderkey, CAST(count(*) FILTER (q = 1) AS BIGINT) AS n_lines, count(*) FILTER (flag = 'R') AS n_returned,
                   CAST(coalesce(sum(l_partkey), 0) AS BIGINT) AS sum_partkey, max(l_linenumber) AS max_linenumber
            FROM (SELECT o_orderkey AS orderkey, 0 AS q, NULL AS flag, NULL::BIGINT AS l_partkey,
                         NULL::INTEGER AS l_linenumber FROM orders
                  UNION ALL
                  SELECT l_orderkey, 1, l_returnflag, l_partkey, l_linenumber FROM lineitem)
            GROUP BY orderkey""",
        "q_cogroup_apply": """
            SELECT orderkey, count(l_orderkey) AS n_lines,
                   count(*) FILTER (l_extendedprice * 3 > o_totalprice) AS n_dear, max(o_totalprice) AS total
            FROM (SELECT coalesce(o_orderkey, l_orderkey) AS orderkey, l_orderkey, l_extendedprice, o_totalprice
                  FROM orders FULL JOIN lineitem ON o_orderkey = l_orderkey)
            GROUP BY orderkey""",
        "q_cogroup_apply_hot": """
            SELECT c_nationkey AS nationkey, c_custkey FROM customer
            LEFT JOIN (SELECT s_nationkey, max(s_acctbal) AS best FROM supplier GROUP BY s_nationkey)
                   ON s_nationkey = c_nationkey
            WHERE best IS NULL OR c_acctbal > best""",
        "q_group_apply": """
            SELECT conv_id, count(*) AS n_turns, CAST(sum(length(text)) AS BIGINT) AS n_chars,
                   count(*) FILTER (role <> previous) AS n_changes,
                   arg_min(role, turn) AS first_role, arg_max(role, turn) AS last_role
            FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS previous FROM conversations)
            GROUP BY conv_id""",
    }
