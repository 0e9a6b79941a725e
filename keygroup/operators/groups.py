"""Rows of several queries, grouped by key."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from keygroup.errors import JobError
from keygroup.functions.order import order_key
from keygroup.functions.token import XXHASH_64, Tokenizer, key_columns
from keygroup.names import TOKEN, quoted
from keygroup.operators.cursor import PREFETCH_ROWS, GroupCursor, lay_out_pages
from keygroup.operators.hot import HotKeys, find_hot_keys, number_rows
from keygroup.operators.sides import merged_in_order, run_sides
from keygroup.plans.shape import Shaped
from keygroup.plans.spec import QuerySpec
from keygroup.sources.token_files import TokenFiles
from keygroup.workspace import delete, new_path

DEFAULT_PAGE_ROWS = 10_000
# Rows of a group that a task puts in order by itself, however small the pages are.
TASK_ROWS = 10_000
MERGE_FAN_IN = 1_000
# Rows of results that are merged at a time, and of a batch that a function sees.
MERGE_ROWS = 100_000
BATCH_ROWS = 10_000


class KeyedGroups:
    """The groups of a job, in several forms.

    A group of up to ``page_rows`` rows is one page, numbered 0. A larger group is
    cut into consecutive pages, so that no list outgrows a task: the pages of a key,
    by number, are its rows in order. With ``page_bytes``, a page is also cut where
    the selected values before its last row reach that size; numbers may then skip.

    Order inside a group: position of the query, clustering columns, and a hash of
    the other columns between rows that agree in those.

    The first form asked for counts rows, over the key columns alone, to learn whether
    any group needs several pages; the answer is kept for the rest. Where declared
    primary keys bound the groups, nothing is counted. With pages smaller than ``TASK_ROWS``,
    only the groups above that are looked for: the others, however many span several pages,
    are cut into them by the task that has their key, in one shuffle.

    A function or expression over lists sees one page. What it needs beside every page,
    such as the header of many lines, is named by ``carry``: queries that have at most one
    row per group by their declared keys, and whose row then comes with each page, beyond
    the page's own rows.

    Large groups are kept in tables of the workspace; ``close`` or a ``with`` block deletes them.
    """

    def __init__(
        self,
        shaped: Shaped,
        page_rows: int = DEFAULT_PAGE_ROWS,
        page_bytes: int | None = None,
        queries: Sequence[QuerySpec] = (),
    ):
        if page_rows < 1:
            raise ValueError(f"page_rows must be positive, not {page_rows}")
        if page_bytes is not None and page_bytes < 1:
            raise ValueError(f"page_bytes must be positive, not {page_bytes}")
        self._shaped = shaped
        self._queries = tuple(queries)
        self._paths: list[str] = []
        self._numbered_without: dict[tuple[int, ...], DataFrame] = {}
        self.page_rows = page_rows
        # What a page may weigh, and what a row weighs: one, or its bytes, but never
        # so few that a page could hold more than ``page_rows`` rows.
        self._page_weight, self._row_weight = page_rows, None
        if page_bytes is not None:
            least = -(-page_bytes // page_rows)
            self._page_weight = least * page_rows
            self._row_weight = F.greatest(shaped.row_bytes, F.lit(least).cast("bigint"))
        self.keys = shaped.names
        self._key_terms = shaped.keys
        self._key_columns = [F.col(k).alias(name) for k, name in zip(shaped.keys, shaped.names)]
        self._key_names = [quoted(name) for name in shaped.names]

    def close(self) -> None:
        """Delete the tables of large groups; frames made from these groups can no longer be read."""
        while self._paths:
            delete(self._shaped.rows.sparkSession, self._paths.pop())

    def __enter__(self) -> KeyedGroups:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    # -- rows and their pages ---------------------------------------------------

    @property
    def rows(self) -> DataFrame:
        """The bag of all rows with their source tag; nothing is grouped yet."""
        return self._shaped.rows.select(*self._key_columns, "_q", *self._shaped.payloads)

    @cached_property
    def hot(self) -> HotKeys | None:
        """Keys whose groups span several pages, or None."""
        if self._bounded:
            return None
        return find_hot_keys(self._shaped.rows, self._key_terms, self._page_weight, self._row_weight, self._paths)

    @property
    def _bounded(self) -> bool:
        """Whether declared keys allow no group more rows than a page."""
        return self._row_weight is None and all(self._shaped.single) and len(self._shaped.single) <= self.page_rows

    @cached_property
    def _large(self) -> HotKeys | None:
        """Keys whose groups are cut into pages by several tasks, or None."""
        if not self._cut:
            return self.hot
        return find_hot_keys(self._shaped.rows, self._key_terms, TASK_ROWS, None, self._paths)

    @cached_property
    def _cut(self) -> bool:
        """Whether all other groups are cut into pages by the task that has their key.

        Pages bounded by bytes are not: their groups may be few rows and yet too much for a task.
        """
        small_pages = self._row_weight is None and self.page_rows < TASK_ROWS
        return small_pages and not self._bounded and not self._in_place

    @property
    def _several(self) -> bool:
        """Whether groups may have several pages."""
        return self._cut or self._large is not None

    @property
    def _in_place(self) -> bool:
        """Whether the rows of each group already lie together in a bucket.

        A hot group would make its bucket too large for a task, so rows are then
        read in even splits instead.
        """
        return self._shaped.in_place is not None and self.hot is None

    @property
    def _small_groups(self) -> DataFrame:
        """Rows of the groups that are not large."""
        if self._large is not None:
            return self._large.matches(self._shaped.rows, "left_anti")
        return self._shaped.in_place if self._in_place else self._shaped.rows

    def _small_pages(self, carried: tuple[int, ...]) -> DataFrame:
        """Rows of the groups that are not large with ``_page``, each carried row once per page."""
        rows = self._small_groups
        if not self._cut:
            return rows.select("*", _first_page())
        # One order serves both windows; the rows move to the tasks of their keys once.
        group = Window.partitionBy(*self._key_terms).orderBy(*self._shaped.sort_terms)
        own = ~F.col("_q").isin(*carried) if carried else F.lit(True)
        before = F.count(F.when(own, True)).over(group.rowsBetween(Window.unboundedPreceding, -1))
        paged = rows.withColumn("_page", F.floor(before / F.lit(self.page_rows)).cast("bigint"))
        if not carried:
            return paged
        whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        zero = F.lit(0).cast("bigint")
        last = F.coalesce(F.max(F.when(own, F.col("_page"))).over(whole), zero)
        pages = F.when(own, F.array("_page")).otherwise(F.sequence(zero, F.col("_last")))
        return paged.withColumn("_last", last).withColumn("_page", F.explode(pages)).drop("_last")

    def _numbered(self, carried: tuple[int, ...] = ()) -> DataFrame:
        """Rows of the large groups with ``_pos`` and ``_page``; carried queries have none."""
        if carried not in self._numbered_without:
            shaped = self._shaped
            identified = None if shaped.unique else shaped.identified()
            distinct = [] if shaped.unique else None if identified is None else ["_rid"]
            rows = self._large.matches(shaped.rows if identified is None else identified, "left_semi")
            if carried:
                rows = rows.where(~F.col("_q").isin(*carried))
            placed = number_rows(rows, shaped.sort_terms, self._large, distinct, self._row_weight, self._paths)
            paged = placed.withColumn("_page", F.expr(f"_before div {self._page_weight}")).drop("_before")
            self._numbered_without[carried] = paged
        return self._numbered_without[carried]

    def _hot_pages(self, carried: tuple[int, ...]) -> DataFrame:
        """Rows of the large groups with ``_page``, each carried row once per page."""
        numbered = self._numbered(carried).drop("_pos")
        if not carried:
            return numbered
        keys, rows = self._key_terms, self._shaped.rows.where(F.col("_q").isin(*carried))
        if self._row_weight is None:
            # The pages of a group follow from the number of its rows; a group of carried
            # rows alone has one as well.
            own = F.col("_n") - F.count("*").over(Window.partitionBy(*keys))
            last = F.greatest(F.ceil(own / F.lit(self._page_weight)).cast("bigint"), F.lit(1).cast("bigint")) - 1
            paged = self._large.with_numbers(rows).withColumn("_last", last)
            paged = paged.withColumn("_page", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_last"))))
            return numbered.unionByName(paged.select(*numbered.columns))
        pages = numbered.select(*keys, "_page").unionByName(self._large.table.select(*keys, _first_page())).distinct()
        named = pages.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_page")
        same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
        single = self._large.matches(rows, "left_semi")
        return numbered.unionByName(single.join(named, same).select(*numbered.columns))

    def _carried(self, carry: Sequence[int | QuerySpec]) -> tuple[int, ...]:
        """Positions of the queries to carry; refused unless they have one row per group."""
        found = set()
        for one in carry:
            if isinstance(one, int) and 0 <= one < len(self._shaped.single):
                found.add(one)
            elif one in self._queries:
                found.add(self._queries.index(one))
            else:
                raise JobError(f"{one!r} is no query of this job")
        many = [i for i in sorted(found) if not self._shaped.single[i]]
        if many:
            raise JobError(f"queries {many} may have several rows in a group and cannot be carried")
        return tuple(sorted(found))

    def _paged(self, carried: tuple[int, ...] = ()) -> DataFrame:
        """All rows with ``_page``."""
        small = self._small_pages(carried)
        return small if self._large is None else small.unionByName(self._hot_pages(carried))

    @property
    def _page_terms(self) -> list[str]:
        return [*self._key_terms, "_page"] if self._several else self._key_terms

    def presence(self) -> DataFrame:
        """One row per group: the key, and per query whether it has rows there.

        Reads the key columns only; flags are joined before the shuffle.
        """
        flags = (F.bool_or(F.col("_q") == i).alias(f"in_{p}") for i, p in enumerate(self._shaped.payloads))
        return self._shaped.rows.groupBy(*self._key_terms).agg(*flags).select(
            *self._key_columns, *(f"in_{p}" for p in self._shaped.payloads)
        )

    # -- groups as lists --------------------------------------------------------

    def merged(self, carry: Sequence[int | QuerySpec] = ()) -> DataFrame:
        """One row per page: key, ``_page`` and ``rows``, the list of its rows.

        An element holds ``_q`` and one struct per query, null but for its own.
        """
        row = F.struct("_q", *self._shaped.payloads)
        return self._collect(carry, rows=self._ordered(self._shaped.sort_terms, row))

    def cogrouped(self, carry: Sequence[int | QuerySpec] = ()) -> DataFrame:
        """One row per page: key, ``_page`` and one list per query, ``s0``, ``s1``, …"""
        lists = {}
        for index, payload in enumerate(self._shaped.payloads):
            order = self._shaped.order[index]
            lists[payload] = self._ordered(order, F.col(payload), F.col("_q") == index)
        return self._collect(carry, **lists)

    def _ordered(self, order: list[str], row: Column, only: Column | None = None) -> Column:
        """The list of ``row`` values in the order of the ``order`` terms."""
        terms = F.struct(*(F.col(term).alias(f"t{i}") for i, term in enumerate(order)))
        element = F.struct(terms.alias("order"), row.alias("row"))
        collected = F.collect_list(element if only is None else F.when(only, element))
        if self._shaped.sortable:
            return F.sort_array(collected)["row"]
        # Maps have no order, so the elements that hold them are compared by hand.
        return F.array_sort(
            collected,
            lambda a, b: F.when(a["order"] < b["order"], -1).when(a["order"] > b["order"], 1).otherwise(0),
        )["row"]

    def _collect(self, carry: Sequence[int | QuerySpec], **lists: Column) -> DataFrame:
        # Lists do not shrink before the shuffle, so rows move first and are
        # collected once, instead of being collected on both sides of it. Rows that
        # lie in buckets of their key need not move at all, nor those that were cut into
        # pages where their key is.
        carried = self._carried(carry)
        terms = self._page_terms
        page = F.col("_page") if self._several else _first_page()
        rows = self._small_pages(carried)
        parts = [rows if self._in_place or self._cut else rows.repartition(*self._key_terms)]
        if self._large is not None:
            parts.append(self._hot_pages(carried).repartition(*terms))
        groups = [part.groupBy(*terms).agg(*(c.alias(n) for n, c in lists.items())) for part in parts]
        return reduce(DataFrame.unionByName, groups).select(*self._key_columns, page, *lists)

    def fold(
        self,
        cogrouped: bool = False,
        carry: Sequence[int | QuerySpec] = (),
        **parts: tuple[Column, Callable[[Column], Column]],
    ) -> DataFrame:
        """One row per group from its lists.

        Each part is an expression over the list or lists of one page (and its
        ``_page``), and the aggregate that joins the values of the pages; it is applied
        to groups of one page, too. Carried rows are in the lists of every page.
        """
        lists = self.cogrouped(carry) if cogrouped else self.merged(carry)
        pages = lists.select(*self._key_names, "_page", *(e.alias(n) for n, (e, _) in parts.items()))
        # The pages of a job without large groups lie by key already; nothing moves again.
        return pages.groupBy(*self._key_names).agg(*(join(F.col(n)).alias(n) for n, (_, join) in parts.items()))

    # -- groups as flat rows ----------------------------------------------------

    def flat(self) -> DataFrame:
        """Key, ``_pos`` (1-based position in the group), ``_q`` and the structs."""
        window = Window.partitionBy(*self._key_terms).orderBy(*self._shaped.sort_terms)
        columns = [*self._key_columns, "_pos", "_q", *self._shaped.payloads]
        position = F.row_number().over(window).cast("bigint")
        small = self._small_groups.withColumn("_pos", position).select(*columns)
        return small if self._large is None else small.unionByName(self._numbered().select(*columns))

    def sorted_slices(
        self, n: int, tokenizer: Tokenizer = XXHASH_64, style: str | None = None, uuids: Sequence[str] = ()
    ) -> DataFrame:
        """Rows in exactly ``n`` partitions, each ordered by token, key and group order.

        With a ``style``, keys are compared as ``order_key`` does, by one term; ``uuids`` are
        key columns that hold UUIDs as texts.

        Partition ``i`` is token slice ``i``; page ``p`` of a hot group goes ``p``
        partitions further, round and round. A page is never split.
        """
        key = self._key_terms[: self._shaped.n_partition_key]
        token = tokenizer.column(*key_columns(key, self._shaped.rows.schema))
        target = F.pmod(tokenizer.slice_of(TOKEN, n).cast("bigint") + F.col("_page"), F.lit(n)).cast("int")
        terms = self._key_terms
        if style is not None:
            terms_of = dict(zip(self.keys, self._key_terms))
            terms = [order_key(terms, self._shaped.rows.schema, style, [terms_of[name] for name in uuids])]
        return (
            self._paged().withColumn(TOKEN, token)
            .repartitionById(n, target)
            .sortWithinPartitions(TOKEN, *terms, "_page", *self._shaped.sort_terms)
            .select(TOKEN, *self._key_columns, "_page", "_q", *self._shaped.payloads)
        )

    def partitioned(self, n: int) -> DataFrame:
        """Rows in exactly ``n`` partitions, unsorted; every page lies in one of them."""
        return (
            self._paged().repartition(n, *self._page_terms)
            .select(*self._key_columns, "_page", "_q", *self._shaped.payloads)
        )

    def lay_out(
        self, path: str, cogrouped: bool = False, carry: Sequence[int | QuerySpec] = (), **options
    ) -> TokenFiles:
        """Write the pages, ``merged`` or ``cogrouped``, to files sorted by token, key and page.

        They outlive this session; ``options`` are those of ``TokenFiles.write``, whose
        ``rows_per_file`` counts pages here.
        """
        pages = self.cogrouped(carry) if cogrouped else self.merged(carry)
        return lay_out_pages(pages, self.keys, self._shaped.n_partition_key, path, **options)

    def cursor(self, prefetch_rows: int = PREFETCH_ROWS, **options) -> GroupCursor:
        """A cursor over the pages with their keys, laid out in the workspace for it first.

        To go on in another session, keep what ``lay_out`` writes and a position, and open
        a ``GroupCursor`` over ``TokenFiles.open``.
        """
        path = new_path(self._shaped.rows.sparkSession, "pages")
        self._paths.append(path)
        return GroupCursor(self.lay_out(path, **options), prefetch_rows)

    # -- user functions ---------------------------------------------------------

    def apply_pages(
        self,
        function: Callable,
        schema: T.StructType | str,
        carry: Sequence[int | QuerySpec] = (),
        partitions: int | None = None,
    ) -> DataFrame:
        """Call ``function(pdf) -> pdf`` once per page, its rows in group order.

        Columns of ``pdf``: the key, ``_page``, ``_q``, and ``s0_x`` for column x of
        query 0, and so on; they are null in rows of other queries. ``partitions`` are
        the tasks, ``spark.sql.shuffle.partitions`` of them unless given.
        """
        return self._apply(self._paged(self._carried(carry)), function, schema, partitions=partitions)

    def apply_groups(
        self,
        function: Callable,
        merge: Callable,
        schema: T.StructType | str,
        carry: Sequence[int | QuerySpec] = (),
        partitions: int | None = None,
    ) -> DataFrame:
        """Call ``function`` per page and ``merge`` on the results of a group's pages.

        Both return frames of ``schema``, which holds the key columns. ``merge`` gets
        results of pages, in page order, and then its own results, until one is left; it
        must not depend on how they are batched. A frame has about ``MERGE_ROWS`` rows
        beside one result, however many rows a group's pages return. It gets the result
        of a group of one page as well.
        """
        carried = self._carried(carry)
        keys = list(self.keys)

        def whole(pdf):
            return merge(function(pdf))

        if not self._several:
            return self._apply(self._paged(), whole, schema, partitions=partitions)
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        numbered = T.StructType([*schema.fields, T.StructField("_page", T.LongType())])

        # The page number travels beside the result; both callables stay unaware of it.
        def on_page(pdf):
            return function(pdf).assign(_page=pdf["_page"].iloc[0])

        def on_results(frames):
            return merged_in_order(frames, merge, keys, MERGE_ROWS)

        # Small groups of several pages take the same way as large ones.
        paged = self._paged(carried) if self._cut else self._hot_pages(carried)
        merged = self._apply(paged, on_page, numbered, partitions=partitions)
        largest = TASK_ROWS if self._large is None else self._large.largest
        pages = -(-largest // self._page_weight)
        span = 1
        while True:
            span *= MERGE_FAN_IN
            batch = F.expr(f"_page div {span}").alias("_batch")
            terms = [*self._key_names, "_batch"]
            lying = merged.select("*", batch).repartition(*terms).sortWithinPartitions(*terms, "_page").drop("_batch")
            # Neighbours of one key in a partition may be of two batches; joined at once, that saves a round.
            merged = lying.mapInPandas(on_results, numbered)
            if span >= pages:
                break

        if self._cut:
            return merged.drop("_page")
        small = self._small_groups.select("*", _first_page())
        small = self._apply(small, whole, schema, one_page=True, partitions=partitions)
        return small.unionByName(merged.drop("_page"))

    def apply_sides(
        self,
        function: Callable,
        schema: T.StructType | str,
        paged: bool = False,
        carry: Sequence[int | QuerySpec] = (),
        batch_rows: int = BATCH_ROWS,
        partitions: int | None = None,
    ) -> DataFrame:
        """Call ``function(key, *sides)`` once per group, the rows of every query apart.

        ``key`` is a tuple of the key's values. A side is an iterator of Arrow batches with
        the columns of one query, in its clustering order, of ``batch_rows`` rows at most;
        it is empty where the query has no rows of the key. The function returns, or yields,
        Arrow batches or tables, pandas frames, or dicts of lists, with the columns of ``schema``.

        Rows are streamed: sides are read in the order of the queries, and a group of any
        size takes the memory of a batch. A side may be left early or left out; one that a
        later side has passed is gone. As a function may want to see all rows of a group, a
        hot group is the work of one task. With ``paged``, the function is called per page,
        and many tasks share a hot group; rows of ``carry`` come with every page.
        """
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if batch_rows < 1:
            raise ValueError(f"batch_rows must be positive, not {batch_rows}")
        if carry and not paged:
            raise JobError("rows are carried to pages; a whole group has them anyway")
        if paged:
            rows = self._paged(self._carried(carry))
        else:
            rows = self._shaped.rows.withColumn("_page", F.lit(0).cast("bigint"))
        # Both zeros are one key, to the shuffle as well.
        floating = [k for k in self._key_terms if isinstance(rows.schema[k].dataType, (T.FloatType, T.DoubleType))]
        rows = rows.withColumns({k: F.when(F.col(k) == 0, F.lit(0).cast(rows.schema[k].dataType)).otherwise(F.col(k)) for k in floating})
        arrow = to_arrow_schema(schema)

        terms = [*self._key_terms, "_page"]
        n_terms, n_sides = len(terms), len(self._shaped.payloads)

        def run(stream):
            # The page parts calls, but is no part of the key that the function sees.
            return run_sides(stream, lambda key, *sides: function(key[:-1], *sides), n_terms, n_sides, arrow, batch_rows)

        n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return (
            rows.repartition(n, *terms)
            .sortWithinPartitions(*terms, *self._shaped.sort_terms)
            .select(*self._key_terms, "_page", "_q", *self._shaped.payloads)
            .mapInArrow(run, schema)
        )

    def _apply(
        self,
        paged: DataFrame,
        function: Callable,
        schema: T.StructType | str,
        one_page: bool = False,
        partitions: int | None = None,
    ) -> DataFrame:
        # A constant page number would be dropped from the sort, and the rows would
        # be sorted once more without their order.
        page = [] if one_page or not self._several else ["_page"]
        terms = [*self._key_terms, *page]
        flat = [
            F.col(payload)[field.name].alias(f"{payload}_{field.name}")
            for payload in self._shaped.payloads
            for field in self._shaped.rows.schema[payload].dataType.fields
        ]
        # A fixed number of partitions, since few bytes may mean much work in Python.
        # The grouping asks for rows sorted by ``terms``; this sort satisfies it and
        # goes on with the order inside the page.
        n = partitions or int(paged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return (
            paged.repartition(n, *terms)
            .sortWithinPartitions(*terms, *self._shaped.sort_terms)
            .select(*self._key_columns, "_page", "_q", *flat)
            .groupBy(*self._key_names, *page)
            .applyInPandas(function, schema)
        )


def _first_page() -> Column:
    return F.lit(0).cast("bigint").alias("_page")
