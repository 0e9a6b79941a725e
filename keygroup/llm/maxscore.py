"""Exact top-k by inner product with MaxScore over shards.

Components are whole numbers, a dimension is a term, and a term's posting list in a
shard holds each vector's component. A query's terms are split by score bounds: the
terms whose bounds together stay below the k-th best score so far are non-essential.
The postings of the essential terms are traversed, for a block of queries at once; a
vector that can still reach the k-th score is probed in the other terms, largest bound
first, while it is competitive. Bounds are counted from each term's least possible
contribution, so that negative weights and components fit in. A query takes its k-th
best score along from shard to shard; the best of all tasks are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keygroup.llm.common import picked

SHARD_ROWS = 8_192
QUERY_ROWS = 512
SEED_ROWS = 64
# A task has one group of vectors, and all queries pass by. Groups have so many rows at
# least; there are more than GROUPS only where each would have over GROUP_PARTS components.
GROUP_ROWS = 1_024
GROUPS = 64
GROUP_PARTS = 1 << 24
# Scores that are held at once, of some queries with all vectors of a shard.
CELLS = 1 << 20
# Where more of so many vectors stay alive after the essential terms, probing one by one
# would take longer than to traverse all postings.
SAMPLE_ROWS, DENSE = 256, 1 / 64
# Vectors with a component beyond it are searched apart; their scores may not fit a long.
NARROW = 1 << 26
# Every float fits. Doubles beyond it are refused.
LARGEST = 1 << 136
# Scores have this many digits at most; others are refused.
DIGITS = 38
# Below every score of a ``Shard``.
NONE = -(1 << 62)


def quantised(vector: Column) -> Column:
    """``floor(256 x)`` of every component, as a whole double; null for a vector without part."""
    wide = vector.cast("array<double>")
    usable = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    refused = F.raise_error(F.lit("a component is too large for an exact score")).cast("double")

    def whole(x: Column) -> Column:
        # A double of 2^53 or more has no fraction.
        small = F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double"))
        return small.when(F.abs(x) <= float(LARGEST), x).otherwise(refused)

    return F.when(vector.isNotNull() & usable, F.transform(wide, lambda x: whole(x * 256)))


class Best:
    """The ``k`` best of every query of a block: score and id, ties to smaller ids."""

    def __init__(self, own: np.ndarray, k: int):
        self.own, self.k = own, k
        self.scores, self.ids = np.full((len(own), k), NONE), np.zeros((len(own), k), np.int64)

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores and ids by the numbers of their queries, which rise."""
        met = np.unique(queries)
        queries = np.concatenate([np.repeat(met, self.k), queries])
        scores = np.concatenate([self.scores[met].ravel(), scores.astype(np.int64)])
        ids = np.concatenate([self.ids[met].ravel(), ids])
        order = np.lexsort((ids, -scores, queries))
        queries = queries[order]
        place = np.arange(len(queries)) - np.searchsorted(queries, queries)
        best = place < self.k
        self.scores[queries[best], place[best]] = scores[order[best]]
        self.ids[queries[best], place[best]] = ids[order[best]]


class Shard:
    """Posting lists of up to ``SHARD_ROWS`` vectors, by term."""

    def __init__(self, ids: np.ndarray, postings: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.low, self.high = postings.min(axis=1), postings.max(axis=1)
        self.norm, self.largest = _norm(postings), _largest(postings)
        exact = np.float32 if self.largest <= 1 << 24 else np.float64
        self.postings = np.ascontiguousarray(postings[:, order], exact)
        self.sample = np.ascontiguousarray(self.postings[:, :: max(1, len(ids) // SAMPLE_ROWS)])

    def kind(self, queries: np.ndarray) -> type | None:
        """A type that holds all sums exactly, the smallest; none if a long does not."""
        # No sum of some of a score's products is larger than the product of the norms.
        norms, largest = self.norm * _norm(queries) * 1.001, self.largest * _largest(queries)
        if norms < 1 << 24:
            return np.float32
        if norms < 1 << 53 and 4 * len(self.postings) * largest < 1 << 53:
            return np.float64
        return np.int64 if len(self.postings) * largest < 1 << 60 else None

    def search(self, best: Best, queries: np.ndarray, kind: type) -> None:
        """Adds what is among the best; ``queries`` by term, sums in ``kind``."""
        terms = min(len(queries), len(self.postings))
        queries, postings = queries[:terms], self.postings[:terms].astype(kind, copy=False)
        step = max(1, CELLS // max(1, len(self.ids)))
        for at in range(0, len(best.own), step):
            self._some(best, slice(at, at + step), queries[:, at : at + step], postings)

    def _some(self, best: Best, some: slice, queries: np.ndarray, postings: np.ndarray) -> None:
        kind, wide = postings.dtype, np.int64 if postings.dtype == np.int64 else np.float64
        own, terms, k = best.own[some], len(queries), best.k
        queries = queries.astype(wide)
        ends = np.stack([queries * self.low[:terms, None], queries * self.high[:terms, None]])
        least, bound = ends.min(axis=0), np.abs(ends[1] - ends[0])
        base = least.sum(axis=0)
        order = np.argsort(bound, axis=0, kind="stable")
        rest = np.concatenate([np.zeros((1, len(own)), wide), np.cumsum(np.take_along_axis(bound, order, 0), axis=0)])

        threshold = best.scores[some, -1].astype(wide)
        seed = (queries.T.astype(kind) @ postings[:, :SEED_ROWS]).astype(wide)
        seed[self.ids[:SEED_ROWS] == own[:, None]] = NONE
        if seed.shape[1] >= k:
            threshold = np.maximum(threshold, np.partition(seed, -k, axis=1)[:, -k])
        # From here on, of what lies above the least contributions.
        needed = threshold - base

        # rest[n] bounds what the n smallest terms can add together.
        n = np.maximum((rest < needed).sum(axis=0) - 1, 0)
        rank = np.argsort(order, axis=0)
        everyone = np.arange(len(own))

        def essential() -> tuple[np.ndarray, np.ndarray]:
            """The weights of the essential terms, and what a vector needs in them."""
            used = rank >= n
            return np.where(used, queries, 0).astype(kind), needed - rest[n, everyone] + np.where(used, least, 0).sum(axis=0)

        weights, cut = essential()
        alive = (weights.T @ self.sample[:terms].astype(kind) >= cut[:, None]).mean(axis=1)
        n = np.where(alive > DENSE, 0, n)
        weights, cut = essential()
        reached = rest[-1] >= needed
        for these in (np.flatnonzero(reached & (n == 0)), np.flatnonzero(reached & (n > 0))):
            if not len(these):
                continue
            # Postings of terms that are essential for none of the queries are not traversed.
            used = (rank[:, these] >= n[these]).any(axis=1)
            sums = weights[:, these][used].T @ (postings if used.all() else postings[used])
            query, row = np.nonzero(sums >= _rounded_down(cut[these], kind)[:, None])
            sums, query = sums[query, row].astype(wide), these[query]
            other = self.ids[row] != own[query]
            sums, query, row = sums[other], query[other], row[other]

            # What terms that are still to be traversed contribute at least.
            left = np.where(rank < n, least, 0).sum(axis=0)
            for at in range(int(n[query].max(initial=0)) - 1, -1, -1):
                probed, term = n > at, order[at]
                left = np.where(probed, left - least[term, everyone], left)
                mine = np.flatnonzero(probed[query])
                asked = query[mine]
                sums[mine] += queries[term[asked], asked] * postings[term[asked], row[mine]].astype(wide)
                alive = ~probed[query] | (sums + left[query] + rest[at, query] >= threshold[query])
                sums, query, row = sums[alive], query[alive], row[alive]

            kept = _first(query, sums, 16 * k, k)
            best.add(query[kept] + some.start, sums[kept], self.ids[row[kept]])


def _first(query: np.ndarray, sums: np.ndarray, many: int, k: int) -> np.ndarray:
    """Indexes of the candidates but, of queries with ``many``, only the best ``k``; the first of equals."""
    starts = np.flatnonzero(np.diff(query, prepend=-1))
    kept = np.ones(len(query), bool)
    for start, end in zip(starts, np.append(starts[1:], len(query))):
        if end - start > many:
            own = sums[start:end]
            least = np.partition(own, -k)[-k]
            above = own > least
            equal = np.flatnonzero(own == least)[: k - int(above.sum())]
            above[equal] = True
            kept[start:end] = above
    return np.flatnonzero(kept)


def _rounded_down(values: np.ndarray, kind: np.dtype) -> np.ndarray:
    """Values of a type that ``kind`` may not hold, as the next below that it does."""
    near = values.astype(kind)
    return np.where(near > values, np.nextafter(near, kind.type(-np.inf)), near) if near.dtype != values.dtype else near


def _norm(postings: np.ndarray) -> float:
    return float(np.sqrt(np.square(postings, dtype=np.float64).sum(axis=0).max(initial=0)))


def _largest(postings: np.ndarray) -> int:
    return int(max(postings.max(initial=0), -postings.min(initial=0)))


class WideShard:
    """Vectors of whole doubles, whose scores may be too large for a long."""

    def __init__(self, ids: np.ndarray, postings: np.ndarray):
        self.ids, self.postings = ids, postings.astype(np.float64)

    def best(self, own: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """As ``Shard.best``: rounded scores tell which vectors may be among the best."""
        terms = min(len(query), len(self.postings))
        query, postings = query[:terms].astype(np.float64), self.postings[:terms]
        rows = np.flatnonzero(self.ids != own)
        score = query @ postings[:, rows]
        slack = 4 * (terms + 1) * np.finfo(float).eps * (np.abs(query) @ np.abs(postings[:, rows]))
        if len(rows) > k:
            rows = rows[score + slack >= np.sort(score - slack)[-k]]
        exact = [int(x) for x in query]
        found = ((sum(a * int(b) for a, b in zip(exact, postings[:, i])), int(self.ids[i])) for i in rows)
        return sorted(found, key=lambda x: (-x[0], x[1]))[:k]


class Group:
    """The shards of a task, as its rows come."""

    def __init__(self, size: int):
        self.size, self.shards = size, []
        self.held = {"q": [], "w": []}

    def add(self, rows: pa.RecordBatch) -> None:
        for name in self.held:
            own = rows.filter(rows[name].is_valid())
            while own.num_rows:
                room = self.size - sum(part.num_rows for part in self.held[name])
                self.held[name].append(own.slice(0, room))
                own = own.slice(room)
                if own.num_rows:
                    self._close(name)

    def _close(self, name: str) -> None:
        if self.held[name]:
            rows = pa.Table.from_batches(self.held[name]).combine_chunks().to_batches()[0]
            made = Shard if name == "q" else WideShard
            self.shards.append(made(rows["vec_id"].to_numpy(), _matrix(rows[name])))
            self.held[name] = []

    def all(self) -> list[Shard | WideShard]:
        for name in self.held:
            self._close(name)
        return self.shards


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Components by term; those that shorter vectors lack are 0."""
    lengths = vectors.value_lengths().to_numpy()
    values = vectors.flatten().to_numpy()
    terms = int(lengths.max(initial=0))
    if (lengths == terms).all():
        return values.reshape(len(lengths), terms).T
    matrix = np.zeros((terms, len(lengths)), values.dtype)
    starts = np.cumsum(lengths) - lengths
    matrix[np.arange(len(values)) - np.repeat(starts, lengths), np.repeat(np.arange(len(lengths)), lengths)] = values
    return matrix


def _found(shards: list[Shard | WideShard], own: np.ndarray, queries: np.ndarray, k: int) -> Iterator[list]:
    """Columns ``query_id, vec_id, score`` of a block: the best of all shards, or those of shards whose scores no long holds."""
    best = Best(own, k)
    for shard in shards:
        kind = shard.kind(queries) if isinstance(shard, Shard) and queries.dtype == np.int32 else None
        if kind:
            shard.search(best, queries, kind)
            continue
        wide = shard if isinstance(shard, WideShard) else WideShard(shard.ids, shard.postings)
        found = [
            (int(one), other, Decimal(score))
            for one, query in zip(own, queries.T)
            for score, other in wide.best(int(one), np.ascontiguousarray(query), k)
        ]
        if any(abs(score) >= 10**DIGITS for _, _, score in found):
            raise ValueError(f"a score has more than {DIGITS} digits")
        if found:
            yield list(zip(*found))
    there = best.scores > NONE
    yield [np.repeat(own, there.sum(axis=1)), best.ids[there], pa.array(best.scores[there]).cast(pa.decimal128(DIGITS, 0))]


def top_k(
    df: DataFrame, every: int = 50, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every row whose id is divisible by ``every``.

    Searched are all rows but those with the query's own id. Rows with a null id or a
    vector that is null or holds a null or non-finite component take no part, repeated
    rows count once, missing components of shorter vectors count as 0. Fewer than ``k``
    rows are returned where there are fewer candidates; an empty table gives none. Other
    columns are left out. Scores are exact decimals; one of more than ``DIGITS`` digits, or
    a component that no float holds, is an error.

    Vectors are dealt into groups, a task each, which turns its group into shards; the
    queries are copied to every group and pass by in blocks. Groups, shards and blocks are
    bounded, and a vector that is no query is sent once.
    """
    rows = picked(df, vec_id=id_column, vector=vector_column)
    there = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("vector")).alias("parts")).first()
    n = max(1, min(GROUPS, -(-there.rows // GROUP_ROWS)), -(-(there.parts or 0) // GROUP_PARTS))
    rows = rows.select(F.col("vec_id").cast("bigint"), quantised(F.col("vector")).alias("whole"))
    narrow = F.forall("whole", lambda x: F.abs(x) <= NARROW)
    rows = rows.where("vec_id IS NOT NULL AND whole IS NOT NULL").select(
        "vec_id",
        F.when(narrow, F.col("whole").cast("array<int>")).alias("q"),
        F.when(~narrow, F.col("whole")).alias("w"),
    )
    rows = rows.dropDuplicates(["vec_id", "q", "w"])

    def to(group: Column, query: bool) -> Column:
        return F.struct(group.cast("int").alias("group"), F.lit(query).alias("query"))

    one = F.array(to(F.pmod(F.xxhash64("vec_id", "q", "w"), F.lit(n)), False))
    each = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda group: to(group, True))
    places = F.when(F.col("vec_id") % every == 0, F.concat(one, each)).otherwise(one)
    dealt = rows.select(F.explode(places).alias("to"), "vec_id", "q", "w").select("to.*", "vec_id", "q", "w")
    ordered = dealt.repartitionById(n, "group").sortWithinPartitions("group", "query")
    shard_rows, query_rows = SHARD_ROWS, QUERY_ROWS

    def search(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, number = Group(shard_rows), -1
        for batch in stream:
            places = 2 * batch["group"].to_numpy().astype(np.int64) + batch["query"].to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.diff(places, prepend=-1))
            for start, end in zip(starts, np.append(starts[1:], len(places))):
                if number != places[start] // 2:
                    group, number = Group(shard_rows), places[start] // 2
                part = batch.slice(start, end - start)
                if not places[start] % 2:
                    group.add(part)
                    continue
                for name in ("q", "w"):
                    queries = part.filter(part[name].is_valid())
                    for at in range(0, queries.num_rows, query_rows):
                        block = queries.slice(at, query_rows)
                        for found in _found(group.all(), block["vec_id"].to_numpy(), _matrix(block[name]), k):
                            arrays = [pa.array(c, kind) for c, kind in zip(found, (pa.int64(), pa.int64(), pa.decimal128(DIGITS, 0)))]
                            yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])

    found = ordered.mapInArrow(search, f"query_id bigint, vec_id bigint, score decimal({DIGITS},0)")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


MAXSCORE_SQL = """
    WITH v AS (
        SELECT vec_id, [CAST(floor(256 * x::DOUBLE) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
    ), c AS (SELECT vec_id, unnest(q) AS x, generate_subscripts(q, 1) AS d FROM v
    ), s AS (
        SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
        FROM c a JOIN c b ON a.d = b.d AND a.vec_id <> b.vec_id
        WHERE a.vec_id % 50 = 0 GROUP BY a.vec_id, b.vec_id
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    WHERE rank <= 5
"""
