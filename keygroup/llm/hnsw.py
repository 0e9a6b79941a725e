"""Links between similar vectors by hierarchical navigable small-world graphs.

Vectors of one label are dealt to shards of bounded size, and each shard gets a graph:
every vector has up to ``DEGREE`` near neighbours on its layers, each layer holds a
sixteenth of the one below. Every vector of the label is looked up in every shard by a
greedy descent and a beam search on the ground layer, and from what it finds within the
threshold the search goes on to neighbours within it, so a vector with more links than
the beam has places loses none. Lookups are audited against brute force, by queries that
have links in the shard; while links are missed the beam is widened, up to a plain scan,
and where links are too few to audit by, the shard is scanned. What is found is verified
by cosine in double precision, and links are united to components.

Equal vectors are one vector with a count: copies meet no task twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keygroup.llm.common import picked
from keygroup.llm.components import components
from keygroup.workspace import materialise

COSINE = 0.93
SHARD_ROWS = 4_096
QUERY_ROWS = 4_096
DEGREE, BEAM = 16, 32
# Queries that have links, but few, by which a beam is judged, and the least mean recall.
AUDITED, FEW, RECALL = 256, 64, 0.999
WIDEST = 4 * BEAM
BATCH = 256


def usable(vector: Column) -> Column:
    """Not null, not zero, and of finite components only."""
    wide = vector.cast("array<double>")
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(wide, lambda x: x != 0), F.lit(False))


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


class Graph:
    """A navigable small-world graph over unit vectors, built by batches of insertions."""

    def __init__(self, vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM, seed: int = 1):
        self.vectors, self.degree = vectors, degree
        n = len(vectors)
        rng = np.random.default_rng(seed)
        # The height of a vector falls off by a sixteenth a layer; the first is highest.
        heights = np.minimum(np.floor(-np.log(1 - rng.random(n)) / np.log(degree)).astype(int), 6)
        heights[:1] = heights.max(initial=0)
        # Missing neighbours are n, a row of zeros that no search goes to.
        self.padded = np.vstack([vectors, np.zeros((1, vectors.shape[1]), vectors.dtype)])
        tall = heights.max(initial=0) + 1
        self.layers = [np.full((n, degree * (2 if layer == 0 else 1)), n) for layer in range(tall)]
        self.nearness = [np.full(links.shape, -2.0, np.float32) for links in self.layers]
        self.back: tuple[np.ndarray, np.ndarray] | None = None
        done = 1
        while done < n:
            stop = min(n, done + min(BATCH, max(1, done)))
            new = np.arange(done, stop)
            entry = np.zeros(len(new), int)
            for layer in range(len(self.layers) - 1, -1, -1):
                here = heights[new] >= layer
                found, _ = self._search(layer, vectors[new], entry[:, None], beam if here.any() else 1, done)
                entry = np.where(found[:, 0] < n, found[:, 0], entry)
                if here.any():
                    self._link(layer, new[here], found[here])
            done = stop

    def _link(self, layer: int, new: np.ndarray, found: np.ndarray) -> None:
        links, n = self.layers[layer], len(self.vectors)
        # Vectors of one batch do not find each other by search; they are compared at once.
        peers = np.broadcast_to(new, (len(new), len(new)))
        both = np.concatenate([found, peers], axis=1)
        sims = np.einsum("qcd,qd->qc", self.padded[both], self.vectors[new])
        sims[(both == new[:, None]) | (both == n)] = -2
        order = np.argsort(-sims, axis=1)
        both, sims = np.take_along_axis(both, order, axis=1), np.take_along_axis(sims, order, axis=1)
        nearness, most = self.nearness[layer], links.shape[1]
        for i, one in enumerate(new):
            some = sims[i] > -2
            picked_ids, picked_sims = self._spread(both[i][some][: 3 * most], sims[i][some][: 3 * most], most)
            links[one, : len(picked_ids)] = picked_ids
            nearness[one, : len(picked_ids)] = picked_sims
            # Links back take a free place or that of the least near neighbour.
            worst = nearness[picked_ids].argmin(axis=1)
            better = picked_sims > nearness[picked_ids, worst]
            new_to = ~(links[picked_ids] == one).any(axis=1) & better
            links[picked_ids[new_to], worst[new_to]] = one
            nearness[picked_ids[new_to], worst[new_to]] = picked_sims[new_to]

    def _spread(self, candidates: np.ndarray, sims: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """First those nearer to the centre than to any chosen before, then the nearest rest."""
        if len(candidates) > most:
            among = self.vectors[candidates] @ self.vectors[candidates].T
            cover = np.full(len(candidates), -2.0)
            chosen, rest = [], []
            for i in range(len(candidates)):
                if cover[i] < sims[i] and len(chosen) < most:
                    chosen.append(i)
                    np.maximum(cover, among[i], out=cover)
                else:
                    rest.append(i)
            keep = np.array(chosen + rest[: most - len(chosen)])
            candidates, sims = candidates[keep], sims[keep]
        return candidates, sims

    def _search(
        self, layer: int, queries: np.ndarray, entries: np.ndarray, beam: int, known: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Best ``beam`` ids and similarities per query among the first ``known`` vectors, best first."""
        links, n = self.layers[layer], len(self.vectors)
        m = len(queries)
        rows = np.arange(m)
        ids = np.full((m, beam + 1), n)
        sims = np.full((m, beam + 1), -2.0, queries.dtype)
        entries = entries[:, :beam]
        ids[:, : entries.shape[1]] = entries
        near = np.einsum("qcd,qd->qc", self.padded[entries], queries)
        sims[:, : entries.shape[1]] = np.where(entries < n, near, -2)
        expanded = np.zeros((m, beam + 1), bool)
        seen = np.zeros((m, n + 1), bool)
        seen[rows[:, None], entries] = True
        active = rows
        while len(active):
            open_sims = np.where(expanded[active] | (ids[active] == n), -3.0, sims[active])[:, :beam]
            at = open_sims.argmax(axis=1)
            going = open_sims[np.arange(len(active)), at] > -3
            active, at = active[going], at[going]
            if not len(active):
                break
            expanded[active, at] = True
            around = links[ids[active, at]]
            fresh = ~seen[active[:, None], around] & (around < known)
            seen[active[:, None], around] = True
            around = np.where(fresh, around, n)
            near = np.einsum("qcd,qd->qc", self.padded[around], queries[active])
            near[~fresh] = -2
            all_ids = np.concatenate([ids[active, :beam], around], axis=1)
            all_sims = np.concatenate([sims[active, :beam], near], axis=1)
            all_done = np.concatenate([expanded[active, :beam], np.zeros(around.shape, bool)], axis=1)
            order = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[active, :beam] = np.take_along_axis(all_ids, order, axis=1)
            sims[active, :beam] = np.take_along_axis(all_sims, order, axis=1)
            expanded[active, :beam] = np.take_along_axis(all_done, order, axis=1)
        return ids[:, :beam], sims[:, :beam]

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        entries = np.zeros((len(queries), 1), int)
        n = len(self.vectors)
        for layer in range(len(self.layers) - 1, -1, -1):
            # Half a beam above the ground gives it several places to start from.
            entries, sims = self._search(layer, queries, entries, min(beam if layer == 0 else -(-beam // 2), n), n)
        return entries, sims

    def _backward(self) -> tuple[np.ndarray, np.ndarray]:
        """The links of the ground layer by their target: where each target's begin, and their sources."""
        if self.back is None:
            n = len(self.vectors)
            targets = self.layers[0].ravel()
            sources = np.repeat(np.arange(n), self.layers[0].shape[1])[np.argsort(targets, kind="stable")]
            starts = np.searchsorted(np.sort(targets), np.arange(n + 1))
            self.back = starts, sources
        return self.back

    def _spread_out(
        self, queries: np.ndarray, ids: np.ndarray, sims: np.ndarray, least: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query and a vector at least so similar: those found, their neighbours, and so on."""
        links, n = self.layers[0], len(self.vectors)
        starts, sources = self._backward()
        seen = np.zeros((len(queries), n + 1), bool)
        seen[:, n] = True
        q, c = np.nonzero((sims >= least) & (ids < n))
        c = ids[q, c]
        seen[q, c] = True
        left, right = [q], [c]
        while len(q):
            around = links[c]
            flat = (q[:, None] * (n + 1) + around)[~seen[q[:, None], around]]
            # A vector that none of its neighbours has room for is found from them all the same.
            counts = starts[c + 1] - starts[c]
            at = np.repeat(starts[c] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            back, of = sources[at], np.repeat(q, counts)
            fresh = ~seen[of, back]
            flat = np.unique(np.concatenate([flat, of[fresh] * (n + 1) + back[fresh]]))
            q, c = flat // (n + 1), flat % (n + 1)
            seen[q, c] = True
            near = np.concatenate([
                np.einsum("nd,nd->n", queries[q[i : i + 65536]], self.vectors[c[i : i + 65536]])
                for i in range(0, len(q), 65536)
            ] or [np.zeros(0)]) >= least
            q, c = q[near], c[near]
            left.append(q)
            right.append(c)
        return np.concatenate(left), np.concatenate(right)

    def within(self, queries: np.ndarray, least: float, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query and a vector that are at least so similar, by audited beams.

        Queries are drawn at random and scanned until ``AUDITED`` of them have seen links,
        but no more than ``FEW``; a query's own vector, at its place ``own`` or -1, is none.
        Beams are judged by the mean recall of these queries, and apart from them of those
        with more links, which would outnumber all others. What was scanned is settled: where
        links are too sparse for an audit, that is every query.
        """
        n = len(self.vectors)
        margin = least - 1e-4
        own = np.full(len(queries), -1) if own is None else own
        left, right = [np.zeros(0, int)], [np.zeros(0, int)]

        def scan(some: np.ndarray) -> np.ndarray:
            """How many links each of some queries has; their pairs are taken."""
            sims = queries[some] @ self.vectors.T
            q, c = np.nonzero(sims >= margin)
            left.append(some[q])
            right.append(c)
            return np.bincount(q[(sims[q, c] >= least) & (c != own[some[q]])], minlength=len(some))

        order = np.random.default_rng(2).permutation(len(queries))
        few, many = np.zeros(0, int), np.zeros(0, int)
        at = 0
        while at < len(order) and len(few) < AUDITED:
            some = order[at : at + BATCH]
            links = scan(some)
            few = np.append(few, some[(links > 0) & (links <= FEW)])
            many = np.append(many, some[links > FEW])
            at += len(some)
        rest = order[at:]
        beam = BEAM
        if len(rest):
            audit = np.append(few[:AUDITED], many[:BATCH])
            truth = queries[audit] @ self.vectors.T >= least
            truth[np.flatnonzero(own[audit] >= 0), own[audit][own[audit] >= 0]] = False
            while beam <= WIDEST and 4 * beam < n:
                q, c = self._spread_out(queries[audit], *self.search(queries[audit], beam), margin)
                hit = np.zeros(truth.shape, bool)
                hit[q, c] = True
                recall = (truth & hit).sum(axis=1) / truth.sum(axis=1)
                if min(part.mean() for part in (recall[:AUDITED], recall[AUDITED:]) if len(part)) >= RECALL:
                    break
                beam *= 2
        for at in range(0, len(rest), BATCH):
            some = rest[at : at + BATCH]
            if beam > WIDEST or 4 * beam >= n:
                # Wider beams cost more than a plain scan.
                scan(some)
            else:
                q, c = self._spread_out(queries[some], *self.search(queries[some], beam), margin)
                left.append(some[q])
                right.append(c)
        return np.concatenate(left), np.concatenate(right)


def _packed(rows: DataFrame, sizes: DataFrame, size: int, salt: int, kind: int) -> DataFrame:
    """Rows of up to about ``size`` vectors of one label, packed: a part with its number."""
    number = F.pmod(F.xxhash64("node", F.lit(salt)), F.ceil(F.col("rows") / size)).cast("int")
    dealt = rows.join(sizes, ["label", "width"]).withColumn("part", number)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            "label": [pdf["label"].iloc[0]],
            "width": [pdf["width"].iloc[0]],
            "rows": [pdf["rows"].iloc[0]],
            "part": [pdf["part"].iloc[0]],
            "kind": [kind],
            "nodes": [b"".join(pdf["node"])],
            "counts": [pdf["n"].to_numpy(np.int64).tobytes()],
            "values": [np.array(pdf["v"].tolist(), np.float64).tobytes()],
        })

    schema = "label string, width int, rows bigint, part int, kind int, nodes binary, counts binary, values binary"
    return dealt.groupBy("label", "width", "part").applyInPandas(pack, schema)


def _searched(rows: DataFrame) -> DataFrame:
    """Per node and shard: ``node``, ``root`` (a node it is connected with), ``n`` links.

    Every block of queries goes to every shard of its label. The graph of a shard is
    built once, by the task that gets the shard and, behind it, the blocks.
    """
    sizes = materialise(rows.groupBy("label", "width").agg(F.count("*").alias("rows")), "hnsw-sizes")
    shards = _packed(rows, sizes, SHARD_ROWS, 1, 0).withColumn("shard", F.col("part"))
    last = (F.ceil(F.col("rows") / SHARD_ROWS) - 1).cast("int")
    blocks = _packed(rows, sizes, QUERY_ROWS, 2, 1).withColumn("shard", F.explode(F.sequence(F.lit(0), last)))
    place = F.xxhash64("label", "width", "shard").alias("place")
    met = shards.unionByName(blocks).select(place, "kind", "part", "width", "nodes", "counts", "values")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.repartition(n, "place").sortWithinPartitions("place", "kind", "part")

    def run(stream: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        graph = None
        for pdf in stream:
            for row in pdf.itertuples():
                names = np.frombuffer(row.nodes, np.dtype("V16"))
                values = np.frombuffer(row.values, np.float64).reshape(len(names), -1)
                if row.kind == 0:
                    shard, counts = (names, units(values)), np.frombuffer(row.counts, np.int64)
                    graph = Graph(shard[1].astype(np.float32))
                    places = {name.tobytes(): at for at, name in enumerate(names)}
                    continue
                own = units(values)
                at = np.array([places.get(name.tobytes(), -1) for name in names])
                left, right = graph.within(own.astype(np.float32), COSINE, at)
                exact = np.einsum("nd,nd->n", own[left], shard[1][right])
                true = (exact >= COSINE) & (names[left] != shard[0][right])
                left, right = left[true], right[true]
                if len(left):
                    yield _forest(names, shard[0], counts, left, right)

    return met.mapInPandas(run, "node binary, root binary, n bigint")


def _forest(names: np.ndarray, others: np.ndarray, counts: np.ndarray, left: np.ndarray, right: np.ndarray) -> pd.DataFrame:
    """Links as one row per node that they connect, and the link counts of the queries."""
    mark, far = np.arange(len(names)), np.full(len(others), len(names))
    while True:
        before = mark.copy()
        np.minimum.at(far, right, mark[left])
        np.minimum.at(mark, left, far[right])
        if (mark == before).all():
            break
    n = np.bincount(left, counts[right], len(names)).astype(np.int64)
    linked, met = np.flatnonzero(n), np.flatnonzero(far < len(names))
    nodes = [names[i].tobytes() for i in linked] + [others[i].tobytes() for i in met]
    roots = [names[i].tobytes() for i in np.concatenate([mark[linked], far[met]])]
    return pd.DataFrame({"node": nodes, "root": roots, "n": np.concatenate([n[linked], np.zeros(len(met), np.int64)])})


def near_vectors(
    df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label"
) -> DataFrame:
    """``vec_id`` (as the id column), ``n_links``, ``component_id``, ``kept``: one row per row.

    Vectors are linked if their labels are equal and their cosine is ``COSINE`` or more.
    Null vectors, zero vectors, vectors with a null or non-finite component, rows without
    label and rows without id are linked with nothing; vectors of different lengths are
    not compared. Rows with one id, label and vector count as one vector. ``component_id``
    is the smallest id reachable by links, the row's own if it has none; ``kept`` says that
    it is the row's own. Other columns are left out; an empty table gives no rows.
    """
    rows = picked(df, vec_id=id_column, vector=vector_column, label=label_column)
    good = usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    label = F.col("label").cast("string")
    code = F.concat_ws("|", label, F.array_join(F.col("vector").cast("array<string>"), ","))
    named = rows.select("vec_id", F.when(good, F.unhex(F.md5(code))).alias("node"), label.alias("label"), "vector")
    members = materialise(named.where("node IS NOT NULL").select("node", "vec_id").distinct(), "hnsw-members")
    counts = members.groupBy("node").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    distinct = named.where("node IS NOT NULL").groupBy("node").agg(
        F.first("label").alias("label"), F.first("vector").cast("array<double>").alias("v")
    )
    distinct = materialise(distinct.join(counts, "node").withColumn("width", F.size("v")), "hnsw-vectors")

    found = materialise(_searched(distinct.select("node", "label", "width", "v", "n")), "hnsw-links")
    parts = components(found.where("node <> root").select("node", "root"), "hnsw-parts")
    links = found.groupBy("node").agg(F.sum("n").alias("n_far"))
    whole = (
        distinct.select("node", "n", "first").join(links, "node", "left").join(parts, "node", "left")
        .select("node", "n", "first", F.coalesce("n_far", F.lit(0)).alias("n_far"), F.coalesce("component", "node").alias("part"))
    )
    least = whole.groupBy("part").agg(F.min("first").alias("component_id"))
    # Copies of a vector are linked with each other, and each with all that one of them is.
    told = whole.join(least, "part").select(
        F.col("node").alias("of"), (F.col("n_far") + F.col("n") - 1).alias("n_links"), "component_id"
    )
    joined = named.select("vec_id", "node").join(told, F.col("node") == F.col("of"), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
