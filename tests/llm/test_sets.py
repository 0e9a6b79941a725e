"""Mixing, search, links, near-duplicates and repeats, against brute force; the registry."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from keygroup.llm import hnsw, maxscore, mixing, neardup, registry, repeats
from keygroup.llm.components import components


def components_of(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)]
    links += [(400, 500 + i) for i in range(60)] + [(i, i + 1) for i in range(700, 760)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = components_of({x for l in links for x in l}, links)
    assert got == {n: c for n, c in expected.items() if any(n in l and l[0] != l[1] for l in links)}


# -- mixing -------------------------------------------------------------------------


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_queries_match_their_sql(spark, name):
    got = registry.queries()[name](spark, SF)
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = connection.sql(registry.oracle_sql()[name])
    order = [expected.columns.index(c) for c in got.columns]
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert rows == sorted((tuple(r[i] for i in order) for r in expected.fetchall()), key=repr) and rows


def test_a_mix_takes_what_is_due(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(1, 30), rng.choice(["a"] * 6 + ["b", "c", "d", None]), "s") for i in range(600)]
    rows += [(None, None, "a", "s"), (601, "", "e", "s"), (602, "x y", "b", "s"), (602, "x y", "b", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, SIZE string")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
        assert 0 <= r.copies <= 2
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for source in sizes:
        assert target[source] <= 2 * sizes[source] + 1e-9 and abs(taken[source] - target[source]) <= 60
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(df.repartition(5)).collect()), key=repr)
    assert mixing.mix(df.limit(0)).count() == 0


# -- vectors ------------------------------------------------------------------------

NAN, INF = float("nan"), float("inf")


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, label int, score int")


def test_top_k_is_exact(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 40)
    monkeypatch.setattr(maxscore, "QUERY_ROWS", 3)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.3, 6).astype(np.float32).tolist(), 0) for i in range(400)]
    rows += [(400, [0.0] * 6, 0), (401, None, 0), (450, [NAN] * 6, 0), (500, [INF] + [0.0] * 5, 0), (550, [None] * 6, 0),
             (None, [1.0] * 6, 0), (600, [0.5, -0.5], 0), (600, [0.5, -0.5], 0), (650, [], 0), (651, [1e30] * 6, 0)]
    used = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            used[i] = [int(min(max(np.floor(256 * float(np.float32(x))), -maxscore.LARGEST), maxscore.LARGEST)) for x in v]
    expected = []
    for q in (i for i in used if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(used[q], used[i])), i) for i in used if i != q)[:5]
        expected += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores)]
    assert sorted(map(tuple, maxscore.top_k(vectors(spark, rows)).collect())) == sorted(expected)
    assert maxscore.top_k(vectors(spark, [(50, [1.0], 0)])).count() == 0
    assert maxscore.top_k(vectors(spark, [])).count() == 0


def test_top_k_does_not_clip(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 20)
    rng = np.random.default_rng(14)
    scale = [1.0, 1e5, 262_145.0, 3e6, 1e12, 1e16]
    v = [(rng.normal(0, 1, 5) * scale[i % 6]).astype(np.float32).tolist() for i in range(120)]
    # The largest floats have no term in common with a query, which would make scores too long.
    v[0][0] = v[50][0] = 0.0
    v[100] = [0.0, 1e16, 0.5, 262_145.0, -3e6]
    rows = [(i, x, 0) for i, x in enumerate(v)] + [(201 + i, [3e38, 0.0, 1.0 + i, 0.0, -1.0], 0) for i in range(3)]
    used = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v, _ in rows}
    expected = []
    for q in (0, 50, 100):
        scores = sorted((-sum(a * b for a, b in zip(used[q], used[i])), i) for i in used if i != q)[:5]
        expected += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores)]
    assert sorted(map(tuple, maxscore.top_k(vectors(spark, rows)).collect())) == sorted(expected)
    with pytest.raises(Exception, match="more than 38 digits"):
        maxscore.top_k(vectors(spark, [(0, [3e38], 0), (1, [3e38], 0)])).collect()


def test_top_k_sends_no_blocks_to_the_driver(spark, monkeypatch):
    # Spark takes a binary column for a hundred bytes, and so broadcast blocks of any size.
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 16)
    monkeypatch.setattr(maxscore, "QUERY_ROWS", 2)
    monkeypatch.setattr(maxscore, "GROUP_ROWS", 50, raising=False)
    rng = np.random.default_rng(6)
    x = np.where(rng.random((430, 9)) < 0.4, rng.gamma(0.3, 2, (430, 9)), 0).astype(np.float32)
    rows = [(i, x[i].tolist(), 0) for i in range(400)] + [(399, x[i].tolist(), 0) for i in range(400, 410)]
    rows += rows[:50] + [(1_000 + i, x[100].tolist(), 0) for i in range(60)]
    found = maxscore.top_k(vectors(spark, rows), every=10)
    plan = found._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "Join" not in plan and "Broadcast" not in plan
    whole = {(i, tuple(int(np.floor(256 * c)) for c in v)) for i, v, _ in rows}
    expected = []
    for q in {i for i, _ in whole if i % 10 == 0}:
        own = next(v for i, v in whole if i == q)
        scores = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in whole if i != q)[:5]
        expected += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores)]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    empty = [(50, 1, 51, 0), (50, 2, 52, 0)]
    assert sorted(map(tuple, maxscore.top_k(vectors(spark, [(50, [], 0), (51, [], 0), (52, [], 0)])).collect())) == empty


@pytest.mark.parametrize("scale", [40, 5_000, 20_000_000, 60_000_000])
@pytest.mark.parametrize("dense", [0.05, 0.3, 1.0])
def test_shards_find_the_best_scores(scale, dense):
    rng = np.random.default_rng(7)
    shape = (40, 900)
    signs = 1 if dense == 0.3 else rng.choice([1, -1], shape)
    postings = (np.where(rng.random(shape) < dense, rng.pareto(1.2, shape), 0).clip(0, 9) / 9 * scale * signs).astype(np.int32)
    postings[:, 300:420] = postings[:, [7]]
    ids = rng.permutation(880)[np.arange(900) % 880]
    own, queries = ids[::45], postings[:33, ::45]
    best, kinds = maxscore.Best(own, 4), set()
    for at in range(0, 900, 250):
        shard = maxscore.Shard(ids[at : at + 250], postings[:, at : at + 250])
        kinds.add(kind := shard.kind(queries))
        shard.search(best, queries, kind)
    assert kinds == {np.float32 if scale == 40 else np.float64 if scale == 5_000 else np.int64}
    scores = queries.T.astype(object) @ postings[:33].astype(object)
    for n, one in enumerate(own):
        expected = sorted((-s, i) for s, i in zip(scores[n], ids) if i != one)[:4]
        assert list(zip(-best.scores[n], best.ids[n])) == expected


def test_links_of_vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (12, 8))
    rows = [(i, (centres[i % 12] + rng.normal(0, 0.22, 8)).astype(np.float32).tolist(), i % 2) for i in range(500)]
    rows += [(500 + i, rows[0][1], 0) for i in range(5)] + [(600, None, 0), (601, [0.0] * 8, 0), (602, [NAN] * 8, 0),
             (603, rows[0][1], None), (604, [1.0], 0), (None, rows[0][1], 0), (605, [1e-30] * 8, 1), (606, [1e30] * 8, 1)]
    unit = {i: np.array(v, float) for i, v, l in rows if i is not None and v is not None and l is not None
            and np.isfinite(v).all() and np.any(v)}
    unit = {i: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for i, v in unit.items()}
    label = {r[0]: r[2] for r in rows}
    links = [(a, b) for a in unit for b in unit if a < b and label[a] == label[b] and len(unit[a]) == len(unit[b])
             and unit[a] @ unit[b] >= hnsw.COSINE]
    count = defaultdict(int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    root = components_of([r[0] for r in rows if r[0] is not None], links)
    got = hnsw.near_vectors(vectors(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is not None:
            assert (r.n_links, r.component_id, r.kept) == (count[r.vec_id], root[r.vec_id], root[r.vec_id] == r.vec_id)
    assert hnsw.near_vectors(vectors(spark, [])).count() == 0


def test_recall_of_the_graph():
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 1, (60, 32))
    v = hnsw.units((centres[rng.integers(0, 60, 3000)] + rng.normal(0, 0.2, (3000, 32)))).astype(np.float32)
    graph = hnsw.Graph(v)
    truth = v @ v.T >= hnsw.COSINE
    ids, sims = graph.search(v, hnsw.BEAM)
    assert (ids[:, 0] == np.arange(3000)).mean() > 0.95
    q, c = graph.within(v, hnsw.COSINE)
    hit = np.zeros_like(truth)
    hit[q, c] = True
    assert (hit & truth).sum() >= 0.99 * truth.sum()


@pytest.mark.parametrize("share, hot_queries", [(0.01, 0), (0.3, 1365)])
def test_sparse_links_beside_a_hot_cluster_are_found(share, hot_queries):
    rng = np.random.default_rng(3)
    v, q = rng.normal(0, 1, (4096, 64)), rng.normal(0, 1, (4096, 64))
    hot, others = rng.normal(0, 1, 64), np.arange(1365, 4096)
    linked = rng.permutation(others)[: int(share * 4096)]
    q[linked] = v[rng.choice(others, len(linked))] + rng.normal(0, 0.2, (len(linked), 64))
    v[:1365] = hot + rng.normal(0, 0.12, (1365, 64))
    q[:hot_queries] = hot + rng.normal(0, 0.12, (hot_queries, 64))
    # Vectors come in any order, as shards deal them.
    v, q = (hnsw.units(rng.permutation(x)).astype(np.float32) for x in (v, q))
    truth = q @ v.T >= hnsw.COSINE
    few = truth.sum(axis=1) <= 64
    hit = np.zeros_like(truth)
    hit[hnsw.Graph(v).within(q, hnsw.COSINE)] = True
    assert (hit & truth)[few].sum() >= 0.999 * truth[few].sum() > 0
    assert (hit & truth).sum() >= 0.999 * truth.sum()


def test_links_in_a_label_of_many_shards(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 250)
    monkeypatch.setattr(hnsw, "QUERY_ROWS", 400)
    rng = np.random.default_rng(13)
    v = rng.normal(0, 1, (3000, 32))
    v[2900:] = v[:100] + rng.normal(0, 0.2, (100, 32))
    v[:1000] = v[0] + rng.normal(0, 0.12, (1000, 32))
    rows = [(i, x, 0) for i, x in enumerate(v.astype(np.float32).tolist())]
    unit = hnsw.units(v.astype(np.float32).astype(float))
    count = (unit @ unit.T >= hnsw.COSINE).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in hnsw.near_vectors(vectors(spark, rows)).collect()}
    assert sum(got.values()) >= 0.999 * count.sum()
    assert sum(got[i] for i in range(1000, 3000)) >= 0.999 * count[1000:].sum()


# -- near-duplicates ----------------------------------------------------------------


def corpus(seed, n=160):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    bases = [[word() for _ in range(rng.randrange(3, 120))] for _ in range(20)]
    texts = []
    for _ in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = word()
        texts.append(" ".join(words))
    return texts


def test_draws_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(7)
    keys = rng.integers(0, 1 << 62, 4000).astype(np.uint64)
    keys.sort()
    w = rng.gamma(2, 1, 4000)
    a, b = (keys[:3000], w[:3000]), (keys[600:], w[600:] * 1.1)
    sampler = neardup.Sampler()
    true = neardup.similarity(a, b)
    rounds = []
    for i in range(40):
        mixed = [((k * np.uint64(2 * i + 1)), v) for k, v in (a, b)]
        drawn = sampler.draws(mixed)
        rounds.append((drawn[0] == drawn[1]).mean())
    assert abs(np.mean(rounds) - true) < 0.05


@pytest.mark.parametrize("block", [2_000, 4_000_000])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK_BYTES", block)
    texts = corpus(1) + ["", "", "!!", None, None, "one two", "one two!", "q " * 30_000]
    rows = [(i, t, "s", "c") for i, t in enumerate(texts)] + [(0, texts[0], "s", "c"), (None, texts[1], "s", "c"), (None, "alone here", "s", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, CLASS_ID string")
    words = neardup.Words()
    idf = neardup.word_weights(df.where("text IS NOT NULL").select("text"))
    sets = {i: words.shingles(words.hashes(t or ""), idf) for i, t in enumerate(texts)}
    links = [(a, b) for a in sets for b in sets if a < b and (
        neardup.similarity(sets[a], sets[b]) >= 0.8 or texts[a] is not None and texts[a] == texts[b])]
    root = components_of(range(len(texts)), links)
    got = neardup.near_duplicates(df).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "text", "source", "class_id", "kept"}
    kept = defaultdict(int)
    for r in got:
        if r.doc_id is not None:
            assert r.class_id == root[r.doc_id], (r.doc_id, r.text)
        kept[r.class_id] += r.kept
    assert set(kept.values()) == {1} and kept.keys() == {*root.values(), None}
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_chunks_of_a_large_band_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CHUNK", 4)
    rng = np.random.default_rng(12)
    draws = np.sort(rng.integers(1, 1 << 24, (11, neardup.DRAWS)).astype(">i4"), axis=0)
    # The second and the last in order have most draws in common, and none with others.
    draws[1, 10:] = draws[-1, 10:]
    rows = [(7, bytes([i]), bytearray(d.tobytes())) for i, d in enumerate(draws)] + [(8, bytes([i]), bytearray(draws[i].tobytes())) for i in (2, 3)]
    pairs = neardup.closest(spark.createDataFrame(rows, "band long, node binary, draws binary"))
    root = components_of([bytes([i]) for i in range(11)], [(bytes(r.a), bytes(r.b)) for r in pairs.collect()])
    assert root[bytes([1])] == root[bytes([10])]
    assert len(set(root.values())) == 1


def test_near_duplicates_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CHUNK", 3)
    texts = [t for t in corpus(2) if len(t) > 200]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = neardup.Words()
    idf = neardup.word_weights(df.select("text"))
    sets = [words.shingles(words.hashes(t), idf) for t in texts]
    n = range(len(texts))
    root = components_of(n, [(a, b) for a in n for b in n if a < b and neardup.similarity(sets[a], sets[b]) >= 0.8])
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()} == root


# -- repeats ------------------------------------------------------------------------


def removed(texts):
    seen, out = set(), []
    for body in texts:
        gone = np.zeros(len(body), bool)
        for i in range(len(body) - repeats.LENGTH + 1):
            window = body[i : i + repeats.LENGTH]
            gone[i : i + repeats.LENGTH] |= window in seen
            seen.add(window)
        out.append(gone)
    return out


@pytest.mark.parametrize("contexts, chunk", [(40_000, 1_000_000), (3, 700)])
def test_repeats_are_exact(spark, monkeypatch, contexts, chunk):
    monkeypatch.setattr(repeats, "CONTEXTS", contexts)
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    rng = random.Random(8)
    bases = ["".join(rng.choice("abé ") for _ in range(rng.randrange(60, 400))) for _ in range(6)]
    texts = [None, "", "x" * 99, "y" * 1500]
    for _ in range(120):
        parts = []
        for _ in range(rng.randrange(4)):
            base = rng.choice(bases)
            parts += [base[rng.randrange(len(base)) :], rng.choice(["", "-", "a" * 120, "zz" + str(rng.random())])]
        texts.append("".join(parts))
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, KEPT string")
    got = {r.doc_id: r for r in repeats.without_repeats(df).collect()}
    bodies = [(t or "").encode() for t in texts]
    for i, gone in enumerate(removed(bodies)):
        row = got[i]
        kept = np.frombuffer(bodies[i], np.uint8)[~gone].tobytes()
        assert (row.n_bytes, bytes(row.kept)) == (len(bodies[i]), kept)
        flags = np.zeros(len(bodies[i]), bool)
        for span in row.spans:
            flags[span.start : span.stop] = True
        assert (flags == gone).all() and len(row.spans) == (np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()
    assert repeats.without_repeats(df.limit(0)).count() == 0


def test_repeats_with_ids_that_tell_nothing(spark):
    rng = random.Random(9)
    body = "".join(rng.choice("abcdefgh") for _ in range(300))
    rows = [(None, body), (None, body), (7, body), (7, "short")]
    got = repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(len(r.kept) for r in got) == [0, 0, 5, 300]


# -- the pipeline -------------------------------------------------------------------


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, columns = docs, docs.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).cache()
        assert after.columns == columns, name
        ids = after.select("doc_id").distinct()
        assert ids.join(before, "doc_id", "left_anti").count() == 0
        counts.append(after.count())
        before = after
    assert counts[0] > counts[1] > counts[2] == counts[3] < counts[4] <= 2 * counts[3]
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert last.count() == counts[-1] and last.where("n_tokens < 1 OR n_corrected > 0").count() == 0
    digest = lambda t: hashlib.sha256(t.replace("▁", " ").encode()).hexdigest()
    texts = sorted((r.doc_id, digest(r.text)) for r in before.select("doc_id", "text").collect())
    assert sorted((r.doc_id, r.decoded_sha256) for r in last.collect()) == texts


def test_stages_keep_columns_named_like_their_own(spark):
    import corpus_pipeline

    named = ["copy", "SIZE", "source_size", "target", "copies", "found", "Class_Id", "kept", "_own5"]
    docs = spark.range(40).selectExpr(
        "id AS doc_id", "'s' AS source", "concat('some text of ', id, ' at 10.0.0.', id) AS text", "1L AS n_chars",
        *(f"concat('{name} ', id) AS {name}" for name in named),
    )
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        rows = after.collect()
        assert rows and all(r[c] == f"{c} {r.doc_id}" for r in rows for c in named), name


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in registry.queries()) == list(range(1, 14))
