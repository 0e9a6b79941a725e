"""Near-duplicate documents by consistent weighted sampling.

A document is a weighted set of shingles of five words; the weight of a shingle is its
count times the mean inverse document frequency of its words. (Frequencies of whole
shingles would grow with a group of copies and so pull its members apart; those of
words hardly do.) Word frequencies are counted over all documents, in a fixed number
of hash buckets.

Improved consistent weighted sampling draws, per hash function, one pair of a shingle
and a quantised weight; two documents draw the same pair with the probability of their
weighted Jaccard similarity. Draws are joined to bands; documents with a common band are
candidates, candidates whose draws mostly differ are passed over, and the rest are
verified by their true weighted Jaccard similarity.

Within a band no list of all pairs is made. A maximal spanning tree on the number of
common draws has the same connected parts as all pairs with enough of them. Parts are
dealt to tasks whole or, where one is large, in pairs of blocks, and a task searches its
texts by true similarity: from each text found, what it has not reached yet.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keygroup.llm.common import others
from keygroup.llm.components import components
from keygroup.names import quoted
from keygroup.workspace import materialise

SHINGLE = 5
SIMILARITY = 0.8
BANDS, BAND_DRAWS = 10, 3
DRAWS = BANDS * BAND_DRAWS
# Two documents at the least similarity have fewer common draws with probability 1e-5.
COMMON_DRAWS = 14
WORD_BUCKETS = 1 << 20
# Documents of one band that one task compares with each other at a time.
CHUNK = 2_048
# Hash buckets of documents, of which those with candidates are broadcast.
NODE_BUCKETS = 1 << 20
# Bytes of text in one block of a large part; a task gets two blocks.
BLOCK_BYTES = 4_000_000
REMEMBERED = 150_000
_WORD = re.compile(r"\w+")
_TABLE = 1 << 12


def _tables() -> tuple[np.ndarray, ...]:
    """Quantiles of the distributions that the sampling draws from."""
    at = (np.arange(_TABLE) + 0.5) / _TABLE
    # Gamma(2, 1): its distribution function 1 - (1 + x) exp(-x) is inverted by bisection.
    low, high = np.zeros(_TABLE), np.full(_TABLE, 60.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - (1 + middle) * np.exp(-middle) < at
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return low, 1 / low, np.log(low), at


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Words:
    """Hashes of words, and of the shingles of texts."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}
        self.factors = _odd(5, SHINGLE)

    def hashes(self, text: str) -> np.ndarray:
        """A hash per word of the text, in order."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        found = []
        for word in _WORD.findall(text.lower()):
            value = known.get(word)
            if value is None:
                code = word.encode()
                value = known[word] = zlib.crc32(code) << 32 | zlib.crc32(code, 0x5BD1E995)
            found.append(value)
        return np.array(found, np.uint64)

    def shingles(self, hashes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles and their weights; a shorter text is one shingle."""
        n = len(hashes)
        if not n:
            return np.zeros(0, np.uint64), np.zeros(0)
        weights = idf[(hashes & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)]
        width = min(SHINGLE, n)
        count = n - width + 1
        mixed = np.zeros(count, np.uint64)
        weight = np.zeros(count)
        for i in range(width):
            mixed += hashes[i : i + count] * self.factors[i]
            weight += weights[i : i + count]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        distinct, first, times = np.unique(mixed, return_index=True, return_counts=True)
        return distinct, weight[first] / width * times


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two weighted sets; 0 if one is empty."""
    (xs, xw), (ys, yw) = a, b
    if not len(xs) or not len(ys):
        return 0.0
    at = np.searchsorted(ys, xs)
    at[at == len(ys)] = 0
    same = ys[at] == xs
    least = float(np.minimum(xw[same], yw[at[same]]).sum())
    return least / (float(xw.sum()) + float(yw.sum()) - least)


class Sampler:
    """Draws of consistent weighted sampling for many sets at a time."""

    def __init__(self) -> None:
        self.r, self.inverse_r, self.log_r, self.beta = _tables()
        self.mixers = _odd(11, DRAWS)

    def draws(self, sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """A matrix of draws, one row per set; sets must not be empty."""
        starts = np.concatenate([[0], np.cumsum([len(s) for s, _ in sets])])
        shingles = np.concatenate([s for s, _ in sets])
        log_w = np.log(np.concatenate([w for _, w in sets]))
        out = np.zeros((len(sets), DRAWS), np.int32)
        sizes = np.diff(starts)
        shift, low = np.uint64(12), np.uint64(_TABLE - 1)
        for k in range(DRAWS):
            mixed = shingles * self.mixers[k]
            mixed ^= mixed >> np.uint64(31)
            i = (mixed & low).astype(np.int64)
            mixed >>= shift
            j = (mixed & low).astype(np.int64)
            mixed >>= shift
            r, beta = self.r[i], self.beta[j]
            level = np.floor(log_w * self.inverse_r[i] + beta)
            # log of c / (y exp r), where log y = r (level - beta); c is gamma like r.
            key = self.log_r[(mixed & low).astype(np.int64)] - r * (level - beta + 1)
            least = np.minimum.reduceat(key, starts[:-1])
            hit = np.flatnonzero(key == np.repeat(least, sizes))
            of = np.searchsorted(starts, hit, side="right") - 1
            one = hit[np.concatenate([[True], of[1:] != of[:-1]])]
            drawn = (shingles[one] ^ (level[one].astype(np.int64).astype(np.uint64) << np.uint64(17))) * self.mixers[k]
            out[:, k] = (drawn >> np.uint64(33)).astype(np.int32)
        return out


# -- passes over the texts --------------------------------------------------------


def word_weights(texts: DataFrame) -> np.ndarray:
    """Inverse document frequency per word bucket, ``log(1 + N / n)``, over all texts.

    The counts are summed per task before they are shuffled; there are at most
    ``WORD_BUCKETS`` of them, and only these come to the driver.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, n = Words(), np.zeros(WORD_BUCKETS, np.int64), 0
        for whole in stream:
            for text in whole.column(0).to_pylist():
                found = words.hashes(text or "")
                n += len(found) > 0
                counts[np.unique(found & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)] += 1
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1)), pa.array(np.append(counts[some], n))], names=["bucket", "n"]
        )

    sums = texts.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    buckets, n = sums.column("bucket").to_numpy(), sums.column("n").to_numpy()
    total = max(1, int(n[buckets < 0].sum()))
    idf = np.full(WORD_BUCKETS, np.log(1 + total))
    idf[buckets[buckets >= 0]] = np.log(1 + total / n[buckets >= 0])
    return idf


def signatures(texts: DataFrame, idf) -> DataFrame:
    """``node`` and packed ``draws`` of the texts that have words; ``idf`` is broadcast."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, sampler, weights = Words(), Sampler(), idf.value
        for whole in stream:
            at = 0
            while at < whole.num_rows:
                nodes, sets, size = [], [], 0
                # Batches of bounded work: one very long text may fill one alone.
                while at < whole.num_rows and size < 60_000:
                    one = words.shingles(words.hashes(whole.column(1)[at].as_py() or ""), weights)
                    if len(one[0]):
                        nodes.append(whole.column(0)[at].as_py())
                        sets.append(one)
                        size += len(one[0])
                    at += 1
                if sets:
                    packed = [row.tobytes() for row in sampler.draws(sets)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes, pa.binary()), pa.array(packed, pa.binary())], names=["node", "draws"]
                    )

    return texts.select("node", "text").mapInArrow(run, "node binary, draws binary")


def banded(signed: DataFrame) -> DataFrame:
    """A row per document and band: ``band``, ``node``, ``draws``."""
    keys = (
        F.xxhash64(F.lit(i), F.substring("draws", 4 * BAND_DRAWS * i + 1, 4 * BAND_DRAWS)) for i in range(BANDS)
    )
    return signed.select(F.explode(F.array(*keys)).alias("band"), "node", "draws")


def _blocks(stream: Iterator[pa.RecordBatch], key: int) -> Iterator[pa.Table]:
    """Consecutive rows with one value in column ``key``, up to ``CHUNK`` at a time."""
    held: list[pa.RecordBatch] = []
    size, current = 0, None
    for whole in stream:
        values = whole.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        for start, stop in zip([0, *cuts], [*cuts, len(values)]):
            while start < stop:
                if size and (values[start] != current or size == CHUNK):
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
                current = values[start]
                part = whole.slice(start, min(stop - start, CHUNK - size))
                held.append(part)
                size += part.num_rows
                start += part.num_rows
    if size:
        yield pa.Table.from_batches(held)


def _matrix(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("draws").to_pylist()), np.int32).reshape(-1, DRAWS)


def _common(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    return (many == one).sum(axis=1)


def closest(bands: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that connect what is connected by pairs of one band with enough common draws.

    In a band of several chunks every document is joined to the first, unseen: that only
    makes a part larger, and takes a row per document.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = [], []
        current, head, chunk = None, None, []
        for table in _blocks(stream, 0):
            band, nodes = table.column("band")[0].as_py(), table.column("node").to_pylist()
            n = len(nodes)
            if band == current:
                # With the second chunk, the documents of the first are joined as well.
                for far in (chunk[1:], nodes):
                    left += [head] * len(far)
                    right += far
                chunk = []
                yield _pairs(left, right)
                left, right = [], []
                continue
            current, head, chunk = band, nodes[0], nodes
            if n == 1:
                continue
            draws = _matrix(table)
            best, via = _common(draws[0], draws), np.zeros(n, np.int64)
            best[0] = -1
            for _ in range(n - 1):
                at = int(best.argmax())
                if best[at] >= COMMON_DRAWS:
                    left.append(nodes[via[at]])
                    right.append(nodes[at])
                best[at] = -1
                common = _common(draws[at], draws)
                closer = (common > best) & (best >= 0)
                best[closer], via[closer] = common[closer], at
            if len(left) > 4096:
                yield _pairs(left, right)
                left, right = [], []
        yield _pairs(left, right)

    ordered = bands.repartition("band").sortWithinPartitions("band", "draws", "node")
    pairs = ordered.mapInArrow(run, "a binary, b binary")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _pairs(left: list[bytes], right: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])


def linked(sets: list[tuple[np.ndarray, np.ndarray]], least: float) -> np.ndarray:
    """Per weighted set the number of the first set that links of ``least`` or more lead to.

    From every set that is reached, the sets not reached yet are compared with it at once.
    """
    n = len(sets)
    root = np.arange(n)
    sizes = np.array([len(x) for x, _ in sets])
    _, index = np.unique(np.concatenate([x for x, _ in sets]), return_inverse=True)
    data = np.concatenate([w for _, w in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    total = np.add.reduceat(data, starts[:-1])
    dense = np.zeros(index.max() + 1)
    alive, at, flat, values = np.arange(n), starts[:-1], index, data
    waiting = np.ones(n, bool)
    for first in range(n):
        if not waiting[first]:
            continue
        waiting[first] = False
        todo = [first]
        while todo:
            one = todo.pop()
            if waiting[alive].sum() < 0.7 * len(alive):
                # Leave out what is reached, so that the rest costs less and less.
                keep = waiting[alive]
                held = np.repeat(keep, sizes[alive])
                flat, values, alive = flat[held], values[held], alive[keep]
                at = np.concatenate([[0], np.cumsum(sizes[alive])])[:-1]
            if not len(alive):
                break
            own = slice(starts[one], starts[one + 1])
            dense[index[own]] = data[own]
            common = np.add.reduceat(np.minimum(dense[flat], values), at)
            dense[index[own]] = 0
            near = alive[(common >= least * (total[one] + total[alive] - common)) & waiting[alive]]
            waiting[near] = False
            root[near] = first
            todo += near.tolist()
    return root


def searched(parts: DataFrame, texts: DataFrame, idf, least: float) -> DataFrame:
    """Links ``a, b`` within the parts (``node, component``), by true similarity.

    A part of several blocks is searched two blocks at a time, each pair of them by a
    task of its own, so that no task holds a whole large part and every pair is compared.
    """
    # Most texts belong to no part. Those in none of the hash buckets of the parts stay
    # where they are; there are at most NODE_BUCKETS buckets to send, whatever the input.
    bucket = F.pmod(F.xxhash64("node"), F.lit(NODE_BUCKETS))
    buckets = materialise(parts.select(bucket.alias("bucket")).distinct(), "near-buckets")
    some = texts.join(F.broadcast(buckets), bucket == F.col("bucket"), "left_semi")
    met = materialise(some.join(parts, "node").dropDuplicates(["node"]), "near-texts")
    blocks = F.ceil(F.sum(F.octet_length("text")) / BLOCK_BYTES).cast("int")
    sizes = met.groupBy("component").agg(F.when(blocks > 2, blocks).otherwise(1).alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: i != F.col("own"))
    dealt = met.join(sizes, "component").withColumn("own", own).select(
        "node", "text", "component", "own",
        F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(other)).alias("other"),
    )
    task = F.xxhash64("component", F.least("own", "other"), F.greatest("own", "other"))
    dealt = dealt.select(task.alias("task"), "node", "text")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights = Words(), idf.value
        task, nodes, sets = None, [], []

        def done() -> pa.RecordBatch:
            root = linked(sets, least) if len(sets) > 1 else np.zeros(len(sets), int)
            far = np.flatnonzero(root != np.arange(len(sets)))
            return _pairs([nodes[i] for i in root[far]], [nodes[i] for i in far])

        for whole in stream:
            for i in range(whole.num_rows):
                if whole.column(0)[i].as_py() != task:
                    yield done()
                    task, nodes, sets = whole.column(0)[i].as_py(), [], []
                nodes.append(whole.column(1)[i].as_py())
                sets.append(words.shingles(words.hashes(whole.column(2)[i].as_py()), weights))
        yield done()

    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "task").sortWithinPartitions("task", "node").mapInArrow(run, "a binary, b binary")


# -- the operator -----------------------------------------------------------------


def _node(text: Column) -> Column:
    return F.unhex(F.md5(F.encode(text, "utf-8")))


def near_duplicates(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = SIMILARITY
) -> DataFrame:
    """All rows with ``class_id`` and ``kept``, the mark of one row per class.

    A class holds the rows that links of similarity ``least`` or more connect; its id is
    the smallest id in it, null if it has none. Equal texts are one class, also empty ones
    and those without words, which are linked with nothing else. A row with a null text is
    a class of its own. The row that stays is one with the class id, the same in every
    run, and of repeated rows any one. Input columns with the names of the added ones, in
    any case, are replaced; an empty table gives no rows.
    """
    spark = df.sparkSession
    keep = others(df, ("class_id", "kept"))
    identity, text = F.col(quoted(id_column)), F.col(quoted(text_column))
    every = df.select(identity.alias("id"), text.alias("text")).where("text IS NOT NULL")
    texts = every.select(_node(F.col("text")).alias("node"), "text")
    idf = spark.sparkContext.broadcast(word_weights(every.select("text")))
    signed = materialise(signatures(texts, idf).groupBy("node").agg(F.first("draws").alias("draws")), "near-draws")
    bands = banded(signed)

    parts = components(materialise(closest(bands), "near-pairs"), "near-parts")
    links = materialise(searched(parts, texts, idf, least), "near-links")
    # The links are written, so the weights are of no more use.
    idf.destroy()
    labels = components(links, "near-links")

    rows = df.select(
        *(F.col(quoted(c)) for c in keep), identity.alias("_near_id"), _node(text).alias("_near_node")
    )
    # One row per document and text tells the classes; copies are counted, not listed.
    ids = every.groupBy("id", _node(F.col("text")).alias("node")).agg(F.count("*").alias("n"))
    ids = materialise(ids, "near-ids")
    part = F.coalesce("component", "node").alias("component")
    parts = ids.select("node").distinct().join(labels, "node", "left").select("node", part)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("first")
    heads = ids.join(parts, "node").groupBy("component").agg(first)
    classes = parts.join(heads, "component").select(
        F.col("node").alias("_near_of"), F.col("first.id").alias("class_id"), F.col("first.node").alias("_near_head")
    )
    joined = rows.join(classes, F.col("_near_node") == F.col("_near_of"), "left")
    alone = F.col("_near_node").isNull()
    kept = alone | ((F.col("_near_node") == F.col("_near_head")) & F.col("_near_id").eqNullSafe(F.col("class_id")))
    if ids.where("n > 1").limit(1).count():
        repeats = Window.partitionBy("_near_id", "_near_node").orderBy(F.lit(0))
        kept = kept & (alone | (F.row_number().over(repeats) == 1))
    return joined.select(
        *(F.col(quoted(c)) for c in keep),
        F.when(alone, F.col("_near_id")).otherwise(F.col("class_id")).alias("class_id"),
        kept.alias("kept"),
    )
