"""Removal of repeated passages, exact to the byte, by sorting sampled suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier in the
corpus. Sorting all suffixes would show this, and a difference cover lets a sample of
them be sorted first, provided that any two equal strings meet the sample at a common
offset. Here the sample is drawn by content: a window of ``LENGTH`` bytes is held by the
least of the hashes of its ``GRAM``-byte substrings, its anchor, which depends on the
window alone. So equal windows have their anchor at one offset, and the anchors are a
few hundredths of all suffixes instead of two thirds.

1. An anchor stands for the windows that it holds, a run of text, its context. Anchors
   that occur once hold no repeat. Where a whole context occurs again, all windows of the
   later one are repeats.
2. What remains are contexts that agree in their anchor and differ elsewhere. The sampled
   suffixes are named by blocks and sorted by their triples of names. Three blocks reach
   as far as a window does, so names need no further recursion.
3. The remaining suffixes, those of the windows, begin a few bytes before their anchor:
   they are merged by the order of these bytes, read backwards, and the place of the
   sampled suffix. Prefixes shared with the neighbour in either order give, for each
   offset, the classes of equal windows; all but the earliest of a class are repeats.

Everything moves by anchor, so no document, key or group meets one task as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keygroup.llm.common import picked
from keygroup.workspace import materialise

LENGTH = 100
GRAM = 36
HELD = LENGTH - GRAM + 1
# Bytes of text whose anchors are found at a time; positions within fit 24 bits.
CHUNK = 1_000_000
# Contexts of one anchor that are sorted in memory; more are compared window by window.
CONTEXTS = 40_000
_PRIME = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_WORDS = np.random.default_rng(3).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _power(k: int) -> np.uint64:
    return np.uint64(pow(_PRIME, k, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def _grams(codes: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hashes of all substrings of ``length``, put together from powers of two."""
    n, done, out, power, size = len(codes), 0, None, codes, 1
    while length >> (size.bit_length() - 1):
        if length & size:
            part = power[done : n - length + done + 1]
            out = part.copy() if out is None else out * _power(size) + part
            done += size
        if length >= 2 * size:
            power = power[:-size] * _power(size) + power[size:]
        size *= 2
    return out


def anchors(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of documents laid end to end: their hash, first and last window, place, context hash.

    ``ends`` are the documents' ends. Windows do not cross them.
    """
    empty = np.zeros(0, np.int64)
    n = len(text)
    starts = np.concatenate([[0], ends[:-1]])
    if n < LENGTH:
        return np.zeros(0, np.uint64), empty, empty, empty, np.zeros(0, np.uint64)
    codes = _WORDS[text]
    grams = _mixed(_grams(codes, GRAM))
    low = np.uint64((1 << 24) - 1)
    ranked = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    least, size = ranked, 1
    while 2 * size <= HELD:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < HELD:
        least = np.minimum(least[: len(least) - (HELD - size)], least[HELD - size :])
    place = (least & low).astype(np.int64)
    # Windows that stay inside their document.
    edge = np.zeros(n + 1, np.int32)
    long = ends - starts >= LENGTH
    np.add.at(edge, starts[long], 1)
    np.add.at(edge, ends[long] - LENGTH + 1, -1)
    inside = np.cumsum(edge)[: len(place)] > 0
    turn = np.ones(len(place), bool)
    turn[1:] = (place[1:] != place[:-1]) | (inside[1:] != inside[:-1])
    # Documents that touch each other end a run, too.
    turn[starts[long]] = True
    first = np.flatnonzero(turn & inside)
    bounds = np.append(np.flatnonzero(turn), len(place))
    last = bounds[np.searchsorted(bounds, first) + 1] - 1
    at = place[first]
    powers = np.full(n, _power(1), np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers, dtype=np.uint64)])
    inverse = np.uint64(pow(_PRIME, -1, 1 << 64))
    # Sums are shifted to a common power by the inverse of the power at their start.
    context = (sums[last + LENGTH] - sums[first]) * _inverse_powers(first, inverse)
    shape = ((at - first) * 128 + (last - first)).astype(np.uint64)
    return grams[at], first, last, at, _mixed(context ^ (shape * np.uint64(_PRIME)))


def _inverse_powers(exponents: np.ndarray, base: np.uint64) -> np.ndarray:
    out, power, e = np.ones(len(exponents), np.uint64), base, exponents.copy()
    while e.any():
        odd = (e & 1).astype(bool)
        out[odd] *= power
        power = np.uint64(int(power) * int(power) & _MASK)
        e >>= 1
    return out


# -- 1: anchors and whole contexts ------------------------------------------------

# A row is an anchor's occurrence, or, with a negative shape, a run of repeated bytes.
_OCCURRENCES = "h bigint, ctx bigint, ord bigint, s int, shape int"


def _occurrences(texts: DataFrame) -> DataFrame:
    """Anchors of all texts (``ord``, ``body``), copies within a chunk already resolved."""

    def resolved(orders: list[int], bases: list[int], bodies: list[bytes]) -> pa.RecordBatch:
        sizes = np.array([len(b) for b in bodies])
        ends = np.cumsum(sizes)
        h, first, last, at, ctx = anchors(np.frombuffer(b"".join(bodies), np.uint8), ends)
        doc = np.searchsorted(ends, first, side="right")
        order = np.array(orders, np.int64)[doc]
        begin = first - (ends - sizes)[doc] + np.array(bases)[doc]
        shape = (at - first) * 128 + (last - first)
        h, ctx = h.view(np.int64), ctx.view(np.int64)
        by = np.lexsort((begin, order, ctx, h))
        again = np.zeros(len(by), bool)
        again[1:] = (h[by[1:]] == h[by[:-1]]) & (ctx[by[1:]] == ctx[by[:-1]])
        repeat = by[again]
        shape[repeat] = -(last[repeat] - first[repeat] + LENGTH)
        # Runs of repeats go where their document hashes to, not to a hot anchor.
        h[repeat], ctx[repeat] = _mixed(order[repeat].view(np.uint64)).view(np.int64), 0
        return pa.RecordBatch.from_arrays(
            [pa.array(h), pa.array(ctx), pa.array(order), pa.array(begin.astype(np.int32)), pa.array(shape.astype(np.int32))],
            names=["h", "ctx", "ord", "s", "shape"],
        )

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, bases, bodies, size = [], [], [], 0
        for whole in stream:
            for i in range(whole.num_rows):
                body = whole.column(1)[i].as_py()
                # A text longer than a chunk is cut, overlapping so that no window is lost.
                for base in range(0, max(1, len(body) - LENGTH + 1), CHUNK):
                    piece = body[base : base + CHUNK + LENGTH - 1]
                    if size and size + len(piece) > CHUNK:
                        yield resolved(orders, bases, bodies)
                        orders, bases, bodies, size = [], [], [], 0
                    orders.append(whole.column(0)[i].as_py())
                    bases.append(base)
                    bodies.append(piece)
                    size += len(piece)
        if bodies:
            yield resolved(orders, bases, bodies)

    return texts.select("ord", "body").mapInArrow(run, _OCCURRENCES)


def _sifted(occurrences: DataFrame) -> DataFrame:
    """Repeated runs, and the first occurrence of each context of anchors with several."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, told = None, None, False
        for whole in stream:
            if not whole.num_rows:
                continue
            h, ctx = whole.column(0).to_numpy(), whole.column(1).to_numpy()
            shape = whole.column(4).to_numpy().copy()
            plain = shape >= 0
            at = np.flatnonzero(plain)
            out = np.flatnonzero(~plain)
            emitted = [whole.take(pa.array(out))]
            if len(at):
                new_h, new_ctx = np.ones(len(at), bool), np.ones(len(at), bool)
                new_h[1:] = h[at[1:]] != h[at[:-1]]
                new_ctx[1:] = new_h[1:] | (ctx[at[1:]] != ctx[at[:-1]])
                if last is not None and h[at[0]] == last[0]:
                    new_h[0] = False
                    new_ctx[0] = ctx[at[0]] != last[1]
                repeat = at[~new_ctx]
                shape[repeat] = -(shape[repeat] % 128 + LENGTH)
                first = at[new_ctx]
                # First occurrences of contexts with another context of their anchor beside them.
                joins = ~new_h[new_ctx]
                several = joins.copy()
                several[:-1] |= joins[1:]
                if len(first) and joins[0] and held is not None and not told:
                    emitted.append(held)
                if len(first):
                    held = whole.slice(int(first[-1]), 1)
                    told = bool(several[-1])
                    keep = first[several]
                else:
                    keep = first
                last = h[at[-1]], ctx[at[-1]]
                chosen = np.concatenate([repeat, keep])
                arrays = [whole.column(i) for i in range(4)] + [pa.array(shape)]
                emitted.append(pa.RecordBatch.from_arrays(arrays, names=whole.schema.names).take(pa.array(chosen)))
            for part in emitted:
                if part.num_rows:
                    yield part

    n = int(occurrences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = occurrences.repartition(n, "h").sortWithinPartitions("h", "ctx", "ord", "s")
    return ordered.mapInArrow(run, _OCCURRENCES)


# -- 2 and 3: contexts that differ ------------------------------------------------


def _contexts(sifted: DataFrame, texts: DataFrame) -> DataFrame:
    """The bytes of the contexts to compare: ``h, ord, s, shape, body``."""
    wanted = sifted.where("shape >= 0").groupBy("ord").agg(F.collect_list(F.struct("h", "s", "shape")).alias("wanted"))
    met = texts.join(wanted, "ord").select("ord", "body", "wanted")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in stream:
            for at in range(whole.num_rows):
                order, body = whole.column(0)[at].as_py(), whole.column(1)[at].as_py()
                wanted = whole.column(2)[at].values
                h, s, shape = (wanted.field(i) for i in range(3))
                cuts = [body[x : x + y % 128 + LENGTH] for x, y in zip(s.to_pylist(), shape.to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [h, pa.array([order] * len(cuts), pa.int64()), s, shape, pa.array(cuts, pa.binary())],
                    names=["h", "ord", "s", "shape", "body"],
                )

    return met.mapInArrow(run, "h bigint, ord bigint, s int, shape int, body binary")


def _words(rows: np.ndarray) -> list[np.ndarray]:
    """Byte rows as big-endian numbers of eight bytes, in reading order."""
    width = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), width), np.uint8)
    padded[:, : rows.shape[1]] = rows
    return list(padded.view(">u8").astype(np.uint64).T)


def _names(words: list[np.ndarray]) -> np.ndarray:
    """Ranks of rows, equal for equal rows."""
    by = np.lexsort(words[::-1])
    new = np.zeros(len(by), bool)
    for word in words:
        new[1:] |= word[by[1:]] != word[by[:-1]]
    out = np.zeros(len(by), np.int64)
    out[by] = np.cumsum(new)
    return out


def _shared(rows: np.ndarray, by: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Bytes that each row shares with the one before it in the order; none across groups."""
    out = np.full(len(by), -1, np.int64)
    for at in range(1, len(by), 50_000):
        a, b = by[at : at + 50_000], by[at - 1 : at - 1 + len(by[at : at + 50_000])]
        differs = rows[a] != rows[b]
        common = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
        out[at : at + len(a)] = np.where(groups[a] == groups[b], common, -1)
    return out


def repeated_windows(
    groups: np.ndarray, order: np.ndarray, start: np.ndarray, shape: np.ndarray, bodies: list[bytes]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of repeated windows among contexts with the same anchor: row, first and last offset."""
    m = len(bodies)
    lead, held = shape // 128, shape % 128
    right, left = np.zeros((m, LENGTH), np.uint8), np.zeros((m, HELD), np.uint8)
    for i, body in enumerate(bodies):
        row = np.frombuffer(body, np.uint8)
        tail = row[lead[i] : lead[i] + LENGTH]
        right[i, : len(tail)] = tail
        left[i, : lead[i]] = row[: lead[i]][::-1]
    # The sampled suffixes, by triples of the names of their blocks.
    blocks = [_names(_words(right[:, at : at + GRAM])) for at in range(0, LENGTH, GRAM)]
    by_right = np.lexsort((*blocks[::-1], groups))
    by_left = np.lexsort((*_words(left)[::-1], groups))
    shared_right, shared_left = _shared(right, by_right, groups), _shared(left, by_left, groups)
    earliest = np.empty(m, np.int64)
    earliest[np.lexsort((start + lead, order))] = np.arange(m)

    repeat = np.zeros((m, HELD + 1), bool)
    class_right, class_left = np.empty(m, np.int64), np.empty(m, np.int64)
    for back in range(HELD):
        some = np.flatnonzero((lead >= back) & (lead - held <= back))
        if len(some) < 2:
            continue
        class_right[by_right] = np.cumsum(shared_right < LENGTH - back)
        class_left[by_left] = np.cumsum(shared_left < back)
        by = some[np.lexsort((earliest[some], class_left[some], class_right[some]))]
        again = np.zeros(len(by), bool)
        again[1:] = (class_right[by[1:]] == class_right[by[:-1]]) & (class_left[by[1:]] == class_left[by[:-1]])
        repeat[by[again], back] = True
    # Runs of neighbouring offsets; a larger offset is an earlier window.
    padded = np.concatenate([np.zeros((m, 1), bool), repeat], axis=1)
    row, begin = np.nonzero(padded[:, 1:] & ~padded[:, :-1])
    _, end = np.nonzero(padded[:, :-1] & ~padded[:, 1:])
    return row, lead[row] - (end - 1), lead[row] - begin


def _compared(contexts: DataFrame) -> DataFrame:
    """Repeated runs ``ord, lo, hi``; windows of very common anchors as ``window, ord, lo``."""

    def settled(rows: pa.Table) -> pa.RecordBatch:
        order, start = rows.column("ord").to_numpy(), rows.column("s").to_numpy().astype(np.int64)
        row, first, last = repeated_windows(
            rows.column("h").to_numpy(), order, start, rows.column("shape").to_numpy().astype(np.int64),
            rows.column("body").to_pylist(),
        )
        lo = start[row] + first
        return _runs([b""] * len(row), order[row], lo, start[row] + last + LENGTH)

    def spelled(rows: pa.Table) -> pa.RecordBatch:
        found: list[tuple] = []
        for order, start, shape, body in zip(*(rows.column(c).to_pylist() for c in ("ord", "s", "shape", "body"))):
            for i in range(shape % 128 + 1):
                window = hashlib.blake2b(body[i : i + LENGTH], digest_size=16).digest()
                found.append((window, order, start + i, start + i + LENGTH))
        windows, orders, lo, hi = zip(*found)
        return _runs(list(windows), np.array(orders), np.array(lo), np.array(hi))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, common = 0, None
        for whole in stream:
            at = 0
            while at < whole.num_rows:
                h = whole.column(0).to_numpy()
                if common is not None and h[at] == common:
                    stop = at + int(np.searchsorted(h[at:] != common, True)) if (h[at:] != common).any() else len(h)
                    yield spelled(pa.Table.from_batches([whole.slice(at, stop - at)]))
                    at = stop
                    continue
                held.append(whole.slice(at))
                size += whole.num_rows - at
                at = whole.num_rows
                if size > CONTEXTS:
                    table = pa.Table.from_batches(held).combine_chunks()
                    values = table.column("h").to_numpy()
                    cut = int(np.searchsorted(values, values[-1]))
                    if cut:
                        yield settled(table.slice(0, cut))
                    held, size = table.slice(cut).to_batches(), len(values) - cut
                    if size > CONTEXTS:
                        common = values[-1]
                        yield spelled(table.slice(cut))
                        held, size = [], 0
        if size:
            yield settled(pa.Table.from_batches(held).combine_chunks())

    n = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = contexts.repartition(n, "h").sortWithinPartitions("h")
    return ordered.mapInArrow(run, "window binary, ord bigint, lo int, hi int")


def _runs(windows: list[bytes], order: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(windows, pa.binary()), pa.array(order, pa.int64()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())],
        names=["window", "ord", "lo", "hi"],
    )


# -- the operator -----------------------------------------------------------------


def repeated_runs(texts: DataFrame) -> DataFrame:
    """Runs of bytes to remove, ``ord, lo, hi``, which may overlap, from ``ord, body``."""
    sifted = materialise(_sifted(_occurrences(texts)), "repeats-sifted")
    compared = materialise(_compared(_contexts(sifted, texts)), "repeats-runs")
    common = compared.where(F.length("window") > 0)
    first = common.groupBy("window").agg(F.min(F.struct("ord", "lo")).alias("first"))
    later = common.join(first, "window").where(F.struct("ord", "lo") > F.col("first"))
    whole = sifted.where("shape < 0").select("ord", F.col("s").alias("lo"), (F.col("s") - F.col("shape")).alias("hi"))
    return whole.unionByName(compared.where(F.length("window") == 0).drop("window")).unionByName(later.select("ord", "lo", "hi"))


def _ordered(rows: DataFrame) -> DataFrame:
    """``ord``, a number in the order of the ids, beside ``doc_id`` and ``body``.

    Whole numbers that are unique serve themselves. Otherwise rows are sorted by id, nulls
    first, and text, and numbered; the numbers are written down, since they must not change.
    """
    if dict(rows.dtypes)["doc_id"] in ("tinyint", "smallint", "int", "bigint"):
        per_id = rows.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1")
        if not per_id.limit(1).count():
            return rows.select(F.col("doc_id").cast("bigint").alias("ord"), "doc_id", "body")
    numbered = rows.repartitionByRange("doc_id", F.md5("body")).sortWithinPartitions("doc_id", F.md5("body"))
    return materialise(numbered.select(F.monotonically_increasing_id().alias("ord"), "doc_id", "body"), "repeats-order")


def without_repeats(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` (as the id column), ``n_bytes``, ``spans`` and ``kept``, one row per row.

    ``spans`` are the maximal removed runs, ``start, stop`` in bytes; ``kept`` are the other
    bytes, joined. Earlier means a smaller id or, in one document, an earlier start. Rows
    with equal or null ids come in the order of the digests of their texts, null ids first;
    of repeated rows any one is the first. Null texts are empty; texts of less than
    ``LENGTH`` bytes lose nothing. Other columns are left out; an empty table gives no rows.
    """
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = picked(df, doc_id=id_column, text=text_column).select("doc_id", body.alias("body"))
    texts = _ordered(rows)
    runs = repeated_runs(texts.where(F.length("body") >= LENGTH).select("ord", "body"))
    lists = runs.groupBy("ord").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    met = texts.join(lists, "ord", "left").select("doc_id", "body", "runs")
    key = met.schema["doc_id"].dataType.simpleString()

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in stream:
            for at in range(0, whole.num_rows, 256):
                part = whole.slice(at, 256)
                sizes, spans, kept = [], [], []
                for i in range(part.num_rows):
                    body, runs = part.column(1)[i].as_py(), part.column(2)[i]
                    merged: list[dict] = []
                    if runs.is_valid:
                        lo, hi = (runs.values.field(j).to_numpy() for j in range(2))
                        by = np.argsort(lo, kind="stable")
                        lo, reach = lo[by], np.maximum.accumulate(hi[by])
                        cut = np.flatnonzero(np.append(True, lo[1:] > reach[:-1]))
                        ends = reach[np.append(cut[1:] - 1, len(lo) - 1)]
                        merged = [{"start": int(a), "stop": int(b)} for a, b in zip(lo[cut], ends)]
                    sizes.append(len(body))
                    spans.append(merged)
                    edges = [0, *(x for span in merged for x in (span["start"], span["stop"])), len(body)]
                    kept.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2])))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                        pa.array(kept, pa.binary()),
                    ],
                    names=["doc_id", "n_bytes", "spans", "kept"],
                )

    return met.mapInArrow(
        run, f"doc_id {key}, n_bytes bigint, spans array<struct<start:int,stop:int>>, kept binary"
    )
