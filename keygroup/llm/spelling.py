"""Words grouped with the commoner spelling from which they differ by one character.

Two words one edit apart have letter counts a squared distance of one (a character more or
less) or two (one replaced) apart. So words are put in blocks by how many letters they
have of each of a few groups of letters, which also fixes their length; only blocks one
letter more, or one letter exchanged, can hold near words. A task holds one block, or a
part of it, as a matrix of letter counts, and multiplies it with the matrices of these
neighbours as they stream by: the Gram products give all squared distances, the few pairs
at one or two are compared character by character.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keygroup.llm.common import batch, picked
from keygroup.operators.hot import BROADCAST_BYTES, ROW_BYTES
from keygroup.workspace import materialise

WORD = "[A-Za-z\\u00C0-\\u00FF]+"
LEAST_LENGTH, LEAST_COUNT = 5, 3
# A form is at least this many times as common as the word that follows it.
COMMONER = 2
# Groups of letters, of about the same share in texts; what is in none of them is a last group.
LETTERS = ("ed", "ts", "ao", "ing", "hrl")
# Words of a block that a task holds, and words that it compares with them at a time.
PART_WORDS, CHUNK_WORDS = 4_096, 2_048
# Bound to the numbers that a chunk of compared words takes.
_CELLS = 1 << 22


def words_of(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word, n``: the words of the texts, with planted faults, and how often they occur.

    Words are runs of letters, with A to Z in lower case. Where 97 divides the checksum of
    ``id:word``, the character at its remainder by the length is left out. Null texts have no
    words, null ids are written as nothing. Counts are joined before they are shuffled, so
    a word with a third of all occurrences costs no more than another.
    """
    rows = picked(df, doc_id=id_column, text=text_column)
    upper = "".join(map(chr, range(65, 91)))
    found = rows.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"({WORD})"), 1)).alias("run"))
    found = found.select("doc_id", F.translate("run", upper, upper.lower()).alias("run"))
    # Copies of a run in a document share their checksum, so its faults as well.
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    sums = found.withColumn("h", F.crc32(F.concat(text_id, F.lit(":"), F.col("run"))))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = sums.select(F.when(F.col("h") % 97 == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))


def _block(word: Column) -> Column:
    """Numbers of letters of each group, the rest last."""
    kept = [F.length(word) - F.length(F.translate(word, group, "")) for group in LETTERS]
    return F.array(*kept, F.length(word) - reduce(lambda a, b: a + b, kept))


def _homes(block: Column) -> Column:
    """Blocks whose words a word is compared with: its own, and those that differ by one edit.

    Of two neighbouring blocks one is the home of the pair: the shorter words', or for equal
    lengths the one with the letter of the later group.
    """
    n = len(LETTERS) + 1
    steps = [[0] * n]
    for i in range(n):
        steps.append([-(i == k) for k in range(n)])
        steps.extend([(k == j) - (k == i) for k in range(n)] for j in range(i + 1, n))
    moved = [F.array(*(block[k] + F.lit(step[k]) for k in range(n))) for step in steps]
    # No word has fewer than no letters of a group.
    return F.filter(F.array(*moved), lambda b: F.forall(b, lambda x: x >= 0))


def near_words(words: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """``word, n, n_near, form, form_n`` for every row of ``words`` (``word, n``, distinct).

    Near words differ by one character inserted, deleted or replaced. The form is the near
    word of largest ``n`` (ties: the first by code points) if that is ``COMMONER`` times the
    word's. Words must consist of code points up to U+FFFF; an empty table gives no rows.

    A block of more than ``PART_WORDS`` words is cut by a hash into parts, each a task of its
    own with the neighbours sent to every part: exact, with bounded memory, and for words of
    a single block quadratic in its parts.
    """
    spark = words.sparkSession
    words = materialise(words.select("word", "n", _block(F.col("word")).alias("block")), "words", paths)
    sizes = words.groupBy("block").agg(F.ceil(F.count("*") / F.lit(PART_WORDS)).cast("int").alias("parts"))
    sizes = materialise(sizes, "blocks", paths)
    if sizes.count() * ROW_BYTES * 2 <= BROADCAST_BYTES:
        sizes = F.broadcast(sizes)
    own = words.join(sizes, "block").withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    held = own.select("block", "part", F.lit(0).alias("side"), "word", "n")
    # A pair within one block belongs to the part of lower number, pairs within one part to it alone.
    guests = words.select("word", "n", F.col("block").alias("from"), F.explode(_homes(F.col("block"))).alias("block"))
    guests = guests.join(sizes, "block").withColumn("at", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    last = F.when(F.col("from") == F.col("block"), F.col("at")).otherwise(F.col("parts")) - 1
    guests = guests.where("`from` <> block OR at > 0").withColumn("part", F.explode(F.sequence(F.lit(0), last)))
    sides = held.unionByName(guests.select("block", "part", F.lit(1).alias("side"), "word", "n"))

    kinds = "word string, n_near bigint, form string, form_n bigint"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    task = F.concat_ws(":", F.concat_ws(",", "block"), "part").alias("task")
    ordered = sides.select(task, "side", "word", "n").repartition(n, "task").sortWithinPartitions("task", "side", "word")
    links = ordered.mapInArrow(_compare, kinds)
    # The largest count, then the first word: counts fall, words rise.
    order = F.struct((-F.col("form_n")).alias("c"), F.col("form").alias("w"))
    best = links.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(order).alias("best"))
    common = F.when(-F.col("best.c") >= F.col("n") * COMMONER, F.col("best.w"))
    return words.drop("block").join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), common.alias("form"),
        F.when(common.isNotNull(), -F.col("best.c")).alias("form_n"),
    )


class _Words:
    """Words as characters, letter counts and occurrences, by length."""

    def __init__(self, words: list[str], n: np.ndarray):
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.by_length = {}
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            text = "".join([words[i] for i in at])
            codes = np.frombuffer(text.encode("utf-16-le"), np.uint16).reshape(len(at), length)
            self.by_length[int(length)] = (at, codes)
        self.words, self.n = words, n


def _counts(codes: np.ndarray, column: np.ndarray, width: int) -> np.ndarray:
    """Letter counts, a row per word; exact in doubles, as are products of words up to 2^26 letters."""
    rows = np.repeat(np.arange(len(codes)), codes.shape[1])
    flat = np.bincount(rows * width + column[codes.ravel()], minlength=len(codes) * width)
    return flat.reshape(len(codes), width).astype(np.float32 if codes.shape[1] < 2_000 else np.float64)


def _near(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of ``a`` and ``b`` one edit apart; ``b`` is as long, or one longer.

    Squared distances of letter counts come from one product: with half the squared length
    of either side in a column of its own, it is minus half the distance.
    """
    present = np.unique(np.concatenate([np.unique(a), np.unique(b)]))
    column = np.zeros(int(present[-1]) + 1, np.int64)
    column[present] = np.arange(len(present))
    x, longer = _counts(a, column, len(present)), b.shape[1] - a.shape[1]
    left = np.column_stack([x, -0.5 * (x * x).sum(1), np.ones(len(x), x.dtype)]).astype(x.dtype)
    step = max(1, min(CHUNK_WORDS, _CELLS // max(1, len(a))))
    for start in range(0, len(b), step):
        part = b[start : start + step]
        y = _counts(part, column, len(present))
        right = np.column_stack([y, np.ones(len(y), y.dtype), -0.5 * (y * y).sum(1)]).astype(y.dtype)
        # Equal lengths differ in an even number, others in an odd one.
        i, j = np.nonzero(left @ right.T == (-0.5 if longer else -1.0))
        room = max(1, _CELLS // a.shape[1])
        for at in range(0, len(i), room):
            p, q = i[at : at + room], j[at : at + room]
            here, there = a[p], part[q]
            if longer:
                # All but one character lie in a common beginning and a common end.
                head = np.cumprod(here == there[:, :-1], axis=1, dtype=np.int8).sum(1, dtype=np.int64)
                tail = np.cumprod((here == there[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(1, dtype=np.int64)
                near = head + tail >= a.shape[1]
            else:
                near = (here != there).sum(1) == 1
            yield p[near], q[near] + start


def _compare(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of the two sides of every task, as counts and best forms of either word.

    Words of a side come in code-point order, so their place is their rank.
    """
    out = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())])
    task = current = None
    held: list[tuple] = []
    guests: list[tuple] = []
    ready: list[tuple] = []

    def best(words: _Words, i: np.ndarray, forms: _Words, j: np.ndarray) -> None:
        """For every word in ``i`` the number of its pairs and the best of their forms."""
        order = np.lexsort((j, -forms.n[j], i))
        i, j = i[order], j[order]
        first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
        number = np.diff(np.r_[first, len(i)])
        ready.extend(
            zip([words.words[k] for k in i[first]], number.tolist(), [forms.words[k] for k in j[first]],
                forms.n[j[first]].tolist())
        )

    def among(words: _Words) -> None:
        for at, codes in words.by_length.values():
            for p, q in _near(codes, codes):
                p, q = at[p[p < q]], at[q[p < q]]
                if len(p):
                    best(words, p, words, q)
                    best(words, q, words, p)

    def between(words: _Words, others: _Words) -> None:
        for length, (at, codes) in words.by_length.items():
            for other in (length, length + 1):
                if other in others.by_length:
                    to, more = others.by_length[other]
                    for p, q in _near(codes, more):
                        if len(p):
                            best(words, at[p], others, to[q])
                            best(others, to[q], words, at[p])

    def settle(everything: bool) -> None:
        """Compare what a task holds: itself once, then the guests so far."""
        nonlocal current, guests
        if current is None and held:
            current = _Words(*_columns(held))
            among(current)
        if guests and (everything or sum(len(w) for w, _ in guests) >= CHUNK_WORDS):
            if current is not None:
                between(current, _Words(*_columns(guests)))
            guests = []

    for whole in stream:
        tasks, sides = whole.column(0).to_pylist(), np.asarray(whole.column(1))
        words, numbers = whole.column(2).to_pylist(), np.asarray(whole.column(3))
        # Stretches of one task and side, in their order.
        cuts = [k for k in range(1, len(tasks)) if tasks[k] != tasks[k - 1] or sides[k] != sides[k - 1]]
        for a, b in zip([0, *cuts], [*cuts, len(tasks)]):
            if tasks[a] != task:
                settle(True)
                task, held, current = tasks[a], [], None
            if sides[a] == 0:
                held.append((words[a:b], numbers[a:b]))
            else:
                guests.append((words[a:b], numbers[a:b]))
                settle(False)
        if len(ready) >= 4_096:
            yield batch(out, ready)
            ready = []
    settle(True)
    if ready:
        yield batch(out, ready)


def _columns(stretches: list[tuple[list[str], np.ndarray]]) -> tuple[list[str], np.ndarray]:
    return [w for words, _ in stretches for w in words], np.concatenate([n for _, n in stretches])


def with_roots(found: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """Add ``root``, the last word that forms lead to; the word itself if it has none.

    A form is at least twice as common as its word, so chains are short and never close.
    Every round doubles the steps taken and is written to the shared folder.
    """
    links = materialise(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "forms", paths)
    while True:
        ahead = links.select(F.col("word").alias("at"), F.col("root").alias("further"))
        moved = links.join(ahead, F.col("root") == F.col("at"), "left")
        moved = moved.select("word", F.coalesce("further", "root").alias("root"), F.col("at").isNotNull().alias("on"))
        moved = materialise(moved, "roots", paths)
        links = moved.drop("on")
        if moved.where("on").isEmpty():
            break
    return found.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", paths: list[str] | None = None
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the words of ``words_of`` with three occurrences.

    Null and empty texts have no words, repeated rows count each, other columns are left
    out, whatever their names, and an empty table gives no rows.
    """
    words = words_of(df, id_column, text_column).where(F.col("n") >= LEAST_COUNT)
    found = materialise(near_words(words, paths), "near-words", paths)
    return with_roots(found, paths).select("word", "form", "root", "n", "n_near", "form_n")
