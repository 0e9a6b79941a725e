"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms, hashed: its words and, since many languages inflect
insults, the beginnings of its words. Its score is the logistic of a bias, a
weight per term and the inner products of the terms' factors, so that pairs of words,
such as an insult and the mention of a group, count beyond what each adds alone.

The machine is fitted to a bounded sample of labelled documents: ``SAMPLE`` of them, by
hash of the id, each text once. Terms enter it if, in the sample, their share among the
documents of the two labels differs beyond chance; all other terms say nothing.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keygroup.llm.common import picked
from keygroup.names import quoted

SAMPLE = 12_000
TERM_BITS = 22
FACTORS = 4
MAX_TERMS = 4_096
STEPS = 300
RATE = 0.05
DECAY = 3e-3
# Least signed root of the likelihood ratio of a term that enters the machine.
EVIDENCE = 4.0
REMEMBERED = 400_000
# Lengths of the beginnings that are terms; each is part of a longer word.
STEMS = (4, 5, 6)
_WORD = re.compile(r"\w+")


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def terms_of(word: str) -> list[int]:
    """Hashed terms of one word: itself and its beginnings."""
    names = [word, *(f"{word[:n]} {n}" for n in STEMS if len(word) > n)]
    return [zlib.crc32(name.encode()) & ((1 << TERM_BITS) - 1) for name in names]


@dataclass
class Machine:
    """Bias, and per known term a weight and a row of factors."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, starts: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Raw scores of documents whose known terms are ``index``, cut at ``starts``."""
        linear = _sums(self.weights[index], starts)
        chosen = self.factors[index]
        total = _sums(chosen, starts)
        squares = _sums(chosen**2, starts)
        return self.bias + linear + 0.5 * (total**2 - squares).sum(axis=1)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches, which may be empty; ``starts`` ends with the length."""
    running = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    return running[starts[1:]] - running[starts[:-1]]


def logistic(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _selected(documents: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Terms that tell the labels apart, the strongest first cut at ``MAX_TERMS``."""
    n1, n0 = max(1, labels.sum()), max(1, (1 - labels).sum())
    # Term and label in one number, sorted in place: four bytes an occurrence, and nothing
    # the size of all possible terms.
    both = np.concatenate([np.zeros(0, np.int32), *documents])
    both *= 2
    both += np.repeat(labels.astype(np.int32), [len(d) for d in documents])
    both.sort()
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])[: len(both)])
    pairs, times = both[first], np.diff(np.append(first, len(both))).astype(float)
    del both, first
    found, place = np.unique(pairs >> 1, return_inverse=True)
    in1, in0 = (np.bincount(place, np.where((pairs & 1) == one, times, 0), len(found)) for one in (1, 0))
    share = (in1 + in0) / (n1 + n0)

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0)

    ratio = 2 * (
        part(in1, share * n1) + part(n1 - in1, (1 - share) * n1) + part(in0, share * n0) + part(n0 - in0, (1 - share) * n0)
    )
    strength = np.sqrt(np.maximum(ratio, 0))
    strong = np.flatnonzero(strength >= EVIDENCE)
    strong = strong[np.lexsort((found[strong], -strength[strong]))][:MAX_TERMS]
    return np.sort(found[strong])


def fit(documents: list[np.ndarray], labels: np.ndarray) -> Machine:
    """Fit a machine to sets of terms and their labels of 0 and 1.

    Without two labels the bias alone is fitted.
    """
    labels = labels.astype(float)
    terms = _selected(documents, labels)
    rate = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-3, 1 - 1e-3))
    rng = np.random.default_rng(7)
    machine = Machine(
        terms, float(np.log(rate / (1 - rate))), np.zeros(len(terms)), rng.normal(0, 0.02, (len(terms), FACTORS))
    )
    if not len(terms):
        return machine
    index = [np.searchsorted(terms, np.intersect1d(d, terms)) for d in documents]
    starts = np.concatenate([[0], np.cumsum([len(i) for i in index])])
    index = np.concatenate(index).astype(np.int64)
    sizes = np.diff(starts)
    first, second = [np.zeros(1 + len(terms) * (1 + FACTORS)) for _ in range(2)]
    n = len(labels)
    for step in range(1, STEPS + 1):
        error = (logistic(machine.margins(starts, index)) - labels) / n
        spread = np.repeat(error, sizes)
        chosen = machine.factors[index]
        total = np.repeat(_sums(chosen, starts), sizes, axis=0)
        g_weights = np.bincount(index, spread, len(terms)) + DECAY / n * machine.weights
        pull = spread[:, None] * (total - chosen)
        g_factors = np.stack([np.bincount(index, pull[:, f], len(terms)) for f in range(FACTORS)], axis=1)
        g_factors += DECAY * 3 / n * machine.factors
        gradient = np.concatenate([[error.sum()], g_weights, g_factors.ravel()])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-10)
        machine.bias -= move[0]
        machine.weights -= move[1 : 1 + len(terms)]
        machine.factors -= move[1 + len(terms) :].reshape(-1, FACTORS)
    return machine


def training_rows(
    documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", sample: int = SAMPLE,
) -> DataFrame:
    """The bounded sample as ``sample`` rows at most of ``terms`` (distinct, sorted, packed) and ``label``.

    Each set of terms comes once, with its larger label, however many rows have it.
    Documents with several label rows take the larger label; null labels and ids are
    left out, as are ids of which crc32(id as text) is divisible by 5.
    """
    known = picked(labels, doc_id=id_column, label=label_column).where("doc_id IS NOT NULL AND label IS NOT NULL")
    known = known.where(~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = picked(documents, doc_id=id_column, text=text_column)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in stream:
            for at in range(0, whole.num_rows, 256):
                part = whole.slice(at, 256)
                found = [
                    np.unique(np.array([x for w in words(t) for x in terms_of(w)], np.int32)).tobytes()
                    for t in part.column(0).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), part.column(1)], names=["terms", "label"])

    # The sample is bounded, so it is sent to the documents.
    rows = texts.join(F.broadcast(chosen), "doc_id").select("text", "label").mapInArrow(run, "terms binary, label int")
    merged = rows.groupBy("terms").agg(F.max("label").alias("label"))
    return merged.orderBy(F.xxhash64("terms"), "terms").limit(sample)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, **names) -> Machine:
    """Fit a machine to the bounded sample of ``training_rows``.

    The sample is gathered as sets of hashed terms, copies of one set once; only these
    come to the driver. Their order does not depend on how the tables are partitioned.
    """
    rows = training_rows(documents, labels, **names).toArrow()
    ordered = sorted(zip(rows.column("terms").to_pylist(), rows.column("label").to_pylist()))
    del rows
    return fit([np.frombuffer(t, np.int32) for t, _ in ordered], np.array([label for _, label in ordered]))


class Scorer:
    """Scores of texts; remembers which terms of a word the machine knows."""

    def __init__(self, machine: Machine):
        self.machine = machine
        self.place = {int(t): i for i, t in enumerate(machine.terms)}
        # Most words have no known term, and share the one empty tuple.
        self.known: dict[str, tuple[int, ...]] = {}

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        known, place = self.known, self.place
        if len(known) > REMEMBERED:
            known.clear()
        index: list[int] = []
        starts = [0]
        for text in texts:
            found: set[int] = set()
            for word in words(text):
                places = known.get(word)
                if places is None:
                    places = known[word] = tuple([place[t] for t in terms_of(word) if t in place])
                if places:
                    found.update(places)
            index += sorted(found)
            starts.append(len(index))
        return logistic(self.machine.margins(np.array(starts), np.array(index, np.int64)))


def without_toxic(df: DataFrame, machine: Machine, text_column: str = "text") -> DataFrame:
    """The rows whose texts score below 0.5, with all columns; null and empty texts score the bias."""

    @F.pandas_udf("double")
    def scored(stream: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(machine)
        for texts in stream:
            parts = [scorer(texts.iloc[at : at + 512].tolist()) for at in range(0, len(texts), 512)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return df.where(scored(F.col(quoted(text_column))) < 0.5)


def score(df: DataFrame, machine: Machine, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` (as the id column), ``held_out``, ``score`` and ``predicted``, one row per row.

    Whole texts are scored, and nothing but texts. Null and empty texts have no terms:
    they get the score of the bias. ``held_out`` is false for a null id. Repeated rows
    are scored each, other columns are left out, an empty table gives no rows.
    """
    rows = picked(df, doc_id=id_column, text=text_column)
    key = rows.schema["doc_id"].dataType.simpleString()

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(machine)
        for whole in stream:
            for at in range(0, whole.num_rows, 512):
                part = whole.slice(at, 512)
                scores = scorer(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores)], names=["doc_id", "score"])

    scored = rows.mapInArrow(run, f"doc_id {key}, score double")
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
