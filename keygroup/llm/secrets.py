"""Secrets in texts: known forms, and stretches that are too random for prose.

Known forms are assignments to telling names, access key ids and long runs of lower-case
hexadecimal digits. Beside them, a window slides over every long run of characters that
secrets are made of, once per character class. The Shannon entropy of a window comes from
the counts of its characters, of which a step changes two; windows above the bound of
their class are joined to spans. What an allow-list knows to be harmless is left out.

No row meets another, so nothing is shuffled: a key or a source with any share of the
rows is spread like all others. Memory is bounded by the largest text of a batch.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keygroup.llm.common import picked

# Known forms, in the order in which spans of one start are listed. Letters of the names
# match in either case, all others as they stand; ``least`` is the length that the last
# group, or the match, must have.
FORMS = {
    "assign": (
        re.compile(
            r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
        ),
        6,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 20),
    "hex": (re.compile(r"[0-9a-f]+"), 24),
}


@dataclass(frozen=True)
class CharacterClass:
    """Characters, the length of the window and the least entropy, in bits a character.

    A window needs a digit and a letter, or letters of both cases if ``both_cases`` is set.
    """

    kind: str
    characters: str
    window: int
    bits: float
    both_cases: bool = False


# From narrow to wide. Random characters of these classes have about 3.4, 4.0 and 4.3 bits
# in such windows; words and names in mixed case stay below the bounds, and most paths have
# letters of one case.
CLASSES = (
    CharacterClass("random_hex", "0-9A-Fa-f", 20, 3.1),
    CharacterClass("random_alnum", "0-9A-Za-z", 20, 3.8),
    CharacterClass("random_base64", r"0-9A-Za-z+/_=\-", 24, 4.1, both_cases=True),
)

# Runs that hold one of these are no secrets: numbers, words and numbered names as a whole,
# universally unique ids, counting sequences, published checksums, and values that stand for another.
ALLOWED = (
    r"\A[0-9]+\Z",
    r"\A[A-Za-z]+[0-9]{0,6}\Z",
    r"\A[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\Z",
    r"(?i)0123456789|abcdefghij|qwertyuiop",
    r"(?i)\Asha(1|256|384|512)-",
    r"(?i)example|placeholder|changeme|redacted|xxxx|your[_-]?(key|token|secret|password)",
)

KINDS = (*FORMS, *(c.kind for c in CLASSES))
# Entropies are compared as whole numbers of this many parts of a bit, so sums of steps are exact.
_PARTS = 1 << 24


def entropy_windows(run: str, one: CharacterClass) -> Iterator[tuple[int, int]]:
    """Windows of ``run`` with at least the entropy of the class and the characters it needs, joined.

    With n characters in a window, c of a kind, the entropy is log2(n) less the sum of
    c*log2(c) over n. A step takes one character out and one in, so the sum changes by
    two differences.
    """
    window = one.window
    if len(run) < window:
        return
    weight = [round(c * math.log2(c) * _PARTS) if c else 0 for c in range(window + 1)]
    most = math.floor(window * (math.log2(window) - one.bits) * _PARTS)
    counts: dict[str, int] = dict.fromkeys(run, 0)
    total = digits = upper = lower = 0
    start = stop = -1
    for at, character in enumerate(run):
        c = counts[character]
        total += weight[c + 1] - weight[c]
        counts[character] = c + 1
        digits += character.isdigit()
        upper += character.isupper()
        lower += character.islower()
        first = at + 1 - window
        if first < 0:
            continue
        cased = upper and lower if one.both_cases else upper or lower
        if total <= most and digits and cased:
            if first > stop:
                if stop > 0:
                    yield start, stop
                start = first
            stop = at + 1
        gone = run[first]
        c = counts[gone]
        total += weight[c - 1] - weight[c]
        counts[gone] = c - 1
        digits -= gone.isdigit()
        upper -= gone.isupper()
        lower -= gone.islower()
    if stop > 0:
        yield start, stop


class Scanner:
    """Finds the spans of one text after the other."""

    def __init__(self, classes: Sequence[CharacterClass] = CLASSES, allowed: Sequence[str] = ALLOWED):
        self.classes = [(c, re.compile(f"[{c.characters}]{{{c.window},}}", re.ASCII)) for c in classes]
        self.allowed = [re.compile(pattern) for pattern in allowed]
        least = min((c.window for c in classes), default=0)
        every = "".join(c.characters for c in classes)
        self.candidate = re.compile(f"[{every}]{{{least},}}", re.ASCII) if classes else None
        self.kinds = (*FORMS, *(c.kind for c in classes))

    def known(self, text: str) -> Iterator[tuple[int, int, int]]:
        """``start, place of the kind, stop`` of known forms, leftmost first, apart per kind."""
        for place, (pattern, least) in enumerate(FORMS.values()):
            for match in pattern.finditer(text):
                low, high = match.span(match.lastindex or 0)
                if high - low >= least:
                    yield match.start(), place, match.end()

    def random(self, text: str) -> Iterator[tuple[int, int, int]]:
        """The same for stretches of high entropy; none lies within one of a narrower class."""
        if self.candidate is None:
            return
        for candidate in self.candidate.finditer(text):
            if self._harmless(candidate[0]):
                continue
            found: list[tuple[int, int]] = []
            for place, (one, runs) in enumerate(self.classes, len(FORMS)):
                spans = []
                for run in runs.finditer(text, *candidate.span()):
                    if not self._harmless(run[0]):
                        spans.extend((run.start() + a, run.start() + b) for a, b in entropy_windows(run[0], one))
                spans = [(a, b) for a, b in spans if not any(x <= a and b <= y for x, y in found)]
                found.extend(spans)
                yield from ((a, place, b) for a, b in spans)

    def _harmless(self, run: str) -> bool:
        return any(pattern.search(run) for pattern in self.allowed)

    def scan(self, text: str) -> list[tuple[str, int, int]]:
        """All spans, ``kind, start, stop``, by start, kind and stop."""
        spans = sorted([*self.known(text), *self.random(text)])
        return [(self.kinds[place], start, stop) for start, place, stop in spans]


def find_secrets(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    classes: Sequence[CharacterClass] = CLASSES,
    allowed: Sequence[str] = ALLOWED,
) -> DataFrame:
    """``doc_id`` (as the id column) and ``spans``, one row per row.

    ``spans`` lists ``kind, start, stop`` in code points, the stop excluded, by start and
    then by kind in the order of ``KINDS``. Known forms are found leftmost first and
    without overlap per kind; those of too short a value are dropped. Null and empty
    texts have no spans, null ids stay null, repeated rows are scanned each, texts of any
    length are scanned as a whole, other columns are left out whatever their names, and
    an empty table gives no rows.
    """
    rows = picked(df, doc_id=id_column, text=text_column)
    key = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, spans array<struct<kind:string,start:int,stop:int>>"

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(classes, allowed)
        for whole in stream:
            for at in range(0, whole.num_rows, 512):
                part = whole.slice(at, 512)
                spans, ends = [], [0]
                for text in part.column(1).to_pylist():
                    if text:
                        spans.extend(scanner.scan(text))
                    ends.append(len(spans))
                kinds, starts, stops = zip(*spans) if spans else ((), (), ())
                values = pa.StructArray.from_arrays(
                    [pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(stops, pa.int32())],
                    names=["kind", "start", "stop"],
                )
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["doc_id", "spans"])

    return rows.mapInArrow(run, schema)


def listed(spans: Column) -> Column:
    """Spans as text: ``kind:start:stop``, joined by commas."""
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")))
    )


def digests(found: DataFrame) -> DataFrame:
    """Numbers of known forms, a digest of their spans, and all spans as text."""
    known = F.filter("spans", lambda s: s["kind"].isin(*FORMS))
    counts = (
        F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}") for kind in FORMS
    )
    return found.select(
        "doc_id", *counts, F.sha2(listed(known), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
