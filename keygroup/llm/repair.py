"""Conversations brought into the order of roles that training needs, at least cost.

A conversation should be ``(system)? (user assistant)+``, or empty. Its rows are kept,
given another role, or deleted, and empty turns are inserted; the cheapest edits win, and
of equally cheap ones those whose initials, the audit, come first in ASCII order.

The search is a depth-first branch and bound with a stack of its own. A node is a place
in the conversation and a state of the role order. Each row has a least cost for the rest
of the conversation from every state, audits left aside; a branch is cut where its cost and
that bound cannot beat the incumbent, and a table per node cuts prefixes that reach the
node again without being cheaper there. The stack runs empty when optimality is proved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keygroup.llm.common import batches, picked
from keygroup.workspace import materialise

# Costs of the edits, and of leaving a truncated row in.
RETITLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLANK, DUPLICATE, CUT = "blank", "duplicate", "truncated"

# States of the role order: nothing yet, behind the system turn, behind a user's turn,
# behind an assistant's. ``_NEXT[state]`` has the state behind each initial allowed there.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = ({"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER})
_TURN = {_USER: "user", _ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}
_NEVER = 1 << 60

# Conversations with more characters are planned first and rewritten in a second pass.
HELD_CHARS = 4_000_000

REPORT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
)
NAMES = [field.split()[0] for field in REPORT.split(", ")]


# -- one conversation -----------------------------------------------------------------


def _edits(initial: str, fault: str | None, state: int) -> Iterator[tuple[str, int, int]]:
    """Edits that use up a row: letter, cost and the state behind it, by letter."""
    yield "D", DELETE, state
    if fault in (BLANK, DUPLICATE):
        return
    extra = TRUNCATED if fault == CUT else 0
    if initial in _NEXT[state]:
        yield "K", extra, _NEXT[state][initial]
    for then in _NEXT[state].values():
        if then in _TURN:
            yield "R", RETITLE + extra, then


def _insertions(state: int) -> Iterator[tuple[str, int, int]]:
    return (("I", INSERT, then) for then in _NEXT[state].values() if then in _TURN)


def _bounds(rows: Sequence[tuple[str, str | None]]) -> list[tuple[int, ...]]:
    """Least cost of the rest of the conversation, per place and state."""

    def with_insertions(costs: list[int]) -> tuple[int, ...]:
        # Two rounds are enough: a third inserted turn would only undo the first two.
        for _ in range(2):
            costs = [min([costs[s], *(cost + costs[then] for _, cost, then in _insertions(s))]) for s in range(4)]
        return tuple(costs)

    bounds = [with_insertions([0, _NEVER, _NEVER, 0])]
    for initial, fault in reversed(rows):
        rest = bounds[-1]
        bounds.append(
            with_insertions([min(cost + rest[then] for _, cost, then in _edits(initial, fault, s)) for s in range(4)])
        )
    bounds.reverse()
    return bounds


def search(rows: Sequence[tuple[str, str | None]]) -> tuple[int, str]:
    """The least cost and its first audit, for the initial of the role and the fault of every row.

    Children are taken by bound and then by letter. Bounds are exact, so along a cheapest
    path the bound stays as it is, and of two cheapest paths the one taken first has the
    first audit: no audit extends another of its cost, so their first difference decides.
    Hence a branch whose bound only reaches the incumbent's cost comes behind it, and the
    table of a node need only hold its least cost.
    """
    bounds, n = _bounds(rows), len(rows)
    # Deleting everything is always allowed, and no audit of that cost comes before it.
    best_cost, best_audit = DELETE * n, "D" * n
    seen: dict[tuple[int, int], int] = {}
    audit: list[str] = []
    # Place, state, cost so far, and the audit as its length and last letter.
    stack = [(0, _START, 0, 0, "")]
    while stack:
        at, state, cost, length, letter = stack.pop()
        if length:
            del audit[length - 1 :]
            audit.append(letter)
        if cost + bounds[at][state] >= best_cost or seen.get((at, state), _NEVER) <= cost:
            continue
        seen[at, state] = cost
        if at == n and state in (_START, _ASSISTANT):
            best_cost, best_audit = cost, "".join(audit)
            continue
        children = [(at, *edit) for edit in _insertions(state)]
        if at < n:
            children.extend((at + 1, *edit) for edit in _edits(*rows[at], state))
        children = [(cost + paid + bounds[to][then], edit, to, then, cost + paid) for to, edit, paid, then in children]
        for _, edit, to, then, paid in sorted(children, reverse=True):
            stack.append((to, then, paid, length + 1, edit))
    return best_cost, best_audit


def apply_audit(audit: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The turns that an audit makes of rows ``role, text``; the order of roles tells the rest."""
    state, rows = _START, iter(rows)
    for letter in audit:
        if letter == "I":
            role, text = None, ""
        else:
            role, text = next(rows)
            if letter == "D":
                continue
        if letter == "K":
            state = _NEXT[state][role[:1]]
        else:
            state = _ASSISTANT if state == _USER else _USER
            role = _TURN[state]
        yield role, text


# -- conversations in tables --------------------------------------------------------------


class _Plan:
    """What is kept of a conversation while its rows pass: a few bytes a row, no texts."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, str | None]] = []
        self.met: set[bytes] = set()
        self.counts = dict.fromkeys((BLANK, DUPLICATE, CUT), 0)
        self.illegal = self.distinct = 0
        self.low = self.high = None

    def add(self, turn: int | None, role: str, text: str, blank: bool, whole: bool) -> None:
        digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        fault = BLANK if blank else DUPLICATE if digest in self.met else None if whole else CUT
        self.met.add(digest)
        initial = role[:1]
        if fault:
            self.counts[fault] += 1
        if self.rows and self.rows[-1][0] + initial not in _LEGAL:
            self.illegal += 1
        self.rows.append((initial, fault))
        if turn is not None and turn != self.high:
            self.low, self.high = turn if self.low is None else self.low, turn
            self.distinct += 1

    def report(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        cost, audit = search(self.rows)
        return {"gaps": gaps, **self.counts, "illegal": self.illegal, "cost": cost, "audit": audit}


def repair(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    dropped: str | None = None,
    held_chars: int | None = None,
    paths: list[str] | None = None,
) -> DataFrame:
    """Every conversation repaired, in parts: ``conv_id, part, last, report, turns``.

    ``turns`` lists ``role, text``; parts are numbered from 0, and ``last`` marks the last.
    Part 0 has the ``report``: gaps between turn numbers, rows that are blank, duplicate or
    truncated (the first of these that holds), neighbours in an illegal order, the cost and
    the audit. Rows come by turn (nulls first), role and text, repeated rows as often as
    they occur. Null roles and texts count as one space, null conversations form one
    conversation. A row with a true ``dropped`` column only says that its conversation
    exists; one without other rows has an empty report and no turns. An empty table has
    no parts; other columns are left out, whatever their names.

    Rows move once, sorted by conversation. A task keeps the texts of one conversation
    until its edits are known, up to ``held_chars`` characters (``HELD_CHARS`` unless
    given). Longer ones, which are never held as a whole, are rewritten part by part in a
    second pass by the audit of the first. About a hundred bytes a row are kept in either case.
    """
    limit = HELD_CHARS if held_chars is None else held_chars
    columns = {"conv_id": conversation, "turn": turn, "role": role, "text": text}
    rows = picked(df, **columns, **({"_dropped": dropped} if dropped else {}))
    key = rows.schema["conv_id"].dataType.simpleString()
    space = F.lit(" ")
    said = F.coalesce("text", space)
    rows = rows.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", space).alias("role"),
        said.alias("text"),
        (~said.rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        said.rlike(r"[.!?][\x20\x09-\x0D]*\z").alias("whole"),
        (F.coalesce("_dropped", F.lit(False)) if dropped else F.lit(False)).alias("dropped"),
    )
    schema = (
        f"conv_id {key}, part int, last boolean, report struct<{REPORT.replace(' ', ':').replace(',:', ',')}>,"
        " turns array<struct<role:string,text:string>>, raw boolean"
    )

    def plan(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts(conv_id, group: Iterable[dict]) -> Iterator[tuple]:
            found, held, size, part = _Plan(), [], 0, 0
            for r in group:
                if r["dropped"]:
                    continue
                found.add(r["turn"], r["role"], r["text"], r["blank"], r["whole"])
                held.append((r["role"], r["text"]))
                size += len(r["text"])
                if size > limit:
                    yield conv_id, part, False, None, _turns(held), True
                    held, size, part = [], 0, part + 1
            report = found.report()
            if part:
                # The report precedes the rows of the second pass.
                yield conv_id, -1, False, report, _turns(held[:0]), True
                yield conv_id, part, True, None, _turns(held), True
            else:
                yield conv_id, 0, True, report, _turns(apply_audit(report["audit"], held)), False

        yield from _by_conversation(stream, parts)

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    planned = materialise(ordered.mapInArrow(plan, schema), "repaired", paths)
    short = planned.where("NOT raw").drop("raw")
    if planned.where("raw").isEmpty():
        return short

    def rewrite(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts(conv_id, group: Iterator[dict]) -> Iterator[tuple]:
            report = next(group)["report"]

            def counted() -> Iterator[tuple[str, str]]:
                return ((t["role"], t["text"]) for r in group for t in r["turns"])

            held, size, part = [], 0, 0
            for role, text in apply_audit(report["audit"], counted()):
                held.append((role, text))
                size += len(text)
                if size > limit:
                    yield conv_id, part, False, None if part else report, _turns(held), False
                    held, size, part = [], 0, part + 1
            yield conv_id, part, True, None if part else report, _turns(held), False

        yield from _by_conversation(stream, parts)

    # Only conversations of more than a part come here, each with one row a part.
    raw = planned.where("raw").repartition(n, "conv_id").sortWithinPartitions("conv_id", "part")
    return short.unionByName(raw.mapInArrow(rewrite, schema).drop("raw"))


def _turns(rows: Iterable[tuple[str, str]]) -> list[dict]:
    return [{"role": role, "text": text} for role, text in rows]


def _by_conversation(stream: Iterator[pa.RecordBatch], parts) -> Iterator[pa.RecordBatch]:
    """Parts of every conversation of a sorted stream, in batches of a few."""
    out = None

    def rows() -> Iterator[dict]:
        nonlocal out
        for whole in stream:
            if out is None:
                turn = pa.struct([("role", pa.string()), ("text", pa.string())])
                report = pa.struct([(n, pa.string() if n == "audit" else pa.int64()) for n in NAMES])
                fields = [("conv_id", whole.schema.field("conv_id").type), ("part", pa.int32()), ("last", pa.bool_())]
                out = pa.schema([*fields, ("report", report), ("turns", pa.list_(turn)), ("raw", pa.bool_())])
            for at in range(0, whole.num_rows, 256):
                yield from whole.slice(at, 256).to_pylist()

    def made() -> Iterator[tuple]:
        for conv_id, group in groupby(rows(), key=lambda r: r["conv_id"]):
            yield from parts(conv_id, group)

    held, size = [], 0
    for one in made():
        held.append(one)
        size += sum(len(t["text"]) for t in one[4]) + 1_000
        if size > HELD_CHARS:
            yield from batches(out, held)
            held, size = [], 0
    if held:
        yield from batches(out, held)


# -- the registered query ------------------------------------------------------------


def damaged(df: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with faults by the checksum of conversation and turn.

    Of twenty checksums one each drops the row (``dropped``), empties its text, removes the
    ends of its sentences, repeats the row, or makes it a user's. Nulls count as one space.
    """
    space = F.lit(" ")
    place = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    kind = F.crc32(place) % 20
    text = F.coalesce("text", space)
    hurt = picked(df, conv_id="conv_id", turn="turn", role="role", text="text").select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    )
    return hurt.drop("copy")


def digests(repaired: DataFrame) -> DataFrame:
    """The reports, and a digest of every repaired conversation.

    A conversation in one part is a list, and its digest an expression. The digest of a
    longer one is taken part by part: a hash is sequential, so in one task.
    """
    line: Column = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    numbers = [F.col(f"report.{name}").alias(name) for name in NAMES]
    whole = repaired.where("part = 0 AND last").select(
        "conv_id", *numbers, F.sha2(F.concat_ws("\n", line), 256).alias("repaired_sha256")
    )
    key = repaired.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {key}, {REPORT}, repaired_sha256 string"

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None

        def rows() -> Iterator[dict]:
            nonlocal out
            for whole in stream:
                if out is None:
                    kinds = [(n, pa.string() if n == "audit" else pa.int64()) for n in NAMES]
                    id_field = ("conv_id", whole.schema.field("conv_id").type)
                    out = pa.schema([id_field, *kinds, ("repaired_sha256", pa.string())])
                for at in range(whole.num_rows):
                    yield whole.slice(at, 1).to_pylist()[0]

        def made() -> Iterator[tuple]:
            for conv_id, parts in groupby(rows(), key=lambda r: r["conv_id"]):
                digest, between, report = hashlib.sha256(), "", None
                for part in parts:
                    report = report or part["report"]
                    for t in part["turns"]:
                        digest.update(f"{between}{t['role']}:{t['text']}".encode())
                        between = "\n"
                yield conv_id, *report.values(), digest.hexdigest()

        first = next(found := made(), None)
        if first is not None:
            yield from batches(out, chain([first], found))

    n = int(repaired.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    longer = repaired.where("NOT (part = 0 AND last)")
    longer = longer.repartition(n, "conv_id").sortWithinPartitions("conv_id", "part")
    return whole.unionByName(longer.mapInArrow(run, schema))
