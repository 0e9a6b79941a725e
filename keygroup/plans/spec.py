"""One query over one keyed table, as an immutable value."""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Any

from keygroup.errors import JobError

ALL_COLUMNS = "*"

# A string literal or a quoted identifier; a question mark inside is no parameter.
_STRING = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"")
_QUOTED = re.compile(_STRING.pattern + r"|`[^`]*`")

# A column and the placeholders compared with it.
_COLUMN = r"(`[^`]+`|[A-Za-z_]\w*)\s*"
_COMPARISONS = [
    re.compile(_COLUMN + tail, re.IGNORECASE)
    for tail in (
        r"(?:<=>|<=|>=|<>|!=|==|=|<|>)\s*\?",
        r"(?:\bnot\s+)?\bin\s*\([^()]*\)",
        r"(?:\bnot\s+)?\bbetween\s+\?\s+and\s+\?",
    )
]


@dataclass(frozen=True)
class WhereClause:
    """A predicate with positional ``?`` parameters and the values for them."""

    text: str
    args: tuple[Any, ...] = ()

    def __post_init__(self) -> None:
        if self.text is None or self.args is None:
            raise JobError("a WHERE clause needs a text and its arguments")
        object.__setattr__(self, "args", tuple(self.args))
        if not self.predicate:
            raise JobError("the WHERE clause is empty")

    @property
    def predicate(self) -> str:
        """The condition without the leading keyword."""
        return re.sub(r"^\s*where\b", "", self.text, flags=re.IGNORECASE).strip()

    @property
    def placeholders(self) -> list[int]:
        """Offsets of the parameters in the predicate."""
        plain = _QUOTED.sub(_blank, self.predicate)
        return [at for at, ch in enumerate(plain) if ch == "?"]

    def compared_columns(self) -> list[str | None]:
        """Per placeholder, the column it is compared with, if that is plain to see.

        Covers ``c op ?``, ``c IN (?, …)`` and ``c BETWEEN ? AND ?``.
        """
        text = _STRING.sub(_blank, self.predicate)
        owner = {}
        for form in _COMPARISONS:
            for match in form.finditer(text):
                owner.update(dict.fromkeys(range(*match.span()), match.group(1).strip("`")))
        return [owner.get(at) for at in self.placeholders]


def _blank(match: re.Match) -> str:
    return " " * len(match.group())


@dataclass(frozen=True)
class QuerySpec:
    """Columns of one table, restricted by at most one WHERE clause.

    No columns means all of them. A column is a name or any SQL select term.
    """

    keyspace: str
    table: str
    columns: tuple[str, ...] = ()
    where: WhereClause | None = None

    def __post_init__(self) -> None:
        if not self.keyspace:
            raise JobError("a query needs a keyspace")
        if not self.table:
            raise JobError("a query needs a table")
        columns = (self.columns,) if isinstance(self.columns, str) else tuple(self.columns)
        if any(not isinstance(c, str) or not c.strip() for c in columns):
            raise JobError(f"column names must be non-empty text: {columns}")
        object.__setattr__(self, "columns", () if columns == (ALL_COLUMNS,) else columns)
        if isinstance(self.where, str):
            object.__setattr__(self, "where", WhereClause(self.where))

    @property
    def name(self) -> str:
        return f"{self.keyspace}.{self.table}"

    @staticmethod
    def builder() -> QuerySpecBuilder:
        return QuerySpecBuilder()


class QuerySpecBuilder:
    """Collects the parts of a query; each part but the columns is given once."""

    def __init__(self) -> None:
        self._keyspace: str | None = None
        self._table: str | None = None
        self._columns: list[str] = []
        self._where: WhereClause | None = None

    def keyspace(self, name: str) -> QuerySpecBuilder:
        self._keyspace = _once("keyspace", self._keyspace, name)
        return self

    def table(self, name: str) -> QuerySpecBuilder:
        self._table = _once("table", self._table, name)
        return self

    def columns(self, *names: str) -> QuerySpecBuilder:
        """Add columns; repeated calls accumulate."""
        if not names:
            raise JobError("name at least one column")
        self._columns.extend(names)
        return self

    def columns_csv(self, csv: str) -> QuerySpecBuilder:
        """Add comma-separated columns; ``*`` adds nothing."""
        if csv is None:
            raise JobError("the column list is missing")
        if csv.strip() != ALL_COLUMNS:
            self._columns.extend(part.strip() for part in csv.split(","))
        return self

    def where(self, text: str, *args: Any) -> QuerySpecBuilder:
        """Set the predicate, its conditions joined by AND; a leading WHERE is optional."""
        self._where = _once("WHERE clause", self._where, None if text is None else WhereClause(text, args))
        return self

    def build(self) -> QuerySpec:
        return QuerySpec(self._keyspace, self._table, tuple(self._columns), self._where)


def _once(what: str, current: Any, value: Any) -> Any:
    if current is not None:
        raise JobError(f"a query has only one {what}")
    if value is None:
        raise JobError(f"the {what} is missing")
    return value
