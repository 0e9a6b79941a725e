"""Walking over groups with their keys, in bounded memory, and going on another day.

The pages of the groups are laid out once in files sorted by token, key and page. A cursor
fetches the next few of them by what comes behind its position, from the files that hold
them; the position is a plain tuple, from which any session can go on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from keygroup.names import SIZE, TOKEN, quoted
from keygroup.sources.tables import KeyedTable
from keygroup.sources.token_files import TokenFiles

PREFETCH_ROWS = 100_000
PREFETCH_PAGES = 1_000


@dataclass(frozen=True)
class Page:
    """A page of a group: its place, the key, the number of the page, and its lists."""

    position: tuple
    key: Row
    number: int
    lists: Row

    @property
    def rows(self) -> list[Row]:
        return self.lists["rows"]


class GroupCursor:
    """Pages of groups in the order of token, key and page.

    A fetch brings pages of about ``prefetch_rows`` rows to the driver, one page at least and
    ``PREFETCH_PAGES`` at most, and reads the few files around the position. All pages of
    a group follow each other, so a group of any size passes in the memory of a fetch.
    """

    def __init__(self, files: TokenFiles, prefetch_rows: int = PREFETCH_ROWS):
        if prefetch_rows < 1:
            raise ValueError(f"prefetch_rows must be positive, not {prefetch_rows}")
        if "_page" not in files.clustering:
            raise ValueError("a cursor walks over the pages of groups")
        self.files = files
        self.prefetch_rows = prefetch_rows
        self._keys = [*files.partition_key, *files.clustering[:-1]]
        self._order = [TOKEN, *self._keys, "_page"]
        self._lists = [c for c in files.schema.names if c not in (*self._order, SIZE)]
        # Tokens at which files end; as many as there are files at most.
        self._ends = [row.high for row in files.manifest().select("high").distinct().collect()]

    def pages(self, after: Sequence | None = None) -> Iterator[Page]:
        """All pages behind the position ``after``, or all."""
        position = None if after is None else tuple(after)
        if position is not None and len(position) != len(self._order):
            raise ValueError(f"a position has the values of {self._order}")
        while found := self._fetch(position):
            for row in found:
                position = tuple(row[name] for name in self._order)
                key = Row(*self._keys)(*position[1:-1])
                lists = Row(*self._lists)(*(row[name] for name in self._lists))
                yield Page(position, key, position[-1], lists)

    __iter__ = pages

    def _fetch(self, after: tuple | None) -> list[Row]:
        low = self.files.tokenizer.low if after is None else after[0]
        ends = sorted({high for high in self._ends if high >= low})
        # More files are looked at until there is something, which nearly always is in the first.
        width = 1
        while ends:
            rows = self.files.tokens(low, ends[min(width, len(ends)) - 1])
            if after is not None:
                rows = rows.where(self._behind(after))
            terms = [quoted(c) for c in self._order]
            # Narrow columns tell which pages to fetch.
            sizes = rows.select(*terms, SIZE).orderBy(*terms).limit(PREFETCH_PAGES).collect()
            if sizes:
                number, total = 0, 0
                for row in sizes:
                    total += row[SIZE]
                    if number and total > self.prefetch_rows:
                        break
                    number += 1
                last = tuple(sizes[number - 1][name] for name in self._order)
                return rows.where((F.col(TOKEN) <= last[0]) & ~self._behind(last)).orderBy(*terms).collect()
            if width >= len(ends):
                break
            width *= 2
        return []

    def _behind(self, position: tuple) -> Column:
        """Whether a page comes behind a position: nulls first, NaN last, as they are sorted.

        Spelled out in comparisons that files are pruned by.
        """
        found, same = F.lit(False), F.lit(True)
        for name, value in zip(self._order, position):
            column = F.col(quoted(name))
            if value is None:
                further, equal = column.isNotNull(), column.isNull()
            else:
                literal = F.lit(value).cast(self.files.schema[name].dataType)
                further, equal = F.coalesce(column > literal, F.lit(False)), column.eqNullSafe(literal)
                if name in (TOKEN, "_page"):
                    further, equal = column > literal, column == literal
            found, same = found | (same & further), same & equal
        return found


def lay_out_pages(pages: DataFrame, keys: Sequence[str], n_partition_key: int, path: str, **options) -> TokenFiles:
    """Write pages of groups, with the numbers of their rows, to files sorted by token, key and page."""
    lists = [f.name for f in pages.schema.fields if f.name not in (*keys, "_page")]
    sized = pages.withColumn(SIZE, reduce(lambda a, b: a + b, [F.size(name) for name in lists]))
    table = KeyedTable(sized, tuple(keys[:n_partition_key]), (*keys[n_partition_key:], "_page"), unique=True)
    return TokenFiles.write(table, path, **options)
