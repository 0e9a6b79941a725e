"""Several queries over tables that share a partition key, read as one job."""

from __future__ import annotations

from dataclasses import dataclass, replace

from keygroup.operators.groups import DEFAULT_PAGE_ROWS, KeyedGroups
from keygroup.plans.checks import check_job
from keygroup.plans.shape import shape
from keygroup.plans.spec import QuerySpec
from keygroup.sources.tables import Catalog, KeyedTable


@dataclass(frozen=True)
class MultiQuery:
    """An ordered list of queries and one list of grouping columns for all of them.

    Rows are grouped by the partition key, or by the partition key and the
    grouping columns. The position of a query in the list tags its rows (``_q``).
    """

    catalog: Catalog
    queries: tuple[QuerySpec, ...] = ()
    grouping: tuple[str, ...] = ()

    def add(self, *queries: QuerySpec) -> MultiQuery:
        return replace(self, queries=(*self.queries, *queries))

    def group_by(self, *columns: str) -> MultiQuery:
        return replace(self, grouping=tuple(dict.fromkeys(columns)))

    def validate(self) -> list[KeyedTable]:
        """Check the whole job against the schemas; reads no data."""
        return check_job(self.catalog, self.queries, self.grouping)

    def read(self, page_rows: int = DEFAULT_PAGE_ROWS, page_bytes: int | None = None) -> KeyedGroups:
        """Validate the job and open its groups, still without reading data.

        ``page_rows`` and, for rows of very unequal width, ``page_bytes`` bound the
        lists that groups come in.
        """
        tables = self.validate()
        return KeyedGroups(shape(self.queries, tables, self.grouping), page_rows, page_bytes, self.queries)
