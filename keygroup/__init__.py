"""Keyed group reads on Spark."""

from keygroup.errors import JobError, UnknownTableError
from keygroup.functions.order import order_key
from keygroup.functions.token import MD5_60, XXHASH_64, Tokenizer
from keygroup.operators.backfill import Backfill
from keygroup.operators.balance import TokenWeights, balanced_ranges, balanced_slices
from keygroup.operators.cursor import GroupCursor
from keygroup.operators.groups import KeyedGroups
from keygroup.operators.hot import heavy_keys
from keygroup.operators.profile import SliceProfile
from keygroup.operators.slices import TokenRanges, iterate_slices, read_slice, slice_profile, with_token
from keygroup.plans.job import MultiQuery
from keygroup.plans.scan import scan
from keygroup.plans.spec import QuerySpec, WhereClause
from keygroup.sources.clustered import write_clustered
from keygroup.sources.sliced import SlicedTable
from keygroup.sources.tables import Catalog, KeyedTable, declare_keys
from keygroup.sources.token_files import TokenFiles
from keygroup.workspace import drop_workspace, workspace_dir

__all__ = [
    "MD5_60",
    "XXHASH_64",
    "Backfill",
    "Catalog",
    "GroupCursor",
    "JobError",
    "KeyedGroups",
    "KeyedTable",
    "MultiQuery",
    "QuerySpec",
    "SliceProfile",
    "SlicedTable",
    "TokenFiles",
    "TokenRanges",
    "TokenWeights",
    "Tokenizer",
    "UnknownTableError",
    "WhereClause",
    "balanced_ranges",
    "balanced_slices",
    "declare_keys",
    "drop_workspace",
    "heavy_keys",
    "iterate_slices",
    "order_key",
    "read_slice",
    "scan",
    "slice_profile",
    "with_token",
    "write_clustered",
    "workspace_dir",
]
