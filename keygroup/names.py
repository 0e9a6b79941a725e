"""Column names that the engine adds, and quoting."""

from __future__ import annotations

import re

TOKEN = "_token"
SLICE = "_slice"
SIZE = "_size"

# Output columns of the grouped forms; a key column may not bear one of these names.
_RESERVED = re.compile(r"_token|_slice|_size|_page|_pos|_q|_batch|rows|(in_)?s\d+", re.IGNORECASE)


def is_reserved(name: str) -> bool:
    return _RESERVED.fullmatch(name) is not None


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
