"""Names for columns that an operator adds for a while."""

from __future__ import annotations

from collections.abc import Iterable


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores in front until no column is called so (case does not tell names apart)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
