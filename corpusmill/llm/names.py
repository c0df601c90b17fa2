"""Names for internal columns that no column of the caller has."""

from __future__ import annotations

from collections.abc import Iterable


def unused(columns: Iterable[str], *wanted: str) -> list[str]:
    """Each of ``wanted``, made longer until it differs from all ``columns``, whatever the case of their letters."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        name = f"cm_{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
