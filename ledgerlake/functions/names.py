"""Column-name helpers. They work on schema names only, never on data."""

from __future__ import annotations


def normalise_header(name: str) -> str:
    """Lower-case, `/` -> `_per_`, space -> `_` (idempotent)."""
    return name.lower().replace("/", "_per_").replace(" ", "_")
