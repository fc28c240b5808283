"""Names that go into SQL text."""

from __future__ import annotations

import re

_IDENTIFIER = re.compile(r"\w+", re.ASCII)


def checked_identifier(name: str) -> str:
    """``name`` itself if it is a plain identifier, so that it can stand in SQL text."""
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


def qualified_name(database: str, table: str) -> str:
    return f"`{checked_identifier(database)}`.`{checked_identifier(table)}`"
