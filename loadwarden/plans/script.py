"""SQL scripts: several statements in one text, with ``${name}`` placeholders."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# What may hold a semicolon that ends no statement: quoted text (raw strings
# have no escapes), a comment, or a hint. Anything else is taken one by one.
_PIECE = re.compile(
    r"""
      (?P<quoted>  \b[rR]'[^']*' | \b[rR]"[^"]*"
                 | '(?:[^'\\]|\\.)*' | "(?:[^"\\]|\\.)*" | `[^`]*` )
    | (?P<comment> --[^\n]* )
    | (?P<hint>    /\*\+.*?\*/ )
    | (?P<block>   /\* )
    | (?P<end>     ; )
    | (?P<other>   . )
    """,
    re.VERBOSE | re.DOTALL,
)
_BLOCK_EDGE = re.compile(r"/\*|\*/")
_PLACEHOLDER = re.compile(r"\$\{(\w+)\}")


def _block_end(script: str, start: int) -> int:
    """Where the bracketed comment that starts at ``start`` ends; such comments nest."""
    depth = 0
    for edge in _BLOCK_EDGE.finditer(script, start):
        depth += 1 if edge.group() == "/*" else -1
        if depth == 0:
            return edge.end()
    raise ValueError("a bracketed comment is not closed")


def _statements(script: str) -> Iterable[str]:
    """The statements without their comments; empty ones are left out."""
    current: list[str] = []
    position = 0
    while position < len(script):
        piece = _PIECE.match(script, position)
        position = piece.end()
        match piece.lastgroup:
            case "end":
                yield "".join(current).strip()
                current = []
            case "block":
                position = _block_end(script, piece.start())
                current.append(" ")
            case "comment":
                pass
            case _:
                current.append(piece.group())
    yield "".join(current).strip()


def script_statements(script: str, params: Mapping[str, str] | None = None) -> list[str]:
    """The statements of ``script`` in order, with its placeholders filled in.

    A placeholder without a value is an error. Placeholders are filled in after
    the split, so no value can add a statement, and a value may not hold
    characters that would end a quoted text.
    """
    values = {name: str(value) for name, value in (params or {}).items()}
    for name, value in values.items():
        if re.search(r"['\"`;\\]", value):
            raise ValueError(f"the value of {name!r} holds a quote, backslash or semicolon")

    def fill(placeholder: re.Match[str]) -> str:
        name = placeholder.group(1)
        if name not in values:
            raise ValueError(f"no value for placeholder ${{{name}}}")
        return values[name]

    return [_PLACEHOLDER.sub(fill, text) for text in _statements(script) if text]


def run_sql_script(
    spark: SparkSession,
    script: str,
    params: Mapping[str, str] | None = None,
    args: Mapping[str, Any] | None = None,
) -> list[DataFrame]:
    """Run the statements of a script text in order and return one DataFrame each.

    Commands take effect at once; queries run when their DataFrame is used.
    ``args`` binds named parameters (``:name``). The first error ends the script.
    """
    return [
        spark.sql(statement, args=dict(args) if args else None)
        for statement in script_statements(script, params)
    ]


def show_results(results: Iterable[DataFrame], rows: int | None = None) -> None:
    """Print each result in full width: all of its rows, a partition at a time, or the first ``rows``."""
    for result in results:
        if rows is not None:
            result.show(rows, truncate=False)
            continue
        print("|" + "|".join(result.columns) + "|")
        for row in result.toLocalIterator():
            print("|" + "|".join(str(value) for value in row) + "|")
        print()
