"""Names and values as SQL text."""

from __future__ import annotations


def sql_text(value: str) -> str:
    """A string as a SQL literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def sql_name(*parts: str) -> str:
    """A column name, or the path of a nested field, in quotes."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)
