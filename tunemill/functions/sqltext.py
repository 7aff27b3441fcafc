"""SQL text for wide generated expressions.

One parsed text costs one call into the JVM, where the same expression built column by column costs dozens; for a
matrix of pairs or a table of statistics that is most of the time of a small query.
"""

from __future__ import annotations


def name(identifier: str) -> str:
    """A quoted column name."""
    return "`" + identifier.replace("`", "``") + "`"


def text(value: str) -> str:
    """A quoted string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value: float) -> str:
    """A double literal."""
    return f"{float(value)!r}D" if float(value) == float(value) and abs(float(value)) != float("inf") \
        else f"double('{float(value)}')"


def as_double(column: str) -> str:
    """The column as a double with NaN as null."""
    value = f"CAST({name(column)} AS DOUBLE)"
    return f"CASE WHEN NOT isnan({value}) THEN {value} END"


def rows(entries: list[dict[str, str]]) -> str:
    """A generator with one row per entry; an entry maps result names to SQL text."""
    structs = ["named_struct(" + ", ".join(f"{text(k)}, {v}" for k, v in entry.items()) + ")" for entry in entries]
    return f"inline(array({', '.join(structs)}))"
