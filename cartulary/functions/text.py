"""Text and array helpers shared by the rules.

The ``(?U)`` flag gives Unicode classes, so a no-break space separates words and an
accented letter counts as a letter.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.regexp_replace(text, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def words(text: Column) -> Column:
    """Split on white space and drop empty pieces."""
    return F.filter(F.split(text, rf"(?U){SPACE}+"), lambda word: word != "")


def blank_to_null(text: Column) -> Column:
    """An empty element carries no text."""
    return F.nullif(text, F.lit(""))


def after_last(text: Column, separator: str) -> Column:
    """The text after the last separator, or all of it."""
    return F.substring_index(text, separator, -1)


def quoted(value: str) -> str:
    """A text as a SQL literal; ``$`` would start a variable."""
    for plain, escaped in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("$", "\\u0024")):
        value = value.replace(plain, escaped)
    return f"'{value}'"


def _array_literal(values: Sequence[str]) -> str:
    return f"CAST(array({', '.join(map(quoted, values))}) AS array<string>)"


def text_array(values: Sequence[str]) -> Column:
    return F.expr(_array_literal(values))


def text_map(values: Mapping[str, str | Sequence[str]]) -> Column:
    """A literal map; its values are texts or lists of texts."""
    return F.expr(
        "map("
        + ", ".join(
            f"{quoted(key)}, {quoted(value) if isinstance(value, str) else _array_literal(value)}"
            for key, value in values.items()
        )
        + ")"
    )


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
