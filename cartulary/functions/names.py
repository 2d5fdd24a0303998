"""Person names.

A standardised name is ``struct<given, last, full, parts>``: the last part is the family
name, everything before it the given names, and ``parts`` counts what was found.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartulary.functions.text import after_last, bind, strip, text_map, words


def _after_label(text: Column) -> Column:
    return F.when(F.contains(text, F.lit(":")), strip(after_last(text, ":"))).otherwise(text)


def _family_last(text: Column) -> Column:
    """``Doe, Jane`` reads ``Jane Doe``."""
    return F.array_join(F.reverse(F.split(text, ",")), " ")


def _from_parts(parts: Column, full: Column, count: Column) -> Column:
    return F.struct(
        F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), " ").alias(
            "given"
        ),
        F.coalesce(F.get(parts, F.size(parts) - 1), F.lit("")).alias("last"),
        full.alias("full"),
        count.alias("parts"),
    )


def house_parts(whole: Column, house_names: Mapping[str, Sequence[str]]) -> Column:
    """The replacement parts of a listed name, or null: one look-up, however long the list."""
    if not house_names:
        return F.lit(None).cast("array<string>")
    return F.element_at(text_map(house_names), whole)


def person_name(
    text: Column,
    house_names: Mapping[str, Sequence[str]],
    override: Column | None = None,
) -> Column:
    """Standardise a name: drop a label, put the family name last, apply house names.

    ``override`` replaces the literal list by a column with the replacement parts (null
    for none), for lists that are too long to inline.
    """

    def assemble(parts: Column) -> Column:
        replacement = (
            override if override is not None else house_parts(F.array_join(parts, " "), house_names)
        )
        return bind(
            F.struct(
                F.coalesce(replacement, parts).alias("parts"),
                F.when(replacement.isNotNull(), 0).otherwise(F.size(parts)).alias("count"),
            ),
            lambda name: _from_parts(
                name["parts"], F.array_join(name["parts"], " "), name["count"]
            ),
        )

    return bind(name_words(text), assemble)


def name_words(text: Column) -> Column:
    """The words of a name in reading order; no name gives no words."""
    return F.coalesce(words(_family_last(_after_label(text))), F.array().cast("array<string>"))


def labelled_name(text: Column) -> Column:
    """The second dialect's contact name: drop a label, split, keep the spacing in full."""
    return bind(
        strip(after_last(F.coalesce(text, F.lit("")), ":")),
        lambda name: bind(
            words(name), lambda parts: _from_parts(parts, name, F.size(parts))
        ),
    )


def author_name(text: Column) -> Column:
    """The second dialect's author name: family name last, labels kept."""
    return bind(
        F.coalesce(words(_family_last(text)), F.array().cast("array<string>")),
        lambda parts: _from_parts(parts, F.array_join(parts, " "), F.size(parts)),
    )
