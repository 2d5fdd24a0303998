"""Authors named in a suggested citation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartulary.functions.text import bind, strip
from cartulary.settings import UNPUBLISHED_CITATIONS

# Fixed patterns: where the author list ends, what joins the last author, what an initial is.
_AUTHORS_END = r"(?U)\(|\d{4}\."
_CONJUNCTION = r"(?U)\s+&\s+|\s+and\s+"
_INITIAL = r"^[\p{L}\p{N}_]\."

AUTHORS_TYPE = "array<struct<lastName:string,givenNames:string>>"


def is_published(citation: Column) -> Column:
    return F.coalesce(
        (citation != "") & ~F.lower(citation).isin(list(UNPUBLISHED_CITATIONS)), F.lit(False)
    )


def lists_authors(citation: Column) -> Column:
    """True when something marks the end of an author list."""
    return is_published(citation) & F.rlike(citation, F.lit(_AUTHORS_END))


def abbreviates_authors(citation: Column) -> Column:
    return F.coalesce(F.contains(citation, F.lit("et al.")), F.lit(False))


def citation_authors(citation: Column) -> Column:
    """The authors in order. An initial belongs to the author before it."""
    head = F.get(F.split(citation, _AUTHORS_END), F.lit(0))
    items = F.filter(
        F.transform(F.split(F.regexp_replace(head, _CONJUNCTION, ""), ","), strip),
        lambda item: item != "",
    )

    def starts(items: Column) -> Column:
        """Positions of the items that open an author, closed by the end of the list."""
        numbered = F.transform(
            items,
            lambda item, i: F.when((i == 0) | ~F.rlike(item, F.lit(_INITIAL)), i),
        )
        opening = F.filter(numbered, lambda i: i.isNotNull())
        return F.array_append(opening, F.size(items))

    def authors(items: Column, bounds: Column) -> Column:
        return F.transform(
            F.slice(bounds, 1, F.size(bounds) - 1),
            lambda start, i: F.struct(
                F.get(items, start).alias("lastName"),
                F.when(
                    F.get(bounds, i + 1) - 1 > start, F.get(items, F.get(bounds, i + 1) - 1)
                ).alias("givenNames"),
            ),
        )

    listed = bind(items, lambda it: bind(starts(it), lambda bounds: authors(it, bounds)))
    return F.when(lists_authors(citation), listed).otherwise(F.array().cast(AUTHORS_TYPE))
