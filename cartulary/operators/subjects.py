"""Keywords, places and subject categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.text import strip, text_array, text_map
from cartulary.operators.lookup import adaptive_lookup
from cartulary.settings import DEFAULT_CATEGORY
from cartulary.vocabulary import CATEGORIES, categories_by_term


def _of_type(kind: str) -> Column:
    return F.filter(F.col("keyword_groups"), lambda group: group["type"] == kind)


def theme_keywords() -> Column:
    """All theme keywords as written: untrimmed, repeated, in document order."""
    return F.filter(
        F.flatten(_of_type("theme")["keywords"]), lambda keyword: keyword.isNotNull()
    )


def places() -> Column:
    """The first keyword of each place group."""
    return F.filter(
        F.transform(_of_type("place")["keywords"], lambda keywords: F.get(keywords, F.lit(0))),
        lambda place: place.isNotNull(),
    )


def place_description() -> Column:
    return F.array_join(places(), " - ")


def all_keywords() -> Column:
    """Keywords of every group, whatever its type."""
    return F.filter(
        F.flatten(F.col("keyword_groups")["keywords"]), lambda keyword: keyword.isNotNull()
    )


def keyword_tokens() -> Column:
    """Distinct comma-separated tokens of all keywords, sorted."""
    pieces = F.flatten(F.transform(all_keywords(), lambda keyword: F.split(keyword, ",")))
    return F.array_sort(F.array_distinct(F.transform(pieces, strip)))


def fgdc_keywords() -> Column:
    """Theme keys, then the place list of the second dialect split on ``"; "``."""
    listed = F.coalesce(F.split("places", "; "), F.array())
    return F.concat(F.col("theme_keys"), listed)


def keywords_long(records: DataFrame) -> DataFrame:
    """One row per keyword with its group, the group's type, and both positions.

    ``inline`` of an expression keeps the optimizer from adding a filter on the array, which
    would extract the keywords twice.
    """
    words = F.flatten(
        F.transform(
            F.col("keyword_groups"),
            lambda group, group_position: F.transform(
                group["keywords"],
                lambda keyword, position: F.struct(
                    group_position.alias("group_position"),
                    group["type"].alias("keyword_type"),
                    position.alias("position"),
                    keyword.alias("keyword"),
                ),
            ),
        )
    )
    return records.select("record_id", F.inline(words))


def or_default(categories: Column) -> Column:
    """Sorted categories; ``["other"]`` for none."""
    return F.when(F.size(categories) > 0, F.array_sort(categories)).otherwise(
        text_array([DEFAULT_CATEGORY])
    )


def matched_categories(
    keywords: Column, vocabulary: Mapping[str, Sequence[str]] = CATEGORIES
) -> Column:
    """Categories of a keyword array by exact match, without order; none for none.

    A vocabulary given as a mapping becomes a literal map, so classification needs neither join
    nor shuffle; one kept as a table goes through ``classify_by_table``.
    """
    inverse = categories_by_term(vocabulary)
    if not inverse:
        return F.array().cast("array<string>")
    lookup = text_map(inverse)
    found = F.filter(
        F.transform(F.array_distinct(keywords), lambda keyword: F.element_at(lookup, keyword)),
        lambda hit: hit.isNotNull(),
    )
    return F.array_distinct(F.flatten(found))


def categories(
    keywords: Column, vocabulary: Mapping[str, Sequence[str]] = CATEGORIES
) -> Column:
    """Categories of a keyword array by exact match, sorted; ``["other"]`` for none."""
    return or_default(matched_categories(keywords, vocabulary))


def matched_by_table(
    records: DataFrame, vocabulary: DataFrame, keywords: str = "keywords"
) -> DataFrame:
    """``(record_id, matched)``: categories by a ``(category, term)`` table of any size, without order;
    none for none.

    Popular keywords are hot join keys. The vocabulary side is distinct, and adaptive
    execution splits their partitions. The result has one row per ``record_id``.
    """
    terms = vocabulary.where(F.col("term").isNotNull()).select("category", "term").distinct()
    mentions = records.select(
        "record_id", F.explode_outer(F.array_distinct(keywords)).alias("term")
    )
    hits = adaptive_lookup(mentions, terms, "term", "record_id")
    return hits.groupBy("record_id").agg(F.collect_set("category").alias("matched"))


def classify_by_table(
    records: DataFrame, vocabulary: DataFrame, keywords: str = "keywords"
) -> DataFrame:
    """Classification against a ``(category, term)`` table of any size; ``["other"]`` for none."""
    matched = matched_by_table(records, vocabulary, keywords)
    return matched.select("record_id", or_default(F.col("matched")).alias("categories"))


def term_usage(records: DataFrame, vocabulary: DataFrame, keywords: str = "keywords") -> DataFrame:
    """Every vocabulary entry with the number of records that carry its term."""
    usage = (
        records.select(F.explode(F.array_distinct(keywords)).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("records"))
    )
    return vocabulary.join(usage, "term", "left").select(
        "category", "term", F.coalesce("records", F.lit(0).cast("long")).alias("records")
    )
