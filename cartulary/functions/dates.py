"""Calendar dates, kept as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartulary.settings import UNDEFINED_DATE

_LOOKS_LIKE_A_DATE = r"(?U)^\d{4}-\d{2}-\d{2}"


def has_date(text: Column) -> Column:
    """True when the field says anything at all."""
    return F.coalesce((text != "") & (text != UNDEFINED_DATE), F.lit(False))


def calendar_day(text: Column) -> Column:
    """The date a text of exactly the form ``yyyy-MM-dd`` names, or null."""
    return F.when(F.length(text) == 10, F.try_to_date(text, "yyyy-MM-dd"))


def normalise_date(text: Column) -> Column:
    """Midnight UTC for a calendar date, the raw text for anything else, null for none."""
    return F.when(
        has_date(text),
        F.when(calendar_day(text).isNotNull(), F.concat(text, F.lit("T00:00:00Z"))).otherwise(
            text
        ),
    )


def date_finding(text: Column) -> Column:
    """The data-quality rule a date field breaks, or null."""
    return F.when(
        has_date(text) & calendar_day(text).isNull(),
        F.when(F.rlike(text, F.lit(_LOOKS_LIKE_A_DATE)), F.lit("unparsable_date")).otherwise(
            F.lit("invalid_date")
        ),
    )
