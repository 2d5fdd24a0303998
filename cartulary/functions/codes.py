"""Code lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartulary.functions.text import text_map
from cartulary.settings import ROLE_CODES


def map_code(code: Column, codes: Mapping[str, str]) -> Column:
    """The code's value, or null when the list does not have it."""
    return F.element_at(text_map(codes), code)


def map_role(role: Column) -> Column:
    """A listed role is translated, an already translated one passes, others give null."""
    return F.coalesce(
        map_code(role, ROLE_CODES), F.when(role.isin(list(ROLE_CODES.values())), role)
    )
