"""Key lookups that survive hot keys.

A few keys can carry a large share of the rows: boilerplate text, a person who is given
everything. Where the facts are a stored table, reading their key column twice is cheap, and
the hot keys are found first and spread over many tasks. Where the facts are the result of
heavy work, such as parsing, the join is written so that adaptive execution can split its
skewed partitions at run time, without a second pass.

Whether a side is broadcast is left to the optimizer, which checks its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is hot and is split into pieces of about this size.
HOT_ROWS = 500_000
# At most this many keys can be hot: a hot key also holds more than this share of all rows, so
# the list is short whatever the data, and safe to broadcast.
HOT_KEYS = 10_000
# Rows without a key are dealt over so many pieces.
KEYLESS_PIECES = 4_096


def hot_keys(facts: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(keys, _salts)`` of the keys above the threshold, and how many pieces each needs.

    The threshold is the larger of ``hot_rows`` and the rows' ``HOT_KEYS``-th part; smaller keys
    are at most that share of the rows and need no splitting. Counting is combined before the
    shuffle, so a hot key costs one row per input split.
    """
    keyed = facts.dropna(subset=list(keys))
    total = keyed.agg(F.count("*")).scalar()
    threshold = F.greatest(F.lit(hot_rows).cast("long"), F.ceil(total / HOT_KEYS).cast("long"))
    return (
        keyed.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .withColumn("_most", threshold)
        .where(F.col("_rows") > F.col("_most"))
        .select(*keys, F.ceil(F.col("_rows") / F.col("_most")).cast("int").alias("_salts"))
    )


def salted_lookup(
    facts: DataFrame,
    dimension: DataFrame,
    key: str | Sequence[str],
    spread: str,
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join of ``facts`` with a ``dimension``: ``left``, ``left_semi`` or ``left_anti``.

    ``spread`` names a column that differs between rows of one key. Only the dimension rows
    of hot keys are repeated, once per salt. Rows without a key are spread as well and find
    nothing.
    """
    keys = [key] if isinstance(key, str) else list(key)
    hot = F.broadcast(hot_keys(facts, keys, hot_rows))
    keyless = F.greatest(*[F.col(name).isNull() for name in [*keys, keys[0]]])

    def salts(otherwise: Column) -> Column:
        return F.coalesce("_salts", otherwise)

    salt = F.pmod(
        F.xxhash64(spread), salts(F.when(keyless, F.lit(KEYLESS_PIECES)).otherwise(F.lit(1)))
    )
    copies = F.explode(F.sequence(F.lit(0), salts(F.lit(1)) - 1))
    salted_facts = facts.join(hot, keys, "left").withColumn("_salt", salt.cast("int"))
    salted_dimension = dimension.join(hot, keys, "left").withColumn("_salt", copies)
    return (
        salted_facts.drop("_salts")
        .join(salted_dimension.drop("_salts"), [*keys, "_salt"], how)
        .drop("_salt")
    )


def adaptive_lookup(
    facts: DataFrame, dimension: DataFrame, key: str, spread: str
) -> DataFrame:
    """Left join that leaves hot keys to adaptive execution.

    It splits a skewed partition only where the shuffle feeds the join directly. A dimension
    that was just aggregated by the key would be joined without a shuffle of its own; the
    second key calls for one. It also spreads the rows without a key.
    """
    bucketed_facts = facts.withColumn("_bucket", F.xxhash64(F.coalesce(key, spread)))
    bucketed_dimension = dimension.withColumn("_bucket", F.xxhash64(key))
    return bucketed_facts.join(bucketed_dimension, [key, "_bucket"], "left").drop("_bucket")
