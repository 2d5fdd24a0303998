"""Translation memory: keys, lookup, what is still to translate, and the update.

The translator itself is outside. A run looks texts up in the memory table and lists the
distinct texts it does not have; translations that come back become memory rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.keys import translation_key
from cartulary.functions.localised import LOCALISED, localised
from cartulary.operators.lookup import HOT_ROWS, salted_lookup
from cartulary.settings import MACHINE_TRANSLATION_NOTICE

TRANSLATED_FIELDS = ("title", "abstract", "limitations", "comments")
# Texts inside an array of structs, as ``array.member``.
TRANSLATED_DISTRIBUTION = ("distribution.description", "distribution.name")


def with_keys(texts: DataFrame, source: str = "en", target: str = "fr") -> DataFrame:
    """Add ``cache_key`` to rows with a ``text``; an empty text has none."""
    key = translation_key(F.col("text"), F.lit(source), F.lit(target))
    return texts.withColumn("cache_key", F.when(F.col("text") != "", key))


def look_up(
    keyed: DataFrame, memory: DataFrame, spread: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``translated`` from the memory, null where it has none."""
    return salted_lookup(
        keyed, memory.select("cache_key", "translated"), "cache_key", spread, hot_rows=hot_rows
    )


def pending(
    keyed: DataFrame,
    memory: DataFrame,
    locate: Sequence[str],
    source: str = "en",
    target: str = "fr",
    terminology: str | None = None,
) -> DataFrame:
    """Each distinct text the memory lacks, once.

    ``locate`` names the columns that tell rows apart. Keys and a place for each are all that meet
    the memory; then the text is fetched from that one place.
    """
    placed = keyed.where(F.col("cache_key").isNotNull()).withColumn("_place", F.xxhash64(*locate))
    missing = (
        placed.groupBy("cache_key")
        .agg(F.min("_place").alias("_place"))
        .join(memory.select("cache_key"), "cache_key", "left_anti")
    )
    return (
        placed.join(missing, ["cache_key", "_place"], "left_semi").select(
            "cache_key",
            "text",
            F.lit(source).alias("source"),
            F.lit(target).alias("target"),
            F.lit(terminology).cast("string").alias("terminology"),
        )
    )


def update_memory(memory: DataFrame, returned: DataFrame) -> DataFrame:
    """The memory with returned translations added; what it already has stays."""
    fresh = (
        returned.groupBy("cache_key")
        .agg(F.min("translated").alias("translated"))
        .join(memory.select("cache_key"), "cache_key", "left_anti")
    )
    return memory.select("cache_key", "translated").unionByName(fresh)


def _notice() -> Column:
    return F.struct(
        F.struct(
            F.lit(MACHINE_TRANSLATION_NOTICE).alias("message"), F.lit(False).alias("verified")
        ).alias("fr")
    )


def _addressed(fields: Sequence[str], last: Callable[[Column], Column], name: str) -> Column:
    """An array of ``(field, position, name)`` for every localised text: fields, and members of
    arrays with their position."""
    entries = []
    for field in fields:
        array, _, member = field.partition(".")
        if member:
            texts = F.transform(F.col(array), _addresser(field, member, last, name))
            entries.append(F.coalesce(texts, F.array().cast(f"array<struct<field:string,position:int,{name}:string>>")))
        else:
            entries.append(
                F.array(
                    F.struct(
                        F.lit(field).alias("field"), F.lit(None).cast("int").alias("position"), last(F.col(field)["en"]).alias(name)
                    )
                )
            )
    return F.concat(*entries)


def _addresser(
    field: str, member: str, last: Callable[[Column], Column], name: str
) -> Callable[[Column, Column], Column]:
    def address(entry: Column, at: Column) -> Column:
        return F.struct(F.lit(field).alias("field"), at.cast("int").alias("position"), last(entry[member]["en"]).alias(name))

    return address


def field_texts(
    records: DataFrame, fields: Sequence[str] = TRANSLATED_FIELDS, key: str = "recordKey"
) -> DataFrame:
    """``(key, field, position, text)``: the English text of each localised field.

    ``array.member`` names a member of an array of structs; its texts have their position there.
    """
    return records.select(key, F.inline(_addressed(fields, lambda text: text, "text")))


def with_field_keys(
    records: DataFrame,
    fields: Sequence[str] = TRANSLATED_FIELDS,
    source: str = "en",
    target: str = "fr",
) -> DataFrame:
    """Add ``translationKeys``, the ``(field, position, cache_key)`` of every text that is not empty.

    Stored with the records, the keys save later steps from reading the texts.
    """

    def key(text: Column) -> Column:
        return F.when(text != "", translation_key(text, F.lit(source), F.lit(target)))

    keyed = F.filter(_addressed(fields, key, "cache_key"), lambda entry: entry["cache_key"].isNotNull())
    return records.withColumn("translationKeys", keyed)


def _translated(text: Column, address: Column) -> Column:
    french = F.element_at("_french", address)
    return F.when(french.isNotNull(), localised(text["en"], french, _notice())).otherwise(text).cast(LOCALISED)


def translate_records(
    records: DataFrame,
    memory: DataFrame,
    key: str = "recordKey",
    fields: Sequence[str] = TRANSLATED_FIELDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Fill ``fr`` and the machine-translation notice of the localised fields.

    Only keys travel to the lookup and only translations travel back; the records move once, when
    the translations of all fields join them, and not at all if they are bucketed by ``key``. A text
    without English, and one the memory lacks, stays as it is.

    The records come from ``with_field_keys`` with the same ``fields``. Their keys are read twice
    and all else once, so they should be a stored table.
    """
    keyed = records.select(key, F.inline("translationKeys"))
    found = look_up(keyed, memory, key, hot_rows).where(F.col("translated").isNotNull())
    address = F.concat_ws("/", "field", F.col("position").cast("string"))
    per_record = found.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct(address, "translated"))).alias("_french")
    )
    result = records.join(per_record, key, "left")
    members: dict[str, list[str]] = {}
    for field in fields:
        array, _, member = field.partition(".")
        if member:
            members.setdefault(array, []).append(member)
        else:
            result = result.withColumn(field, _translated(F.col(field), F.lit(field)))
    for array, named in members.items():
        every = records.schema[array].dataType.elementType.fieldNames()
        result = result.withColumn(array, F.transform(F.col(array), _entry_translator(array, named, every)))
    return result.drop("_french", "translationKeys")


def _entry_translator(array: str, named: Sequence[str], every: Sequence[str]) -> Callable[[Column, Column], Column]:
    """Writes translations back into an entry of an array of structs, by its position."""

    def entry_with_french(entry: Column, at: Column) -> Column:
        values = [
            _translated(entry[name], F.concat(F.lit(f"{array}.{name}/"), at.cast("string"))) if name in named else entry[name]
            for name in every
        ]
        return F.when(entry.isNotNull(), F.struct(*[v.alias(n) for v, n in zip(values, every, strict=True)]))

    return entry_with_french
