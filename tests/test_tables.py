"""Operators over tables, against brute force where the result is not obvious."""

import hashlib
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartulary.operators import (
    appending,
    contacts,
    harvest,
    identifiers,
    lookup,
    people,
    profile,
    sharing,
    subjects,
    translation,
)
from cartulary.sources import lists
from cartulary.vocabulary import CATEGORIES, categories_by_term, term_pairs, vocabulary_table


def rows(table):
    return Counter(tuple(row) for row in table.collect())


# Lookups


def _skewed(spark):
    """A third of the rows on one key, a third without a key, the rest spread out."""
    facts = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 50}") for i in range(600)]
    dimension = [("hot", "H"), ("k2", "two"), ("k5", "five"), ("unused", "x")]
    return (
        facts,
        dict(dimension),
        spark.createDataFrame(facts, "id int, key string"),
        spark.createDataFrame(dimension, "key string, value string"),
    )


@pytest.mark.parametrize("hot_rows", [5, 50, 10_000])
def test_salted_lookup_equals_a_plain_one(spark, hot_rows):
    facts, values, left, right = _skewed(spark)
    found = lookup.salted_lookup(left, right, "key", "id", hot_rows=hot_rows)
    assert rows(found.select("id", "key", "value")) == Counter(
        (i, key, values.get(key)) for i, key in facts
    )
    missing = lookup.salted_lookup(left, right, "key", "id", "left_anti", hot_rows)
    assert rows(missing.select("id")) == Counter((i,) for i, key in facts if key not in values)
    present = lookup.salted_lookup(left, right, "key", "id", "left_semi", hot_rows)
    assert rows(present.select("id")) == Counter((i,) for i, key in facts if key in values)


def test_hot_keys_are_found_and_bounded(spark, monkeypatch):
    _, _, left, _ = _skewed(spark)
    assert rows(lookup.hot_keys(left, ["key"], 100)) == Counter([("hot", 2)])
    monkeypatch.setattr(lookup, "HOT_KEYS", 4)  # none but keys with over a quarter of all rows
    assert rows(lookup.hot_keys(left, ["key"], 1)).keys() == {("hot", 2)}


def test_hot_key_is_spread_over_tasks(spark):
    facts = spark.range(4000).select("id", F.lit("hot").alias("key"))
    dimension = spark.createDataFrame([("hot", 1)], "key string, value int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = lookup.salted_lookup(facts, dimension, "key", "id", hot_rows=100)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 4000 and len(sizes) > 1 and max(sizes) < 3000


# Contacts

_WORD = st.sampled_from([None, "", "a", "b"])
_PERSON = st.tuples(_WORD, _WORD, st.booleans(), st.sampled_from([["x"], ["y"], [None]]))
_CONTACT_SCHEMA = (
    "record_id string, contacts array<struct<givenNames:string,lastName:string,inCitation:boolean,"
    "indEmail:string,indName:string,indOrcid:string,indPosition:string,orgAddress:string,"
    "orgCity:string,orgCountry:string,orgEmail:string,orgName:string,orgRor:string,orgURL:string,"
    "role:array<string>>>"
)


def _contact(given_names, email, cited, role):
    fixed = dict.fromkeys(contacts.IDENTITY)
    fixed |= {"givenNames": given_names, "indEmail": email, "inCitation": cited}
    return (*fixed.values(), role)


def _merged_by_hand(people):
    merged = {}
    for *who, role in people:
        merged.setdefault(tuple(who), []).extend(role)
    return [(*who, roles) for who, roles in merged.items()]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(_PERSON, max_size=6), min_size=1, max_size=6))
def test_merge_equals_brute_force(spark, corpus):
    people = [[_contact(*person) for person in record] for record in corpus]
    table = spark.createDataFrame(
        [(str(i), record) for i, record in enumerate(people)], _CONTACT_SCHEMA
    )
    expected = {str(i): _merged_by_hand(record) for i, record in enumerate(people)}
    found = contacts.merge_contacts(table).collect()
    assert {row.record_id: [tuple(c) for c in row.contacts] for row in found} == expected
    long = contacts.merge_contacts_long(contacts.contacts_long(table)).orderBy("position").collect()
    by_record = {record_id: [] for record_id in expected}
    for row in long:
        by_record[row.record_id].append((*[row[name] for name in contacts.IDENTITY], row.role))
    assert by_record == expected


def test_merge_of_a_long_list(spark):
    people = [_contact(f"p{i % 700}", None, True, [str(i)]) for i in range(2100)]
    table = spark.createDataFrame([("1", people)], _CONTACT_SCHEMA)
    (row,) = contacts.merge_contacts(table).collect()
    assert [tuple(c) for c in row.contacts] == _merged_by_hand(people)


# Subjects


def test_vocabulary():
    assert len(CATEGORIES) == 34
    assert sum(bool(terms) for terms in CATEGORIES.values()) == 22
    assert len(term_pairs()) == 59 and len(categories_by_term()) == 55
    assert sum(len(found) > 1 for found in categories_by_term().values()) == 4


def test_classification_by_literal_and_by_table_agree(spark):
    keywords = [
        ["Chlorophyll", "Chlorophyll", "nothing"],
        ["chlorophyll", "Salinity "],
        [],
        ["Air-water exchange", "Plastics", "CTD profiles"],
    ]
    table = spark.createDataFrame(
        [(str(i), words) for i, words in enumerate(keywords)], "record_id string, keywords array<string>"
    )
    expected = {
        str(i): sorted({c for w in words for c, term in term_pairs() if term == w}) or ["other"]
        for i, words in enumerate(keywords)
    }
    literal = table.select("record_id", subjects.categories(F.col("keywords")).alias("categories"))
    by_table = subjects.classify_by_table(table, vocabulary_table(spark))
    for result in (literal, by_table):
        assert {row.record_id: row.categories for row in result.collect()} == expected


def test_empty_vocabulary(spark):
    table = spark.createDataFrame([("1", ["Ice"])], "record_id string, keywords array<string>")
    (row,) = table.select(subjects.categories(F.col("keywords"), {}).alias("c")).collect()
    assert row.c == ["other"]


def test_term_usage_counts_records(spark):
    table = spark.createDataFrame([("1", ["Ice", "Ice"]), ("2", ["Ice"])], "record_id string, keywords array<string>")
    usage = subjects.term_usage(table, vocabulary_table(spark))
    assert usage.count() == 59
    assert usage.where("term = 'Ice'").collect()[0].records == 2


def test_profiles(spark):
    table = spark.createDataFrame(
        [("a.xml", ["x", "y", "x"]), ("b.xml", ["x"]), ("c.xml", [])], "file_name string, words array<string>"
    )
    assert rows(profile.distinct_values(table, "words")) == Counter([("x", 3), ("y", 1)])
    by_file = {row.file_name: row["values"] for row in profile.values_by_file(table, "words").collect()}
    assert by_file == {"a.xml": ["x", "y", "x"], "b.xml": ["x"], "c.xml": []}


# Publishing


def test_append_refuses_collisions(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "record_key string, n int")
    with pytest.raises(appending.KeyCollision):
        appending.append_records(old, spark.createDataFrame([("b", 3), ("c", 4)], old.schema))
    fresh = spark.createDataFrame([("c", "x")], "record_key string, extra string")
    found = appending.append_records(old, fresh)
    assert rows(found) == Counter([("a", 1, None), ("b", 2, None), ("c", None, "x")])


def test_share_grants_drop_empty_persons(spark):
    records = spark.createDataFrame([("u", "k1"), ("u", "k2")], "user_id string, record_key string")
    found = sharing.share_grants(records, ["ana", "", "ana"])
    assert rows(found) == Counter([("ana", "u", "k1", True), ("ana", "u", "k2", True)])
    assert sharing.share_grants(records, [""]).count() == 0


def test_append_shares(spark):
    schema = "person string, user_id string, record_key string, shared boolean"
    old = [("ana", "u", "1", True), ("ana", "v", "2", True), ("ben", "u", "3", True)]
    old += [("ana", "u", str(n), True) for n in range(100, 140)]
    new = [("ana", "u", "9", True), ("cat", "u", "9", True), ("ana", "u", "1", True)]
    left, right = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    replaced = Counter([*new, old[1], old[2]])
    for hot_rows in (5, 10_000):
        assert rows(sharing.append_shares(left, right, hot_rows=hot_rows)) == replaced
    assert rows(sharing.append_shares(left, right, "merge")) == Counter(set(old) | set(new))
    with pytest.raises(ValueError):
        sharing.append_shares(left, right, "other")


# Translation


def _key(text):
    return hashlib.md5(f"{text}-en-fr".encode()).hexdigest()


def test_translation_memory(spark):
    texts = ["one", "two", "one", "", None, "three", *["boiler"] * 30]
    table = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    memory = spark.createDataFrame(
        [(_key("one"), "un"), (_key("boiler"), "chaudière")], "cache_key string, translated string"
    )
    keyed = translation.with_keys(table)
    known = {"one": "un", "boiler": "chaudière"}
    for hot_rows in (5, 10_000):
        found = translation.look_up(keyed, memory, "id", hot_rows)
        assert rows(found.select("id", "translated")) == Counter(
            (i, known.get(text)) for i, text in enumerate(texts)
        )
    missing = translation.pending(keyed, memory, ("id",), terminology="t")
    assert rows(missing) == Counter(
        [(_key(text), text, "en", "fr", "t") for text in ("two", "three")]
    )
    returned = spark.createDataFrame(
        [(_key("two"), "deux"), (_key("two"), "deux"), (_key("one"), "other")], memory.schema
    )
    assert rows(translation.update_memory(memory, returned)) == Counter(
        [(_key("one"), "un"), (_key("boiler"), "chaudière"), (_key("two"), "deux")]
    )


def test_translated_records(spark):
    localised = "struct<en:string,fr:string,translations:struct<fr:struct<message:string,verified:boolean>>>"
    records = spark.createDataFrame(
        [("k1", ("one", None, None), ("", None, None), 1), ("k2", ("two", None, None), None, 2)],
        f"recordKey string, title {localised}, limitations {localised}, other int",
    )
    memory = spark.createDataFrame([(_key("one"), "un"), (_key(""), "vide")], "cache_key string, translated string")
    found = {
        row.recordKey: row
        for row in translation.translate_records(
            translation.with_field_keys(records, ("title", "limitations")),
            memory,
            fields=("title", "limitations"),
        ).collect()
    }
    first, second = found["k1"], found["k2"]
    assert (first.title.en, first.title.fr) == ("one", "un")
    assert first.title.translations.fr.verified is False
    assert "Amazon" in first.title.translations.fr.message
    assert first.limitations.fr is None and first.limitations.translations is None
    assert second.title.fr is None and second.limitations is None and second.other == 2


def test_translated_members_of_arrays(spark):
    localised = "struct<en:string,fr:string,translations:struct<fr:struct<message:string,verified:boolean>>>"
    way = f"struct<name:{localised},url:{localised},count:int>"

    def text(en):
        return (en, None, None)

    records = spark.createDataFrame(
        [
            ("k1", text("one"), [(text("two"), text("one"), 1), None, (text("one"), text("one"), 2), (None, None, None)]),
            ("k2", text(""), []), ("k3", None, None), ("k4", text("two"), [(text("nowhere"), text("two"), 3)]),
        ],
        f"recordKey string, title {localised}, distribution array<{way}>",
    )
    memory = spark.createDataFrame([(_key("one"), "un"), (_key("two"), "deux")], "cache_key string, translated string")
    fields = ("title", "distribution.name")
    texts = translation.field_texts(records, fields).where("text <> ''")
    assert rows(texts) == Counter(
        [
            ("k1", "title", None, "one"), ("k1", "distribution.name", 0, "two"), ("k1", "distribution.name", 2, "one"),
            ("k4", "title", None, "two"), ("k4", "distribution.name", 0, "nowhere"),
        ]
    )
    done = translation.translate_records(translation.with_field_keys(records, fields), memory, fields=fields)
    assert done.schema["distribution"].dataType == records.schema["distribution"].dataType
    found = {row.recordKey: row for row in done.collect()}
    first = found["k1"].distribution
    assert [way and way.name and way.name.fr for way in first] == ["deux", None, "un", None] and first[1] is None
    assert [way.url.fr for way in (first[0], first[2])] == [None, None] and first[0]["count"] == 1
    assert first[0].name.translations.fr.verified is False and found["k1"].title.fr == "un"
    assert found["k2"].distribution == [] and found["k3"].distribution is None and found["k3"].title is None
    assert found["k4"].distribution[0].name == ("nowhere", None, None) and found["k4"].title.fr == "deux"


# Harvest and lists


def test_worklist(spark):
    ids = lists.identifier_list(spark, [1, 2, "2", 3])
    present = lists.identifier_list(spark, [3, 3, 9])
    base = "https://example.org"
    found = harvest.worklist(ids, present, base, "iso")
    assert rows(found) == Counter(
        (n, f"{n}_iso.xml", f"https://example.org/iso/{n}_iso.xml") for n in ("1", "2")
    )
    assert harvest.worklist(ids, present, base, "iso", overwrite=True).count() == 3


def test_failures_and_summary(spark):
    statuses = spark.createDataFrame(
        [("1", "u1", 200), ("2", "u2", 404), ("3", "u3", None)], "record_id string, url string, status int"
    )
    assert rows(harvest.failures(statuses)) == Counter([("2", "u2", 404), ("3", "u3", None)])
    assert rows(harvest.summary(statuses)) == Counter([(3, 1, 2)])


def test_tagged_union(spark):
    one = spark.createDataFrame([(1, "a")], "id int, x string")
    two = spark.createDataFrame([(2, 5.0)], "id int, y double")
    found = lists.tagged_union(one, two)
    assert found.columns == ["id", "x", "status", "y"]
    assert rows(found) == Counter([(1, "a", "confirmed", None), (2, None, "candidate", 5.0)])


def test_house_names_by_table(spark):
    names = ["Desk: The House", "Doe, Jane", *["The  House"] * 30, None]
    table = spark.createDataFrame(list(enumerate(names)), "id int, written string")
    houses = spark.createDataFrame([("The House", ["The House", ""])], "full string, parts array<string>")
    literal = people.standardise_names(table, "written", {"The House": ["The House", ""]})
    for hot_rows in (5, 10_000):
        by_table = people.standardise_names_by_table(table, "written", houses, "id", hot_rows)
        assert rows(by_table) == rows(literal)


def test_adaptive_execution_splits_a_hot_id(spark):
    """The record side of a lookup may hold one id in a third of its rows."""
    lowered = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in lowered}
    for key, value in lowered.items():
        spark.conf.set(key, value)
    try:
        records = spark.range(0, 30000, 1, 16).selectExpr(
            "CAST(id AS STRING) AS record_id",
            "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS local_id",
        )
        registry = spark.range(0, 30000, 7).selectExpr("'10.21963/' || id AS doi").union(
            spark.createDataFrame([("10.21963/hot",)], "doi string")
        )
        found = identifiers.resolve_dois(records, registry)
        assert found.where("doi_url <> ''").count() == 10000 + sum(
            1 for i in range(0, 30000, 7) if i % 3
        )
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
