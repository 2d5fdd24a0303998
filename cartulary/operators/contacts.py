"""Contacts: standardised people and organisations with their roles.

A record's contacts live in one array, so building and merging them is row-local: no
shuffle, and no group can outgrow its document.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.codes import map_role
from cartulary.functions.names import author_name, labelled_name, person_name
from cartulary.functions.text import bind, text_array

# Every contact field but the roles, in output order. Contacts equal in all of them merge.
IDENTITY = (
    "givenNames",
    "lastName",
    "inCitation",
    "indEmail",
    "indName",
    "indOrcid",
    "indPosition",
    "orgAddress",
    "orgCity",
    "orgCountry",
    "orgEmail",
    "orgName",
    "orgRor",
    "orgURL",
)


# The sections of a record that give a contact, each with its fixed role.
ISO_SECTIONS = (
    ("point_of_contact", "pointOfContact"),
    ("maintainer", "custodian"),
    ("distributor", "distributor"),
)
FGDC_SECTIONS = (
    ("points_of_contact", "pointOfContact"),
    ("distributors", "owner"),
    ("maintainers", "custodian"),
)


def _contact(party: Column, name: Column, in_citation: Column, roles: Column, org_email: Column) -> Column:
    """One contact from a party and its standardised name."""
    nothing = F.lit("")
    return F.struct(
        name["given"].alias("givenNames"),
        name["last"].alias("lastName"),
        in_citation.alias("inCitation"),
        party["email"].alias("indEmail"),
        name["full"].alias("indName"),
        nothing.alias("indOrcid"),
        party["position"].alias("indPosition"),
        party["address"].alias("orgAddress"),
        party["city"].alias("orgCity"),
        party["country"].alias("orgCountry"),
        org_email.alias("orgEmail"),
        party["organisation"].alias("orgName"),
        nothing.alias("orgRor"),
        nothing.alias("orgURL"),
        roles.alias("role"),
    )


def _entry(party: Column | str, role: Column) -> Column:
    party = F.col(party) if isinstance(party, str) else party
    return F.struct(party.alias("party"), role.alias("fixed"))


def iso_contacts(house_names: Mapping[str, Sequence[str]]) -> Column:
    """All contacts in section order: point of contact, custodian, distributor, cited parties.

    A missing section still gives its contact, with the fixed role and no other field. Only
    cited parties, which have no fixed role, count as part of the citation.
    """
    entries = F.concat(
        F.array(*[_entry(section, F.lit(role)) for section, role in ISO_SECTIONS]),
        F.transform(F.col("cited"), lambda party: _entry(party, F.lit(None).cast("string"))),
    )

    def contact(entry: Column) -> Column:
        party, fixed = entry["party"], entry["fixed"]
        return bind(
            person_name(party["name"], house_names),
            lambda name: _contact(
                party,
                name,
                fixed.isNull(),
                F.array(F.coalesce(fixed, map_role(party["role"]))),
                party["email"],
            ),
        )

    return F.transform(entries, contact)


def fgdc_contacts() -> Column:
    """The second dialect's contacts; authors carry a name only and nothing is merged."""

    def section(column: str, role: str) -> Column:
        return F.transform(F.col(column), lambda party: _entry(party, F.lit(role)))

    entries = F.concat(*[section(column, role) for column, role in FGDC_SECTIONS])

    def contact(entry: Column) -> Column:
        party = entry["party"]
        return bind(
            labelled_name(party["name"]),
            lambda name: _contact(party, name, F.lit(False), F.array(entry["fixed"]), F.lit("")),
        )

    def author(origin: Column) -> Column:
        unknown = F.lit(None).cast("string")

        def fields(name: Column) -> Column:
            known = {
                "givenNames": name["given"],
                "lastName": name["last"],
                "inCitation": F.lit(True),
            }
            return F.struct(
                *[known.get(field, unknown).alias(field) for field in IDENTITY],
                text_array(["author"]).alias("role"),
            )

        return bind(author_name(origin), fields)

    return F.concat(F.transform(entries, contact), F.transform(F.col("origins"), author))


def _fields(of: str, names: Sequence[str] = IDENTITY) -> str:
    return ", ".join(f"'{name}', {of}.{name}" for name in names)


def merge_contacts(records: DataFrame, column: str = "contacts") -> DataFrame:
    """Merge equal contacts of each record; roles concatenate, first-seen order stays.

    Contacts are sorted by a hash, so that equal ones stand together and one pass finds where
    each group begins; a record with very many contacts costs a sort, not a comparison of pairs.
    """
    who = f"named_struct({_fields('person')})"
    entries = (
        f"array_sort(transform({column}, (person, i) -> "
        f"named_struct('hash', xxhash64({who}), 'who', {who}, 'position', i, 'role', person.role)))"
    )
    starts = (
        "filter(transform(_entries, (e, i) -> if(i > 0 AND e.hash = _entries[i - 1].hash "
        "AND e.who <=> _entries[i - 1].who, NULL, i)), i -> i IS NOT NULL)"
    )
    groups = (
        "array_sort(transform(_starts, (start, i) -> named_struct("
        "'position', _entries[start].position, 'who', _entries[start].who, 'role', flatten("
        "slice(_entries, start + 1, coalesce(get(_starts, i + 1), size(_entries)) - start).role))))"
    )
    merged = f"transform(_groups, person -> named_struct({_fields('person.who')}, 'role', person.role))"
    return (
        records.withColumn("_entries", F.expr(entries))
        .withColumn("_starts", F.expr(starts))
        .withColumn("_groups", F.expr(groups))
        .withColumn(column, F.expr(merged))
        .drop("_entries", "_starts", "_groups")
    )


def contacts_long(records: DataFrame, column: str = "contacts") -> DataFrame:
    """One row per contact with its position in the record.

    ``inline`` of an expression, because ``posexplode`` of a column adds a filter that is
    pushed below the projection and builds all contacts a second time.
    """
    fields = _fields("person", (*IDENTITY, "role"))
    return records.selectExpr(
        "record_id",
        f"inline(transform({column}, (person, i) -> named_struct('position', i, {fields})))",
    )


def merge_contacts_long(contacts: DataFrame) -> DataFrame:
    """The merge for contacts already in long form, for tables that outlived their documents.

    Grouping by record and person keeps every group inside one record.
    """
    entry = F.struct("position", "role")
    return (
        contacts.groupBy("record_id", *IDENTITY)
        .agg(F.min("position").alias("position"), F.sort_array(F.collect_list(entry)).alias("_all"))
        .withColumn("role", F.flatten(F.col("_all")["role"]))
        .drop("_all")
    )
