"""What is read from a document, as schemas for ``from_xml``.

Names are bare because namespaces are ignored. Everything is text: inference would turn a
version ``1.0`` into a number. Elements that may repeat are arrays, since a plain struct
keeps the last occurrence and the rules want the first.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql.types import ArrayType, StructField, StructType

CORRUPT = "_corrupt_record"

_TEXT = "struct<CharacterString:string>"
_BOUND = "struct<Decimal:string>"
_PARTY = (
    "struct<CI_ResponsibleParty:struct<"
    f"individualName:{_TEXT},organisationName:{_TEXT},"
    "contactInfo:struct<CI_Contact:struct<address:struct<CI_Address:struct<"
    f"deliveryPoint:array<{_TEXT}>,city:{_TEXT},country:{_TEXT},"
    f"electronicMailAddress:array<{_TEXT}>>>>>,"
    "role:struct<CI_RoleCode:string>>>"
)
_CITATION = (
    f"struct<CI_Citation:struct<title:{_TEXT},citedResponsibleParty:array<{_PARTY}>,"
    f"otherCitationDetails:array<{_TEXT}>>>"
)
_KEYWORDS = (
    f"struct<MD_Keywords:struct<keyword:array<{_TEXT}>,"
    f"type:struct<MD_KeywordTypeCode:string>,thesaurusName:{_CITATION}>>"
)
_EXTENT = (
    "struct<EX_Extent:struct<"
    "geographicElement:array<struct<EX_GeographicBoundingBox:struct<"
    f"westBoundLongitude:{_BOUND},eastBoundLongitude:{_BOUND},"
    f"southBoundLatitude:{_BOUND},northBoundLatitude:{_BOUND}>>>,"
    "temporalElement:array<struct<EX_TemporalExtent:struct<extent:struct<"
    "TimePeriod:struct<beginPosition:string,endPosition:string>>>>>>>"
)
_IDENTIFICATION = (
    "struct<MD_DataIdentification:struct<"
    f"citation:{_CITATION},abstract:{_TEXT},purpose:{_TEXT},"
    "status:array<struct<MD_ProgressCode:string>>,"
    f"pointOfContact:array<{_PARTY}>,descriptiveKeywords:array<{_KEYWORDS}>,"
    f"language:array<{_TEXT}>,extent:array<{_EXTENT}>,supplementalInformation:{_TEXT}>>"
)

ISO_SCHEMA = (
    f"language {_TEXT}, dateStamp struct<Date:string>, dataSetURI {_TEXT}, "
    f"identificationInfo array<{_IDENTIFICATION}>, "
    "distributionInfo struct<MD_Distribution:struct<"
    f"distributionFormat:array<struct<MD_Format:struct<version:{_TEXT}>>>,"
    f"distributor:array<struct<MD_Distributor:struct<distributorContact:{_PARTY}>>>>>, "
    f"metadataMaintenance struct<MD_MaintenanceInformation:struct<contact:array<{_PARTY}>>>, "
    f"{CORRUPT} string"
)

_FGDC_PARTY = (
    "struct<cntinfo:struct<"
    "cntorgp:struct<cntorg:string,cntper:string>,cntperp:struct<cntper:string,cntorg:string>,"
    "cntpos:string,cntaddr:array<struct<address:array<string>,city:string,country:string>>,"
    "cntemail:array<string>>>"
)

FGDC_SCHEMA = (
    "idinfo struct<"
    "citation:struct<citeinfo:struct<origin:array<string>,pubdate:string,title:string>>,"
    "descript:struct<abstract:string,purpose:string,supplinf:string>,"
    "timeperd:struct<timeinfo:struct<rngdates:struct<begdate:string,enddate:string>>>,"
    "spdom:struct<bounding:struct<westbc:string,eastbc:string,northbc:string,southbc:string>>,"
    "keywords:struct<theme:array<struct<themekey:array<string>>>,"
    "place:array<struct<placekt:string>>>,"
    f"ptcontac:array<{_FGDC_PARTY}>>, "
    f"distinfo struct<distrib:array<{_FGDC_PARTY}>>, "
    f"metainfo struct<metd:string,metc:array<{_FGDC_PARTY}>>, "
    f"{CORRUPT} string"
)

_ID = "identificationInfo.MD_DataIdentification"
_CITE = f"{_ID}.citation.CI_Citation"
_GROUP = f"{_ID}.descriptiveKeywords.MD_Keywords"
_THESAURUS = f"{_GROUP}.thesaurusName.CI_Citation"
_BOX = f"{_ID}.extent.EX_Extent.geographicElement.EX_GeographicBoundingBox"
_PERIOD = f"{_ID}.extent.EX_Extent.temporalElement.EX_TemporalExtent.extent.TimePeriod"
_DISTRIBUTION = "distributionInfo.MD_Distribution"
_CITEINFO = "idinfo.citation.citeinfo"
_RANGE = "idinfo.timeperd.timeinfo.rngdates"
_BOUNDING = "idinfo.spdom.bounding"

# Where each record column comes from. A parser that is asked for few elements is faster.
PATHS = {
    "iso": {
        "title": (f"{_CITE}.title", f"{_THESAURUS}.title"),
        "abstract": (f"{_ID}.abstract",),
        "purpose": (f"{_ID}.purpose",),
        "supplement": (f"{_ID}.supplementalInformation",),
        "language_code": ("language", f"{_ID}.language"),
        "progress_code": (f"{_ID}.status",),
        "date_stamp": ("dateStamp",),
        "begin": (f"{_PERIOD}.beginPosition",),
        "end": (f"{_PERIOD}.endPosition",),
        "uri": ("dataSetURI",),
        "north": (f"{_BOX}.northBoundLatitude",),
        "south": (f"{_BOX}.southBoundLatitude",),
        "east": (f"{_BOX}.eastBoundLongitude",),
        "west": (f"{_BOX}.westBoundLongitude",),
        "version": (f"{_DISTRIBUTION}.distributionFormat",),
        "citation": (f"{_CITE}.otherCitationDetails",),
        "keyword_groups": (f"{_GROUP}.keyword", f"{_GROUP}.type"),
        "point_of_contact": (f"{_ID}.pointOfContact",),
        "maintainer": ("metadataMaintenance",),
        "distributor": (f"{_DISTRIBUTION}.distributor",),
        "cited": (f"{_CITE}.citedResponsibleParty", f"{_THESAURUS}.citedResponsibleParty"),
    },
    "fgdc": {
        "title": (f"{_CITEINFO}.title",),
        "abstract": ("idinfo.descript.abstract",),
        "purpose": ("idinfo.descript.purpose",),
        "supplement": ("idinfo.descript.supplinf",),
        "published": (f"{_CITEINFO}.pubdate",),
        "begin": (f"{_RANGE}.begdate",),
        "end": (f"{_RANGE}.enddate",),
        "north": (f"{_BOUNDING}.northbc",),
        "south": (f"{_BOUNDING}.southbc",),
        "east": (f"{_BOUNDING}.eastbc",),
        "west": (f"{_BOUNDING}.westbc",),
        "theme_keys": ("idinfo.keywords.theme",),
        "places": ("idinfo.keywords.place",),
        "metadata_date": ("metainfo.metd",),
        "revised": (),
        "depth_max": (),
        "depth_min": (),
        "points_of_contact": ("idinfo.ptcontac",),
        "distributors": ("distinfo.distrib",),
        "maintainers": ("metainfo.metc",),
        "origins": (f"{_CITEINFO}.origin",),
    },
}

# Columns of elements that are read wherever they occur.
UNPLACED = {
    "iso": {},
    "fgdc": {"revised": "revdate", "depth_max": "depthmax", "depth_min": "depthmix"},
}

_DDL = {"iso": ISO_SCHEMA, "fgdc": FGDC_SCHEMA}


@functools.cache
def _whole(dialect: str) -> StructType:
    return StructType.fromDDL(_DDL[dialect])


def _prune(schema: StructType, paths: Sequence[Sequence[str]]) -> StructType:
    """The part of a schema that lies on the paths."""
    kept = []
    for field in schema.fields:
        below = [path[1:] for path in paths if path[0] == field.name]
        if not below:
            continue
        kind = field.dataType
        if all(below):
            inner = kind.elementType if isinstance(kind, ArrayType) else kind
            inner = _prune(inner, below)
            kind = ArrayType(inner) if isinstance(kind, ArrayType) else inner
        kept.append(StructField(field.name, kind))
    return StructType(kept)


def document_schema(dialect: str, columns: Sequence[str] | None = None) -> StructType:
    """The schema to parse with, for all record columns or for some."""
    if columns is None:
        return _whole(dialect)
    paths = [path.split(".") for name in columns for path in PATHS[dialect][name]]
    return _prune(_whole(dialect), [*paths, [CORRUPT]])
