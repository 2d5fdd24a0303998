"""Fixed code lists and the parameters of a harmonisation run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from cartulary.vocabulary import CATEGORIES

# Code lists, formats and notices that the output must carry verbatim.
LANGUAGE_CODES = {
    "eng; CAN": "en",
    "fra; CAN": "fr",
}
PROGRESS_CODES = {
    "underDevelopment": "underDevelopment",
    "ongoing": "onGoing",
    "completed": "completed",
    "planned": "planned",
}
ROLE_CODES = {
    "Originator": "originator",
    "Collaborator": "collaborator",
    "Author": "author",
    "coAuthor": "coauthor",
    "pointOfContact": "pointOfContact",
    "principalInvestigator": "principalInvestigator",
}
UNPUBLISHED_CITATIONS = ("unpublished data", "unpublished")
UNDEFINED_DATE = "Undefined"
DEFAULT_EDITION = "1.0"
DEFAULT_CATEGORY = "other"
IDENTIFIER_PREFIX = "ccin-"
DOI_RESOLVER = "https://doi.org/"
DOI_PREFIXES = ("10.21963",)
MACHINE_TRANSLATION_NOTICE = (
    "text translated using the Amazon translate service / "
    "texte traduit à l'aide du service de traduction Amazon"
)


@dataclass(frozen=True)
class JobSettings:
    """Parameters stamped on every record of one run.

    ``house_names`` maps a whole person name, as standardised, to the name parts that
    replace it: organisations that appear where a person is expected. ``vocabulary`` maps a category
    to its terms. ``as_of`` fixes the
    revision time; when it is absent the query start time is used.
    """

    user: str = "unknown"
    status: str = "submitted"
    license: str = "CC-BY-4.0"
    region: str = ""
    projects: Sequence[str] = ()
    resource_type: Sequence[str] = ("oceanographic",)
    shares: Sequence[str] = ()
    categories: Sequence[str] = ()
    doi_status: str = "findable"
    doi_prefixes: Sequence[str] = DOI_PREFIXES
    house_names: Mapping[str, Sequence[str]] = field(default_factory=dict)
    vocabulary: Mapping[str, Sequence[str]] = field(default_factory=lambda: CATEGORIES)
    equivalent_title_en: str = "Source catalogue equivalent record"
    equivalent_title_fr: str = "Enregistrement équivalent du catalogue source"
    as_of: str | None = None
    random_keys: bool = False
