"""The built-in subject vocabulary: ocean variables and the keywords that imply them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# Category -> keywords, in the published order. Categories without keywords
# are valid targets of a manual choice but are never derived from keywords.
CATEGORIES: dict[str, list[str]] = {
    "oceanSurfaceStress": ["Air-water exchange", "Water-air gas exchange"],
    "airWaterExchange": ["Air-water exchange", "Water-air gas exchange"],
    "seaIce": [
        "Ice",
        "Iceberg",
        "Ice island",
        "Ice drift",
        "Sea ice",
        "Ice thickness",
        "Ice pack motion",
        "Cryosphere",
    ],
    "seaSurfaceHeight": [],
    "seaSurfaceTemperature": [],
    "subSurfaceTemperature": ["Temperature", "CTD profiles"],
    "surfaceCurrents": [],
    "subSurfaceCurrents": ["Ocean currents"],
    "seaSurfaceSalinity": [],
    "subSurfaceSalinity": ["Salinity", "CTD profiles", "Conductivity"],
    "oceanSurfaceHeatFlux": [
        "Solar radiation",
        "Photosynthetically available radiation (PAR)",
        "Radiation",
    ],
    "oceanBottomPressure": [],
    "turbulentDiapycnalFluxes": [],
    "oxygen": ["Oxygen"],
    "nutrients": ["Nitrogen", "Nutrients"],
    "inorganicCarbon": ["Particulate organic carbon", "Carbon fluxes", "Carbon dioxide"],
    "transientTracers": [
        "Contaminants",
        "Bromine oxide",
        "Mercury",
        "Methylmercury",
        "Organophosphate flame retardants",
        "DDT",
        "PCBs",
        "Bioaccumulation",
        "Perfluoro contaminants",
    ],
    "particulateMatter": ["Transmittance", "Sediment fluxes", "Sediments"],
    "nitrousOxide": [],
    "stableCarbonIsotopes": [],
    "dissolvedOrganicCarbon": [
        "Dissolved organic carbon (DOC)",
        "Organic carbon",
        "Colored dissolved organic material (CDOM)",
    ],
    "phytoplanktonBiomassAndDiversity": ["Chlorophyll", "Phytoplankton", "Ice algae"],
    "zooplanktonBiomassAndDiversity": ["Zooplankton", "Megazoobenthos"],
    "fishAbundanceAndDistribution": ["Fishes", "Arctic Cod", "Arctic cod", "Fish larvae"],
    "marineTurtlesBirdsMammalsAbundanceAndDistribution": ["Seals", "Marine mammals"],
    "hardCoralCoverAndComposition": ["Corals"],
    "seagrassCoverAndComposition": [],
    "macroalgalCanopyCoverAndComposition": [],
    "mangroveCoverAndComposition": [],
    "microbeBiomassAndDiversity": ["Bateria"],
    "invertebrateAbundanceAndDistribution": ["Invertebrates"],
    "oceanColour": ["Fluorescence", "Chlorophyll"],
    "oceanSound": [],
    "marineDebris": ["Plastics"],
}


def term_pairs(categories: Mapping[str, Sequence[str]] = CATEGORIES) -> list[tuple[str, str]]:
    """All (category, term) pairs, categories without terms left out."""
    return [(category, term) for category, terms in categories.items() for term in terms or ()]


def categories_by_term(
    categories: Mapping[str, Sequence[str]] = CATEGORIES,
) -> dict[str, list[str]]:
    """The inverse view used for lookups: term -> categories."""
    inverse: dict[str, list[str]] = {}
    for category, term in term_pairs(categories):
        inverse.setdefault(term, []).append(category)
    return inverse


def vocabulary_table(
    spark: SparkSession, categories: Mapping[str, Sequence[str]] = CATEGORIES
) -> DataFrame:
    """The vocabulary as a ``(category, term)`` table."""
    return spark.createDataFrame(term_pairs(categories), "category string, term string")
