"""Controlled vocabularies as literal maps (a fixed handful of rows: no join needed)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheafline.functions.text import truthy
from sheafline.schemas import TERM

_OBO = "http://purl.obolibrary.org/obo/"

# Role code -> (label, term, vocabulary). Keys are camel case and looked up in lower case,
# so only the one-word roles can match.
ROLE_TERMS = {
    "pointOfContact": ("Point of Contact", _OBO + "NCIT_C70902", "NCIT"),
    "custodian": ("Custodian", _OBO + "NCIT_C70903", "NCIT"),
    "owner": ("Owner", _OBO + "NCIT_C70904", "NCIT"),
    "user": ("User", _OBO + "NCIT_C70905", "NCIT"),
    "distributor": ("Distributor", _OBO + "NCIT_C70906", "NCIT"),
    "originator": ("Originator", _OBO + "NCIT_C70907", "NCIT"),
    "publisher": ("Publisher", _OBO + "NCIT_C70908", "NCIT"),
    "author": ("Author", _OBO + "NCIT_C70909", "NCIT"),
    "principalInvestigator": ("Principal Investigator", _OBO + "NCIT_C70910", "NCIT"),
    "processor": ("Processor", _OBO + "NCIT_C70911", "NCIT"),
    "metadataContact": ("Metadata Contact", _OBO + "NCIT_C70912", "NCIT"),
}

# Topic category -> (measurement label, term, vocabulary).
TOPIC_TERMS = {
    "biota": ("Biological Measurement", _OBO + "NCIT_C19026", "NCIT"),
    "boundaries": ("Boundary Measurement", _OBO + "NCIT_C19027", "NCIT"),
    "climatologyMeteorologyAtmosphere": ("Atmospheric Measurement", _OBO + "ENVO_01000818", "ENVO"),
    "economy": ("Economic Measurement", _OBO + "NCIT_C19029", "NCIT"),
    "elevation": ("Elevation Measurement", _OBO + "ENVO_00002001", "ENVO"),
    "environment": ("Environmental Measurement", _OBO + "ENVO_01000819", "ENVO"),
    "farming": ("Agricultural Measurement", _OBO + "AGRO_00000001", "AGRO"),
    "geoscientificInformation": ("Geoscientific Measurement", _OBO + "ENVO_01000820", "ENVO"),
    "health": ("Health Measurement", _OBO + "NCIT_C19034", "NCIT"),
    "imageryBaseMapsEarthCover": ("Remote Sensing Measurement", _OBO + "ENVO_01000817", "ENVO"),
    "inlandWaters": ("Hydrological Measurement", _OBO + "ENVO_01000821", "ENVO"),
    "intelligenceMilitary": ("Military Measurement", _OBO + "NCIT_C19037", "NCIT"),
    "location": ("Location Measurement", _OBO + "NCIT_C19038", "NCIT"),
    "oceans": ("Oceanographic Measurement", _OBO + "ENVO_00000015", "ENVO"),
    "planningCadastre": ("Cadastre Measurement", _OBO + "NCIT_C19040", "NCIT"),
    "society": ("Social Measurement", _OBO + "NCIT_C19041", "NCIT"),
    "structure": ("Structural Measurement", _OBO + "NCIT_C19042", "NCIT"),
    "transportation": ("Transportation Measurement", _OBO + "NCIT_C19043", "NCIT"),
    "utilitiesCommunication": ("Utility Measurement", _OBO + "NCIT_C19044", "NCIT"),
}
DEFAULT_TOPIC_TERM = ("Spatial Data Acquisition", _OBO + "NCIT_C19026", "NCIT")

# Vocabularies every mapped record refers to, as (name, file, description).
RECORD_VOCABULARIES = (
    ("NCIT", _OBO + "ncit.owl", "NCI Thesaurus"),
    ("GEMET", "http://www.eionet.europa.eu/gemet", "GEMET Thesaurus"),
    ("EDAM", "http://edamontology.org", "EDAM Bioinformatics Ontology"),
    ("ISO", "http://www.isotc211.org/2005/gco", "ISO Geospatial Metadata"),
)
GRAPH_VOCABULARIES = (
    ("SCHEMAORG", "https://schema.org/", "Schema.org vocabulary for structured data"),
    ("NCIT", _OBO + "ncit.owl", "NCI Thesaurus"),
    ("EDAM", "http://edamontology.org", "EDAM Bioinformatics Ontology"),
)


def term(name: Column | str, tan: str | None = None, tsr: str | None = None) -> Column:
    """A vocabulary term; label only when no accession is given."""
    label = F.lit(name) if isinstance(name, str) else name
    return F.struct(label.alias("name"), F.lit(tan).alias("tan"), F.lit(tsr).alias("tsr")).cast(TERM)


def _term_map(terms: dict[str, tuple[str, str, str]]) -> Column:
    pairs = [col for key, value in terms.items() for col in (F.lit(key), term(*value))]
    return F.create_map(*pairs)


def role_term(role: Column) -> Column:
    """Term of a role code, the raw role when unknown, null without a role."""
    known = F.try_element_at(_term_map(ROLE_TERMS), F.lower(role))
    return F.when(truthy(role).isNotNull(), F.coalesce(known, term(role)))


def topic_term(topics: Column) -> Column:
    """Measurement term of the first topic category."""
    topic = F.get(topics, F.lit(0))
    known = F.try_element_at(_term_map(TOPIC_TERMS), topic)
    return F.when(F.size(F.coalesce(topics, F.array().cast("array<string>"))) == 0, term(*DEFAULT_TOPIC_TERM)).otherwise(
        F.coalesce(known, term(topic))
    )
