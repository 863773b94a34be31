"""Reference-shaped inputs built from driver rows, one row at a time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheafline.checks.base import code_el, text_el
from sheafline.schemas import RECORD_FIELDS
from sheafline.sources.iso import contact


def record_fields(**given: Column):
    """Field name -> column, absent fields typed null or empty."""

    def r(name: str) -> Column:
        ddl = RECORD_FIELDS[name]
        if name in given:
            return given[name].cast(ddl)
        if ddl.startswith("array") and name != "spatial_extent":
            return F.array().cast(ddl)
        return F.lit(None).cast(ddl)

    return r


def full_contact(name: Column, **fields: Column) -> Column:
    """A contact with any of its fields."""
    none = F.lit(None).cast("string")
    row = contact(name, fields.get("organization", none), fields.get("email", none), fields.get("role", none), fields.get("type", none))
    for key, value in fields.items():
        row = row.withField(key, value)
    return row


def cells_text(table: Column) -> Column:
    """A protocol table as one text: ``kind|header|value`` per column."""
    return F.array_join(
        F.transform(table["columns"], lambda c: F.concat_ws("|", c["kind"], c["header"], c["value"])), ";;"
    )


def pairs_text(pairs: Column) -> Column:
    """Comments as one text: ``name|value`` each."""
    return F.array_join(F.transform(pairs, lambda c: F.concat_ws("|", c["name"], c["value"])), ";;")


def iso_record(identifier: Column, title: Column, abstract: Column, **more: Column) -> Column:
    """XML of one catalogue record."""
    citation = [text_el(title).alias("title")]
    if "code" in more:
        citation.append(F.struct(F.struct(text_el(more["code"]).alias("code")).alias("MD_Identifier")).alias("identifier"))
    ident = [
        F.struct(F.struct(*citation).alias("CI_Citation")).alias("citation"),
        text_el(abstract).alias("abstract"),
    ]
    if "keywords" in more:
        ident.append(
            F.struct(F.struct(F.transform(more["keywords"], text_el).alias("keyword")).alias("MD_Keywords")).alias(
                "descriptiveKeywords"
            )
        )
    if "denominator" in more:
        fraction = F.struct(F.struct(more["denominator"].alias("Integer")).alias("denominator"))
        ident.append(
            F.struct(F.struct(F.struct(fraction.alias("MD_RepresentativeFraction")).alias("equivalentScale")).alias("MD_Resolution")).alias(
                "spatialResolution"
            )
        )
    parts = [text_el(identifier).alias("fileIdentifier")]
    if "language" in more:
        parts.append(code_el(more["language"], "LanguageCode").alias("language"))
    if "hierarchy" in more:
        parts.append(code_el(more["hierarchy"], "MD_ScopeCode").alias("hierarchyLevel"))
    if "contact" in more:
        party = F.struct(
            text_el(more["contact"]).alias("individualName"), code_el(F.lit("owner"), "CI_RoleCode").alias("role")
        )
        parts.append(F.struct(party.alias("CI_ResponsibleParty")).alias("contact"))
    parts.append(F.struct(F.struct(*ident).alias("MD_DataIdentification")).alias("identificationInfo"))
    return F.to_xml(F.struct(*parts), {"rowTag": "MD_Metadata"})


def iso_response(matches: Column, *records: Column) -> Column:
    """One response body."""
    return F.concat(
        F.lit('<GetRecordsResponse><SearchResults numberOfRecordsMatched="'),
        matches.cast("string"),
        F.lit('">'),
        *records,
        F.lit("</SearchResults></GetRecordsResponse>"),
    )
