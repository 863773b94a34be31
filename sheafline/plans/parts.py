"""Pieces shared by both mappers: table columns, comments, the published JSON layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheafline.schemas import CELL, COMMENT, ONTOLOGY_SOURCE, TABLE

_CONTEXT = "https://w3id.org/ro/crate/1.1/context"


def cell(kind: str, header: str, value: Column | str) -> Column:
    """One column of a one-row protocol table; null when its value is null."""
    text = F.lit(value) if isinstance(value, str) else value
    return F.when(
        text.isNotNull(), F.struct(F.lit(kind).alias("kind"), F.lit(header).alias("header"), text.alias("value")).cast(CELL)
    )


def cells(kind: str, header: str, values: Column) -> Column:
    """One column per value, all under the same header."""
    return F.coalesce(
        F.transform(
            values,
            lambda v: F.struct(F.lit(kind).alias("kind"), F.lit(header).alias("header"), v.alias("value")).cast(CELL),
        ),
        F.array().cast(f"array<{CELL}>"),
    )


def table(name: str, columns: Column) -> Column:
    """A named table."""
    return F.struct(F.lit(name).alias("name"), columns.alias("columns")).cast(TABLE)


def framed(name: str, source: Column, parameters: Column, result: Column) -> Column:
    """Input column, parameter columns, output column."""
    return table(name, F.concat(F.array(source), parameters, F.array(result)))


def comment(name: str | Column, value: Column) -> Column:
    """A named comment; null when the value is null."""
    label = F.lit(name) if isinstance(name, str) else name
    return F.when(value.isNotNull(), F.struct(label.alias("name"), value.alias("value")).cast(COMMENT))


def ontology_source(name: Column | str, file: str | None, version: Column | str, description: str) -> Column:
    """A vocabulary reference."""
    def col(x):
        return x if isinstance(x, Column) else F.lit(x)

    return F.struct(
        col(name).alias("name"), F.lit(file).alias("file"), col(version).alias("version"), F.lit(description).alias("description")
    ).cast(ONTOLOGY_SOURCE)


def crate_json(investigation: Column, study: Column, assay: Column, files: Column) -> Column:
    """The published document: a JSON-LD graph whose root ``./`` carries the identifier.

    Layout: a metadata entity, the root (investigation), the study and the assay, each with the fields of
    its nested row. Absent values are left out.
    """
    node = (
        "struct<`@id`:string,`@type`:string,additionalType:string,about:struct<`@id`:string>,identifier:string,"
        "name:string,description:string,datePublished:string,hasPart:array<struct<`@id`:string>>,"
        "creator:array<struct<familyName:string,givenName:string,email:string,affiliation:string,address:string,"
        "telephone:string,faxNumber:string,jobTitle:array<struct<name:string,tan:string,tsr:string>>,"
        "comment:array<struct<name:string,value:string>>>>,"
        "citation:array<struct<name:string,author:string,identifier:string>>,"
        "comment:array<struct<name:string,text:string>>,"
        "mentions:array<struct<name:string,url:string,version:string,description:string>>,"
        "variableMeasured:struct<name:string,tan:string,tsr:string>,"
        "measurementMethod:struct<name:string,tan:string,tsr:string>,"
        "measurementTechnique:struct<name:string,tan:string,tsr:string>,"
        "processTable:array<struct<name:string,columns:array<struct<kind:string,header:string,value:string>>>>>"
    )
    names = [
        "@id", "@type", "additionalType", "about", "identifier", "name", "description", "datePublished", "hasPart",
        "creator", "citation", "comment", "mentions", "variableMeasured", "measurementMethod", "measurementTechnique",
        "processTable",
    ]

    def entity(**given: Column) -> Column:
        return F.struct(*[given.get(n.replace("@", ""), F.lit(None)).alias(n) for n in names]).cast(node)

    def ref(path: Column) -> Column:
        return F.struct(path.alias("@id"))

    study_path = F.concat(F.lit("studies/"), study["identifier"], F.lit("/"))
    assay_path = F.concat(F.lit("assays/"), assay["identifier"], F.lit("/"))
    root = entity(
        id=F.lit("./"),
        type=F.lit("Dataset"),
        additionalType=F.lit("Investigation"),
        identifier=investigation["identifier"],
        name=investigation["title"],
        description=investigation["description"],
        datePublished=investigation["submission_date"],
        hasPart=F.concat(F.array(ref(study_path), ref(assay_path)), F.transform(files, ref)),
        creator=investigation["contacts"],
        citation=investigation["publications"],
        comment=investigation["comments"],
        mentions=investigation["ontology_sources"],
    )
    meta = entity(
        id=F.lit("ro-crate-metadata.json"), type=F.lit("CreativeWork"), about=F.struct(F.lit("./").alias("@id"))
    )
    study_entity = entity(
        id=study_path,
        type=F.lit("Dataset"),
        additionalType=F.lit("Study"),
        identifier=study["identifier"],
        name=study["title"],
        description=study["description"],
        datePublished=study["submission_date"],
        hasPart=F.transform(study["registered_assays"], lambda a: ref(F.concat(F.lit("assays/"), a, F.lit("/")))),
        processTable=study["tables"],
    )
    assay_entity = entity(
        id=assay_path,
        type=F.lit("Dataset"),
        additionalType=F.lit("Assay"),
        identifier=assay["identifier"],
        name=assay["title"],
        variableMeasured=assay["measurement_type"],
        measurementMethod=assay["technology_type"],
        measurementTechnique=assay["technology_platform"],
        processTable=assay["tables"],
    )
    return F.to_json(
        F.struct(F.lit(_CONTEXT).alias("@context"), F.array(meta, root, study_entity, assay_entity).alias("@graph"))
    )
