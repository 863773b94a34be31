"""One full catalogue record per document: every extracted field, the mapped parts and the archive, against SQL."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from sheafline.checks.base import check, s, slug_sql, table
from sheafline.checks.builders import cells_text
from sheafline.plans.record_arc import map_records
from sheafline.session import scratch_path
from sheafline.sources import iso, sinks


def _text(name: str, value: str) -> str:
    return f"<gmd:{name}><gco:CharacterString> {value} </gco:CharacterString></gmd:{name}>"


def _anchor(name: str, value: str, href: str) -> str:
    return f'<gmd:{name}><gmx:Anchor xlink:href="{href}">{value}</gmx:Anchor></gmd:{name}>'


def _code(name: str, kind: str, value: str) -> str:
    return f'<gmd:{name}><gmd:{kind} codeListValue="{value}">x</gmd:{kind}></gmd:{name}>'


def _dated(day: str, kind: str) -> str:
    stamp = f"<gmd:date><gco:Date>{day}</gco:Date></gmd:date>"
    return f"<gmd:date><gmd:CI_Date>{stamp}{_code('dateType', 'CI_DateTypeCode', kind)}</gmd:CI_Date></gmd:date>"


def _online(url: str, *rest: str) -> str:
    link = f"<gmd:linkage><gmd:URL>{url}</gmd:URL></gmd:linkage>"
    return f"<gmd:onLine><gmd:CI_OnlineResource>{link}{''.join(rest)}</gmd:CI_OnlineResource></gmd:onLine>"


# {K}, {S} and {L} stand for doc_id, source and lang.
_RECORD = "".join(
    [
        '<gmd:MD_Metadata xmlns:gmd="g" xmlns:gco="c" xmlns:gmx="x" xmlns:xlink="l">',
        _text("fileIdentifier", "f-{K}"),
        "<gmd:dateStamp><gco:Date>2020-01-{K}</gco:Date></gmd:dateStamp>",
        "<gmd:referenceSystemInfo><gmd:MD_ReferenceSystem><gmd:referenceSystemIdentifier><gmd:RS_Identifier>",
        _anchor("code", "EPSG:{K}", "http://epsg/{K}"),
        _text("codeSpace", "{L}"),
        "</gmd:RS_Identifier></gmd:referenceSystemIdentifier></gmd:MD_ReferenceSystem></gmd:referenceSystemInfo>",
        "<gmd:identificationInfo><gmd:MD_DataIdentification><gmd:citation><gmd:CI_Citation>",
        _text("title", "{S} no {K}"),
        _dated("2001-{K}", "creation") + _dated("2002-{K}", "revision"),
        "</gmd:CI_Citation></gmd:citation>",
        _text("abstract", "about {S}"),
        _text("purpose", "for {L}"),
        "<gmd:graphicOverview><gmd:MD_BrowseGraphic>" + _text("fileName", "g{K}.png") + "</gmd:MD_BrowseGraphic></gmd:graphicOverview>",
        "<gmd:resourceConstraints><gmd:MD_Constraints>" + _text("useLimitation", "use {L}") + "</gmd:MD_Constraints></gmd:resourceConstraints>",
        "<gmd:resourceConstraints><gmd:MD_LegalConstraints>",
        _code("accessConstraints", "MD_RestrictionCode", "license"),
        _code("useConstraints", "MD_RestrictionCode", "copyright"),
        _anchor("otherConstraints", "free {S}", "http://free/{K}"),
        "</gmd:MD_LegalConstraints></gmd:resourceConstraints>",
        _text("supplementalInformation", "more on {K}"),
        "</gmd:MD_DataIdentification></gmd:identificationInfo>",
        "<gmd:distributionInfo><gmd:MD_Distribution><gmd:distributionFormat><gmd:MD_Format>",
        _anchor("name", "CSV{L}", "http://csv/{L}"),
        _text("version", "v{K}"),
        "</gmd:MD_Format></gmd:distributionFormat><gmd:transferOptions><gmd:MD_DigitalTransferOptions>",
        _online(
            "http://one/{K}", _text("protocol", "WFS"), _text("name", "n-{S}"), _text("description", "d-{L}"),
            _code("function", "CI_OnLineFunctionCode", "download"),
        ),
        _online("http://two/{K}"),
        "</gmd:MD_DigitalTransferOptions></gmd:transferOptions></gmd:MD_Distribution></gmd:distributionInfo>",
        "<gmd:dataQualityInfo><gmd:DQ_DataQuality><gmd:lineage><gmd:LI_Lineage>",
        _anchor("statement", "made in {S}", "http://lineage/{K}"),
        "</gmd:LI_Lineage></gmd:lineage></gmd:DQ_DataQuality></gmd:dataQualityInfo></gmd:MD_Metadata>",
    ]
)
_COLUMN = {"K": "doc_id", "S": "source", "L": "lang"}


def _parts() -> list[str]:
    return re.split(r"\{([KSL])\}", _RECORD)


def _records(spark, d):
    """The records of all documents, read from their responses."""
    element = F.concat(*[F.col(_COLUMN[p]).cast("string") if k % 2 else s(p) for k, p in enumerate(_parts())])
    body = F.concat(s('<r numberOfRecordsMatched="1">'), element, s("</r>"))
    return iso.read_iso(
        table(spark, d, "documents").select(F.col("lang").alias("rdi"), F.col("doc_id").alias("batch"), body.alias("body"))
    )


_RAW_SQL = " || ".join(_COLUMN[p] if k % 2 else "'" + p + "'" for k, p in enumerate(_parts()))


def _rows_text(name: str, *fields: str):
    """An array of structs as one text; absent fields are dashes."""
    return F.array_join(
        F.transform(name, lambda x: F.concat_ws("|", *[F.coalesce(x[f].cast("string"), s("-")) for f in fields])), ";;"
    )


@check(
    "iso_fields",
    "FN32 FN34 FN35 FN36 SC1",
    """
SELECT doc_id, 'f-' || doc_id AS identifier, '2020-01-' || doc_id AS date_stamp, 'made in ' || source AS lineage,
       'http://lineage/' || doc_id AS lineage_url, '2001-' || doc_id || '|creation;;2002-' || doc_id || '|revision' AS dates,
       'CSV' || lang || '|v' || doc_id || '|-|http://csv/' || lang || '|-|-' AS formats,
       'http://one/' || doc_id || '|WFS|n-' || source || '|d-' || lang || '|download;;http://two/' || doc_id || '|-|-|-|-' AS online,
       'EPSG:' || doc_id || '|http://epsg/' || doc_id || '|' || lang || '|-|-|-' AS reference_systems,
       'use ' || lang AS limits, 'license' AS access, 'copyright' AS use, 'free ' || source || '|http://free/' || doc_id AS other,
       'g' || doc_id || '.png' AS graphics, 'for ' || lang AS purpose, 'more on ' || doc_id AS supplemental FROM documents
""",
)
def iso_fields(spark, d):
    return _records(spark, d).select(
        F.col("batch").alias("doc_id"),
        "identifier",
        "date_stamp",
        "lineage",
        "lineage_url",
        _rows_text("dates", "date", "datetype").alias("dates"),
        _rows_text("distribution_formats", "name", "version", "specification", "name_url", "version_url", "specification_url").alias("formats"),
        _rows_text("online_resources", "url", "protocol", "name", "description", "function").alias("online"),
        _rows_text("reference_systems", "code", "code_url", "codespace", "codespace_url", "version", "version_url").alias("reference_systems"),
        F.array_join("constraints", ";").alias("limits"),
        F.array_join("access_constraints", ";").alias("access"),
        F.array_join("use_constraints", ";").alias("use"),
        F.concat_ws("|", F.array_join("other_constraints", ";"), F.array_join("other_constraints_url", ";")).alias("other"),
        F.array_join("graphic_overviews", ";").alias("graphics"),
        "purpose",
        F.col("supplemental_information").alias("supplemental"),
    )


_SLUG = slug_sql("source || ' no ' || doc_id")


@check(
    "record_parts",
    "FN24 FN25 FN26 JN13",
    f"""
SELECT doc_id, 'f-' || doc_id AS investigation_id, source || ' no ' || doc_id AS title, 'about ' || source AS description,
       '2020-01-' || doc_id AS submitted, {_SLUG} AS study_id,
       'Lineage: made in ' || source || ' | Purpose: for ' || lang || ' | Supplemental: more on ' || doc_id AS study_description,
       {_SLUG} AS registered, {_SLUG} AS assay_id, 'Data Collection' AS technology, 'Measurement' AS assay_table,
       'input|Source Name|Dataset Source;;output|URI|http://one/' || doc_id || ';;comment|Online Resource|http://two/' || doc_id
         || ';;comment|Graphic Overview|g' || doc_id || '.png' AS assay_cells,
       'iso19115.xml' AS files FROM documents
""",
)
def record_parts(spark, d):
    first = F.get(F.col("assay.tables"), F.lit(0))
    return map_records(_records(spark, d).drop("record_id", "error", "pos", "rdi")).select(
        F.col("batch").alias("doc_id"),
        F.col("investigation.identifier").alias("investigation_id"),
        F.col("investigation.title").alias("title"),
        F.col("investigation.description").alias("description"),
        F.col("investigation.submission_date").alias("submitted"),
        F.col("study.identifier").alias("study_id"),
        F.col("study.description").alias("study_description"),
        F.array_join("study.registered_assays", ";").alias("registered"),
        F.col("assay.identifier").alias("assay_id"),
        F.col("assay.technology_type.name").alias("technology"),
        first["name"].alias("assay_table"),
        cells_text(first).alias("assay_cells"),
        F.array_join("files", ";").alias("files"),
    )


@check(
    "archive_roundtrip",
    "SC12",
    f"SELECT lang AS rdi, 'f-' || doc_id AS identifier, md5({_RAW_SQL}) AS raw_md5 FROM documents",
)
def archive_roundtrip(spark, d):
    path = scratch_path(spark, "archive")
    sinks.write_archive(_records(spark, d), path)
    back = spark.read.schema("identifier string, raw_xml binary, rdi string").parquet(path)
    return back.select("rdi", "identifier", F.md5("raw_xml").alias("raw_md5"))
