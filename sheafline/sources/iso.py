"""ISO 19139 catalogue responses -> typed records.

A response body is cut into record elements first and every element is parsed on its own with a declared
schema, so one broken record costs one error row and the original text is kept for archiving. All of it is
row-local: no shuffle, and the same expressions serve streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.functions.text import parse_float, parse_int, truthy, truthy_list
from sheafline.operators.fallback import RANDOM_PREFIX
from sheafline.schemas import CONTACT, RECORD_FIELDS
from sheafline.operators.once import compute_once
from sheafline.session import built_once

_TEXT = "struct<CharacterString:string,Anchor:struct<_VALUE:string,_href:string>>"
_DATE = "struct<Date:string,DateTime:string>"
_CODE = "struct<_VALUE:string,_codeListValue:string>"
_PARTY = (
    f"struct<individualName:{_TEXT},organisationName:{_TEXT},positionName:{_TEXT},"
    f"contactInfo:struct<CI_Contact:struct<address:struct<CI_Address:struct<electronicMailAddress:array<{_TEXT}>>>>>,"
    f"role:struct<CI_RoleCode:{_CODE}>>"
)
_PARTIES = f"array<struct<CI_ResponsibleParty:{_PARTY}>>"
_CITATION_DATE = f"struct<CI_Date:struct<date:{_DATE},dateType:struct<CI_DateTypeCode:{_CODE}>>>"
_IDENT_CODE = f"struct<code:{_TEXT},codeSpace:{_TEXT},version:{_TEXT}>"
_PERIOD = "struct<beginPosition:string,endPosition:string>"
_IDENTIFICATION = (
    "struct<citation:struct<CI_Citation:struct<"
    f"title:{_TEXT},alternateTitle:{_TEXT},date:array<{_CITATION_DATE}>,edition:{_TEXT},"
    f"identifier:array<struct<MD_Identifier:{_IDENT_CODE},RS_Identifier:{_IDENT_CODE}>>>>,"
    f"abstract:{_TEXT},purpose:{_TEXT},status:struct<MD_ProgressCode:{_CODE}>,pointOfContact:{_PARTIES},"
    f"graphicOverview:array<struct<MD_BrowseGraphic:struct<fileName:{_TEXT}>>>,"
    f"descriptiveKeywords:array<struct<MD_Keywords:struct<keyword:array<{_TEXT}>>>>,"
    "resourceConstraints:array<struct<"
    f"MD_Constraints:struct<useLimitation:array<{_TEXT}>>,"
    f"MD_SecurityConstraints:struct<classification:array<struct<MD_ClassificationCode:{_CODE}>>,useLimitation:array<{_TEXT}>>,"
    f"MD_LegalConstraints:struct<useLimitation:array<{_TEXT}>,"
    f"accessConstraints:array<struct<MD_RestrictionCode:{_CODE},MD_ClassificationCode:{_CODE}>>,"
    f"useConstraints:array<struct<MD_RestrictionCode:{_CODE}>>,otherConstraints:array<{_TEXT}>>>>,"
    "spatialResolution:array<struct<MD_Resolution:struct<"
    "equivalentScale:struct<MD_RepresentativeFraction:struct<denominator:struct<Integer:string>>>,"
    "distance:struct<Distance:struct<_VALUE:string,_uom:string>>>>>,"
    f"language:array<struct<CharacterString:string,LanguageCode:{_CODE}>>,"
    "topicCategory:array<struct<MD_TopicCategoryCode:string>>,"
    "extent:array<struct<EX_Extent:struct<"
    "geographicElement:array<struct<EX_GeographicBoundingBox:struct<westBoundLongitude:struct<Decimal:string>,"
    "eastBoundLongitude:struct<Decimal:string>,southBoundLatitude:struct<Decimal:string>,"
    "northBoundLatitude:struct<Decimal:string>>>>,"
    f"temporalElement:array<struct<EX_TemporalExtent:struct<extent:struct<TimePeriod:{_PERIOD}>>>>>>>,"
    f"supplementalInformation:{_TEXT}>"
)

#: Declared XML shape of one record element, namespace prefixes ignored.
RECORD_XML = (
    f"fileIdentifier {_TEXT}, parentIdentifier {_TEXT}, "
    f"language struct<CharacterString:string,LanguageCode:{_CODE}>, "
    f"characterSet struct<MD_CharacterSetCode:{_CODE}>, hierarchyLevel array<struct<MD_ScopeCode:{_CODE}>>, "
    f"contact {_PARTIES}, dateStamp {_DATE}, metadataStandardName {_TEXT}, metadataStandardVersion {_TEXT}, "
    f"dataSetURI {_TEXT}, "
    f"referenceSystemInfo array<struct<MD_ReferenceSystem:struct<referenceSystemIdentifier:struct<RS_Identifier:{_IDENT_CODE}>>>>, "
    f"identificationInfo array<struct<MD_DataIdentification:{_IDENTIFICATION},SV_ServiceIdentification:{_IDENTIFICATION}>>, "
    "distributionInfo struct<MD_Distribution:struct<"
    f"distributionFormat:array<struct<MD_Format:struct<name:{_TEXT},version:{_TEXT},specification:{_TEXT}>>>,"
    "transferOptions:array<struct<MD_DigitalTransferOptions:struct<onLine:array<struct<CI_OnlineResource:struct<"
    f"linkage:struct<URL:string>,protocol:{_TEXT},name:{_TEXT},description:{_TEXT},"
    f"function:struct<CI_OnLineFunctionCode:{_CODE}>>>>>>>>>, "
    "dataQualityInfo array<struct<DQ_DataQuality:struct<"
    f"lineage:struct<LI_Lineage:struct<statement:{_TEXT}>>,"
    "report:array<struct<DQ_DomainConsistency:struct<result:array<struct<DQ_ConformanceResult:struct<"
    f"specification:struct<CI_Citation:struct<title:{_TEXT},date:array<{_CITATION_DATE}>>>,"
    "pass:struct<Boolean:string>>>>>>>>>>, _corrupt_record string"
)

_XML_OPTIONS = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "true", "mode": "PERMISSIVE"}
_RECORD_START = r"<(?:[\w.-]+:)?MD_Metadata(?=[\s>/])"
# A record up to its end tag, or an element that is closed at once.
_RECORD_CLOSED = r"(?s)\A(<[^<>]*/>|.*</(?:[\w.-]+:)?MD_Metadata\s*>)"
# A comment or CDATA section, closed or not.
_ASIDE = r"<!--.*?(?:-->|\z)|<!\[CDATA\[.*?(?:\]\]>|\z)"
# Such a section before the first record, or (group 1) a record with all that follows up to the next one. The
# possessive loop runs without recursion and never steps back.
_RECORD_PIECE = rf"(?s)(?:{_ASIDE})|({_RECORD_START}(?:[^<]++|{_ASIDE}|(?!{_RECORD_START})<)*+)"


def _txt(t: Column) -> Column:
    """Element text: a character string or the text of an anchor; an empty element has none."""
    return F.coalesce(truthy(t["CharacterString"]), truthy(t["Anchor"]["_VALUE"]))


def _href(t: Column) -> Column:
    return truthy(t["Anchor"]["_href"])


def _code(c: Column) -> Column:
    return F.coalesce(truthy(c["_codeListValue"]), truthy(c["_VALUE"]))


def _date(d: Column) -> Column:
    return F.coalesce(truthy(d["Date"]), truthy(d["DateTime"]))


def _map(arr: Column, fn) -> Column:
    """transform over a possibly missing array, missing -> empty."""
    out = F.transform(arr, fn)
    return F.coalesce(out, F.array())


def _flat(arr: Column, fn) -> Column:
    """Concatenate the lists ``fn`` yields per element; missing lists are empty."""
    return F.flatten(F.filter(F.transform(arr, fn), lambda x: x.isNotNull()))


# --- extractors over already separated parts --------------------------------------------------


def zip_identifiers(codes: Column, codespaces: Column) -> Column:
    """Codes paired with code spaces by position; the shorter list is padded, rows without code go."""
    pairs = F.arrays_zip(
        F.coalesce(codes, F.array().cast("array<string>")).alias("code"),
        F.coalesce(codespaces, F.array().cast("array<string>")).alias("codespace"),
    )
    return F.transform(
        F.filter(pairs, lambda p: truthy(p["code"]).isNotNull()),
        lambda p: F.struct(
            p["code"].alias("code"),
            p["codespace"].alias("codespace"),
            F.when(p["code"].startswith("http"), p["code"]).alias("url"),
        ),
    )


def zip_conformance(titles: Column, urls: Column, dates: Column, types: Column, degrees: Column) -> Column:
    """Conformance results by position, as long as the longest of titles, dates and degrees; no title, no row."""
    names = ("specification_title", "specification_title_url", "specification_date", "specification_datetype", "degree")
    lists = [
        F.coalesce(a, F.array().cast("array<string>")).alias(n)
        for a, n in zip((titles, urls, dates, types, degrees), names, strict=True)
    ]
    return F.transform(
        F.filter(F.arrays_zip(*lists), lambda r: truthy(r["specification_title"]).isNotNull()),
        lambda r: F.struct(*[r[n].alias(n) for n in names]),
    )


def zip_distances(values: Column, units: Column) -> Column:
    """Distances with units by position; a missing or empty unit is metres, an unreadable distance goes."""
    empty = F.array().cast("array<string>")
    # Zipped rather than looked up: what a lambda closes over is evaluated for every element.
    pairs = F.arrays_zip(F.coalesce(values, empty).alias("value"), F.coalesce(units, empty).alias("uom"))
    rows = F.transform(
        pairs,
        lambda p: F.struct(
            parse_float(p["value"]).alias("value"), F.coalesce(truthy(p["uom"]), F.lit("m")).alias("uom")
        ),
    )
    return F.filter(rows, lambda r: r["value"].isNotNull())


def denominators(values: Column) -> Column:
    """Scale denominators as whole numbers; null when one of them is unreadable (an error for the record)."""
    numbers = F.transform(truthy_list(values), parse_int)
    return F.when(~F.exists(numbers, lambda n: n.isNull()), numbers)


def bounding_box(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """``[minx, miny, maxx, maxy]``, or null when any of them is missing or unreadable."""
    numbers = [parse_float(c) for c in (minx, miny, maxx, maxy)]
    complete = numbers[0].isNotNull()
    for n in numbers[1:]:
        complete = complete & n.isNotNull()
    return F.when(complete, F.array(*numbers))


def temporal_extent(start: Column, end: Column) -> Column:
    """Period with a start; an end alone does not count."""
    return F.when(truthy(start).isNotNull(), F.struct(start.alias("start"), end.alias("end")))


def contact(name: Column, organization: Column, email: Column, role: Column, kind: Column) -> Column:
    """A contact row; only these five fields come out of a response."""
    given = {"name": name, "organization": organization, "email": email, "role": role, "type": kind}
    fields = [f.split(":")[0] for f in CONTACT[len("struct<"):-1].split(",")]
    return F.struct(*[given.get(f, F.lit(None)).cast("string").alias(f) for f in fields])


def contacts_by_role(contacts: Column, role: str) -> Column:
    """Contacts in one role."""
    return F.filter(contacts, lambda c: c["role"] == role)


def all_tagged(metadata_contacts: Column, resource_contacts: Column) -> Column:
    """Metadata contacts before resource contacts, each tagged with where it stood."""
    return F.concat(
        F.transform(metadata_contacts, lambda c: c.withField("type", F.lit("metadata"))),
        F.transform(resource_contacts, lambda c: c.withField("type", F.lit("resource"))),
    )


# --- response -> records ---------------------------------------------------------------------


def record_pieces(body: Column) -> Column:
    """Every record element of a response as text, cut at each start tag outside comments and CDATA.

    A record without end tag reaches to the next start tag, or to the end of the body, and so costs no neighbour; an
    open comment or CDATA section reaches to the end of the body. One pass over the body, whatever it holds.
    """
    plain = F.filter(F.split(body, f"(?={_RECORD_START})"), lambda p: p.rlike(rf"\A{_RECORD_START}"))
    marked = F.filter(F.regexp_extract_all(body, F.lit(_RECORD_PIECE), F.lit(1)), lambda p: p != "")
    pieces = F.when(body.contains("<!--") | body.contains("<![CDATA["), marked).otherwise(plain)
    return F.transform(pieces, closed_record)


def closed_record(piece: Column) -> Column:
    """A record element up to its end tag; all of it if there is none."""
    return F.coalesce(truthy(F.regexp_extract(piece, _RECORD_CLOSED, 1)), piece)


def parse_pieces(pieces: DataFrame) -> DataFrame:
    """Typed records and errors of record elements (``raw`` and other columns), one row per element."""
    keep = [c for c in pieces.columns if c != "raw"]
    return parse_records(compute_once(pieces, [*keep, "raw"], x=F.from_xml(F.col("raw"), RECORD_XML, _XML_OPTIONS)))


def split_records(responses: DataFrame) -> DataFrame:
    """One row per record element of each landed response: the input columns, ``pos``, ``raw`` and ``x``.

    The body is cut first and each record parsed in a row of its own; what a generator emits is not copied into
    the filters and projections above it, so a record is parsed once.
    """
    keep = [c for c in responses.columns if c != "body"]
    pieces = responses.select(*keep, F.posexplode(record_pieces(F.col("body"))).alias("pos", "raw"))
    return compute_once(pieces, [*keep, "pos", "raw"], x=F.from_xml(F.col("raw"), RECORD_XML, _XML_OPTIONS))


def page_header(body: Column) -> Column:
    """Announced total of a response; null when it is not a whole number."""
    return F.regexp_extract(body, r'numberOfRecordsMatched\s*=\s*["\'](\d+)["\']', 1).try_cast("bigint")


def _parties(list_of_parties: Column) -> Column:
    return _map(
        F.filter(list_of_parties, lambda p: p["CI_ResponsibleParty"].isNotNull()),
        lambda p: contact(
            _txt(p["CI_ResponsibleParty"]["individualName"]),
            _txt(p["CI_ResponsibleParty"]["organisationName"]),
            _txt(
                F.get(
                    p["CI_ResponsibleParty"]["contactInfo"]["CI_Contact"]["address"]["CI_Address"][
                        "electronicMailAddress"
                    ],
                    F.lit(0),
                )
            ),
            _code(p["CI_ResponsibleParty"]["role"]["CI_RoleCode"]),
            F.lit(None),
        ),
    )


def _entry_columns() -> list[Column]:
    """First identification, quality and reference entries of the parsed element ``x``."""
    ident = F.get(F.col("x.identificationInfo"), F.lit(0))
    return [
        F.coalesce(ident["MD_DataIdentification"], ident["SV_ServiceIdentification"]).alias("idn"),
        F.get(F.col("x.dataQualityInfo"), F.lit(0))["DQ_DataQuality"].alias("dq"),
        F.get(F.col("x.referenceSystemInfo"), F.lit(0))["MD_ReferenceSystem"]["referenceSystemIdentifier"][
            "RS_Identifier"
        ].alias("rs"),
        F.col("x.distributionInfo.MD_Distribution").alias("dist"),
    ]


def _list_columns() -> list[Column]:
    """Lists below those entries."""
    boxes = F.transform(
        _flat(F.col("idn.extent"), lambda e: e["EX_Extent"]["geographicElement"]),
        lambda g: g["EX_GeographicBoundingBox"],
    )
    periods = _flat(F.col("idn.extent"), lambda e: e["EX_Extent"]["temporalElement"])
    return [
        F.col("idn.citation.CI_Citation").alias("cit"),
        F.coalesce(F.col("idn.resourceConstraints"), F.array()).alias("rc"),
        F.get(F.filter(boxes, lambda b: b.isNotNull()), F.lit(0)).alias("box"),
        F.get(periods, F.lit(0))["EX_TemporalExtent"]["extent"]["TimePeriod"].alias("period"),
        F.transform(F.col("idn.resourceConstraints"), lambda r: r["MD_LegalConstraints"]).alias("legal"),
        _flat(
            F.col("dq.report"),
            lambda r: F.transform(r["DQ_DomainConsistency"]["result"], lambda q: q["DQ_ConformanceResult"]),
        ).alias("conf"),
        F.get(F.col("dist.distributionFormat"), F.lit(0))["MD_Format"].alias("fmt"),
        _flat(
            F.col("dist.transferOptions"),
            lambda t: F.transform(t["MD_DigitalTransferOptions"]["onLine"], lambda o: o["CI_OnlineResource"]),
        ).alias("online"),
        _parties(F.col("idn.pointOfContact")).alias("poc"),
        F.transform(
            "idn.citation.CI_Citation.identifier", lambda i: F.coalesce(i["MD_Identifier"], i["RS_Identifier"])
        ).alias("ids"),
    ]


def _with_parts(df: DataFrame) -> DataFrame:
    entries = df.select("*", *built_once("iso entries", _entry_columns))
    return entries.select("*", *built_once("iso lists", _list_columns))


def _extract() -> dict[str, Column]:
    c = F.col
    dates = F.filter(
        F.transform(
            c("cit.date"),
            lambda d: F.struct(
                _date(d["CI_Date"]["date"]).alias("date"), _code(d["CI_Date"]["dateType"]["CI_DateTypeCode"]).alias("datetype")
            ),
        ),
        lambda d: d["date"].isNotNull(),
    )
    resolution = c("idn.spatialResolution")
    distances = F.filter(
        F.transform(resolution, lambda r: r["MD_Resolution"]["distance"]["Distance"]), lambda d: d.isNotNull()
    )
    statement = c("dq.lineage.LI_Lineage.statement")
    return {
        "identifier": _txt(c("x.fileIdentifier")),
        "title": _txt(c("cit.title")),
        "abstract": _txt(c("idn.abstract")),
        "date_stamp": _date(c("x.dateStamp")),
        "keywords": _flat(
            c("idn.descriptiveKeywords"), lambda k: truthy_list(F.transform(k["MD_Keywords"]["keyword"], _txt))
        ),
        "topic_categories": truthy_list(F.transform(c("idn.topicCategory"), lambda t: t["MD_TopicCategoryCode"])),
        "contacts": all_tagged(_parties(c("x.contact")), c("poc")),
        "lineage": _txt(statement),
        "spatial_extent": bounding_box(
            *[
                F.col(f"box.{side}.Decimal")
                for side in ("westBoundLongitude", "southBoundLatitude", "eastBoundLongitude", "northBoundLatitude")
            ]
        ),
        "temporal_extent": temporal_extent(truthy(c("period.beginPosition")), truthy(c("period.endPosition"))),
        "constraints": _flat(
            c("rc"),
            lambda r: truthy_list(
                F.transform(
                    F.coalesce(
                        r["MD_Constraints"]["useLimitation"],
                        r["MD_LegalConstraints"]["useLimitation"],
                        r["MD_SecurityConstraints"]["useLimitation"],
                    ),
                    _txt,
                )
            ),
        ),
        "parent_identifier": _txt(c("x.parentIdentifier")),
        "language": F.coalesce(truthy(c("x.language.CharacterString")), _code(c("x.language.LanguageCode"))),
        "charset": _code(c("x.characterSet.MD_CharacterSetCode")),
        "hierarchy": _code(F.get(c("x.hierarchyLevel"), F.lit(0))["MD_ScopeCode"]),
        "metadata_standard_name": _txt(c("x.metadataStandardName")),
        "metadata_standard_version": _txt(c("x.metadataStandardVersion")),
        "dataset_uri": _txt(c("x.dataSetURI")),
        "alternate_title": _txt(c("cit.alternateTitle")),
        "resource_identifiers": zip_identifiers(
            F.transform(c("ids"), lambda i: _txt(i["code"])), F.transform(c("ids"), lambda i: _txt(i["codeSpace"]))
        ),
        "edition": _txt(c("cit.edition")),
        "purpose": _txt(c("idn.purpose")),
        "status": _code(c("idn.status.MD_ProgressCode")),
        "resource_language": F.concat(
            truthy_list(F.transform(c("idn.language"), lambda x: _code(x["LanguageCode"]))),
            truthy_list(F.transform(c("idn.language"), lambda x: x["CharacterString"])),
        ),
        "graphic_overviews": truthy_list(
            F.transform(c("idn.graphicOverview"), lambda g: _txt(g["MD_BrowseGraphic"]["fileName"]))
        ),
        "dates": dates,
        "spatial_resolution_denominators": denominators(
            F.transform(
                resolution,
                lambda r: r["MD_Resolution"]["equivalentScale"]["MD_RepresentativeFraction"]["denominator"]["Integer"],
            )
        ),
        "spatial_resolution_distances": zip_distances(
            F.transform(distances, lambda d: d["_VALUE"]), F.transform(distances, lambda d: d["_uom"])
        ),
        "creators": contacts_by_role(all_tagged(F.array().cast(f"array<{CONTACT}>"), c("poc")), "originator"),
        "publishers": contacts_by_role(all_tagged(F.array().cast(f"array<{CONTACT}>"), c("poc")), "publisher"),
        "contributors": contacts_by_role(all_tagged(F.array().cast(f"array<{CONTACT}>"), c("poc")), "author"),
        "access_constraints": _flat(
            c("legal"),
            lambda g: truthy_list(F.transform(g["accessConstraints"], lambda a: _code(a["MD_RestrictionCode"]))),
        ),
        "use_constraints": _flat(
            c("legal"), lambda g: truthy_list(F.transform(g["useConstraints"], lambda a: _code(a["MD_RestrictionCode"])))
        ),
        "classification": F.concat(
            _flat(
                c("legal"),
                lambda g: truthy_list(F.transform(g["accessConstraints"], lambda a: _code(a["MD_ClassificationCode"]))),
            ),
            _flat(
                c("rc"),
                lambda r: truthy_list(
                    F.transform(
                        r["MD_SecurityConstraints"]["classification"], lambda a: _code(a["MD_ClassificationCode"])
                    )
                ),
            ),
        ),
        "other_constraints": _flat(c("legal"), lambda g: truthy_list(F.transform(g["otherConstraints"], _txt))),
        "other_constraints_url": _flat(c("legal"), lambda g: truthy_list(F.transform(g["otherConstraints"], _href))),
        "distribution_formats": F.when(
            _txt(c("fmt.name")).isNotNull(),
            F.array(
                F.struct(
                    _txt(c("fmt.name")).alias("name"),
                    _txt(c("fmt.version")).alias("version"),
                    _txt(c("fmt.specification")).alias("specification"),
                    _href(c("fmt.name")).alias("name_url"),
                    _href(c("fmt.version")).alias("version_url"),
                    _href(c("fmt.specification")).alias("specification_url"),
                )
            ),
        ),
        "online_resources": F.transform(
            F.filter(c("online"), lambda o: truthy(o["linkage"]["URL"]).isNotNull()),
            lambda o: F.struct(
                o["linkage"]["URL"].alias("url"),
                _txt(o["protocol"]).alias("protocol"),
                _href(o["protocol"]).alias("protocol_url"),
                _txt(o["name"]).alias("name"),
                _href(o["name"]).alias("name_url"),
                _txt(o["description"]).alias("description"),
                _href(o["description"]).alias("description_url"),
                _code(o["function"]["CI_OnLineFunctionCode"]).alias("function"),
            ),
        ),
        "conformance_results": zip_conformance(
            F.transform(c("conf"), lambda r: _txt(r["specification"]["CI_Citation"]["title"])),
            F.transform(c("conf"), lambda r: _href(r["specification"]["CI_Citation"]["title"])),
            F.transform(
                c("conf"),
                lambda r: _date(F.get(r["specification"]["CI_Citation"]["date"], F.lit(0))["CI_Date"]["date"]),
            ),
            F.transform(
                c("conf"),
                lambda r: _code(
                    F.get(r["specification"]["CI_Citation"]["date"], F.lit(0))["CI_Date"]["dateType"]["CI_DateTypeCode"]
                ),
            ),
            F.transform(c("conf"), lambda r: truthy(r["pass"]["Boolean"])),
        ),
        "lineage_url": _href(statement),
        "reference_systems": F.when(
            _txt(c("rs.code")).isNotNull(),
            F.array(
                F.struct(
                    _txt(c("rs.code")).alias("code"),
                    _href(c("rs.code")).alias("code_url"),
                    _txt(c("rs.codeSpace")).alias("codespace"),
                    _href(c("rs.codeSpace")).alias("codespace_url"),
                    _txt(c("rs.version")).alias("version"),
                    _href(c("rs.version")).alias("version_url"),
                )
            ),
        ),
        "supplemental_information": _txt(c("idn.supplementalInformation")),
        "raw_xml": F.encode(c("raw"), "utf-8"),
    }


def validation_error(response_key: Column) -> Column:
    """The first rule a record breaks: identifier, title, abstract, scale numbers. Empty texts are allowed."""
    return (
        F.when(
            truthy(F.col("identifier")).isNull(),
            F.concat(F.lit("Record "), response_key, F.lit(" is missing a valid identifier (gmd:fileIdentifier).")),
        )
        .when(F.col("title").isNull(), F.lit("Record is missing a title in its identification section."))
        .when(F.col("abstract").isNull(), F.lit("Record is missing an abstract in its identification section."))
    )


def _typed(columns: dict[str, Column]) -> list[Column]:
    out = []
    for name, ddl in RECORD_FIELDS.items():
        value = columns[name]
        if ddl.startswith("array") and name not in ("spatial_extent", "spatial_resolution_denominators"):
            value = F.coalesce(value.cast(ddl), F.array().cast(ddl))
        out.append(value.cast(ddl).alias(name))
    return out


def parse_records(pieces: DataFrame) -> DataFrame:
    """Typed record columns plus ``record_id`` and ``error`` (null for a good record).

    ``pieces`` comes from :func:`split_records`; other columns pass through. An element without
    identifier gets a placeholder built from its place in the response, or from its content where no place is
    known: stable across reruns.
    """
    keep = [c for c in pieces.columns if c not in ("raw", "x")]
    place = [F.col(c) for c in keep if c in ("rdi", "batch", "url", "pos")] if "pos" in keep else [F.col("x")]
    parsed = _with_parts(pieces)
    typed = parsed.select(
        *keep,
        F.col("x._corrupt_record").alias("__bad"),
        F.lower(F.hex(F.xxhash64(*place))).alias("__place"),
        *built_once("iso fields", lambda: _typed(_extract())),
    )
    key = F.coalesce("identifier", F.concat(F.lit(RANDOM_PREFIX), F.col("__place")))
    error = F.when(F.col("__bad").isNotNull(), F.lit("Record is not well-formed XML.")).otherwise(
        F.coalesce(
            validation_error(key),
            F.when(
                F.col("spatial_resolution_denominators").isNull(),
                F.lit("Record has a scale denominator that is not a whole number."),
            ),
        )
    )
    return typed.select(*keep, key.alias("record_id"), error.alias("error"), *RECORD_FIELDS)


def read_iso(responses: DataFrame) -> DataFrame:
    """Landed catalogue responses (``rdi, batch, body, ...``) -> records and errors, one row per element.

    The same call serves a single unpaged response: page rules live in ``operators.paging``.
    """
    return parse_records(split_records(responses))


def read_iso_files(spark: SparkSession, path: str, rdi: str, page: str = r"(\d+)[^\d/]*$") -> DataFrame:
    """Landed response files, one whole body per file.

    ``page`` finds the page number in a file's path, by default the last digits of its name. A path without one is an error:
    without page numbers neither page stops nor cuts mean anything.
    """
    files = spark.read.format("binaryFile").load(path)
    number = F.regexp_extract("path", page, 1)
    bodies = files.select(
        F.lit(rdi).alias("rdi"),
        F.when(number != "", number.cast("bigint"))
        .otherwise(F.raise_error(F.concat(F.lit("No page number in "), F.col("path"))).cast("bigint"))
        .alias("batch"),
        F.col("path").alias("url"),
        F.decode("content", "utf-8").alias("body"),
    )
    return read_iso(bodies)


def read_iso_dump(reader, path: str, rdi: str) -> DataFrame:
    """Records straight from large XML files, split at record elements.

    ``reader`` is ``spark.read`` or ``spark.readStream``. A file of any size is divided over tasks, but
    neither the original text nor the position within the file is known.
    """
    parsed = reader.format("xml").schema(RECORD_XML).options(rowTag="MD_Metadata", **_XML_OPTIONS).load(path)
    pieces = parsed.select(
        F.lit(rdi).alias("rdi"), F.struct(*parsed.columns).alias("x"), F.lit(None).cast("string").alias("raw")
    )
    return parse_records(pieces)


def read_brief_ids(responses: DataFrame) -> DataFrame:
    """Brief identifiers of each page: ``rdi, batch, pos, dc_id``; a missing or broken page has none."""
    brief = (
        "SearchResults struct<BriefRecord:array<struct<identifier:array<string>>>,"
        "Record:array<struct<identifier:array<string>>>>"
    )
    parsed = responses.select("rdi", "batch", F.from_xml("body", brief, _XML_OPTIONS).alias("x"))
    entries = F.coalesce(F.col("x.SearchResults.BriefRecord"), F.col("x.SearchResults.Record"))
    return parsed.select(
        "rdi", "batch", F.posexplode(F.transform(entries, lambda r: F.get(r["identifier"], F.lit(0)))).alias("pos", "dc_id")
    ).filter(truthy(F.col("dc_id")).isNotNull())
