"""Catalogue record -> investigation, study and assay. Row-local native expressions throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.functions.names import format_address, split_name
from sheafline.functions.terms import RECORD_VOCABULARIES, role_term, term, topic_term
from sheafline.functions.text import (
    first_truthy,
    float_text,
    fold,
    head,
    joined_or_omit,
    record_url,
    slug,
    truthy,
)
from sheafline.operators.catalog import is_dataset_level
from sheafline.operators.once import compute_once
from sheafline.operators.outcomes import to_outcomes
from sheafline.plans.parts import cell, cells, comment, crate_json, framed, ontology_source, table
from sheafline.schemas import (
    ASSAY,
    CELL,
    COMMENT,
    INVESTIGATION,
    PERSON,
    PUBLICATION,
    RECORD_FIELDS,
    STUDY,
    TERM,
)
from sheafline.session import built_once
from sheafline.sources.sinks import archive_files

STUDY_DEFAULT_DESCRIPTION = "Imported from INSPIRE metadata"


def investigation_id(identifier: Column, title: Column) -> Column:
    """The record id; one with a slash gives way to the title slug, else to its last path segment."""
    return F.when(
        identifier.contains("/"), F.coalesce(truthy(slug(title)), F.element_at(F.split(identifier, "/"), -1))
    ).otherwise(identifier)


def person_comments(contact: Column) -> Column:
    """Position, then the online resource under its name."""
    label = F.coalesce(truthy(contact["online_resource_name"]), F.lit("Online Resource"))
    return F.array_compact(
        F.array(
            comment("Position", truthy(contact["position"])), comment(label, truthy(contact["online_resource_url"]))
        )
    )


def map_person(contact: Column) -> Column:
    """Person of a named contact."""
    name = split_name(contact["name"])
    role = role_term(contact["role"])
    return F.struct(
        name["last"].alias("last_name"),
        name["first"].alias("first_name"),
        contact["email"].alias("email"),
        contact["organization"].alias("affiliation"),
        format_address(contact).alias("address"),
        contact["phone"].alias("phone"),
        contact["fax"].alias("fax"),
        F.array_compact(F.array(role)).alias("roles"),
        person_comments(contact).alias("comments"),
    ).cast(PERSON)


def all_contacts(*lists: Column) -> Column:
    """Contacts, creators, publishers and contributors in a row; repeats stay."""
    return F.concat(*lists)


def persons(contacts: Column) -> Column:
    """Persons of the contacts that have a name."""
    return F.transform(F.filter(contacts, lambda c: truthy(c["name"]).isNotNull()), map_person)


def is_publication_id(code: Column, codespace: Column) -> Column:
    """DOI-like code or ISBN code space. Any code containing ``doi`` counts."""
    return (
        code.startswith("10.")
        | F.lower(code).contains("doi")
        | F.lower(F.coalesce(codespace, F.lit(""))).contains("isbn")
    )


def authors_text(people: Column) -> Column:
    """``Last, F.`` of the persons whose role label is the lower-case ``author``; null without any.

    Mapped roles are labelled ``Author``, so for catalogue records this is null in practice.
    """
    authors = F.filter(people, lambda p: F.exists(p["roles"], lambda r: r["name"] == "author"))
    return fold(
        F.transform(
            authors,
            lambda p: F.concat(
                F.coalesce(p["last_name"], F.lit("")),
                F.lit(", "),
                F.when(
                    truthy(p["first_name"]).isNotNull(), F.concat(F.substring(p["first_name"], 1, 1), F.lit("."))
                ).otherwise(""),
            ),
        ),
        "; ",
    )


def publications(identifiers: Column, title: Column, authors: Column) -> Column:
    """One publication per DOI- or ISBN-like identifier, under the record's title."""
    return F.transform(
        F.filter(identifiers, lambda i: truthy(i["code"]).isNotNull() & is_publication_id(i["code"], i["codespace"])),
        lambda i: F.struct(title.alias("title"), authors.alias("authors"), i["code"].alias("doi")).cast(PUBLICATION),
    )


def hierarchy_comment(hierarchy: Column) -> Column:
    """The hierarchy level unless it is the plain dataset level."""
    return F.when(~F.lower(hierarchy).isin("dataset", "nongeographicdataset"), truthy(hierarchy))


def record_comments(r) -> Column:
    """Labelled comments in fixed order; empty ones are left out. ``r`` maps a field name to its column."""
    plain = [
        ("Metadata Standard", "metadata_standard_name"),
        ("Parent Identifier", "parent_identifier"),
        ("Language", "language"),
        ("Edition", "edition"),
        ("Status", "status"),
        ("Alternate Title", "alternate_title"),
        ("Purpose", "purpose"),
        ("Supplemental Information", "supplemental_information"),
    ]
    rows = [comment(label, truthy(r(field))) for label, field in plain]
    rows.append(comment("Hierarchy Level", hierarchy_comment(r("hierarchy"))))
    rows += [
        comment("Access Constraints", fold(r("access_constraints"), ", ")),
        comment("Use Constraints", fold(r("use_constraints"), ", ")),
        comment("Classification", fold(r("classification"), ", ")),
        comment("Other Constraints", fold(head(r("other_constraints"), 3), "; ")),
        comment("Other Constraints URLs", fold(head(r("other_constraints_url"), 3), "; ")),
    ]
    return F.array_compact(F.array(*rows)).cast(f"array<{COMMENT}>")


def ontology_sources(standard: Column, version: Column) -> Column:
    """The metadata standard when named, then the common vocabularies."""
    own = F.when(
        truthy(standard).isNotNull(),
        ontology_source(standard, None, F.coalesce(version, F.lit("")), "INSPIRE Metadata Standard"),
    )
    common = [ontology_source(n, f, "", d) for n, f, d in RECORD_VOCABULARIES]
    return F.array_compact(F.array(own, *common))


def map_investigation(r, people: Column) -> Column:
    """Investigation of a record with the given persons."""
    return F.struct(
        investigation_id(r("identifier"), r("title")).alias("identifier"),
        r("title").alias("title"),
        r("abstract").alias("description"),
        r("date_stamp").alias("submission_date"),
        people.alias("contacts"),
        publications(r("resource_identifiers"), r("title"), authors_text(people)).alias("publications"),
        record_comments(r).alias("comments"),
        ontology_sources(r("metadata_standard_name"), r("metadata_standard_version")).alias("ontology_sources"),
    ).cast(INVESTIGATION)


def study_description(lineage: Column, purpose: Column, supplemental: Column) -> Column:
    """Lineage, purpose and supplemental text, or a default."""
    parts = F.concat_ws(
        " | ",
        F.concat(F.lit("Lineage: "), truthy(lineage)),
        F.concat(F.lit("Purpose: "), truthy(purpose)),
        F.concat(F.lit("Supplemental: "), truthy(supplemental)),
    )
    return F.coalesce(truthy(parts), F.lit(STUDY_DEFAULT_DESCRIPTION))


def bbox_text(box: Column) -> Column:
    """``[10.0, 48.0, 11.0, 49.0]``."""
    return F.when(
        F.size(F.coalesce(box, F.array().cast("array<double>"))) > 0,
        F.concat(F.lit("["), F.array_join(F.transform(box, float_text), ", "), F.lit("]")),
    )


def spatial_table(r) -> Column:
    """Spatial Sampling: box, reference systems, scales, distances; null when none, or for non-geographic data."""
    systems = fold(
        F.transform(r("reference_systems"), lambda s: F.concat_ws(":", truthy(s["codespace"]), s["code"])), ", "
    )
    scales = fold(
        F.transform(r("spatial_resolution_denominators"), lambda d: F.concat(F.lit("1:"), d.cast("string"))), ", "
    )
    distances = fold(
        F.transform(
            r("spatial_resolution_distances"), lambda d: F.concat(float_text(d["value"]), F.lit(" "), d["uom"])
        ),
        ", ",
    )
    parameters = F.array_compact(
        F.array(
            cell("parameter", "Bounding Box", bbox_text(r("spatial_extent"))),
            cell("parameter", "Coordinate Reference System", systems),
            cell("parameter", "Spatial Resolution (Scale)", scales),
            cell("parameter", "Spatial Resolution (Distance)", distances),
        )
    )
    geographic = F.coalesce(F.lower(r("hierarchy")) != "nongeographicdataset", F.lit(True))
    return F.when(
        geographic & (F.size(parameters) > 0),
        framed(
            "Spatial Sampling",
            cell("input", "Source Name", "Geographic Region"),
            parameters,
            cell("output", "Sample Name", "Selected Location"),
        ),
    )


def dates_of(dates: Column, *kinds: str) -> Column:
    """Citation dates of the given types, comma-joined."""
    return fold(F.transform(F.filter(dates, lambda d: d["datetype"].isin(*kinds)), lambda d: d["date"]), ", ")


def acquisition_table(r) -> Column:
    """Data Acquisition: period and creation dates; null when neither is known."""
    period = r("temporal_extent")
    unknown = F.lit("unknown")
    period_text = F.when(
        period.isNotNull(),
        F.concat(
            F.coalesce(truthy(period["start"]), unknown), F.lit(" to "), F.coalesce(truthy(period["end"]), unknown)
        ),
    )
    parameters = F.array_compact(
        F.array(
            cell("parameter", "Temporal Extent", period_text),
            cell("parameter", "Acquisition Date", dates_of(r("dates"), "creation")),
        )
    )
    return F.when(
        F.size(parameters) > 0,
        framed(
            "Data Acquisition",
            cell("input", "Sample Name", "Selected Location"),
            parameters,
            cell("output", "Data", "Raw Data"),
        ),
    )


def conformance_status(degree: Column) -> Column:
    """``PASS``, ``FAIL`` or ``Unknown``."""
    return (
        F.when(F.lower(degree).isin("true", "pass"), F.lit("PASS"))
        .when(truthy(degree).isNotNull(), F.lit("FAIL"))
        .otherwise(F.lit("Unknown"))
    )


def format_label(name: Column, version: Column) -> Column:
    """Name, with ``v<version>`` when there is one."""
    return F.concat(name, F.coalesce(F.concat(F.lit(" v"), truthy(version)), F.lit("")))


def processing_table(r) -> Column:
    """Data Processing: lineage, conformance, formats, dates; a bare note when only other dates are known."""
    parameters = F.concat(
        F.array_compact(
            F.array(
                cell("parameter", "Processing Description", F.substring(truthy(r("lineage")), 1, 500)),
                cell("parameter", "Lineage Documentation URL", truthy(r("lineage_url"))),
            )
        ),
        cells(
            "parameter",
            "Conformance",
            F.transform(
                r("conformance_results"),
                lambda c: F.concat(c["specification_title"], F.lit(": "), conformance_status(c["degree"])),
            ),
        ),
        cells(
            "parameter",
            "Output Format",
            F.transform(r("distribution_formats"), lambda f: format_label(f["name"], f["version"])),
        ),
        F.array_compact(
            F.array(cell("parameter", "Processing Date", dates_of(r("dates"), "publication", "revision")))
        ),
    )
    note = F.array(cell("parameter", "Note", "Data processing details from INSPIRE metadata"))
    columns = F.when(F.size(parameters) > 0, parameters).when(F.size(r("dates")) > 0, note)
    return F.when(
        columns.isNotNull(),
        framed("Data Processing", cell("input", "Data", "Raw Data"), columns, cell("output", "Data", "Processed Data")),
    )


def map_study(r) -> Column:
    """Study of a record, with its assay registered under the shared slug."""
    ident = slug(r("title"))
    return F.struct(
        ident.alias("identifier"),
        r("title").alias("title"),
        study_description(r("lineage"), r("purpose"), r("supplemental_information")).alias("description"),
        r("date_stamp").alias("submission_date"),
        F.array(ident).alias("registered_assays"),
        F.array_compact(F.array(spatial_table(r), acquisition_table(r), processing_table(r))).alias("tables"),
    ).cast(STUDY)


def _field(name: str):
    return lambda x: x[name]


def assay_table(r) -> Column:
    """Measurement: where the data is, and what else is known about its online resources.

    The address is the dataset URI, else the first online resource (then left out of the lists), else a slug.
    """
    online = r("online_resources")
    own = truthy(r("dataset_uri"))
    first = F.get(online, F.lit(0))["url"]
    address = F.coalesce(own, first, F.concat(slug(r("title")), F.lit("_dataset")))
    listed = F.when(own.isNull(), F.slice(online, F.lit(2), F.greatest(F.size(online), F.lit(1)))).otherwise(online)
    columns = F.array(
        cell("input", "Source Name", "Dataset Source"),
        cell("output", "URI", address),
        cell("comment", "Online Resource", fold(F.transform(listed, lambda o: o["url"]), ";")),
        *[
            cell("comment", f"Online Resource {label}", joined_or_omit(F.transform(listed, _field(f))))
            for label, f in (
                ("Name", "name"),
                ("Protocol", "protocol"),
                ("Description", "description"),
                ("Function", "function"),
            )
        ],
        cell("comment", "Graphic Overview", fold(r("graphic_overviews"), ";")),
    )
    return table("Measurement", F.array_compact(columns).cast(f"array<{CELL}>"))


def map_assay(r) -> Column:
    """Assay of a record."""
    return F.struct(
        slug(r("title")).alias("identifier"),
        r("title").alias("title"),
        topic_term(r("topic_categories")).cast(TERM).alias("measurement_type"),
        term("Data Collection").alias("technology_type"),
        term("Satellite/Sensor Acquisition").alias("technology_platform"),
        F.array(assay_table(r)).alias("tables"),
    ).cast(ASSAY)


def map_records(records: DataFrame) -> DataFrame:
    """Add ``investigation, study, assay, files`` to typed records and drop the record columns."""
    keep = [c for c in records.columns if c not in RECORD_FIELDS]

    def people() -> Column:
        return persons(all_contacts(*[F.col(c) for c in ("contacts", "creators", "publishers", "contributors")]))

    def mapped() -> list[Column]:
        return [
            map_investigation(F.col, F.col("__people")).alias("investigation"),
            map_study(F.col).alias("study"),
            map_assay(F.col).alias("assay"),
            archive_files(F.col("raw_xml")).alias("files"),
        ]

    with_people = compute_once(records, records.columns, __people=built_once("record people", people))
    return with_people.select(*keep, "identifier", "hierarchy", *built_once("record mapping", mapped))


def record_outcomes(parsed: DataFrame, base_url: Column | str) -> DataFrame:
    """Outcomes of parsed records (``rdi, seq, record_id, error`` + record columns).

    One scan yields errors and research objects; records of another hierarchy level yield nothing.
    """
    base = F.lit(base_url) if isinstance(base_url, str) else base_url
    kept = parsed.filter(F.col("error").isNotNull() | is_dataset_level(F.col("hierarchy")))
    mapped = map_records(kept)
    good = F.col("error").isNull()
    document = built_once(
        "record document",
        lambda: crate_json(F.col("investigation"), F.col("study"), F.col("assay"), F.col("files")),
    )
    return to_outcomes(
        mapped,
        rdi=F.col("rdi"),
        seq=F.col("seq"),
        kind=F.when(good, F.lit("arc")).otherwise(F.lit("error")),
        arc_json=F.when(good, document),
        record_id=F.when(~good, F.col("record_id")),
        source_url=F.when(good, record_url(base, first_truthy(F.col("identifier")))),
        message=F.col("error"),
    )
