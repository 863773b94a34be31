"""Declared schemas. Nothing in the library infers a schema from data."""

from __future__ import annotations

CONTACT = (
    "struct<name:string,name_url:string,organization:string,organization_url:string,email:string,"
    "role:string,type:string,position:string,phone:string,fax:string,address:string,city:string,"
    "region:string,postcode:string,country:string,online_resource_url:string,"
    "online_resource_protocol:string,online_resource_name:string,online_resource_description:string>"
)
IDENTIFIER = "struct<code:string,codespace:string,url:string>"
DATED = "struct<date:string,datetype:string>"
DISTANCE = "struct<value:double,uom:string>"
FORMAT = (
    "struct<name:string,version:string,specification:string,name_url:string,version_url:string,"
    "specification_url:string>"
)
ONLINE = (
    "struct<url:string,protocol:string,protocol_url:string,name:string,name_url:string,"
    "description:string,description_url:string,function:string>"
)
CONFORMANCE = (
    "struct<specification_title:string,specification_title_url:string,specification_date:string,"
    "specification_datetype:string,degree:string>"
)
REFERENCE_SYSTEM = (
    "struct<code:string,code_url:string,codespace:string,codespace_url:string,version:string,"
    "version_url:string>"
)

# One catalogue record. Dates stay text, absent lists are empty, absent scalars are null.
RECORD_FIELDS: dict[str, str] = {
    "identifier": "string",
    "title": "string",
    "abstract": "string",
    "date_stamp": "string",
    "keywords": "array<string>",
    "topic_categories": "array<string>",
    "contacts": f"array<{CONTACT}>",
    "lineage": "string",
    "spatial_extent": "array<double>",
    "temporal_extent": "struct<start:string,end:string>",
    "constraints": "array<string>",
    "parent_identifier": "string",
    "language": "string",
    "charset": "string",
    "hierarchy": "string",
    "metadata_standard_name": "string",
    "metadata_standard_version": "string",
    "dataset_uri": "string",
    "alternate_title": "string",
    "resource_identifiers": f"array<{IDENTIFIER}>",
    "edition": "string",
    "purpose": "string",
    "status": "string",
    "resource_language": "array<string>",
    "graphic_overviews": "array<string>",
    "dates": f"array<{DATED}>",
    "spatial_resolution_denominators": "array<bigint>",
    "spatial_resolution_distances": f"array<{DISTANCE}>",
    "creators": f"array<{CONTACT}>",
    "publishers": f"array<{CONTACT}>",
    "contributors": f"array<{CONTACT}>",
    "access_constraints": "array<string>",
    "use_constraints": "array<string>",
    "classification": "array<string>",
    "other_constraints": "array<string>",
    "other_constraints_url": "array<string>",
    "distribution_formats": f"array<{FORMAT}>",
    "online_resources": f"array<{ONLINE}>",
    "conformance_results": f"array<{CONFORMANCE}>",
    "lineage_url": "string",
    "reference_systems": f"array<{REFERENCE_SYSTEM}>",
    "supplemental_information": "string",
    "raw_xml": "binary",
}

TERM = "struct<name:string,tan:string,tsr:string>"
COMMENT = "struct<name:string,value:string>"
PERSON = (
    "struct<last_name:string,first_name:string,email:string,affiliation:string,address:string,"
    f"phone:string,fax:string,roles:array<{TERM}>,comments:array<{COMMENT}>>"
)
PUBLICATION = "struct<title:string,authors:string,doi:string>"
CELL = "struct<kind:string,header:string,value:string>"
TABLE = f"struct<name:string,columns:array<{CELL}>>"
ONTOLOGY_SOURCE = "struct<name:string,file:string,version:string,description:string>"

INVESTIGATION = (
    "struct<identifier:string,title:string,description:string,submission_date:string,"
    f"contacts:array<{PERSON}>,publications:array<{PUBLICATION}>,comments:array<{COMMENT}>,"
    f"ontology_sources:array<{ONTOLOGY_SOURCE}>>"
)
STUDY = (
    "struct<identifier:string,title:string,description:string,submission_date:string,"
    f"registered_assays:array<string>,tables:array<{TABLE}>>"
)
ASSAY = (
    f"struct<identifier:string,title:string,measurement_type:{TERM},technology_type:{TERM},"
    f"technology_platform:{TERM},tables:array<{TABLE}>>"
)

OUTCOME_FIELDS: dict[str, str] = {
    "rdi": "string",
    "seq": "bigint",
    "kind": "string",
    "arc_json": "string",
    "record_id": "string",
    "source_url": "string",
    "message": "string",
}
OUTCOME = ", ".join(f"{name} {ddl}" for name, ddl in OUTCOME_FIELDS.items())


def record_ddl() -> str:
    """DDL of one catalogue record."""
    return ", ".join(f"{name} {ddl}" for name, ddl in RECORD_FIELDS.items())
