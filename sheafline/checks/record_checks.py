"""Catalogue records: reading, validation, mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafline.checks.base import check, s, slug_sql, spread_table, table
from sheafline.checks.builders import (
    cells_text,
    full_contact,
    iso_record,
    iso_response,
    pairs_text,
    record_fields,
)
from sheafline.functions.terms import term
from sheafline.functions.text import fold, head, joined_or_omit, truthy, truthy_list
from sheafline.operators.catalog import filter_hierarchy
from sheafline.operators.once import compute_once
from sheafline.operators.outcomes import arc_identifier
from sheafline.plans import record_arc as ra
from sheafline.schemas import CONTACT, ONLINE, PERSON, RECORD_FIELDS
from sheafline.sources import iso


def _doc_title():
    return F.concat_ws(" ", "source", F.col("doc_id").cast("string"))


def _random_free(message):
    return F.regexp_replace(message, "owslib_random_[0-9a-f]+", "owslib_random_N")


_LEVELS = """CASE event_type WHEN 'click' THEN 'dataset' WHEN 'view' THEN 'Series' WHEN 'purchase' THEN 'nonGeographicDataset'
 WHEN 'signup' THEN 'service' ELSE CASE WHEN event_id % 2 = 0 THEN '' END END"""


@check(
    "hierarchy_filter",
    "PF1",
    f"""
SELECT hierarchy, count(*) AS n FROM (SELECT {_LEVELS} AS hierarchy FROM events)
WHERE hierarchy IS NULL OR hierarchy = '' OR lower(hierarchy) IN ('dataset', 'series', 'nongeographicdataset') GROUP BY 1
""",
)
def hierarchy_filter(spark, d):
    rows = table(spark, d, "events").select(F.expr(_LEVELS).alias("hierarchy"))
    return filter_hierarchy(rows).groupBy("hierarchy").agg(F.count(F.lit(1)).alias("n"))


@check(
    "validate_records",
    "PF2 PF3",
    """
SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'Record key-' || doc_id || ' is missing a valid identifier (gmd:fileIdentifier).'
       WHEN doc_id % 11 = 0 THEN 'Record is missing a title in its identification section.'
       WHEN doc_id % 13 = 0 THEN 'Record is missing an abstract in its identification section.' END AS error
FROM documents
""",
)
def validate_records(spark, d):
    k = F.col("doc_id")
    rows = table(spark, d, "documents").select(
        "doc_id",
        F.when(k % 7 > 0, k.cast("string")).otherwise(F.when(k % 2 == 0, "")).alias("identifier"),
        F.when(k % 11 > 0, F.when(k % 3 == 0, "").otherwise(F.col("source"))).alias("title"),
        F.when(k % 13 > 0, F.col("text")).alias("abstract"),
    )
    return rows.select(
        "doc_id", iso.validation_error(F.concat(s("key-"), F.col("doc_id").cast("string"))).alias("error")
    )


def _responses(spark, d):
    """One response per document: a good, padded record and one that may lack its id.

    At times an element that is closed at once, one that is never closed, or a comment with a start tag stands
    between them, and a broken one at the end.
    """
    docs = spread_table(spark, d, "documents")
    key = F.col("doc_id").cast("string")
    levels = F.element_at(F.array(s("dataset"), s("Series"), s("service"), s("")), (F.col("doc_id") % 4 + 1).cast("int"))
    first = iso_record(
        F.concat(s("doc/"), key),
        F.concat(s("\n  "), _doc_title(), s(" ")),
        F.concat(F.col("text"), s("\n")),
        keywords=F.array(F.concat(s(" "), "lang"), "source"),
        language=F.concat(F.col("lang"), s(" ")),
        hierarchy=levels,
        code=F.concat(s("10.1/"), key),
        denominator=F.when(F.col("doc_id") % 10 == 9, "a lot").otherwise(F.col("n_chars").cast("string")),
        contact=F.concat_ws(" ", s("Ann"), "source"),
    )
    at = lambda k, element: F.when(F.col("doc_id") % k == 0, element).otherwise("")
    between = F.concat(at(2, "<!-- <gmd:MD_Metadata> -->"), at(7, "<gmd:MD_Metadata/>"), at(11, "<gmd:MD_Metadata><gmd:open>"))
    second = iso_record(F.when(F.col("doc_id") % 3 > 0, F.concat(s("b-"), key)), F.col("source"), F.col("lang"))
    broken = F.when(F.col("doc_id") % 5 == 0, "<gmd:MD_Metadata><gmd:open></gmd:MD_Metadata>").otherwise("")
    return docs.select(
        F.col("lang").alias("rdi"),
        F.col("doc_id").alias("batch"),
        s("https://csw.example.org/csw").alias("base_url"),
        iso_response(F.col("n_chars"), first, between, second, broken).alias("body"),
    )


_SECOND = "1 + CAST(doc_id % 7 = 0 AS INT) + CAST(doc_id % 11 = 0 AS INT)"
_BROKEN = f"""SELECT doc_id, 1 AS pos, true AS closed FROM documents WHERE doc_id % 7 = 0
UNION ALL SELECT doc_id, 1 + CAST(doc_id % 7 = 0 AS INT), false FROM documents WHERE doc_id % 11 = 0
UNION ALL SELECT doc_id, 1 + {_SECOND}, false FROM documents WHERE doc_id % 5 = 0"""


@check(
    "iso_roundtrip",
    "SC1 PF8 PF9 FN33",
    f"""
SELECT doc_id AS batch, 0 AS pos, 'doc/' || doc_id AS record_id, source || ' ' || doc_id AS title, md5(trim(text, chr(10) || ' ')) AS abstract_md5, lang AS language,
       lang || ',' || source AS keywords, CASE WHEN doc_id % 10 <> 9 THEN n_chars END AS denominator,
       CASE WHEN doc_id % 10 = 9 THEN 'Record has a scale denominator that is not a whole number.' END AS error
FROM documents
UNION ALL
SELECT doc_id, {_SECOND}, CASE WHEN doc_id % 3 > 0 THEN 'b-' || doc_id ELSE 'owslib_random_N' END, source, md5(lang), NULL, '', NULL,
       CASE WHEN doc_id % 3 = 0 THEN 'Record owslib_random_N is missing a valid identifier (gmd:fileIdentifier).' END
FROM documents
UNION ALL
SELECT doc_id, pos, 'owslib_random_N', NULL, NULL, NULL, '', NULL,
       CASE WHEN closed THEN 'Record owslib_random_N is missing a valid identifier (gmd:fileIdentifier).'
            ELSE 'Record is not well-formed XML.' END FROM ({_BROKEN})
""",
)
def iso_roundtrip(spark, d):
    return iso.read_iso(_responses(spark, d)).select(
        "batch",
        "pos",
        _random_free(F.col("record_id")).alias("record_id"),
        "title",
        F.md5("abstract").alias("abstract_md5"),
        "language",
        F.array_join("keywords", ",").alias("keywords"),
        F.get("spatial_resolution_denominators", F.lit(0)).alias("denominator"),
        _random_free(F.col("error")).alias("error"),
    )


@check(
    "iso_unpaged",
    "SC2 PF4",
    """
SELECT lang AS rdi,
       count(*) * 2 + count(*) FILTER (doc_id % 5 = 0) + count(*) FILTER (doc_id % 7 = 0) + count(*) FILTER (doc_id % 11 = 0)
         AS elements,
       count(*) FILTER (doc_id % 10 <> 9) + count(*) FILTER (doc_id % 3 > 0) AS good,
       count(*) FILTER (doc_id % 3 = 0) + count(*) FILTER (doc_id % 5 = 0) + count(*) FILTER (doc_id % 7 = 0)
         + count(*) FILTER (doc_id % 11 = 0) AS nameless
FROM documents GROUP BY 1
""",
)
def iso_unpaged(spark, d):
    from sheafline.operators.fallback import is_random_id

    parsed = iso.read_iso(_responses(spark, d)).select("rdi", "record_id", "error")
    return parsed.groupBy("rdi").agg(
        F.count(F.lit(1)).alias("elements"),
        F.count_if(F.col("error").isNull()).alias("good"),
        F.count_if(is_random_id(F.col("record_id"))).alias("nameless"),
    )


@check(
    "record_to_arc",
    "FN24 FN25 FN26 JN13 SC12 PF5",
    f"""
SELECT doc_id AS batch, 0 AS pos, CASE WHEN doc_id % 10 = 9 THEN 'error' ELSE 'arc' END AS kind,
       CASE WHEN doc_id % 10 <> 9 THEN {slug_sql("source || ' ' || doc_id")} END AS arc_id,
       CASE WHEN doc_id % 10 <> 9 THEN 'https://csw.example.org/csw?service=CSW&version=2.0.2&request=GetRecordById&id=doc%2F' || doc_id
            || '&outputSchema=http%3A%2F%2Fwww.isotc211.org%2F2005%2Fgmd&elementSetName=full' END AS source_url,
       CASE WHEN doc_id % 10 = 9 THEN 'Record has a scale denominator that is not a whole number.' END AS message
FROM documents WHERE doc_id % 10 = 9 OR doc_id % 4 <> 2
UNION ALL
SELECT doc_id, {_SECOND}, CASE WHEN doc_id % 3 = 0 THEN 'error' ELSE 'arc' END, CASE WHEN doc_id % 3 > 0 THEN 'b-' || doc_id END,
       CASE WHEN doc_id % 3 > 0 THEN 'https://csw.example.org/csw?service=CSW&version=2.0.2&request=GetRecordById&id=b-' || doc_id
            || '&outputSchema=http%3A%2F%2Fwww.isotc211.org%2F2005%2Fgmd&elementSetName=full' END,
       CASE WHEN doc_id % 3 = 0 THEN 'Record owslib_random_N is missing a valid identifier (gmd:fileIdentifier).' END
FROM documents
UNION ALL
SELECT doc_id, pos, 'error', NULL, NULL,
       CASE WHEN closed THEN 'Record owslib_random_N is missing a valid identifier (gmd:fileIdentifier).'
            ELSE 'Record is not well-formed XML.' END FROM ({_BROKEN})
""",
)
def record_to_arc(spark, d):
    parsed = iso.read_iso(_responses(spark, d))
    numbered = parsed.withColumn("seq", F.col("batch") * 10 + F.col("pos"))
    out = ra.record_outcomes(numbered, F.col("base_url"))
    return out.select(
        F.floor(F.col("seq") / 10).alias("batch"),
        (F.col("seq") % 10).alias("pos"),
        "kind",
        arc_identifier(F.col("arc_json")).alias("arc_id"),
        "source_url",
        _random_free(F.col("message")).alias("message"),
    )


@check(
    "dc_ids",
    "SC3",
    """
SELECT doc_id AS batch, 0 AS pos, 'dc-' || doc_id AS dc_id FROM documents WHERE doc_id % 4 <> 3
UNION ALL SELECT doc_id, 2, source FROM documents WHERE doc_id % 4 <> 3
""",
)
def dc_ids(spark, d):
    body = F.when(F.col("doc_id") % 4 == 3, "<GetRecordsResponse><SearchResults>").otherwise(
        F.concat(
            s('<csw:GetRecordsResponse xmlns:csw="c" xmlns:dc="d"><csw:SearchResults><csw:BriefRecord><dc:identifier>dc-'),
            F.col("doc_id").cast("string"),
            s("</dc:identifier></csw:BriefRecord><csw:BriefRecord><dc:identifier/></csw:BriefRecord><csw:BriefRecord><dc:identifier>"),
            F.col("source"),
            s("</dc:identifier></csw:BriefRecord></csw:SearchResults></csw:GetRecordsResponse>"),
        )
    )
    pages = table(spark, d, "documents").select(F.col("lang").alias("rdi"), F.col("doc_id").alias("batch"), body.alias("body"))
    return iso.read_brief_ids(pages).select("batch", "pos", "dc_id")


_WORDS = "string_split(text, ' ')"


@check(
    "iso_arrays",
    "JN5 JN6 JN7",
    f"""
WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     i AS (SELECT *, range(1, len(w) + 1) AS ix, len(w) // 2 AS half FROM w)
SELECT doc_id,
  md5(array_to_string([CASE len(w[k]) % 5 WHEN 1 THEN 'http' || w[k] ELSE w[k] END || '|' || CASE WHEN k <= half THEN left(w[k], 1) ELSE '-' END
        || '|' || CASE len(w[k]) % 5 WHEN 1 THEN 'http' || w[k] ELSE '-' END for k in ix if len(w[k]) % 5 <> 0 AND w[k] <> ''], ';')) AS identifiers,
  md5(array_to_string([w[k] || '|' || CASE WHEN k <= half THEN 'd' || len(w[k]) ELSE '-' END || '|' || CASE WHEN k <= half + 1 THEN 'true' ELSE '-' END
        for k in ix if w[k] <> ''], ';')) AS conformance,
  md5(array_to_string([(len(w[k]) + 0.5)::VARCHAR || '|' || CASE WHEN k <= 2 AND k <= half THEN 'km' ELSE 'm' END
        for k in ix if len(w[k]) % 3 <> 0], ';')) AS distances
FROM i
""",
)
def iso_arrays(spark, d):
    def per(w, fn):
        return F.transform(w, fn)

    docs = compute_once(spread_table(spark, d, "documents"), ["doc_id"], w=F.split("text", " "))
    half = F.floor(F.size("w") / 2).cast("int")
    codes = per(
        F.col("w"),
        lambda x: F.when(F.length(x) % 5 == 0, "").when(F.length(x) % 5 == 1, F.concat(s("http"), x)).otherwise(x),
    )
    spaces = F.slice(per(F.col("w"), lambda x: F.substring(x, 1, 1)), F.lit(1), half)
    ids = iso.zip_identifiers(codes, spaces)
    conf = iso.zip_conformance(
        F.col("w"),
        F.array().cast("array<string>"),
        F.slice(per(F.col("w"), lambda x: F.concat(s("d"), F.length(x).cast("string"))), F.lit(1), half),
        F.array().cast("array<string>"),
        F.slice(per(F.col("w"), lambda x: s("true")), F.lit(1), half + 1),
    )
    dist = iso.zip_distances(
        per(
            F.col("w"),
            lambda x: F.when(F.length(x) % 3 == 0, "n/a").otherwise(F.concat(F.length(x).cast("string"), s(".5"))),
        ),
        F.slice(F.array(s("km"), s("km"), s("")), F.lit(1), F.least(half, F.lit(3))),
    )

    def text(arr, *parts):
        return F.md5(F.array_join(F.transform(arr, lambda r: F.concat_ws("|", *[p(r) for p in parts])), ";"))

    def or_dash(name):
        return lambda r: F.coalesce(r[name], s("-"))

    return docs.select(
        "doc_id",
        text(ids, or_dash("code"), or_dash("codespace"), or_dash("url")).alias("identifiers"),
        text(conf, or_dash("specification_title"), or_dash("specification_date"), or_dash("degree")).alias("conformance"),
        text(dist, lambda r: r["value"].cast("string"), or_dash("uom")).alias("distances"),
    )


@check(
    "truthy_lists",
    "PF10 FN36",
    f"""
SELECT conv_id, turn, len(list_filter({_WORDS}, lambda x: x <> '')) AS n,
       md5(array_to_string(list_filter({_WORDS}, lambda x: x <> ''), '|')) AS kept, role || '|' || conv_id AS limits
FROM conversations
""",
)
def truthy_lists(spark, d):
    kept = truthy_list(F.concat(F.split("text", " "), F.array(F.lit(None).cast("string"))))
    limits = F.flatten(
        F.transform(
            F.array(F.array("role"), F.array(s("")), F.array(F.col("conv_id").cast("string"))), lambda a: truthy_list(a)
        )
    )
    return table(spark, d, "conversations").select(
        "conv_id",
        "turn",
        F.size(kept).cast("bigint").alias("n"),
        F.md5(F.array_join(kept, "|")).alias("kept"),
        F.array_join(limits, "|").alias("limits"),
    )


@check(
    "list_folds",
    "AG13 AG14 SL2 SL4 SO5",
    f"""
WITH c AS (SELECT conv_id, turn, role, text, {_WORDS} AS w FROM conversations)
SELECT conv_id, turn, array_to_string(w[1:3], '; ') AS first3,
       CASE WHEN turn % 2 = 0 THEN role || ';;' || conv_id END AS joined,
       md5(array_to_string(list_filter(w, lambda x, i: list_position(w, x) = i), ' ')) AS distinct_words,
       left(text, 80) AS cut80, left(text, 200) AS cut200
FROM c
""",
)
def list_folds(spark, d):
    w = F.split("text", " ")
    even = F.col("turn") % 2 == 0
    slots = F.when(even, F.array(F.col("role"), F.lit(None).cast("string"), F.col("conv_id").cast("string"))).otherwise(
        F.array(s(" "), F.lit(None).cast("string"), s(""))
    )
    return table(spark, d, "conversations").select(
        "conv_id",
        "turn",
        fold(head(w, 3), "; ").alias("first3"),
        joined_or_omit(slots).alias("joined"),
        F.md5(F.array_join(F.array_distinct(w), " ")).alias("distinct_words"),
        F.substring("text", 1, 80).alias("cut80"),
        F.substring("text", 1, 200).alias("cut200"),
    )


@check(
    "contacts_union",
    "SO1 SO2 FN11",
    """
WITH c AS (SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, 0 AS pos, c_name AS last, '' AS first, 'metadata' AS kind, 'Owner' AS role FROM c
UNION ALL SELECT c_custkey, 1, n_name, 'Bo', 'resource', 'reviewer' FROM c
UNION ALL SELECT c_custkey, 2, n_name, 'Cy', NULL, NULL FROM c WHERE c_custkey % 2 = 0
UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE 2 END, c_name, 'Di', NULL, 'Author' FROM c
""",
)
def contacts_union(spark, d):
    joined = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    none = F.array().cast(f"array<{CONTACT}>")
    tagged = iso.all_tagged(
        F.array(full_contact(F.col("c_name"), role=s("OWNER"))),
        F.array(full_contact(F.concat(s("Bo "), "n_name"), role=s("reviewer"))),
    )
    creators = F.when(
        F.col("c_custkey") % 2 == 0, F.array(full_contact(F.concat(s("Cy "), "n_name"), role=s("")))
    ).otherwise(F.array(full_contact(s(""))))
    contributors = F.array(full_contact(F.concat("c_name", s(", Di")), role=s("author")))
    everyone = F.filter(
        ra.all_contacts(tagged, creators, none, contributors), lambda c: truthy(c["name"]).isNotNull()
    )
    rows = F.arrays_zip(everyone.alias("c"), ra.persons(everyone).alias("p"))
    return joined.select("c_custkey", F.posexplode(rows).alias("pos", "z")).select(
        "c_custkey",
        "pos",
        F.col("z.p.last_name").alias("last"),
        F.col("z.p.first_name").alias("first"),
        F.col("z.c.type").alias("kind"),
        F.get(F.col("z.p.roles"), F.lit(0))["name"].alias("role"),
    )


@check(
    "contacts_by_role",
    "FN37",
    """
SELECT conv_id, turn, CASE role WHEN 'user' THEN 1 ELSE 0 END AS creators, CASE role WHEN 'assistant' THEN 2 ELSE 1 END AS publishers,
       CASE role WHEN 'system' THEN 1 ELSE 0 END AS contributors
FROM conversations
""",
)
def contacts_by_role(spark, d):
    role = F.when(F.col("role") == "user", "originator").when(F.col("role") == "assistant", "publisher").otherwise("author")
    people = F.array(full_contact(F.col("text"), role=role), full_contact(s("P"), role=s("publisher")), full_contact(s("Q")))

    def n(name):
        return F.size(iso.contacts_by_role(people, name)).cast("bigint")

    return table(spark, d, "conversations").select(
        "conv_id", "turn", n("originator").alias("creators"), n("publisher").alias("publishers"), n("author").alias("contributors")
    )


@check(
    "person_comments",
    "FN10",
    """
SELECT conv_id, turn, CASE WHEN role = 'user' THEN concat_ws(';;', 'Position|user', CASE WHEN turn % 3 > 0 THEN 'Online Resource|http://c/' || conv_id END)
       ELSE CASE WHEN turn % 3 > 0 THEN role || '|http://c/' || conv_id ELSE '' END END AS comments
FROM conversations
""",
)
def person_comments(spark, d):
    user = F.col("role") == "user"
    contact = full_contact(
        s("x"),
        position=F.when(user, F.col("role")).otherwise(""),
        online_resource_url=F.when(F.col("turn") % 3 > 0, F.concat(s("http://c/"), F.col("conv_id").cast("string"))),
        online_resource_name=F.when(~user, F.col("role")).otherwise(""),
    )
    return table(spark, d, "conversations").select(
        "conv_id", "turn", pairs_text(ra.person_comments(contact)).alias("comments")
    )


@check(
    "publications",
    "PF14 FN15",
    """
SELECT doc_id, source AS title, NULL::VARCHAR AS authors, CASE doc_id % 5 WHEN 0 THEN '10.1/' || doc_id WHEN 1 THEN 'urn:DOI:' || doc_id
       WHEN 2 THEN 'not-a-doi' ELSE 'x' || doc_id END AS doi
FROM documents WHERE doc_id % 5 <> 4
""",
)
def publications(spark, d):
    k, key = F.col("doc_id") % 5, F.col("doc_id").cast("string")
    code = (
        F.when(k == 0, F.concat(s("10.1/"), key))
        .when(k == 1, F.concat(s("urn:DOI:"), key))
        .when(k == 2, "not-a-doi")
        .otherwise(F.concat(s("x"), key))
    )
    ids = iso.zip_identifiers(F.array(code, s("")), F.array(F.when(k == 3, "my-ISBN-13")))
    people = ra.persons(F.array(full_contact(F.concat(s("A "), "lang"), role=s("author"))))
    pubs = ra.publications(ids, F.col("source"), ra.authors_text(people))
    return table(spark, d, "documents").select("doc_id", F.inline(pubs))


@check(
    "authors",
    "AG11 AG12",
    """
SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name || ', N.; ' || s_name || ', ' END AS record_authors,
       CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name || ', N.; ' || s_name END AS graph_authors
FROM supplier
""",
)
def authors(spark, d):
    from sheafline.plans import graph_arc as ga

    role = F.when(F.col("s_suppkey") % 3 == 0, "Author").otherwise("author")

    def person(first):
        none = F.lit(None).cast("string")
        return F.struct(
            F.col("s_name"), first, none, none, none, none, none, F.array(term(role)), F.array().cast("array<struct<name:string,value:string>>")
        ).cast(PERSON)

    people = F.array(person(F.concat(s("N"), F.col("s_nationkey").cast("string"))), person(s("")))
    return table(spark, d, "supplier").select(
        "s_suppkey", ra.authors_text(people).alias("record_authors"), ga.authors_text(people).alias("graph_authors")
    )


@check(
    "record_comments",
    "FN12 PF15",
    """
SELECT doc_id, md5(concat_ws(';;', 'Metadata Standard|ISO', 'Language|' || lang, CASE WHEN doc_id % 2 = 0 THEN 'Edition|' || doc_id END,
       'Purpose|' || text, CASE doc_id % 3 WHEN 0 THEN 'Hierarchy Level|series' END, 'Access Constraints|' || lang || ', ' || source,
       'Other Constraints|1; 2; 3', 'Other Constraints URLs|' || source)) AS comments
FROM documents
""",
)
def record_comments(spark, d):
    k = F.col("doc_id")
    r = record_fields(
        metadata_standard_name=s("ISO"),
        parent_identifier=s(""),
        language=F.col("lang"),
        edition=F.when(k % 2 == 0, k.cast("string")),
        purpose=F.col("text"),
        hierarchy=F.when(k % 3 == 0, "series").when(k % 3 == 1, "nonGeographicDataset"),
        access_constraints=F.array("lang", "source"),
        other_constraints=F.array(s("1"), s("2"), s("3"), s("4")),
        other_constraints_url=F.array("source"),
    )
    return table(spark, d, "documents").select("doc_id", F.md5(pairs_text(ra.record_comments(r))).alias("comments"))


@check(
    "record_scalars",
    "FN17 FN21 FN22 FN32 FN34 FN35",
    """
SELECT doc_id,
       md5(CASE doc_id % 4 WHEN 0 THEN 'Imported from INSPIRE metadata' WHEN 1 THEN 'Lineage: ' || text WHEN 2 THEN 'Lineage: ' || text || ' | Purpose: ' || source
           ELSE 'Supplemental: ' || lang END) AS description,
       CASE doc_id % 4 WHEN 0 THEN 'PASS' WHEN 1 THEN 'PASS' WHEN 2 THEN 'FAIL' ELSE 'Unknown' END AS status,
       CASE WHEN doc_id % 2 = 0 THEN source || ' v' || doc_id ELSE source END AS format,
       lang || ', ' || source AS created
FROM documents
""",
)
def record_scalars(spark, d):
    k = F.col("doc_id") % 4
    degree = F.when(k == 0, "TRUE").when(k == 1, "Pass").when(k == 2, "no").otherwise("")
    dates = F.array(
        F.struct(F.col("lang").alias("date"), s("creation").alias("datetype")),
        F.struct(s("x").alias("date"), F.lit(None).cast("string").alias("datetype")),
        F.struct(F.col("source").alias("date"), s("creation").alias("datetype")),
    )
    return table(spark, d, "documents").select(
        "doc_id",
        F.md5(
            ra.study_description(
                F.when(k.isin(1, 2), F.col("text")).otherwise(""),
                F.when(k == 2, F.col("source")),
                F.when(k == 3, F.col("lang")),
            )
        ).alias("description"),
        ra.conformance_status(degree).alias("status"),
        ra.format_label(F.col("source"), F.when(F.col("doc_id") % 2 == 0, F.col("doc_id").cast("string")).otherwise("")).alias("format"),
        ra.dates_of(dates, "creation").alias("created"),
    )


@check(
    "ontology_sources",
    "FN14",
    """
SELECT doc_id, source AS name, NULL AS file, CASE WHEN doc_id % 2 = 0 THEN '2003' ELSE '' END AS version FROM documents WHERE doc_id % 3 > 0
UNION ALL
SELECT doc_id, v.name, v.file, '' FROM documents, (VALUES ('NCIT', 'http://purl.obolibrary.org/obo/ncit.owl'), ('GEMET', 'http://www.eionet.europa.eu/gemet'),
  ('EDAM', 'http://edamontology.org'), ('ISO', 'http://www.isotc211.org/2005/gco')) v(name, file)
""",
)
def ontology_sources(spark, d):
    k = F.col("doc_id")
    sources = ra.ontology_sources(F.when(k % 3 > 0, F.col("source")).otherwise(""), F.when(k % 2 == 0, "2003"))
    return table(spark, d, "documents").select("doc_id", F.inline(sources)).drop("description")


@check(
    "spatial_table",
    "FN18",
    """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 OR NOT (o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 OR o_orderkey % 7 = 0) THEN NULL ELSE
  concat_ws(';;', 'input|Source Name|Geographic Region',
    CASE WHEN o_orderkey % 2 = 0 THEN 'parameter|Bounding Box|[' || cast(o_custkey AS DOUBLE)::VARCHAR || ', ' || o_totalprice::VARCHAR || ', 11.0, 49.5]' END,
    CASE WHEN o_orderkey % 3 = 0 THEN 'parameter|Coordinate Reference System|EPSG:4326, WGS' || o_custkey END,
    CASE WHEN o_orderkey % 5 = 0 THEN 'parameter|Spatial Resolution (Scale)|1:1000, 1:' || o_custkey END,
    CASE WHEN o_orderkey % 7 = 0 THEN 'parameter|Spatial Resolution (Distance)|' || o_totalprice::VARCHAR || ' km' END,
    'output|Sample Name|Selected Location') END AS cells
FROM orders
""",
)
def spatial_table(spark, d):
    k = F.col("o_orderkey")
    r = record_fields(
        hierarchy=F.when(k % 6 == 0, "nonGeographicDataset").when(k % 6 == 1, "dataset"),
        spatial_extent=F.when(
            k % 2 == 0, F.array(F.col("o_custkey").cast("double"), F.col("o_totalprice"), F.lit(11.0), F.lit(49.5))
        ),
        reference_systems=F.when(
            k % 3 == 0,
            F.array(
                *[
                    F.struct(
                        code.alias("code"), F.lit(None).alias("code_url"), space.alias("codespace"),
                        F.lit(None).alias("codespace_url"), F.lit(None).alias("version"), F.lit(None).alias("version_url"),
                    )
                    for code, space in (
                        (s("4326"), s("EPSG")),
                        (F.concat(s("WGS"), F.col("o_custkey").cast("string")), F.lit(None).cast("string")),
                    )
                ]
            ),
        ),
        spatial_resolution_denominators=F.when(k % 5 == 0, F.array(F.lit(1000).cast("bigint"), F.col("o_custkey"))),
        spatial_resolution_distances=F.when(
            k % 7 == 0, F.array(F.struct(F.col("o_totalprice").alias("value"), s("km").alias("uom")))
        ),
    )
    return table(spark, d, "orders").select("o_orderkey", cells_text(ra.spatial_table(r)).alias("cells"))


def _dated(date, kind):
    return F.struct(date.alias("date"), s(kind).alias("datetype"))


@check(
    "acquisition_table",
    "FN19",
    """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE
  concat_ws(';;', 'input|Sample Name|Selected Location',
    CASE o_orderkey % 4 WHEN 1 THEN 'parameter|Temporal Extent|' || o_orderstatus || ' to unknown' WHEN 2 THEN 'parameter|Temporal Extent|' || o_orderstatus || ' to ' || o_orderpriority END,
    CASE WHEN o_orderkey % 4 IN (2, 3) THEN 'parameter|Acquisition Date|' || strftime(o_orderdate, '%Y-%m-%d') || ', 2000' END,
    'output|Data|Raw Data') END AS cells
FROM orders
""",
)
def acquisition_table(spark, d):
    k = F.col("o_orderkey") % 4
    made = _dated(F.date_format("o_orderdate", "yyyy-MM-dd"), "creation")
    r = record_fields(
        temporal_extent=F.when(
            k.isin(1, 2), iso.temporal_extent(F.col("o_orderstatus"), F.when(k == 2, F.col("o_orderpriority")).otherwise(""))
        ),
        dates=F.when(k.isin(2, 3), F.array(made, _dated(s("1999"), "revision"), _dated(s("2000"), "creation"))).otherwise(
            F.array(_dated(s("1999"), "revision"))
        ),
    )
    return table(spark, d, "orders").select("o_orderkey", cells_text(ra.acquisition_table(r)).alias("cells"))


@check(
    "processing_table",
    "FN20",
    """
SELECT doc_id, md5(CASE doc_id % 4 WHEN 0 THEN 'input|Data|Raw Data;;parameter|Note|Data processing details from INSPIRE metadata;;output|Data|Processed Data'
  WHEN 1 THEN NULL ELSE concat_ws(';;', 'input|Data|Raw Data', 'parameter|Processing Description|' || left(text, 500),
    CASE WHEN doc_id % 4 = 2 THEN 'parameter|Lineage Documentation URL|http://l/' || doc_id END,
    'parameter|Conformance|' || source || ': PASS', 'parameter|Conformance|' || lang || ': Unknown', 'parameter|Output Format|' || lang || ' v1.0',
    'parameter|Processing Date|' || source || ', ' || lang, 'output|Data|Processed Data') END) AS cells
FROM documents
""",
)
def processing_table(spark, d):
    k = F.col("doc_id") % 4
    full = k.isin(2, 3)
    none = F.lit(None).cast("string")
    results = iso.zip_conformance(
        F.array("source", "lang"), F.array(none), F.array(none), F.array(none), F.array(s("pass"), none)
    )
    formats = F.array(F.struct(F.col("lang"), s("1.0"), none, none, none, none))
    r = record_fields(
        lineage=F.when(full, F.col("text")),
        lineage_url=F.when(k == 2, F.concat(s("http://l/"), F.col("doc_id").cast("string"))),
        conformance_results=F.when(full, results),
        distribution_formats=F.when(full, formats.cast(RECORD_FIELDS["distribution_formats"])),
        dates=F.when(
            full, F.array(_dated(F.col("source"), "publication"), _dated(s("no"), "creation"), _dated(F.col("lang"), "revision"))
        ).when(k == 0, F.array(_dated(s("no"), "creation"))),
    )
    return table(spark, d, "documents").select("doc_id", F.md5(cells_text(ra.processing_table(r))).alias("cells"))


@check(
    "assay_table",
    "FN23",
    """
SELECT page_id, concat_ws(';;', 'input|Source Name|Dataset Source',
  CASE page_id % 3 WHEN 0 THEN 'output|URI|doi:' || page_id WHEN 1 THEN 'output|URI|' || url ELSE 'output|URI|page_' || page_id || '_dataset' END,
  CASE page_id % 3 WHEN 0 THEN 'comment|Online Resource|' || url || ';' || url || '/b' WHEN 1 THEN 'comment|Online Resource|' || url || '/b' END,
  CASE WHEN page_id % 3 = 0 THEN 'comment|Online Resource Name|first;' END,
  CASE page_id % 3 WHEN 0 THEN 'comment|Online Resource Function|;download' WHEN 1 THEN 'comment|Online Resource Function|download' END,
  CASE WHEN page_id % 2 = 0 THEN 'comment|Graphic Overview|' || url || '.png;x.png' END) AS cells
FROM pages
""",
)
def assay_table(spark, d):
    k = F.col("page_id") % 3
    none = F.lit(None).cast("string")

    def online(url, name, function):
        return F.struct(url, none, none, name, none, s(" "), none, function).cast(ONLINE)

    r = record_fields(
        title=F.concat(s("Page "), F.col("page_id").cast("string")),
        dataset_uri=F.when(k == 0, F.concat(s("doi:"), F.col("page_id").cast("string"))).otherwise(""),
        online_resources=F.when(
            k < 2,
            F.array(online(F.col("url"), s("first"), none), online(F.concat("url", s("/b")), none, s("download"))),
        ).otherwise(F.array().cast(RECORD_FIELDS["online_resources"])),
        graphic_overviews=F.when(
            F.col("page_id") % 2 == 0, F.array(F.concat("url", s(".png")), s("x.png"))
        ),
    )
    return table(spark, d, "pages").select("page_id", cells_text(ra.assay_table(r)).alias("cells"))
