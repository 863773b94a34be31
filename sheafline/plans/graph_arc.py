"""Schema.org graph -> investigation, study and assay.

The graph of a page is a map in the page's row, so every hop is a lookup and nothing is shuffled. Work is
laid out in a few projections (subject, linked nodes, persons, documents) so that nothing is computed twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.functions.names import split_name_at_last_blank
from sheafline.functions.terms import GRAPH_VOCABULARIES, term
from sheafline.functions.text import concat_truthy, doi_from, fold, slug, truthy
from sheafline.operators.once import compute_once
from sheafline.operators.outcomes import to_outcomes
from sheafline.plans.parts import cell, comment, crate_json, framed, ontology_source, table
from sheafline.schemas import ASSAY, COMMENT, INVESTIGATION, PERSON, PUBLICATION, STUDY
from sheafline.session import built_once
from sheafline.sources.jsonld import OBJECTS, RDF_TYPE, SCHEMA_HTTP, SCHEMA_HTTPS

EMPTY_GRAPH = "Graph does not contain a Schema.org Dataset entity"
STUDY_DEFAULT_DESCRIPTION = "Imported from Schema.org metadata"
PROCESSING_NOTE = "Data processing and publication according to Schema.org metadata standard"
_PERSON_PROPERTIES = ("name", "givenName", "familyName", "email", "url", "encodingFormat", "contentUrl")
_LINKS = ("creator", "author", "contributor", "publisher", "distribution")


def objects(props: Column, predicate: Column) -> Column:
    """All objects of a predicate in document order, with their kind."""
    return F.coalesce(F.try_element_at(props, predicate), F.array().cast(OBJECTS))


def texts(props: Column, predicate: Column) -> Column:
    """All objects of a predicate as text."""
    return F.transform(objects(props, predicate), lambda x: x["o"])


def first_text(props: Column, predicate: Column) -> Column:
    """First object of a predicate; null without any."""
    return F.get(F.try_element_at(props, predicate), F.lit(0))["o"]


def has_type(props: Column, iri: Column) -> Column:
    """Whether the node's properties give it the type."""
    return F.exists(objects(props, F.lit(RDF_TYPE)), lambda x: x["o"] == iri)


def with_subject(graphs: DataFrame) -> DataFrame:
    """Add ``ns``, ``subject`` and ``own`` (its properties).

    The subject is the first Dataset in the https namespace, then in http, else the first subject.
    """

    def dataset(ns: str) -> Column:
        typed = F.filter(F.map_entries("graph"), lambda e: has_type(e["value"], F.lit(ns + "Dataset")))
        return F.get(typed, F.lit(0))["key"]

    found = graphs.select("*", dataset(SCHEMA_HTTPS).alias("__https"), dataset(SCHEMA_HTTP).alias("__http"))
    chosen = found.select(
        *graphs.columns,
        F.when(F.col("__https").isNull() & F.col("__http").isNotNull(), F.lit(SCHEMA_HTTP))
        .otherwise(F.lit(SCHEMA_HTTPS))
        .alias("ns"),
        F.coalesce("__https", "__http", F.get(F.map_keys("graph"), F.lit(0))).alias("subject"),
    )
    return chosen.select("*", F.try_element_at("graph", "subject").alias("own"))


def _p(name: str) -> Column:
    return F.concat(F.col("ns"), F.lit(name))


def _value(name: str, props: Column | None = None) -> Column:
    return first_text(F.col("own") if props is None else props, _p(name))


def linked_nodes() -> Column:
    """Nodes the subject points to, with the few texts the mapping reads from them."""

    def role_nodes(role: str) -> Column:
        return F.transform(
            objects(F.col("own"), _p(role)),
            lambda x: F.struct(
                F.lit(role).alias("role"),
                x["kind"].alias("kind"),
                x["o"].alias("o"),
                F.when(x["kind"] != "literal", F.try_element_at("graph", x["o"])).alias("props"),
            ),
        )

    with_props = F.concat(*[role_nodes(r) for r in _LINKS])

    def read(n: Column) -> Column:
        place = F.get(F.try_element_at(n["props"], _p("address")), F.lit(0))
        parts = F.try_element_at("graph", place["o"])
        return F.struct(
            n["role"].alias("role"),
            n["kind"].alias("kind"),
            n["o"].alias("o"),
            has_type(n["props"], _p("Organization")).alias("is_org"),
            *[_value(p, n["props"]).alias(p) for p in _PERSON_PROPERTIES],
            F.when(place["kind"] == "literal", place["o"])
            .otherwise(
                concat_truthy(", ", *[_value(p, parts) for p in ("streetAddress", "postalCode", "addressCountry")])
            )
            .alias("address"),
        )

    return F.transform(with_props, read)


def derived_name(given: Column, family: Column, name: Column) -> Column:
    """``struct<given,family>``: the properties when one is filled, else the split name."""
    given, family = F.coalesce(given, F.lit("")), F.coalesce(family, F.lit(""))
    split = split_name_at_last_blank(F.coalesce(name, F.lit("")))
    return F.when((given != "") | (family != ""), F.struct(given.alias("given"), family.alias("family"))).otherwise(split)


def person_row(last: Column, first: Column, role: Column, **other: Column) -> Column:
    """A person in one role."""
    none = F.lit(None).cast("string")
    return F.struct(
        last.alias("last_name"),
        first.alias("first_name"),
        other.get("email", none).alias("email"),
        other.get("affiliation", none).alias("affiliation"),
        other.get("address", none).alias("address"),
        none.alias("phone"),
        none.alias("fax"),
        F.array(term(role)).alias("roles"),
        other.get("comments", F.array().cast(f"array<{COMMENT}>")).alias("comments"),
    ).cast(PERSON)


def node_to_person(node: Column) -> Column:
    """Person of a linked node: literal, organisation or person; null without any name."""
    role = F.when(node["role"] == "creator", F.lit("author")).otherwise(node["role"])
    derived = derived_name(node["givenName"], node["familyName"], node["name"])
    nameless = F.coalesce(*[truthy(node[p]) for p in ("givenName", "familyName", "name")]).isNull()
    blank = F.lit("")
    return (
        F.when(
            node["kind"] == "literal", F.when(truthy(node["o"]).isNotNull(), person_row(node["o"], blank, role))
        )
        .when(
            node["is_org"],
            F.when(
                truthy(node["name"]).isNotNull(), person_row(node["name"], blank, role, affiliation=node["name"])
            ),
        )
        .when(
            ~nameless,
            person_row(
                derived["family"],
                derived["given"],
                role,
                email=node["email"],
                address=node["address"],
                comments=F.array_compact(F.array(comment("URL", truthy(node["url"])))),
            ),
        )
    )


def people() -> Column:
    """Every creator, author, contributor and the first publisher, with the name authors are compared by."""
    ordered = F.concat(
        F.filter("nodes", lambda n: n["role"].isin("creator", "author", "contributor")),
        F.slice(F.filter("nodes", lambda n: n["role"] == "publisher"), 1, 1),
    )
    return F.filter(
        F.transform(
            ordered,
            lambda n: F.struct(
                n["role"].alias("role"),
                node_to_person(n).alias("person"),
                derived_name(n["givenName"], n["familyName"], n["name"]).alias("key"),
            ),
        ),
        lambda x: x["person"].isNotNull(),
    )


def contacts() -> Column:
    """Creators, authors whose name is not there yet, contributors, publisher."""
    listed = f"array<{PERSON}>"

    def person(x: Column) -> Column:
        return x["person"]

    return F.concat(
        F.aggregate(
            F.filter("people", lambda x: x["role"] == "author"),
            F.transform(F.filter("people", lambda x: x["role"] == "creator"), person).cast(listed),
            lambda acc, a: F.when(
                F.exists(
                    acc, lambda p: (p["first_name"] == a["key"]["given"]) & (p["last_name"] == a["key"]["family"])
                ),
                acc,
            ).otherwise(F.concat(acc, F.array(a["person"])).cast(listed)),
        ),
        F.transform(F.filter("people", lambda x: x["role"].isin("contributor", "publisher")), person),
    )


def authors_text(people: Column) -> Column:
    """``Last, F.``, ``Last`` or ``First`` per author, joined with ``; ``; null without authors."""
    authors = F.filter(people, lambda p: F.exists(p["roles"], lambda r: r["name"] == "author"))
    first, last = (lambda p: truthy(p["first_name"])), (lambda p: truthy(p["last_name"]))
    return fold(
        F.filter(
            F.transform(
                authors,
                lambda p: F.coalesce(
                    F.concat(last(p), F.lit(", "), F.substring(first(p), 1, 1), F.lit(".")), last(p), first(p)
                ),
            ),
            lambda x: x.isNotNull(),
        ),
        "; ",
    )


def dataset_id(doi: Column, subject: Column, title: Column) -> Column:
    """DOI as it is; else the subject, or the title slug when the subject has a slash."""
    plain = F.coalesce(truthy(subject), slug(title))
    return F.when(truthy(doi).isNotNull(), doi).when(
        plain.contains("/"), F.coalesce(truthy(slug(title)), F.element_at(F.split(plain, "/"), -1))
    ).otherwise(plain)


def publications(doi: Column, name: Column, authors: Column, citations: Column) -> Column:
    """The dataset's own DOI, then citations that are not that DOI, cut to 200 characters."""
    own = F.when(
        truthy(doi).isNotNull(),
        F.struct(
            F.coalesce(truthy(name), F.lit("Untitled")).alias("title"), authors.alias("authors"), doi.alias("doi")
        ).cast(PUBLICATION),
    )
    cited = F.transform(
        F.filter(citations, lambda c: (c != "") & (doi.isNull() | (c != doi))),
        lambda c: F.struct(
            F.substring(c, 1, 200).alias("title"),
            F.lit(None).cast("string").alias("authors"),
            F.lit(None).cast("string").alias("doi"),
        ).cast(PUBLICATION),
    )
    return F.concat(F.array_compact(F.array(own)), cited)


def graph_comments() -> Column:
    """Keywords, licence, language, version, URL, conformance, then one per distribution."""
    listed = [comment("Keywords", fold(F.col("keywords"), ", "))]
    for label, name in (("License", "license"), ("Language", "inLanguage"), ("Version", "version"), ("URL", "dataset_url")):
        listed.append(comment(label, truthy(F.col(name))))
    listed.append(comment("Conforms To", _value("conformsTo")))
    offers = F.transform(
        F.filter("nodes", lambda n: (n["role"] == "distribution") & (n["kind"] != "literal")),
        lambda n: F.struct(
            F.coalesce(n["encodingFormat"], F.lit("")).alias("format"),
            F.coalesce(n["contentUrl"], F.lit("")).alias("url"),
        ),
    )
    distributions = F.transform(
        F.filter(offers, lambda o: (o["format"] != "") | (o["url"] != "")),
        lambda o: comment("Distribution", F.concat(o["format"], F.lit(": "), o["url"])),
    )
    return F.concat(F.array_compact(F.array(*listed)), distributions).cast(f"array<{COMMENT}>")


def collection_table(keywords: Column, description: Column) -> Column:
    """Data Collection; null without keywords and description."""
    parameters = F.array_compact(F.array(cell("parameter", "Keywords", fold(keywords, ", "))))
    return F.when(
        (F.size(keywords) > 0) | truthy(description).isNotNull(),
        framed(
            "Data Collection",
            cell("input", "Source Name", "Research Subject"),
            parameters,
            cell("output", "Sample Name", ""),
        ),
    )


def processing_table(publisher_name: Column) -> Column:
    """Data Processing with a fixed note, followed by the publisher when named."""
    note = F.concat(
        F.lit(PROCESSING_NOTE), F.coalesce(F.concat(F.lit(" | Publisher: "), truthy(publisher_name)), F.lit(""))
    )
    return framed(
        "Data Processing",
        cell("input", "Data", "Raw Data"),
        F.array(cell("parameter", "Processing Description", note)),
        cell("output", "Data", "Published Dataset"),
    )


def assay_table(address: Column, license_text: Column, has_publisher: Column, publisher_name: Column, language: Column) -> Column:
    """Measurement: address, licence, publisher, language."""
    publisher = F.when(has_publisher, F.coalesce(truthy(publisher_name), F.lit("Unknown Publisher")))
    return table(
        "Measurement",
        F.array_compact(
            F.array(
                cell("input", "Source Name", "Dataset Source"),
                cell("output", "URI", address),
                cell("comment", "License", truthy(license_text)),
                cell("comment", "Publisher", publisher),
                cell("comment", "Language", truthy(language)),
            )
        ),
    )


def map_graphs(graphs: DataFrame) -> DataFrame:
    """Add ``investigation, study, assay`` to page graphs; all null where ``graph`` has no triple."""
    keep = [c for c in graphs.columns if c != "graph"]
    located = with_subject(graphs)
    laid_out = compute_once(located, [*keep, "ns", "subject", "own"], nodes=built_once("graph nodes", linked_nodes))
    publisher = F.get(F.filter("nodes", lambda n: n["role"] == "publisher"), F.lit(0))
    carried = [*keep, "ns", "subject", "own", "nodes"]
    read = compute_once(
        laid_out,
        carried,
        **{p: _value(p) for p in ("name", "description", "license", "inLanguage", "version")},
        dataset_url=_value("url"),
        published=_value("datePublished"),
        modified=_value("dateModified"),
        doi=doi_from(_value("identifier"), F.col("subject")),
        people=built_once("graph people", people),
        publisher=publisher,
        keywords=texts(F.col("own"), _p("keywords")),
    )
    facts = compute_once(read, read.columns, contacts=built_once("graph contacts", contacts))
    title = F.coalesce(truthy(F.col("name")), F.lit("Untitled Dataset"))
    ident = F.coalesce(truthy(slug(title)), F.lit("dataset"))
    investigation = F.struct(
        dataset_id(F.col("doi"), F.col("subject"), title).alias("identifier"),
        title.alias("title"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce(truthy(F.col("published")), truthy(F.col("modified")), F.lit("")).alias("submission_date"),
        F.col("contacts"),
        publications(
            F.col("doi"), F.col("name"), authors_text(F.col("contacts")), texts(F.col("own"), _p("citation"))
        ).alias("publications"),
        graph_comments().alias("comments"),
        F.array(*[ontology_source(n, f, "", d) for n, f, d in GRAPH_VOCABULARIES]).alias("ontology_sources"),
    ).cast(INVESTIGATION)
    study = F.struct(
        ident.alias("identifier"),
        title.alias("title"),
        F.coalesce(truthy(F.col("description")), F.lit(STUDY_DEFAULT_DESCRIPTION)).alias("description"),
        F.col("published").alias("submission_date"),
        F.array(ident).alias("registered_assays"),
        F.array_compact(
            F.array(
                collection_table(F.col("keywords"), F.col("description")), processing_table(F.col("publisher.name"))
            )
        ).alias("tables"),
    ).cast(STUDY)
    assay = F.struct(
        ident.alias("identifier"),
        title.alias("title"),
        term("Data Collection").alias("measurement_type"),
        term("Data Repository").alias("technology_type"),
        term("Schema.org Data Repository").alias("technology_platform"),
        F.array(
            assay_table(
                F.coalesce(truthy(F.col("dataset_url")), F.col("subject")),
                F.col("license"),
                F.col("publisher").isNotNull(),
                F.col("publisher.name"),
                F.col("inLanguage"),
            )
        ).alias("tables"),
    ).cast(ASSAY)
    found = F.col("subject").isNotNull()
    return facts.select(
        *keep,
        "subject",
        F.when(found, investigation).alias("investigation"),
        F.when(found, study).alias("study"),
        F.when(found, assay).alias("assay"),
    )


def graph_outcomes(graphs: DataFrame) -> DataFrame:
    """Outcomes of page graphs (``rdi, seq, url, graph, graph_error``)."""
    mapped = map_graphs(graphs)
    problem = F.coalesce("graph_error", F.when(F.col("subject").isNull(), F.lit(EMPTY_GRAPH)))
    staged = mapped.select(
        "rdi", "seq", "url", "investigation", "study", "assay", problem.alias("problem")
    )
    good = F.col("problem").isNull()
    document = built_once(
        "graph document",
        lambda: crate_json(
            F.col("investigation"), F.col("study"), F.col("assay"), F.array().cast("array<string>")
        ),
    )
    return to_outcomes(
        staged,
        rdi=F.col("rdi"),
        seq=F.col("seq"),
        kind=F.when(good, F.lit("arc")).otherwise(F.lit("error")),
        arc_json=F.when(good, document),
        record_id=F.when(~good, F.col("url")),
        source_url=F.col("url"),
        message=F.when(~good, F.concat(F.lit("Failed to map dataset "), "url", F.lit(": "), "problem")),
    )
