"""JSON-LD pages: blocks, triples, graph mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafline.checks.base import HOST_SQL, PAGE_TITLE_SQL, check, page_title, s, slug_sql, spread_table, table
from sheafline.checks.builders import cells_text, pairs_text
from sheafline.functions.text import url_host
from sheafline.operators.outcomes import arc_identifier, harvest_counts
from sheafline.plans import graph_arc as ga
from sheafline.plans.registry import DATASETS, MAPPERS, SOURCES
from sheafline.sources import jsonld

_OPEN = '<script type="application/ld+json">'


def script(json, tag=_OPEN, end="</script>"):
    """A JSON-LD script element. A closing tag inside the JSON is escaped, as page writers do."""
    return F.concat(s(tag), F.replace(json, s("</"), s("<\\/")), s(end))


def _obj(**fields):
    return F.struct(*[v.alias(k.replace("__", "@")) for k, v in fields.items()])


@check(
    "jsonld_blocks",
    "SC8",
    """
SELECT page_id, 0 AS block_no, '{"p":' || page_id || '}' AS json FROM pages
UNION ALL SELECT page_id, 1, '[' || page_id || ']' FROM pages WHERE page_id % 2 = 1
""",
)
def jsonld_blocks(spark, d):
    pid = F.col("page_id").cast("string")
    html = F.concat(
        s('<!-- <script type="application/ld+json">{"no":1}</script> -->'),
        s('<script type="application/ld+json; charset=utf-8">{"no":2}</script><script>var s = "<!--";</script>'),
        script(F.to_json(F.struct(F.col("page_id").alias("p"))), "<SCRIPT id='a>b' Type = 'application/ld+json'\n>", "</SCRIPT >"),
        "html",
        F.when(F.col("page_id") % 2 == 1, F.concat(s("<script type=application/ld+json>["), pid, s("]</script>"))).otherwise(
            s('<script type="application/LD+json">{"no":3}</script>')
        ),
        s('<script type="application/ld+json">{"unclosed":1}'),
    )
    pages = table(spark, d, "pages").select(pid.alias("url"), html.alias("html"))
    return jsonld.read_jsonld_blocks(pages).select(F.col("url").cast("bigint").alias("page_id"), "block_no", "json")


def _triple_pages(spark, d):
    pid = F.col("page_id").cast("string")
    first = F.to_json(
        _obj(
            __context=s("https://schema.org"),
            __type=s("Dataset"),
            __id=F.concat(s("http://d/"), pid),
            name=page_title(F.col("html")),
            keywords=F.array(s("k"), pid, s("k")),
            version=F.col("page_id"),
            creator=_obj(__type=s("Person"), name=F.concat(s("P "), pid)),
            license=_obj(__value=s("CC")),
        )
    )
    again = F.to_json(
        F.struct(
            F.struct(s("http://schema.org/").alias("@vocab"), s("http://purl.org/dc/terms/").alias("dct")).alias("@context"),
            F.array(
                F.struct(
                    F.concat(s("http://d/"), pid).alias("@id"),
                    page_title(F.col("html")).alias("name"),
                    F.col("url").alias("dct:source"),
                )
            ).alias("@graph"),
        )
    )
    return spread_table(spark, d, "pages").select(
        F.concat(s("http://p/"), pid).alias("url"), F.concat("html", script(first), script(again)).alias("html")
    )


@check(
    "jsonld_triples",
    "SC9 SO3 PF12",
    f"""
WITH p AS (SELECT page_id, url AS src, 'http://p/' || page_id AS url, 'http://d/' || page_id AS s, {PAGE_TITLE_SQL} AS title,
             'n' || left(sha256('http://p/' || page_id), 16) || '-0-0-creator-0' AS b FROM pages)
SELECT url, s, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' AS p, 'iri' AS kind, 'http://schema.org/Dataset' AS o FROM p
UNION ALL SELECT url, s, 'http://schema.org/name', 'literal', title FROM p
UNION ALL SELECT url, s, 'http://schema.org/keywords', 'literal', 'k' FROM p
UNION ALL SELECT url, s, 'http://schema.org/keywords', 'literal', page_id::VARCHAR FROM p
UNION ALL SELECT url, s, 'http://schema.org/version', 'literal', page_id::VARCHAR FROM p
UNION ALL SELECT url, s, 'http://schema.org/license', 'literal', 'CC' FROM p
UNION ALL SELECT url, s, 'http://schema.org/creator', 'bnode', b FROM p
UNION ALL SELECT url, b, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type', 'iri', 'http://schema.org/Person' FROM p
UNION ALL SELECT url, b, 'http://schema.org/name', 'literal', 'P ' || page_id FROM p
UNION ALL SELECT url, s, 'http://purl.org/dc/terms/source', 'literal', src FROM p
""",
)
def jsonld_triples(spark, d):
    return jsonld.to_triples(DATASETS["html_jsonld"](_triple_pages(spark, d))).drop("ord")


def _dataset_pages(spark, d):
    """Pages with a dataset description, in five conditions by page id."""
    k, pid = F.col("page_id") % 5, F.col("page_id").cast("string")
    title = page_title(F.col("html"))
    ident = F.when(k == 0, F.concat(s("10.5/"), pid)).otherwise("local")
    body = _obj(
        __context=s("https://schema.org/"),
        __type=s("Dataset"),
        name=title,
        description=F.when(k == 1, s("about <b>it</b>")),
        identifier=ident,
        url=F.col("url"),
        datePublished=F.when(F.col("page_id") % 2 == 0, "2020"),
        dateModified=s("2021"),
        inLanguage=F.regexp_extract("html", '<html lang="([a-z]+)"', 1),
        creator=F.array(
            _obj(__type=s("Person"), name=F.concat(s("Ann Bo Lee"), pid), givenName=F.lit(None).cast("string"), familyName=F.lit(None).cast("string")),
            _obj(__type=s("Organization"), name=s("Org"), givenName=F.lit(None).cast("string"), familyName=F.lit(None).cast("string")),
        ),
        author=F.array(
            _obj(__type=s("Person"), name=F.lit(None).cast("string"), givenName=s("Ann Bo"), familyName=F.concat(s("Lee"), pid)),
            _obj(__type=s("Person"), name=s("New Author"), givenName=s(""), familyName=s("")),
        ),
        contributor=s("Con Tributor"),
        publisher=_obj(__id=s("#pub")),
    )
    json = (
        F.when(k == 3, s("{broken"))
        .when(k == 4, F.to_json(F.struct(title.alias("name"))))
        .otherwise(F.to_json(body))
    )
    publisher = F.to_json(_obj(__context=s("http://schema.org"), __id=s("#pub"), __type=s("Organization"), name=s("Pub House")))
    blocks = F.when(k == 2, s("")).otherwise(F.concat(script(json), script(publisher)))
    return spread_table(spark, d, "pages").select(
        s("web").alias("rdi"),
        F.col("page_id").alias("seq"),
        F.concat(s("http://p/"), pid).alias("url"),
        F.concat("html", blocks).alias("html"),
    )


# Without a Dataset the first subject is mapped; in condition 4 that is the publisher, read as https.
_GRAPH_SQL = f"""
WITH p AS (SELECT page_id, url AS src, 'http://p/' || page_id AS url, {PAGE_TITLE_SQL} AS title, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang,
                  'n' || left(sha256('http://p/' || page_id), 16) || '-0-0' AS b FROM pages),
     q AS (SELECT *, CASE WHEN title = '' THEN 'Untitled Dataset' ELSE title END AS t FROM p),
     r AS (SELECT *, {slug_sql('t')} AS sl FROM q)"""


@check(
    "graph_to_arc",
    "PF11 PF13 JN9 JN10 FN27 FN28 FN29 UD2",
    f"""{_GRAPH_SQL}
SELECT url, CASE page_id % 5 WHEN 0 THEN '10.5/' || page_id WHEN 1 THEN b WHEN 4 THEN '#pub' END AS identifier,
  CASE WHEN page_id % 5 < 2 THEN t WHEN page_id % 5 = 4 THEN 'Untitled Dataset' END AS title,
  CASE page_id % 5 WHEN 1 THEN 'about <b>it</b>' WHEN 0 THEN '' WHEN 4 THEN '' END AS description,
  CASE WHEN page_id % 5 < 2 THEN CASE WHEN page_id % 2 = 0 THEN '2020' ELSE '2021' END WHEN page_id % 5 = 4 THEN '' END AS submitted,
  CASE WHEN page_id % 5 < 2 THEN 'Ann Bo+Lee' || page_id || '+author;+Org+author;New+Author+author;+Con Tributor+contributor;+Pub House+publisher' WHEN page_id % 5 = 4 THEN '' END AS people,
  CASE page_id % 5 WHEN 0 THEN t || '+Lee' || page_id || ', A.; Org; Author, N.+10.5/' || page_id WHEN 1 THEN '' WHEN 4 THEN '' END AS pubs,
  CASE WHEN page_id % 5 < 2 THEN concat_ws(';;', CASE WHEN lang <> '' THEN 'Language|' || lang END, 'URL|' || src) WHEN page_id % 5 = 4 THEN '' END AS comments,
  CASE WHEN page_id % 5 < 2 THEN CASE WHEN sl <> '' THEN sl ELSE 'dataset' END WHEN page_id % 5 = 4 THEN 'untitled_dataset' END AS study_id,
  CASE page_id % 5 WHEN 1 THEN 'input|Source Name|Research Subject;;output|Sample Name|' END AS collection,
  CASE WHEN page_id % 5 IN (0, 1, 4) THEN 'input|Data|Raw Data;;parameter|Processing Description|Data processing and publication according to Schema.org metadata standard'
     || CASE WHEN page_id % 5 < 2 THEN ' | Publisher: Pub House' ELSE '' END || ';;output|Data|Published Dataset' END AS processing,
  CASE WHEN page_id % 5 < 2 THEN concat_ws(';;', 'input|Source Name|Dataset Source', 'output|URI|' || src, 'comment|Publisher|Pub House', CASE WHEN lang <> '' THEN 'comment|Language|' || lang END)
     WHEN page_id % 5 = 4 THEN 'input|Source Name|Dataset Source;;output|URI|#pub' END AS measurement
FROM r""",
)
def graph_to_arc(spark, d):
    pages = _dataset_pages(spark, d)
    mapped = MAPPERS["general"](DATASETS["html_jsonld"](pages))
    people = F.array_join(
        F.transform(
            "investigation.contacts",
            lambda p: F.concat_ws("+", p["first_name"], p["last_name"], F.get(p["roles"], F.lit(0))["name"]),
        ),
        ";",
    )
    pubs = F.array_join(
        F.transform("investigation.publications", lambda p: F.concat_ws("+", p["title"], p["authors"], p["doi"])), ";"
    )
    tables = F.col("study.tables")
    return mapped.select(
        "url",
        F.col("investigation.identifier").alias("identifier"),
        F.col("investigation.title").alias("title"),
        F.col("investigation.description").alias("description"),
        F.col("investigation.submission_date").alias("submitted"),
        people.alias("people"),
        pubs.alias("pubs"),
        pairs_text(F.col("investigation.comments")).alias("comments"),
        F.col("study.identifier").alias("study_id"),
        cells_text(F.get(F.filter(tables, lambda t: t["name"] == "Data Collection"), F.lit(0))).alias("collection"),
        cells_text(F.element_at(tables, -1)).alias("processing"),
        cells_text(F.get(F.col("assay.tables"), F.lit(0))).alias("measurement"),
    )


_OUTCOME_SQL = f"""{_GRAPH_SQL}
SELECT url AS source_url, CASE WHEN page_id % 5 IN (0, 1, 4) THEN 'arc' ELSE 'error' END AS kind,
  CASE page_id % 5 WHEN 0 THEN '10.5/' || page_id WHEN 1 THEN b WHEN 4 THEN '#pub' END AS arc_id,
  CASE page_id % 5 WHEN 2 THEN 'Failed to map dataset ' || url || ': No JSON-LD blocks found in HTML at: ' || url
       WHEN 3 THEN 'Failed to map dataset ' || url || ': Invalid JSON in JSON-LD block at ' || url
         || ': Expecting property name enclosed in double quotes: line 1 column 2 (char 1)' || chr(10) || 'Block:' || chr(10) || '{{broken' END AS message
FROM r"""


@check("mapper_registry", "UD3 PF5", _OUTCOME_SQL)
def mapper_registry(spark, d):
    graphs = DATASETS["html_jsonld"](_dataset_pages(spark, d))
    return ga.graph_outcomes(graphs).select("source_url", "kind", arc_identifier(F.col("arc_json")).alias("arc_id"), "message")


@check(
    "graph_persons",
    "FN7 FN9 JN9",
    """
WITH x AS (SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, 0 AS pos, s_name AS last, 'A' AS first, 'a@' || s_suppkey AS email, CASE WHEN s_suppkey % 2 = 0 THEN 'Street 1, ' || n_name ELSE n_name END AS address,
       NULL AS affiliation, 'author' AS role, 'URL|http://o/' || s_suppkey AS comments FROM x
UNION ALL SELECT s_suppkey, 1, n_name, '', NULL, NULL, NULL, 'author', '' FROM x
UNION ALL SELECT s_suppkey, 2, n_name, '', NULL, NULL, NULL, 'author', '' FROM x
UNION ALL SELECT s_suppkey, 3, s_name || ' Inc', '', NULL, NULL, s_name || ' Inc', 'contributor', '' FROM x
UNION ALL SELECT s_suppkey, 4, n_name, n_name, NULL, NULL, NULL, 'publisher', '' FROM x
""",
)
def graph_persons(spark, d):
    joined = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    key = F.col("s_suppkey").cast("string")
    folded = F.to_json(_obj(streetAddress=s("Street 1"), addressCountry=F.col("n_name")))
    address = F.when(F.col("s_suppkey") % 2 == 0, folded).otherwise(F.to_json(F.array("n_name")))
    person = F.concat(
        s('{"@type":"Person","name":"A '), "s_name", s('","email":"a@'), key, s('","url":"http://o/'), key, s('","address":'), address, s("}")
    )
    json = F.concat(
        s('{"@context":{"@vocab":"https://schema.org/"},"@type":["Thing","Dataset"],"name":"x","creator":['), person, s(',"'), "n_name",
        s('"],"author":[{"givenName":"A","familyName":"'), "s_name", s('"},"'), "n_name", s('",{"@type":"Person"}],"contributor":{"@type":"Organization","name":"'),
        "s_name", s(' Inc"},"publisher":[{"@type":"Person","name":"'), "n_name", s('"},"ignored"]}'),
    )
    pages = joined.select("s_suppkey", F.concat(s("http://s/"), key).alias("url"), script(json).alias("html"))
    mapped = ga.map_graphs(jsonld.page_graphs(pages))
    return mapped.select("s_suppkey", F.posexplode("investigation.contacts").alias("pos", "p")).select(
        "s_suppkey",
        "pos",
        F.col("p.last_name").alias("last"),
        F.col("p.first_name").alias("first"),
        F.col("p.email").alias("email"),
        F.col("p.address").alias("address"),
        F.col("p.affiliation").alias("affiliation"),
        F.get(F.col("p.roles"), F.lit(0))["name"].alias("role"),
        pairs_text(F.col("p.comments")).alias("comments"),
    )


def _doc_pages(spark, d):
    """Documents as dataset pages; the whole text is the description and one of the citations."""
    key = F.col("doc_id").cast("string")
    body = _obj(
        __context=s("https://schema.org"),
        __type=s("Dataset"),
        __id=F.concat(s("https://doi.org/10."), key, s("/suffix")),
        name=F.when(F.col("doc_id") % 2 == 0, F.col("source")),
        description=F.col("text"),
        keywords=F.array("lang", "source"),
        license=F.when(F.col("doc_id") % 3 == 0, "CC0").otherwise(""),
        inLanguage=F.col("lang"),
        version=F.col("n_chars"),
        conformsTo=_obj(__id=s("http://profile/1")),
        citation=F.array(F.col("text"), F.concat(s("10."), key), s("")),
        author=s("Solo"),
        distribution=F.array(
            _obj(__type=s("DataDownload"), encodingFormat=s("csv"), contentUrl=F.concat(s("http://f/"), key)),
            _obj(__type=s("DataDownload"), encodingFormat=F.lit(None).cast("string"), contentUrl=F.lit(None).cast("string")),
        ),
    )
    return spread_table(spark, d, "documents").select(
        "doc_id", F.concat(s("http://p/"), key).alias("url"), script(F.to_json(body)).alias("html")
    )


@check(
    "graph_comments",
    "FN13",
    """
SELECT doc_id, concat_ws(';;', 'Keywords|' || lang || ', ' || source, CASE WHEN doc_id % 3 = 0 THEN 'License|CC0' END, 'Language|' || lang, 'Version|' || n_chars,
       'Conforms To|http://profile/1', 'Distribution|csv: http://f/' || doc_id) AS comments, md5(text) AS description_md5
FROM documents
""",
)
def graph_comments(spark, d):
    mapped = ga.map_graphs(jsonld.page_graphs(_doc_pages(spark, d)))
    return mapped.select(
        "doc_id",
        pairs_text(F.col("investigation.comments")).alias("comments"),
        F.md5("investigation.description").alias("description_md5"),
    )


@check(
    "graph_publications",
    "FN16 SO6 AG12",
    """
SELECT doc_id, 0 AS pos, CASE WHEN doc_id % 2 = 0 THEN source ELSE 'Untitled' END AS title, 'Solo' AS authors, '10.' || doc_id AS doi FROM documents
UNION ALL SELECT doc_id, 1, left(text, 200), NULL, NULL FROM documents WHERE text <> ''
""",
)
def graph_publications(spark, d):
    mapped = ga.map_graphs(jsonld.page_graphs(_doc_pages(spark, d)))
    rows = mapped.select("doc_id", F.posexplode("investigation.publications").alias("pos", "p"))
    return rows.select("doc_id", "pos", "p.title", "p.authors", "p.doi")


_HARVEST_SQL = f"""
WITH p AS (SELECT {HOST_SQL} AS host, page_id, regexp_replace(url, '[?#].*$', '') AS u,
                  row_number() OVER (PARTITION BY {HOST_SQL}, regexp_replace(url, '[?#].*$', '') ORDER BY page_id) AS rn FROM pages)
SELECT host AS rdi, nullif(count(*) FILTER (rn = 1 AND page_id % 7 > 0), 0) AS harvested,
       nullif(count(*) FILTER (rn = 1 AND page_id % 7 = 0), 0) AS failed, count(*) FILTER (rn > 1) AS skipped
FROM p GROUP BY host"""


@check("host_harvest", "FN41 WN1 SC8 SC9 FN27 AG1", _HARVEST_SQL)
def host_harvest(spark, d):
    """How many dataset pages per host were harvested, failed or skipped."""
    pid = F.col("page_id").cast("string")
    json = F.to_json(
        _obj(
            __context=s("https://schema.org"),
            __type=s("Dataset"),
            name=page_title(F.col("html")),
            identifier=F.concat(s("10.9/"), pid),
            creator=_obj(__type=s("Person"), name=F.concat(s("Curator "), pid)),
        )
    )
    pages = spread_table(spark, d, "pages").select(
        url_host(F.col("url")).alias("rdi"),
        F.col("page_id").alias("seq"),
        F.regexp_replace("url", "[?#].*$", "").alias("url"),
        F.when(F.col("page_id") % 7 > 0, F.concat("html", script(json))).otherwise(F.col("html")).alias("body"),
    )
    return harvest_counts(SOURCES["html_jsonld"](pages))
