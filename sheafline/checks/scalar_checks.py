"""Scalar functions: names, identifiers, URLs, dates, waits."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafline.checks.base import HOST_SQL, PAGE_TITLE_SQL, check, page_title, s, slug_sql, table
from sheafline.functions import terms, text, timefmt
from sheafline.functions.names import format_address, split_name, split_name_at_last_blank
from sheafline.plans.graph_arc import dataset_id
from sheafline.plans.record_arc import bbox_text, investigation_id
from sheafline.sources.iso import bounding_box, temporal_extent



@check(
    "slug_titles",
    "FN1",
    f"""
SELECT 'part' AS src, p_partkey AS id, {slug_sql('p_name')} AS slug FROM part
UNION ALL
SELECT 'page' AS src, page_id AS id, {slug_sql('t')} AS slug FROM (SELECT page_id, {PAGE_TITLE_SQL} AS t FROM pages)
""",
)
def slug_titles(spark, d):
    parts = table(spark, d, "part").select(s("part").alias("src"), F.col("p_partkey").alias("id"), F.col("p_name").alias("t"))
    pages = table(spark, d, "pages").select(s("page").alias("src"), F.col("page_id").alias("id"), page_title(F.col("html")).alias("t"))
    return parts.unionByName(pages).select("src", "id", text.slug(F.col("t")).alias("slug"))


@check("host_counts", "FN41", f"SELECT {HOST_SQL} AS host, count(*) AS n FROM pages GROUP BY 1")
def host_counts(spark, d):
    return table(spark, d, "pages").groupBy(text.url_host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))


@check(
    "base_urls",
    "FN40",
    f"""
SELECT page_id, CASE WHEN page_id % 7 = 0 THEN NULL ELSE regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) END AS base,
       CASE WHEN page_id % 7 = 0 THEN NULL
            ELSE regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || '/receive/obj_' || page_id END AS receive,
       CASE WHEN page_id % 7 = 0 THEN 'Invalid sitemap URL: /' || url END AS error
FROM pages
""",
)
def base_urls(spark, d):
    url = F.when(F.col("page_id") % 7 == 0, F.concat(s("/"), "url")).otherwise(F.col("url"))
    base = text.base_url(url)
    return table(spark, d, "pages").select(
        "page_id",
        base.alias("base"),
        text.receive_url(base, F.concat(s("obj_"), F.col("page_id").cast("string"))).alias("receive"),
        text.url_error(url, "sitemap URL").alias("error"),
    )


@check(
    "record_urls",
    "SC10",
    """
SELECT page_id,
       CASE page_id % 3 WHEN 0 THEN 'https://csw.example.org/csw?' WHEN 1 THEN 'https://csw.example.org/csw?'
            ELSE 'https://csw.example.org/csw?map=x&' END
       || 'service=CSW&version=2.0.2&request=GetRecordById&id='
       || replace(replace(replace(replace(replace(replace(url || ' ~*', ':', '%3A'), '/', '%2F'), '?', '%3F'), '=', '%3D'),
                  '&', '%26'), '#', '%23').replace('*', '%2A').replace(' ', '+')
       || '&outputSchema=http%3A%2F%2Fwww.isotc211.org%2F2005%2Fgmd&elementSetName=full' AS record_url
FROM pages
""",
)
def record_urls(spark, d):
    base = (
        F.when(F.col("page_id") % 3 == 0, "https://csw.example.org/csw")
        .when(F.col("page_id") % 3 == 1, "https://csw.example.org/csw?")
        .otherwise("https://csw.example.org/csw?map=x")
    )
    return table(spark, d, "pages").select(
        "page_id", text.record_url(base, F.concat("url", s(" ~*"))).alias("record_url")
    )


@check(
    "solr_page_urls",
    "FN39",
    """
SELECT page_id, regexp_extract(url, '^([^?#]*)', 1) || '?'
       || CASE WHEN regexp_extract(url, '\\?([^#]*)', 1) = '' THEN '' ELSE regexp_extract(url, '\\?([^#]*)', 1) || '&' END
       || 'start=' || (page_id * 50)
       || CASE WHEN regexp_extract(url, '#(.+)$', 1) = '' THEN '' ELSE '#' || regexp_extract(url, '#(.+)$', 1) END AS page_url
FROM pages
""",
)
def solr_page_urls(spark, d):
    with_start = F.regexp_replace("url", "ref=x", "start=9&ref=x")
    return table(spark, d, "pages").select(
        "page_id", text.solr_page_url(with_start, F.col("page_id") * 50).alias("page_url")
    )


@check(
    "bbox",
    "FN30",
    """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 9 IN (0, 1) THEN NULL
            ELSE '[' || cast(cast(o_custkey AS DOUBLE) AS VARCHAR) || ', ' || cast(o_totalprice AS VARCHAR) || ', 10.5, -0.25]'
       END AS bbox
FROM orders
""",
)
def bbox(spark, d):
    miny = (
        F.when(F.col("o_orderkey") % 9 == 0, F.lit(None).cast("string"))
        .when(F.col("o_orderkey") % 9 == 1, "north")
        .otherwise(F.format_string(" %.2f ", "o_totalprice"))
    )
    box = bounding_box(F.col("o_custkey").cast("string"), miny, s("10.5"), s("-.25"))
    return table(spark, d, "orders").select("o_orderkey", bbox_text(box).alias("bbox"))


@check(
    "temporal",
    "FN31",
    """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS start_text,
       CASE WHEN o_orderkey % 5 > 1 THEN o_orderpriority END AS end_text
FROM orders
""",
)
def temporal(spark, d):
    start = F.when(F.col("o_orderkey") % 5 > 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("")
    extent = temporal_extent(start, F.when(F.col("o_orderkey") % 5 != 1, F.col("o_orderpriority")))
    return table(spark, d, "orders").select(
        "o_orderkey", extent["start"].alias("start_text"), extent["end"].alias("end_text")
    )


_ROLE_CASE = """CASE role WHEN 'user' THEN 'OWNER' WHEN 'assistant' THEN 'pointOfContact' ELSE
 CASE turn % 3 WHEN 0 THEN 'author' WHEN 1 THEN 'reviewer' ELSE '' END END"""


@check(
    "role_terms",
    "JN1",
    f"""
WITH c AS (SELECT {_ROLE_CASE} AS code FROM conversations)
SELECT code, CASE code WHEN 'OWNER' THEN 'Owner' WHEN 'author' THEN 'Author' WHEN '' THEN NULL ELSE code END AS label,
       CASE code WHEN 'OWNER' THEN 'http://purl.obolibrary.org/obo/NCIT_C70904'
                 WHEN 'author' THEN 'http://purl.obolibrary.org/obo/NCIT_C70909' END AS tan,
       CASE WHEN code IN ('OWNER', 'author') THEN 'NCIT' END AS tsr, count(*) AS n
FROM c GROUP BY ALL
""",
)
def role_terms(spark, d):
    code = F.expr(_ROLE_CASE)
    rows = table(spark, d, "conversations").select(code.alias("code"))
    term = terms.role_term(F.col("code"))
    return rows.groupBy(
        "code", term["name"].alias("label"), term["tan"].alias("tan"), term["tsr"].alias("tsr")
    ).agg(F.count(F.lit(1)).alias("n"))


_TOPIC_CASE = """CASE c_mktsegment WHEN 'BUILDING' THEN 'structure' WHEN 'AUTOMOBILE' THEN 'transportation'
 WHEN 'HOUSEHOLD' THEN 'society' WHEN 'MACHINERY' THEN 'Farming' END"""


@check(
    "topic_terms",
    "JN2 SL3",
    f"""
SELECT c_custkey, CASE topic WHEN 'structure' THEN 'Structural Measurement' WHEN 'transportation' THEN 'Transportation Measurement'
        WHEN 'society' THEN 'Social Measurement' WHEN 'Farming' THEN 'Farming' ELSE 'Spatial Data Acquisition' END AS label,
       CASE topic WHEN 'structure' THEN 'http://purl.obolibrary.org/obo/NCIT_C19042'
        WHEN 'transportation' THEN 'http://purl.obolibrary.org/obo/NCIT_C19043'
        WHEN 'society' THEN 'http://purl.obolibrary.org/obo/NCIT_C19041' WHEN 'Farming' THEN NULL
        ELSE 'http://purl.obolibrary.org/obo/NCIT_C19026' END AS tan
FROM (SELECT c_custkey, {_TOPIC_CASE} AS topic FROM customer)
""",
)
def topic_terms(spark, d):
    topic = F.expr(_TOPIC_CASE)
    topics = F.when(topic.isNotNull(), F.array(topic, s("biota"))).otherwise(F.array().cast("array<string>"))
    term = terms.topic_term(topics)
    return table(spark, d, "customer").select("c_custkey", term["name"].alias("label"), term["tan"].alias("tan"))


_NAME_FORMS = """
CASE s_suppkey % 9
 WHEN 0 THEN f || ' ' || l
 WHEN 1 THEN l || ', ' || f || ' ' || m
 WHEN 2 THEN '  ' || l || ' '
 WHEN 3 THEN 'Dr. ' || f || ' ' || m || ' ' || l
 WHEN 4 THEN f || ' ' || m || '  ' || l
 WHEN 5 THEN f || ' ' || m || ' ' || l || ' Jr.'
 WHEN 6 THEN 'Prof. Dr. ' || f || ' von der ' || l
 WHEN 7 THEN f || ' ' || m || ' ' || l || ', PhD'
 ELSE '' END"""
_NAME_PARTS = "SELECT s_suppkey, 'F' || s_suppkey AS f, 'M' || s_nationkey AS m, s_name AS l FROM supplier"


@check(
    "name_split",
    "FN5",
    f"""
SELECT s_suppkey, CASE WHEN s_suppkey % 9 IN (0, 3, 4, 5, 6) THEN f WHEN s_suppkey % 9 IN (1, 7) THEN f || ' ' || m ELSE '' END AS first,
       CASE WHEN s_suppkey % 9 IN (0, 1, 2, 3, 5, 7) THEN l WHEN s_suppkey % 9 = 4 THEN m || ' ' || l
            WHEN s_suppkey % 9 = 6 THEN 'von der ' || l ELSE '' END AS last
FROM ({_NAME_PARTS})
""",
)
def name_split(spark, d):
    rows = table(spark, d, "supplier").select(
        "s_suppkey",
        F.concat(s("F"), F.col("s_suppkey").cast("string")).alias("f"),
        F.concat(s("M"), F.col("s_nationkey").cast("string")).alias("m"),
        F.col("s_name").alias("l"),
    )
    name = split_name(F.expr(_NAME_FORMS))
    return rows.select("s_suppkey", name.alias("n")).select("s_suppkey", "n.first", "n.last")


@check(
    "name_split_graph",
    "FN6",
    """
SELECT n_nationkey,
       CASE n_nationkey % 3 WHEN 0 THEN n_name WHEN 1 THEN r_name ELSE r_name || ' ' END AS given, n_name AS family
FROM nation JOIN region ON n_regionkey = r_regionkey
""",
)
def name_split_graph(spark, d):
    joined = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    name = (
        F.when(F.col("n_nationkey") % 3 == 0, F.col("n_name"))
        .when(F.col("n_nationkey") % 3 == 1, F.concat_ws(" ", "r_name", "n_name"))
        .otherwise(F.concat_ws("  ", "r_name", "n_name"))
    )
    split = split_name_at_last_blank(name)
    return joined.select("n_nationkey", split["given"].alias("given"), split["family"].alias("family"))


@check(
    "address_fold",
    "FN8",
    """
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE
       concat_ws(', ', CASE WHEN c_custkey % 2 = 0 THEN c_name END, n_name, r_name,
                 CASE WHEN c_custkey % 3 = 0 THEN c_custkey::VARCHAR END) END AS address
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""",
)
def address_fold(spark, d):
    joined = (
        table(spark, d, "customer")
        .join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    shown = F.col("c_custkey") % 7 != 0
    contact = F.struct(
        F.when(shown & (F.col("c_custkey") % 2 == 0), F.col("c_name")).otherwise("").alias("address"),
        F.when(shown, F.col("n_name")).alias("city"),
        F.when(shown, F.col("r_name")).otherwise("").alias("region"),
        F.when(shown & (F.col("c_custkey") % 3 == 0), F.col("c_custkey").cast("string")).alias("postcode"),
        s("").alias("country"),
    )
    return joined.select("c_custkey", format_address(contact).alias("address"))


@check(
    "investigation_ids",
    "FN2 FN3",
    f"""
WITH p AS (SELECT page_id, url, {PAGE_TITLE_SQL} AS title,
                  CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 'id-' || page_id WHEN 2 THEN 'a/b' || page_id ELSE url END AS ident
           FROM pages),
     q AS (SELECT *, CASE page_id % 4 WHEN 3 THEN '***' WHEN 2 THEN '' ELSE title END AS t FROM p),
     r AS (SELECT *, {slug_sql('t')} AS sl FROM q)
SELECT page_id,
       CASE WHEN ident LIKE '%/%' THEN CASE WHEN sl <> '' THEN sl ELSE regexp_extract(ident, '([^/]*)$', 1) END ELSE ident END AS record_id,
       CASE WHEN page_id % 5 = 0 THEN '10.5/' || page_id
            WHEN ident LIKE '%/%' THEN CASE WHEN sl <> '' THEN sl ELSE regexp_extract(ident, '([^/]*)$', 1) END ELSE ident END AS graph_id
FROM r
""",
)
def investigation_ids(spark, d):
    k = F.col("page_id") % 4
    rows = table(spark, d, "pages").select(
        "page_id",
        F.when(k.isin(0, 3), F.col("url"))
        .when(k == 1, F.concat(s("id-"), F.col("page_id").cast("string")))
        .otherwise(F.concat(s("a/b"), F.col("page_id").cast("string")))
        .alias("ident"),
        F.when(k == 3, "***").when(k == 2, "").otherwise(page_title(F.col("html"))).alias("t"),
    )
    doi = F.when(F.col("page_id") % 5 == 0, F.concat(s("10.5/"), F.col("page_id").cast("string")))
    return rows.select(
        "page_id",
        investigation_id(F.col("ident"), F.col("t")).alias("record_id"),
        dataset_id(doi, F.col("ident"), F.col("t")).alias("graph_id"),
    )


@check(
    "doi_extract",
    "FN4",
    """
SELECT page_id, CASE page_id % 5 WHEN 0 THEN '10.1/' || page_id WHEN 1 THEN '10.' || page_id WHEN 2 THEN '10.7/x' || page_id END AS doi
FROM pages
""",
)
def doi_extract(spark, d):
    k, pid = F.col("page_id") % 5, F.col("page_id").cast("string")
    identifier = F.when(k == 0, F.concat(s("10.1/"), pid)).otherwise("local")
    subject = (
        F.when(k == 1, F.concat(s("https://DOI.org/10."), pid, s("/lost?x#y")))
        .when(k == 2, F.concat(s("10.7/x"), pid))
        .otherwise(F.col("url"))
    )
    return table(spark, d, "pages").select("page_id", text.doi_from(identifier, subject).alias("doi"))


_STATUS = "CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 503 WHEN 'signup' THEN 404 WHEN 'purchase' THEN 429 END"


@check(
    "retry_class",
    "FN46 FN47",
    """
SELECT event_type, CASE event_type WHEN 'view' THEN 'ok' WHEN 'signup' THEN 'fatal' ELSE 'transient' END AS page_class,
       CASE event_type WHEN 'view' THEN 'ok' WHEN 'signup' THEN 'fatal' WHEN 'purchase' THEN 'fatal'
            WHEN 'error' THEN CASE event_id % 4 WHEN 3 THEN 'fatal' ELSE 'transient' END ELSE 'transient' END AS catalogue_class,
       count(*) AS n
FROM events GROUP BY ALL
""",
)
def retry_class(spark, d):
    error = F.when(
        F.col("event_type") == "error",
        F.element_at(F.array(s("network"), s("timeout"), s("xml_syntax"), s("value")), (F.col("event_id") % 4 + 1).cast("int")),
    )
    rows = table(spark, d, "events").select(
        "event_type",
        timefmt.retry_class(F.expr(_STATUS), error).alias("page_class"),
        timefmt.catalogue_retry_class(F.expr(_STATUS), error).alias("catalogue_class"),
    )
    return rows.groupBy("event_type", "page_class", "catalogue_class").agg(F.count(F.lit(1)).alias("n"))


@check(
    "backoff",
    "FN48 FN50",
    """
WITH e AS (SELECT event_id, 1 + event_id % 12 AS attempt, event_type, cast(value * 10 AS DOUBLE) AS wait FROM events),
     b AS (SELECT *, least(pow(2.0, attempt - 1), 600.0) AS delay FROM e)
SELECT event_id, delay,
       CASE WHEN event_type IN ('click', 'purchase') THEN least(greatest(delay, wait), 600.0) ELSE delay END AS effective,
       TRUE AS jitter_in_range
FROM b
""",
)
def backoff(spark, d):
    attempt = F.lit(1) + F.col("event_id") % 12
    plain = timefmt.backoff(attempt, jitter=False)
    jittered = timefmt.backoff(attempt, F.col("event_id"))
    rows = table(spark, d, "events").select("event_id", F.expr(_STATUS).alias("status"), "value", plain.alias("delay"), jittered.alias("j"))
    return rows.select(
        "event_id",
        "delay",
        timefmt.effective_delay(F.col("delay"), F.col("status"), F.col("value") * 10).alias("effective"),
        ((F.col("j") >= F.col("delay") * 0.9 - 1e-9) & (F.col("j") <= F.least(F.col("delay") * 1.1, F.lit(600.0)))).alias(
            "jitter_in_range"
        ),
    )


@check(
    "retry_after",
    "FN49",
    """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN cast(event_id AS DOUBLE)
       WHEN 1 THEN greatest(epoch_us(date_trunc('second', ts)) - epoch_us(TIMESTAMP '2024-01-15 00:00:00'), 0) / 1e6 END AS seconds
FROM events
""",
)
def retry_after(spark, d):
    k = F.col("event_id") % 4
    value = (
        F.when(k == 0, F.concat(s(" "), F.col("event_id").cast("string")))
        .when(k == 1, F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), s(" GMT")))
        .when(k == 2, "soon")
        .otherwise("")
    )
    return table(spark, d, "events").select(
        "event_id",
        timefmt.retry_after_seconds(value, F.lit("2024-01-15 00:00:00").cast("timestamp")).alias("seconds"),
    )


@check(
    "report_times",
    "FN42 FN43",
    """
SELECT event_id,
       'PT' || regexp_replace(regexp_replace(printf('%.6f', CASE WHEN event_id % 5 = 0 THEN 0.0 ELSE value END), '0+$', ''), '\\.$', '') || 'S' AS duration,
       CASE WHEN event_id % 3 = 0 OR date_trunc('second', ts) = ts THEN strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS stamp
FROM events
""",
)
def report_times(spark, d):
    events = table(spark, d, "events")
    seconds = F.when(F.col("event_id") % 5 == 0, 0.0).otherwise(F.col("value"))
    ts = F.when(F.col("event_id") % 3 == 0, F.date_trunc("second", "ts")).otherwise(F.col("ts"))
    return events.select(
        "event_id", timefmt.iso_duration(seconds).alias("duration"), timefmt.iso_timestamp(ts).alias("stamp")
    )
