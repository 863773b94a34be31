"""Sitemaps, search pages, URL deduplication, robots rules, schedules and attempts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafline.checks.base import HOST_SQL, check, s, spread_table, table
from sheafline.operators.scan import arrival_ordinal
from sheafline.operators import fetchlog
from sheafline.operators.dedup import dedup_urls, duplicate_outcomes
from sheafline.operators.scan import blocked_row_number, ordinal_block
from sheafline.plans.registry import SITEMAPS
from sheafline.sources import sitemap, solr

_NS = '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'


def _xml(c):
    return F.replace(c, s("&"), s("&amp;"))


@check(
    "sitemap_urls",
    "SC4 SC6 UD2",
    """
SELECT 'sm-' || page_id AS sitemap_url, v.pos, CASE v.pos WHEN 0 THEN url ELSE url || '/x' END AS url, NULL AS message
FROM pages, (VALUES (0), (1)) v(pos) WHERE page_id % 5 < 3
UNION ALL
SELECT 'sm-' || page_id, NULL, NULL, CASE page_id % 5 WHEN 3 THEN 'Unsupported sitemap root element: feed' ELSE 'Sitemap is not well-formed XML' END
FROM pages WHERE page_id % 5 >= 3
""",
)
def sitemap_urls(spark, d):
    k = F.col("page_id") % 5
    loc = _xml(F.col("url"))
    good = F.concat(
        s('<?xml version="1.0"?><!-- map --> ' + _NS + "<url><loc>\n "), loc, s(" </loc></url><url><loc/></url><url><loc>"), loc, s("/x</loc></url></urlset>")
    )
    body = F.when(k < 3, good).when(k == 3, s('<a:feed xmlns:a="x"/>')).otherwise(s(_NS + "<url>"))
    docs = table(spark, d, "pages").select(
        F.concat(s("sm-"), F.col("page_id").cast("string")).alias("sitemap_url"), body.alias("body")
    )
    urls = SITEMAPS["xml"](docs).withColumn("message", F.lit(None).cast("string"))
    return urls.unionByName(sitemap.sitemap_errors(docs), allowMissingColumns=True)


_FAN = 16


def _tree(spark, d):
    """Page i is an index of pages 16i+1 .. 16i+16 where those exist, else a URL set; every index also names itself and the root."""
    pages = table(spark, d, "pages")
    size = pages.agg(F.count(F.lit(1)).alias("n")).scalar()
    child = F.transform(
        F.sequence(F.col("page_id") * _FAN + 1, F.least(F.col("page_id") * _FAN + _FAN, F.col("n") - 1)),
        lambda i: F.concat(s("<sitemap><loc>sm-"), i.cast("string"), s("</loc></sitemap>")),
    )
    index = F.concat(
        s("<sitemapindex><sitemap><loc>sm-0</loc></sitemap><sitemap><loc>sm-"),
        F.col("page_id").cast("string"),
        s("</loc></sitemap>"),
        F.array_join(child, ""),
        s("</sitemapindex>"),
    )
    leaf = F.concat(s(_NS + "<url><loc>"), _xml(F.col("url")), s("</loc></url></urlset>"))
    return pages.withColumn("n", size).select(
        F.concat(s("sm-"), F.col("page_id").cast("string")).alias("sitemap_url"),
        F.when(F.col("page_id") * _FAN + 1 < F.col("n"), index).otherwise(leaf).alias("body"),
    )


@check(
    "sitemap_tree",
    "SC5",
    f"""
WITH RECURSIVE n AS (SELECT count(*) AS n FROM pages),
r AS (SELECT 0::BIGINT AS id, 0 AS depth UNION ALL
      SELECT page_id, depth + 1 FROM r, n, pages WHERE page_id BETWEEN r.id * {_FAN} + 1 AND r.id * {_FAN} + {_FAN} AND r.id * {_FAN} + 1 < n.n)
SELECT 'sm-0' AS root, 'sm-' || id AS sitemap_url, depth, 0 AS pos, url FROM r JOIN pages ON page_id = id, n WHERE id * {_FAN} + 1 >= n.n
""",
)
def sitemap_tree(spark, d):
    docs = _tree(spark, d)
    roots = spark.range(1).select(s("sm-0").alias("root"))
    return sitemap.discover_sitemap_urls(roots, docs)


_HITS = """
w AS (SELECT lang, doc_id, string_split(text, ' ') AS w FROM documents),
h AS (SELECT lang, doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM w),
g AS (SELECT lang, word, doc_id * 4294967296 + pos AS seq FROM h WHERE NOT regexp_matches(word, '^\\s*$'))"""


def _search_pages(spark, d):
    """Every document is one search page whose hits are its words; blanks, numbers and odd entries are mixed in."""
    hits = F.transform(F.split("text", " "), lambda w: F.to_json(F.struct(w.alias("id"))))
    body = F.concat(
        s('{"response":{"numFound":'),
        F.size(hits).cast("string"),
        s(',"start":'),
        F.col("doc_id").cast("string"),
        s(',"docs":['),
        F.array_join(F.concat(hits, F.array(s('{"id":5}'), s('"x"'), s("{}"))), ","),
        s("]}}"),
    )
    return spread_table(spark, d, "documents").select(
        F.col("lang").alias("rdi"),
        F.col("doc_id").alias("batch"),
        F.concat(s("https://"), "lang", s(".example.org:8443/solr?q=*")).alias("url"),
        body.alias("body"),
    )


@check(
    "solr_docs",
    "SC7 WN2",
    f"""
WITH {_HITS} SELECT lang AS rdi, min(seq) AS seq, word AS object_id, 'https://' || lang || '.example.org:8443/receive/' || word AS url FROM g GROUP BY lang, word
""",
)
def solr_docs(spark, d):
    hits = SITEMAPS["mycore_solr"](_search_pages(spark, d))
    return hits.select("rdi", arrival_ordinal(F.col("batch"), F.col("pos")).alias("seq"), "object_id", "url")


@check(
    "solr_envelope",
    "SC7",
    """
SELECT doc_id AS batch, CASE WHEN doc_id % 6 < 2 THEN n_chars END AS num_found,
       CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'Missing Solr response envelope: response' WHEN 3 THEN 'Missing or invalid response.numFound'
            WHEN 4 THEN 'Missing or invalid response.start' ELSE 'Missing expected response.docs array' END AS error
FROM documents
""",
)
def solr_envelope(spark, d):
    k, n = F.col("doc_id") % 6, F.col("n_chars").cast("string")
    docs = F.concat(s('"docs":['), F.to_json(F.struct("text")), s("]"))
    body = (
        F.when(k < 2, F.concat(s('{"response":{"numFound":'), n, s(',"start":0,'), docs, s("}}")))
        .when(k == 2, F.concat(s('{"response":[],"text":'), F.to_json(F.struct("text")), s("}")))
        .when(k == 3, F.concat(s('{"response":{"numFound":"'), n, s('","start":0,'), docs, s("}}")))
        .when(k == 4, F.concat(s('{"response":{"numFound":1,"start":1.5,'), docs, s("}}")))
        .otherwise(s('{"response":{"numFound":1,"start":0,"docs":{}}}'))
    )
    pages = table(spark, d, "documents").select(F.col("doc_id").alias("batch"), body.alias("body"))
    read = solr.read_solr(pages)
    return read.select("batch", F.when(F.col("error").isNull(), F.col("num_found")).alias("num_found"), "error")


def _visits(spark, d):
    """Event stream as discovered URLs: few distinct ones, so most rows are repeats."""
    return table(spark, d, "events").select(
        F.col("event_type").alias("rdi"),
        F.col("event_id").alias("seq"),
        F.concat(s("http://u/"), F.col("user_id").cast("string")).alias("url"),
    )


_VISITS = "SELECT event_type AS rdi, event_id AS seq, 'http://u/' || user_id AS url FROM events"


@check(
    "url_dedup",
    "WN1",
    f"SELECT *, row_number() OVER (PARTITION BY rdi, url ORDER BY seq) > 1 AS is_duplicate FROM ({_VISITS})",
)
def url_dedup(spark, d):
    return dedup_urls(_visits(spark, d), mode="flag")


@check(
    "page_url_dedup",
    "WN1",
    """
WITH p AS (SELECT 'web' AS rdi, page_id * 2 AS seq, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS url FROM pages
           UNION ALL SELECT 'web', page_id * 2 + 1, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') FROM pages WHERE page_id % 3 = 0),
q AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS rn FROM p)
SELECT rdi, seq, 'skip' AS kind, url AS source_url, 'Duplicate sitemap entry skipped: ' || url AS message FROM q WHERE rn > 1
""",
)
def page_url_dedup(spark, d):
    clean = F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "/+$", "")
    pages = table(spark, d, "pages").select(s("web").alias("rdi"), (F.col("page_id") * 2).alias("seq"), clean.alias("url"))
    repeats = pages.filter("seq % 6 = 0").withColumn("seq", F.col("seq") + 1)
    return duplicate_outcomes(dedup_urls(pages.unionByName(repeats))).drop("arc_json", "record_id")


# --- fetch policy -----------------------------------------------------------------------------


def _rules(spark, d):
    """Robots rules of every host but the mobile ones; blogs have a group of their own for the product."""
    from sheafline.functions.text import url_host

    def rule(pos, agent, allow, path, delay=None):
        return F.struct(
            F.lit(pos).alias("pos"), s(agent).alias("agent"), F.lit(allow).alias("allow"), F.lit(path).cast("string").alias("path"),
            F.lit(delay).cast("double").alias("crawl_delay"),
        )

    common = F.array(
        rule(0, "*", False, "/en/1"), rule(1, "*", True, "/en/"), rule(2, "*", False, "/en"), rule(3, "*", False, ""),
        rule(4, "*", True, None, 0.25), rule(5, "otherbot", False, "/"),
    )
    blog = F.concat(common, F.array(rule(10, "HarvestBot", False, "/"), rule(11, "HarvestBot", True, None, 3.0)))
    hosts = table(spark, d, "pages").select(url_host(F.col("url")).alias("host")).distinct()
    return hosts.filter(~F.col("host").startswith("m.")).select(
        "host", F.inline(F.when(F.col("host").startswith("blog."), blog).otherwise(common))
    )


@check(
    "robots_allowed",
    "JN11",
    f"""
WITH t AS (SELECT page_id, {HOST_SQL} AS host, regexp_replace(regexp_replace(url, '^[a-z]+://[^/?#]+', ''), '#.*$', '') AS path FROM pages)
SELECT page_id, CASE WHEN host LIKE 'm.%' THEN TRUE WHEN host LIKE 'blog.%' THEN FALSE WHEN path LIKE '/en/1%' THEN FALSE
       WHEN path LIKE '/en/%' THEN TRUE WHEN path LIKE '/en%' THEN FALSE ELSE TRUE END AS allowed, TRUE AS ignored
FROM t
""",
)
def robots_allowed(spark, d):
    urls = table(spark, d, "pages").select("page_id", "url")
    rules = _rules(spark, d)
    out = fetchlog.robots_allowed(urls, rules, "HarvestBot/2.0")
    ignored = fetchlog.robots_allowed(out.withColumnRenamed("allowed", "a"), rules, "HarvestBot/2.0", respect=False)
    return ignored.select("page_id", F.col("a").alias("allowed"), F.col("allowed").alias("ignored"))


@check(
    "robots_files",
    "JN11 JN12",
    f"""
WITH h AS (SELECT DISTINCT {HOST_SQL} AS host FROM pages)
SELECT host, 0 AS entry, 0 AS pos, '*' AS agent, FALSE AS allow, '/en/1' AS path, NULL::DOUBLE AS crawl_delay FROM h
UNION ALL SELECT host, 0, 1, '*', TRUE, '/en', NULL FROM h
UNION ALL SELECT host, 0, 2, '*', FALSE, NULL, len(host) FROM h
UNION ALL SELECT host, 1, 3, host, FALSE, '', NULL FROM h
UNION ALL SELECT host, 1, 4, 'bot', FALSE, '', NULL FROM h
""",
)
def robots_files(spark, d):
    from sheafline.functions.text import url_host
    from sheafline.sources.robots import read_robots

    hosts = table(spark, d, "pages").select(url_host(F.col("url")).alias("host")).distinct()
    body = F.concat(
        s("# rules\nUser-agent: *\nDisallow: /en/1 # part\n  \nAllow: /en\nCrawl-delay: "),
        F.length("host").cast("string"),
        s("\nSitemap: http://x/\n\nDisallow: /lost\nUser-agent: "),
        "host",
        s("\nUser-agent: bot\nDisallow:\n"),
    )
    return read_robots(hosts.select("host", body.alias("body")))


@check(
    "host_delay",
    "JN12",
    f"""
SELECT DISTINCT host, CASE WHEN host LIKE 'm.%' THEN 0.5 WHEN host LIKE 'blog.%' THEN 3.0 ELSE 0.5 END::DOUBLE AS delay,
       CASE WHEN host LIKE 'm.%' THEN 0.0 WHEN host LIKE 'blog.%' THEN 3.0 ELSE 0.25 END::DOUBLE AS unlimited
FROM (SELECT {HOST_SQL} AS host FROM pages)
""",
)
def host_delay(spark, d):
    from sheafline.functions.text import url_host

    hosts = table(spark, d, "pages").select(url_host(F.col("url")).alias("host")).distinct()
    rules = _rules(spark, d)
    limited = fetchlog.host_delay(hosts, rules, "HarvestBot/2.0", 2.0)
    free = fetchlog.host_delay(hosts, rules, "HarvestBot/2.0", None).withColumnRenamed("delay", "unlimited")
    return limited.join(free, "host")


@check(
    "polite_schedule",
    "WN6",
    """
WITH r AS (SELECT user_id, event_id, epoch_us(ts) // 600000000 * 600000000 AS arrival, CASE WHEN user_id % 2 = 0 THEN 500000 ELSE 900000000 END AS delay FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY arrival, event_id) - 1 AS k FROM r)
SELECT event_id, max(arrival - k * delay) OVER (PARTITION BY user_id ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) + k * delay AS send_at FROM n
""",
)
def polite_schedule(spark, d):
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    requests = table(spark, d, "events").select(
        F.col("user_id").alias("host"),
        F.col("event_id").alias("id"),
        (F.floor(micros / 600_000_000) * 600_000_000).cast("bigint").alias("arrival"),
        F.when(F.col("user_id") % 2 == 0, F.lit(500_000)).otherwise(F.lit(900_000_000)).cast("bigint").alias("delay"),
    )
    return fetchlog.polite_schedule(requests).select("id", "send_at").withColumnRenamed("id", "event_id")


_LOG_STATUS = "CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 503 WHEN 'signup' THEN 404 WHEN 'purchase' THEN 429 END"


def _log(spark, d):
    """Events as logged attempts, numbered per URL."""
    rows = table(spark, d, "events").select(
        "event_id",
        F.concat(s("u"), F.col("user_id").cast("string"), s("-"), (F.col("event_id") % 3).cast("string")).alias("url"),
        F.when(F.col("user_id") % 3 > 0, F.expr(_LOG_STATUS)).otherwise(F.when(F.col("event_type") != "error", 503)).alias("status"),
        F.when(F.col("event_type") == "error", "timeout").alias("error"),
        F.when(F.col("event_type").isin("click", "purchase"), F.col("value").cast("int").cast("string")).alias("retry_after"),
    )
    return blocked_row_number(rows, ["url"], [F.col("event_id")], ordinal_block(F.col("event_id"), 300), "attempt")


_LOG_SQL = f"""
l AS (SELECT 'u' || user_id || '-' || (event_id % 3) AS url, event_id, event_type,
             CASE WHEN user_id % 3 > 0 THEN {_LOG_STATUS} WHEN event_type <> 'error' THEN 503 END AS status,
             CASE event_type WHEN 'error' THEN 'timeout' END AS error,
             CASE WHEN event_type IN ('click', 'purchase') THEN trunc(value)::INT::VARCHAR END AS retry_after,
             row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY event_id) AS attempt FROM events),
c AS (SELECT *, CASE WHEN error IS NOT NULL OR status IS NULL OR status = 429 OR status >= 500 THEN 'transient' WHEN status >= 400 THEN 'fatal' ELSE 'ok' END AS class
      FROM l WHERE attempt <= 6)"""


@check(
    "final_attempt",
    "AG15",
    f"""
WITH {_LOG_SQL}, z AS (SELECT url, coalesce(min(attempt) FILTER (class <> 'transient'), max(attempt)) AS attempts FROM c GROUP BY url)
SELECT url, status, error, CASE class WHEN 'transient' THEN 'failed' ELSE class END AS outcome, attempts
FROM z JOIN c USING (url) WHERE attempt = attempts
""",
)
def final_attempt(spark, d):
    return fetchlog.final_attempt(_log(spark, d))


@check(
    "last_response",
    "FN50",
    f"""
WITH {_LOG_SQL}
SELECT event_id, last_value(status IGNORE NULLS) OVER w AS seen_status,
       last_value(CASE WHEN status IS NOT NULL THEN coalesce(retry_after, '') END IGNORE NULLS) OVER w AS seen_retry_after
FROM l WINDOW w AS (PARTITION BY url ORDER BY attempt ROWS UNBOUNDED PRECEDING)
""",
)
def last_response(spark, d):
    seen = fetchlog.last_response(_log(spark, d))
    return seen.select(
        "event_id",
        "seen_status",
        F.when(F.col("seen_status").isNotNull(), F.coalesce("seen_retry_after", s(""))).alias("seen_retry_after"),
    )
