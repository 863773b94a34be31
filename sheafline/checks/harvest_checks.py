"""The assembled harvests, against SQL over the same tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafline.checks.base import check, s, table
from sheafline.checks.graph_checks import _dataset_pages
from sheafline.checks.record_checks import _responses
from sheafline.operators.outcomes import finalize_counts, harvest_counts
from sheafline.operators.paging import expected_count_catalogue
from sheafline.operators.report import repo_jsonld, with_expected
from sheafline.operators.scan import arrival_ordinal
from sheafline.plans.harvest import harvest_catalogue, harvest_sitemap
from sheafline.plans.record_arc import record_outcomes
from sheafline.session import cut_lineage
from sheafline.sources.iso import page_header, read_iso

def _catalogue(spark, d, landed, limit=None):
    """The harvest with brief ids and a predicate over landed responses."""
    docs = table(spark, d, "documents")
    key = F.col("doc_id").cast("string")
    entry = lambda t: F.concat(s("<BriefRecord><identifier>"), t, s("</identifier></BriefRecord>"))
    whole = F.concat(
        s("<GetRecordsResponse><SearchResults>"), entry(F.concat(s("dc-"), key)), s("<BriefRecord><identifier/></BriefRecord>"),
        entry(F.col("source")), s("</SearchResults></GetRecordsResponse>"),
    )
    brief = docs.select(
        F.col("lang").alias("rdi"),
        F.col("doc_id").alias("batch"),
        F.when(F.col("doc_id") % 4 == 3, s("<GetRecordsResponse><SearchResults>")).otherwise(whole).alias("body"),
    )
    # The second record of a page has its source as title.
    out = harvest_catalogue(landed, brief, F.col("title") != "src3", limit)
    arc = F.when(F.col("source_url").contains("id=doc"), "doc").otherwise("b")
    error = F.when(F.col("record_id").startswith("owslib_random_"), "placeholder").otherwise(F.col("record_id"))
    return out.select(
        "rdi",
        F.shiftright("seq", 32).alias("batch"),
        "kind",
        F.when(F.col("kind") == "arc", arc).otherwise(error).alias("id"),
    )


#: Outcomes of the pages in k.
_OUTCOMES = """e AS (SELECT *, 1 AS pos, true AS nameless, NULL AS id, 'error' AS kind FROM k WHERE doc_id % 7 = 0
      UNION ALL SELECT *, 2, true, NULL, 'error' FROM k WHERE doc_id % 11 = 0
      UNION ALL SELECT *, 3, true, NULL, 'error' FROM k WHERE doc_id % 3 = 0
      UNION ALL SELECT *, 4, true, NULL, 'error' FROM k WHERE doc_id % 5 = 0
      UNION ALL SELECT *, 0, false, 'doc/' || doc_id, 'error' FROM k WHERE doc_id % 10 = 9),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, nameless ORDER BY pos) AS nth FROM e)
SELECT lang AS rdi, doc_id AS batch, 'error' AS kind,
       CASE WHEN NOT nameless THEN id WHEN doc_id % 4 = 3 OR nth > 2 THEN 'placeholder' WHEN nth = 1 THEN 'dc-' || doc_id ELSE source END AS id
FROM n
UNION ALL SELECT lang, doc_id, 'arc', 'doc' FROM k WHERE doc_id % 10 <> 9 AND doc_id % 4 <> 2
UNION ALL SELECT lang, doc_id, 'arc', 'b' FROM k WHERE doc_id % 3 > 0 AND source <> 'src3'
"""


def _announcing(landed, total):
    """The responses with another announced total."""
    stated = F.concat(s('<GetRecordsResponse><SearchResults numberOfRecordsMatched="'), total.cast("string"))
    return landed.withColumn("body", F.regexp_replace("body", s(r'^<GetRecordsResponse><SearchResults numberOfRecordsMatched="[^"]*'), stated))


@check(
    "harvest_catalogue_whole",
    "SC1 SC3 WN4 AG10 JN3 PF4",
    f"""
WITH k AS (SELECT doc_id, lang, source FROM documents),
{_OUTCOMES}""",
)
def harvest_catalogue_whole(spark, d):
    """Every page is read: the announced total is above the sum of rows, and no record limit stops before."""
    return _catalogue(spark, d, _announcing(_responses(spark, d), F.lit(10**9)))


@check(
    "harvest_catalogue",
    "SC1 SC3 WN4 AG10 JN3 JN4 PF4 PF5",
    f"""
WITH p AS (SELECT doc_id, lang, source, (doc_id % 10 <> 9)::INT + (doc_id % 3 > 0 AND source <> 'src3')::INT AS n_ok FROM documents),
k AS (SELECT * FROM p QUALIFY sum(n_ok) OVER (PARTITION BY lang ORDER BY doc_id) - n_ok < (SELECT count(*) // 4 FROM documents)
                          OR row_number() OVER (PARTITION BY lang ORDER BY doc_id) = 1),
{_OUTCOMES}""",
)
def harvest_catalogue_run(spark, d):
    """The record limit, a quarter of all pages, stops before the announced total."""
    limit = table(spark, d, "documents").count() // 4
    return _catalogue(spark, d, _announcing(_responses(spark, d), F.lit(10**9)), limit)


def _half_announced(spark, d):
    """The responses, announcing half of their repository's rows.

    The totals, a row a repository, are a table: Spark sees their size before it plans, and no body moves to the few
    tasks that the repositories hash to.
    """
    rows = F.lit(2) + sum((F.col("doc_id") % k == 0).cast("int") for k in (5, 7, 11))
    totals = cut_lineage(table(spark, d, "documents").groupBy(F.col("lang").alias("rdi")).agg(F.floor(F.sum(rows) / 2).alias("total")))
    return _announcing(_responses(spark, d).join(totals, "rdi"), F.col("total")).drop("total")


@check(
    "harvest_catalogue_cuts",
    "SC1 SC3 WN4 WN5 AG10 JN3 JN4 PF4 PF5",
    f"""
WITH p AS (SELECT doc_id, lang, source,
                  2 + (doc_id % 5 = 0)::INT + (doc_id % 7 = 0)::INT + (doc_id % 11 = 0)::INT AS n_rows,
                  (doc_id % 10 <> 9)::INT + (doc_id % 3 > 0 AND source <> 'src3')::INT AS n_ok FROM documents),
c AS (SELECT *, sum(n_rows) OVER (PARTITION BY lang ORDER BY doc_id) >= sum(n_rows) OVER (PARTITION BY lang) // 2 AS reached FROM p),
r AS (SELECT * FROM c QUALIFY coalesce(bool_or(reached) OVER (PARTITION BY lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) = false),
k AS (SELECT * FROM r QUALIFY sum(n_ok) OVER (PARTITION BY lang ORDER BY doc_id) - n_ok < (SELECT count(*) // 5 FROM documents)
                          OR row_number() OVER (PARTITION BY lang ORDER BY doc_id) = 1),
{_OUTCOMES}""",
)
def harvest_catalogue_cuts(spark, d):
    """Each repository announces half of its rows; the record limit is a fifth of all pages, so both stops grow."""
    return _catalogue(spark, d, _half_announced(spark, d), table(spark, d, "documents").count() // 5)


@check(
    "harvest_sitemap",
    "SC5 SC6 SC8 SC9 WN1 WN2 ST2 PF5",
    """
WITH p AS (SELECT page_id, 'http://p/' || page_id AS url, 'r' || (page_id % 3) AS rdi FROM pages)
SELECT rdi, url AS source_url, CASE WHEN page_id % 13 = 5 THEN 'error' WHEN page_id % 5 IN (0, 1, 4) THEN 'arc' ELSE 'error' END AS kind,
       page_id % 13 = 5 AS lost FROM p
UNION ALL SELECT rdi, url, 'skip', false FROM p WHERE page_id % 4 = 0
""",
)
def harvest_sitemap_run(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.concat(s("http://p/"), F.col("page_id").cast("string")).alias("url"))
    loc = F.concat(s("<url><loc> "), "url", s(" </loc></url>"))
    # One URL set per page; every fourth lists its page twice. The index of a repository links itself and indexes of
    # the sets of 10,000 page ids each.
    sets = pages.select(
        F.concat(s("http://set/"), F.col("page_id").cast("string")).alias("sitemap_url"),
        F.col("page_id").alias("batch"),
        F.concat(s("<urlset>"), loc, F.when(F.col("page_id") % 4 == 0, loc).otherwise(""), s("</urlset>")).alias("body"),
    )
    root = F.concat(s("http://root/"), (F.col("page_id") % 3).cast("string"))
    part = F.concat(s("http://index/"), (F.col("page_id") % 3).cast("string"), s("/"), F.floor(F.col("page_id") / 10_000).cast("string"))
    entry = lambda url: F.concat(s("<sitemap><loc>"), url, s("</loc></sitemap>"))
    index = lambda own: F.concat(s("<sitemapindex>"), own, F.array_join("l", ""), s("</sitemapindex>"))
    listed = F.collect_list(entry(F.concat(s("http://set/"), F.col("page_id").cast("string"))))
    parts = pages.groupBy(part.alias("sitemap_url")).agg(listed.alias("l"))
    parts = parts.select("sitemap_url", F.lit(0).cast("bigint").alias("batch"), index(s("")).alias("body"))
    tops = pages.select(root.alias("sitemap_url"), part.alias("part")).distinct()
    tops = tops.groupBy("sitemap_url").agg(F.collect_list(entry(F.col("part"))).alias("l"))
    tops = tops.select("sitemap_url", F.lit(0).cast("bigint").alias("batch"), index(entry(F.col("sitemap_url"))).alias("body"))
    indexes = tops.unionByName(parts)
    roots = pages.select(F.concat(s("r"), (F.col("page_id") % 3).cast("string")).alias("rdi"), root.alias("root")).distinct()
    landed = _dataset_pages(spark, d).select("url", F.col("html").alias("body"))
    landed = landed.where(F.regexp_extract("url", "([0-9]+)$", 1).cast("bigint") % 13 != 5)
    out = harvest_sitemap(roots, indexes.unionByName(sets), landed)
    lost = F.coalesce(F.col("message").startswith("No page was landed"), F.lit(False))
    return out.select("rdi", "source_url", "kind", lost.alias("lost"))


@check(
    "expected_report",
    "AG8 AG9 FN44 AG1 AG3",
    """
WITH n AS (SELECT lang AS rdi, count(*) FILTER (doc_id % 10 <> 9 AND doc_id % 4 <> 2) + count(*) FILTER (doc_id % 3 > 0) AS ok,
                  count(*) FILTER (doc_id % 10 = 9) + count(*) FILTER (doc_id % 3 = 0) + count(*) FILTER (doc_id % 5 = 0)
                  + count(*) FILTER (doc_id % 7 = 0) + count(*) FILTER (doc_id % 11 = 0) AS bad, max(n_chars) AS expected
           FROM documents GROUP BY 1)
SELECT rdi, '{"@type":"schema:EntryPoint","name":"' || rdi || '","identifier":"' || rdi || '","schema:duration":"PT1S","harvest:harvestedDatasets":'
       || ok || ',"harvest:harvestId":"h","harvest:expectedDatasets":' || expected || ',"harvest:skippedDatasets":0,"harvest:failedDatasets":'
       || bad || '}' AS json FROM n
""",
)
def expected_report(spark, d):
    landed = _responses(spark, d)
    parsed = read_iso(landed).withColumn("seq", arrival_ordinal(F.col("batch"), F.col("pos")))
    counts = harvest_counts(record_outcomes(parsed, F.col("base_url")))
    repos = landed.select("rdi").distinct().withColumn("harvest_started", F.lit(True))
    header = page_header(F.col("body")).cast("string").alias("matches_text")
    announced = expected_count_catalogue(landed.select("rdi", header))
    rows = with_expected(finalize_counts(repos, counts), announced)
    return rows.withColumns({"harvest_id": s("h"), "duration_seconds": F.lit(1.0)}).select("rdi", repo_jsonld().alias("json"))
