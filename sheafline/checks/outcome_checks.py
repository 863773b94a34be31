"""Outcomes, counters, reports, paging, catalogue predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafline.checks.base import check, s, spread_table, table
from sheafline.operators import catalog, fallback, outcomes, paging, report
from sheafline.plans.registry import Repository, repository_rows, run_repositories, run_sources
from sheafline.session import scratch_path

_KIND = "CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'skip' ELSE 'arc' END"
_URL = "'http://h' || (event_id % 3) || '/' || (event_id % 40)"


def _outcomes(spark, d):
    """Events as outcomes: user -> repository, id -> arrival, type -> kind."""
    arc = F.concat(
        s('{"@graph":[{"@id":"x"},{"@id":"./","identifier":"arc-'), (F.col("event_id") % 40).cast("string"), s('"}]}')
    )
    kind = F.expr(_KIND)
    url = F.expr(_URL)
    return table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("rdi"),
        F.col("event_id").alias("seq"),
        kind.alias("kind"),
        F.when(kind == "arc", arc).alias("arc_json"),
        F.when((kind == "error") & (F.col("event_id") % 2 == 0), F.concat(s("rec-"), F.col("event_id").cast("string"))).alias("record_id"),
        F.when(F.col("event_id") % 5 > 0, url).alias("source_url"),
        F.when(kind == "error", F.concat(s("failed "), F.col("props"))).alias("message"),
    )


_OUT = f"""
o AS (SELECT user_id::VARCHAR AS rdi, event_id AS seq, {_KIND} AS kind,
             CASE WHEN {_KIND} = 'arc' THEN 'arc-' || (event_id % 40) END AS arc_id,
             CASE WHEN {_KIND} = 'error' AND event_id % 2 = 0 THEN 'rec-' || event_id END AS record_id,
             CASE WHEN event_id % 5 > 0 THEN {_URL} END AS url, CASE WHEN {_KIND} = 'error' THEN 'failed ' || props END AS message
      FROM events)"""


def _client_errors(spark, d):
    """Purchases as upload errors; a third name no known object."""
    e = table(spark, d, "events").filter("event_type = 'purchase'")
    return e.select(
        F.col("user_id").cast("string").alias("rdi"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_id") % 2 == 0, "DUPLICATE").otherwise("INVALID").alias("error_type"),
        F.when(F.col("event_id") % 3 > 0, F.concat(s("arc-"), (F.col("event_id") % 40).cast("string"))).alias("arc_id"),
        F.concat(s("upload "), F.col("props")).alias("message"),
    )


_ERR = """
e AS (SELECT user_id::VARCHAR AS rdi, event_id AS seq, CASE WHEN event_id % 2 = 0 THEN 'DUPLICATE' ELSE 'INVALID' END AS error_type,
             CASE WHEN event_id % 3 > 0 THEN 'arc-' || (event_id % 40) END AS arc_id, 'upload ' || props AS message
      FROM events WHERE event_type = 'purchase')"""

_COUNTS = """
c AS (SELECT rdi, nullif(count(*) FILTER (kind = 'arc'), 0) AS harvested, nullif(count(*) FILTER (kind = 'error'), 0) AS failed,
             count(*) FILTER (kind = 'skip') AS skipped FROM o GROUP BY rdi)"""

_ADJUSTED = """
x AS (SELECT rdi, count(*) FILTER (error_type = 'DUPLICATE') AS dup, count(*) AS n FROM e GROUP BY rdi),
a AS (SELECT c.rdi, CASE WHEN harvested IS NOT NULL THEN greatest(harvested - coalesce(dup, 0), 0) END AS harvested,
             CASE WHEN n IS NULL THEN failed ELSE coalesce(failed, 0) + n END AS failed, skipped
      FROM c LEFT JOIN x USING (rdi))"""


@check(
    "outcome_counts",
    "AG1 PF5",
    f"WITH {_OUT}, {_COUNTS} SELECT * FROM c",
)
def outcome_counts(spark, d):
    return outcomes.harvest_counts(_outcomes(spark, d))


def _repos(spark, d):
    """Every second user started; customers give the configured list."""
    users = table(spark, d, "events").select(F.col("user_id")).distinct()
    return users.select(
        F.col("user_id").cast("string").alias("rdi"),
        F.col("user_id").alias("repo_no"),
        (F.col("user_id") % 4 != 1).alias("harvest_started"),
    )


@check(
    "counts_final",
    "AG2 AG3",
    f"""
WITH {_OUT}, {_ERR}, {_COUNTS}, {_ADJUSTED}
SELECT a.rdi, rdi::BIGINT % 4 <> 1 AS harvest_started, CASE WHEN rdi::BIGINT % 4 <> 1 THEN coalesce(harvested, 0) END AS harvested,
       CASE WHEN rdi::BIGINT % 4 <> 1 THEN coalesce(failed, 0) END AS failed, skipped FROM a
""",
)
def counts_final(spark, d):
    counts = outcomes.apply_client_errors(outcomes.harvest_counts(_outcomes(spark, d)), _client_errors(spark, d))
    return outcomes.finalize_counts(_repos(spark, d).drop("repo_no"), counts)


@check(
    "arc_url_list",
    "AG4 FN38",
    f"WITH {_OUT} SELECT rdi, arc_id, url, min(seq) AS first_seq FROM o WHERE kind = 'arc' AND url IS NOT NULL GROUP BY ALL",
)
def arc_url_list(spark, d):
    return outcomes.arc_urls(_outcomes(spark, d))


_ENRICHED = """
u AS (SELECT rdi, arc_id, url, min(seq) AS first_seq FROM o WHERE kind = 'arc' AND url IS NOT NULL GROUP BY ALL),
l AS (SELECT rdi, arc_id, count(*) AS n FROM u GROUP BY ALL),
m AS (SELECT e.rdi, e.seq, e.error_type, e.arc_id,
             message || CASE WHEN n IS NULL THEN '' WHEN n = 1 THEN ' — source URL:' ELSE ' — source URLs:' END AS message,
             coalesce(n, 0) AS n_urls
      FROM e LEFT JOIN l ON e.rdi = l.rdi AND e.arc_id = l.arc_id),
eu AS (SELECT e.rdi, e.seq, row_number() OVER (PARTITION BY e.rdi, e.seq ORDER BY first_seq, url) AS rn, url
       FROM e JOIN u ON e.rdi = u.rdi AND e.arc_id = u.arc_id)"""


@check("client_errors", "JN8", f"WITH {_OUT}, {_ERR}, {_ENRICHED} SELECT * FROM m")
def client_errors(spark, d):
    return outcomes.enrich_client_errors(_client_errors(spark, d), outcomes.arc_urls(_outcomes(spark, d)))


@check("client_error_urls", "JN8", f"WITH {_OUT}, {_ERR}, {_ENRICHED} SELECT * FROM eu")
def client_error_urls(spark, d):
    return outcomes.error_urls(_client_errors(spark, d), outcomes.arc_urls(_outcomes(spark, d)))


_FAILED = """
f AS (SELECT rdi, 0 AS section, seq, message || CASE WHEN record_id IS NOT NULL THEN ' (record_id=' || record_id || ')' ELSE '' END AS message,
             record_id, CASE WHEN record_id IS NOT NULL THEN url END AS url, 0::BIGINT AS n_urls FROM o WHERE kind = 'error'
      UNION ALL SELECT rdi, 1, seq, message, arc_id, NULL, n_urls FROM m)"""


def _failed(spark, d):
    out = _outcomes(spark, d)
    return outcomes.failed_records(out, outcomes.enrich_client_errors(_client_errors(spark, d), outcomes.arc_urls(out)))


@check("failed_record_list", "AG5", f"WITH {_OUT}, {_ERR}, {_ENRICHED}, {_FAILED} SELECT * FROM f")
def failed_record_list(spark, d):
    return _failed(spark, d)


def _report_rows(spark, d):
    counts = outcomes.apply_client_errors(outcomes.harvest_counts(_outcomes(spark, d)), _client_errors(spark, d))
    final = outcomes.finalize_counts(_repos(spark, d), counts)
    k = F.col("repo_no")
    return final.select(
        "*",
        F.when(k % 3 > 0, F.concat(s("h-"), "rdi")).alias("harvest_id"),
        (k * 1.5).alias("duration_seconds"),
        F.when(k % 2 == 0, k * 10).alias("expected"),
    )


_ROW_JSON = """
'{"@type":"schema:EntryPoint","name":"' || rdi || '","identifier":"' || rdi || '","schema:duration":"PT'
|| regexp_replace(regexp_replace(printf('%.6f', rdi::BIGINT * 1.5), '0+$', ''), '\\.$', '') || 'S"'
|| CASE WHEN started THEN ',"harvest:harvestedDatasets":' || coalesce(harvested, 0) ELSE '' END
|| ',"harvest:harvestId":' || CASE WHEN rdi::BIGINT % 3 > 0 THEN '"h-' || rdi || '"' ELSE 'null' END
|| CASE WHEN rdi::BIGINT % 2 = 0 THEN ',"harvest:expectedDatasets":' || (rdi::BIGINT * 10) ELSE '' END
|| ',"harvest:skippedDatasets":' || skipped
|| CASE WHEN started THEN ',"harvest:failedDatasets":' || coalesce(failed, 0) ELSE '' END"""


@check(
    "repo_report",
    "FN44",
    f"""
WITH {_OUT}, {_ERR}, {_COUNTS}, {_ADJUSTED}, r AS (SELECT *, rdi::BIGINT % 4 <> 1 AS started FROM a)
SELECT rdi, {_ROW_JSON} || '}}' AS json FROM r
""",
)
def repo_report(spark, d):
    return _report_rows(spark, d).select("rdi", report.repo_jsonld().alias("json"))


@check(
    "run_report",
    "AG7 FN45",
    f"""
WITH {_OUT}, {_ERR}, {_COUNTS}, {_ADJUSTED}, {_ENRICHED}, {_FAILED},
r AS (SELECT a.*, rdi::BIGINT % 4 <> 1 AS started, (SELECT max(rdi::BIGINT) FROM a) = rdi::BIGINT AS last,
             rdi IN (SELECT rdi FROM f) AS has FROM a),
t AS (SELECT min(ts) AS t0, max(ts) AS t1 FROM events),
g AS (SELECT *, row_number() OVER (PARTITION BY rdi ORDER BY section, seq) = 1 AS first FROM f)
SELECT -1::BIGINT AS repo_no, -1 AS section, 0::BIGINT AS seq, 0::BIGINT AS part,
  '{{"@context":{{"@vocab":"https://schema.org/","schema":"https://schema.org/","harvest":"https://example.org/harvest/"}},"@type":"schema:Action","name":"Harvest Run","schema:startTime":"'
  || strftime(t0, '%Y-%m-%dT%H:%M:%S.%fZ') || '","schema:endTime":"' || strftime(t1, '%Y-%m-%dT%H:%M:%S.%fZ') || '","harvest:harvestDurationSeconds":' || 'S,"schema:result":[' AS line FROM t
UNION ALL
SELECT rdi::BIGINT, -1, 0, 0, {_ROW_JSON} || CASE WHEN has THEN ',"harvest:failedRecords":[' ELSE '}}' || CASE WHEN last THEN '' ELSE ',' END END FROM r
UNION ALL
SELECT rdi::BIGINT, 9, 0, 0, ']}}' || CASE WHEN last THEN '' ELSE ',' END FROM r WHERE has
UNION ALL
SELECT rdi::BIGINT, section, seq, 0, CASE WHEN first THEN '' ELSE ',' END || '{{"harvest:message":"' || replace(message, '"', '\\"')
  || CASE WHEN n_urls > 0 THEN '' ELSE '"' || CASE WHEN record_id IS NOT NULL THEN ',"harvest:recordId":"' || record_id || '"' ELSE '' END
  || CASE WHEN url IS NOT NULL THEN ',"harvest:url":"' || url || '"' ELSE '' END || '}}' END FROM g
UNION ALL
SELECT m.rdi::BIGINT, 1, m.seq, rn, url || CASE WHEN rn < n_urls THEN ',' ELSE '","harvest:recordId":"' || arc_id || '"}}' END
FROM eu JOIN m ON m.rdi = eu.rdi AND m.seq = eu.seq
UNION ALL SELECT 4611686018427387904, 9, 0, 0, ']}}'
""",
)
def run_report(spark, d):
    run = table(spark, d, "events").agg(F.min("ts").alias("start_time"), F.max("ts").alias("end_time"))
    urls = outcomes.error_urls(_client_errors(spark, d), outcomes.arc_urls(_outcomes(spark, d)))
    lines = report.run_lines(run, _report_rows(spark, d), _failed(spark, d), urls=urls)
    # The run length is a division of microseconds; its text is left out of the comparison.
    return lines.withColumn("line", F.regexp_replace("line", 'DurationSeconds":[0-9.E]+,', 'DurationSeconds":S,'))


@check(
    "run_failed",
    "AG6",
    "SELECT c.k, c.n > 0 AND c.n = c.missing AS all_failed FROM (SELECT user_id % 2 AS k, count(DISTINCT user_id) AS n, "
    "count(DISTINCT user_id) FILTER (user_id % 2 = 0) AS missing FROM events GROUP BY 1) c "
    "UNION ALL SELECT 2, FALSE",
)
def run_failed(spark, d):
    repos = _repos(spark, d).withColumn("harvest_id", F.when(F.col("repo_no") % 2 == 1, "x"))
    even = report.all_failed(repos.filter("repo_no % 2 = 0")).withColumn("k", F.lit(0).cast("bigint"))
    odd = report.all_failed(repos.filter("repo_no % 2 = 1")).withColumn("k", F.lit(1).cast("bigint"))
    none = report.all_failed(repos.filter("repo_no < 0")).withColumn("k", F.lit(2).cast("bigint"))
    return even.unionByName(odd).unionByName(none)


@check(
    "arc_identifier",
    "FN38",
    """
SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN source WHEN 1 THEN lang WHEN 2 THEN doc_id::VARCHAR END AS arc_id FROM documents
""",
)
def arc_identifier(spark, d):
    k = F.col("doc_id") % 8
    # The whole text rides along in a neighbouring entity.
    head = F.concat(s('{"@graph":["x",{"@id":"a","identifier":"no"},'), F.to_json(F.struct("text")), s(","))
    doc = (
        F.when(k == 0, F.concat(head, s('{"@id":"./","identifier":"'), "source", s('"}]}')))
        .when(k == 1, F.concat(head, s('{"@id":"./","identifier":["'), "lang", s('","z"]}]}')))
        .when(k == 2, F.concat(head, s('{"@id":"./","identifier":'), F.col("doc_id").cast("string"), s("}]}")))
        .when(k == 3, F.concat(head, s('{"@id":"./","identifier":[]}]}')))
        .when(k == 4, F.concat(head, s('{"@id":"./","identifier":""}]}')))
        .when(k == 5, s('{"@graph":{"@id":"./","identifier":"x"}}'))
        .when(k == 6, s("not json"))
        .otherwise(F.concat(head, s('{"@id":"b"}]}')))
    )
    return table(spark, d, "documents").select("doc_id", outcomes.arc_identifier(doc).alias("arc_id"))


# --- paging -----------------------------------------------------------------------------------


def _pages(spark, d):
    """Events in pages of 50 per event type; errors are failed records."""
    rows = table(spark, d, "events").select(
        F.col("event_type").alias("rdi"),
        F.floor(F.col("event_id") / 50).alias("batch"),
        (F.col("value") > 2).alias("ok"),
    )
    return paging.batch_counts(rows)


_PAGES_SQL = """
p AS (SELECT event_type AS rdi, event_id // 50 AS batch, count(*) FILTER (value > 2) AS n_ok, count(*) AS n_rows FROM events GROUP BY ALL)"""


@check("page_counts", "AG10", f"WITH {_PAGES_SQL} SELECT * FROM p")
def page_counts(spark, d):
    return _pages(spark, d)


@check(
    "page_cut",
    "WN4",
    f"""
WITH {_PAGES_SQL}, q AS (SELECT *, sum(n_ok) OVER w::BIGINT AS ok_total, row_number() OVER w AS k FROM p
  WINDOW w AS (PARTITION BY rdi ORDER BY batch ROWS UNBOUNDED PRECEDING))
SELECT rdi, batch, n_ok, n_rows, ok_total FROM q WHERE ok_total - n_ok < 500 OR k = 1
""".replace("sum(n_ok) OVER w::BIGINT", "(sum(n_ok) OVER w)::BIGINT"),
)
def page_cut(spark, d):
    # Narrow blocks make the block offsets matter at this scale.
    from sheafline.operators.scan import ordinal_block

    return paging.limit_pages(_pages(spark, d), 500, ordinal_block(F.col("batch"), 7))


@check(
    "page_stop",
    "WN5",
    f"""
WITH {_PAGES_SQL}, m AS (SELECT rdi, batch, CASE WHEN rdi = 'view' AND batch % 37 = 36 THEN 0 ELSE n_rows END AS n_rows,
         CASE rdi WHEN 'click' THEN 100 WHEN 'error' THEN 1000000 WHEN 'signup' THEN 7 END AS matches FROM p),
c AS (SELECT *, (sum(n_rows) OVER w)::BIGINT AS row_total FROM m WINDOW w AS (PARTITION BY rdi ORDER BY batch ROWS UNBOUNDED PRECEDING)),
z AS (SELECT *, sum((n_rows = 0)::INT) OVER w AS empties,
        coalesce(sum(coalesce(row_total >= matches, FALSE)::INT) OVER (PARTITION BY rdi ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stops
      FROM c WINDOW w AS (PARTITION BY rdi ORDER BY batch ROWS UNBOUNDED PRECEDING))
SELECT rdi, batch, n_rows, matches::BIGINT AS matches, row_total FROM z WHERE empties = 0 AND stops = 0
""",
)
def page_stop(spark, d):
    from sheafline.operators.scan import ordinal_block

    total = F.when(F.col("rdi") == "click", 100).when(F.col("rdi") == "error", 1_000_000).when(F.col("rdi") == "signup", 7)
    rows = F.when((F.col("rdi") == "view") & (F.col("batch") % 37 == 36), 0).otherwise(F.col("n_rows"))
    pages = _pages(spark, d).select("rdi", "batch", rows.alias("n_rows"), total.cast("bigint").alias("matches"))
    return paging.pages_read(pages, ordinal_block(F.col("batch"), 5))


@check(
    "expected_counts",
    "AG8 AG9",
    """
SELECT 'catalogue ' || lang AS rdi, CASE lang WHEN 'es' THEN 0 ELSE max(doc_id) END AS expected FROM documents GROUP BY lang
UNION ALL SELECT 'search ' || lang, CASE WHEN lang = 'fr' THEN NULL ELSE arg_min(n_chars, doc_id) END FROM documents GROUP BY lang
UNION ALL SELECT DISTINCT 'sitemap ' || lang, NULL FROM documents
""",
)
def expected_counts(spark, d):
    docs = table(spark, d, "documents")

    def named(kind):
        return F.concat(s(kind + " "), "lang").alias("rdi")

    key = F.col("doc_id").cast("string")
    matches = F.when(F.col("lang") == "es", "many").when(
        F.col("lang") == "de", F.concat(s("["), key, s(",1]"))
    ).otherwise(key)
    catalogue = docs.select(named("catalogue"), matches.alias("matches_text"))
    search = docs.select(named("search"), F.col("doc_id").alias("start"), F.when(F.col("lang") != "fr", F.col("n_chars")).alias("num_found"))
    return (
        paging.expected_count_catalogue(catalogue)
        .unionByName(paging.expected_count_search(search))
        .unionByName(paging.expected_count_sitemap(docs.select(named("sitemap"))))
    )


@check("count_probe", "SL5", "SELECT count(*) AS n_rows, max(doc_id) AS matches FROM (SELECT * FROM (SELECT max(doc_id) AS doc_id FROM documents) LIMIT 1)")
def count_probe(spark, d):
    docs = table(spark, d, "documents")
    pages = docs.select(s("r").alias("rdi"), docs.agg(F.max("doc_id")).scalar().alias("matches"))
    return paging.count_probe(pages).agg(F.count(F.lit(1)).alias("n_rows"), F.max("matches").alias("matches"))


# --- identifiers of failed records ------------------------------------------------------------


def _fallback_parts(spark, d):
    docs = table(spark, d, "documents")
    key = F.col("doc_id").cast("string")
    base = [F.col("lang").alias("rdi"), F.floor(F.col("doc_id") / 50).alias("batch"), F.col("doc_id").alias("pos")]
    errors = docs.filter("doc_id % 3 = 0").select(
        *base, F.concat(F.when(F.col("doc_id") % 2 == 0, "owslib_random_").otherwise("own-"), key).alias("record_id")
    )
    parsed = docs.filter("doc_id % 3 > 0").select(*base, F.concat(s("dc-"), key).alias("identifier"))
    labels = table(spark, d, "labels").select("doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    brief = labels.select(*base, F.concat(s("dc-"), key).alias("dc_id"))
    return errors, brief, parsed


@check(
    "dc_fallback",
    "JN3 JN4",
    """
WITH n AS (SELECT lang, doc_id // 50 AS batch, doc_id, row_number() OVER (PARTITION BY lang, doc_id // 50 ORDER BY doc_id) AS rn
           FROM documents WHERE doc_id % 6 = 0),
     u AS (SELECT lang, doc_id // 50 AS batch, 'dc-' || doc_id AS dc_id, row_number() OVER (PARTITION BY lang, doc_id // 50 ORDER BY doc_id) AS rn
           FROM documents JOIN labels USING (doc_id) WHERE doc_id % 3 = 0)
SELECT n.lang AS rdi, n.batch, n.doc_id AS pos, coalesce(dc_id, 'owslib_random_' || n.doc_id) AS record_id
FROM n LEFT JOIN u ON n.lang = u.lang AND n.batch = u.batch AND n.rn = u.rn
UNION ALL SELECT lang, doc_id // 50, doc_id, 'own-' || doc_id FROM documents WHERE doc_id % 6 = 3
""",
)
def dc_fallback(spark, d):
    return fallback.apply_id_fallback(*_fallback_parts(spark, d))


@check(
    "batch_positions",
    "WN3 SL1",
    "SELECT lang AS rdi, doc_id // 50 AS batch, doc_id AS pos, row_number() OVER (PARTITION BY lang, doc_id // 50 ORDER BY doc_id) AS rn FROM documents",
)
def batch_positions(spark, d):
    docs = table(spark, d, "documents").select(
        F.col("lang").alias("rdi"), F.floor(F.col("doc_id") / 50).alias("batch"), F.col("doc_id").alias("pos")
    )
    return fallback.batch_positions(docs).withColumn("rn", F.col("rn").cast("bigint"))


# --- catalogue predicates ---------------------------------------------------------------------


@check(
    "catalog_filter",
    "PF7",
    """
SELECT p_partkey, p_name FROM part
WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5', 'Brand#6') AND p_type <> 'SMALL'
  AND NOT (p_name LIKE '%blue%' OR p_name LIKE 'red _idget' OR p_name LIKE '%100!%%' ESCAPE '!')
""",
)
def catalog_filter(spark, d):
    part = table(spark, d, "part")
    wanted = catalog.all_match(
        catalog.any_match(*[catalog.equals(F.col("p_brand"), f"Brand#{i}") for i in range(1, 7)]),
        ~catalog.equals(F.col("p_type"), "SMALL"),
        catalog.none_match(
            catalog.like(F.col("p_name"), "*blue*", wildcard="*", single="?"),
            catalog.like(F.col("p_name"), "red _idget"),
            catalog.like(F.col("p_name"), "%100\\%%"),
        ),
    )
    return part.filter(wanted).select("p_partkey", "p_name")


@check(
    "any_text",
    "PF6",
    "SELECT doc_id FROM documents WHERE text LIKE '%the%' OR source LIKE '%the%' OR lang LIKE '%the%'",
)
def any_text(spark, d):
    docs = table(spark, d, "documents")
    return docs.filter(
        catalog.any_text_like("%the%", F.col("text"), F.col("source"), lists=[F.array("lang")])
    ).select("doc_id")


# --- several sources --------------------------------------------------------------------------


@check(
    "union_sources",
    "SO4 UD1",
    """
WITH r AS (SELECT 'docs' AS rdi, 'iso' AS source_type UNION ALL SELECT 'web', 'html_jsonld' UNION ALL SELECT 'ftp', 'ftp'),
 n AS (SELECT 'docs' AS rdi, count(*) AS harvested, 0 AS failed FROM documents
       UNION ALL SELECT 'web', 0, count(*) FROM pages)
SELECT r.rdi, source_type, source_type <> 'ftp' AS harvest_started, harvested, failed, 0::BIGINT AS skipped FROM r LEFT JOIN n USING (rdi)
""",
)
def union_sources(spark, d):
    from sheafline.checks.builders import iso_record, iso_response

    docs = spread_table(spark, d, "documents")
    record = iso_record(F.col("doc_id").cast("string"), F.col("source"), F.col("text"))
    landed_iso = docs.select(
        s("docs").alias("rdi"), s("http://c/csw").alias("base_url"), F.col("doc_id").alias("batch"), iso_response(F.lit(10**9), record).alias("body")
    )
    landed_html = table(spark, d, "pages").select(
        s("web").alias("rdi"), F.col("page_id").alias("seq"), F.concat("url", s("#"), F.col("page_id").cast("string")).alias("url"), F.col("html").alias("body")
    )
    out = run_sources({"iso": landed_iso, "html_jsonld": landed_html, "ftp": landed_html})
    types = F.array(*[F.struct(s(r).alias("rdi"), s(t).alias("source_type")) for r, t in (("docs", "iso"), ("web", "html_jsonld"), ("ftp", "ftp"))])
    repos = spark.range(1).select(F.inline(types))
    return outcomes.finalize_counts(repository_rows(repos), outcomes.harvest_counts(out))


@check(
    "repositories_side_by_side",
    "SO4 AG2",
    """
WITH r AS (SELECT unnest(['late', 'docs', 'bad', 'ftp', 'web']) AS rdi, unnest([0, 1, 2, 3, 4])::BIGINT AS repo_no,
                  unnest(['html_jsonld', 'iso', 'iso', 'ftp', 'html_jsonld']) AS source_type),
n AS (SELECT 'docs' AS rdi, count(*) AS harvested, 0 AS failed FROM documents
      UNION ALL SELECT 'web', 0, count(*) FROM pages WHERE page_id % 2 = 0
      UNION ALL SELECT 'late', 0, count(*) FROM pages WHERE page_id % 2 = 1)
SELECT r.rdi, repo_no, source_type, source_type <> 'ftp' AS harvest_started, rdi = 'bad' AS crashed, rdi = 'bad' AS explained,
       CASE WHEN rdi = 'bad' THEN 0 ELSE harvested END AS harvested, CASE WHEN rdi <> 'bad' THEN failed END AS failed, 0::BIGINT AS skipped
FROM r LEFT JOIN n USING (rdi)
""",
)
def repositories_side_by_side(spark, d):
    """Two page repositories, two catalogues of which one raises while it is read, and one of unknown type."""
    from sheafline.checks.builders import iso_record, iso_response

    docs = spread_table(spark, d, "documents")
    record = iso_record(F.col("doc_id").cast("string"), F.col("source"), F.col("text"))
    pages = table(spark, d, "pages")

    def catalogue(rdi, batch):
        return docs.select(
            s(rdi).alias("rdi"), s("http://c/csw").alias("base_url"), batch.alias("batch"), iso_response(F.lit(10**9), record).alias("body")
        )

    def web(rdi, part):
        return pages.where(F.col("page_id") % 2 == part).select(
            s(rdi).alias("rdi"), F.col("page_id").alias("seq"), F.concat("url", s("#"), F.col("page_id").cast("string")).alias("url"), F.col("html").alias("body")
        )

    broken = F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")).otherwise(F.raise_error(s("the landed table is damaged")).cast("bigint"))
    configured = [
        Repository("late", "html_jsonld", web("late", 1)),
        Repository("docs", "iso", catalogue("docs", F.col("doc_id"))),
        Repository("bad", "iso", catalogue("bad", broken)),
        Repository("ftp", "ftp", web("ftp", 0)),
        Repository("web", "html_jsonld", web("web", 0)),
    ]
    out, rows = run_repositories(configured, scratch_path(spark, "repositories"))
    final = outcomes.finalize_counts(rows, outcomes.harvest_counts(out))
    return final.withColumn("explained", F.coalesce(F.col("message").contains("damaged"), F.lit(False))).drop("message")


@check(
    "publish_versions",
    "SC11 FN38",
    f"""
WITH {_OUT}, v AS (SELECT rdi, arc_id, max(seq) AS last, bool_or(seq % 4 = 3) AS late FROM o WHERE kind = 'arc' GROUP BY ALL),
e AS (SELECT rdi, arc_id, max(seq) FILTER (seq % 4 < 3) AS first_last FROM o WHERE kind = 'arc' GROUP BY ALL)
SELECT 0::BIGINT AS version, 'created' AS change, count(first_last) AS n FROM e
UNION ALL SELECT 2, CASE WHEN first_last IS NULL THEN 'created' ELSE 'updated' END, count(*) FROM v JOIN e USING (rdi, arc_id)
          WHERE first_last IS NULL OR first_last <> last GROUP BY 2
""",
)
def publish_versions(spark, d):
    """Three quarters of the outcomes, the same again, which changes nothing, then all of them."""
    from sheafline.sources.sinks import publish_arcs, published

    path = scratch_path(spark, "published")
    # A document that names its arrival differs whenever a later one of the same object has come.
    named = F.regexp_replace("arc_json", s("}]}$"), F.concat(s(',"seq":'), F.col("seq").cast("string"), s("}]}")))
    out = _outcomes(spark, d).withColumn("arc_json", named)
    for version, part in enumerate((out.where("seq % 4 < 3"), out.where("seq % 4 < 3"), out)):
        publish_arcs(part, path, version)
    return published(spark, path).groupBy("version", "change").agg(F.count(F.lit(1)).alias("n"))


@check(
    "run_report_document",
    "SC13 AG7",
    f"""
WITH {_OUT}, {_ERR}, {_COUNTS}, {_ADJUSTED}, {_ENRICHED}, {_FAILED},
r AS (SELECT a.*, rdi::BIGINT % 4 <> 1 AS started FROM a),
k AS (SELECT rdi, count(*) AS n, count(record_id) AS ids, count(url) AS urls FROM f GROUP BY rdi)
SELECT r.rdi, 'PT' || regexp_replace(regexp_replace(printf('%.6f', rdi::BIGINT * 1.5), '0+$', ''), '\\.$', '') || 'S' AS duration,
       CASE WHEN started THEN coalesce(harvested, 0) END AS harvested, CASE WHEN started THEN coalesce(failed, 0) END AS failed, skipped,
       coalesce(n, 0) AS n_records, coalesce(ids, 0) AS n_ids, coalesce(urls, 0) AS n_urls
FROM r LEFT JOIN k USING (rdi)
""",
)
def run_report_document(spark, d):
    """The run report written, read again by a JSON parser, and taken apart."""
    from sheafline.sources.sinks import read_report, write_report

    run = table(spark, d, "events").agg(F.min("ts").alias("start_time"), F.max("ts").alias("end_time"))
    urls = outcomes.error_urls(_client_errors(spark, d), outcomes.arc_urls(_outcomes(spark, d)))
    path = scratch_path(spark, "report")
    problem = write_report(report.run_lines(run, _report_rows(spark, d), _failed(spark, d), urls=urls), path)
    if problem is not None:
        raise RuntimeError(problem)
    listed = F.variant_get("report", "$['schema:result']", "array<variant>")
    repo = read_report(spark, path).select(F.explode(listed).alias("r"))
    field = lambda name, kind: F.variant_get("r", f"$['{name}']", kind)
    records = F.coalesce(field("harvest:failedRecords", "array<variant>"), F.array().cast("array<variant>"))
    holding = lambda name: F.size(F.filter(records, lambda x: F.variant_get(x, f"$['{name}']", "string").isNotNull())).cast("bigint")
    return repo.select(
        field("identifier", "string").alias("rdi"),
        field("schema:duration", "string").alias("duration"),
        *[field(f"harvest:{n}Datasets", "bigint").alias(n) for n in ("harvested", "failed", "skipped")],
        F.size(F.filter(records, lambda x: F.variant_get(x, "$['harvest:message']", "string").isNotNull())).cast("bigint").alias("n_records"),
        holding("harvest:recordId").alias("n_ids"),
        holding("harvest:url").alias("n_urls"),
    )


@check(
    "sinks_roundtrip",
    "SC11",
    f"WITH {_OUT} SELECT rdi, arc_id, count(*) AS n FROM o WHERE kind = 'arc' GROUP BY ALL",
)
def sinks_roundtrip(spark, d):
    from sheafline.sources.sinks import read_arcs, write_arcs

    path = scratch_path(spark, "arcs")
    write_arcs(_outcomes(spark, d), path)
    arc_id = outcomes.arc_identifier(F.col("arc_json")).alias("arc_id")
    return read_arcs(spark, path).groupBy("rdi", arc_id).agg(F.count(F.lit(1)).alias("n"))
