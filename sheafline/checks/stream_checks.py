"""Streams run to completion over landed files; their results equal the batch SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sheafline.checks.base import check, s, table
from sheafline.checks.builders import iso_record
from sheafline.checks.graph_checks import _dataset_pages
from sheafline.checks.outcome_checks import _ADJUSTED, _COUNTS, _ENRICHED, _ERR, _OUT, _client_errors, _outcomes, _repos
from sheafline.checks.record_checks import _responses
from sheafline.operators.outcomes import finalize_counts
from sheafline.schemas import OUTCOME
from sheafline.session import scratch_path
from sheafline.streaming import flows, reconcile


@check(
    "stream_pages",
    "ST1",
    """
SELECT lang AS rdi, 'arc' AS kind, count(*) FILTER (doc_id % 10 <> 9 AND doc_id % 4 <> 2) + count(*) FILTER (doc_id % 3 > 0) AS n FROM documents GROUP BY 1
UNION ALL
SELECT lang, 'error', count(*) FILTER (doc_id % 10 = 9) + count(*) FILTER (doc_id % 3 = 0) + count(*) FILTER (doc_id % 5 = 0)
       + count(*) FILTER (doc_id % 7 = 0) + count(*) FILTER (doc_id % 11 = 0) FROM documents GROUP BY 1
""",
)
def stream_pages(spark, d):
    base = scratch_path(spark, "stream")
    _responses(spark, d).write.parquet(f"{base}/landed")
    landed = flows.stream_landed(spark, f"{base}/landed", "rdi string, batch bigint, base_url string, body string")
    flows.run_available(flows.stream_record_outcomes(landed), flows.publish_into(f"{base}/out"), f"{base}/state")
    out = spark.read.schema(f"{OUTCOME}, batch_id bigint").parquet(f"{base}/out")
    # A repository without outcomes of a kind has none of it, which is a row too.
    counts = out.groupBy("rdi").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("arc", "error")])
    return counts.selectExpr("rdi", "stack(2, 'arc', arc, 'error', error) AS (kind, n)")


@check(
    "stream_publish",
    "ST2",
    """
SELECT 'http://p/' || page_id AS source_url, CASE WHEN page_id % 5 IN (0, 1, 4) THEN 'arc' ELSE 'error' END AS kind FROM pages
""",
)
def stream_publish(spark, d):
    base = scratch_path(spark, "stream")
    pages = _dataset_pages(spark, d).withColumnRenamed("html", "body")
    pages.write.parquet(f"{base}/landed")
    landed = flows.stream_landed(spark, f"{base}/landed", "rdi string, seq bigint, url string, body string")
    publish = flows.publish_into(f"{base}/out")
    flows.run_available(flows.stream_page_outcomes(landed), publish, f"{base}/state")
    return spark.read.schema(f"{OUTCOME}, batch_id bigint").parquet(f"{base}/out").select("source_url", "kind")


def _visits(spark, d):
    """Events as landed discoveries."""
    return table(spark, d, "events").select(
        F.col("event_type").alias("rdi"),
        F.col("event_id").alias("seq"),
        F.concat(s("http://u/"), F.col("user_id").cast("string")).alias("url"),
        F.col("ts").cast("timestamp").alias("landed_at"),
    )


def _land_and_run(rows, base, run, parts=2):
    """Land the rows in some deliveries and run the stream after each, resuming from its checkpoint."""
    for part in range(parts):
        rows.filter(F.col("seq") % parts == part).write.mode("append").parquet(f"{base}/landed")
        run(flows.stream_landed(rows.sparkSession, f"{base}/landed", _ddl(rows)))


def _ddl(rows):
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)


@check(
    "stream_dedup",
    "ST3",
    "SELECT event_type AS rdi, 'http://u/' || user_id AS url, 1::BIGINT AS n FROM events GROUP BY ALL",
)
def stream_dedup(spark, d):
    base = scratch_path(spark, "stream")

    def handle(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    def run(landed):
        flows.run_available(flows.stream_dedup(landed, ttl="60 days"), handle, f"{base}/state")

    _land_and_run(_visits(spark, d), base, run)
    out = spark.read.schema("rdi string, url string, batch_id bigint").parquet(f"{base}/out")
    return out.groupBy("rdi", "url").agg(F.count(F.lit(1)).alias("n"))


@check(
    "stream_flag",
    "ST3",
    "SELECT event_type AS rdi, count(*) AS n, count(*) - count(DISTINCT user_id) AS duplicates FROM events GROUP BY 1",
)
def stream_flag(spark, d):
    base = scratch_path(spark, "stream")
    flows.use_rocksdb(spark)

    def handle(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    def run(landed):
        flows.run_available(flows.stream_flags(landed, ttl="60 days"), handle, f"{base}/state")

    _land_and_run(_visits(spark, d), base, run, parts=3)
    out = spark.read.schema("rdi string, seq bigint, url string, is_duplicate boolean, batch_id bigint").parquet(f"{base}/out")
    return out.groupBy("rdi").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_duplicate").alias("duplicates"))


@check(
    "stream_counts",
    "ST4",
    """
SELECT user_id::VARCHAR AS rdi, count(*) FILTER (event_type NOT IN ('error', 'view')) AS harvested, count(*) FILTER (event_type = 'error') AS failed,
       count(*) FILTER (event_type = 'view') AS skipped FROM events GROUP BY 1
""",
)
def stream_counts(spark, d):
    base = scratch_path(spark, "stream")

    def handle(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    def run(landed):
        flows.run_available(flows.stream_counts(landed), handle, f"{base}/state", mode="update")

    _land_and_run(_outcomes(spark, d), base, run)
    out = spark.read.schema("rdi string, harvested bigint, failed bigint, skipped bigint, batch_id bigint").parquet(f"{base}/out")
    latest = F.max_by(F.struct("harvested", "failed", "skipped"), "batch_id")
    return out.groupBy("rdi").agg(latest.alias("c")).select("rdi", "c.*")


@check(
    "stream_window_counts",
    "ST4 AG1",
    """
WITH e AS (SELECT user_id::VARCHAR AS rdi, event_type, ts, event_id % 9 = 4 AS held,
                  time_bucket(INTERVAL '7 days', ts::TIMESTAMP, TIMESTAMP '1970-01-01') AS w FROM events),
m AS (SELECT max(ts::TIMESTAMP) - INTERVAL '10 days' AS mark FROM e WHERE NOT held)
SELECT rdi, w AS window_start, count(*) FILTER (event_type NOT IN ('error', 'view')) AS harvested, count(*) FILTER (event_type = 'error') AS failed,
       count(*) FILTER (event_type = 'view') AS skipped
FROM e, m WHERE NOT held OR w + INTERVAL '7 days' > mark GROUP BY ALL
""",
)
def stream_window_counts(spark, d):
    """One event in nine lands after all others; those whose window had closed by then are late and do not count."""
    base = scratch_path(spark, "stream")
    when = table(spark, d, "events").select(F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("landed_at"))
    rows = _outcomes(spark, d).select("rdi", "seq", "kind").join(when, "seq")
    held = F.col("seq") % 9 == 4
    # A row far ahead closes the last windows; its own stays open.
    ahead = rows.agg(F.max("landed_at").alias("t")).select(
        s("ahead").alias("rdi"), F.lit(-1).cast("bigint").alias("seq"), s("skip").alias("kind"), (F.col("t") + F.expr("INTERVAL 90 days")).alias("landed_at")
    )

    def handle(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    for delivery in (rows.where(~held), rows.where(held), ahead.select(*rows.columns)):
        delivery.write.mode("append").parquet(f"{base}/landed")
        landed = flows.stream_landed(spark, f"{base}/landed", _ddl(rows))
        flows.run_available(flows.stream_window_counts(landed, "7 days", "10 days"), handle, f"{base}/state")
    out = "rdi string, window_start timestamp, window_end timestamp, harvested bigint, failed bigint, skipped bigint, batch_id bigint"
    counted = spark.read.schema(out).parquet(f"{base}/out")
    return counted.select("rdi", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "harvested", "failed", "skipped")


def _reconciled(spark, d, base, deliveries=3):
    """Outcomes and upload errors, landed in deliveries and published as one stream; the second batch runs twice."""
    out, errors = _outcomes(spark, d), _client_errors(spark, d)
    publish = reconcile.reconcile_into(base)

    def handle(batch, batch_id):
        for _ in range(2 if batch_id == 1 else 1):
            publish(batch, batch_id)

    for part in range(deliveries):
        out.where(F.col("seq") % deliveries == part).write.mode("append").parquet(f"{base}/landed/outcomes")
        # An answer may land before its object, with it, or after it.
        errors.where(F.floor(F.col("seq") / 7) % deliveries == part).write.mode("append").parquet(f"{base}/landed/errors")
        streams = [flows.stream_landed(spark, f"{base}/landed/{n}", _ddl(r)) for n, r in (("outcomes", out), ("errors", errors))]
        flows.run_available(reconcile.with_answers(*streams), handle, f"{base}/state")


@check(
    "stream_reconcile",
    "ST5 AG2 AG3",
    f"""
WITH {_OUT}, {_ERR}, {_COUNTS}, {_ADJUSTED}
SELECT a.rdi, rdi::BIGINT % 4 <> 1 AS harvest_started, CASE WHEN rdi::BIGINT % 4 <> 1 THEN coalesce(harvested, 0) END AS harvested,
       CASE WHEN rdi::BIGINT % 4 <> 1 THEN coalesce(failed, 0) END AS failed, skipped FROM a
""",
)
def stream_reconcile(spark, d):
    base = scratch_path(spark, "stream")
    _reconciled(spark, d, base)
    return finalize_counts(_repos(spark, d).drop("repo_no"), reconcile.reconciled_counts(spark, base))


@check("stream_reconcile_errors", "ST5 JN8", f"WITH {_OUT}, {_ERR}, {_ENRICHED} SELECT * FROM m")
def stream_reconcile_errors(spark, d):
    base = scratch_path(spark, "stream")
    _reconciled(spark, d, base)
    return reconcile.reconciled_errors(spark, base)[0]


@check(
    "stream_sitemap",
    "ST2 SC6 WN1 PF5",
    """
WITH p AS (SELECT page_id, 'http://p/' || page_id AS url, 'r' || (page_id % 3) AS rdi FROM pages)
SELECT rdi, url AS source_url, CASE WHEN page_id % 13 = 5 THEN 'error' WHEN page_id % 5 IN (0, 1, 4) THEN 'arc' ELSE 'error' END AS kind,
       page_id % 13 = 5 AS lost FROM p
UNION ALL SELECT rdi, url, 'skip', false FROM p WHERE page_id % 4 = 0
""",
)
def stream_sitemap(spark, d):
    """Half of the pages land before their sitemap, the others after it, one in thirteen never."""
    base = scratch_path(spark, "stream")
    number = F.regexp_extract("url", "([0-9]+)$", 1).cast("bigint")
    at = lambda hours, k: F.timestamp_seconds(F.lit(1_700_000_000 + hours * 3600) + k % 3600).alias("landed_at")
    pages = _dataset_pages(spark, d).select("url", F.col("html").alias("body")).where(number % 13 != 5)
    ids = table(spark, d, "pages").select("page_id")
    loc = F.concat(s("<url><loc>http://p/"), F.col("page_id").cast("string"), s("</loc></url>"))
    sets = ids.select(
        F.concat(s("r"), (F.col("page_id") % 3).cast("string")).alias("rdi"),
        F.concat(s("http://set/"), F.col("page_id").cast("string")).alias("sitemap_url"),
        F.col("page_id").alias("batch"),
        F.concat(s("<urlset>"), loc, F.when(F.col("page_id") % 4 == 0, loc).otherwise(""), s("</urlset>")).alias("body"),
        at(1, F.col("page_id")),
    )
    early, late = (pages.where(number % 2 == k).select("url", "body", at(2 * k, number)) for k in (0, 1))
    # Rows a month ahead on both sides move the watermark past everything before.
    one = spark.range(1)
    month = at(24 * 30, F.col("id"))
    last_set = one.select(*[s(v).alias(n) for n, v in (("rdi", ""), ("sitemap_url", "end"))], F.col("id").alias("batch"), s("<urlset/>").alias("body"), month)
    last_page = one.select(s("end").alias("url"), s("").alias("body"), month)

    def handle(name):
        return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{base}/{name}/batch_id={batch_id}")

    for name, delivery in (("pages", early), ("sets", sets), ("pages", late), ("sets", last_set), ("pages", last_page)):
        delivery.write.mode("append").parquet(f"{base}/landed/{name}")
        if delivery is early or delivery is last_set:
            continue  # nothing is listed yet; a restarted stream moves its watermark by what both sides land from then on
        landed_sets = flows.stream_landed(spark, f"{base}/landed/sets", _ddl(sets))
        landed_pages = flows.stream_landed(spark, f"{base}/landed/pages", _ddl(early))
        found = flows.stream_sitemap_outcomes(landed_sets, landed_pages, "1 day")
        flows.run_available(found, handle("out"), f"{base}/state")
    flows.run_available(flows.stream_skips(landed_sets), handle("skips"), f"{base}/skip_state")
    read = lambda name: spark.read.schema(f"{OUTCOME}, batch_id bigint").parquet(f"{base}/{name}")
    lost = F.coalesce(F.col("message").startswith("No page was landed"), F.lit(False))
    return read("out").unionByName(read("skips")).select("rdi", "source_url", "kind", lost.alias("lost"))


@check(
    "stream_raw_xml",
    "ST1 SC1",
    """
WITH r AS (SELECT doc_id, doc_id // 100 AS page, row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) AS nth,
                  doc_id = max(doc_id) OVER (PARTITION BY doc_id // 100) AND doc_id // 100 % 3 = 1 AS torn FROM documents)
SELECT page AS batch, nth, CASE WHEN doc_id % 5 = 0 OR torn THEN 'error' ELSE 'arc' END AS kind,
       CASE WHEN doc_id % 5 > 0 AND NOT torn THEN 'doc-' || doc_id END AS id
FROM r
UNION ALL SELECT NULL, 1, 'error', NULL
""",
)
def stream_raw_xml(spark, d):
    """XML files of many blocks: one in three ends inside a record, one has no page number; comments name the tag."""
    base = scratch_path(spark, "stream")
    docs = table(spark, d, "documents").withColumn("page", F.floor(F.col("doc_id") / 100))
    last = docs.groupBy("page").agg(F.max("doc_id").alias("last"))
    record = iso_record(F.when(F.col("doc_id") % 5 > 0, F.concat(s("doc-"), F.col("doc_id").cast("string"))), F.col("source"), F.col("text"))
    comment = F.when(F.col("doc_id") % 2 == 0, s("<!-- <MD_Metadata> is next -->\n")).otherwise("")
    torn = (F.col("doc_id") == F.col("last")) & (F.col("page") % 3 == 1)
    lines = docs.join(last, "page").select(
        F.col("page").cast("string").alias("page"),
        F.col("doc_id").alias("place"),
        F.concat(comment, F.when(torn, F.regexp_replace(record, "</MD_Metadata>\\s*$", "")).otherwise(record)).alias("value"),
    )
    edge = lambda place, text: last.select(F.col("page").cast("string"), F.lit(place).cast("bigint").alias("place"), s(text).alias("value"))
    feet = edge(2**62, "</SearchResults></GetRecordsResponse>").where("page % 3 <> 1")
    stray = spark.range(1).select(s("none").alias("page"), F.col("id").alias("place"), s("<r><MD_Metadata/></r>").alias("value"))
    files = edge(-1, "<GetRecordsResponse><SearchResults>").unionByName(lines).unionByName(feet).unionByName(stray)
    files = files.repartition("page").sortWithinPartitions("page", "place").select("page", "value")
    files.write.partitionBy("page").text(f"{base}/landed")
    block = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 << 10))
    try:
        publish = flows.publish_into(f"{base}/out")
        # Pages below 2^31 of at most 2^32 bytes.
        outcomes = lambda batch: flows.chunk_outcomes(batch, "r", "http://c/", "MD_Metadata", r"page=(\d+)/", offset_bits=32)
        stream = flows.raw_chunks(spark.readStream, f"{base}/landed", "MD_Metadata")
        flows.run_available(stream, lambda batch, batch_id: publish(outcomes(batch), batch_id), f"{base}/state")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    out = spark.read.schema(f"{OUTCOME}, batch_id bigint").parquet(f"{base}/out")
    batch = F.shiftright("seq", 32)
    ident = F.when(F.col("kind") == "arc", F.regexp_extract("source_url", "id=([^&]*)", 1))
    nth = F.row_number().over(Window.partitionBy(batch).orderBy("seq"))
    return out.select(batch.alias("batch"), nth.cast("bigint").alias("nth"), "kind", ident.alias("id"))
