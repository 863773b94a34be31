"""Relational operators against brute force and pinned examples."""

import json
import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from sheafline.checks.builders import full_contact, record_fields
from sheafline.operators import dedup, fallback, fetchlog, outcomes, paging, report, scan

from sheafline.operators.scan import blocked_row_number, blocked_scan, ordinal_block, ordinal_width
from sheafline.plans import record_arc as ra
from sheafline.plans import registry
from sheafline.plans.registry import MAPPERS, SITEMAPS, SOURCES, Registry
from sheafline.sources import iso, robots, sinks
from sheafline.streaming import flows, reconcile


def test_blocked_scan_equals_plain_window(spark):
    rnd = random.Random(1)
    rows = [("hot" if rnd.random() < 0.5 else f"k{i % 7}", i, rnd.choice([None, rnd.randint(-9, 9)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, i bigint, v bigint").repartition(6)
    out = blocked_scan(
        df, ["k"], [F.col("i")], ordinal_block(F.col("i"), 37),
        {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "n": ("count", F.lit(1))},
    ).collect()
    want, state = {}, {}
    for k, i, v in sorted(rows, key=lambda r: r[1]):
        s, m, n = state.get(k, (None, None, 0))
        if v is not None:
            s, m = (s or 0) + v, v if m is None else max(m, v)
        state[k] = (s, m, n + 1)
        want[(k, i)] = state[k]
    assert {(r["k"], r["i"]): (r["s"], r["m"], r["n"]) for r in out} == want


def test_sparse_ordinals(spark):
    df = spark.range(5000).select(F.lit("k").alias("k"), (F.abs(F.xxhash64("id")) % 10**15).alias("i"))
    width = ordinal_width(df, "i", rows=500)
    assert 10**15 // 20 < width < 10**15 // 5
    assert ordinal_width(df.limit(0), "i") > 0
    out = blocked_row_number(df, ["k"], [F.col("i")], ordinal_block(F.col("i"), width)).orderBy("i").collect()
    assert [r["rn"] for r in out] == list(range(1, 5001))


def test_polite_schedule_equals_the_loop(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("ab") if rnd.random() < 0.7 else f"h{i % 5}", i, rnd.randrange(0, 40) * 500_000) for i in range(1500)]
    df = spark.createDataFrame(rows, "host string, id bigint, arrival bigint").withColumn("delay", F.lit(700_000).cast("bigint"))
    got = {r["id"]: r["send_at"] for r in fetchlog.polite_schedule(df, block_micros=3_000_000).collect()}
    last, want = {}, {}
    for host, i, arrival in sorted(rows, key=lambda r: (r[2], r[1])):
        want[i] = arrival if host not in last else max(arrival, last[host] + 700_000)
        last[host] = want[i]
    assert got == want


def test_dedup_modes(spark):
    rows = [("r", i, f"u{i % 3}" if i % 2 else "hot", i * 10) for i in range(40)]
    df = spark.createDataFrame(rows, "rdi string, seq bigint, url string, extra bigint")
    first = {}
    for _, seq, url, extra in rows:
        first.setdefault(url, (seq, extra))
    dropped = {r["url"]: (r["seq"], r["extra"]) for r in dedup.dedup_urls(df, "drop").collect()}
    assert dropped == first
    flagged = dedup.dedup_urls(df, "flag").collect()
    assert len(flagged) == 40
    assert {r["seq"] for r in flagged if not r["is_duplicate"]} == {s for s, _ in first.values()}
    with pytest.raises(ValueError):
        dedup.dedup_urls(df, "other")


@pytest.mark.parametrize("limit", [0, 1, 60, 10_000])
def test_page_cut_equals_the_loop(spark, limit):
    pages = [("r", b, n) for b, n in enumerate([0, 50, 10, 50, 0, 50])]
    df = spark.createDataFrame(pages, "rdi string, batch bigint, n_ok bigint")
    want, total = [], 0
    for _, batch, n in pages:
        want.append(batch)
        total += n
        if total >= limit:
            break
    got = paging.limit_pages(df, limit, ordinal_block(F.col("batch"), 2))
    assert sorted(r["batch"] for r in got.collect()) == want


def test_id_fallback(spark):
    errors = spark.createDataFrame([("r", 0, 1, "owslib_random_1"), ("r", 0, 3, "owslib_random_2"), ("r", 0, 4, "own"), ("r", 1, 0, "owslib_random_3")], "rdi string, batch bigint, pos int, record_id string")
    brief = spark.createDataFrame([("r", 0, 0, "good"), ("r", 0, 1, "dc1")], "rdi string, batch bigint, pos int, dc_id string")
    parsed = spark.createDataFrame([("r", 0, "good")], "rdi string, batch bigint, identifier string")
    got = {(r["batch"], r["pos"]): r["record_id"] for r in fallback.apply_id_fallback(errors, brief, parsed).collect()}
    assert got == {(0, 1): "dc1", (0, 3): "owslib_random_2", (0, 4): "own", (1, 0): "owslib_random_3"}


def _arc(ident):
    return json.dumps({"@graph": [{"@id": "./", "identifier": ident}]})


def test_counts_urls_and_errors(spark):
    rows = [
        ("a", 1, "error", None, "id1", "http://x", "bad"),
        ("a", 2, "arc", _arc("d1"), None, "http://u2", None),
        ("a", 3, "arc", _arc("d1"), None, "http://u1", None),
        ("a", 4, "arc", _arc("d1"), None, "http://u2", None),
        ("a", 5, "arc", _arc(["d2"]), None, "http://u3", None),
        ("a", 6, "skip", None, None, "http://u3", "dup"),
        ("b", 1, "error", None, None, None, "plain"),
    ]
    out = spark.createDataFrame(rows, "rdi string, seq bigint, kind string, arc_json string, record_id string, source_url string, message string")
    counts = outcomes.harvest_counts(out)
    assert {r["rdi"]: (r["harvested"], r["failed"], r["skipped"]) for r in counts.collect()} == {"a": (4, 1, 1), "b": (None, 1, 0)}
    errors = spark.createDataFrame(
        [("a", 1, "DUPLICATE", "d1", "m1"), ("a", 2, "INVALID", "d2", "m2"), ("a", 3, "DUPLICATE", None, "m3"), ("c", 1, "DUPLICATE", "d9", "m4")],
        "rdi string, seq bigint, error_type string, arc_id string, message string",
    )
    adjusted = {r["rdi"]: (r["harvested"], r["failed"]) for r in outcomes.apply_client_errors(counts, errors).collect()}
    assert adjusted == {"a": (2, 4), "b": (None, 1)}
    urls = outcomes.arc_urls(out)
    whole = {(r["rdi"], r["seq"]): (r["message"], r["n_urls"]) for r in outcomes.enrich_client_errors(errors, urls).collect()}
    assert whole == {
        ("a", 1): ("m1 — source URLs:", 2), ("a", 2): ("m2 — source URL:", 1), ("a", 3): ("m3", 0), ("c", 1): ("m4", 0),
    }
    listed = sorted(tuple(r) for r in outcomes.error_urls(errors, urls).collect())
    assert listed == [("a", 1, 1, "http://u2"), ("a", 1, 2, "http://u1"), ("a", 2, 1, "http://u3")]
    repos = spark.createDataFrame([("a", True), ("b", True), ("z", False)], "rdi string, harvest_started boolean")
    final = {r["rdi"]: (r["harvested"], r["failed"], r["skipped"]) for r in outcomes.finalize_counts(repos, counts).collect()}
    assert final == {"a": (4, 1, 1), "b": (0, 1, 0), "z": (None, None, 0)}


def test_lost_repositories(spark):
    repos = spark.createDataFrame(
        [("ok", True, False), ("lost", True, True), ("never", False, False)], "rdi string, harvest_started boolean, crashed boolean"
    )
    counts = spark.createDataFrame([("ok", 2, None, 1), ("lost", 5, 5, 5)], "rdi string, harvested bigint, failed bigint, skipped bigint")
    got = {r["rdi"]: (r["harvested"], r["failed"], r["skipped"]) for r in outcomes.finalize_counts(repos, counts).collect()}
    assert got == {"ok": (2, 0, 1), "lost": (0, None, 0), "never": (None, None, 0)}
    none = spark.createDataFrame([], "rdi string, seq bigint, kind string, arc_json string, record_id string, source_url string, message string")
    runs = spark.createDataFrame([("lost", "OSError: gone", "http://s")], "rdi string, message string, url string")
    rows = outcomes.failed_records(none, run_failures=runs).collect()
    assert [(r["section"], r["message"], r["record_id"], r["url"]) for r in rows] == [(2, "OSError: gone", None, "http://s")]


def test_run_report_is_one_json_document(spark, tmp_path):
    run = spark.sql("select timestamp'2026-01-01 00:00:00' start_time, timestamp'2026-01-01 00:00:01.5' end_time")
    repos = spark.createDataFrame(
        [("b", 0, "h", 12.3, 5, 3, 2, 0), ("a", 1, None, 0.0, None, None, None, 0)],
        "rdi string, repo_no bigint, harvest_id string, duration_seconds double, expected bigint, harvested bigint, failed bigint, skipped bigint",
    )
    failed = spark.createDataFrame(
        [("b", 0, 7, 'say "no" ü', "r1", None, 0), ("b", 1, 1, "up", "", "http://u", 0), ("b", 1, 2, "x — source URLs:", "d", None, 1500)],
        "rdi string, section int, seq bigint, message string, record_id string, url string, n_urls bigint",
    )
    urls = spark.range(1, 1501).selectExpr("'b' rdi", "2L seq", "id rn", "concat('http://u/', id) url")
    lines = report.run_lines(run, repos, failed, report.Vocabulary("ex", "https://ex/", "Run"), urls)
    sinks.write_report(lines, str(tmp_path / "report"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "report").glob("part-*")))
    doc = json.loads(text)
    assert doc["name"] == "Run" and doc["ex:harvestDurationSeconds"] == 1.5
    first, second = doc["schema:result"]
    assert first["name"] == "b" and first["ex:harvestId"] == "h" and first["schema:duration"] == "PT12.3S"
    *two, long = first["ex:failedRecords"]
    assert two == [{"ex:message": 'say "no" ü', "ex:recordId": "r1"}, {"ex:message": "up", "ex:url": "http://u"}]
    assert long == {"ex:message": "x — source URLs: " + ", ".join(f"http://u/{k}" for k in range(1, 1501)), "ex:recordId": "d"}
    assert second == {"@type": "schema:EntryPoint", "name": "a", "identifier": "a", "schema:duration": "PT0S", "ex:harvestId": None, "ex:skippedDatasets": 0}
    assert report.all_failed(repos).collect()[0][0] is False
    assert report.all_failed(repos.filter("rdi = 'a'")).collect()[0][0] is True
    assert report.all_failed(repos.filter("rdi = 'x'")).collect()[0][0] is False


def test_null_keys_are_one_group(spark):
    rows = spark.createDataFrame([(None, k, "u" if k else None) for k in range(4)], "rdi string, seq bigint, url string")
    numbered = scan.blocked_row_number(rows, ["rdi"], [F.col("seq")], scan.ordinal_block(F.col("seq"), 2))
    assert sorted(r["rn"] for r in numbered.collect()) == [1, 2, 3, 4]
    flagged = {r["seq"]: r["is_duplicate"] for r in dedup.dedup_urls(rows).collect()}
    assert flagged == {0: False, 1: False, 2: True, 3: True}


def test_ordinals_do_not_collide(spark):
    given = spark.createDataFrame([(0, 2**31 - 2), (1, 0), (2**31 - 1, 5), (None, 1)], "batch bigint, pos int")
    got = [r[0] for r in given.select(scan.arrival_ordinal(F.col("batch"), F.col("pos"))).collect()]
    assert got[:2] == sorted(got[:2]) and got[2] == (2**31 - 1) * 2**32 + 5 and got[3] is None
    with pytest.raises(Exception, match="out of range"):
        given.select(scan.arrival_ordinal(F.col("batch") + 1, F.col("pos"))).collect()


def test_robots(spark):
    rules = spark.createDataFrame(
        [("h", 0, "*", False, "/a", None), ("h", 1, "*", True, "/a/b", None), ("h", 2, "*", True, None, 4.0), ("e", 0, "*", False, "", None), ("n", 0, "bot", False, "/", None), ("n", 1, "*", True, "/", None)],
        "host string, pos int, agent string, allow boolean, path string, crawl_delay double",
    )
    urls = spark.createDataFrame([(u,) for u in ("http://h/a/b", "http://h/c", "http://e/x", "http://n/x", "http://free/x")], "url string")
    got = {r["url"]: r["allowed"] for r in fetchlog.robots_allowed(urls, rules, "Bot/1.0").collect()}
    assert got == {"http://h/a/b": False, "http://h/c": True, "http://e/x": True, "http://n/x": False, "http://free/x": True}
    hosts = spark.createDataFrame([("h",), ("free",)], "host string")
    assert {r["host"]: r["delay"] for r in fetchlog.host_delay(hosts, rules, "Bot/1.0", 2.0).collect()} == {"h": 4.0, "free": 0.5}
    assert {r["host"]: r["delay"] for r in fetchlog.host_delay(hosts, rules, "Bot/1.0", 0).collect()} == {"h": 4.0, "free": 0.0}


def test_robots_files(spark):
    body = (
        "# c\nUser-agent: other\nUser-Agent: HarvestBot # us\nDisallow: /p%20q\nAllow: /p\nCrawl-delay: 7\n\nDisallow: /ignored\n\n"
        "user-agent: *\ndisallow:\n\nUser-agent: harvestbot\nDisallow: /\nUser-agent: *\nDisallow: /"
    )
    files = spark.createDataFrame([("h", body), ("lone", "User-agent: harvestbot\n\nDisallow: /"), ("none", None), ("star", "User-agent: *\r\nDisallow: /x\r\nUser-agent: *\r\nDisallow: /y")], "host string, body string")
    rules = robots.read_robots(files)
    rows = rules.filter("host = 'h'").orderBy("pos").collect()
    assert [(r["entry"], r["agent"], r["allow"], r["path"], r["crawl_delay"]) for r in rows[:6]] == [
        (0, "other", False, "/p q", None), (0, "HarvestBot", False, "/p q", None), (0, "other", True, "/p", None),
        (0, "HarvestBot", True, "/p", None), (0, "other", False, None, 7.0), (0, "HarvestBot", False, None, 7.0),
    ]
    assert [r["path"] for r in rows[6:]] == ["", "/", "/"]
    urls = spark.createDataFrame([(u,) for u in ("http://h/p%20q/1", "http://h/p1", "http://h/z", "http://lone/", "http://none/", "http://star/x", "http://star/y")], "url string")
    got = {r["url"][7:]: r["allowed"] for r in fetchlog.robots_allowed(urls, rules, "HarvestBot/2.0 (mail)").collect()}
    assert got == {"h/p%20q/1": False, "h/p1": True, "h/z": True, "lone/": True, "none/": True, "star/x": False, "star/y": True}
    hosts = spark.createDataFrame([("h",), ("lone",)], "host string")
    assert {r["host"]: r["delay"] for r in fetchlog.host_delay(hosts, rules, "HarvestBot/2.0", None).collect()} == {"h": 7.0, "lone": 0.0}


def test_golden_record(spark):
    c = lambda **k: full_contact(F.lit(k.pop("name")), **{n: F.lit(v) for n, v in k.items()})
    one = lambda *pairs: F.struct(*[F.lit(v).alias(n) for n, v in pairs])
    r = record_fields(
        identifier=F.lit("uuid-123"), title=F.lit("Test Dataset"), abstract=F.lit("d"), date_stamp=F.lit("2023-10-27"),
        topic_categories=F.array(F.lit("biota")),
        contacts=F.array(c(name="John Doe", organization="Test Org", role="author", address="123 Test St", city="Test City", country="Test Country")),
        creators=F.array(c(name="Jane Doe", role="creator")), publishers=F.array(c(name="Test Publisher")), contributors=F.array(c(name="Contributor Name")),
        lineage=F.lit("Processed using algorithm X"), spatial_extent=F.array(*[F.lit(x) for x in (10.0, 48.0, 11.0, 49.0)]),
        temporal_extent=iso.temporal_extent(F.lit("2020-01-01"), F.lit("2020-12-31")),
        resource_identifiers=iso.zip_identifiers(F.array(F.lit("10.1234/doi")), F.array(F.lit("DOI"))),
        language=F.lit("eng"), metadata_standard_name=F.lit("ISO 19115"), access_constraints=F.array(F.lit("Public Domain")),
        dates=F.array(one(("date", "2023-10-27"), ("datetype", "creation"))),
    )
    row = spark.range(1).select(
        ra.map_investigation(r, ra.persons(ra.all_contacts(*[r(n) for n in ("contacts", "creators", "publishers", "contributors")]))).alias("i"),
        ra.map_study(r).alias("s"), ra.map_assay(r).alias("a"),
    ).collect()[0]
    inv = row["i"]
    assert inv["identifier"] == "uuid-123" and len(inv["contacts"]) == 4 and len(inv["publications"]) == 1
    first = inv["contacts"][0]
    assert (first["first_name"], first["last_name"], first["address"]) == ("John", "Doe", "123 Test St, Test City, Test Country")
    assert [p["name"] for p in inv["ontology_sources"]] == ["ISO 19115", "NCIT", "GEMET", "EDAM", "ISO"]
    assert inv["publications"][0]["authors"] is None
    assert [t["name"] for t in row["s"]["tables"]] == ["Spatial Sampling", "Data Acquisition", "Data Processing"]
    cells = {x["header"]: x["value"] for t in row["s"]["tables"] for x in t["columns"]}
    assert cells["Bounding Box"] == "[10.0, 48.0, 11.0, 49.0]" and cells["Temporal Extent"] == "2020-01-01 to 2020-12-31"
    assert row["a"]["measurement_type"]["name"] == "Biological Measurement" and row["a"]["identifier"] == "test_dataset"


def test_registry():
    registry = Registry("thing")
    registry.register("x")(lambda df: df)
    assert "x" in registry and registry.keys() == ["x"]
    with pytest.raises(ValueError, match="Unsupported thing: y"):
        registry["y"]
    assert "general" in MAPPERS and "iso" in SOURCES


def test_sitemaps_without_repository_keep_locations_that_others_list_too(spark):
    listed = lambda *urls: "<urlset>" + "".join(f"<url><loc>{u}</loc></url>" for u in urls) + "</urlset>"
    docs = spark.createDataFrame([("r", "a", listed("u", "v", "u")), ("r", "b", listed("u"))], "rdi string, sitemap_url string, body string")
    found = lambda df: sorted((r.sitemap_url, r.pos, r.url) for r in SITEMAPS["xml"](df).collect())
    assert found(docs.drop("rdi")) == [("a", 0, "u"), ("a", 1, "v"), ("b", 0, "u")]
    assert found(docs) == [("a", 0, "u"), ("a", 1, "v")]


def test_bodies_do_not_move_to_learn_their_announced_total(spark):
    from sheafline.checks.harvest_checks import _half_announced

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")  # as far below the documents as at scale
    try:
        plan = _half_announced(spark, "/root/testdata/sf0.1")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" in plan and "hashpartitioning(rdi" not in plan


def test_stream_flag_keeps_its_state_over_runs(spark, tmp_path):
    schema = "rdi string, seq bigint, url string, landed_at timestamp"
    at = lambda day: f"2024-01-{day:02d} 00:00:00"
    deliveries = [
        [("r", 1, "u", at(1)), ("r", 2, "u", at(1)), ("r", 3, "v", at(1))],
        [("r", 4, "u", at(2)), ("r", 5, "w", at(2)), (None, 6, "u", at(2)), (None, 7, "u", at(2))],
        [("r", 8, "x", at(30))],
        [("r", 9, "u", at(30)), ("r", 10, "x", at(30))],
    ]
    for ttl, firsts in ((None, [1, 3, 5, 6, 8]), ("7 days", [1, 3, 5, 6, 8, 9])):
        base = tmp_path / str(ttl)
        for rows in deliveries:
            frame = spark.createDataFrame(rows, "rdi string, seq bigint, url string, at string")
            frame = frame.selectExpr("rdi", "seq", "url", "CAST(at AS TIMESTAMP) AS landed_at")
            frame.coalesce(1).write.mode("append").parquet(str(base / "in"))
            stream = flows.stream_flags(flows.stream_landed(spark, str(base / "in"), schema), ttl)
            write = lambda batch, n, base=base: batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={n}")
            flows.run_available(stream, write, str(base / "state"))
        out = spark.read.schema("rdi string, seq bigint, url string, is_duplicate boolean").parquet(str(base / "out")).collect()
        assert sorted(r.seq for r in out) == list(range(1, 11))
        assert sorted(r.seq for r in out if not r.is_duplicate) == firsts


def _documents(spark, path, *rows):
    """A folder of driver tables that holds these documents (``doc_id, lang``)."""
    frame = spark.createDataFrame(rows, "doc_id bigint, lang string")
    path.mkdir(exist_ok=True)
    frame.selectExpr("doc_id", "'a text' AS text", "lang", "'src1' AS source", "6L AS n_chars").toPandas().to_parquet(path / "documents.parquet")
    return str(path)


def test_a_repository_without_errors_counts_none(spark, tmp_path):
    from oracle import differences, duck
    from sheafline.checks import CHECKS

    tables = _documents(spark, tmp_path / "in", (1, "xx"), (2, "en"), (15, "en"), (6, "yy"), (6, "yy"))
    check = CHECKS["stream_pages"]
    out = check.run(spark, tables)
    assert not differences(out, duck(tables), check.sql)
    assert {(r.rdi, r.kind): r.n for r in out.collect()}[("xx", "error")] == 0


def test_files_of_large_page_numbers_are_read(spark, tmp_path):
    from oracle import differences, duck
    from sheafline.checks import CHECKS

    ids = [3, 101, 102, 419_430_399, 419_430_400, 419_430_401, 7_000_000_012, 7_000_000_013, 214_748_364_799]
    tables = _documents(spark, tmp_path / "in", *[(k, "en") for k in ids])
    check = CHECKS["stream_raw_xml"]
    assert not differences(check.run(spark, tables), duck(tables), check.sql)


def test_a_place_beyond_its_bits_is_an_error(spark, tmp_path):
    (tmp_path / "page-5.xml").write_text("<r>" + "<MD_Metadata></MD_Metadata>" * 20 + "</r>")
    out = lambda bits: flows.chunk_outcomes(flows.raw_chunks(spark.read, str(tmp_path), "MD_Metadata"), "r", "http://c", "MD_Metadata", offset_bits=bits)
    assert sorted((r.seq >> 5, r.seq % 32) for r in out(5).select("seq").collect()) == [(5, k) for k in range(1, 21)]
    with pytest.raises(Exception, match="Place in a file out of range: .*page-5.xml"):
        out(4).select("seq").collect()


def test_flags_of_many_urls_share_few_state_entries(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.range(40_000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 'r' || id % 3 END AS rdi", "id AS seq", "'u' || id % 20000 % 17001 AS url", "id DIV 30000 AS part"
    )
    for part in range(2):
        rows.where(F.col("part") == part).drop("part").write.mode("append").parquet(f"{base}/in")
        stream = flows.stream_flags(flows.stream_landed(spark, f"{base}/in", "rdi string, seq bigint, url string"))
        write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={n}")
        query = flows.run_available(stream, write, f"{base}/state")
    out = spark.read.schema("rdi string, seq bigint, url string, is_duplicate boolean").parquet(f"{base}/out")
    firsts = {r.seq for r in rows.groupBy("rdi", "url").agg(F.min("seq").alias("seq")).collect()}
    got = [(r.seq, r.is_duplicate) for r in out.select("seq", "is_duplicate").collect()]
    assert sorted(got) == [(k, k not in firsts) for k in range(40_000)]
    entries = [o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]]
    assert 0 < max(entries) <= flows.FLAG_BUCKETS < len(firsts)


def test_urls_of_one_bucket_expire_alone(spark, tmp_path):
    base = str(tmp_path)
    # The last sighting counts: "a" is seen on days 1 and 6, "b" on day 1 only; on day 12 one of them has expired.
    for k, rows in enumerate(([("a", 1), ("b", 1)], [("a", 6)], [("c", 12)], [("a", 12), ("b", 12)], [("d", 40)], [("a", 40), ("b", 40), (None, 40)])):
        frame = spark.createDataFrame([("r", 10 * k + n, *row) for n, row in enumerate(rows)], "rdi string, seq bigint, url string, day int")
        frame = frame.selectExpr("rdi", "seq", "url", "timestamp_seconds(86400L * day) AS landed_at")
        frame.coalesce(1).write.mode("append").parquet(f"{base}/in")
        landed = flows.stream_landed(spark, f"{base}/in", "rdi string, seq bigint, url string, landed_at timestamp")
        write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={n}")
        flows.run_available(flows.stream_flags(landed, "7 days", buckets=1), write, f"{base}/state")
    out = spark.read.schema("rdi string, seq bigint, url string, is_duplicate boolean").parquet(f"{base}/out").collect()
    assert sorted(r.seq for r in out if r.is_duplicate) == [10, 30]
    assert sorted(r.seq for r in out if not r.is_duplicate) == [0, 1, 20, 31, 40, 50, 51, 52]


def test_reconcile_ignores_what_was_not_committed_and_replaces_what_is_run_again(spark, tmp_path):
    base = str(tmp_path)
    arc = lambda i: '{"@graph":[{"@id":"./","identifier":"%s"}]}' % i
    rows = [
        ("r", 1, "arc", arc("a"), None, "u1", None, None, None),
        ("r", 2, "arc", arc("a"), None, "u2", None, None, None),
        ("r", 3, "error", None, "x", "u3", "bad", None, None),
        ("r", 4, "upload", None, None, None, "twice", "DUPLICATE", "a"),
        ("s", 5, "skip", None, None, "u", None, None, None),
        ("t", 6, "upload", None, None, None, "refused", "INVALID", None),
    ]
    batch = spark.createDataFrame(rows, reconcile.MIXED)
    publish = reconcile.reconcile_into(base)
    for number in (0, 1, 1):
        publish(batch.where("seq < 4") if number == 0 else batch.where("seq >= 4"), number)
    # A batch that died before its commit left these behind.
    stray = spark.createDataFrame([("r", "a", 9, "{}")], reconcile.TABLES["objects"])
    stray.write.parquet(f"{base}/objects/batch_id=2")
    counts = {r.rdi: (r.harvested, r.failed, r.skipped) for r in reconcile.reconciled_counts(spark, base).collect()}
    assert counts == {"r": (1, 2, 0), "s": (None, None, 1)}
    assert [(r.arc_id, r.arc_json, r.batch_id) for r in reconcile.current_objects(spark, base).collect()] == [("a", arc("a"), 0)]
    errors, urls = reconcile.reconciled_errors(spark, base)
    assert {(r.seq, r.message, r.n_urls) for r in errors.collect()} == {(4, "twice — source URLs:", 2), (6, "refused", 0)}
    assert [r.url for r in urls.orderBy("rn").collect()] == ["u1", "u2"]
    publish(batch.where("seq < 0"), 3)
    assert reconcile.reconciled_counts(spark, base).count() == 2


def test_no_file_name_or_broken_record_stops_a_raw_stream(spark, tmp_path):
    record = "<MD_Metadata><fileIdentifier><CharacterString>{}</CharacterString></fileIdentifier>{}</MD_Metadata>"
    files = {
        "page-1.xml": "<r>" + record.format("a", "") + "<!-- <MD_Metadata> -->" + record.format("b", "<open>") + record.format("c", "") + "</r>",
        "page-2.xml": "<r>" + record.format("d", "") + record.format("e", "")[:60],
        "stray.xml": "<r>" + record.format("f", "") + "</r>",
        "page-99999999999999999999.xml": "<r>" + record.format("g", "") + "</r>",
        "page-3.xml": "",
    }
    (tmp_path / "in").mkdir()
    for name, body in files.items():
        (tmp_path / "in" / name).write_text(body)
    publish = flows.publish_into(str(tmp_path / "out"))
    handle = lambda batch, n: publish(flows.chunk_outcomes(batch, "r", "http://c", "MD_Metadata"), n)
    chunks = flows.raw_chunks(spark.readStream, str(tmp_path / "in"), "MD_Metadata")
    flows.run_available(chunks, handle, str(tmp_path / "state"))
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("seq").collect()
    placed = [(r.seq >> 41, r.message.split()[0] if r.record_id.startswith("owslib") else r.record_id) for r in rows if r.seq]
    assert placed == [(1, "a"), (1, "Record"), (1, "c"), (2, "d"), (2, "Record")]
    assert sorted(r.message.rsplit("/", 1)[1] for r in rows if r.seq is None) == ["page-99999999999999999999.xml", "stray.xml"]
    again = flows.chunk_outcomes(flows.raw_chunks(spark.read, str(tmp_path / "in"), "MD_Metadata"), "r", "http://c", "MD_Metadata")
    assert again.count() == len(rows)


def test_bodies_without_page_number_are_errors(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "page.xml").write_text("<r/>")
    stream = flows.stream_record_outcomes(flows.stream_bodies(spark, str(tmp_path / "in"), "r", "http://c"))
    flows.run_available(stream, flows.publish_into(str(tmp_path / "out")), str(tmp_path / "state"))
    [row] = spark.read.parquet(str(tmp_path / "out")).collect()
    assert row.kind == "error" and row.message.startswith("No page number in") and row.source_url.endswith("page.xml")


def test_late_rows_are_dropped_and_reported(spark, tmp_path):
    queries = []
    for part, rows in enumerate(([("r", "arc", 20), ("r", "arc", 1)], [("r", "skip", 1), ("r", "error", 20)], [("z", "skip", 60)])):
        frame = spark.createDataFrame(rows, "rdi string, kind string, day int").selectExpr(
            "rdi", "kind", "timestamp_seconds(86400L * day) AS landed_at"
        )
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = flows.stream_landed(spark, str(tmp_path / "in"), "rdi string, kind string, landed_at timestamp")
        write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id={n}")
        queries.append(flows.run_available(flows.stream_window_counts(stream, "1 day", "3 days"), write, str(tmp_path / "state")))
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.rdi, r.window_start.day, r.harvested, r.failed, r.skipped) for r in out} == {("r", 2, 1, 0, 0), ("r", 21, 1, 1, 0)}
    dropped = [sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in p["stateOperators"]) for q in queries]
    assert dropped == [0, 1, 0]


@pytest.mark.parametrize("count", [40_000])
def test_a_comment_does_not_make_the_cut_quadratic(spark, count):
    record = "<MD_Metadata><a>text</a><a>text</a></MD_Metadata>"
    sized = lambda head: spark.range(1).select(
        F.size(iso.record_pieces(F.concat(F.lit(f"<r>{head}"), F.repeat(F.lit(record), count), F.lit("</r>")))).alias("n")
    )
    seconds = []
    for head in ("", "<!-- <MD_Metadata> -->", "<![CDATA[<MD_Metadata>]]>"):
        sized(head).first()
        start = time.perf_counter()
        assert sized(head).first().n == count
        seconds.append(time.perf_counter() - start)
    assert max(seconds[1:]) < 2 * seconds[0] + 1


def test_record_cut_around_comments(spark):
    bodies = [
        "<r><!-- <MD_Metadata> --><g:MD_Metadata a='1'>x<!-- <MD_Metadata>y --></g:MD_Metadata> t <MD_Metadata/></r>",
        "<r><MD_Metadata><![CDATA[<MD_Metadata>]]>q<MD_Metadata>z</MD_Metadata></r>",
        "<r><MD_Metadata>a</MD_Metadata><!-- open <MD_Metadata>b</MD_Metadata></r>",
        "<r><MD_MetadataX>no</MD_MetadataX><!-- --></r>",
    ]
    rows = spark.createDataFrame([(b,) for b in bodies], "b string").select(iso.record_pieces(F.col("b")).alias("p")).collect()
    assert [r.p for r in rows] == [
        ["<g:MD_Metadata a='1'>x<!-- <MD_Metadata>y --></g:MD_Metadata>", "<MD_Metadata/>"],
        ["<MD_Metadata><![CDATA[<MD_Metadata>]]>q", "<MD_Metadata>z</MD_Metadata>"],
        ["<MD_Metadata>a</MD_Metadata><!-- open <MD_Metadata>b</MD_Metadata>"],
        [],
    ]


def test_repositories_run_side_by_side_and_fail_alone(spark, tmp_path, monkeypatch):
    """Both sources wait for each other, so this ends only if they run at the same time."""
    meet = threading.Barrier(2, timeout=60)

    def waiting(df):
        meet.wait()
        return outcomes.to_outcomes(df, rdi=F.col("rdi"), seq=F.col("seq"), kind=F.lit("skip"))

    def broken(df):
        raise KeyError("first line\nsecond line")

    monkeypatch.setitem(SOURCES._entries, "waiting", waiting)
    monkeypatch.setitem(SOURCES._entries, "broken", broken)
    landed = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "rdi string, seq bigint")
    configured = [registry.Repository(r, t, landed) for r, t in (("b", "waiting"), ("c", "broken"), ("x", "ftp"), ("a", "waiting"))]
    out, rows = registry.run_repositories(configured, str(tmp_path))
    assert sorted((r.rdi, r.seq) for r in out.collect()) == [("a", 1), ("b", 2)]
    got = [(r.rdi, r.harvest_started, r.crashed, r.message) for r in rows.orderBy("repo_no").collect()]
    assert got == [("b", True, False, None), ("c", True, True, "KeyError: 'first line\\nsecond line'"), ("x", False, False, None), ("a", True, False, None)]
    assert [r.message for r in registry.crashed_runs(rows).collect()] == [got[1][3]]
    counts = {r.rdi: (r.harvested, r.failed, r.skipped) for r in outcomes.finalize_counts(rows, outcomes.harvest_counts(out)).collect()}
    assert counts == {"b": (0, 0, 1), "c": (0, None, 0), "x": (None, None, 0), "a": (0, 0, 1)}


def test_publishing_again_writes_nothing(spark, tmp_path):
    arc = lambda i, x: '{"@graph":[{"@id":"./","identifier":"%s","x":%d}]}' % (i, x)
    rows = lambda *objects: spark.createDataFrame([("r", k, "arc", arc(*o)) for k, o in enumerate(objects)], "rdi string, seq bigint, kind string, arc_json string")
    path = str(tmp_path)
    published = lambda df, v: sorted((r.arc_id, r.change) for r in sinks.publish_arcs(df, path, v).collect())
    one = rows(("a", 1), ("b", 1), ("a", 2))
    assert published(one, 0) == [("a", "created"), ("b", "created")]
    assert published(one, 1) == []
    two = rows(("b", 9), ("c", 1), ("a", 2))
    for _ in range(2):  # a repeated run under one version changes nothing
        assert published(two, 2) == [("b", "updated"), ("c", "created")]
    assert published(rows(("b", 1)), 3) == [("b", "updated")]
    assert {(r.arc_id, r.version) for r in sinks.current_arcs(spark, path).collect()} == {("a", 0), ("b", 3), ("c", 2)}
    assert sinks.published(spark, path).count() == 5


def test_a_report_that_cannot_be_written_does_not_raise(spark, tmp_path):
    bad = spark.range(1).selectExpr("id repo_no", "0 section", "id seq", "id part", "raise_error('no text') line")
    assert "no text" in sinks.write_report(bad.selectExpr("repo_no", "section", "seq", "part", "CAST(line AS STRING) line"), str(tmp_path / "r"))


def test_raw_files_stream_into_outcomes(spark, tmp_path):
    for page, ident in ((1, "a"), (2, "b")):
        record = f"<MD_Metadata><fileIdentifier><CharacterString>{ident}</CharacterString></fileIdentifier></MD_Metadata>"
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"page-{page}.xml").write_text(f"<r>{record}</r>")
    stream = flows.stream_record_outcomes(flows.stream_bodies(spark, str(tmp_path / "in"), "r", "http://c"))
    flows.run_available(stream, flows.publish_into(str(tmp_path / "out")), str(tmp_path / "state"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["rdi"], r["seq"] >> 32, r["record_id"]) for r in rows) == [("r", 1, "a"), ("r", 2, "b")]


def test_catalogue_harvest_covers_pages_in_proportion_to_the_table(spark, sf_dir):
    from sheafline.checks import CHECKS

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    pages = lambda name: CHECKS[name].run(spark, sf_dir).select("batch").distinct().count()
    assert pages("harvest_catalogue_whole") > 0.9 * docs
    assert 0.25 * docs < pages("harvest_catalogue_cuts") < 0.75 * docs


def test_many_blocks_are_read_by_few_tasks_in_their_places(spark, tmp_path):
    record = "<MD_Metadata><fileIdentifier><CharacterString>{}</CharacterString></fileIdentifier></MD_Metadata>"
    (tmp_path / "page-1.xml").write_text("<r>" + "".join(record.format(f"d{k:04d}") for k in range(2000)) + "</r>")
    block = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        chunks = flows.raw_chunks(spark.read, str(tmp_path), "MD_Metadata")
        blocks = chunks.rdd.getNumPartitions()
        out = flows.chunk_outcomes(chunks, "r", "http://c", "MD_Metadata")
        tasks, ids = out.rdd.getNumPartitions(), [r.record_id for r in out.select("seq", "record_id").orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    assert blocks > 64 and tasks <= 64
    assert ids == [f"d{k:04d}" for k in range(2000)]


def test_written_folders_do_not_grow_with_repositories(spark, tmp_path):
    named = F.concat(F.lit("r/"), F.col("id").cast("string"))
    out = spark.range(300).select(
        named.alias("rdi"), F.col("id").alias("seq"), F.lit("arc").alias("kind"), F.format_string('{"n":%d}', "id").alias("arc_json"),
        named.alias("identifier"), F.lit("<x/>").cast("binary").alias("raw_xml"),
    )
    sinks.write_arcs(out, str(tmp_path / "arcs"))
    sinks.write_archive(out, str(tmp_path / "archive"))
    flows.publish_into(str(tmp_path / "stream"))(out, 0)
    folders = [sum(p.is_dir() for p in (tmp_path / n).iterdir()) for n in ("arcs", "archive", "stream/batch_id=0")]
    assert max(folders) <= 32, folders
    want = sorted(f"r/{k}" for k in range(300))
    for df in (sinks.read_arcs(spark, str(tmp_path / "arcs")), *[spark.read.parquet(str(tmp_path / n)) for n in ("archive", "stream")]):
        assert sorted(r.rdi for r in df.select("rdi").collect()) == want
        assert [r.rdi for r in sinks.of_repository(df, "r/7").select("rdi").collect()] == ["r/7"]


def test_any_repository_name_and_document_comes_back_as_written(spark, tmp_path):
    rows = [(rdi, "arc", arc) for rdi in ("a", "", None, "7", "x=1/ü\n") for arc in ('{"a": "é\\n"}', '{\n "a":\r\n 1}', "", None, "no {json", '{"a":1}', '{"a":1}')]
    df = spark.createDataFrame([*rows, ("a", "skip", "{}")], "rdi string, kind string, arc_json string")
    for rebalance in (True, False):
        sinks.write_arcs(df, str(tmp_path), rebalance=rebalance)
        back = [(r.rdi, "arc", r.arc_json) for r in sinks.read_arcs(spark, str(tmp_path)).collect()]
        assert sorted(back, key=repr) == sorted(rows, key=repr)
    sinks.write_arcs(df, str(tmp_path), mode="append")
    assert sinks.of_repository(sinks.read_arcs(spark, str(tmp_path)), "").count() == 14


def test_a_document_longer_than_the_json_reader_expects_comes_back(spark, tmp_path):
    df = spark.sql("SELECT 'a' AS rdi, 'arc' AS kind, repeat('x', 20000001) AS arc_json")
    sinks.write_arcs(df, str(tmp_path))
    assert [r.n for r in sinks.read_arcs(spark, str(tmp_path)).select(F.length("arc_json").alias("n")).collect()] == [20000001]
