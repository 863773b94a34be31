"""Reading sitemaps, search pages, JSON-LD pages and catalogue responses."""

import json

import pytest
from pyspark.sql import functions as F

from sheafline.plans.graph_arc import graph_outcomes, map_graphs
from sheafline.sources import iso, jsonld, sitemap, solr

_OPEN = '<script type="application/ld+json">'


def pages(spark, *htmls):
    return spark.createDataFrame([("r", i, f"http://h/{i}", h) for i, h in enumerate(htmls)], "rdi string, seq bigint, url string, html string")


def graph_rows(spark, *htmls):
    return [r.asDict() for r in jsonld.page_graphs(pages(spark, *htmls)).orderBy("seq").collect()]


def test_script_blocks(spark):
    html = (
        f"<!-- {_OPEN}{{1}}</script> --><script>'<!--'</script>{_OPEN}{{a}}</script>"
        "<SCRIPT id='x>y' TYPE=\"application/ld+json\">{b}</SCRIPT ><script type=application/ld+json>{c}</script>"
        '<script type="Application/ld+json">{d}</script><script type="application/ld+json;v=1">{e}</script>'
        f"{_OPEN}</script>{_OPEN}{{open}}"
    )
    rows = jsonld.read_jsonld_blocks(pages(spark, html)).orderBy("block_no").collect()
    assert [r["json"] for r in rows] == ["{a}", "{b}", "{c}", ""]


def test_graph_errors(spark):
    none, bad, tail, deep, remote = graph_rows(
        spark,
        "<p>",
        f"{_OPEN}not json</script>",
        f'{_OPEN}{{"a":1}} x</script>',
        f"{_OPEN}" + '{"@context":"https://schema.org","a":' * 30 + "1" + "}" * 30 + "</script>",
        f'{_OPEN}{{"@context":"http://elsewhere/ctx"}}</script>',
    )
    assert none["graph_error"] == "No JSON-LD blocks found in HTML at: http://h/0"
    assert "not json" in bad["graph_error"] and bad["graph"] is None
    assert "Invalid JSON" in tail["graph_error"]
    assert deep["graph_error"] is None and len(deep["graph"]) == 30
    assert "context" in remote["graph_error"]


def test_raw_control_characters_are_read(spark):
    (row,) = graph_rows(spark, f'{_OPEN}{{"@context":"https://schema.org","@id":"x","name":"a\nb\tc"}}</script>')
    assert row["graph"]["x"]["http://schema.org/name"][0]["o"] == "a\nb\tc"


def test_merge_removes_repeats_and_aliases_work(spark):
    block = json.dumps(
        {
            "@context": {"@vocab": "https://schema.org/", "id": "@id", "dct": "http://purl.org/dc/terms/", "label": "schema:name", "schema": "http://schema.org/"},
            "id": "x",
            "name": {"@set": ["n", "n"]},
            "dct:title": {"@value": "t"},
            "label": "l",
            "n": [1, 2.5, True, None],
        }
    )
    (row,) = graph_rows(spark, f"{_OPEN}{block}</script>{_OPEN}{block}</script>")
    flat = {p: [o["o"] for o in objects] for p, objects in row["graph"]["x"].items()}
    assert flat == {
        "https://schema.org/name": ["n"],
        "http://purl.org/dc/terms/title": ["t"],
        "http://schema.org/name": ["l"],
        "https://schema.org/n": ["1", "2.5", "true"],
    }


def test_node_names(spark):
    block = json.dumps(
        {
            "@context": {"@vocab": "http://schema.org/", "id": "@id", "type": "@type"},
            "id": "x", "type": "Dataset", "creator": {"id": "#a", "name": "A"}, "author": {"@id": "_:b1"}, "about": {"name": "C"},
            "@graph": [{"@id": "_:b1", "name": "B"}],
        }
    )
    html = f"{_OPEN}{block}</script>"
    (row,) = graph_rows(spark, html)
    own = {p.rsplit("/", 1)[-1]: [(o["kind"], o["o"]) for o in objects] for p, objects in row["graph"]["x"].items()}
    assert own["creator"] == [("iri", "#a")]
    (kind, label), (_, place) = own["author"][0], own["about"][0]
    assert kind == "bnode" and label.endswith("-b1") and place.endswith("-about-0")
    keys = jsonld.page_graphs(pages(spark, html)).select(F.map_keys("graph")).collect()[0][0]
    assert keys == ["x", "#a", place, label]


def test_full_graph(spark):
    block = {
        "@context": {"@vocab": "https://schema.org/"},
        "@graph": [
            {"@id": "#pub", "@type": "Organization", "name": "Pub"},
            {
                "@id": "10.1234/abc", "@type": "Dataset", "name": "Full", "creator": "C", "author": ["C", {"name": "Ann Lee"}, {"name": "Ann Lee"}],
                "contributor": "D", "publisher": {"@id": "#pub"}, "keywords": ["k1", "k2"], "license": "CC", "inLanguage": "en", "url": "http://u",
                "conformsTo": "p", "citation": "cited", "distribution": {"encodingFormat": "csv", "contentUrl": "http://f"},
            },
        ],
    }
    html = f"{_OPEN}{json.dumps(block)}</script>"
    row = map_graphs(jsonld.page_graphs(pages(spark, html))).collect()[0]
    inv = row["investigation"]
    assert inv["identifier"] == "10.1234/abc"
    assert [(p["first_name"], p["last_name"], p["roles"][0]["name"]) for p in inv["contacts"]] == [
        ("", "C", "author"), ("", "C", "author"), ("Ann", "Lee", "author"), ("", "D", "contributor"), ("", "Pub", "publisher"),
    ]
    assert [(p["title"], p["doi"]) for p in inv["publications"]] == [("Full", "10.1234/abc"), ("cited", None)]
    assert [c["name"] for c in inv["comments"]] == ["Keywords", "License", "Language", "URL", "Conforms To", "Distribution"]
    assert [t["name"] for t in row["study"]["tables"]] == ["Data Collection", "Data Processing"]
    out = graph_outcomes(jsonld.page_graphs(pages(spark, html, "<p>"))).orderBy("seq").collect()
    assert [o["kind"] for o in out] == ["arc", "error"]
    root = next(n for n in json.loads(out[0]["arc_json"])["@graph"] if n["@id"] == "./")
    assert root["identifier"] == "10.1234/abc"


def test_sitemap_tree_with_cycles(spark):
    def index(*locs):
        return "<sitemapindex>" + "".join(f"<sitemap><loc> {x} </loc></sitemap>" for x in locs) + "</sitemapindex>"

    docs = spark.createDataFrame(
        [
            ("root", index("root", "child", "missing")),
            ("child", index("root", "leaf", "child")),
            ("leaf", "<urlset xmlns='n'><url><loc>http://d/1</loc></url><url><loc> </loc></url><url><loc>http://d/1</loc></url></urlset>"),
            ("other", "<urlset><url><loc>http://d/2</loc></url></urlset>"),
        ],
        "sitemap_url string, body string",
    )
    roots = spark.createDataFrame([("root",)], "root string")
    seen = {(r["sitemap_url"], r["depth"]) for r in sitemap.expand_sitemaps(roots, docs).collect()}
    assert seen == {("root", 0), ("child", 1), ("missing", 1), ("leaf", 2)}
    urls = [r["url"] for r in sitemap.discover_sitemap_urls(roots, docs).orderBy("pos").collect()]
    assert [u for u in urls if u] == ["http://d/1", "http://d/1"]


def test_locations_at_any_depth(spark):
    body = (
        "<s:urlset xmlns:s='s' xmlns:i='i'><!-- <loc>no</loc> --><s:url><s:loc>http://d/1?a=1&amp;b=2</s:loc><i:image><i:loc>http://d/i</i:loc></i:image>"
        "</s:url><url><loc a='1'><![CDATA[http://d/<2>]]></loc></url><url><loc/></url><location>x</location></s:urlset>"
    )
    docs = spark.createDataFrame([("a", body)], "sitemap_url string, body string")
    assert [r["url"] for r in sitemap.read_urlset(docs).orderBy("pos").collect()] == ["http://d/1?a=1&b=2", "http://d/i", "http://d/<2>"]


def test_sitemap_errors(spark):
    docs = spark.createDataFrame([("a", "<feed/>"), ("b", "<urlset>"), ("c", "<urlset/>")], "sitemap_url string, body string")
    got = {r["sitemap_url"]: r["message"] for r in sitemap.sitemap_errors(docs).collect()}
    assert got["a"] == "Unsupported sitemap root element: feed"
    assert "b" in got and "c" not in got


def test_solr_pages(spark):
    bodies = [
        json.dumps({"response": {"numFound": 3, "start": 0, "docs": [{"id": "0001"}, {"id": " "}, {"id": 7}, "x", {"id": "0002"}]}}),
        json.dumps({"response": {"numFound": "3", "start": 0, "docs": []}}),
        json.dumps({"response": {"numFound": 3, "docs": []}}),
        json.dumps({"response": {"numFound": 3, "start": 0, "docs": {}}}),
        json.dumps({"response": []}),
        "{",
    ]
    rows = spark.createDataFrame([("r", i, "https://h:1/solr?q", b) for i, b in enumerate(bodies)], "rdi string, batch bigint, url string, body string")
    errors = [r["error"] for r in solr.read_solr(rows).orderBy("batch").collect()]
    assert errors == [
        None, "Missing or invalid response.numFound", "Missing or invalid response.start", "Missing expected response.docs array",
        "Missing Solr response envelope: response", "Missing Solr response envelope: response",
    ]
    assert [r["url"] for r in solr.solr_docs(rows).orderBy("pos").collect()] == ["https://h:1/receive/0001", "https://h:1/receive/0002"]


def test_iso_response_keeps_raw_text_and_isolates_broken_records(spark):
    good = "<gmd:MD_Metadata xmlns:gmd='g'><gmd:fileIdentifier><gco:CharacterString>id</gco:CharacterString></gmd:fileIdentifier></gmd:MD_Metadata>"
    body = f'<r numberOfRecordsMatched="7">{good}<MD_Metadata><x></MD_Metadata></r>'
    df = spark.createDataFrame([("r", 0, body)], "rdi string, batch bigint, body string")
    rows = iso.read_iso(df).orderBy("pos").collect()
    assert [r["error"] for r in rows] == ["Record is missing a title in its identification section.", "Record is not well-formed XML."]
    assert rows[0]["raw_xml"].decode() == good
    assert rows[0]["record_id"] == "id" and rows[1]["record_id"].startswith("owslib_random_")
    assert df.select(iso.page_header(F.col("body")).alias("m")).collect()[0]["m"] == 7


@pytest.mark.parametrize(
    "body,found",
    [
        ("<r><MD_Metadata><fileIdentifier>{good}</r>", [None, "id"]),
        ("<r><g:MD_Metadata/>{good}</r>", [None, "id"]),
        ("<r>{good}<MD_Metadata><fileId", ["id", None]),
        ("<r><!-- <MD_Metadata> -->{good}<!-- </MD_Metadata> --></r>", ["id"]),
        ("<r>{cdata}{good}<![CDATA[ <MD_Metadata/> ]]></r>", ["c<MD_Metadata>", "id"]),
        ("<r/>", []),
        (None, []),
    ],
)
def test_iso_accounts_for_every_element(spark, body, found):
    record = "<MD_Metadata><fileIdentifier><CharacterString>{}</CharacterString></fileIdentifier></MD_Metadata>"
    parts = {"good": record.format("\n  id\n "), "cdata": record.format("<![CDATA[c<MD_Metadata>]]>")}
    df = spark.createDataFrame([("r", 0, body and body.format(**parts))], "rdi string, batch bigint, body string")
    assert [r["identifier"] for r in iso.read_iso(df).orderBy("pos").collect()] == found


def test_iso_files(spark, tmp_path):
    body = "<r><MD_Metadata><fileIdentifier><CharacterString>a</CharacterString></fileIdentifier></MD_Metadata></r>"
    (tmp_path / "1.xml").write_text(body)
    (tmp_path / "2.xml").write_text(body.replace(">a<", ">b<"))
    rows = iso.read_iso_files(spark, str(tmp_path), "r").select("identifier", "batch").collect()
    assert sorted((r["identifier"], r["batch"]) for r in rows) == [("a", 1), ("b", 2)]
    dump = iso.read_iso_dump(spark.read, str(tmp_path), "r").select("identifier", "error").collect()
    assert sorted(r["identifier"] for r in dump) == ["a", "b"]
    assert all("missing a title" in r["error"] for r in dump)
    (tmp_path / "3.xml").write_text("<r><MD_Metadata><dateStamp><Date>2020</Date></dateStamp></MD_Metadata><MD_Metadata/></r>")
    placeholders = [r["record_id"] for r in iso.read_iso_dump(spark.read, str(tmp_path / "3.xml"), "r").collect()]
    assert len(set(placeholders)) == 2
    (tmp_path / "page.xml").write_text(body)
    with pytest.raises(Exception, match="No page number"):
        iso.read_iso_files(spark, str(tmp_path / "page.xml"), "r", r"/([0-9]+)[^/0-9]*$").collect()


def test_first_hits_aggregate_numbers_only(spark):
    rows = [
        ("r", 2, 0, "a", "http://receive/receive/a"), ("r", 1, 5, "a", "http://receive/receive/a"), ("r", 1, 7, "x/receive/\n", "http://h/receive/x/receive/\n"),
        ("s", 3, 1, "a", "http://receive/receive/a"), ("r", 4, 1, "p", None), ("r", 3, 2, "q", None), ("r", 5, 2, "q", None),
        ("t", 0, 0, "n", "http://h/receive/n"), ("t", None, 9, "n", "http://h/receive/n"), ("t", None, 8, "n", "http://h/receive/n"),
    ]
    first = solr.first_hits(spark.createDataFrame(rows, "rdi string, batch bigint, pos int, object_id string, url string"))
    assert first.columns == ["rdi", "batch", "pos", "object_id", "url"]
    assert {tuple(r) for r in first.collect()} == {rows[1], rows[2], rows[3], rows[4], rows[5], rows[9]}
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
