"""Pinned examples of the scalar functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sheafline.functions import terms, text, timefmt
from sheafline.functions.names import split_name, split_name_at_last_blank
from sheafline.plans.record_arc import conformance_status, is_publication_id
from sheafline.sources import iso


def values(spark, fn, items, ddl="string"):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {ddl}")
    return [r[0] for r in rows.select("i", fn(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_slug(spark):
    cases = {
        "Test Dataset": "test_dataset",
        "Dataset-with-dashes": "dataset_with_dashes",
        "Dataset with special chars!@#": "dataset_with_special_chars",
        "": "untitled",
        "http://example.com/dataset": "http_example_com_dataset",
        "***": "",
        "a" * 79 + " b": "a" * 79 + "_",
        "Ümlaut": "mlaut",
    }
    assert values(spark, text.slug, list(cases)) == list(cases.values())
    assert values(spark, text.slug, [None]) == ["untitled"]


def test_split_name(spark):
    cases = {
        "John Doe": ("John", "Doe"),
        "Doe, John": ("John", "Doe"),
        "Jane": ("", "Jane"),
        "": ("", ""),
        "Dr. John Michael Doe": ("John", "Doe"),
        "Maria Garcia Brizuela": ("Maria", "Garcia Brizuela"),
        "Hans-Joachim von Müller": ("Hans-Joachim", "von Müller"),
        "Prof. Dr. Hans von der Leyen": ("Hans", "von der Leyen"),
        "Doe, Dr. John M., PhD": ("John M.", "Doe"),
        "John Q Smith, PhD": ("John Q", "Smith"),
        "Doe,": ("", "Doe"),
        "Dr.": ("", "Dr."),
    }
    assert [tuple(r) for r in values(spark, split_name, list(cases))] == list(cases.values())


def test_split_name_at_last_blank(spark):
    got = values(spark, split_name_at_last_blank, ["A B C", "Solo", ""])
    assert [tuple(r) for r in got] == [("A B", "C"), ("Solo", "Solo"), ("", "")]


def test_float_text(spark):
    numbers = [10.0, 48.5, 1.5e7, 0.0005, 1e16, 1e-5, -2.5e-7, 1.25e15, 0.0, float("inf"), 1.5e300]
    assert values(spark, text.float_text, numbers, "double") == [repr(n) for n in numbers]


def test_parse_numbers(spark):
    assert values(spark, text.parse_float, ["10.1", " 1e3 ", "x", "", "1.5d", "1_0", "nan "])[:6] == [10.1, 1000.0, None, None, None, 10.0]
    assert values(spark, text.parse_int, ["10", " -3 ", "1.0", "", "1e3"]) == [10, -3, None, None, None]


def test_urls(spark):
    assert values(spark, text.url_host, ["http://h:80/x", "//h/x", "h/x", "HTTPS://H?q"]) == ["h:80", None, None, "H"]
    assert values(spark, text.base_url, ["HTTPS://H:1/x"]) == ["https://H:1"]
    assert values(spark, text.url_target, ["http://h", "http://h?q", "http://h/a?b#c"]) == ["/", "/?q", "/a?b"]
    got = values(spark, lambda x: text.solr_page_url(x, F.lit(50)), ["http://h/s?q=*:*&start=3&e=&f=a+b~#z", "http://h/s"])
    assert got == ["http://h/s?q=%2A%3A%2A&e=&f=a+b~&start=50#z", "http://h/s?start=50"]


def test_role_terms(spark):
    got = values(spark, terms.role_term, ["author", "Publisher", "unknownRole", "pointOfContact", "", None])
    assert [g and g["name"] for g in got] == ["Author", "Publisher", "unknownRole", "pointOfContact", None, None]
    assert got[0]["tan"].endswith("NCIT_C70909") and got[2]["tan"] is None


def test_topic_terms(spark):
    rows = values(spark, terms.topic_term, [["biota"], ["oceans", "biota"], ["unknownTopic"], [], None], "array<string>")
    assert [r["name"] for r in rows] == [
        "Biological Measurement", "Oceanographic Measurement", "unknownTopic", "Spatial Data Acquisition", "Spatial Data Acquisition",
    ]


def test_durations_and_stamps(spark):
    assert values(spark, timefmt.iso_duration, [12.3, 0.0, 100.0, 0.000001], "double") == ["PT12.3S", "PT0S", "PT100S", "PT0.000001S"]
    stamps = [dt.datetime(2026, 1, 2, 3, 4, 5), dt.datetime(2026, 1, 2, 3, 4, 5, 60)]
    assert values(spark, timefmt.iso_timestamp, stamps, "timestamp") == ["2026-01-02T03:04:05Z", "2026-01-02T03:04:05.000060Z"]


def test_retry_after(spark):
    now = F.lit("2015-10-21 07:27:00").cast("timestamp")
    items = ["120", " 7 ", "Wed, 21 Oct 2015 07:28:00 GMT", "Wed, 21 Oct 2014 07:28:00 GMT", "21 Oct 2015 09:28:00 +0200", "soon", "", None]
    assert values(spark, lambda x: timefmt.retry_after_seconds(x, now), items) == [120.0, 7.0, 60.0, 0.0, 60.0, None, None, None]


def test_conformance_and_publications(spark):
    assert values(spark, conformance_status, ["true", "PASS", "false", "", None]) == ["PASS", "PASS", "FAIL", "Unknown", "Unknown"]
    assert values(spark, lambda x: is_publication_id(x, F.lit(None).cast("string")), ["10.1234/doi", "not-a-doi", "ISBN:1"]) == [True, True, False]


def test_bounding_box(spark):
    def box(x):
        return iso.bounding_box(x, F.lit("48.0"), F.lit("11.0"), F.lit("49.0"))

    assert values(spark, box, ["10.1", None, "west"]) == [[10.1, 48.0, 11.0, 49.0], None, None]


@pytest.mark.parametrize(("attempt", "delay"), [(1, 1.0), (2, 2.0), (6, 32.0), (20, 600.0)])
def test_backoff(spark, attempt, delay):
    assert values(spark, lambda x: timefmt.backoff(x, jitter=False), [attempt], "int") == [delay]
    jittered = values(spark, lambda x: timefmt.backoff(x, F.lit("k")), [attempt], "int")[0]
    assert min(0.9 * delay, 600) <= jittered <= min(1.1 * delay, 600)
