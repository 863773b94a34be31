"""Search-index pages -> dataset URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.functions.text import base_url, is_filled, receive_url
from sheafline.operators.once import compute_once
from sheafline.operators.scan import arrival_ordinal, ordinal_parts


def _integral(doc: Column, path: str) -> Column:
    """A whole number (or a boolean, which counts as one); null otherwise."""
    v = F.try_variant_get(doc, path, "variant")
    kind = F.schema_of_variant(v)
    return F.when(kind.isin("BIGINT", "BOOLEAN"), F.try_variant_get(doc, path, "bigint"))


def read_solr(pages: DataFrame) -> DataFrame:
    """Envelope of each landed page: input columns, ``num_found, start, docs, error``.

    ``docs`` stays semi-structured: only ids are read from it, and entries may be anything.
    """
    keep = [c for c in pages.columns if c != "body"]
    parsed = compute_once(pages, keep, __v=F.try_parse_json("body"))
    envelope = F.try_variant_get("__v", "$.response", "struct<docs:variant>")
    found = _integral(F.col("__v"), "$.response.numFound")
    start = _integral(F.col("__v"), "$.response.start")
    docs = F.try_variant_get("__v", "$.response.docs", "array<variant>")
    error = (
        F.when(envelope.isNull(), F.lit("Missing Solr response envelope: response"))
        .when(found.isNull(), F.lit("Missing or invalid response.numFound"))
        .when(start.isNull(), F.lit("Missing or invalid response.start"))
        .when(docs.isNull(), F.lit("Missing expected response.docs array"))
    )
    return compute_once(parsed, keep, num_found=found, start=start, docs=docs, error=error)


def solr_docs(pages: DataFrame) -> DataFrame:
    """One row per usable hit: ``rdi, batch, pos, object_id, url``. Blank and non-text ids are passed over.

    ``pages``: ``rdi, batch, url, body``; the hit's landing page is built on the page URL's host.
    """
    with_base = compute_once(pages, pages.columns, __base=base_url(F.col("url")))
    good = read_solr(with_base).filter("error IS NULL")
    ids = F.transform(
        "docs",
        lambda doc: F.when(
            F.schema_of_variant(F.try_variant_get(doc, "$.id", "variant")) == "STRING",
            F.try_variant_get(doc, "$.id", "string"),
        ),
    )
    hits = good.select("rdi", "batch", "__base", F.posexplode(ids).alias("pos", "object_id"))
    return hits.filter(is_filled(F.col("object_id"))).select(
        "rdi", "batch", "pos", "object_id", receive_url(F.col("__base"), F.col("object_id")).alias("url")
    )


def first_hits(hits: DataFrame) -> DataFrame:
    """The first hit of each landing page within its repository; ``hits`` as :func:`solr_docs` yields them.

    A page's hits are its words, so most rows are repeats. What is aggregated is one number, in a hash table: a
    struct with texts would be sorted, and spilled, before the first repeat goes. The object id is read from the URL
    again. A hit whose page URL has no host has no landing page and is told apart by its id; hits without page number
    come first.
    """
    pageless = F.col("batch").isNull()
    firsts = hits.groupBy("rdi", "url", F.when(F.col("url").isNull(), F.col("object_id")).alias("__id")).agg(
        F.min(arrival_ordinal(F.col("batch"), F.col("pos"))).alias("__at"), F.min(F.when(pageless, F.col("pos"))).alias("__pos")
    )
    batch, pos = ordinal_parts(F.col("__at"))
    return firsts.select(
        "rdi",
        F.when(F.col("__pos").isNull(), batch).alias("batch"),
        F.coalesce("__pos", pos).alias("pos"),
        F.coalesce("__id", F.regexp_extract("url", r"(?s)\A[^/]*//[^/]*/receive/(.*)\z", 1)).alias("object_id"),
        "url",
    )
