"""Sitemap documents -> dataset URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sheafline.functions.text import strip
from sheafline.operators.once import compute_once
from sheafline.session import cut_lineage, scratch_path

_XML_OPTIONS = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE"}
# First element after the prolog, comments and processing instructions.
_ROOT = r"(?s)\A\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*|<![^>]*>\s*)*<(?:[\w.-]+:)?([\w.-]+)"
# Text of every location element at any depth, in any namespace, up to its first child element.
_LOC = r"(?s)<(?:[\w.-]+:)?loc(?:\s[^>]*)?(?<!/)>((?:[^<]++|<!\[CDATA\[.*?\]\]>)*+)"


def sitemap_root(body: Column) -> Column:
    """Local name of the root element; empty when there is none."""
    return F.regexp_extract(body, _ROOT, 1)


def sitemap_error(body: Column) -> Column:
    """Message for a document that is neither a URL set nor a sitemap index, else null."""
    root = sitemap_root(body)
    malformed = F.from_xml(body, "_corrupt_record string", _XML_OPTIONS)["_corrupt_record"].isNotNull()
    return F.when((root == "") | malformed, F.lit("Sitemap is not well-formed XML")).when(
        ~root.isin("urlset", "sitemapindex"), F.concat(F.lit("Unsupported sitemap root element: "), root)
    )


def locations(body: Column) -> Column:
    """Trimmed texts of the location elements, entities resolved; empty elements are left out."""
    found = F.regexp_extract_all(F.regexp_replace(body, "(?s)<!--.*?-->", ""), F.lit(_LOC), F.lit(1))
    return F.transform(
        F.filter(found, lambda t: t != ""),
        lambda t: strip(
            F.when(
                t.contains("&") | t.contains("<"),
                F.from_xml(F.concat(F.lit("<l><t>"), t, F.lit("</t></l>")), "t string", _XML_OPTIONS)["t"],
            ).otherwise(t)
        ),
    )


def _locs(docs: DataFrame, root: str, keep: list[str]) -> DataFrame:
    read = compute_once(
        docs.filter(sitemap_root(F.col("body")) == root),
        keep,
        __error=sitemap_error(F.col("body")),
        __locs=locations(F.col("body")),
    )
    return read.filter("__error IS NULL").select(*keep, F.posexplode("__locs").alias("pos", "loc"))


def read_urlset(docs: DataFrame) -> DataFrame:
    """``sitemap_url, pos, url`` of every location in the URL sets among ``docs`` (``sitemap_url, body``)."""
    keep = [c for c in docs.columns if c != "body"]
    return _locs(docs, "urlset", keep).withColumnRenamed("loc", "url")


def sitemap_errors(docs: DataFrame) -> DataFrame:
    """Documents that are malformed or have an unsupported root."""
    read = compute_once(docs, ["sitemap_url"], message=sitemap_error(F.col("body")))
    return read.filter("message IS NOT NULL")


def expand_sitemaps(roots: DataFrame, docs: DataFrame) -> DataFrame:
    """Documents reachable from each root through sitemap indexes: ``root, sitemap_url, depth``.

    One join round per level against the links of the index documents; a document already reached from
    the same root is not visited again, so cycles and self-links end. Links are written to the shared folder once:
    XML is parsed once. Every level is a partition of one table there, its rows counted as they are written: lineage
    and plan stay the same at any depth, and no level is rewritten.
    Spark sends a level to every executor when its measured size is small.
    """
    spark = docs.sparkSession
    links = cut_lineage(
        _locs(docs, "sitemapindex", ["sitemap_url"]).select("sitemap_url", F.col("loc").alias("child")).distinct()
    )
    levels = scratch_path(spark, "levels")
    nodes = roots.select(F.col("root"), F.col("root").alias("sitemap_url")).distinct()
    schema, depth = "root string, sitemap_url string, depth int", 0
    while _written(nodes, f"{levels}/depth={depth}"):
        reached = spark.read.schema(schema).parquet(levels)
        nodes = (
            reached.where(F.col("depth") == depth)
            .join(links, "sitemap_url")
            .select("root", F.col("child").alias("sitemap_url"))
            .distinct()
            .join(reached, ["root", "sitemap_url"], "left_anti")
        )
        depth += 1
    return spark.read.schema(schema).parquet(levels)


def _written(df: DataFrame, path: str) -> int:
    """Write a table and return its number of rows; metrics of a plan that proved empty may be missing."""
    rows = Observation()
    df.observe(rows, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return rows.get.get("n", 0)


def discover_sitemap_urls(roots: DataFrame, docs: DataFrame) -> DataFrame:
    """Every location in a URL set reachable from a root: ``root, sitemap_url, depth, pos, url``."""
    visited = expand_sitemaps(roots, docs)
    return read_urlset(docs).join(visited, "sitemap_url").select("root", "sitemap_url", "depth", "pos", "url")
