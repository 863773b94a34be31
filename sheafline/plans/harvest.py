"""The two ways in, end to end: a catalogue harvest and a sitemap harvest over landed responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.operators.dedup import dedup_urls, duplicate_outcomes
from sheafline.operators.fallback import apply_id_fallback
from sheafline.operators.outcomes import to_outcomes
from sheafline.operators.paging import batch_counts, limit_pages, pages_read
from sheafline.operators.scan import arrival_ordinal, ordinal_block, ordinal_width
from sheafline.plans.graph_arc import graph_outcomes
from sheafline.plans.record_arc import record_outcomes
from sheafline.session import cut_lineage
from sheafline.sources.iso import page_header, parse_records, read_brief_ids, record_pieces, split_records
from sheafline.sources.jsonld import block_graphs, page_blocks
from sheafline.sources.sitemap import discover_sitemap_urls


def harvest_catalogue(
    landed: DataFrame,
    brief: DataFrame | None = None,
    predicate: Column | None = None,
    max_records: int | None = None,
) -> DataFrame:
    """Landed catalogue responses (``rdi, base_url, batch, body``) -> outcomes.

    Pages are read up to the announced total or the first empty one. A good record must meet ``predicate``; errors
    stay. With ``max_records``, pages count until that many good records are reached. ``brief`` (``rdi, batch,
    body``) holds brief responses of the same pages: their unused identifiers name the nameless errors of a page.
    """
    bodies = landed.select("rdi", "base_url", "batch", "body")
    sizes = cut_lineage(
        bodies.select(
            "rdi", "batch", F.size(record_pieces(F.col("body"))).alias("n_rows"), page_header(F.col("body")).alias("matches")
        )
    )
    block = ordinal_block(F.col("batch"), ordinal_width(sizes, "batch"))
    read = pages_read(sizes, block).select("rdi", "batch")
    parsed = parse_records(split_records(bodies.join(read, ["rdi", "batch"], "left_semi")))
    if predicate is not None:
        parsed = parsed.where(F.col("error").isNotNull() | predicate)
    if max_records is not None:
        # Parsing costs most; the limit reads the counts of all pages before it can drop one.
        parsed = cut_lineage(parsed)
        counts = batch_counts(parsed.select("rdi", "batch", F.col("error").isNull().alias("ok")))
        parsed = parsed.join(limit_pages(counts, max_records, block).select("rdi", "batch"), ["rdi", "batch"], "left_semi")
    if brief is not None:
        errors, good = parsed.where("error IS NOT NULL"), parsed.where("error IS NULL")
        parsed = good.unionByName(apply_id_fallback(errors, read_brief_ids(brief), good))
    numbered = parsed.withColumn("seq", arrival_ordinal(F.col("batch"), F.col("pos")))
    return record_outcomes(numbered, F.col("base_url"))


def discovered_urls(roots: DataFrame, sitemaps: DataFrame) -> DataFrame:
    """``rdi, seq, url, is_duplicate`` of every location in the sitemaps reachable from each repository's root.

    ``roots``: ``rdi, root``; ``sitemaps``: ``sitemap_url, batch, body`` with ``batch`` the order of landing.
    """
    found = discover_sitemap_urls(roots.select("root"), sitemaps.select("sitemap_url", "body"))
    order = sitemaps.select("sitemap_url", "batch")
    listed = found.join(order, "sitemap_url").join(roots, "root")
    numbered = listed.select("rdi", arrival_ordinal(F.col("batch"), F.col("pos")).alias("seq"), "url")
    return dedup_urls(cut_lineage(numbered), mode="flag")


def harvest_sitemap(roots: DataFrame, sitemaps: DataFrame, pages: DataFrame) -> DataFrame:
    """Sitemaps and landed pages (``url, body``) -> outcomes.

    A location listed again is a skip, a location without a landed page an error; the others are read and mapped.
    """
    flagged = discovered_urls(roots, sitemaps)
    wanted = flagged.where("NOT is_duplicate").select("rdi", "seq", "url")
    bodies = pages.select("url", F.col("body").alias("html"))
    read = page_blocks(bodies.join(wanted, "url").select("rdi", "seq", "url", "html"))
    missing = wanted.join(pages.select("url"), "url", "left_anti")
    lost = to_outcomes(
        missing,
        rdi=F.col("rdi"),
        seq=F.col("seq"),
        kind=F.lit("error"),
        source_url=F.col("url"),
        message=F.concat(F.lit("No page was landed for "), F.col("url")),
    )
    return graph_outcomes(block_graphs(read)).unionByName(lost).unionByName(duplicate_outcomes(flagged))
