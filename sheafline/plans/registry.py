"""Pluggable source types, discovery, extraction and mapping: names -> DataFrame transforms."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.operators.dedup import dedup_urls, duplicate_outcomes
from sheafline.plans.graph_arc import graph_outcomes, map_graphs
from sheafline.plans.harvest import harvest_catalogue
from sheafline.schemas import OUTCOME
from sheafline.sources.jsonld import block_graphs, page_blocks, page_graphs
from sheafline.sources.sitemap import read_urlset
from sheafline.sources.solr import first_hits, solr_docs

Transform = Callable[[DataFrame], DataFrame]


class Registry:
    """Named transforms of one kind."""

    def __init__(self, kind: str) -> None:
        self.kind = kind
        self._entries: dict[str, Transform] = {}

    def register(self, key: str) -> Callable[[Transform], Transform]:
        """Decorator that files a transform under ``key``."""

        def file(fn: Transform) -> Transform:
            self._entries[key] = fn
            return fn

        return file

    def __getitem__(self, key: str) -> Transform:
        if key not in self._entries:
            raise ValueError(f"Unsupported {self.kind}: {key}")
        return self._entries[key]

    def __contains__(self, key: str) -> bool:
        return key in self._entries

    def keys(self) -> list[str]:
        """Registered names."""
        return list(self._entries)


SOURCES = Registry("source type")
SITEMAPS = Registry("sitemap type")
DATASETS = Registry("dataset type")
MAPPERS = Registry("payload type")



def _first_of_each(found: DataFrame, order: list[str]) -> DataFrame:
    """The first row of each URL, within its repository; without repositories every sitemap is a source of its own."""
    keys = ["rdi", "url"] if "rdi" in found.columns else ["sitemap_url", "url"]
    return dedup_urls(found.withColumn("__at", F.struct(*order)), mode="drop", keys=keys, seq="__at").drop("__at")


@SITEMAPS.register("xml")
def xml_urls(docs: DataFrame) -> DataFrame:
    """Distinct locations of XML URL sets (``sitemap_url, body``): of a repository with ``rdi``, else of each sitemap."""
    return _first_of_each(read_urlset(docs), ["sitemap_url", "pos"])


@SITEMAPS.register("mycore_solr")
def solr_urls(pages: DataFrame) -> DataFrame:
    """Distinct landing pages of search hits (``rdi, batch, url, body``)."""
    return first_hits(solr_docs(pages))


DATASETS.register("html_jsonld")(page_graphs)
MAPPERS.register("general")(map_graphs)


@SOURCES.register("iso")
def iso_source(landed: DataFrame) -> DataFrame:
    """Landed catalogue responses (``rdi, base_url, batch, body``) -> outcomes; pages up to the announced total."""
    return harvest_catalogue(landed)


@SOURCES.register("html_jsonld")
def html_source(landed: DataFrame) -> DataFrame:
    """Landed dataset pages (``rdi, seq, url, body``) -> outcomes; later copies of a URL are skips.

    Repeats are found on narrow rows and taken out by an anti join. They are few as a rule, so Spark
    broadcasts them and no page moves; otherwise the join moves JSON-LD blocks, not pages.
    """
    pages = landed.select("rdi", "seq", "url", F.col("body").alias("html"))
    flagged = dedup_urls(pages.select("rdi", "seq", "url"), mode="flag")
    repeats = flagged.filter("is_duplicate").select("rdi", "url", "seq")
    kept = page_blocks(pages).join(repeats, ["rdi", "url", "seq"], "left_anti")
    return graph_outcomes(block_graphs(kept)).unionByName(duplicate_outcomes(flagged))


def run_sources(landed: dict[str, DataFrame]) -> DataFrame:
    """Outcomes of several sources side by side, given as source type -> landed rows.

    An unknown type yields no outcome; its repositories appear in the report with unknown counters.
    """
    parts = [df.transform(SOURCES[kind]) for kind, df in landed.items() if kind in SOURCES]
    if not parts:
        raise ValueError("no known source type")
    return reduce(lambda a, b: a.unionByName(b), parts)


@dataclass(frozen=True)
class Repository:
    """One configured repository: its id, its source type and what was landed for it."""

    rdi: str
    source_type: str
    landed: DataFrame


def run_repositories(configured: Sequence[Repository], path: str, side_by_side: int = 8) -> tuple[DataFrame, DataFrame]:
    """Repositories harvested side by side: their outcomes, and one report row for each in configured order.

    Each is planned and written below ``path`` in a thread and a scheduler pool of its own, ``side_by_side`` at a time,
    so a slow one does not hold up the others. One that fails at any point leaves no outcome; its row is ``crashed``
    with a message, as ``finalize_counts`` and ``failed_records`` take it. One of unknown type is not started. The
    rows are ``rdi, repo_no, source_type, harvest_started, crashed, message``; ids may repeat. Outcomes are those
    rows of a repository's source that carry its id.
    """
    if not configured:
        raise ValueError("no repository is configured")
    spark = configured[0].landed.sparkSession
    folder = lambda number: f"{path.rstrip('/')}/repo_no={number}"

    def run(number: int, repository: Repository) -> str | None:
        pool = "spark.scheduler.pool"
        spark.sparkContext.setLocalProperty(pool, f"repository-{number}")
        try:
            found = SOURCES[repository.source_type](repository.landed).where(F.col("rdi") == repository.rdi)
            found.write.mode("overwrite").parquet(folder(number))
        except Exception as error:  # whatever a source raises is its own failure, not that of the run
            return f"{type(error).__name__}: {(str(error).splitlines() or [''])[0]}"
        finally:
            spark.sparkContext.setLocalProperty(pool, None)
        return None

    started = [(k, r) for k, r in enumerate(configured) if r.source_type in SOURCES]
    with ThreadPoolExecutor(max_workers=side_by_side) as threads:
        work = inheritable_thread_target(spark)(run)
        messages = dict(zip([k for k, _ in started], threads.map(lambda x: work(*x), started), strict=True))
    rows = [
        (r.rdi, k, r.source_type, k in messages, messages.get(k) is not None, messages.get(k)) for k, r in enumerate(configured)
    ]
    schema = "rdi string, repo_no bigint, source_type string, harvest_started boolean, crashed boolean, message string"
    good = [spark.read.schema(OUTCOME).parquet(folder(k)) for k, m in messages.items() if m is None]
    outcomes = reduce(lambda x, y: x.unionByName(y), good, spark.createDataFrame([], OUTCOME))
    return outcomes, spark.createDataFrame(rows, schema)


def crashed_runs(report: DataFrame) -> DataFrame:
    """``rdi, message, url`` of the repositories whose whole run failed, for ``failed_records``."""
    return report.where("crashed").select("rdi", "message", F.lit(None).cast("string").alias("url"))


def repository_rows(repos: DataFrame) -> DataFrame:
    """Mark which configured repositories (``rdi, source_type, ...``) can start at all."""
    return repos.withColumn("harvest_started", F.col("source_type").isin(*SOURCES.keys()))
