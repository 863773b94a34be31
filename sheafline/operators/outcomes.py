"""Outcome routing, counters and reconciliation with upload errors.

An outcome row is ``rdi, seq, kind, arc_json, record_id, source_url, message`` with kind
``arc``, ``error`` or ``skip``. Counters and lists keep "unknown" (null) apart from zero.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.functions.text import let, truthy
from sheafline.operators.once import compute_once
from sheafline.operators.scan import BLOCK_ROWS, blocked_row_number, ordinal_block, ordinal_width
from sheafline.schemas import OUTCOME_FIELDS
from sheafline.session import cut_lineage


def arc_identifier(arc_json: Column) -> Column:
    """Identifier of the root entity ``./`` in a JSON-LD graph; null when absent, empty or unreadable."""

    def identifier(root: Column) -> Column:
        listed = F.try_variant_get(root, "$.identifier", "array<variant>")
        scalar = F.when(listed.isNull(), F.try_variant_get(root, "$.identifier", "string")).otherwise(
            F.try_variant_get(F.get(listed, F.lit(0)), "$", "string")
        )
        return F.when(~scalar.isin("", "0", "false"), scalar)

    items = F.try_variant_get(F.try_parse_json(arc_json), "$['@graph']", "array<variant>")
    roots = F.filter(items, lambda x: F.try_variant_get(x, "$['@id']", "string") == "./")
    return let(F.get(roots, F.lit(0)), identifier)


def to_outcomes(df: DataFrame, **columns: Column) -> DataFrame:
    """Project to the outcome schema; columns not given are null."""
    return df.select(
        *[columns.get(name, F.lit(None)).cast(ddl).alias(name) for name, ddl in OUTCOME_FIELDS.items()]
    )


def union_sources(*parts: DataFrame) -> DataFrame:
    """Side-by-side repositories as one outcome table."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def harvest_counts(outcomes: DataFrame) -> DataFrame:
    """Counters per repository; harvested and failed stay null until the first such outcome."""

    def seen(kind: str) -> Column:
        return F.nullif(F.count_if(F.col("kind") == kind), F.lit(0))

    return outcomes.groupBy("rdi").agg(
        seen("arc").alias("harvested"),
        seen("error").alias("failed"),
        F.count_if(F.col("kind") == "skip").alias("skipped"),
    )


def arc_urls(outcomes: DataFrame) -> DataFrame:
    """Distinct source URLs per research object, one row each with its first arrival."""
    arcs = outcomes.filter((F.col("kind") == "arc") & F.col("source_url").isNotNull())
    keyed = compute_once(
        arcs.withColumnRenamed("source_url", "url"), ["rdi", "url", "seq"], arc_id=arc_identifier(F.col("arc_json"))
    )
    return (
        keyed.filter(truthy(F.col("arc_id")).isNotNull())
        .groupBy("rdi", "arc_id", "url")
        .agg(F.min("seq").alias("first_seq"))
    )


def _urls_of_errors(errors: DataFrame, urls: DataFrame) -> DataFrame:
    """The URLs of objects that some error names: few objects have errors, so the others drop out first."""
    return urls.join(errors.select("rdi", "arc_id").distinct(), ["rdi", "arc_id"], "left_semi")


def enrich_client_errors(errors: DataFrame, urls: DataFrame) -> DataFrame:
    """Upload errors, one row each, with the number of source URLs of the object they name.

    ``errors``: ``rdi, seq, error_type, arc_id, message``; ``urls`` as from :func:`arc_urls`. The message ends where
    the list of URLs begins; the list itself stays a table, :func:`error_urls`, of any length.
    """
    counted = _urls_of_errors(errors, urls).groupBy("rdi", "arc_id").agg(F.count(F.lit(1)).alias("__n"))
    n = F.coalesce("__n", F.lit(0)).cast("bigint")
    lead = F.when(n == 1, F.lit(" — source URL:")).when(n > 1, F.lit(" — source URLs:")).otherwise(F.lit(""))
    return errors.join(counted, ["rdi", "arc_id"], "left").select(
        "rdi", "seq", "error_type", "arc_id", F.concat("message", lead).alias("message"), n.alias("n_urls")
    )


def error_urls(errors: DataFrame, urls: DataFrame) -> DataFrame:
    """The URLs that belong to each error's message: ``rdi, seq, rn, url``, by first arrival."""
    # Written once, since finding them reads whole documents and the numbering reads them twice.
    named = cut_lineage(_urls_of_errors(errors, urls))
    ranked = blocked_row_number(
        named,
        ["rdi", "arc_id"],
        [F.col("first_seq"), F.col("url")],
        ordinal_block(F.col("first_seq"), ordinal_width(named, "first_seq", BLOCK_ROWS)),
    )
    return errors.select("rdi", "seq", "arc_id").join(ranked, ["rdi", "arc_id"]).select("rdi", "seq", "rn", "url")


def apply_client_errors(counts: DataFrame, errors: DataFrame) -> DataFrame:
    """Every upload error adds a failure; a duplicate also takes one object off, never below zero."""
    per_rdi = errors.groupBy("rdi").agg(
        F.count_if(F.col("error_type") == "DUPLICATE").alias("__dup"), F.count(F.lit(1)).alias("__n")
    )
    return counts.join(per_rdi, "rdi", "left").select(
        "rdi",
        F.when(
            F.col("harvested").isNotNull(), F.greatest(F.col("harvested") - F.coalesce("__dup", F.lit(0)), F.lit(0))
        ).alias("harvested"),
        F.when(F.col("__n").isNull(), F.col("failed"))
        .otherwise(F.coalesce("failed", F.lit(0)) + F.col("__n"))
        .alias("failed"),
        "skipped",
    )


def finalize_counts(repos: DataFrame, counts: DataFrame) -> DataFrame:
    """Counters per configured repository: zero once the harvest started, unknown before.

    ``repos``: at least ``rdi, harvest_started``, and optionally ``crashed`` for repositories whose whole task
    was lost: those report nothing harvested and an unknown number of failures.
    """
    joined = repos.join(counts, "rdi", "left")
    crashed = F.coalesce(F.col("crashed"), F.lit(False)) if "crashed" in repos.columns else F.lit(False)

    def known(name: str, lost: Column) -> Column:
        return (
            F.when(crashed, lost)
            .when(F.col("harvest_started"), F.coalesce(F.col(name), F.lit(0)))
            .cast("bigint")
            .alias(name)
        )

    return joined.select(
        *[F.col(c) for c in repos.columns],
        known("harvested", F.lit(0)),
        known("failed", F.lit(None)),
        F.when(crashed, F.lit(0)).otherwise(F.coalesce("skipped", F.lit(0))).cast("bigint").alias("skipped"),
    )


def failed_records(
    outcomes: DataFrame, enriched_errors: DataFrame | None = None, run_failures: DataFrame | None = None
) -> DataFrame:
    """One row per failed record: ``rdi, section, seq, message, record_id, url, n_urls``.

    Section 0 holds source errors in arrival order, section 1 upload errors, section 2 the failure of a whole
    repository (``rdi, message, url``), which adds a record but no count. The list stays a table: a repository
    may fail in a third of all rows.
    """
    own = outcomes.filter(F.col("kind") == "error").select(
        "rdi",
        F.lit(0).alias("section"),
        "seq",
        F.when(
            F.col("record_id").isNotNull(), F.concat("message", F.lit(" (record_id="), "record_id", F.lit(")"))
        )
        .otherwise(F.col("message"))
        .alias("message"),
        "record_id",
        F.when(F.col("record_id").isNotNull(), F.col("source_url")).alias("url"),
        F.lit(0).cast("bigint").alias("n_urls"),
    )
    parts = [own]
    none = F.lit(None).cast("string")
    if enriched_errors is not None:
        parts.append(
            enriched_errors.select(
                "rdi",
                F.lit(1).alias("section"),
                "seq",
                "message",
                F.col("arc_id").alias("record_id"),
                none.alias("url"),
                "n_urls",
            )
        )
    if run_failures is not None:
        parts.append(
            run_failures.select(
                "rdi",
                F.lit(2).alias("section"),
                F.lit(0).cast("bigint").alias("seq"),
                "message",
                none.alias("record_id"),
                "url",
                F.lit(0).cast("bigint").alias("n_urls"),
            )
        )
    return union_sources(*parts)
