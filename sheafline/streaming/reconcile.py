"""Publishing a stream of outcomes together with the answers of the upload, exactly once per micro-batch.

The stream mixes outcomes with upload errors (kind ``upload``), since an answer may land long after its object. A
micro-batch writes the objects it publishes, the URLs they come from, its failures and its upload errors, each under
its number, and last of all the changes of the counters. That last table is the commit: readers ignore what other
tables hold of a batch without it, and a batch that is run again replaces all of its own folders.

Counters are kept as changes per batch and repository, so no batch reads what earlier ones wrote; the adjustment by
duplicates is made on the sums, which is why the order in which objects and answers land does not matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.operators.outcomes import arc_identifier, enrich_client_errors, error_urls
from sheafline.operators.once import compute_once
from sheafline.schemas import OUTCOME

#: Rows of the mixed stream: outcomes, and upload errors with ``error_type`` and ``arc_id``.
MIXED = f"{OUTCOME}, error_type string, arc_id string"
#: Rows of the tables below a base folder; ``commits`` holds the changes of the counters.
TABLES = {
    "objects": "rdi string, arc_id string, seq bigint, arc_json string",
    "urls": "rdi string, arc_id string, url string, first_seq bigint",
    "failures": "rdi string, seq bigint, message string, record_id string, source_url string",
    "errors": "rdi string, seq bigint, error_type string, arc_id string, message string",
    "commits": "rdi string, harvested bigint, failed bigint, skipped bigint, duplicates bigint, refused bigint",
}


def with_answers(outcomes: DataFrame, errors: DataFrame) -> DataFrame:
    """One stream of outcomes and upload errors (``rdi, seq, error_type, arc_id, message``)."""
    return outcomes.unionByName(errors.withColumn("kind", F.lit("upload")), allowMissingColumns=True)


def reconcile_into(base: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for :func:`with_answers`; see the module's text for what it writes.

    An object that a batch holds several times is published once, as it was last. Objects without identifier count
    as harvested but have no row.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        def write(name: str, rows: DataFrame) -> None:
            rows.write.mode("overwrite").parquet(f"{base}/{name}/batch_id={batch_id}")

        kind = F.col("kind")
        batch = batch.persist()
        try:
            arcs = compute_once(
                batch.where(kind == "arc").drop("arc_id"), ["rdi", "seq", "arc_json", "source_url"],
                arc_id=arc_identifier(F.col("arc_json")),
            ).where("arc_id IS NOT NULL")
            last = arcs.groupBy("rdi", "arc_id").agg(F.max_by(F.struct("seq", "arc_json"), "seq").alias("o"))
            write("objects", last.select("rdi", "arc_id", "o.seq", "o.arc_json"))
            named = arcs.where("source_url IS NOT NULL").groupBy("rdi", "arc_id", F.col("source_url").alias("url"))
            write("urls", named.agg(F.min("seq").alias("first_seq")))
            write("failures", batch.where(kind == "error").select("rdi", "seq", "message", "record_id", "source_url"))
            write("errors", batch.where(kind == "upload").select("rdi", "seq", "error_type", "arc_id", "message"))
            count = lambda condition, name: F.count_if(condition).alias(name)
            changes = batch.groupBy("rdi").agg(
                count(kind == "arc", "harvested"),
                count(kind == "error", "failed"),
                count(kind == "skip", "skipped"),
                count((kind == "upload") & (F.col("error_type") == "DUPLICATE"), "duplicates"),
                count(kind == "upload", "refused"),
            )
            write("commits", changes)
        finally:
            batch.unpersist()

    return handle


def committed(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Rows of a table below ``base`` whose batch is committed, with ``batch_id``."""
    read = lambda t: spark.read.schema(f"{TABLES[t]}, batch_id bigint").parquet(f"{base}/{t}")
    if name == "commits":
        return read(name)
    # A batch without rows leaves no change; it has nothing in the other tables either.
    return read(name).join(read("commits").select("batch_id").distinct(), "batch_id", "left_semi")


def reconciled_counts(spark: SparkSession, base: str) -> DataFrame:
    """Counters per repository over all committed batches, adjusted by the upload errors: as ``apply_client_errors``."""
    names = ("harvested", "failed", "skipped", "duplicates", "refused")
    total = committed(spark, base, "commits").groupBy("rdi").agg(*[F.sum(n).alias(n) for n in names])
    known = total.where("harvested + failed + skipped > 0")
    harvested = F.when(F.col("harvested") > 0, F.greatest(F.col("harvested") - F.col("duplicates"), F.lit(0)))
    failed = F.col("failed") + F.col("refused")
    return known.select(
        "rdi",
        harvested.cast("bigint").alias("harvested"),
        F.when(failed > 0, failed).alias("failed"),
        "skipped",
    )


def current_objects(spark: SparkSession, base: str) -> DataFrame:
    """Every published object as its last committed batch left it: ``rdi, arc_id, arc_json, batch_id``."""
    last = F.max_by(F.struct("arc_json", "batch_id"), F.struct("batch_id", "seq")).alias("o")
    return committed(spark, base, "objects").groupBy("rdi", "arc_id").agg(last).select("rdi", "arc_id", "o.*")


def reconciled_errors(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """Upload errors with the number of source URLs of their objects, and those URLs, over all committed batches."""
    urls = committed(spark, base, "urls").groupBy("rdi", "arc_id", "url").agg(F.min("first_seq").alias("first_seq"))
    errors = committed(spark, base, "errors").drop("batch_id")
    return enrich_client_errors(errors, urls), error_urls(errors, urls)
