"""Repository and run reports as JSON-LD.

A report document may list every failed record, so it is produced as ordered text lines rather than as
one cell: written in order, the lines form one JSON document of any size.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.functions.text import truthy
from sheafline.functions.timefmt import iso_duration, iso_timestamp
from sheafline.session import cut_lineage


@dataclass(frozen=True)
class Vocabulary:
    """Prefix and namespace of the report's own terms, and the name of the run."""

    prefix: str = "harvest"
    namespace: str = "https://example.org/harvest/"
    run_name: str = "Harvest Run"


def _quoted(text: Column) -> Column:
    """A text as a JSON string."""
    return F.to_json(text.cast("variant"))


def _failed_head(vocab: Vocabulary) -> Column:
    """JSON of one failed record up to the end of its message, without the closing quote."""
    return F.concat(F.lit(f'{{"{vocab.prefix}:message":'), F.regexp_replace(_quoted(F.col("message")), '"$', ""))


def _failed_tail(vocab: Vocabulary) -> Column:
    """The rest: closing quote, id and URL; an empty id or URL is left out."""
    p = vocab.prefix
    given = [
        F.when(truthy(F.col(c)).isNotNull(), F.concat(F.lit(f',"{p}:{name}":'), _quoted(F.col(c)))).otherwise("")
        for c, name in (("record_id", "recordId"), ("url", "url"))
    ]
    return F.concat(F.lit('"'), *given, F.lit("}"))


def repo_jsonld(vocab: Vocabulary = Vocabulary()) -> Column:
    """JSON of one repository row without its failed records.

    ``rdi, harvest_id, duration_seconds, expected, harvested, failed, skipped``: unknown counters are left
    out, the harvest id is always there even when null.
    """
    p = vocab.prefix
    return F.to_json(
        F.struct(
            F.lit("schema:EntryPoint").alias("@type"),
            F.col("rdi").alias("name"),
            F.col("rdi").alias("identifier"),
            iso_duration(F.col("duration_seconds")).alias("schema:duration"),
            F.col("harvested").alias(f"{p}:harvestedDatasets"),
            F.coalesce(F.col("harvest_id").cast("variant"), F.parse_json(F.lit("null"))).alias(f"{p}:harvestId"),
            F.col("expected").alias(f"{p}:expectedDatasets"),
            F.col("skipped").alias(f"{p}:skippedDatasets"),
            F.col("failed").alias(f"{p}:failedDatasets"),
        )
    )


def failed_record_jsonld(vocab: Vocabulary = Vocabulary()) -> Column:
    """JSON of one failed record; an empty id or URL is left out."""
    return F.concat(_failed_head(vocab), _failed_tail(vocab))


def with_expected(repos: DataFrame, *announced: DataFrame) -> DataFrame:
    """Report rows with ``expected`` from tables of announced totals (``rdi, expected``); unknown stays null."""
    totals = reduce(lambda a, b: a.unionByName(b), announced).groupBy("rdi").agg(F.max("expected").alias("expected"))
    return repos.drop("expected").join(totals, "rdi", "left")


def all_failed(repos: DataFrame) -> DataFrame:
    """One row: true when there are repositories and none got a harvest id."""
    return repos.agg(
        ((F.count(F.lit(1)) > 0) & F.coalesce(F.bool_and(F.col("harvest_id").isNull()), F.lit(False))).alias("all_failed")
    )


def run_lines(
    run: DataFrame,
    repos: DataFrame,
    failed: DataFrame,
    vocab: Vocabulary = Vocabulary(),
    urls: DataFrame | None = None,
) -> DataFrame:
    """The run report as rows ``repo_no, section, seq, part, line``; sorted by the first four it is one document.

    ``run``: one row ``start_time, end_time``. ``repos``: report rows plus ``repo_no``, the configured order.
    ``failed``: rows of :func:`sheafline.operators.outcomes.failed_records`. Both are read several times, so
    they are written to the shared folder once. ``urls``: rows of
    :func:`sheafline.operators.outcomes.error_urls`; each is a line of its own inside the message of its record.
    Lines are to be joined by single blanks.
    """
    p = vocab.prefix
    failed = cut_lineage(failed)
    counted = failed.groupBy("rdi").agg(
        F.min(F.struct("section", "seq")).alias("__first"), F.count(F.lit(1)).alias("__n_failed")
    )
    repos = cut_lineage(repos)
    numbered = repos.join(counted, "rdi", "left")
    # A join on the number itself marks the last repository without comparing every row with it.
    last_repo = repos.agg(F.max("repo_no").alias("repo_no")).withColumn("__is_last", F.lit(True))
    numbered = cut_lineage(numbered.join(last_repo, "repo_no", "left"))

    context = F.to_json(
        F.struct(
            F.lit("https://schema.org/").alias("@vocab"),
            F.lit("https://schema.org/").alias("schema"),
            F.lit(vocab.namespace).alias(vocab.prefix),
        )
    )
    start, end = F.col("start_time").cast("timestamp"), F.col("end_time").cast("timestamp")
    seconds = (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)
    head = F.concat(
        F.lit('{"@context":'),
        context,
        F.lit(',"@type":"schema:Action","name":'),
        F.to_json(F.lit(vocab.run_name).cast("variant")),
        F.lit(',"schema:startTime":"'),
        iso_timestamp(start),
        F.lit('","schema:endTime":"'),
        iso_timestamp(end),
        F.lit(f'","{p}:harvestDurationSeconds":'),
        seconds.cast("string"),
        F.lit(',"schema:result":['),
    )

    def line(repo_no: Column, section: Column, seq: Column, part: Column, text: Column) -> list[Column]:
        return [
            repo_no.cast("bigint").alias("repo_no"),
            section.cast("int").alias("section"),
            seq.cast("bigint").alias("seq"),
            part.cast("bigint").alias("part"),
            text.alias("line"),
        ]

    lit = F.lit
    opening = run.select(*line(lit(-1), lit(-1), lit(0), lit(0), head))
    has_failed = F.col("__n_failed").isNotNull()
    body = F.regexp_replace(repo_jsonld(vocab), r"\}$", "")
    comma = F.when(F.col("__is_last"), lit("")).otherwise(lit(","))
    entries = numbered.select(
        *line(
            F.col("repo_no"),
            lit(-1),
            lit(0),
            lit(0),
            F.when(has_failed, F.concat(body, lit(f',"{p}:failedRecords":['))).otherwise(F.concat(body, lit("}"), comma)),
        )
    )
    closings = numbered.filter(has_failed).select(
        *line(F.col("repo_no"), lit(9), lit(0), lit(0), F.concat(lit("]}"), comma))
    )
    records = failed.join(numbered.select("rdi", "repo_no", "__first"), "rdi").select(
        *line(
            F.col("repo_no"),
            F.col("section"),
            F.col("seq"),
            lit(0),
            F.concat(
                F.when(F.struct("section", "seq") == F.col("__first"), lit("")).otherwise(lit(",")),
                F.when(F.col("n_urls") > 0, _failed_head(vocab)).otherwise(failed_record_jsonld(vocab)),
            ),
        )
    )
    if urls is not None:
        listing = failed.where("section = 1 AND n_urls > 0").join(numbered.select("rdi", "repo_no"), "rdi")
        listing = listing.select("rdi", "repo_no", "section", "seq", "n_urls", _failed_tail(vocab).alias("__tail"))
        inner = F.regexp_replace(_quoted(F.col("url")), '^"|"$', "")
        ending = F.when(F.col("rn") < F.col("n_urls"), lit(",")).otherwise(F.col("__tail"))
        records = records.unionByName(
            urls.join(listing, ["rdi", "seq"]).select(
                *line(F.col("repo_no"), F.col("section"), F.col("seq"), F.col("rn"), F.concat(inner, ending))
            )
        )
    closing = run.select(*line(lit(2**62), lit(9), lit(0), lit(0), lit("]}")))
    return opening.unionByName(entries).unionByName(records).unionByName(closings).unionByName(closing)
