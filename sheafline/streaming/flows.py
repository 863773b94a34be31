"""Streams over a landing directory, with the batch operators unchanged wherever they are row-local."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from sheafline.operators.dedup import duplicate_outcomes
from sheafline.operators.outcomes import to_outcomes
from sheafline.operators.scan import arrival_ordinal
from sheafline.plans.graph_arc import graph_outcomes
from sheafline.plans.record_arc import record_outcomes
from sheafline.sources.iso import closed_record, parse_pieces, read_iso
from sheafline.sources.jsonld import block_graphs, page_blocks, page_graphs
from sheafline.sources.sinks import shelf
from sheafline.sources.sitemap import read_urlset

LANDED = "rdi string, seq bigint, url string, base_url string, batch bigint, body string, landed_at timestamp"


def stream_landed(spark: SparkSession, path: str, schema: str = LANDED, max_files: int | None = None) -> DataFrame:
    """Landed responses as they arrive (Parquet files of ``schema``)."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


#: Pages below 2^22 and bytes of a file below 2^41 share one ordinal, unless a caller divides its 63 bits otherwise.
OFFSET_BITS = 41
_LOST = "no page was landed"


def page_number(path: Column, page: str, limit: int = 2**31) -> Column:
    """Page number in a file's path; null where there is none or it is ``limit`` or more."""
    number = F.regexp_extract(path, page, 1).try_cast("bigint")
    return F.when((number >= 0) & (number < limit), number)


def unnumbered(path: Column) -> Column:
    """Message for a file whose path has no usable page number."""
    return F.concat(F.lit("No page number in "), path)


def stream_bodies(spark: SparkSession, path: str, rdi: str, base_url: str, page: str = r"(\d+)[^\d/]*$") -> DataFrame:
    """Raw response files as they arrive, one whole body per row, ready for :func:`stream_record_outcomes`.

    ``page`` finds the page number in a file's path; ``batch`` is null where it finds none.
    """
    raw = spark.readStream.format("text").option("wholetext", "true").load(path)
    named = raw.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("body"))
    return named.select(
        F.lit(rdi).alias("rdi"), F.lit(base_url).alias("base_url"), page_number(F.col("url"), page).alias("batch"), "url", "body"
    )


def stream_record_outcomes(landed: DataFrame) -> DataFrame:
    """Catalogue responses -> outcomes. Row-local, so a broken record costs one error row and no state.

    A response without page number is one error: without it neither page stops nor cuts mean anything.
    """
    numbered = landed.where("batch IS NOT NULL").select("rdi", "base_url", "batch", "body")
    parsed = read_iso(numbered)
    good = record_outcomes(parsed.withColumn("seq", arrival_ordinal(F.col("batch"), F.col("pos"))), F.col("base_url"))
    url = F.col("url") if "url" in landed.columns else F.col("base_url")
    return good.unionByName(lost_file(landed.where("batch IS NULL"), url))


def lost_file(rows: DataFrame, url: Column) -> DataFrame:
    """Error outcomes of files without page number."""
    return to_outcomes(
        rows, rdi=F.col("rdi"), kind=F.lit("error"), record_id=url, source_url=url, message=unnumbered(url)
    )


def raw_chunks(reader, path: str, tag: str = "gmd:MD_Metadata") -> DataFrame:
    """XML files of any size as text cut at the start tags ``<tag`` of their records: ``url, block, chunk``.

    ``reader`` is ``spark.read`` or ``spark.readStream``. A file is divided over tasks; no row holds more than one
    record and nothing reads a whole file. ``block`` is the offset of the part of the file that a task reads.
    """
    raw = reader.format("text").option("lineSep", f"<{tag}").load(path)
    return raw.select(
        F.col("_metadata.file_path").alias("url"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("chunk")
    )


def chunk_outcomes(
    chunks: DataFrame, rdi: str, base_url: str, tag: str = "gmd:MD_Metadata", page: str = r"(\d+)[^\d/]*$", offset_bits: int = OFFSET_BITS
) -> DataFrame:
    """Chunks of a batch or micro-batch, as :func:`raw_chunks` or a stream of it yields them -> outcomes.

    A record's ordinal is the page number in the file's path and its place: the offset of its block plus its number
    there, which stays below the next block's offset. ``offset_bits`` of the ordinal hold the place, the others the page:
    a file has a usable page number below 2^(63 - ``offset_bits``), and a place that does not fit is an error, not a
    collision. A record that is cut off by the end of the file, or is broken,
    is an error row and costs no neighbour; so is a file without page number. A start tag in a comment or CDATA between
    records is no record; inside a record it makes that record an error.
    """
    text = F.col("chunk")
    # What follows a start tag begins with an attribute, with > or with />; the head of a file does not.
    begins = text.rlike(r"\A(\s+[^\s<]|\s*/?>)")
    place = F.col("block") + F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    placed = _gathered(chunks.select("url", "block", place.alias("pos"), text, begins.alias("begins"), F.lit(rdi).alias("rdi")))
    cut = placed.withColumn("batch", page_number(F.col("url"), page, 2 ** (63 - offset_bits)))

    def inside(start: str, end: str) -> Column:
        at = F.instr(text, end)
        return (at > 0) & ((F.instr(text, start) == 0) | (at < F.instr(text, start)))

    element = F.concat(F.lit(f"<{tag}"), text)
    records = cut.where(F.col("batch").isNotNull() & F.col("begins") & ~inside("<!--", "-->") & ~inside("<![CDATA[", "]]>"))
    far = F.raise_error(F.concat(F.lit("Place in a file out of range: "), F.col("url"))).cast("bigint")
    seq = F.shiftleft(F.col("batch"), offset_bits) + F.when(F.col("pos") < 2**offset_bits, F.col("pos")).otherwise(far)
    pieces = parse_pieces(records.select("rdi", "batch", "pos", seq.alias("seq"), closed_record(element).alias("raw")))
    outcomes = record_outcomes(pieces, base_url)
    return outcomes.unionByName(lost_file(cut.where("batch IS NULL AND block = 0 AND NOT begins"), F.col("url")))


#: Blocks of files that one task reads in turn once every core has tasks enough.
_BLOCKS = 256


def _gathered(placed: DataFrame) -> DataFrame:
    """Many small blocks in few tasks, without a shuffle: the mapping of records costs more to start than a block to read.

    Places are numbered below, block by block, so they do not change.
    """
    blocks = placed.rdd.getNumPartitions()
    tasks = max(4 * placed.sparkSession.sparkContext.defaultParallelism, -(-blocks // _BLOCKS))
    return placed.coalesce(tasks) if tasks < blocks else placed


def stream_page_outcomes(landed: DataFrame) -> DataFrame:
    """Dataset pages -> outcomes, in arrival order of the micro-batches. Row-local and stateless."""
    return graph_outcomes(page_graphs(landed.select("rdi", "seq", "url", F.col("body").alias("html"))))


def stream_dedup(discovered: DataFrame, ttl: str = "7 days", event_time: str = "landed_at") -> DataFrame:
    """Drop URLs already seen within ``ttl``; the state is bounded by the watermark."""
    return discovered.withWatermark(event_time, ttl).dropDuplicatesWithinWatermark(["rdi", "url"])


def stream_counts(outcomes: DataFrame) -> DataFrame:
    """Running counters per repository for update or complete mode."""
    return outcomes.groupBy("rdi").agg(
        F.count_if(F.col("kind") == "arc").alias("harvested"),
        F.count_if(F.col("kind") == "error").alias("failed"),
        F.count_if(F.col("kind") == "skip").alias("skipped"),
    )


def stream_window_counts(
    outcomes: DataFrame, width: str, late: str, event_time: str = "landed_at", slide: str | None = None
) -> DataFrame:
    """Counters per repository and event-time window, each emitted once, when no row for it can count any more.

    The watermark follows the latest ``event_time`` of earlier micro-batches by ``late``. A row counts if its window
    ends after the watermark; later ones are dropped and reported as ``numRowsDroppedByWatermark`` in the query's
    progress. State holds the open windows only.
    """
    window = F.window(event_time, width, slide) if slide else F.window(event_time, width)
    counted = outcomes.withWatermark(event_time, late).groupBy("rdi", window.alias("w")).agg(
        F.count_if(F.col("kind") == "arc").alias("harvested"),
        F.count_if(F.col("kind") == "error").alias("failed"),
        F.count_if(F.col("kind") == "skip").alias("skipped"),
    )
    return counted.select(
        "rdi", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "harvested", "failed", "skipped"
    )


#: State entries of :func:`stream_flags`.
FLAG_BUCKETS = 2**14


def stream_flags(
    discovered: DataFrame, ttl: str | None = None, event_time: str = "landed_at", buckets: int = FLAG_BUCKETS
) -> DataFrame:
    """Mark repeats (``rdi, seq, url, is_duplicate``) instead of dropping them, with state that holds every URL once.

    Of a URL's rows in one micro-batch the one of the lowest ``seq`` is the first unless an earlier micro-batch had
    it. URLs are dealt to ``buckets`` by hash; a bucket is one entry of the state store and one call of the state
    function, which costs far more than a row. A micro-batch reads and rewrites the buckets of its own URLs, each a
    ``buckets``-th of all URLs; the number must stay the same for a checkpoint. With the RocksDB store
    (:func:`use_rocksdb`) state lies on disk. With ``ttl`` (``"7 days"``) a URL expires once the latest ``event_time``
    is that far past its last sighting; rows that land more than ``ttl`` behind the latest are then too late and
    dropped. A bucket forgets its expired URLs when it is read, and goes when the last of them has expired. Only narrow
    rows reach this step, and a micro-batch is bounded by its files.
    """
    names = ["rdi", "seq", "url"]
    timeout = GroupStateTimeout.NoTimeout
    if ttl is not None:
        discovered, names, timeout = discovered.withWatermark(event_time, ttl), [*names, event_time], GroupStateTimeout.EventTimeTimeout
    bucket = F.pmod(F.xxhash64("rdi", "url"), F.lit(buckets)).alias("bucket")

    def mark(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames)).sort_values("seq", kind="stable")
        urls = list(zip(rows["rdi"], rows["url"]))
        # Last sightings in milliseconds; without ttl nothing expires and they stay 0.
        watermark, seen_at = 0, [0] * len(urls)
        if ttl is not None:
            watermark = state.getCurrentWatermarkMs()
            seen_at = rows[event_time].to_numpy("datetime64[ms]").astype("int64").tolist()
        last = {}
        if state.exists:
            last = {(rdi, url): at for rdi, url, at in zip(*state.get) if at + 1 >= watermark}
        repeated = []
        for url, at in zip(urls, seen_at):
            before = last.get(url)
            repeated.append(before is not None)
            last[url] = max(at, watermark, before or 0)
        rows["is_duplicate"] = repeated
        state.update(([rdi for rdi, _ in last], [url for _, url in last], list(last.values())))
        if ttl is not None:
            state.setTimeoutTimestamp(max(last.values()) + 1)
        yield rows[["rdi", "seq", "url", "is_duplicate"]]

    return discovered.select(*names, bucket).groupBy("bucket").applyInPandasWithState(
        mark,
        "rdi string, seq bigint, url string, is_duplicate boolean",
        "rdi array<string>, url array<string>, last array<bigint>",
        "append",
        timeout,
    )


def use_rocksdb(spark: SparkSession) -> None:
    """Keep the state of this session's new streams in RocksDB instead of the executors' heaps."""
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)


def stream_sitemap_outcomes(sitemaps: DataFrame, pages: DataFrame, wait: str) -> DataFrame:
    """Discovery and extraction as one stream: landed sitemaps and landed pages -> outcomes.

    ``sitemaps``: ``rdi, sitemap_url, batch, body, landed_at``, the URL sets of a repository; ``pages``: ``url, body,
    landed_at``. A location meets its page if they land within ``wait`` of each other, in either order. A location
    whose page has not landed by then is an error row once the watermark has passed. Only the JSON-LD blocks of a page
    are kept while it waits. Locations listed again within ``wait`` are dropped here; :func:`stream_skips` reports
    them. The watermark is that of the slower side, and after a restart it moves once both sides have landed anew.
    """
    listed = read_urlset(sitemaps.withWatermark("landed_at", wait).select("rdi", "sitemap_url", "batch", "body", "landed_at"))
    seq = arrival_ordinal(F.col("batch"), F.col("pos")).alias("seq")
    firsts = listed.select("rdi", seq, F.col("url").alias("loc"), F.col("landed_at").alias("listed_at"))
    firsts = firsts.dropDuplicatesWithinWatermark(["rdi", "loc"])
    blocks = page_blocks(pages.withWatermark("landed_at", wait).select("url", "landed_at", F.col("body").alias("html")))
    span = F.expr(f"INTERVAL {wait}")
    met = (F.col("url") == F.col("loc")) & F.col("landed_at").between(F.col("listed_at") - span, F.col("listed_at") + span)
    joined = firsts.join(blocks, met, "left_outer")
    # One branch for pages that came and pages that did not, so that the state exists once.
    read = block_graphs(joined.select("rdi", "seq", F.col("loc").alias("url"), "blocks", F.col("url").isNull().alias("lost")))
    graphs = read.withColumn("graph_error", F.when(F.col("lost"), F.lit(_LOST)).otherwise(F.col("graph_error")))
    outcomes = graph_outcomes(graphs.drop("lost"))
    lost = F.col("message") == F.concat(F.lit("Failed to map dataset "), "source_url", F.lit(f": {_LOST}"))
    lost = F.coalesce(lost, F.lit(False))
    return outcomes.withColumns(
        {
            "record_id": F.when(~lost, F.col("record_id")),
            "message": F.when(lost, F.concat(F.lit("No page was landed for "), "source_url")).otherwise(F.col("message")),
        }
    )


def stream_skips(sitemaps: DataFrame, ttl: str | None = None) -> DataFrame:
    """Skip outcomes of the locations that landed sitemaps (with ``landed_at`` if there is a ``ttl``) list again."""
    keep = [c for c in ("rdi", "sitemap_url", "batch", "body", "landed_at") if c in sitemaps.columns]
    listed = read_urlset(sitemaps.select(*keep))
    seq = arrival_ordinal(F.col("batch"), F.col("pos")).alias("seq")
    return duplicate_outcomes(stream_flags(listed.select("rdi", seq, "url", *[c for c in keep if c == "landed_at"]), ttl))


def publish_into(out_path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that writes outcomes by shelves under their micro-batch; a replay overwrites itself."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rebalanced = batch.withColumn("shelf", shelf(F.col("rdi"))).hint("rebalance", "shelf")
        rebalanced.write.mode("overwrite").partitionBy("shelf").parquet(f"{out_path}/batch_id={batch_id}")

    return handle


def run_available(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Process everything landed so far and stop; the next run goes on from the checkpoint."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
