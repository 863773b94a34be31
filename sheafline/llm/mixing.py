"""Mixing sources to target weights by systematic sampling, in Spark expressions only.

Sources, by code point with null last, weigh 1, 2, 3 and so on in turn and share all words. A source's target stops at
``MAX_COPIES`` times its size; the excess is shared by weight among the others. Inside a source every document expects
target / size copies. Along an order by size the expected copies are summed, one random offset per source is added,
and a document is taken once for each integer the sum crosses in its interval. Because the order is by size, a
source's taken words miss its target by at most about twice its largest document.

No task holds a source: the position of a document is the number of documents of smaller sizes (a count per size),
plus those in smaller hash buckets of its size, plus its rank in the bucket.

Null text has size 0; documents of size 0 are sampled like others and take nothing. A null source is a source of its
own. Repeated rows count as separate documents. An empty table gives an empty result. Columns of the input pass
through; clashing output columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafline.llm.common import set_aside, words_of

MAX_COPIES = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
#: Hex digits of the hash that orders documents of equal size: 16 ** 3 buckets.
BUCKET_DIGITS = 3

_SRC = ("__none", "__src")
_OUT = ("size", "source_size", "target", "copies", "taken")


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per source: its size and target. The largest table here has a row per source."""
    sizes = sized.groupBy(*_SRC).agg(F.sum("size").alias("source_size"))
    every = Window.orderBy(*_SRC)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.row_number().over(every) - 1) % len(WEIGHTS) + 1)
    sizes = sizes.withColumn("__w", weight.cast("bigint"))
    # With the k sources of least size per weight at their cap, the others reach some level; the true one is the highest.
    rising = Window.orderBy((F.col("source_size") * 6 / F.col("__w")).cast("double"), *_SRC)
    before, after = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    left = total - MAX_COPIES * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    level = left.cast("double") / F.sum("__w").over(after).cast("double")
    cap = (MAX_COPIES * F.col("source_size")).cast("double")
    levels = sizes.withColumn("__level", level).withColumn("__cap", cap)
    target = F.least(F.col("__cap"), F.max("__level").over(Window.partitionBy()) * F.col("__w"))
    return levels.select(*_SRC, "source_size", target.alias("target"))


def size_of(text: Column) -> Column:
    """Number of words of a text."""
    return F.size(words_of(text)).cast("bigint")


def mix_counts(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", sized_by: str | None = None
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (copies times size).

    ``docs`` is read three times. ``sized_by`` names a column that holds the sizes already, so that no text is needed.
    """
    columns = [c for c in docs.columns if c not in _OUT]
    digest = F.md5(F.concat_ws(":", F.lit(SEED), F.col(doc_id).cast("string")))
    sized = docs.select(
        *columns,
        (size_of(F.col(text)) if sized_by is None else F.col(sized_by).cast("bigint")).alias("size"),
        F.col(source).isNull().cast("int").alias("__none"),
        F.coalesce(F.col(source), F.lit("")).alias("__src"),
        digest.alias("__h"),
    ).withColumn("__b", F.substring("__h", 1, BUCKET_DIGITS))
    cell = (*_SRC, "size", "__b")
    counts = sized.groupBy(*cell).agg(F.count(F.lit(1)).alias("__n"))
    by_size = counts.groupBy(*_SRC, "size").agg(F.sum("__n").alias("__m"))

    def earlier(keys, order, name):
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(name).over(window), F.lit(0))

    smaller = by_size.select(*_SRC, "size", earlier(_SRC, "size", "__m").alias("__smaller"))
    buckets = counts.select(*cell, earlier((*_SRC, "size"), "__b", "__n").alias("__inside"))
    ranked = sized.withColumn("__rn", F.row_number().over(Window.partitionBy(*cell).orderBy("__h", doc_id)) - 1)
    cells = buckets.join(smaller, [*_SRC, "size"]).join(source_targets(sized), list(_SRC))
    placed = ranked.join(cells, list(cell))
    seed = F.md5(F.concat_ws(":", F.lit(SEED), F.col("__none").cast("string"), F.col("__src")))
    offset = F.conv(F.substring(seed, 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(2**52))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    position = F.col("__smaller") + F.col("__inside") + F.col("__rn")
    copies = F.floor(rate * (position + 1) + offset) - F.floor(rate * position + offset)
    copies = F.least(copies, F.lit(MAX_COPIES)).cast("bigint")
    return placed.withColumn("copies", copies).select(
        *columns, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The mix itself: each document's row as often as it is taken, all columns as they were."""
    own, restored = set_aside(docs, [c for c in _OUT if c not in (text, doc_id, source)])
    counted = mix_counts(own, text, doc_id, source).where(F.col("copies") > 0)
    return restored(counted.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))))
