"""What several operators share: the word rule, scratch tables in the shared folder, checked broadcasts."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.session import scratch_path

#: The characters that separate words, and the separators as a Java regular expression.
WORD_GAP_CHARS = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"

#: Rows of one long column that may be broadcast: 8 bytes each and as much again for the hash table.
BROADCAST_IDS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Words of a text as an array; empty for null and for texts without a word."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(WORD_GAP_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new table in the shared folder and read back: cuts the lineage, survives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.stored_at = path
    return written


def discard(df: DataFrame) -> None:
    """Empty a table made by ``stored`` after its last use, so that the shared folder does not grow with the steps."""
    df.sparkSession.createDataFrame([], df.schema).coalesce(1).write.mode("overwrite").parquet(df.stored_at)


def set_aside(docs: DataFrame, names: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with the columns in ``names`` under private names, and what gives a result their old names back."""
    moved = {c: f"__aside_{c}" for c in docs.columns if c in set(names)}
    back = {v: k for k, v in moved.items()}
    columns = [moved.get(c, c) for c in docs.columns]
    return docs.withColumnsRenamed(moved), lambda df: df.select(*columns).withColumnsRenamed(back)


def small_batches(spark: SparkSession) -> None:
    """Hand whole texts to Python in small Arrow batches, so that a worker's memory follows neither rows nor texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def release() -> None:
    """Let Spark drop shuffle files of finished steps: its cleaner acts when the objects that own them are collected."""
    from pyspark import SparkContext

    gc.collect()
    if SparkContext._jvm is not None:
        SparkContext._jvm.System.gc()


def matching(df: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key is among ``ids`` (one column, distinct, materialised by the caller), or is not.

    The ids are counted: up to ``BROADCAST_IDS`` of them are broadcast, so that wide rows do not move; more are
    joined by shuffle.
    """
    few = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, key, how)
