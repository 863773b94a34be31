"""The corpus pipeline over ``documents``: quality, near duplicates, secrets, source mix, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns the next stage's documents,
the last one the pieces of the packed sequences.

Every stage takes the whole table as its operator does: null and empty texts are scored, have no secrets and no near
duplicates, weigh nothing in the mix and pack as their end id. Repeated rows get equal scores; one of them passes the
second stage. Ties go to the smallest ``doc_id``. Columns beyond those of ``documents`` pass through the first four
stages unchanged, also where a stage's operator uses their name. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import mixing, ngram_join, packing, quality, secret_scan
from sheafline.llm.common import set_aside, stored, table

#: A document goes if it is likelier to be of low quality.
REJECT_BELOW = 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it is fitted and calibrated on the labelled ones."""
    fold = quality.fold_of(F.col("doc_id"), 4)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), fold != 2, fold == 3)
    own, restored = set_aside(docs, ["score", "predicted"])
    return restored(quality.score(own, model).where(F.col("score") >= REJECT_BELOW))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.one_of_each(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced, and ``n_chars`` as it is then."""
    clean = secret_scan.redact(docs, secret_scan.fit(docs))
    return clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("mix", mix_stage),
    ("packing", packing_stage),
]

#: SQL has neither the classifier nor the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
