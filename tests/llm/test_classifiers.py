"""Held-out accuracy of the two classifiers, and awkward inputs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from samples import awkward, empty, labels

from sheafline.llm import quality, toxicity
from sheafline.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("query,label,least", [("op2_quality_classifier", "quality", 0.95), ("op9_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, query, label, least):
    known = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    rows = QUERIES[query](spark, SF).join(known, "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert np.mean([r.predicted == r.y for r in rows]) >= least


def plain_ftrl(rows, alpha, beta, l1, l2):
    """One machine, one example after another: (weights by slot, intercept)."""
    z, n, bias = {}, {}, "bias"

    def weight(k):
        zk = z.get(k, 0.0)
        if k == bias:
            return -zk / ((beta + n.get(k, 0.0) ** 0.5) / alpha)
        return 0.0 if abs(zk) <= l1 else -(zk - np.sign(zk) * l1) / ((beta + n.get(k, 0.0) ** 0.5) / alpha + l2)

    for slots, y in rows:
        w = {k: weight(k) for k in [*slots, bias]}
        g = 1 / (1 + np.exp(-np.clip(sum(w.values()), -30, 30))) - y
        for k, wk in w.items():
            before = n.get(k, 0.0)
            n[k] = before + g * g
            z[k] = z.get(k, 0.0) + g - (n[k] ** 0.5 - before**0.5) / alpha * wk
    return {k: weight(k) for k in z if k != bias}, weight(bias)


@pytest.mark.parametrize("shard_rows", [10_000, 60])
def test_ftrl_of_any_number_of_shards_is_that_of_one_machine(spark, monkeypatch, shard_rows):
    """With 60 rows a shard there are more than ten of them."""
    monkeypatch.setattr(toxicity, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(toxicity, "ROUNDS", 2)
    seen = []
    keep = toxicity.stored
    monkeypatch.setattr(toxicity, "stored", lambda df, name: seen.append(keep(df, name)) or seen[-1])
    docs, known = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit(docs, known, F.lit(True))
    rows = sorted(seen[0].collect(), key=lambda r: (r.shard, r.o, r.doc_id))
    assert len({r.shard for r in rows}) >= (4 if shard_rows == 60 else 1)
    learnt = [(np.frombuffer(r.slots, np.int32).tolist(), float(r.y >= 0.5)) for r in rows if (r.o >> 20) % toxicity.CALIBRATE]
    weights, intercept = plain_ftrl(learnt * 2, toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2)
    want = np.zeros(toxicity.SLOTS, np.float32)
    for k, w in weights.items():
        want[k] = w
    assert np.allclose(model["weights"], want, atol=1e-4) and abs(model["intercept"] - intercept) < 1e-6
    assert 0 < np.count_nonzero(want) < toxicity.SLOTS // 10


def test_held_out_toxic_rows_are_caught_and_clean_ones_left(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 500)
    sf = "/root/testdata/sf0.1"
    known = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("toxic").alias("y"))
    rows = QUERIES["op9_toxicity"](spark, sf).join(known, "doc_id").where("held_out").collect()
    score, y = np.array([r.score for r in rows]), np.array([r.y for r in rows])
    toxic, clean = score[y == 1], score[y == 0]
    assert (toxic >= np.quantile(clean, 0.9)).mean() >= 0.8
    assert (clean < toxicity.THRESHOLD).mean() >= 0.98 and (toxic >= toxicity.THRESHOLD).mean() >= 0.6


@pytest.mark.parametrize("module", [quality, toxicity])
def test_awkward_rows(spark, module):
    fit = (lambda d, la: quality.fit(d, la, F.lit(True), F.lit(False))) if module is quality else (
        lambda d, la: toxicity.fit(d, la, F.lit(True))
    )
    none = fit(empty(spark), labels(spark))
    assert {r.score for r in module.score(awkward(spark), none).collect()} == {0.5}
    docs = awkward(spark)
    model = fit(docs, labels(spark, [(1, 1, 1), (1, 1, None), (3, 0, 0), (7, 0, 0), (99, 1, 1), (None, 1, 1), (4, None, None)]))
    scored = module.score(docs, model)
    assert sorted(scored.columns) == sorted({*docs.columns, "score", "predicted"})
    rows = scored.collect()
    assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 1}) == 1
    assert module.score(empty(spark), model).collect() == []


@pytest.mark.parametrize("partitions", [1, 7])
def test_ridge_of_partition_sums_is_that_of_one_machine(spark, monkeypatch, partitions):
    """All labelled rows in one least-squares problem, for any number of partitions; no copy of the model's own sums."""
    monkeypatch.setattr(quality, "FIT_PARTITIONS", partitions)
    docs, known = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    fold = quality.fold_of(F.col("doc_id"), 4)
    model = quality.fit(docs, known, fold != 2, fold == 3)
    rows = docs.join(quality.mean_labels(known, "quality"), "doc_id").select("text", "y", fold.alias("fold")).collect()
    [(_, _, buf, off)] = quality.tb.runs(pa.array([r.text for r in rows], pa.large_string()), 1 << 40)
    stats, y, part = quality.statistics(buf, off), np.array([r.y for r in rows]), np.array([r.fold for r in rows])
    seen = stats[part != 2]
    assert np.allclose(model["mean"], seen.mean(axis=0)) and np.allclose(model["scale"], np.where(seen.std(axis=0) > 0, seen.std(axis=0), 1))
    learnt = (part != 2) & (part != 3)
    phi = quality.Projection(seen.mean(axis=0), np.where(seen.std(axis=0) > 0, seen.std(axis=0), 1))(stats[learnt])
    # Ridge as least squares over extra rows; the last column is the intercept and is not penalised.
    root = np.sqrt(quality.RIDGE * max(1.0, learnt.sum()) + 1e-9) * np.eye(phi.shape[1])
    root[-1, -1] = np.sqrt(1e-9)
    want = np.linalg.lstsq(np.vstack([phi, root]), np.append(y[learnt], np.zeros(len(root))), rcond=None)[0]
    assert np.allclose(phi @ model["weights"], phi @ want, atol=1e-6)
    scored = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert len(scored) == docs.count() and min(scored.values()) >= 0 and max(scored.values()) <= 1


def test_pooled_is_the_isotonic_fit():
    knots, values = quality.pooled(np.array([1.0, 2, 3, 4]), np.ones(4), np.array([0.0, 0.6, 0.2, 1.0]))
    assert knots.tolist() == [1, 2, 3, 4] and np.allclose(values, [0, 0.4, 0.4, 1])
