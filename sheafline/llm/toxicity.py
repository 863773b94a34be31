"""Toxicity: FTRL-proximal logistic regression over hashed words, word pairs and pairs with one word between.

A text's features are the distinct hashes of its lower-cased words (letters and digits), neighbouring pairs and
skip-pairs, in ``SLOTS`` slots. The learner keeps per coordinate the sums ``z`` and ``n`` of gradients and squared
gradients, which give each coordinate its own rate, and an L1 term that leaves most weights at zero. The sample lies in
shards of about ``SHARD_ROWS`` rows. In each of ``ROUNDS`` rounds the state goes from shard to shard in their order, one
task each, so the fit is that of one machine whatever the number of shards: states that advance side by side from one
start must not be added up, since each already takes the whole step. The weights that remain are a dense table of fixed
size (``SLOTS`` floats, 1 MB) for broadcasting. Scores are calibrated by an isotonic fit on rows of the sample that were
not learnt from.

The fit uses at most about ``FIT_ROWS`` labelled rows, drawn by a hash of the id; scoring covers every row and every
whole text. Null text counts as empty: its score is that of the intercept. Several labels of a document are averaged
and count as 1 from one half. Without a usable label every score is 0.5. Repeated rows get equal scores. Other columns
pass through; clashing output columns are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.llm import textbytes as tb
from sheafline.llm.common import small_batches, stored
from sheafline.llm.quality import THRESHOLD, drawn, mean_labels, pooled

SLOTS = 1 << 18
FIT_ROWS = 8_000
#: Rows of one partition of the sample.
SHARD_ROWS = 2_000
ROUNDS = 5
ALPHA, BETA, L1, L2 = 2.0, 1.0, 6.0, 0.1
#: One in so many rows of the sample calibrates and is not learnt from.
CALIBRATE = 5
BINS = 1_000
#: Share of the uncalibrated score: the isotonic fit is flat in places, and this keeps the order there.
TIES = 0.02
_BYTES = np.arange(256)
_GAP = ~(
    np.isin(_BYTES, np.arange(48, 58)) | np.isin(_BYTES, np.arange(65, 91)) | np.isin(_BYTES, np.arange(97, 123))
    | (_BYTES >= 0x80)
)


def features(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and their rows, not yet distinct."""
    starts, ends, row = tb.spans(_GAP[buf], off)
    h = tb.hashed(tb.LOWER[buf], starts, ends)
    slots, rows = [h], [row]
    for gap, salt in ((1, 0x51), (2, 0x52)):
        if len(h) > gap:
            same = row[gap:] == row[:-gap]
            slots.append(tb.mixed(h[:-gap] * np.uint64(3) + tb.mixed(h[gap:] + np.uint64(salt)))[same])
            rows.append(row[gap:][same])
    return (np.concatenate(slots) & np.uint64(SLOTS - 1)).astype(np.int64), np.concatenate(rows)


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """FTRL-proximal weights from the sums."""
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= L1, 0.0, w)


def learn(z: np.ndarray, n: np.ndarray, texts: list[np.ndarray], y: np.ndarray) -> None:
    """One pass over examples; slot ``SLOTS`` is the intercept and is not regularised by L1."""
    for idx, target in zip(texts, y, strict=True):
        zi, ni = z[idx], n[idx]
        w = weights_of(zi, ni)
        w[-1] = -zi[-1] / ((BETA + np.sqrt(ni[-1])) / ALPHA)
        p = sigmoid(w.sum())
        g = p - target
        sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
        z[idx] = zi + g - sigma * w
        n[idx] = ni + g * g


def fit(docs: DataFrame, labels: DataFrame, usable: Column, text: str = "text") -> dict:
    """Weights and intercept, fitted on documents for which ``usable`` holds."""
    small_batches(docs.sparkSession)
    known = mean_labels(labels, "toxic")
    id_type = dict(docs.dtypes)["doc_id"]

    def extract(batches):
        for batch in batches:
            for a, b, buf, off in tb.runs(batch.column(1)):
                slots, rows = features(buf, off)
                cell = np.unique(rows * SLOTS + slots)
                cut = np.searchsorted(cell // SLOTS, np.arange(b - a + 1))
                lists = [(cell[cut[i] : cut[i + 1]] % SLOTS).astype(np.int32).tobytes() for i in range(b - a)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(lists, pa.binary())], names=["doc_id", "slots"]
                )

    chosen = docs.where(usable & drawn(docs, known.count(), FIT_ROWS)).select("doc_id", text)
    sample = chosen.mapInArrow(extract, f"doc_id {id_type}, slots binary").join(known, "doc_id")
    count = known.count()
    shards = max(1, min(count, FIT_ROWS) // SHARD_ROWS)
    order = F.xxhash64("doc_id", F.lit("order"))
    # The order of examples is fixed by a hash, so that reruns agree; a shard is a stretch of that order.
    place = F.floor((F.shiftright(order, 32) + 2**31) * shards / 2**32).cast("int")
    sample = stored(sample.select(place.alias("shard"), order.alias("o"), "doc_id", "slots", "y"), "tox")
    z, n = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    held = F.pmod(F.shiftright("o", 20), F.lit(CALIBRATE)) == 0
    for step in range(ROUNDS * shards):
        state = docs.sparkSession.sparkContext.broadcast((z, n))

        def train(batches, state=state):
            z0, n0 = state.value
            z1, n1 = z0.copy(), n0.copy()
            for batch in batches:
                lists = [
                    np.append(np.frombuffer(x.as_py(), np.int32), SLOTS).astype(np.int64) for x in batch.column("slots")
                ]
                learn(z1, n1, lists, (batch.column("y").to_numpy() >= 0.5).astype(float))
            moved = np.flatnonzero((z1 != z0) | (n1 != n0))
            parts = (moved.astype(np.int32), z1[moved], n1[moved])
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()]) for x in parts], names=["i", "z", "n"])

        own = sample.where(~held & (F.col("shard") == step % shards)).coalesce(1).sortWithinPartitions("o", "doc_id")
        for i, new_z, new_n in own.select("slots", "y").mapInArrow(train, "i binary, z binary, n binary").collect():
            at = np.frombuffer(i, np.int32)
            z, n = z.copy(), n.copy()
            z[at], n[at] = np.frombuffer(new_z), np.frombuffer(new_n)
        state.unpersist()
    none = {"knots": np.array([0.0, 1.0]), "values": np.array([0.0, 1.0])}
    if not n[SLOTS]:
        return {"weights": np.zeros(SLOTS, np.float32), "intercept": 0.0} | none
    intercept = float(-z[SLOTS] / ((BETA + np.sqrt(n[SLOTS])) / ALPHA))
    model = {"weights": weights_of(z, n)[:SLOTS].astype(np.float32), "intercept": intercept}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def binned(batches):
        m = shared.value
        for batch in batches:
            total = [m["weights"][np.frombuffer(x.as_py(), np.int32)].sum() + m["intercept"] for x in batch.column(0)]
            bins = np.round(sigmoid(np.array(total, float)) * BINS).astype(np.int64)
            y = (batch.column(1).to_numpy() >= 0.5).astype(float)
            yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(y)], names=["bin", "y"])

    scored = sample.where(held).select("slots", "y").mapInArrow(binned, "bin bigint, y double")
    bins = scored.groupBy("bin").agg(F.count(F.lit(1)), F.avg("y")).collect()
    if not bins:
        return model | none
    knots, values = pooled(*(np.array([float(b[k]) for b in bins]) for k in range(3)))
    return model | {"knots": knots / BINS, "values": values}


def sigmoid(x: np.ndarray) -> np.ndarray:
    """Logistic function of values held within +-30."""
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; scores use the text alone."""
    kept = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")])
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        weights, intercept = model["weights"], model["intercept"]
        for batch in batches:
            for a, b, buf, off in tb.runs(batch.column(text)):
                slots, rows = features(buf, off)
                hit = weights[slots] != 0
                cell = np.unique(rows[hit] * SLOTS + slots[hit])
                total = np.bincount(cell // SLOTS, weights[cell % SLOTS], minlength=b - a) + intercept
                raw = sigmoid(total)
                values = (1 - TIES) * np.interp(raw, model["knots"], model["values"]) + TIES * raw
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values)], names=[*part.schema.names, "score"])

    scored = kept.mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
