"""Quality classifier: random Fourier features over document statistics, ridge regression, isotonic calibration.

Statistics of every whole text (word and line shapes, character classes, repetition) are standardised and mapped to
``FEATURES`` random cosines, which approximate a Gaussian kernel. Each partition of the training rows sums its part of
the normal equations; the driver adds at most ``FIT_PARTITIONS`` such sums, solves for the ridge weights, and calibrates
on rows of another fold by pooling adjacent violators over ``BINS`` score bins. The fit uses at most about
``FIT_ROWS`` labelled rows, drawn by a hash of the id; scoring covers every row.

Null text counts as empty and gets a score like any other. Several labels of a document are averaged; null labels and
labels without a document are ignored. Without a usable label every score is 0.5, and with one class only it is that
class's share. Repeated rows get equal scores. Other columns pass through; clashing output columns are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.llm import textbytes as tb
from sheafline.llm.common import small_batches

FEATURES = 256
FIT_ROWS = 20_000
FIT_PARTITIONS = 16
BINS = 1_000
RIDGE = 1e-3
THRESHOLD = 0.7

_CLASSES = {
    "digit": np.isin(np.arange(256), np.arange(48, 58)),
    "upper": np.isin(np.arange(256), np.arange(65, 91)),
    "lower": np.isin(np.arange(256), np.arange(97, 123)),
    "wide": np.arange(256) >= 0xC0,
    "symbol": np.isin(np.arange(256), np.frombuffer(b"#*$%&<>@^~{}[]\\=_+", np.uint8)),
    "bar": np.arange(256) == ord("|"),
    "shout": np.isin(np.arange(256), np.frombuffer(b"!?", np.uint8)),
    "stop": np.isin(np.arange(256), np.frombuffer(b".,;:", np.uint8)),
    "line": np.arange(256) == 10,
}
STATISTICS = 9 + 10


def statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` numbers per text."""
    rows = len(off) - 1
    chars = tb.per_row((buf & 0xC0) != 0x80, off)
    starts, ends, row = tb.spans(tb.GAP[buf], off)
    words = np.bincount(row, minlength=rows)
    some, letters = np.maximum(words, 1), np.maximum(chars, 1)
    columns = [tb.per_row(mask[buf], off) / letters for mask in _CLASSES.values()]
    size = ends - starts
    h = tb.hashed(buf, starts, ends)

    def repeats(values: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Values equal to an earlier one of their row."""
        order = np.lexsort((values, of))
        v, r = values[order], of[order]
        same = (v[1:] == v[:-1]) & (r[1:] == r[:-1])
        return np.bincount(r[1:][same], minlength=rows)

    triples = h[:-2] + tb.mixed(h[1:-1] + np.uint64(1)) + tb.mixed(h[2:] + np.uint64(2)) if len(h) > 2 else h[:0]
    inner = row[:-2] == row[2:] if len(h) > 2 else np.zeros(0, bool)
    l_start, l_end, l_row = tb.spans(buf == 10, off)
    lines = np.maximum(np.bincount(l_row, minlength=rows), 1)
    mean = np.bincount(row, size, rows) / some
    columns += [
        np.log1p(chars),
        np.log1p(words),
        mean,
        np.sqrt(np.maximum(np.bincount(row, size.astype(float) ** 2, rows) / some - mean**2, 0)),
        np.bincount(row[size == 1], minlength=rows) / some,
        np.bincount(row[size > 16], minlength=rows) / some,
        repeats(h, row) / some,
        repeats(triples[inner], row[:-2][inner] if len(h) > 2 else row[:0]) / some,
        repeats(tb.hashed(buf, l_start, l_end), l_row) / lines,
        np.log1p(words / lines),
    ]
    return np.column_stack(columns).astype(np.float64)


class Projection:
    """Standardise, then random cosines; the random numbers follow from the seed."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int = FEATURES, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.directions = rng.normal(0, np.sqrt(2.0 / STATISTICS), (STATISTICS, features))
        self.phase = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -5, 5)
        phi = np.sqrt(2.0 / len(self.phase)) * np.cos(z @ self.directions + self.phase)
        return np.column_stack([phi, np.ones(len(phi))])


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def mean_labels(labels: DataFrame, name: str) -> DataFrame:
    """One row per labelled document: doc_id and the mean ``y`` of its labels."""
    known = labels.where(F.col(name).isNotNull() & F.col("doc_id").isNotNull())
    return known.groupBy("doc_id").agg(F.avg(F.col(name).cast("double")).alias("y"))


def drawn(docs: DataFrame, labelled: int, rows: int = FIT_ROWS) -> Column:
    """Condition that keeps about ``rows`` of ``labelled`` documents, by a hash of the id."""
    share = 1.0 if labelled <= rows else rows / labelled
    return F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000)) < int(share * 1_000_000)


def pooled(score: np.ndarray, weight: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic fit by pooling adjacent violators: knots in score order and their fitted values."""
    blocks: list[list[float]] = []
    for s, w, y in sorted(zip(score, weight, target, strict=True)):
        blocks.append([s, s, w, y])
        while len(blocks) > 1 and blocks[-2][3] >= blocks[-1][3]:
            _, high, w1, y1 = blocks.pop()
            low, _, w0, y0 = blocks.pop()
            blocks.append([low, high, w0 + w1, (w0 * y0 + w1 * y1) / (w0 + w1)])
    knots = [(s, b[3]) for b in blocks for s in ((b[0], b[1]) if b[1] > b[0] else (b[0],))]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


def fit(docs: DataFrame, labels: DataFrame, usable: Column, calibrate: Column) -> dict:
    """Fit on documents for which ``usable`` holds; those for which ``calibrate`` holds too calibrate.

    Returns the model as a dictionary of small arrays: it has a fixed size.
    """
    small_batches(docs.sparkSession)
    known = mean_labels(labels, "quality")
    chosen = docs.where(usable & drawn(docs, known.count())).select(
        "doc_id", "text", F.coalesce(calibrate, F.lit(False)).alias("held")
    )

    def measure(batches):
        for batch in batches:
            for a, b, buf, off in tb.runs(batch.column("text")):
                stats = pa.array(list(statistics(buf, off)), pa.list_(pa.float64()))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held"), stats], names=["doc_id", "held", "stats"]
                )

    measured = chosen.mapInArrow(measure, f"doc_id {dict(chosen.dtypes)['doc_id']}, held boolean, stats array<double>")
    rows = measured.join(known, "doc_id").select("held", "y", "stats").repartition(FIT_PARTITIONS).persist()
    try:
        held = rows.agg(F.sum(F.col("held").cast("int")), F.count(F.lit(1)), F.avg("y"), F.min("y"), F.max("y")).first()
        n_held, n, share, low, high = held[0] or 0, held[1], held[2], held[3], held[4]
        if not n or low == high:
            return {"constant": 0.5 if not n else float(share)}
        moments = rows.select(F.posexplode("stats")).groupBy("pos").agg(F.avg("col"), F.stddev_pop("col")).collect()
        mean, scale = np.zeros(STATISTICS), np.ones(STATISTICS)
        for pos, m, s in moments:
            mean[pos], scale[pos] = m, s or 1.0
        project = Projection(mean, scale)
        size = FEATURES + 1

        def sums(batches):
            """The partition's part of the normal equations."""
            gram, moment = np.zeros((size, size)), np.zeros(size)
            for batch in batches:
                if batch.num_rows:
                    flat = batch.column("stats").flatten().to_numpy().reshape(-1, STATISTICS)
                    phi, y = project(flat), batch.column("y").to_numpy()
                    gram += phi.T @ phi
                    moment += phi.T @ y
            yield pa.RecordBatch.from_arrays(
                [pa.array([gram.tobytes()]), pa.array([moment.tobytes()])], names=["gram", "moment"]
            )

        to_fit = rows.where(~F.col("held")) if 0 < n_held < n else rows
        gram, moment = np.zeros((size, size)), np.zeros(size)
        for g, m in to_fit.mapInArrow(sums, "gram binary, moment binary").toLocalIterator():
            gram += np.frombuffer(g).reshape(size, size)
            moment += np.frombuffer(m)
        penalty = RIDGE * max(1.0, gram[-1, -1]) * np.eye(size)
        penalty[-1, -1] = 0.0
        weights = np.linalg.solve(gram + penalty + 1e-9 * np.eye(size), moment)

        def binned(batches):
            for batch in batches:
                flat = batch.column("stats").flatten().to_numpy().reshape(-1, STATISTICS)
                raw = np.clip(project(flat) @ weights, -0.5, 1.5)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.round(raw * BINS).astype(np.int64)), batch.column("y")], names=["bin", "y"]
                )

        to_bin = rows.where(F.col("held")) if n_held else rows
        bins = (
            to_bin.mapInArrow(binned, "bin bigint, y double").groupBy("bin").agg(F.count(F.lit(1)), F.avg("y")).collect()
        )
    finally:
        rows.unpersist()
    knots, values = pooled(*(np.array([float(b[k]) for b in bins]) for k in range(3)))
    return {"mean": mean, "scale": scale, "weights": weights, "knots": knots / BINS, "values": values}


def predict(model: dict, stats: np.ndarray) -> np.ndarray:
    """Calibrated scores from 0 to 1."""
    if "constant" in model:
        return np.full(len(stats), model["constant"])
    raw = Projection(model["mean"], model["scale"])(stats) @ model["weights"]
    return np.clip(np.interp(np.clip(raw, -0.5, 1.5), model["knots"], model["values"]), 0.0, 1.0)


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; scores use the text alone."""
    small_batches(docs.sparkSession)
    columns = [c for c in docs.columns if c not in ("score", "predicted")]
    kept = docs.select(*columns)
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])
    project = None if "constant" in model else Projection(model["mean"], model["scale"])

    def run(batches):
        for batch in batches:
            for a, b, buf, off in tb.runs(batch.column(text)):
                stats = statistics(buf, off)
                if project is None:
                    values = predict(model, stats)
                else:
                    raw = np.clip(project(stats) @ model["weights"], -0.5, 1.5)
                    values = np.clip(np.interp(raw, model["knots"], model["values"]), 0.0, 1.0)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values)], names=[*part.schema.names, "score"])

    scored = kept.mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
