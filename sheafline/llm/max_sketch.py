"""Ranked lexical search over hashed max-sketches with exact rescoring.

The index holds one row per document: its number of terms, its distinct terms as sorted 64-bit hashes with their
frequencies, and a sketch. The sketch is an array of bytes, ``SPACE`` to twice as many as the document has distinct
terms; each term is hashed to ``WAYS`` coordinates, and a coordinate keeps the largest frequency of its terms. A term's
impact grows with its frequency, so the least of its coordinates bounds its impact from above, and the bounds of a
query's terms add up to a bound of its score. A frequency of 255 or more counts as unlimited in bounds.

A search takes its items in blocks of bounded size. Each task looks all terms of a block up in the sketches of some
documents at once, then rescores the documents of each item exactly, from the highest bound down in growing steps,
until no bound reaches the item's k-th best score. A task keeps k documents per item; the tasks' lists are merged by
Spark. Nothing is joined or shuffled but these lists and the document frequencies of the block's terms.

Scores are integers. With N documents that have a term, L terms in all, n terms of a document, df documents with a
term and tf its occurrences: weight w = floor(1000 ln((2N + 2) / (2df + 1))), m = 10 + (90 n N) div L, and a document
scores the sum of w ((10^9 tf) div (1000 tf + 8m)) over the item's distinct terms.

Terms are runs of ASCII letters, digits and all characters above 127; A-Z count as a-z. Null and empty texts have no
term and are never found; an item without one has no row, and an empty table gives an empty result. Rows of one item id
are one item of all their terms, null being an id. Repeated documents are found each for itself. Equal scores are
ordered by document id, nulls last. Texts of any length are indexed whole; other columns are ignored.
"""

from __future__ import annotations

import math
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.llm import textbytes as tb
from sheafline.llm.common import small_batches, stored

#: Coordinates of a sketch: the next power of two from so many per distinct term.
SPACE = 8
#: Coordinates of each term.
WAYS = 2
#: Item terms of one block on average; a block is broadcast.
BLOCK_TERMS = 100_000
#: Terms looked up at once: documents times item terms.
CELLS = 1 << 20
#: Ranks per item.
TOP = 10
_UNLIMITED = 255
_BYTES = np.arange(256)
_GAP = ~(
    np.isin(_BYTES, np.arange(48, 58)) | np.isin(_BYTES, np.arange(65, 91)) | np.isin(_BYTES, np.arange(97, 123))
    | (_BYTES >= 0x80)
)


def term_counts(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term hash, frequency) of the distinct terms of each text, by row and hash."""
    starts, ends, row = tb.spans(_GAP[buf], off)
    h = tb.hashed(tb.LOWER[buf], starts, ends)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(fresh)
    return row[first], h[first], np.diff(np.append(first, len(h)))


def coordinates(h: np.ndarray, way: int, size: np.ndarray | int) -> np.ndarray:
    """Where each term lies in a sketch of ``size`` coordinates, a power of two."""
    mask = np.asarray(size, np.uint64) - np.uint64(1)
    return (tb.mixed(h + np.uint64(0x9E37 * (way + 1))) & mask).astype(np.int64)


def sketches(row: np.ndarray, h: np.ndarray, tf: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the sketches of ``rows`` documents."""
    distinct = np.bincount(row, minlength=rows)
    size = np.where(distinct, 1 << np.ceil(np.log2(np.maximum(distinct * SPACE, 1))).astype(np.int64), 0)
    off = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(off[-1], np.uint8)
    for way in range(WAYS):
        np.maximum.at(out, off[row] + coordinates(h, way, size[row]), np.minimum(tf, _UNLIMITED).astype(np.uint8))
    return out, off


def _binary(values: np.ndarray, off: np.ndarray) -> pa.Array:
    """Binary values cut from one array at element offsets."""
    at = pa.py_buffer((off * values.itemsize).astype(np.int64).tobytes())
    data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(off) - 1, [None, at, data]).cast(pa.binary())


def build_index(docs: DataFrame, text: str = "text") -> DataFrame:
    """The index of ``docs``, written to the shared folder: doc_id, n, sketch, terms, tfs."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType().add("doc_id", kind).add("n", T.LongType())
    for name in ("sketch", "terms", "tfs"):
        schema = schema.add(name, T.BinaryType())

    def run(batches):
        for batch in batches:
            for a, b, buf, off in tb.runs(batch.column(1)):
                row, h, tf = term_counts(buf, off)
                at = np.searchsorted(row, np.arange(b - a + 1))
                n = np.bincount(row, tf, b - a).astype(np.int64)
                lists = [_binary(*sketches(row, h, tf, b - a)), _binary(h, at), _binary(tf.astype(np.uint32), at)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n), *lists], names=schema.names)

    return stored(docs.select("doc_id", text).mapInArrow(run, schema), "lexical")


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, h): the distinct terms of each item."""
    schema = T.StructType().add("item", items.schema[item_id].dataType).add("h", T.LongType())

    def run(batches):
        for batch in batches:
            for a, b, buf, off in tb.runs(batch.column(1)):
                row, h, _ = term_counts(buf, off)
                ids = batch.column(0).slice(a, b - a).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([ids, pa.array(h.view(np.int64))], names=["item", "h"])

    return items.select(item_id, text).mapInArrow(run, schema).distinct()


def flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary column as one array, and the element offsets of its rows."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    values = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return values.view(kind) if len(values) else np.zeros(0, kind), (off - off[0]) // np.dtype(kind).itemsize


def frequencies(index: DataFrame, wanted: np.ndarray) -> dict[int, int]:
    """Documents that hold each of the wanted terms (sorted hashes); terms in none are left out."""
    shared = index.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        wanted = shared.value
        total = np.zeros(len(wanted) + 1, np.int64)
        for batch in batches:
            terms, _ = flat(batch.column(0), np.uint64)
            at = np.searchsorted(wanted, terms)
            at[(at < len(wanted)) & (wanted[np.minimum(at, len(wanted) - 1)] != terms)] = len(wanted)
            total += np.bincount(at, minlength=len(wanted) + 1)
        some = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["i", "df"])

    counted = index.select("terms").mapInArrow(run, "i bigint, df bigint").groupBy("i").agg(F.sum("df").alias("df"))
    return {int(wanted[r.i]): r.df for r in counted.collect()}


class Plan:
    """A block of items: their ids, distinct terms and weights, and the cut of the terms by item."""

    def __init__(self, ids: list, items: np.ndarray, terms: np.ndarray, weights: np.ndarray, documents: int, length: int):
        self.ids, self.documents, self.length = ids, documents, length
        order = np.argsort(items, kind="stable")
        self.hashes, self.term = np.unique(terms[order], return_inverse=True)
        self.weight = weights[order]
        self.cut = np.searchsorted(items[order], np.arange(len(ids) + 1))

    def norm(self, n: np.ndarray) -> np.ndarray:
        """m of documents with n terms."""
        return 10 + (90 * n * self.documents) // self.length

    def bounds(self, sketch: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores: documents (sketches of one size) by items."""
        most = sketch[:, coordinates(self.hashes, 0, sketch.shape[1])]
        for way in range(1, WAYS):
            np.minimum(most, sketch[:, coordinates(self.hashes, way, sketch.shape[1])], out=most)
        tf = np.arange(256)
        impact = (10**9 * tf) // (1000 * tf + 8 * self.norm(n)[:, None])
        impact[:, _UNLIMITED] = 10**6
        each = np.take_along_axis(impact, most.astype(np.int64), axis=1)
        return np.add.reduceat(each[:, self.term] * self.weight, self.cut[:-1], axis=1)

    def scores(self, doc: np.ndarray, item: np.ndarray, terms, off: np.ndarray, tfs, n: np.ndarray) -> np.ndarray:
        """Exact scores of pairs of a document and an item: each term is sought in the document's sorted terms."""
        count = (self.cut[1:] - self.cut[:-1])[item]
        pair = np.repeat(np.arange(len(item)), count)
        entry = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count) + self.cut[item][pair]
        sought = self.hashes[self.term[entry]]
        low, high = off[doc][pair], off[doc + 1][pair]
        end = high.copy()
        while (low < high).any():
            middle = (low + high) >> 1
            less = (low < high) & (terms[np.minimum(middle, len(terms) - 1)] < sought)
            low, high = np.where(less, middle + 1, low), np.where(less, high, np.minimum(middle, high))
        hit = low < end
        hit[hit] = terms[low[hit]] == sought[hit]
        tf = tfs[low[hit]].astype(np.int64)
        value = self.weight[entry[hit]] * ((10**9 * tf) // (1000 * tf + 8 * self.norm(n)[doc[pair[hit]]]))
        total = np.zeros(len(item), np.int64)
        np.add.at(total, pair[hit], value)
        return total


class Best:
    """The k best documents of each item so far."""

    def __init__(self, items: int, k: int, kind: pa.DataType):
        self.items, self.k = items, k
        self.rows = pa.table({"item": pa.array([], pa.int64()), "score": pa.array([], pa.int64()), "doc": pa.array([], kind)})
        self.least = np.ones(items, np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, doc: pa.Array) -> None:
        """Take scored documents in; ``least`` is then the score that a document needs to be among the k best."""
        good = score >= self.least[item]
        if not good.any():
            return
        new = pa.table({"item": item[good], "score": score[good], "doc": doc.filter(pa.array(good))})
        rows = pa.concat_tables([self.rows, new]).combine_chunks()
        rows = rows.sort_by([("item", "ascending"), ("score", "descending"), ("doc", "ascending")])
        item = rows["item"].to_numpy()
        place = np.arange(len(item)) - np.searchsorted(item, item)
        self.rows = rows.filter(pa.array(place < self.k))
        last = place == self.k - 1
        self.least[item[last]] = rows["score"].to_numpy()[last]


def search_block(batches, plan: Plan, k: int, kind: pa.DataType) -> Best:
    """The best documents of one task: bounds of all, exact scores from the highest bound down until none can matter."""
    best = Best(len(plan.ids), k, kind)
    at_once = max(1, CELLS // len(plan.term))
    for batch in batches:
        docs, n = batch.column(0), batch.column(1).to_numpy()
        sketch, sketch_off = flat(batch.column(2), np.uint8)
        terms, off = flat(batch.column(3), np.uint64)
        tfs, _ = flat(batch.column(4), np.uint32)
        size = np.diff(sketch_off)
        for width in np.unique(size[size > 0]).tolist():
            rows = np.flatnonzero(size == width)
            for i in range(0, len(rows), at_once):
                here = rows[i : i + at_once]
                bound = plan.bounds(sketch[sketch_off[here][:, None] + np.arange(width)], n[here])
                order = np.argsort(-bound, axis=0, kind="stable")
                first, step = 0, k
                while first < len(here):
                    part = order[first : first + step]
                    item = np.broadcast_to(np.arange(len(plan.ids)), part.shape)
                    near = bound[part, item] >= best.least
                    if not near.any():
                        break
                    doc, which = here[part[near]], item[near]
                    best.add(which, plan.scores(doc, which, terms, off, tfs, n), docs.take(pa.array(doc)))
                    first, step = first + step, step * 4
    return best


def search(index: DataFrame, items: DataFrame, k: int = TOP, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The k best documents of each item: item_id, rank, doc_id, score."""
    spark = index.sparkSession
    small_batches(spark)
    wanted = stored(item_terms(items, item_id, text), "items")
    documents, length = index.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    blocks = max(1, -(-wanted.count() // BLOCK_TERMS)) if documents else 0
    id_type, doc_type = items.schema[item_id].dataType, index.schema["doc_id"].dataType
    schema = T.StructType().add("item_id", id_type).add("doc_id", doc_type).add("score", T.LongType())
    found = spark.createDataFrame([], schema)
    for block in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toArrow()
        terms = rows["h"].to_numpy().view(np.uint64)
        if not len(terms):
            continue
        df = frequencies(index, np.unique(terms))
        held = np.fromiter((int(h) in df for h in terms), bool, len(terms))
        if not held.any():
            continue
        rows, terms = rows.filter(pa.array(held)), terms[held]
        names = rows["item"].combine_chunks()
        ids = names.unique()
        place = {v: i for i, v in enumerate(ids.to_pylist())}
        number = np.array([place[v] for v in names.to_pylist()], np.int64)
        weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df[int(h)] + 1))) for h in terms]
        plan = Plan(ids.to_pylist(), number, terms, np.array(weights, np.int64), documents, length)
        shared = spark.sparkContext.broadcast(plan)

        def run(batches, shared=shared, id_kind=ids.type):
            plan, batches = shared.value, iter(batches)
            first = next(batches, None)
            if first is None:
                return
            rows = search_block(chain([first], batches), plan, k, first.column(0).type).rows.combine_chunks()
            for batch in rows.to_batches(max_chunksize=10_000):
                ids = pa.array([plan.ids[i] for i in batch["item"].to_pylist()], id_kind)
                yield pa.RecordBatch.from_arrays([ids, batch["doc"], batch["score"]], names=schema.names)

        part = index.select("doc_id", "n", "sketch", "terms", "tfs").mapInArrow(run, schema)
        found = found.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item_id").alias(item_id), "rank", "doc_id", "score")

