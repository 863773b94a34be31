"""Near-duplicate embeddings: a forest of random-projection trees with spill, exact comparison inside leaves.

Identical vectors are one class with a count. ``TREES`` trees halve the classes at the median of a random projection;
classes within a band around the median go to both sides. The band follows from the similarity: two unit vectors of
cosine t lie sqrt(2 - 2t) apart, and a random direction sees that distance over sqrt(d). The upper levels are fitted on
about ``SAMPLE_ROWS`` classes; leaves that still hold more than ``BLOCK`` classes are halved again in rounds, with medians
taken over all their rows. A leaf that does not shrink any more, as a dense cluster, is compared in pairs of blocks.

A pair may meet in several leaves; it counts in the smallest of them only, which each side knows from its list of
leaves. So a leaf returns one row per class, never its pairs: the number of vectors linked there and the smallest
class in its group. Sums of these rows are the links, their components the groups.

Null vectors, zero vectors and vectors with null or non-finite components link with nothing. Vectors of different
length are never compared. Rows with equal ids are vectors of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import stored
from sheafline.llm.components import components

COSINE = 0.95
TREES = 4
#: Half width of the band, in standard deviations of the projected distance of a barely linked pair.
SPILL = 0.7
SAMPLE_ROWS = 16_000
LEAF = 256
BLOCK = 1_024
#: A leaf is halved again only if that takes at least this share of its classes off both sides.
SHRINK = 0.1
ROUNDS = 24

_DENSE_BIT = 1 << 62


def band(dimension: int, cosine: float) -> float:
    """Half width of the spill band."""
    return SPILL * np.sqrt(2 - 2 * cosine) / np.sqrt(dimension)


def child(leaf: int, side: int) -> int:
    """Id of a child node: a hash of the path."""
    digest = hashlib.blake2b(f"{leaf}:{side}".encode(), digest_size=8).digest()
    return int.from_bytes(digest, "little") & (_DENSE_BIT - 1)


def direction(leaf: int, dimension: int) -> np.ndarray:
    """The node's random unit vector; it follows from the node's id."""
    v = np.random.default_rng(leaf).normal(size=dimension)
    return v / np.linalg.norm(v)


def classes(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id``, class key (null for vectors that link with nothing) and dimension of every row."""
    id_type = dict(vectors.dtypes)[vec_id]

    def run(batches):
        for batch in batches:
            keys, raw = [], []
            for value in batch.column(1):
                v = value.values
                ok = v is not None and len(v) and not v.null_count
                x = np.asarray(v.to_numpy(zero_copy_only=False), np.float64) + 0.0 if ok else None
                ok = ok and bool(np.isfinite(x).all()) and np.isfinite(x @ x) and x @ x > 0
                raw.append(x.tobytes() if ok else None)
                keys.append(hashlib.blake2b(raw[-1], digest_size=16).digest() if ok else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())], names=["vec_id", "key", "raw"]
            )

    chosen = vectors.select(F.col(vec_id).alias("vec_id"), embedding)
    return chosen.mapInArrow(run, f"vec_id {id_type}, key binary, raw binary")


def units(column: pa.Array, dimension: int) -> np.ndarray:
    """Unit vectors of equal dimension from their bytes."""
    x = np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dimension)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def grow(sample: np.ndarray, total: int, cosine: float) -> dict[int, float]:
    """Medians of the inner nodes of all trees over vectors of one dimension."""
    dimension = sample.shape[1]
    half, least = band(dimension, cosine), max(16, int(LEAF * len(sample) / max(total, 1)))
    medians: dict[int, float] = {}
    todo = [(child(t, dimension), np.arange(len(sample))) for t in range(TREES)]
    while todo:
        node, rows = todo.pop()
        if len(rows) <= least:
            continue
        p = sample[rows] @ direction(node, dimension)
        middle = float(np.median(p))
        sides = rows[p <= middle + half], rows[p >= middle - half]
        if max(map(len, sides)) > (1 - SHRINK) * len(rows):
            continue
        medians[node] = middle
        todo += [(child(node, k), side) for k, side in enumerate(sides)]
    return medians


def leaves_of(x: np.ndarray, medians: dict[int, float], cosine: float) -> list[list[int]]:
    """Leaves of each row, all trees."""
    dimension, half = x.shape[1], band(x.shape[1], cosine)
    found: list[list[int]] = [[] for _ in range(len(x))]
    todo = [(child(t, dimension), np.arange(len(x))) for t in range(TREES)]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        middle = medians.get(node)
        if middle is None:
            for i in rows:
                found[i].append(node)
            continue
        p = x[rows] @ direction(node, dimension)
        todo += [(child(node, 0), rows[p <= middle + half]), (child(node, 1), rows[p >= middle - half])]
    return found


def _by_dimension(batch: pa.RecordBatch, at: int):
    """Rows of each dimension and their unit vectors."""
    size = np.array([len(b.as_py()) // 8 for b in batch.column(at)])
    for dimension in np.unique(size):
        rows = np.flatnonzero(size == dimension)
        yield rows, units(batch.column(at).take(pa.array(rows)), int(dimension))


def assign(reps: DataFrame, cosine: float) -> DataFrame:
    """(rep, leaf) of every class."""
    total = reps.count()
    share = min(1.0, SAMPLE_ROWS / max(total, 1))
    drawn = reps.where(F.pmod(F.xxhash64("rep"), F.lit(1_000_000)) < int(share * 1_000_000) + 1).limit(2 * SAMPLE_ROWS)
    medians: dict[int, float] = {}
    sample = drawn.select("raw").toArrow().combine_chunks()
    if sample.num_rows:
        for rows, x in _by_dimension(sample.to_batches()[0], 0):
            medians |= grow(x, total * len(rows) // sample.num_rows, cosine)
    shared = reps.sparkSession.sparkContext.broadcast(medians)

    def run(batches):
        for batch in batches:
            for rows, x in _by_dimension(batch, 1):
                found = leaves_of(x, shared.value, cosine)
                counts = [len(f) for f in found]
                rep = np.repeat(batch.column(0).to_numpy()[rows], counts)
                leaf = np.array([f for fs in found for f in fs], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(leaf)], names=["rep", "leaf"])

    return reps.select("rep", "raw").mapInArrow(run, "rep bigint, leaf bigint")


def halved(placed: DataFrame, reps: DataFrame, cosine: float) -> DataFrame:
    """``placed`` (rep, leaf) with leaves above ``BLOCK`` halved until they are smaller or do not shrink."""
    done = None
    for _ in range(ROUNDS):
        sizes = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("size"))
        big = sizes.where(F.col("size") > BLOCK)
        marked = placed.join(big, "leaf", "left")
        small = marked.where("size is null").select("rep", "leaf")
        done = small if done is None else done.unionByName(small)
        large = stored(marked.where("size is not null").select("rep", "leaf"), "leaves")
        if large.isEmpty():
            return done

        def project(batches):
            known: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                leaf, out = batch.column(1).to_numpy(), np.zeros(batch.num_rows)
                wide = np.zeros(batch.num_rows)
                for rows, x in _by_dimension(batch, 2):
                    wide[rows] = band(x.shape[1], cosine)
                    for node in np.unique(leaf[rows]):
                        key = (int(node), x.shape[1])
                        if key not in known:
                            known[key] = direction(*key)
                        at = leaf[rows] == node
                        out[rows[at]] = x[at] @ known[key]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(out), pa.array(wide)], names=["rep", "leaf", "p", "half"]
                )

        projected = stored(
            large.join(reps, "rep").select("rep", "leaf", "raw").mapInArrow(project, "rep bigint, leaf bigint, p double, half double"),
            "leaves",
        )
        middle = projected.groupBy("leaf").agg(F.percentile_approx("p", F.lit(0.5), F.lit(1000)).alias("m"))
        sided = projected.join(middle, "leaf").select(
            "rep", "leaf", (F.col("p") <= F.col("m") + F.col("half")).alias("l"),
            (F.col("p") >= F.col("m") - F.col("half")).alias("r"),
        )
        sided = stored(sided, "leaves")
        shares = sided.groupBy("leaf").agg(
            F.greatest(F.sum(F.col("l").cast("int")), F.sum(F.col("r").cast("int"))).alias("most"),
            F.count(F.lit(1)).alias("all"),
        )
        judged = sided.join(shares, "leaf").withColumn("dense", F.col("most") > (1 - SHRINK) * F.col("all"))
        done = done.unionByName(judged.where("dense").select("rep", "leaf"))
        sides = F.filter(F.array(F.when(F.col("l"), F.lit(0)), F.when(F.col("r"), F.lit(1))), lambda x: x.isNotNull())
        split = judged.where("not dense").select("rep", "leaf", F.explode(sides).alias("side"))
        lower = F.shiftrightunsigned(F.xxhash64("leaf", "side"), 2)
        placed = stored(split.select("rep", lower.alias("leaf")), "leaves")
    return done.unionByName(placed)


def linked(placed: DataFrame, reps: DataFrame, cosine: float) -> DataFrame:
    """(rep, links, root) per class and leaf in which it has a link."""
    placed = stored(placed, "leaves")
    lists = placed.groupBy("rep").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))
    full = reps.join(lists, "rep")
    sizes = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep", F.lit("block")), F.col("blocks"))
    blocked = placed.join(sizes.select("leaf", blocks.alias("blocks")), "leaf").withColumn("own", own.cast("int"))
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j")),
    )
    rows = blocked.select("rep", "leaf", "own", F.explode(meets).alias("b")).select("rep", "leaf", "own", "b.i", "b.j")
    rows = rows.join(full, "rep").select("leaf", "i", "j", "own", "rep", "n", "raw", "leaves")

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("rep")
        leaf, i, j = (table.column(c)[0].as_py() for c in ("leaf", "i", "j"))
        rep, n = table.column("rep").to_numpy(), table.column("n").to_numpy()
        x = units(table.column("raw").combine_chunks(), len(table.column("raw")[0].as_py()) // 8)
        near = np.triu(x @ x.T >= cosine, 1)
        if i != j:
            side = table.column("own").to_numpy()
            near &= side[:, None] != side[None, :]
        if near.any():
            lists = table.column("leaves").combine_chunks()
            flat, ends = lists.flatten().to_numpy(), np.cumsum([len(v) for v in lists.to_pylist()])
            owner = np.searchsorted(ends, np.arange(len(flat)), "right")
            earlier = flat < leaf
            names, slot = np.unique(flat[earlier], return_inverse=True)
            if len(names):
                member = np.zeros((len(rep), len(names)), np.float32)
                member[owner[earlier], slot] = 1
                near &= ~(member @ member.T > 0)
        a, b = np.nonzero(near)
        links = np.bincount(a, n[b], len(rep)) + np.bincount(b, n[a], len(rep))
        root = np.arange(len(rep))
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        some = links > 0
        return pa.table({"rep": rep[some], "links": links[some].astype(np.int64), "root": rep[root[some]]})

    return rows.groupBy("leaf", "i", "j").applyInArrow(compare, "rep bigint, links bigint, root bigint")


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = stored(classes(vectors, vec_id, embedding), "vectors")
    grouped = rows.where("key is not null and vec_id is not null").groupBy("key")
    reps = stored(
        grouped.agg(F.min("vec_id").cast("bigint").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("raw").alias("raw")),
        "vectors",
    )
    narrow = reps.select("rep", "n", "raw")
    placed = stored(assign(narrow, cosine), "leaves")
    found = stored(linked(halved(placed, narrow, cosine), narrow, cosine), "found")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    per_class = (
        reps.select("key", "rep", "n")
        .join(counts, "rep", "left")
        .join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "key",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    out = rows.select("vec_id", "key").join(per_class, "key", "left")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", F.col("vec_id").cast("bigint")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id") == F.col("component_id"))
