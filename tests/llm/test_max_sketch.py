"""Search by max-sketches against scores of all pairs, bounds, and awkward inputs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from oracle import differences, duck
from pyspark.sql import functions as F
from samples import awkward, empty

from sheafline.llm import max_sketch
from sheafline.llm.queries import QUERIES, SQL

_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return _TERM.findall((text or "").translate(_LOWER))


def plain(docs, items, k=10):
    """Rows of (doc_id, text) ranked for rows of (item_id, text)."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    total = sum(1 for _, c in counts if c)
    length = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, words in wanted.items():
        ranked = []
        for i, c in counts:
            n = sum(c.values())
            m = 10 + 90 * n * total // length if n else 0
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in words if t in c
            )
            if score > 0:
                ranked.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(ranked)[:k])]
    return sorted(out, key=repr)


def found(spark, docs, items, **options):
    index = max_sketch.build_index(docs)
    return sorted((tuple(r) for r in max_sketch.search(index, items, **options).collect()), key=repr)


def corpus(spark, rows, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    pick = lambda n: " ".join(vocabulary[min(int(rng.paretovariate(0.6)) - 1, 399)] for _ in range(n))
    docs = [(i, pick(rng.choice([1, 5, 40, 300]))) for i in range(rows)]
    items = [(f"i{k}", pick(rng.randint(1, 30))) for k in range(25)]
    make = lambda data, kind: spark.createDataFrame(data, f"{kind}, text string")
    return docs, items, make(docs, "doc_id bigint").repartition(5), make(items, "item_id string")


@pytest.mark.parametrize("space,ways,cells,block", [(8, 2, 1 << 20, 100_000), (1, 1, 1, 7), (1, 3, 5_000, 40)])
def test_equal_to_all_pairs(spark, monkeypatch, space, ways, cells, block):
    """Whatever the size of sketches, groups and blocks."""
    for name, value in (("SPACE", space), ("WAYS", ways), ("CELLS", cells), ("BLOCK_TERMS", block)):
        monkeypatch.setattr(max_sketch, name, value)
    docs, items, frame, queries = corpus(spark, 150)
    assert found(spark, frame, queries) == plain(docs, items)
    assert found(spark, frame, queries, k=3) == plain(docs, items, 3)


def test_copies_and_large_frequencies(spark):
    docs = [(i, "alpha beta gamma") for i in range(500, 0, -1)] + [(900, "alpha " * 400 + "beta"), (901, "delta")]
    items = [(1, "alpha BETA"), (2, "delta, delta!"), (3, "nothing"), (4, ""), (5, None), (1, "gamma")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert found(spark, frame, spark.createDataFrame(items, "item_id int, text string")) == plain(docs, items)


def test_bounds_hold_and_save_work():
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.3, 200) % 3_000) for _ in range(300)]
    array = pa.array(texts, pa.large_string())
    [(_, _, buf, off)] = max_sketch.tb.runs(array, 1 << 30)
    row, h, tf = max_sketch.term_counts(buf, off)
    n, at = np.bincount(row, tf).astype(np.int64), np.searchsorted(row, np.arange(301))
    sketch, cut = max_sketch.sketches(row, h, tf, 300)
    item, which = np.repeat(np.arange(20), 15), rng.choice(np.unique(h), 300, replace=False)
    plan = max_sketch.Plan(list(range(20)), item, which, rng.integers(1, 9_000, 300), 300, int(n.sum()))
    exact = plan.scores(*(x.ravel() for x in np.indices((300, 20))), h, at, tf, n).reshape(300, 20)
    for i in range(300):
        bound = plan.bounds(sketch[cut[i] : cut[i + 1]][None], n[i : i + 1])[0]
        assert (bound >= exact[i]).all() and (bound == exact[i]).mean() > 0.2


def test_query_agrees_with_sql_on_more_rows(spark):
    sf = "/root/testdata/sf0.01"
    assert not differences(QUERIES["op11_lexical_search"](spark, sf), duck(sf), SQL["op11_lexical_search"])


def test_awkward_rows(spark):
    docs = awkward(spark).withColumn("n", F.lit("x")).withColumn("sketch", F.lit(1)).withColumn("rank", F.lit(2))
    items = [(1, "The FOX, the lazy dog!"), (None, "bird"), (None, "birds lorem"), (2, None), (3, " "), (4, "été word")]
    queries = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(3))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(spark, docs, queries) == plain(rows, items)
    assert found(spark, empty(spark), queries) == []
    assert found(spark, docs, queries.limit(0)) == []
    named = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    assert {r[2] for r in found(spark, named, queries)} == {None if i is None else str(i) for _, _, i, _ in plain(rows, items)}
