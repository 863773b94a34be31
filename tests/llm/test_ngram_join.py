"""The join against brute force over shingle sets; small limits reach every step."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import awkward, empty

from sheafline.llm import common, ngram_join


def shingle_set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs, percent=80):
    sets = {i: shingle_set(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if j < i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    passages = [[rng.choice(vocabulary) for _ in range(40)] for _ in range(3)]
    docs = []
    for _ in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(3, 120))]
        docs.append(words + rng.choice(passages) * rng.randint(0, 1))
    for size in (3, 9, 60):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 150))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append(copy)
    docs += [["one", "two"], ["One", "two"], ["one", "two", "three", "four", "five"], []]
    rng.shuffle(docs)
    return [(i, " ".join(w)) for i, w in enumerate(docs)]


@pytest.mark.parametrize("group,broadcast", [(2, 500_000), (2, 0), (16, 500_000)])
def test_groups(spark, monkeypatch, group, broadcast):
    monkeypatch.setattr(ngram_join, "GROUP", group)
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", broadcast)
    monkeypatch.setattr(common, "BROADCAST_IDS", broadcast)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "CHUNK", 8)
    docs = corpus()
    got = ngram_join.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs)


@pytest.mark.parametrize("percent", [50, 65, 95])
def test_other_similarities(spark, percent):
    rng = random.Random(percent)
    pairs = []
    for _ in range(30):
        base = [f"w{rng.randrange(4_000)}" for _ in range(80)]
        pairs += [base, base[: rng.randint(60, 78)] + [f"w{rng.randrange(4_000)}" for _ in range(rng.randint(0, 10))]]
    docs = [(i, " ".join(w)) for i, w in enumerate(pairs)]
    want = brute(docs, percent)
    got = ngram_join.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) < 60


def test_rows_are_kept_by_text_and_named_by_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (1, a), (2, b), (3, b), (3, c), (None, "x y z"), (None, "x y z"), (4, None), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("component_id", F.lit(7))
    kept = sorted(((r.doc_id, r.text) for r in ngram_join.one_of_each(docs).collect()), key=repr)
    assert kept == sorted([(1, a), (2, b), (3, c), (None, "x y z"), (4, None), (4, None)], key=repr)
    assert ngram_join.one_of_each(docs).columns == docs.columns
    got = sorted(((r.doc_id, r.component_id) for r in ngram_join.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(1, 1), (1, 1), (2, 2), (3, 2), (3, 2), (None, None), (None, None), (4, 4), (4, 4)], key=repr)
    with pytest.raises(TypeError, match="whole number"):
        ngram_join.near_duplicates(docs.withColumn("doc_id", F.col("doc_id").cast("string")))


def test_trie_equals_set_overlap():
    rng = np.random.default_rng(2)
    sets = [(k, np.unique(rng.integers(0, 60, rng.integers(1, 50)))) for k in range(200)]
    trie = ngram_join.Trie(sets)
    for _, probe in sets[:80]:
        want = {
            k for k, s in sets
            if 100 * len(np.intersect1d(s, probe)) >= 80 * len(np.union1d(s, probe))
        }
        assert set(trie.matches(probe)) == want


def test_awkward_rows(spark):
    got = {r.doc_id: r for r in ngram_join.near_duplicates(awkward(spark)).collect()}
    assert [got[i].n_shingles for i in (2, 3, 4, 6)] == [0, 0, 0, 1]
    assert got[1].component_id == got[5].component_id == 1
    assert got[None].component_id in (None, 1)
    assert ngram_join.near_duplicates(awkward(spark)).count() == 9
    assert ngram_join.near_duplicates(empty(spark)).collect() == []
    kept = {r.doc_id for r in ngram_join.one_of_each(awkward(spark)).collect()}
    assert {1, 2, 3, 4, 6, 7} <= kept and 5 not in kept
