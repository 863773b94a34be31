"""Periodic runs against a plain scan of every lag, and awkward inputs."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import awkward, empty

from sheafline.llm import period_runs, textbytes
from sheafline.llm.queries import QUERIES


def plain_runs(words):
    """Every lag, word by word: (start, length, period)."""
    n, least = len(words), {}
    for q in range(1, n // 2 + 1):
        t = 0
        while t + q < n:
            s = t
            while t + q < n and words[t] == words[t + q]:
                t += 1
            if t + q - s >= max(12, 2 * q):
                least.setdefault((s, t + q), q)
            t += t == s
    return sorted((s, e - s, q) for (s, e), q in least.items())


def fast_runs(texts):
    row = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    values = textbytes.mixed(np.array([w for x in texts for w in x], np.uint64) + np.uint64(1))
    start, stop, period = period_runs.runs_in(values, row)
    base = np.searchsorted(row, np.arange(len(texts)))
    out = [[] for _ in texts]
    for s, e, q in zip(start.tolist(), stop.tolist(), period.tolist(), strict=True):
        out[row[s]].append((s - int(base[row[s]]), e - s, q))
    return out


def periodic(rng):
    n, letters = rng.randint(0, 140), rng.choice([1, 2, 3, 5, 30])
    x = [rng.randrange(letters) for _ in range(n)]
    if n and rng.random() < 0.7:
        a, p = rng.randrange(n), rng.randint(1, max(1, n // 3))
        x = x[:a] + [x[a + (i - a) % min(p, n - a)] for i in range(a, n)]
        if rng.random() < 0.5:
            x[rng.randrange(n)] = 99
    return x


def test_many_texts_at_once():
    rng = random.Random(1)
    for _ in range(120):
        texts = [periodic(rng) for _ in range(rng.randint(1, 6))]
        assert fast_runs(texts) == [plain_runs(x) for x in texts]


@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4))
@settings(max_examples=200, deadline=None)
def test_any_texts(texts):
    assert fast_runs(texts) == [plain_runs(x) for x in texts]


@pytest.mark.parametrize("rounds,top", [(0, 16), (1, 1), (64, 0)])
def test_splitting_and_block_sizes_decide_nothing(monkeypatch, rounds, top):
    monkeypatch.setattr(period_runs, "ROUNDS", rounds)
    monkeypatch.setattr(period_runs, "TOP", top)
    rng = random.Random(2)
    texts = [periodic(rng) for _ in range(60)]
    assert fast_runs(texts) == [plain_runs(x) for x in texts]


def test_long_texts():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 50, 60_000)
    x[10_000:] = x[10_000:][np.arange(50_000) % 9_000]
    assert (10_000, 50_000, 9_000) in fast_runs([x.tolist()])[0]
    assert fast_runs([[1] * 60_000, [1, 2] * 30_000]) == [[(0, 60_000, 1)], [(0, 60_000, 2)]]


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_query_agrees_with_plain_code(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want, planted = set(), 0
    for d in docs:
        words = [w.decode() for w in (d.text or "").encode().split()]
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        if n > 3_000:
            continue  # too long for the plain scan; their runs are compared above
        runs = plain_runs(words)
        planted += bool(runs)
        s, m, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        want.add((d.doc_id, len(runs), s, m, q, m and 1000 * m // q, digest(lines), digest(collapsed(words, runs))))
    got = {tuple(r) for r in QUERIES["op12_period_runs"](spark, sf_dir).collect()}
    assert want <= got and len(got) == len(docs) and planted > 10


def test_awkward_rows(spark):
    docs = awkward(spark).withColumnsRenamed({"kept": "runs", "lang": "collapsed"})
    rows = period_runs.find_runs(docs).collect()
    assert len(rows) == 9 and "score" in rows[0]
    for r in rows:
        words = [w.decode() for w in (r.text or "").encode().split()]
        runs = [tuple(x) for x in r.runs]
        assert runs == (plain_runs(words) if len(words) < 1_000 else [(0, 60_000, 3)])
        assert r.collapsed == collapsed(words, runs)
    assert period_runs.find_runs(empty(spark)).collect() == []
