"""The forest against brute force, with dense clusters, copies and broken vectors."""

import numpy as np
import pytest

from sheafline.llm import rp_forest


def brute(vectors, cosine=0.95):
    ok = [v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in vectors]
    n = len(vectors)
    links, root = np.zeros(n, int), list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if o else None for (_, v), o in zip(vectors, ok, strict=True)]
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {vectors[i][0]: (links[i], vectors[find(i)][0]) for i in range(n)}


@pytest.mark.parametrize("leaf,block", [(256, 1024), (24, 48)])
def test_links_and_groups(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(rp_forest, "LEAF", leaf)
    monkeypatch.setattr(rp_forest, "BLOCK", block)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(250, 32))
    near = base[:120] + rng.normal(size=(120, 32)) * rng.uniform(0.05, 0.4, (120, 1))
    dense = base[7] + rng.normal(size=(150, 32)) * 0.12
    rows = [v.tolist() for v in np.vstack([base, near, dense])] + [base[3].tolist()] * 40
    rows += [None, [0.0] * 32, [float("nan")] + [1.0] * 31, [None] + [1.0] * 31, [], [1.0, 2.0], [2.0, 4.0]]
    vectors = list(enumerate(rows))
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r for r in rp_forest.near_duplicates(df).collect()}
    want = brute(vectors)
    assert set(got) == set(want)
    assert all(got[i].n_links <= want[i][0] for i in want)
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(w[0] for w in want.values())
    assert sum(got[i].component_id == want[i][1] for i in want) >= 0.97 * len(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    for i in range(len(rows) - 7, len(rows) - 2):
        assert (got[i].n_links, got[i].component_id) == (0, i)


def test_no_rows(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>, n_links string")
    assert rp_forest.near_duplicates(df).collect() == []
