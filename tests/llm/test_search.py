"""Exact search against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from ordertally.llm import topk_search

ROWS = "vec_id long, embedding array<double>, label int"


def brute(rows, every=50):
    ok = [
        (i, [math.floor(256 * x) for x in v])
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, q in ok:
        if i % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in ok if j != i)[:5]
        cut = lambda s: min(max(s, -(2**63)), 2**63 - 1)
        out += [(i, rank, j, cut(-s)) for rank, (s, j) in enumerate(scores, 1)]
    return sorted(out)


def run(spark, rows, every=50):
    got = topk_search.top_k(spark.createDataFrame(rows, ROWS), every)
    return sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect())


def test_nulls_ties_repeats_and_odd_vectors(spark):
    rng = random.Random(1)
    vec = lambda n=8, s=1.0: [rng.choice([-1, 0, 1, 0.5, rng.uniform(-1, 1)]) * s for _ in range(n)]
    rows = [(i, vec(), 0) for i in range(300)]
    hot = vec()
    rows += [(1000 + i, list(hot), 1) for i in range(200)] + [(2000, list(hot), 1), (2000, list(hot), 1)]
    rows += [(3000, None, 0), (3050, [1.0, None], 0), (3100, [float("nan")] * 8, 0), (3150, [float("inf"), 1.0], 0)]
    rows += [(None, vec(), 0), (3200, [], 0), (3250, [0.0] * 8, 0), (3300, vec(20), 0), (3301, vec(3), 0), (-50, vec(), 0)]
    want = brute(rows)
    got = run(spark, rows)
    # Both rows of id 2000 are queries of their own.
    assert got == want and len([r for r in got if r[0] == 2000]) == 10


def test_huge_components(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.choice([0, 3, 9, 16, 30]) for _ in range(5)], 0) for i in range(120)]
    want = brute(rows)
    got = run(spark, rows)
    assert [(r[0], r[1], r[3]) for r in got] == [(r[0], r[1], r[3]) for r in want]


@pytest.mark.parametrize("dims", [64, 7])
def test_shards_and_query_groups(spark, monkeypatch, dims):
    monkeypatch.setattr(topk_search, "SHARD_ROWS", 100)
    monkeypatch.setattr(topk_search, "BLOCK_QUERIES", 8)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    vectors = topk_search.usable(spark.createDataFrame(rows, ROWS))
    index = topk_search.build_index(vectors, 100).cache()
    got = topk_search.search(index, vectors.filter("id % 10 = 0"), group_bytes=2000)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 10)
    index.unpersist()


def test_few_rows_and_none(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0], 0)]) == []
    assert run(spark, [(0, [1.0], 0), (7, [2.0], 0)]) == [(0, 1, 7, 131072)]


def test_segments_descend_and_leave_small_rests():
    rng = np.random.default_rng(4)
    m = topk_search.matrix_of([list(v) for v in rng.normal(size=(50, 6))])
    segments = topk_search.posting_segments(m)
    impacts = [i for i, _ in segments]
    assert impacts == sorted(impacts, reverse=True) and len(impacts) <= topk_search.LEVELS + 1
    rest = m.astype(float).T.copy()
    for impact, places in segments:
        up, down = places[places >= 0], ~places[places < 0]
        assert (np.bincount(np.concatenate([up, down]), minlength=m.size) <= 1).all()
        rest.reshape(-1)[up] -= impact
        rest.reshape(-1)[down] += impact
    step = np.abs(m.astype(float)).max() / topk_search.LEVELS
    assert np.abs(rest).max() <= step / 2 + 1e-6
