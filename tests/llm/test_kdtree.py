"""Exact top-k search against brute force."""
import math

import numpy as np

from roadlens.llm import kdtree

SCHEMA = "vec_id long, embedding array<float>, id string, code string, shard long"


def brute(rows, k, every):
    sound = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in sound:
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j) for j, c in sound if j != i and len(c) == len(q))[:k]
            out += [(i, n, j, max(-2 ** 63, min(2 ** 63 - 1, -s))) for n, (s, j) in enumerate(found, 1)]
    return sorted(out)


def run(spark, rows, **options):
    table = spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], SCHEMA).repartition(4)
    return sorted(tuple(r) for r in kdtree.top_products(table, **options).collect())


def test_top_products(spark):
    rng = np.random.default_rng(31)
    centre = rng.normal(size=(12, 8))
    x = np.concatenate([np.repeat(centre, 40, 0) + .05 * rng.normal(size=(480, 8)), rng.normal(size=(300, 8))])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x.astype(np.float32))]
    one = rows[7][1]
    rows += [(1000 + i, one) for i in range(400)]  # a group of a third: ties by id, more copies than any result holds
    rows += [(2000, None), (2020, [None] * 8), (2040, [float("nan")] * 8), (2060, [float("inf")] * 8), (2080, []), (2081, []), (None, one), (2100, [0.0] * 8),
             (2120, [1.0, 2.0]), (2121, [3.0, -1.0]), (2140, [-5.0]), (1000, one), (3, rows[3][1]), (-20, one)]
    want = brute(rows, 20, 20)
    assert run(spark, rows) == want
    assert run(spark, rows, target=50, block=7, sample=100) == want  # many shards and waves
    assert run(spark, rows[:15], k=20) == brute(rows[:15], 20, 20)  # fewer candidates than k
    assert run(spark, rows[:1], k=20) == [] and run(spark, rows[500:501]) == []
    empty = spark.createDataFrame([], SCHEMA)
    assert kdtree.top_products(empty).collect() == []


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(32)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=3) * 10.0 ** rng.integers(0, 9)]) for i in range(300)]
    rows += [(400 + i, [2.0 ** 24, 2.0 ** 24 + 2 * i, 1.0]) for i in range(40)] + [(500, [1e30, 1.0, 1.0]), (501, [-1e30, 0.0, 3e38])]
    assert run(spark, rows, k=5, target=60, block=9) == brute(rows, 5, 20)


def test_tree_boxes_are_tight_and_bound(spark):
    rng = np.random.default_rng(33)
    x = np.floor(rng.normal(size=(500, 6)) * 30)
    order, first, last, child, low, high = kdtree.build_tree(x, 16)
    q = np.floor(rng.normal(size=(9, 6)) * 30)
    reach = kdtree.bounds(q, low, high)
    for i in range(len(first)):
        own = x[order[first[i]:last[i]]]
        assert (own.min(0) == low[i]).all() and (own.max(0) == high[i]).all() and ((own @ q.T).max(0) <= reach[:, i]).all()
        assert child[i] or len(own) <= 16
    assert sorted(order[a:b].tolist() for a, b, c in zip(first, last, child, strict=True) if not c) and sum(b - a for a, b, c in zip(first, last, child, strict=True) if not c) == 500
