"""Nearest points and counts in the tree of cells against brute force."""
import math
import random

import pytest

from roadlens.operators import quadtree as T


def frame(spark, rows, prefix):
    return spark.createDataFrame(rows, f"{prefix}_id long, x double, y double").repartition(3)


def fixture(seed):
    rnd = random.Random(seed)
    city = [(i, 500 + rnd.random(), 500 + rnd.random()) for i in range(400)]  # dense: a million times the mean
    land = [(1000 + i, rnd.random() * 1000, rnd.random() * 1000) for i in range(150)]
    same = [(2000 + i, 250.0, 250.0) for i in range(120)]  # equal coordinates
    right = city + land + same + [(3000, None, 1.0), (3001, float("nan"), 1.0)]
    left = [(i, rnd.random() * 1000, rnd.random() * 1000) for i in range(120)] + [(200, 1e7, -1e7), (201, -5e5, 500.0), (202, 500.5, 500.5), (203, 250.0, 250.0),
                                                                                 (204, None, 3.0), (205, 3.0, None), (206, float("nan"), 0.0)]
    return left, right


def dist(a, b):
    return math.sqrt((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2)


def sound(p):
    return p[1] is not None and p[2] is not None and math.isfinite(p[1]) and math.isfinite(p[2])


@pytest.mark.parametrize("ties", ["first", "all"])
def test_nearest(spark, ties):
    left, right = fixture(1)
    right += [(4000, 9000.0, 0.0), (4001, -9000.0, 0.0)]
    left.append((300, 0.0, -1e6))  # ties far out
    got = sorted((r.l_id, r.r_id, r.distance) for r in T.nearest_unbounded(frame(spark, left, "l"), frame(spark, right, "r"), "l_id", "r_id", ties=ties).collect())
    want = []
    for p in left:
        d = sorted((round(dist(p, q), 6), q[0]) for q in right if sound(q)) if sound(p) else []
        best = [k for v, k in d if v == d[0][0]]
        want += [(p[0], k, d[0][0]) for k in (best[:1] if ties == "first" else best)] or [(p[0], None, None)]
    assert [(a, b) for a, b, _ in got] == sorted((a, b) for a, b, _ in want)
    for (_, _, d), (_, _, w) in zip(got, sorted(want, key=lambda r: r[:2]), strict=True):
        assert d == w or d == pytest.approx(w, abs=1e-6)


@pytest.mark.parametrize("radius", [0.4, 30.0, 800.0])
def test_counts(spark, radius):
    left, right = fixture(2)
    left.append((301, 250.0 + radius, 250.0))  # at exactly the radius
    got = {r.l_id: r.n for r in T.count_within(frame(spark, left, "l"), frame(spark, right, "r"), "l_id", "r_id", radius, "n").collect()}
    assert got == {p[0]: sum(dist(p, q) <= radius for q in right if sound(q)) if sound(p) else 0 for p in left}


def test_empty_sides(spark):
    left, right = fixture(3)
    none = frame(spark, right, "r").limit(0)
    assert {(r.r_id, r.distance) for r in T.nearest_unbounded(frame(spark, left, "l"), none, "l_id", "r_id").collect()} == {(None, None)}
    assert {r.n for r in T.count_within(frame(spark, left, "l"), none, "l_id", "r_id", 5.0, "n").collect()} == {0}
    assert T.nearest_unbounded(frame(spark, left, "l").limit(0), frame(spark, right, "r"), "l_id", "r_id").count() == 0


def test_rows_meet_few_points(spark):
    """However dense the city, a row meets LEAF places in each leaf left to it;
    a far row sees the leaves along its side only."""
    rnd = random.Random(4)
    right = frame(spark, [(i, 500 + rnd.random(), 500 + rnd.random()) for i in range(4000)], "r")
    left, placed = T._prepared(frame(spark, [(0, 1e6, 0.0), (1, 500.5, 500.5), (2, 0.0, 0.0)], "l"), "l_id", "x", "y")
    nodes, leaves = T.build(T._right(right, "r_id", "x", "y"))
    assert leaves.count() == 4000 and leaves.groupBy("node").count().agg({"count": "max"}).first()[0] <= T.LEAF
    assert nodes.where("leaf").agg({"n": "sum"}).first()[0] == 4000

    from pyspark.sql import functions as F

    def prune(df):
        return df.withColumn("_l", F.array_min(F.transform("_nodes", T._surely)) + T.SLACK).withColumn("_nodes", F.filter("_nodes", lambda b: T._apart(b) <= F.col("_l"))).drop("_l")
    met = [len(r._leaves) for r in T.descend(placed, nodes, prune, []).collect()]
    assert max(met) <= 4 * math.sqrt(4000 / T.LEAF)


def small_parts(monkeypatch):
    for name, value in (("LEAF", 2), ("ROWS", 4), ("MOST", 8), ("SLICE", 2), ("TOGETHER", 16)):
        monkeypatch.setattr(T, name, value)


@pytest.mark.parametrize("radius", [0.4, 30.0])
def test_boxes_in_blocks_and_slices(spark, monkeypatch, radius):
    small_parts(monkeypatch)
    left, right = fixture(5)
    left += [(400 + i, 500.5, 500.5) for i in range(20)] + [(500 + i, 500 + i / 40, 500.3) for i in range(40)]  # one place; a dense line
    got = {r.l_id: r.n for r in T.count_within(frame(spark, left, "l"), frame(spark, right, "r"), "l_id", "r_id", radius, "n").collect()}
    assert got == {p[0]: sum(dist(p, q) <= radius for q in right if sound(q)) if sound(p) else 0 for p in left}
    near = {r.l_id: (r.r_id, r.distance) for r in T.nearest_unbounded(frame(spark, left, "l"), frame(spark, right, "r"), "l_id", "r_id").collect()}
    for p in left:
        d = min((round(dist(p, q), 6), q[0]) for q in right if sound(q)) if sound(p) else (None, None)
        assert near[p[0]][0] == d[1] and (d[0] is None or near[p[0]][1] == pytest.approx(d[0], abs=1e-6))


def test_rows_go_down_the_tree_as_boxes(spark):
    """Far fewer boxes than rows are carried down, however dense a place is; a
    cell of many rows is divided unless they lie in one place."""
    rnd = random.Random(6)
    city = [(i, rnd.random(), rnd.random()) for i in range(20_000)]
    left = city + [(30_000 + i, 0.5, 0.5) for i in range(5000)] + [(40_000, 1000.0, 1000.0)]
    _, placed = T._prepared(frame(spark, left, "l"), "l_id", "x", "y")
    rows, boxes = T._boxes(placed, T._right(frame(spark, [(1, 5.0, 5.0)], "r"), "r_id", "x", "y"))
    found = boxes.collect()
    assert sum(b._n for b in found) == len(left) == rows.count() and len(found) < len(left) / 50
    assert all(b._n <= T.MOST or (b._x0, b._y0) == (b._x1, b._y1) for b in found if b._n < 5000)
