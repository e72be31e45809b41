"""The search for the nearest pieces against brute force; what it looks at."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.operators import nearest as N
from roadlens.operators import spatial as S


def gap(p, e):
    (x, y), (ax, ay, bx, by) = p, e
    dx, dy = bx - ax, by - ay
    n = dx * dx + dy * dy
    t = min(1.0, max(0.0, ((x - ax) * dx + (y - ay) * dy) / n)) if n else 0.0
    return math.hypot(x - ax - t * dx, y - ay - t * dy)


def small_parts(monkeypatch):
    for name, value in (("PLACES", 4), ("MOST", 8), ("PIECES", 5), ("TOGETHER", 8)):
        monkeypatch.setattr(N, name, value)


def test_a_place_looks_at_few_pieces(monkeypatch):
    """All pieces lie within the radius of all places: the distances looked at are few all the same."""
    rnd = np.random.default_rng(1)
    x, y = rnd.random((2, 3000)) * 1000
    a = rnd.random((2, 20_000)) * 1000
    pieces = np.concatenate((a, a + rnd.random((2, 20_000)) * 50))
    looked = []
    gaps = N._gaps
    monkeypatch.setattr(N, "_gaps", lambda px, py, ends: looked.append(np.size(px) * len(ends[0])) or gaps(px, py, ends))
    i, j = N.closest(x, y, pieces, 5000.0)
    assert sorted(set(i.tolist())) == list(range(3000)) and len(i) < 3100
    assert sum(looked) < 3000 * 20_000 / 20
    for place, piece in zip(i[:50].tolist(), j[:50].tolist(), strict=True):
        d = gaps(x[place], y[place], (a[0], a[1], pieces[2] - a[0], pieces[3] - a[1], 1 / ((pieces[2] - a[0]) ** 2 + (pieces[3] - a[1]) ** 2)))
        assert d[piece] <= d.min() + 2 * N.SLACK


@pytest.mark.parametrize("ties", ["first", "all"])
def test_lines_in_small_parts_equal_brute_force(spark, monkeypatch, ties):
    small_parts(monkeypatch)
    rnd = random.Random(7)
    points = [(i, rnd.random() * 1000, rnd.random() * 1000) for i in range(120)] + [(200 + i, 500 + rnd.random(), 500 + rnd.random()) for i in range(60)]
    points += [(300, 1e6, 1e6), (301, None, 1.0), (302, float("nan"), 2.0), (303, 250.0, 250.0), (303, 250.0, 250.0)]
    lines = []
    for k in range(150):
        at = (500.0, 500.0) if k < 60 else (rnd.random() * 1000, rnd.random() * 1000)
        path = [at]
        for _ in range(2):
            path.append((path[-1][0] + rnd.uniform(-80, 80), path[-1][1] + rnd.uniform(-80, 80)))
        lines.append((k, path))
    lines += [(1000, [(200.0, 260.0), (300.0, 260.0)]), (1001, [(200.0, 240.0), (300.0, 240.0)]), (1002, [(0.0, 700.0), (20_000.0, 700.0)]), (1003, [(250.0, 260.0), (250.0, 260.0)])]
    P = spark.createDataFrame(points, "id long, x double, y double").repartition(3)
    G = spark.createDataFrame([(k, [{"x": x, "y": y} for x, y in g]) for k, g in lines], "sid long, g array<struct<x:double,y:double>>")
    got = sorted(((r.id, r.sid, r.distance) for r in S.nearest_line_within(P, G, "id", "sid", "g", 60.0, ties=ties).collect()), key=str)
    want = []
    for i, x, y in points[:-1]:
        near = []
        if x is not None and math.isfinite(x):
            near = [(round(d, 6), k) for k, g in lines for d in [min(gap((x, y), (*u, *v)) for u, v in zip(g, g[1:], strict=False))] if d <= 60.0]
        best = sorted(k for d, k in near if d == min(near)[0])
        want += [(i, k, min(near)[0]) for k in (best[:1] if ties == "first" else best)] or [(i, None, None)]
    want = sorted(want, key=str)
    assert sorted((a, b if b is not None else -1) for a, b, _ in got) == sorted((a, b if b is not None else -1) for a, b, _ in want)
    have = {(a, b): d for a, b, d in got}
    assert all(have[a, b] == pytest.approx(d, abs=1e-6) if d is not None else have[a, b] is None for a, b, d in want)


def test_rows_without_a_key_within_the_radius(spark):
    P = spark.createDataFrame([(1, 0.0, 0.0), (2, 100.0, 0.0)], "id long, x double, y double")
    Q = spark.createDataFrame([(None, 1.0, 0.0), (None, 30.0, 0.0), (7, 101.0, 0.0), (None, 102.0, 0.0)], "sid long, x double, y double")
    rows = lambda ties: sorted(((r.id, r.sid, r.distance) for r in S.nearest_within(P, Q, "id", "sid", 50.0, ties=ties).collect()))
    assert rows("first") == [(1, None, None), (2, None, None)]
    assert rows("all") == [(1, None, None), (1, None, None), (2, 7, 1.0)]


def test_dense_pieces_are_not_sent_to_all_boxes(spark, monkeypatch):
    """A radius over everything: a piece still goes to the boxes near it only, and a place finds its nearest alone."""
    for name, value in (("PLACES", 16), ("MOST", 16)):
        monkeypatch.setattr(N, name, value)
    P = spark.range(400).select((F.rand(1) * 1000).alias("_lx"), (F.rand(2) * 1000).alias("_ly")).localCheckpoint()
    Q = spark.range(2000).select(F.col("id").alias("_rkey"), (F.rand(3) * 1000).alias("ax"), (F.rand(4) * 1000).alias("ay")).select("*", F.col("ax").alias("bx"), F.col("ay").alias("by")).localCheckpoint()
    met = []
    written = N._written
    monkeypatch.setattr(N, "_written", lambda df, name: met.append((name, written(df, name))) or met[-1][1])
    found = N.near_pieces(P, Q, 5000.0, 5000.0)
    reach = [r._reach for name, df in met if name == "nearest-boxes" for r in df.collect()]
    assert sorted(reach)[len(reach) // 2] < 500 and 400 <= found.count() < 410
