"""DBSCAN and k-means against brute force, in 2, 3 and 64 dimensions."""
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from roadlens.operators import clustering as C
from roadlens.operators import learn as P


def brute(keys, x, eps, least):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    near = d <= eps
    core = near.sum(1) >= least
    label = np.where(core, keys, np.iinfo(np.int64).max)
    while True:
        new = label.copy()
        for i in np.flatnonzero(core):
            new[i] = label[near[i] & core].min()
        if (new == label).all():
            break
        label = new
    return {int(k): int(label[i] if core[i] else min(label[near[i] & core], default=-1)) for i, k in enumerate(keys)}


def run(spark, keys, x, eps, least, **kw):
    df = spark.createDataFrame([(int(k), [float(c) for c in v], "x", 0) for k, v in zip(keys, x, strict=True)], "id long, v array<double>, part string, ball int").repartition(4)
    return {r.id: r.cluster for r in P.dbscan(df, "id", "v", eps, least, **kw).collect()}


@pytest.mark.parametrize("dim, eps", [(2, .5), (3, .8), (64, 7.5)])
@pytest.mark.parametrize("unit_rows", [4096, 60])
def test_dbscan_equals_brute_force(spark, dim, eps, unit_rows):
    rng = np.random.default_rng(dim)
    blobs = [rng.normal(size=(60, dim)) * .7 + rng.normal(size=dim) * 3 for _ in range(4)]
    x = np.concatenate([*blobs, rng.normal(size=(80, dim)) * 4, np.repeat(rng.normal(size=(1, dim)), 150, 0)])  # a third are copies
    keys = rng.permutation(len(x)) * 3
    want = brute(keys, x, eps, 5)
    assert len(set(want.values())) > 3 and -1 in want.values()
    assert run(spark, keys, x, eps, 5, unit_rows=unit_rows) == want


def test_exact_borders_and_bad_rows(spark):
    """Points at exactly eps are neighbours; nulls, NaN and infinity are noise."""
    x = [[0.0, 0.0], [0.5, 0.0], [1.0, 0.0], [1.5, 0.0], [2.0000001, 0.0], [9.0, 9.0]]
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(x)] + [(10, None, 0.0), (11, float("nan"), 0.0), (12, float("inf"), 0.0)], "id long, a double, b double")
    got = {r.id: r.cluster for r in P.dbscan(df, "id", ["a", "b"], 0.5, 3).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 1, 4: -1, 5: -1, 10: -1, 11: -1, 12: -1}
    assert P.dbscan(df.limit(0), "id", ["a", "b"], 0.5, 3).count() == 0
    assert P.dbscan(df.where("id >= 10"), "id", ["a", "b"], 0.5, 3).count() == 3


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    """A chain of 500 balls is one cluster in a logarithmic number of rounds."""
    from roadlens.operators import components
    rounds, real = [], components._checksum
    monkeypatch.setattr(components, "_checksum", lambda pairs: rounds.append(1) or real(pairs))
    x = np.stack([np.arange(1500) / 3, np.zeros(1500)], 1)
    keys = np.random.default_rng(5).permutation(1500)
    got = run(spark, keys, x, 1.0, 3, unit_rows=100)
    assert set(got.values()) == {0} and len(rounds) < 24  # two calls of under 12


def test_no_pairs_of_a_dense_group_are_listed(spark, monkeypatch):
    """20,000 points within eps of each other: no task reports more rows than it holds."""
    seen, real = [], C._links

    def links(eps):
        visit = real(eps)

        def spy(q, m):
            out = visit(q, m)
            assert out.num_rows <= q.num_rows + m.num_rows
            return out
        return spy
    monkeypatch.setattr(C, "_links", links)
    rnd = random.Random(7)
    df = spark.createDataFrame([(i, rnd.random() * .01, rnd.random() * .01) for i in range(20_000)], "id long, a double, b double")
    assert {r.cluster for r in P.dbscan(df, "id", ["a", "b"], 1.0, 5).collect()} == {0} and not seen


def test_rows_are_sent_once_to_a_bundle_of_units(spark):
    """In 64 dimensions every point reaches every unit: rows are sent to few
    bundles, not to each of the units, and a bundle holds all units reached."""
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(size=(2400, 64)) * .1, np.repeat(rng.normal(size=(1, 64)) * .1, 600, 0)])
    space = C.Space(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "key long, v array<double>"), 9.0, 20)
    parts = space.parts.value
    sent = np.concatenate([np.stack(p, 1) for p in parts.asks(x[:50], 9.0)])
    row, part = parts.reach(x[:50], 9.0)
    assert parts.units.sum() > 120 and len(sent) == len(np.unique(sent, axis=0)) <= 50 * 3 * C.BUNDLES
    assert {(r, b) for r, p in zip(row, part, strict=True) for b in parts.bundle(p, np.arange(parts.units[p]))} == set(map(tuple, sent))
    rows = {}
    for r in space.members.groupBy("part", "unit").count().collect():
        rows.setdefault(int(parts.bundle(r.part, r.unit)), []).append(r["count"])
    assert all(sum(n) <= 1.5 * space.most for n in rows.values())  # units of a part are as large as its hash deals them


def test_neighbours_is_exact_at_the_border():
    rng = np.random.default_rng(8)
    a, b = rng.integers(-9, 9, (80, 3)) / 4 + 1e6, rng.integers(-9, 9, (90, 3)) / 4 + 1e6
    for eps in (.25, .75, 1.25):
        assert (C.neighbours(a, b, eps) == (np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1)) <= eps)).all()


def test_kmeans_finds_planted_clusters(spark):
    rng = np.random.default_rng(9)
    centre = rng.normal(size=(4, 12)) * 6
    df = spark.createDataFrame([(i, (centre[i % 4] + rng.normal(size=12)).tolist()) for i in range(400)], "id long, v array<double>").select("id", array_to_vector("v").alias("f"))
    pts = P.scaled_vectors(df, "f")
    rows = P.kmeans_elbow(pts, "f", range(2, 7), starts=3)
    assert max(rows, key=lambda r: r[2])[0] == 4  # the silhouette picks the planted number
    assert [c for _, c, _ in rows] == sorted((c for _, c, _ in rows), reverse=True)
    m = P.kmeans(pts, "f", 4, starts=3)
    got = {r.id: r.cluster for r in P.assign_centres(pts, "f", [c.tolist() for c in m.clusterCenters()]).collect()}
    assert len({(i % 4, c) for i, c in got.items()}) == 4
    assert got == {r.id: r.prediction for r in m.transform(pts).collect()}


def test_kmeans_of_many_k_is_the_best_of_its_starts(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame(list(enumerate(rng.normal(size=(60, 2)).tolist())), "id long, v array<double>")
    pts = P.spread(df.select("id", array_to_vector("v").alias("f")))
    many = P.kmeans_many(pts, "f", [2, 3], starts=3)
    assert sorted(many) == [2, 3]
    for k, m in many.items():
        costs = [P.kmeans(pts, "f", k, starts=1, seed=42 + i).summary.trainingCost for i in range(3)]
        assert m.summary.trainingCost == pytest.approx(min(costs))
    assert P.each(spark, lambda j: j * 2, [3, 1, 2]) == [6, 2, 4]
