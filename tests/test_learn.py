"""Learning operators: encodings, isotonic fits, folds, ensembles, search, ZIP,
importances, p-values."""
import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from roadlens.functions.stats import correlation_p_value
from roadlens.operators import calibration as K
from roadlens.operators import learn as P
from roadlens.operators import selection as S
from roadlens.operators import splits as N
from roadlens.operators.zero_inflated import fit_zero_inflated
from roadlens.plans import training
from roadlens.plans import workzones as W


def test_label_encode_alphabetical(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["b", "a", "c", "a", None, "b"])], "id long, v string")
    got = {r.id: r.v_code for r in P.label_encode(df, "v").collect()}
    assert got == {0: 1, 1: 0, 2: 2, 3: 0, 4: None, 5: 1}


def test_one_hot_refuses_too_many(spark, monkeypatch):
    df = spark.range(5).withColumn("c", F.col("id").cast("string"))
    assert P.one_hot(df, df, "c").columns == ["id", "c", "c_1", "c_2", "c_3", "c_4"]
    monkeypatch.setattr(P, "MOST_CATEGORIES", 4)
    with pytest.raises(ValueError):
        P.one_hot(df, df, "c")


def test_standard_scale_in_one_scan(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = P.standard_scale(df, df, ["a", "b"])
    assert [tuple(r) for r in out.orderBy("a").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


# ------------------------------------------------------------ P12

def pool(x, y):
    """Pool-adjacent-violators, value by value: the serial version."""
    blocks = []
    for v in sorted(set(x)):
        own = [b for a, b in zip(x, y, strict=True) if a == v]
        blocks.append([sum(own), len(own), [v]])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, vs = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += n
            blocks[-1][2] += vs
    return [(vs[0], vs[-1], s / n) for s, n, vs in blocks]


def test_hulls_of_stretches_join_to_the_serial_fit():
    rng = random.Random(1)
    for case in range(1000):
        n = rng.randint(1, 60)
        x = [rng.randint(0, rng.choice([3, 20, 500])) for _ in range(n)]
        y = [int(rng.random() < (v / 500 if case % 2 else .4)) for v in x]
        values = sorted(set(x))
        w = np.cumsum([x.count(v) for v in values]).astype(float)
        s = np.cumsum([sum(b for a, b in zip(x, y, strict=True) if a == v) for v in values]).astype(float)
        parts = [list(p) for p in np.array_split(np.arange(len(w)), rng.randint(1, 5)) if len(p)]
        while len(parts) > 1:  # corners of stretches, joined two at a time
            parts = [[p[i] for i in K.lower_hull(w[p], s[p])] for p in parts]
            parts = [sum(parts[i:i + 2], []) for i in range(0, len(parts), 2)]
        at = np.array([-1, *parts[0]])
        ww, ss = np.append(w, 0.0)[at], np.append(s, 0.0)[at]
        hull = K.lower_hull(ww, ss)
        got = [(values[at[a] + 1], values[at[b]], (ss[b] - ss[a]) / (ww[b] - ww[a])) for a, b in zip(hull, hull[1:], strict=False)]
        assert got == pool(x, y)


@pytest.mark.parametrize("stretch", [50_000, 40])
def test_isotonic_table(spark, monkeypatch, stretch):
    monkeypatch.setattr(K, "STRETCH", stretch)
    monkeypatch.setattr(K, "FAN_IN", 3)
    rng = random.Random(2)
    x = [rng.choice([0.0, 0.25, rng.random()]) for _ in range(900)]  # hot scores
    y = [int(rng.random() < v) for v in x]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(x, y, strict=True))] + [(-1, None, 1), (-2, 0.5, None)], "id long, p double, y int").repartition(5)
    want = pool(x, y)
    blocks = K.fit_isotonic(df, "p", "y")
    assert sorted(tuple(r) for r in blocks.collect()) == [pytest.approx(b, rel=1e-12) for b in want]
    ask = [-5.0, *sorted(set(x))[::40], *((a[1] + b[0]) / 2 for a, b in zip(want, want[1:], strict=False)), 7.0]
    got = {r.p: r.p_cal for r in K.apply_isotonic(spark.createDataFrame([(v,) for v in [*ask, None]], "p double"), "p", blocks).collect()}
    knots = [v for a, b, _ in want for v in (a, b)]
    line = np.interp(ask, knots, [v for *_, v in want for _ in (0, 1)])
    assert got.pop(None) is None and [got[v] for v in ask] == pytest.approx(line.tolist())
    none = K.fit_isotonic(df.limit(0), "p", "y")
    assert {r.p_cal for r in K.apply_isotonic(df, "p", none).collect()} == {None}


def test_folded_calibration_never_sees_its_rows(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, (p := rng.random()), int(rng.random() < p ** 3), i % 3) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, p double, y int, fold int")
    fitted, real = [], K.calibrate
    monkeypatch.setattr(K, "calibrate", lambda d, *a: fitted.append({r.fold for r in d.select("fold").distinct().collect()}) or real(d, *a))
    for method in ("isotonic", "platt"):
        out = K.calibrate_folds(df, "p", "y", "fold", 3, method)
        scores = K.fold_scores(out, "p", "y", "fold").collect()
        assert out.count() == 900 and len(scores) == 3 and all(r.brier_cal < r.brier_raw and r.n == 300 for r in scores)
    assert fitted == [{1, 2}, {0, 2}, {0, 1}] * 2
    with pytest.raises(ValueError):
        real(df, "p", "y", "other")


# ------------------------------------------------------------ P13 - P15

def planted(spark, n=600, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, c = rng.gauss(0, 1), rng.choice("uvw")
        rows.append((i, a if i % 9 else None, rng.gauss(0, 1), c if i % 7 else None, float(rng.random() < 1 / (1 + math.exp(-2 * a - (2 if c == "u" else -1)))), i % 3))
    return spark.createDataFrame(rows, "id long, a double, b double, c string, y double, fold int")


def test_search_over_three_kinds(spark):
    df = planted(spark)
    c = [S.Candidate("logistic", {"maxIter": 20}), S.Candidate("random_forest", {"numTrees": 10, "maxDepth": 4}), S.Candidate("gbt", {"maxIter": 3, "maxDepth": 3})]
    rows = S.cross_val_score(df, ["a", "b"], ["c"], "y", "fold", c, 3).collect()
    assert {(r.kind, r.fold) for r in rows} == {(x.kind, k) for x in c for k in range(3)} and all(r.auc > .7 and r.n == 200 for r in rows)
    assert S.best_candidate(spark.createDataFrame(rows), c) in c
    assert len(S.grid("gbt", {"maxIter": [1, 2, 3], "maxDepth": [2, 3]})) == 6
    assert S.grid("gbt", {"maxIter": list(range(9))}, 3, 1) == S.grid("gbt", {"maxIter": list(range(9))}, 3, 1)


def test_no_row_is_scored_by_a_model_that_saw_it(spark, monkeypatch):
    df = planted(spark)
    trained, real = [], S.fit
    monkeypatch.setattr(S, "fit", lambda t, *a, **k: trained.append({r.fold for r in t.select("fold").distinct().collect()}) or real(t, *a, **k))
    members = [S.Candidate("logistic"), S.Candidate("random_forest", {"numTrees": 5, "maxDepth": 3}), S.Candidate("gbt", {"maxIter": 2, "maxDepth": 2})]
    e = S.Ensemble(df, ["a", "b"], ["c"], "y", "fold", members, 3)
    assert trained == [{1, 2}] * 3 + [{0, 2}] * 3 + [{0, 1}] * 3 + [{0, 1, 2}] * 3
    assert {r.id for r in e.oof.select("id").collect()} == set(range(600)) and e.oof.count() == 600
    out = e.transform(planted(spark, 200, 5))
    r = out.first()
    assert r.p_vote == pytest.approx((r.p_0 + r.p_1 + r.p_2) / 3)
    from roadlens.operators.evaluate import roc_auc
    assert roc_auc(out.withColumn("y", F.col("y").cast("int")), "y", "p_stack").first()["auc"] > .75


def test_exact_median_is_filled_and_survives_saving(spark, tmp_path):
    df = planted(spark)
    m = P.fit_classifier(df, ["a", "b"], ["c"], "y", "logistic", maxIter=5)
    want = float(np.median([r.a for r in df.collect() if r.a is not None]))
    path = f"{spark.sparkContext.getCheckpointDir()}/model-{random.random()}"
    m.write().save(path)
    again = PipelineModel.load(path)
    for model in (m, again):
        assert {r.a__imp for r in model.transform(df).where("a is null").select("a__imp").collect()} == {want}


def test_importances_sum_the_slots_of_a_category(spark):
    df = planted(spark)
    m = P.fit_classifier(df, ["a", "b"], ["c"], "y", "random_forest", numTrees=20, maxDepth=4)
    rows = P.feature_importances(m, df, ["a", "b"], ["c"], {"a": "x"})
    assert [r[0] for r in rows][-1] == "b" and sum(r[1] for r in rows) == pytest.approx(1) and {r[0]: r[2] for r in rows}["a"] == "x"


def test_train_and_report_checks_leakage(spark):
    df = planted(spark)
    c = [S.Candidate("logistic", {"maxIter": 20}), S.Candidate("gbt", {"maxIter": 3, "maxDepth": 3})]
    part = [df.where(F.col("fold") == k) for k in range(3)]
    rows = training.train_and_report(*part, ["a", "b"], ["c"], "y", c).collect()
    assert [r.model for r in rows] == [x.label for x in c] and all(r.auc > .7 for r in rows)
    for features, bad in ((["a", "y"], []), (["a", "b"], ["b"])):
        with pytest.raises(ValueError):
            training.train_and_report(*part, features, [], "y", c, bad)


def test_sensitivity_of_any_feature(spark):
    df = spark.createDataFrame([(1, 10.0, 2.0), (2, 20.0, 4.0)], "id long, a double, b double")
    s = W.sensitivity(df, ["a", "b"], lambda t: t.withColumn("p", F.col("a") + 100 * F.col("b")), "p", "id", 0.1, 3)
    got = {(r.id, r.feature, r.step): r.score for r in s.collect()}
    assert len(got) == 12 and got[1, "a", 0] == pytest.approx(209) and got[1, "b", 2] == pytest.approx(230) and got[2, "a", 1] == 420


# ------------------------------------------------------------ P11

def test_zero_inflated_recovers_coefficients(spark):
    rng = np.random.default_rng(6)
    n = 8000
    x = rng.normal(size=n) * 2 + 5
    big = rng.random(n) * 90_000  # a feature of another size
    lam, pi = np.exp(.3 + .25 * (x - 5) + 1e-5 * big), 1 / (1 + np.exp(-(-.5 + .8 * (x - 5))))
    y = np.where(rng.random(n) < pi, 0, rng.poisson(lam))
    df = spark.createDataFrame(list(zip(x.tolist(), big.tolist(), y.tolist(), strict=True)) + [(None, 1.0, 2)], "x double, big double, y long")
    m = fit_zero_inflated(df, ["x", "big"], "y")
    assert m.count == pytest.approx([.3 - 1.25, .25, 1e-5], abs=.12) and m.zero[1] == pytest.approx(.8, abs=.12)
    assert abs(m.count[2] - 1e-5) < 2e-6
    assert all(b >= a for a, b in zip(m.trace, m.trace[1:], strict=False)) and m.gradient < 1e-7 and m.n == n
    from math import lgamma
    ll = sum(math.log(p + (1 - p) * math.exp(-v)) if k == 0 else math.log(1 - p) + k * math.log(v) - v - lgamma(k + 1)
             for k, v, p in ((r.y, r.lam, r.pi) for r in m.transform(df.where("x is not null")).collect()))
    assert m.trace[-1] == pytest.approx(ll, rel=1e-9)
    with pytest.raises(RuntimeError):
        fit_zero_inflated(df, ["x", "big"], "y", max_rounds=1)
    for bad in ("y - 1", "0"):
        with pytest.raises(ValueError):
            fit_zero_inflated(df.withColumn("y", F.expr(bad)), ["x"], "y")


# ------------------------------------------------------------ H16

def _p(r, n):
    """Student's t by its finite series."""
    v, s, c = n - 2, abs(r), math.sqrt(1 - r * r)
    term = total = 1.0 if v % 2 == 0 else (c if v > 1 else 0.0)
    k = 2 if v % 2 == 0 else 3
    while k + 2 <= v and term > 1e-20:
        term *= c * c * (k - 1) / k
        total += term
        k += 2
    return 1 - (s * total if v % 2 == 0 else 2 / math.pi * (math.asin(s) + s * total))


def test_p_values(spark):
    rows = [(r, n) for n in (3, 4, 5, 6, 10, 11, 31, 100, 1001, 30_000, 1_000_000) for r in (0.0, 1e-4, -.001, .01, -.1, .3, .5, -.77, .95, .999)]
    got = spark.createDataFrame(rows, "r double, n long").select("r", "n", correlation_p_value(F.col("r"), F.col("n")).alias("p")).collect()
    for x in got:
        assert abs(x.p - _p(x.r, x.n)) < 1e-10, x
    odd = spark.createDataFrame([(.5, 2), (1.0, 9), (-1.0, 9), (None, 9)], "r double, n long").select(correlation_p_value(F.col("r"), F.col("n")).alias("p"))
    assert [x.p for x in odd.collect()] == [None, 0.0, 0.0, None]


def test_folds_of_hot_strata(spark):
    df = spark.range(3000).withColumn("y", (F.col("id") % 50 == 0).cast("int"))
    sizes = {(r.y, r.fold): r["count"] for r in N.stratified_kfold(df, "y", "id", 5).groupBy("y", "fold").count().collect()}
    assert set(sizes.values()) == {12, 588} and len(sizes) == 10


# ------------------------------------------------------------ spread of the training rows

def test_training_rows_are_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(P, "FILE_ROWS", 100)
    df = planted(spark).coalesce(1)
    seen, real = [], P.Pipeline.fit
    monkeypatch.setattr(P.Pipeline, "fit", lambda self, t, *a: seen.append(t.rdd.getNumPartitions()) or real(self, t, *a))
    P.fit_classifier(df, ["a", "b"], ["c"], "y", "random_forest", numTrees=3, maxDepth=2)
    assert seen[0] > 1 and P.spread(df).count() == 600
    assert sorted(map(tuple, P.spread(df).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_models_of_a_fold_share_its_features(spark, monkeypatch):
    fitted, real = [], P.fit_features
    monkeypatch.setattr(P, "fit_features", lambda t, *a: fitted.append({r.fold for r in t.select("fold").distinct().collect()}) or real(t, *a))
    c = [S.Candidate("logistic", {"maxIter": 5}), S.Candidate("random_forest", {"numTrees": 3, "maxDepth": 2})]
    assert S.cross_val_score(planted(spark), ["a", "b"], ["c"], "y", "fold", c, 3).count() == 6
    assert sorted(map(sorted, fitted)) == [[0, 1], [0, 2], [1, 2]]


def test_shared_features_give_the_same_model(spark):
    df = planted(spark).coalesce(1)
    for kind in ("logistic", "random_forest"):
        own = P.fit_classifier(df, ["a", "b"], ["c"], "y", kind, maxIter=20, numTrees=5, maxDepth=3)
        shared = P.fit_classifier(df, ["a", "b"], ["c"], "y", kind, features=P.fit_features(df, ["a", "b"], ["c"]), maxIter=20, numTrees=5, maxDepth=3)
        p, q = ([r.p for r in P.probability(m.transform(df)).orderBy("id").collect()] for m in (own, shared))
        assert p == pytest.approx(q, abs=1e-9)


def test_count_regressors_train_on_four_of_five_segments(spark, tmp_path):
    from roadlens.catalog import learning as Q
    n = 1000
    spark.createDataFrame([(k, k % 50) for k in range(1, n + 1)], "p_partkey long, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(1 + i % n,) for i in range(3 * n)], "l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    sizes = {r["split"]: r["count"] for r in Q._segment_ml(spark, str(tmp_path)).groupBy("split").count().collect()}
    assert sum(sizes.values()) == n and 0.75 * n < sizes["train"] < 0.85 * n
