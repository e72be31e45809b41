"""Exact quantiles equal numpy's, for many values, ties, groups and bad sketches."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.operators import quantiles as Q


def test_groups_ties_nulls(spark):
    rng = np.random.default_rng(1)
    rows = []
    for g, x in (("normal", rng.normal(size=997)), ("ties", rng.integers(0, 3, 500).astype(float)), ("one", np.array([4.5])),
                 ("wide", np.concatenate((rng.normal(size=200) * 1e300, [1e-300, 0.0, -0.0]))), ("same", np.full(300, 7.25))):
        rows += [(g, float(v), float(v) * 2) for v in x] + [(g, None, None), (g, float("nan"), None)]
    rows += [(None, 1.0, 1.0), ("empty", None, None)]
    df = spark.createDataFrame(rows, "g string, v double, w double").repartition(7)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r.g, r["column"], r.p): r.value for r in Q.exact_quantiles(df, ["v", "w"], probs, ["g"]).collect()}
    want = {}
    for g in ("normal", "ties", "one", "wide", "same"):
        for c, k in (("v", 1), ("w", 2)):
            x = np.array([r[k] for r in rows if r[0] == g and r[k] is not None and not np.isnan(r[k])])
            want |= {(g, c, p): float(np.quantile(x, p)) for p in probs}
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-12), k


@pytest.mark.parametrize("few, margin", [(0, Q.MARGIN), (Q.FEW, 1e-9), (0, 1e-9)])
def test_range_sums_and_missed_brackets(spark, monkeypatch, few, margin):
    """Running sums over range partitions instead of windows; brackets so
    narrow that ranks miss them are widened."""
    monkeypatch.setattr(Q, "FEW", few)
    monkeypatch.setattr(Q, "MARGIN", margin)
    monkeypatch.setattr(Q, "SKETCH", 20)
    x = np.random.default_rng(2).lognormal(size=3001)
    df = spark.createDataFrame([(i % 2, float(v)) for i, v in enumerate(x)], "g long, v double")
    for by in ([], ["g"]):
        for r in Q.exact_quantiles(df, ["v"], [0.1, 0.5, 0.9], by).collect():
            own = x if not by else x[np.arange(len(x)) % 2 == r.g]
            assert r.value == pytest.approx(np.quantile(own, r.p), rel=1e-13)


def test_ten_million_values_in_two_groups(spark):
    n = 10_000_000  # different values, a third of them in one group
    df = spark.range(n).select((F.col("id") % 3 == 0).alias("g"), ((F.col("id") * 7919) % n).cast("double").alias("v"))
    got = {(r.g, r.p): r.value for r in Q.exact_quantiles(df, ["v"], [0.5, 0.99], ["g"]).collect()}
    ids = np.arange(n)
    v = (ids * 7919) % n
    for g in (True, False):
        own = v[(ids % 3 == 0) == g]
        for p in (0.5, 0.99):
            assert got[g, p] == np.quantile(own, p)


def test_scalars(spark):
    df = spark.createDataFrame([(float(i), None) for i in range(11)], "a double, b double")
    assert spark.range(1).select(Q.quantile(df, "a", 0.5).alias("m"), Q.quantile(df, "a", [0.0, 0.25]).alias("e"), Q.quantile(df, "b", 0.5).alias("n"),
                                 Q.quantile(df, "b", [0.5]).alias("k")).first() == (5.0, [0.0, 2.5], None, None)
    assert Q.medians(df, ["a", "b"]) == {"a": 5.0, "b": None} and Q.medians(df, []) == {}


def test_nothing_else_takes_exact_percentiles():
    import pathlib
    import re
    root = pathlib.Path(Q.__file__).parent.parent
    for path in [*root.glob("operators/*.py"), *root.glob("plans/*.py"), *root.glob("functions/*.py")]:
        text = path.read_text()
        assert not re.search(r"F\.percentile\(|F\.median\(|relativeError|accuracy=", text), path
        assert path.name == "quantiles.py" or "percentile_approx" not in text
