"""Learning queries (P1-P21, X9). Fitted-statistic operators (imputation,
scaling, encoding, voting, DBSCAN) have SQL oracles; trained models are
rows-only with invariants checked in pytest."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from .. import testviews as V
from ..operators import evaluate as O
from ..operators import learn as P
from ..operators import splits as N
from ..operators.calibration import apply_isotonic, calibrate_folds, fit_isotonic, fold_scores
from ..operators.selection import Candidate, Ensemble, cross_val_score, grid, out_of_fold
from ..operators.zero_inflated import fit_zero_inflated
from ..plans.training import train_and_report as report
from ..plans.workzones import sensitivity as vary
from ..sources.readers import shared_dir
from .base import query, r6
from .groups import CF_SQL, cf

NUMERIC = ["hour", "day_of_week", "month", "temperature_f", "visibility_mi", "x", "y"]
CATEGORICAL = ["weather_category", "city"]
LABEL = "high_severity"


def ml_base(spark, d):
    """Crash features with a temporal split: train <= 1998, val 1999, test after."""
    c = cf(spark, d).withColumn("split", F.when(F.col("year") <= 1998, "train").when(F.col("year") == 1999, "val")
                                .otherwise("test"))
    return c.withColumn(LABEL, F.col(LABEL).cast("double"))


def _table(spark, d):
    """What the models read of ``ml_base``, written once."""
    return P.spread(ml_base(spark, d).select("id", *NUMERIC, *CATEGORICAL, LABEL, "split"))


TRAIN_SQL = f"WITH cf AS ({CF_SQL}), tr AS (SELECT * FROM cf WHERE year <= 1998)"


@query("median_impute", TRAIN_SQL + """
SELECT id, coalesce(temperature_f, (SELECT median(temperature_f) FROM tr)) AS temperature_f,
       coalesce(visibility_mi, (SELECT median(visibility_mi) FROM tr)) AS visibility_mi FROM cf""", ("crashes",))
def median_impute(spark, d):
    """Train-fitted exact medians applied to every split."""
    b = ml_base(spark, d)
    return P.median_impute(b.where(F.col("split") == "train"), b, ["temperature_f", "visibility_mi"]).select(
        "id", "temperature_f", "visibility_mi")


@query("mean_impute", TRAIN_SQL + """
SELECT id, round_even(coalesce(temperature_f, (SELECT avg(temperature_f) FROM tr)), 6) AS temperature_f,
       round_even(coalesce(visibility_mi, (SELECT avg(visibility_mi) FROM tr)), 6) AS visibility_mi FROM cf""",
       ("crashes",))
def mean_impute(spark, d):
    """ML ``Imputer(strategy='mean')`` fitted on train."""
    b = ml_base(spark, d)
    out = P.mean_impute(b.where(F.col("split") == "train"), b, ["temperature_f", "visibility_mi"])
    return out.select("id", r6("temperature_f").alias("temperature_f"), r6("visibility_mi").alias("visibility_mi"))


@query("standard_scale", TRAIN_SQL + """
SELECT id, round_even((temperature_f - (SELECT avg(temperature_f) FROM tr)) / (SELECT stddev_pop(temperature_f) FROM tr), 6) AS temperature_f,
       round_even((visibility_mi - (SELECT avg(visibility_mi) FROM tr)) / (SELECT stddev_pop(visibility_mi) FROM tr), 6) AS visibility_mi
FROM cf""", ("crashes",))
def standard_scale(spark, d):
    """Population-std scaling fitted on train."""
    b = ml_base(spark, d)
    out = P.standard_scale(b.where(F.col("split") == "train"), b, ["temperature_f", "visibility_mi"])
    return out.select("id", r6("temperature_f").alias("temperature_f"), r6("visibility_mi").alias("visibility_mi"))


@query("one_hot", f"""WITH cf AS ({CF_SQL})
SELECT id, {', '.join(f"CAST(coalesce(weather_category = '{v}', false) AS INTEGER) AS weather_category_{v}"
                      for v in ('cloudy', 'fog', 'rain', 'snow'))} FROM cf""", ("crashes",))
def one_hot(spark, d):
    """Drop-first one-hot of the training categories."""
    b = ml_base(spark, d)
    o = P.one_hot(b.where(F.col("split") == "train"), b, "weather_category")
    return o.select("id", *[f"weather_category_{v}" for v in ("cloudy", "fog", "rain", "snow")])


@query("label_encode", """
SELECT id, CAST(dense_rank() OVER (ORDER BY county) - 1 AS INTEGER) AS county_code FROM crashes""", ("crashes",))
def label_encode(spark, d):
    """P5: alphabetical codes."""
    return P.label_encode(V.crashes(spark, d).select("id", "county"), "county", "county_code").select("id", "county_code")


@query("feature_pipeline")
def feature_pipeline(spark, d):
    """Imputer + scaler + indexer + one-hot + assembler (rows: one
    feature vector per crash, fitted on train)."""
    from pyspark.ml import Pipeline
    b = ml_base(spark, d)
    m = Pipeline(stages=P.feature_pipeline(NUMERIC, CATEGORICAL)).fit(b.where(F.col("split") == "train"))
    t = m.transform(b)
    return t.select("id", "split", F.size(vector_to_array("features")).alias("n_features"))


def _auc(df, label, p):
    return O.roc_auc(df.withColumn(label, F.col(label).cast("int")), label, p)


def _fit_eval(spark, d, kind, **params):
    b = _table(spark, d)
    train = P.with_balanced_weight(b.where(F.col("split") == "train").withColumn(
        "_y", F.col(LABEL).cast("int")), "_y").drop("_y")
    m = P.fit_classifier(train, NUMERIC, CATEGORICAL, LABEL, kind, weight="weight", **params)
    scored = P.spread(P.probability(m.transform(b.where(F.col("split") == "test"))).select(LABEL, "p"))
    return m, scored


@query("logistic_regression")
def logistic_regression(spark, d):
    """Balanced-weight logistic regression; test AUC (exact)."""
    _, s = _fit_eval(spark, d, "logistic")
    return _auc(s, LABEL, "p").withColumn("model", F.lit("logistic_regression"))


@query("random_forest")
def random_forest(spark, d):
    """Random forest classifier of 100 trees of depth 15; test AUC."""
    _, s = _fit_eval(spark, d, "random_forest", numTrees=100, maxDepth=15)
    return _auc(s, LABEL, "p").withColumn("model", F.lit("random_forest"))


@query("boosted_trees")
def boosted_trees(spark, d):
    """Gradient-boosted trees of depth 6, stopped by the validation set."""
    b = ml_base(spark, d)
    tv = b.where(F.col("split").isin("train", "val")).withColumn("is_val", F.col("split") == "val")
    m = P.fit_classifier(tv, NUMERIC, CATEGORICAL, LABEL, "gbt", maxIter=50, maxDepth=6,
                         validationIndicatorCol="is_val")
    s = P.probability(m.transform(b.where(F.col("split") == "test")))
    return _auc(s, LABEL, "p").withColumn("model", F.lit("gbt"))


def _segment_ml(spark, d):
    s = V.segments(spark, d).join(V.counts(spark, d), "segment_id")
    from ..functions.cleaning import to_numeric_null_token
    return s.select("segment_id", to_numeric_null_token("speed_limit").alias("speed_limit"),
                    F.col("through_lanes").cast("double").alias("through_lanes"),
                    F.col("f_system").cast("double").alias("f_system"), F.col("aadt").cast("double").alias("aadt"),
                    F.col("y").cast("double").alias("y"),
                    F.when(N.mix("segment_id") < int(0.8 * N.MIX_MOD), "train").otherwise("test").alias("split"))


@query("count_regressors")
def count_regressors(spark, d):
    """Random forest, GBT and Poisson regressors on segment
    crash counts; one regression report row per model (test split)."""
    s = P.spread(_segment_ml(spark, d))
    num = ["speed_limit", "through_lanes", "f_system", "aadt"]
    out = None
    for kind, params in (("random_forest", {"numTrees": 100, "maxDepth": 10}), ("gbt", {"maxIter": 50}),
                         ("poisson", {"regParam": 1.0})):
        m = P.fit_regressor(s.where(F.col("split") == "train"), num, [], "y", kind, **params)
        pred = m.transform(s.where(F.col("split") == "test")).select("y", F.greatest(F.col("prediction"), F.lit(0.0)).alias("yhat"))
        r = O.regression_report(P.spread(pred), "y", "yhat").select(F.lit(kind).alias("model"), "rmse", "mae", "poisson_deviance")
        out = r if out is None else out.unionByName(r)
    return out


@query("zero_inflated_poisson")
def zero_inflated_poisson(spark, d):
    """ZIP to convergence (it raises otherwise); the log-likelihood must
    not fall; AIC and BIC; coefficients per feature."""
    features = ["speed_limit", "through_lanes", "f_system", "aadt"]
    s = _segment_ml(spark, d).na.fill({"speed_limit": 0.0})
    m = fit_zero_inflated(s, features, "y")
    ic = m.information
    monotone = all(b >= a for a, b in zip(m.trace, m.trace[1:], strict=False))
    coefficients = F.array(*[F.struct(F.lit(c).alias("term"), F.lit(a).alias("count_coefficient"), F.lit(b).alias("zero_coefficient"))
                             for c, a, b in zip(["intercept", *features], m.count, m.zero, strict=True)])
    return m.transform(s).agg(F.avg("mean").alias("mean_fitted"), F.avg("pi").alias("mean_pi")).select(
        "*", F.lit(ic["llf"]).alias("llf"), F.lit(ic["aic"]).alias("aic"), F.lit(ic["bic"]).alias("bic"),
        F.lit(len(m.trace)).alias("rounds"), F.lit(int(monotone)).alias("llf_monotone"), F.explode(coefficients).alias("c")).select("*", "c.*").drop("c")


def _folds(spark, d, k):
    b = ml_base(spark, d).where(F.col("split") == "train")
    return N.stratified_kfold(b, LABEL, "id", k).select("id", *NUMERIC, *CATEGORICAL, LABEL, "fold")


@query("calibrate")
def calibrate(spark, d):
    """Isotonic and Platt calibration over three folds (no row is
    calibrated by a fit that saw it); Brier score per fold, before and after."""
    oof = out_of_fold(_folds(spark, d, 3), NUMERIC, CATEGORICAL, LABEL, "fold", [Candidate("logistic", {"maxIter": 50})], 3)
    out = None
    for method in ("isotonic", "platt"):
        s = fold_scores(calibrate_folds(oof, "p_0", LABEL, "fold", 3, method), "p_0", LABEL, "fold").select(F.lit(method).alias("method"), "*")
        out = s if out is None else out.unionByName(s)
    return out


@query("isotonic_fit", """
WITH RECURSIVE s AS (SELECT (id * 7919 % 97) AS x, (id * 31 % 4 >= 2)::INT AS y FROM crashes),
t AS (SELECT x, count(*) AS w, sum(y) AS s, row_number() OVER (ORDER BY x) AS i FROM s GROUP BY x),
c AS (SELECT i, x, sum(w) OVER (ORDER BY i) AS cw, sum(s) OVER (ORDER BY i) AS cs FROM t UNION ALL SELECT 0, NULL, 0, 0),
fit AS (
  SELECT t.i, t.x, (SELECT max(m) FROM (
    SELECT a.i, min((b.cs - a.cs) / (b.cw - a.cw)) AS m FROM c a JOIN c b ON b.i >= t.i WHERE a.i < t.i GROUP BY a.i)) AS value FROM t)
SELECT x::DOUBLE AS x, round_even(value, 9) AS fitted FROM fit""", ("crashes",))
def isotonic_fit(spark, d):
    """The isotonic fit of a noisy score, value by value (the oracle: the
    largest of the least means over stretches around each)."""
    s = V.crashes(spark, d).select((F.col("id") * 7919 % 97).cast("double").alias("x"), (F.col("id") * 31 % 4 >= 2).cast("int").alias("y"))
    fitted = apply_isotonic(s.select("x").distinct(), "x", fit_isotonic(s, "x", "y"), "fitted")
    return fitted.select("x", r6("fitted", 9).alias("fitted"))


SEARCH = [*grid("logistic", {"regParam": [0.0, 0.1], "maxIter": [20]}),
          *grid("random_forest", {"numTrees": [20, 50], "maxDepth": [5, 10]}, n_random=2),
          *grid("gbt", {"maxIter": [10], "maxDepth": [3, 5]}, n_random=1)]


@query("hyperparameter_search")
def hyperparameter_search(spark, d):
    """Three kinds of models, grid and random, over three stratified
    folds, categorical features among them; mean AUC per candidate."""
    scores = cross_val_score(_folds(spark, d, 3), NUMERIC, CATEGORICAL, LABEL, "fold", SEARCH, 3)
    return scores.groupBy("candidate", "kind", "params").agg(F.avg("auc").alias("mean_auc"), F.min("auc").alias("lowest_auc"), F.max("auc").alias("highest_auc"))


@query("cross_val_score")
def cross_val(spark, d):
    """AUC of each of five stratified folds."""
    return cross_val_score(_folds(spark, d, 5), NUMERIC, CATEGORICAL, LABEL, "fold", [Candidate("logistic", {"maxIter": 50})], 5).select("kind", "fold", "n", "auc")


@query("learning_curve")
def learning_curve(spark, d):
    """Test AUC against growing train fractions (N1-style mix order)."""
    b = _table(spark, d)
    test = b.where(F.col("split") == "test")
    out = None
    for frac in (0.25, 0.5, 1.0):
        tr = b.where((F.col("split") == "train") & (N.mix("id") < int(frac * N.MIX_MOD)))
        m = P.fit_classifier(tr, NUMERIC, CATEGORICAL, LABEL, "logistic", maxIter=50)
        a = _auc(P.spread(P.probability(m.transform(test)).select(LABEL, "p")), LABEL, "p").select(F.lit(frac).alias("train_fraction"), "auc")
        out = a if out is None else out.unionByName(a)
    return out


@query("voting", """
SELECT id, round_even((0.0 + p + ((id * 7919) % 1000) / 1000.0) / 2, 6) AS p_vote FROM scored""", ("scored",))
def voting(spark, d):
    """Soft voting = mean of two members' probabilities (second member:
    an independent deterministic scorer of the same rows)."""
    s = V.scored(spark, d).withColumn("p2", ((F.col("id") * 7919) % 1000) / 1000.0)
    return P.voting(s, ["p", "p2"]).select("id", r6("p_vote").alias("p_vote"))


@query("stacking")
def stacking(spark, d):
    """Three fitted members, their mean and a logistic regression on their
    out-of-fold probabilities; test AUC of each."""
    b = ml_base(spark, d)
    members = [Candidate("logistic", {"maxIter": 50}), Candidate("random_forest", {"numTrees": 50, "maxDepth": 10}),
               Candidate("gbt", {"maxIter": 10, "maxDepth": 4})]
    e = Ensemble(_folds(spark, d, 3), NUMERIC, CATEGORICAL, LABEL, "fold", members, 3)
    test = P.spread(e.transform(b.where(F.col("split") == "test").select("id", *NUMERIC, *CATEGORICAL, LABEL)).drop("id", *NUMERIC, *CATEGORICAL))
    out = None
    for c, name in zip([*e.columns, "p_vote", "p_stack"], [*(m.kind for m in members), "voting", "stacking"], strict=True):
        a = _auc(test, LABEL, c).withColumn("model", F.lit(name))
        out = a if out is None else out.unionByName(a)
    return out


def _embedded(spark, d):
    e = spark.read.parquet(f"{d}/embeddings.parquet").where(F.col("embedding").isNotNull())
    return e.select("vec_id", array_to_vector(F.transform("embedding", lambda v: v.cast("double"))).alias("f"))


@query("kmeans")
def kmeans(spark, d):
    """All 64 components, scaled; cost and simplified silhouette for k = 2
    to 9 (the best of ten starts each), and the sizes of the four clusters."""
    pts = P.scaled_vectors(_embedded(spark, d), "f")
    models = P.kmeans_many(pts, "f", range(2, 10))
    rows = P.elbow_rows(pts, "f", models)
    sizes = models[4].transform(pts).groupBy(F.col("prediction").alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    long = [("inertia", k, c) for k, c, _ in rows] + [("silhouette", k, s) for k, _, s in rows]
    return sizes.select(F.lit("k4_size").alias("kind"), F.col("cluster").cast("long").alias("k"), F.col("n").cast("double").alias("value")).unionByName(
        spark.createDataFrame(long, "kind string, k long, value double"))


@query("kmeans_assign", """
WITH c AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cluster, CAST(embedding AS DOUBLE[]) AS v FROM embeddings ORDER BY vec_id LIMIT 4),
x AS (SELECT e.vec_id, c.cluster, list_distance(CAST(e.embedding AS DOUBLE[]), c.v) AS d FROM embeddings e, c)
SELECT vec_id, CAST(arg_min(cluster, d) AS INTEGER) AS cluster, round_even(min(d), 6) AS distance FROM x GROUP BY vec_id""")
def kmeans_assign(spark, d):
    """Every vector to the nearest of four given centres."""
    pts = _embedded(spark, d)
    centres = [r.f.toArray().tolist() for r in pts.orderBy("vec_id").limit(4).collect()]
    return P.assign_centres(pts, "f", centres).select("vec_id", "cluster", r6("distance").alias("distance"))


DBSCAN_SQL = """WITH RECURSIVE
nb AS (SELECT a.vec_id AS a, b.vec_id AS b FROM planar a JOIN planar b
       ON sqrt(power(a.px - b.px, 2) + power(a.py - b.py, 2)) <= 0.5),
core AS (SELECT a FROM nb GROUP BY a HAVING count(*) >= 5),
ce AS (SELECT nb.a, nb.b FROM nb JOIN core c1 ON nb.a = c1.a JOIN core c2 ON nb.b = c2.a),
reach(a, b) AS (SELECT a, b FROM ce UNION SELECT reach.a, ce.b FROM reach JOIN ce ON reach.b = ce.a),
lab AS (SELECT a, min(b) AS label FROM reach GROUP BY a),
border AS (SELECT nb.a, min(lab.label) AS bl FROM nb JOIN lab ON nb.b = lab.a GROUP BY nb.a)
SELECT p.vec_id, CAST(coalesce(lab.label, border.bl, -1) AS BIGINT) AS cluster
FROM planar p LEFT JOIN lab ON p.vec_id = lab.a LEFT JOIN border ON p.vec_id = border.a"""
EPS = 0.9


@query("dbscan", DBSCAN_SQL.replace("WITH RECURSIVE", "WITH RECURSIVE vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),", 1)
       .replace("planar", "vectors").replace("sqrt(power(a.px - b.px, 2) + power(a.py - b.py, 2)) <= 0.5", f"list_distance(a.v, b.v) <= {EPS}"))
def dbscan(spark, d):
    """DBSCAN over all 64 components, min_samples 5, canonical labels
    (smallest core id of the component), noise -1."""
    return P.dbscan(spark.read.parquet(f"{d}/embeddings.parquet"), "vec_id", "embedding", EPS, 5)


@query("dbscan_planar", DBSCAN_SQL, ("planar",))
def dbscan_planar(spark, d):
    """P17 in two dimensions: eps 0.5, min_samples 5."""
    return P.dbscan(V.planar(spark, d), "vec_id", ["px", "py"], 0.5, 5)


@query("pca2")
def pca2(spark, d):
    """Two principal components of the scaled 64-d embeddings
    (rows; invariants: component variances descending)."""
    e = V.planar(spark, d).join(
        spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", array_to_vector(
            F.transform("embedding", lambda v: v.cast("double"))).alias("emb")), "vec_id")
    return P.pca2(e, "emb").select("vec_id", "pc1", "pc2")


@query("batch_score")
def batch_score(spark, d):
    """P20: save the fitted pipeline, reload it, score every crash, apply the
    threshold and dispatch tier; reload must reproduce the scores."""
    from ..functions.features import score_to_decision
    b = ml_base(spark, d)
    m = P.fit_classifier(b.where(F.col("split") == "train"), NUMERIC, CATEGORICAL, LABEL, "logistic", maxIter=50)
    m2 = P.save_and_reload(m, shared_dir(spark, "model"))
    s1 = P.probability(m.transform(b)).select("id", F.col("p").alias("p1"))
    s2 = P.probability(m2.transform(b)).select("id", "p")
    dec = score_to_decision("p", 0.5)
    return s2.join(s1, "id").select("id", "p", dec["prediction"].alias("prediction"),
                                    dec["dispatch_tier"].alias("dispatch_tier"),
                                    (F.abs(F.col("p") - F.col("p1")) < 1e-12).cast("int").alias("reload_equal"))


@query("tree_importance")
def tree_importance(spark, d):
    """Ranked random-forest importances of numeric and categorical
    features (the slots of a category summed) with a family tag."""
    b = ml_base(spark, d)
    m = P.fit_classifier(b.where(F.col("split") == "train"), NUMERIC, CATEGORICAL, LABEL, "random_forest", numTrees=100, maxDepth=10)
    fam = {"hour": "temporal", "day_of_week": "temporal", "month": "temporal", "temperature_f": "weather",
           "visibility_mi": "weather", "weather_category": "weather", "x": "location", "y": "location", "city": "location"}
    rows = P.feature_importances(m, b, NUMERIC, CATEGORICAL, fam)
    return spark.createDataFrame(rows, "feature string, importance double, family string")


LEAKAGE_FORBIDDEN = ["severity", "end_time", "end_lat", "end_lng"]


@query("train_and_report")
def train_and_report(spark, d):
    """Leakage check -> P6 -> P7 / P8 / P9 -> P12 (isotonic) -> O8 -> O1
    report of three kinds of models on the test split."""
    b = ml_base(spark, d).select("id", *NUMERIC, *CATEGORICAL, LABEL, "split")
    part = lambda s: b.where(F.col("split") == s)
    candidates = [Candidate("logistic", {"maxIter": 50}), Candidate("random_forest", {"numTrees": 50, "maxDepth": 10}),
                  Candidate("gbt", {"maxIter": 10, "maxDepth": 4})]
    return report(part("train"), part("val"), part("test"), NUMERIC, CATEGORICAL, LABEL, candidates, LEAKAGE_FORBIDDEN)


@query("sensitivity")
def sensitivity(spark, d):
    """A fitted model's probability with temperature and visibility changed
    by -10 % to +10 % in five steps; mean per feature and step."""
    b = ml_base(spark, d).select("id", *NUMERIC, *CATEGORICAL, LABEL, "split")
    m = P.fit_classifier(b.where(F.col("split") == "train"), NUMERIC, CATEGORICAL, LABEL, "logistic", maxIter=50)
    s = vary(b.where(F.col("split") == "test"), ["temperature_f", "visibility_mi"], lambda t: P.probability(m.transform(t)), "p", "id", steps=5)
    return s.groupBy("feature", "step").agg(F.avg("score").alias("mean_score"), F.count("score").alias("n"))
