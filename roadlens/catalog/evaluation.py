"""Evaluation queries on the ``scored`` (binary) and ``counts`` (count
regression) views (O1-O11)."""

from __future__ import annotations

from .. import testviews as V
from ..operators import evaluate as O
from .base import query, r6

CM = """count(*) FILTER (WHERE p >= {t} AND y = 1) AS tp, count(*) FILTER (WHERE p >= {t} AND y <> 1) AS fp,
        count(*) FILTER (WHERE p < {t} AND y <> 1) AS tn, count(*) FILTER (WHERE p < {t} AND y = 1) AS fn"""


def _div(a, b):
    return f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0.0)"


@query("classification_report", f"""
SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn,
  round_even({_div('tp + tn', 'tp + fp + tn + fn')}, 6) AS accuracy, round_even({_div('tp', 'tp + fp')}, 6) AS precision,
  round_even({_div('tp', 'tp + fn')}, 6) AS recall, round_even({_div('2 * tp', '2 * tp + fp + fn')}, 6) AS f1,
  round_even({_div('tp + fp', 'tp + fp + tn + fn')}, 6) AS predicted_positive_share,
  round_even({_div('tp + fn', 'tp + fp + tn + fn')}, 6) AS true_positive_share, CAST(0.45 AS DOUBLE) AS threshold
FROM (SELECT {CM.format(t=0.45)} FROM scored)""", ("scored",))
def classification_report(spark, d):
    """O1 + O2 at threshold 0.45."""
    r = O.classification_report(V.scored(spark, d), "y", "p", 0.45)
    return r.select("tp", "fp", "tn", "fn", *[r6(c).alias(c) for c in (
        "accuracy", "precision", "recall", "f1", "predicted_positive_share", "true_positive_share")], "threshold")


ST_SQL = """st AS (SELECT p AS score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg
                FROM scored GROUP BY p)"""


@query("roc_auc", f"""
WITH {ST_SQL},
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_neg FROM st)
SELECT round_even(CAST(sum(pos * (before_neg + neg * 0.5)) AS DOUBLE) / (sum(pos) * sum(neg)), 6) AS auc FROM c""",
       ("scored",))
def roc_auc(spark, d):
    """O3: exact AUC with tie averaging."""
    return O.roc_auc(V.scored(spark, d), "y", "p").select(r6("auc").alias("auc"))


CURVE_SQL = f"""
WITH {ST_SQL},
c AS (SELECT score, pos, neg,
             sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
             sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM st)"""


@query("roc_pr_curve", CURVE_SQL + """
SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round_even(CAST(tp AS DOUBLE) / P, 6) AS tpr,
       round_even(CAST(fp AS DOUBLE) / N, 6) AS fpr, round_even(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision,
       round_even(CAST(tp AS DOUBLE) / P, 6) AS recall FROM c""", ("scored",))
def roc_pr_curve(spark, d):
    """ROC and PR points per distinct threshold."""
    c = O.curves(V.scored(spark, d), "y", "p")
    return c.select("threshold", "tp", "fp", *[r6(k).alias(k) for k in ("tpr", "fpr", "precision", "recall")])


@query("average_precision", CURVE_SQL + """
SELECT round_even(sum(pos * (CAST(tp AS DOUBLE) / (tp + fp))) / max(P), 6) AS average_precision FROM c""", ("scored",))
def average_precision(spark, d):
    """O5."""
    return O.average_precision(V.scored(spark, d), "y", "p").select(r6("average_precision").alias("average_precision"))


@query("brier_score", "SELECT round_even(avg(power(p - y, 2)), 6) AS brier_score FROM scored", ("scored",))
def brier_score(spark, d):
    """O6."""
    return O.brier_score(V.scored(spark, d), "y", "p").select(r6("brier_score").alias("brier_score"))


@query("top_decile_report", """
WITH t AS (SELECT quantile_cont(p, 0.9) AS t, avg(y) AS m FROM scored)
SELECT CAST(count(*) AS BIGINT) AS top_count, round_even(coalesce(avg(y), 0.0), 6) AS top_mean,
       round_even(CASE WHEN max(m) > 0 THEN avg(y) / max(m) ELSE 0.0 END, 6) AS enrichment
FROM scored, t WHERE p >= t.t""", ("scored",))
def top_decile_report(spark, d):
    """O7."""
    r = O.top_decile_report(V.scored(spark, d), "y", "p")
    return r.select("top_count", r6("top_mean").alias("top_mean"), r6("enrichment").alias("enrichment"))


SWEEP_SQL = "WITH s AS (" + " UNION ALL ".join(
    f"SELECT {k / 20} AS threshold, {CM.format(t=k / 20)} FROM scored" for k in range(2, 18)) + """),
m AS (SELECT CAST(threshold AS DOUBLE) AS threshold, """ + f"""{_div('2 * tp', '2 * tp + fp + fn')} AS f1,
      {_div('tp', 'tp + fp')} AS precision, {_div('tp', 'tp + fn')} AS recall,
      {_div('tp + tn', 'tp + fp + tn + fn')} AS accuracy FROM s)"""


@query("threshold_sweep", SWEEP_SQL + """
SELECT threshold, round_even(f1, 6) AS f1, round_even(precision, 6) AS precision, round_even(recall, 6) AS recall,
       round_even(accuracy, 6) AS accuracy FROM m""", ("scored",))
def threshold_sweep(spark, d):
    """Metrics on the 0.10 .. 0.85 grid in one aggregate."""
    s = O.threshold_sweep(V.scored(spark, d), "y", "p")
    return s.select("threshold", *[r6(k).alias(k) for k in ("f1", "precision", "recall", "accuracy")])


@query("optimal_threshold", SWEEP_SQL + """,
l AS (UNPIVOT m ON f1, precision, recall, accuracy INTO NAME metric VALUE score)
SELECT metric, CASE WHEN max(score) > 0 THEN arg_min(threshold, (-score, threshold)) ELSE 0.5 END AS threshold,
       round_even(max(score), 6) AS score FROM l GROUP BY metric""", ("scored",))
def optimal_threshold(spark, d):
    """Best threshold per metric (first strict maximum)."""
    o = O.optimal_threshold(O.threshold_sweep(V.scored(spark, d), "y", "p"))
    return o.select("metric", "threshold", r6("score").alias("score"))


@query("calibration_curve", """
SELECT bin, round_even(avg(p), 6) AS mean_predicted, round_even(avg(y), 6) AS observed_rate, CAST(count(*) AS BIGINT) AS n,
       round_even(abs(avg(p) - avg(y)), 6) AS gap,
       CASE WHEN abs(avg(p) - avg(y)) < 0.1 THEN 'ok' WHEN abs(avg(p) - avg(y)) < 0.2 THEN 'warn' ELSE 'bad' END AS status
FROM (SELECT p, y, """ + " + ".join(f"CASE WHEN p > {j / 10} THEN 1 ELSE 0 END" for j in range(1, 10)) + """ AS bin
      FROM scored) GROUP BY bin""", ("scored",))
def calibration_curve(spark, d):
    """O9."""
    c = O.calibration_curve(V.scored(spark, d), "y", "p")
    return c.select("bin", r6("mean_predicted").alias("mean_predicted"), r6("observed_rate").alias("observed_rate"),
                    "n", r6("gap").alias("gap"), "status")


@query("regression_report", """
WITH m AS (SELECT avg(y) AS ybar FROM counts), t AS (SELECT quantile_cont(yhat, 0.9) AS t FROM counts),
top AS (SELECT avg(y) AS top10_actual_mean, count(*) AS top10_count FROM counts, t WHERE yhat >= t.t)
SELECT round_even(sqrt(avg(power(y - yhat, 2))), 6) AS rmse, round_even(avg(abs(y - yhat)), 6) AS mae,
       round_even(1 - sum(power(y - yhat, 2)) / sum(power(y - ybar, 2)), 6) AS r2,
       round_even(CASE WHEN count(*) FILTER (WHERE y = 0) = 0 THEN avg(abs((y - yhat) / y)) * 100 END, 6) AS mape,
       round_even(avg(CASE WHEN y = 0 THEN 2 * greatest(yhat, 1e-10)
                      ELSE 2 * (y * ln(y / greatest(yhat, 1e-10)) - y + greatest(yhat, 1e-10)) END), 6) AS poisson_deviance,
       round_even(avg(yhat), 6) AS mean_pred, round_even(avg(y), 6) AS mean_true,
       round_even(avg(CASE WHEN yhat = 0 THEN 1.0 ELSE 0.0 END), 6) AS pred_zero_share,
       round_even(avg(CASE WHEN y = 0 THEN 1.0 ELSE 0.0 END), 6) AS true_zero_share,
       round_even(max(top10_actual_mean), 6) AS top10_actual_mean, CAST(max(top10_count) AS BIGINT) AS top10_count,
       round_even(CASE WHEN avg(y) > 0 THEN max(top10_actual_mean) / avg(y) ELSE 0.0 END, 6) AS top10_enrichment
FROM counts, m, top""", ("counts",))
def regression_report(spark, d):
    """O10 on per-segment crash counts."""
    r = O.regression_report(V.counts(spark, d), "y", "yhat")
    cols = ["rmse", "mae", "r2", "mape", "poisson_deviance", "mean_pred", "mean_true", "pred_zero_share",
            "true_zero_share", "top10_actual_mean"]
    return r.select(*[r6(c).alias(c) for c in cols], "top10_count", r6("top10_enrichment").alias("top10_enrichment"))


@query("class_weights", """
WITH c AS (SELECT y, count(*) AS nc FROM scored GROUP BY y)
SELECT id, y, round_even((SELECT count(*) FROM scored) / ((SELECT count(*) FROM c) * nc), 6) AS weight
FROM scored JOIN c USING (y)""", ("scored",))
def class_weights(spark, d):
    """Balanced per-row weights."""
    w = O.class_weights(V.scored(spark, d).select("id", "y"), "y")
    return w.select("id", "y", r6("weight").alias("weight"))


@query("scale_pos_weight", """
SELECT round_even(count(*) FILTER (WHERE y <> 1) * 1.0 / count(*) FILTER (WHERE y = 1), 6) AS scale_pos_weight FROM scored""",
       ("scored",))
def scale_pos_weight(spark, d):
    """Negative / positive ratio."""
    return O.scale_pos_weight(V.scored(spark, d), "y").select(r6("scale_pos_weight").alias("scale_pos_weight"))
