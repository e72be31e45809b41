"""Exact evaluation of scored tables.

All metrics are aggregates over the scored table. Ranking metrics (AUC, AP,
ROC/PR curves) first collapse to one row per distinct score (a hot score is
one row after map-side aggregation), then take distributed prefix sums over
the distinct scores (``prefix_offsets``): exact, tie-averaged, and never a
single-partition window over the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import prefix_offsets


def _safe_div(a, b):
    return F.coalesce(F.try_divide(a, F.nullif(b, F.lit(0))), F.lit(0.0))


def confusion_counts(df: DataFrame, y: str, p: str, threshold: float) -> DataFrame:
    """TP/FP/TN/FN at a threshold in one aggregate."""
    pred = F.col(p) >= threshold
    pos = F.col(y) == 1
    return df.agg(F.count_if(pred & pos).alias("tp"), F.count_if(pred & ~pos).alias("fp"),
                  F.count_if(~pred & ~pos).alias("tn"), F.count_if(~pred & pos).alias("fn"))


def classification_report(df: DataFrame, y: str, p: str, threshold: float = 0.5) -> DataFrame:
    """O1/O2: accuracy, precision, recall, F1 (zero division -> 0), counts and
    predicted/true positive shares at a threshold."""
    c = confusion_counts(df, y, p, threshold)
    tp, fp, tn, fn = (F.col(k) for k in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    prec, rec = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    return c.select("tp", "fp", "tn", "fn", _safe_div(tp + tn, n).alias("accuracy"), prec.alias("precision"),
                    rec.alias("recall"), _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
                    _safe_div(tp + fp, n).alias("predicted_positive_share"),
                    _safe_div(tp + fn, n).alias("true_positive_share"), F.lit(threshold).alias("threshold"))


def score_table(df: DataFrame, y: str, p: str) -> DataFrame:
    """One row per distinct score: positives and negatives at that score."""
    return df.groupBy(F.col(p).alias("score")).agg(F.count_if(F.col(y) == 1).alias("pos"),
                                                   F.count_if(F.col(y) != 1).alias("neg"))


def roc_auc(df: DataFrame, y: str, p: str) -> DataFrame:
    """O3: exact ROC AUC with ties counted one half (Mann-Whitney)."""
    st = score_table(df, y, p)
    cum = prefix_offsets(st, "score", ["neg"])
    part = cum.agg(F.sum(F.col("pos").cast("double") * (F.col("before_neg") + F.col("neg") * 0.5)).alias("num"),
                   F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return part.select(F.try_divide(F.try_divide(F.col("num"), F.col("P")), F.col("N")).alias("auc"))


def curves(df: DataFrame, y: str, p: str) -> DataFrame:
    """Per distinct threshold (descending) tp, fp, tpr, fpr, precision,
    recall; the cumulative counts run from the highest score down."""
    st = score_table(df, y, p).withColumn("neg_score", -F.col("score"))
    cum = prefix_offsets(st, "neg_score", ["pos", "neg"])
    P = st.select(F.sum("pos")).scalar()
    N = st.select(F.sum("neg")).scalar()
    tp = F.col("before_pos") + F.col("pos")
    fp = F.col("before_neg") + F.col("neg")
    return cum.select(F.col("score").alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                      F.try_divide(tp, F.lit(1.0) * P).alias("tpr"), F.try_divide(fp, F.lit(1.0) * N).alias("fpr"),
                      (tp / (tp + fp)).alias("precision"), F.try_divide(tp, F.lit(1.0) * P).alias("recall"),
                      F.col("pos"))


def average_precision(df: DataFrame, y: str, p: str) -> DataFrame:
    """AP = sum over thresholds of (R_n - R_{n-1}) * P_n."""
    c = curves(df, y, p)
    P = df.select(F.count_if(F.col(y) == 1)).scalar()
    return c.agg(F.try_divide(F.sum(F.col("pos") * F.col("precision")), F.lit(1.0) * P).alias("average_precision"))


def brier_score(df: DataFrame, y: str, p: str) -> DataFrame:
    """O6."""
    return df.agg(F.avg(F.pow(F.col(p) - F.col(y), 2)).alias("brier_score"))


def top_decile_report(df: DataFrame, y: str, p: str, q: float = 0.9) -> DataFrame:
    """Rows with p >= the q-quantile: count, precision (mean label) and
    enrichment over the overall mean (0 when the overall mean is 0)."""
    from .quantiles import quantile
    t = quantile(df, p, q)
    overall = df.select(F.avg(y)).scalar()
    top = df.where(F.col(p) >= t)
    return top.agg(F.count(F.lit(1)).alias("top_count"), F.coalesce(F.avg(y), F.lit(0.0)).alias("top_mean")) \
        .withColumn("enrichment", F.when(overall > 0, F.col("top_mean") / overall).otherwise(F.lit(0.0)))


SWEEP = [k / 20 for k in range(2, 18)]  # 0.10 .. 0.85 step 0.05, exact grid


def threshold_sweep(df: DataFrame, y: str, p: str, thresholds=SWEEP) -> DataFrame:
    """f1/precision/recall/accuracy at every grid threshold, computed in
    ONE aggregate (four count_if per threshold, map-side partial), then
    unpivoted: no cross join with the grid."""
    pos = F.col(y) == 1
    aggs = []
    for i, t in enumerate(thresholds):
        pred = F.col(p) >= t
        aggs += [F.count_if(pred & pos).alias(f"tp{i}"), F.count_if(pred & ~pos).alias(f"fp{i}"),
                 F.count_if(~pred & ~pos).alias(f"tn{i}"), F.count_if(~pred & pos).alias(f"fn{i}")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"tp{i}").alias("tp"),
                                        F.col(f"fp{i}").alias("fp"), F.col(f"tn{i}").alias("tn"),
                                        F.col(f"fn{i}").alias("fn")) for i, t in enumerate(thresholds)]))
    long = one.select(rows.alias("r")).select("r.*")
    tp, fp, tn, fn = (F.col(k) for k in ("tp", "fp", "tn", "fn"))
    return long.select("threshold", _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
                       _safe_div(tp, tp + fp).alias("precision"), _safe_div(tp, tp + fn).alias("recall"),
                       _safe_div(tp + tn, tp + fp + tn + fn).alias("accuracy"))


def optimal_threshold(sweep: DataFrame, metrics=("f1", "precision", "recall", "accuracy"),
                      default: float = 0.5) -> DataFrame:
    """Per metric the first threshold with a strictly greater score than
    all before it (lowest threshold among maxima); if every score is 0 the
    default threshold is kept."""
    long = sweep.unpivot(["threshold"], list(metrics), "metric", "score")
    best = long.groupBy("metric").agg(F.max("score").alias("best"),
                                      F.min_by("threshold", F.struct(-F.col("score"), F.col("threshold"))).alias("t"))
    return best.select("metric", F.when(F.col("best") > 0, F.col("t")).otherwise(F.lit(default)).alias("threshold"),
                       F.col("best").alias("score"))


def calibration_curve(df: DataFrame, y: str, p: str, n_bins: int = 10) -> DataFrame:
    """Uniform bins, right-closed like ``searchsorted`` on the inner
    edges; empty bins absent; gap status ok < 0.1 <= warn < 0.2 <= bad."""
    b = sum((F.when(F.col(p) > j / n_bins, 1).otherwise(0) for j in range(1, n_bins)), F.lit(0))
    g = df.groupBy(b.alias("bin")).agg(F.avg(p).alias("mean_predicted"), F.avg(y).alias("observed_rate"),
                                       F.count(F.lit(1)).alias("n"))
    gap = F.abs(F.col("mean_predicted") - F.col("observed_rate"))
    return g.withColumn("gap", gap).withColumn("status", F.when(gap < 0.1, "ok").when(gap < 0.2, "warn").otherwise("bad"))


def regression_report(df: DataFrame, y: str, yhat: str, eps: float = 1e-10) -> DataFrame:
    """RMSE, MAE, R2, MAPE (null if any y is 0), mean Poisson deviance
    (predictions floored at eps; the y = 0 term is 2*yhat), means, zero
    shares, and top-10 % enrichment."""
    yc, pc = F.col(y).cast("double"), F.greatest(F.col(yhat).cast("double"), F.lit(eps))
    dev = F.when(yc == 0, 2 * pc).otherwise(2 * (yc * F.ln(yc / pc) - yc + pc))
    base = df.agg(
        F.sqrt(F.avg(F.pow(yc - F.col(yhat), 2))).alias("rmse"), F.avg(F.abs(yc - F.col(yhat))).alias("mae"),
        (1 - F.sum(F.pow(yc - F.col(yhat), 2)) / (F.var_pop(yc) * F.count(yc))).alias("r2"),
        F.when(F.count_if(yc == 0) == 0, F.avg(F.abs(F.try_divide(yc - F.col(yhat), yc))) * 100).alias("mape"),
        F.avg(dev).alias("poisson_deviance"), F.avg(yhat).alias("mean_pred"), F.avg(yc).alias("mean_true"),
        F.avg(F.when(F.col(yhat) == 0, 1.0).otherwise(0.0)).alias("pred_zero_share"),
        F.avg(F.when(yc == 0, 1.0).otherwise(0.0)).alias("true_zero_share"))
    from .quantiles import quantile
    t = quantile(df, yhat, 0.9)
    top = df.where(F.col(yhat) >= t).agg(F.avg(yc).alias("top10_actual_mean"), F.count(F.lit(1)).alias("top10_count"))
    j = base.select("*", top.select("top10_actual_mean").scalar().alias("top10_actual_mean"),
                    top.select("top10_count").scalar().alias("top10_count"))
    return j.withColumn("top10_enrichment", F.when(F.col("mean_true") > 0, F.col("top10_actual_mean") / F.col("mean_true"))
                        .otherwise(F.lit(0.0)))


def class_weights(df: DataFrame, y: str, out: str = "weight") -> DataFrame:
    """Balanced weights n / (k * n_class) as a column (class counts are
    one aggregate joined back; Spark broadcasts it if it is small)."""
    counts = df.groupBy(y).agg(F.count(F.lit(1)).alias("_nc"))
    n = df.select(F.count(F.lit(1))).scalar()
    k = counts.select(F.count(F.lit(1))).scalar()
    return df.join(counts, y).withColumn(out, n / (k * F.col("_nc"))).drop("_nc")


def scale_pos_weight(df: DataFrame, y: str) -> DataFrame:
    """Negatives / positives."""
    return df.agg(F.try_divide(F.count_if(F.col(y) != 1) * 1.0, F.count_if(F.col(y) == 1)).alias("scale_pos_weight"))
