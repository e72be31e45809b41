"""Probability calibration (P12): isotonic and Platt, with folds.

Isotonic regression is the slope of the greatest convex minorant of the points
(rows so far, positives so far) in the order of the score. The lower hull of a
stretch of points is all that the hull of the whole needs of it, so stretches
of bounded weight take their hulls in parallel and a tree joins them, 32 at a
time. Labels are 0 or 1, and a convex chain over whole numbers up to n has
O(n^(2/3)) corners, so the last hull is small next to its input.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from .ranking import prefix_offsets

#: Weight of the points of a first stretch, and stretches that join at a time.
STRETCH, FAN_IN = 50_000, 32


def _written(df: DataFrame, name: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_hull(w: np.ndarray, s: np.ndarray) -> list[int]:
    """Corners (indexes) of the lower hull of points in ascending ``w``; whole
    numbers are compared exactly."""
    whole = (s == np.floor(s)).all() and (w == np.floor(w)).all()
    x, y = ([int(v) for v in a] if whole else a.tolist() for a in (w, s))
    hull: list[int] = []
    for i in range(len(x)):
        while len(hull) > 1:
            a, b = hull[-2], hull[-1]
            if (y[b] - y[a]) * (x[i] - x[b]) < (y[i] - y[b]) * (x[b] - x[a]):
                break
            hull.pop()
        hull.append(i)
    return hull


def fit_isotonic(df: DataFrame, score: str, label: str) -> DataFrame:
    """``lo, hi, value``: the blocks of the non-decreasing least-squares fit of
    a 0/1 ``label`` on ``score``: scores from lo to hi are fitted by value. Rows
    with a null score or label do not count; no rows give no blocks."""
    spark = df.sparkSession
    ship_package(spark)
    t = (df.select(F.col(score).cast("double").alias("x"), F.col(label).cast("double").alias("y")).where("x is not null and y is not null and not isnan(x)")
         .groupBy((F.col("x") + 0.0).alias("x")).agg(F.count(F.lit(1)).cast("double").alias("w"), F.sum("y").alias("s")))
    total = t.agg(F.sum("w")).first()[0]
    if not total:
        return spark.createDataFrame([], "lo double, hi double, value double")
    t = _written(prefix_offsets(t, "x", ["w", "s"]), "isotonic-points")
    nodes = max(1, math.ceil(total / STRETCH))
    upper = t.select("x", (F.col("before_w") + F.col("w")).alias("w"), (F.col("before_s") + F.col("s")).alias("s"))

    def corners(key, table):
        w, s = table.column("w").to_numpy(), table.column("s").to_numpy()
        order = np.lexsort((s, w))
        return table.take(order[lower_hull(w[order], s[order])])

    def blocks(key, table):
        import pyarrow as pa
        w, s, x = (np.concatenate((first, table.column(c).to_numpy())) for c, first in (("w", [0.0]), ("s", [0.0]), ("x", [-np.inf])))
        order = np.argsort(w, kind="stable")
        hull = order[lower_hull(w[order], s[order])]
        return pa.table([pa.array(w[hull[:-1]]), pa.array(x[hull[1:]]), pa.array(np.diff(s[hull]) / np.diff(w[hull]))], ["before_w", "hi", "value"])
    level = upper.withColumn("node", F.least(F.floor(F.col("w") * nodes / total), F.lit(nodes - 1)).cast("long"))
    while nodes > 1:
        level = level.groupBy("node").applyInArrow(corners, "x double, w double, s double, node long")
        nodes = math.ceil(nodes / FAN_IN)
        level = level.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("long"))
    fitted = level.groupBy("node").applyInArrow(blocks, "before_w double, hi double, value double")
    return _written(fitted.join(t.select("before_w", F.col("x").alias("lo")), "before_w").select("lo", "hi", "value"), "isotonic-blocks")


def apply_isotonic(df: DataFrame, score: str, blocks: DataFrame, out: str = "p_cal") -> DataFrame:
    """``df`` with the fitted value of its score: a block's value inside it, a
    straight line between blocks, the end values beyond. Null scores and a fit
    without blocks give null."""
    order = Window.orderBy("lo")  # of the blocks: few (see the module's text)
    known = blocks.withColumns({"_i": F.row_number().over(order) - 1, "_hi0": F.lag("hi").over(order), "_v0": F.lag("value").over(order)})
    beyond = blocks.agg(F.count(F.lit(1)).alias("_i"), F.max_by("value", "lo").alias("_v0")).where("_i > 0").select(
        F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("value"), "_i", F.lit(None).cast("double").alias("_hi0"), "_v0")
    known = known.select("lo", "value", F.col("_i").cast("long"), "_hi0", "_v0").unionByName(beyond)
    x = F.col(score).cast("double") + 0.0
    wanted = df.select(x.alias("x")).where("x is not null").distinct().withColumns({"kind": F.lit(0), "n": F.lit(0)})
    ends = blocks.select(F.col("hi").alias("x")).withColumns({"kind": F.lit(1), "n": F.lit(1)})
    placed = prefix_offsets(wanted.unionByName(ends), ["x", "kind"], ["n"]).where("kind = 0").select("x", F.col("before_n").cast("long").alias("_i"))
    share = (F.col("x") - F.col("_hi0")) / (F.col("lo") - F.col("_hi0"))
    value = (F.when(F.col("lo").isNull(), F.col("_v0")).when((F.col("x") >= F.col("lo")) | F.col("_v0").isNull(), F.col("value"))
             .otherwise(F.col("_v0") + share * (F.col("value") - F.col("_v0"))))
    table = placed.join(known, "_i").select(F.col("x").alias("_x"), value.alias(out))
    return df.drop(out).withColumn("_x", x).join(table, "_x", "left").drop("_x")


def calibrate(val_scored: DataFrame, score: str, label: str, method: str = "isotonic") -> Callable[[DataFrame], DataFrame]:
    """Isotonic regression or Platt scaling (logistic on the score) fitted
    on scored rows; returns a function DataFrame -> DataFrame adding ``p_cal``."""
    if method == "isotonic":
        blocks = fit_isotonic(val_scored, score, label)
        return lambda df: apply_isotonic(df, score, blocks)
    if method != "platt":
        raise ValueError(method)
    vector = VectorAssembler(inputCols=[score], outputCol="_s")
    m = LogisticRegression(featuresCol="_s", labelCol=label, probabilityCol="_prob", rawPredictionCol="_raw",
                           predictionCol="_pred").fit(vector.transform(val_scored))
    return lambda df: (m.transform(vector.transform(df)).withColumn("p_cal", vector_to_array("_prob")[1]).drop("_s", "_prob", "_raw", "_pred"))


def calibrate_folds(scored: DataFrame, score: str, label: str, fold: str, folds: int, method: str = "isotonic") -> DataFrame:
    """``scored`` with ``p_cal``: the rows of a fold are calibrated by a fit on
    the other folds, so none is calibrated by a fit that saw it."""
    scored = _written(scored, "calibration-scores")
    out = None
    for k in range(folds):
        own = calibrate(scored.where(F.col(fold) != k), score, label, method)(scored.where(F.col(fold) == k))
        out = own if out is None else out.unionByName(own)
    return out


def fold_scores(calibrated: DataFrame, score: str, label: str, fold: str) -> DataFrame:
    """``fold, n, brier_raw, brier_cal`` of rows that ``calibrate_folds`` made."""
    brier = lambda c: F.avg(F.pow(F.col(c) - F.col(label), 2))
    return calibrated.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), brier(score).alias("brier_raw"), brier("p_cal").alias("brier_cal"))
