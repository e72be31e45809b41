"""Training on a user's DataFrames (X9): leakage check, fits of several kinds,
calibration, threshold and report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate as O
from ..operators import learn as P
from ..operators.calibration import calibrate
from ..operators.selection import Candidate, fit


def check_leakage(features: list[str], forbidden: list[str]) -> None:
    """Raise if a feature list (Q19: not the table) names a column that is
    known only after the event, or the target itself."""
    leaked = sorted(set(features) & set(forbidden))
    if leaked:
        raise ValueError(f"leakage features in the feature list: {leaked}")


def train_and_report(train: DataFrame, val: DataFrame, test: DataFrame, numeric: list[str], categorical: list[str], label: str,
                     candidates: list[Candidate], forbidden: list[str] = (), method: str = "isotonic", seed: int = 42) -> DataFrame:
    """A row per candidate: leakage check -> P6 -> P7 / P8 / P9 with balanced
    weights -> P12 on the validation rows -> O8 threshold of the best F1 there
    -> O1 and AUC on the test rows."""
    check_leakage([*numeric, *categorical], [*forbidden, label])
    whole = F.col(label).cast("int")
    # written once; so are the scores, which calibration, threshold and report read again
    train, val, test = (P.spread(t.select(*dict.fromkeys([*numeric, *categorical, label]))) for t in (train, val, test))
    train = P.spread(P.with_balanced_weight(train.withColumn("_y", whole), "_y").drop("_y"))
    features = P.fit_features(train, numeric, categorical)
    out = None
    for c in candidates:
        model = fit(train, numeric, categorical, label, Candidate(c.kind, {**c.params, "weight": "weight"}), seed, features)
        scored = P.spread(P.probability(model.transform(val)).select(label, "p"))
        apply = calibrate(scored, "p", label, method)
        sweep = O.threshold_sweep(apply(scored).withColumn(label, whole), label, "p_cal")
        best = O.optimal_threshold(sweep).where(F.col("metric") == "f1").first()["threshold"]
        done = P.spread(apply(P.spread(P.probability(model.transform(test)).select(label, "p"))).withColumn(label, whole))
        row = O.classification_report(done, label, "p_cal", best).select(
            F.lit(c.label).alias("model"), F.lit(float(best)).alias("chosen_threshold"), "*", O.roc_auc(done, label, "p_cal").select("auc").scalar().alias("auc"))
        out = row if out is None else out.unionByName(row)
    return out
