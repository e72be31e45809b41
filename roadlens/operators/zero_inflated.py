"""Zero-inflated Poisson regression (P11) by damped Newton steps.

Counts are 0 with probability pi and Poisson(lam) otherwise; log(lam) and
logit(pi) are linear in the features. Every round is one aggregate over the rows
(log-likelihood, gradient and curvature: a number of sums that depends on the
features only), the step is solved on the driver, and a second aggregate tries
several step lengths at once. The likelihood never falls, and the fit ends when
the gradient is nothing next to the number of rows; if it doesn't get there, it
raises.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


@dataclass
class ZeroInflatedPoisson:
    """Coefficients on the features as given, intercept first."""
    features: list[str]
    count: list[float]
    zero: list[float]
    trace: list[float]  # log-likelihood after each round
    n: int
    gradient: float  # largest component per row, at the end

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``pi``, ``lam`` and ``mean``; null where a feature is."""
        x = [F.lit(1.0), *(F.col(c).cast("double") for c in self.features)]
        lam = F.exp(_bounded(_linear(x, self.count)))
        pi = 1 / (1 + F.exp(-_linear(x, self.zero)))
        return df.withColumns({"pi": pi, "lam": lam}).withColumn("mean", (1 - F.col("pi")) * F.col("lam"))

    @property
    def information(self) -> dict:
        k, llf = len(self.count) + len(self.zero), self.trace[-1]
        return {"llf": llf, "aic": 2 * k - 2 * llf, "bic": k * math.log(self.n) - 2 * llf}


def _linear(x: list[Column], b) -> Column:
    total = F.lit(0.0)
    for c, v in zip(x, b, strict=True):
        total = total + c * F.lit(float(v))
    return total


def _bounded(eta: Column) -> Column:
    """Keeps exp() finite for steps that are then refused."""
    return F.least(F.greatest(eta, F.lit(-500.0)), F.lit(500.0))


def _likelihood(y: Column, log_fact: Column, eta: Column, zeta: Column) -> Column:
    soft = lambda v: F.greatest(v, F.lit(0.0)) + F.log1p(F.exp(-F.abs(v)))  # noqa: E731  log(1 + e^v)
    lam = F.exp(_bounded(eta))
    # log(pi + (1 - pi) e^-lam) = log(1 + e^(zeta + lam)) - lam - log(1 + e^zeta)
    zero = soft(zeta + lam) - lam - soft(zeta)
    return F.when(y == 0, zero).otherwise(-soft(zeta) + y * eta - lam - log_fact)


def _log_factorial(y: Column) -> Column:
    """log(y!): Stirling's series from 20 on, the sum of logarithms below."""
    z = y + 1.0
    series = (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, F.lit(5.0)))
    small = F.element_at(F.array(*[F.lit(math.lgamma(k + 1)) for k in range(20)]), y.cast("int") + 1)
    return F.when(y < 20, small).otherwise(series)


def fit_zero_inflated(df: DataFrame, features: list[str], label: str, max_rounds: int = 200, tol: float = 1e-9) -> ZeroInflatedPoisson:
    """The maximum-likelihood fit over rows whose features and label are
    there. ``tol``: the largest gradient component per row (features scaled to
    unit deviation) at which it ends. Labels must be whole numbers from 0 on."""
    y0 = F.col(label).cast("double")
    rows = df.select(y0.alias("y"), *[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)])
    for c in rows.columns:
        rows = rows.where(F.col(c).isNotNull() & ~F.isnan(c))
    stat = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("m"), F.avg((F.col("y") == 0).cast("double")).alias("z"),
                    F.coalesce(F.max((F.col("y") < 0) | (F.col("y") != F.floor("y"))), F.lit(False)).alias("bad"),
                    *[F.avg(f"f{i}").alias(f"m{i}") for i in range(len(features))], *[F.stddev_pop(f"f{i}").alias(f"s{i}") for i in range(len(features))]).first()
    if not stat.n or not stat.m:
        raise ValueError("no rows with a positive count")
    if stat.bad:
        raise ValueError("counts must be whole numbers from 0 on")
    centre = np.array([0.0, *(stat[f"m{i}"] for i in range(len(features)))])
    scale = np.array([1.0, *(stat[f"s{i}"] or 1.0 for i in range(len(features)))])
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/zip-{uuid.uuid4().hex}"
    rows.select("y", *[((F.col(f"f{i}") - float(centre[i + 1])) / float(scale[i + 1])).alias(f"x{i}") for i in range(len(features))],
                _log_factorial(F.col("y")).alias("lf")).write.parquet(folder)
    data = df.sparkSession.read.parquet(folder)  # every round reads it
    y, lf = F.col("y"), F.col("lf")
    x = [F.lit(1.0), *(F.col(f"x{i}") for i in range(len(features)))]
    p = len(x)
    # start: the rate of a Poisson whose positive part has this mean, the zeros it leaves over
    lam = max(stat.m / max(1 - stat.z, 1e-9), 1e-3)
    beta = np.zeros(2 * p)
    beta[0] = math.log(lam)
    pi = min(max((stat.z - math.exp(-lam)) / max(1 - math.exp(-lam), 1e-9), 0.02), 0.98)
    beta[p] = math.log(pi / (1 - pi))

    def curvature(b):
        eta, zeta = F.col("eta"), F.col("zeta")
        lam = F.exp(_bounded(eta))
        tau, pi = 1 / (1 + F.exp(-(zeta + lam))), 1 / (1 + F.exp(-zeta))
        zero = y == 0
        g = {"e": F.when(zero, -lam * (1 - tau)).otherwise(y - lam), "z": F.when(zero, tau - pi).otherwise(-pi)}
        v = tau * (1 - tau)
        h = {"ee": F.when(zero, -lam * (1 - tau) + lam * lam * v).otherwise(-lam), "ez": F.when(zero, lam * v).otherwise(0.0),
             "zz": F.when(zero, v - pi * (1 - pi)).otherwise(-pi * (1 - pi))}
        t = data.withColumns({"eta": _linear(x, b[:p]), "zeta": _linear(x, b[p:])}).withColumns({f"g{k}": c for k, c in g.items()} | {f"h{k}": c for k, c in h.items()})
        t = t.withColumn("ll", _likelihood(y, lf, F.col("eta"), F.col("zeta")))
        pairs = [(i, j) for i in range(p) for j in range(i, p)]
        r = t.agg(F.sum("ll").alias("ll"), *[F.sum(F.col(f"g{k}") * x[i]).alias(f"g{k}{i}") for k in "ez" for i in range(p)],
                  *[F.sum(F.col(f"h{k}") * x[i] * x[j]).alias(f"h{k}{i}_{j}") for k in ("ee", "ez", "zz") for i, j in pairs]).first()
        grad = np.array([r[f"g{k}{i}"] for k in "ez" for i in range(p)])
        hess = np.zeros((2 * p, 2 * p))
        for k, (a, b_) in {"ee": (0, 0), "ez": (0, p), "zz": (p, p)}.items():
            for i, j in pairs:
                v = r[f"h{k}{i}_{j}"]
                for u, w in ((i, j), (j, i)):
                    hess[a + u, b_ + w] = hess[b_ + w, a + u] = v
        return r.ll, grad, hess

    def likelihoods(options):
        r = data.agg(*[F.sum(_likelihood(y, lf, _linear(x, b[:p]), _linear(x, b[p:]))).alias(f"l{k}") for k, b in enumerate(options)]).first()
        return [v if v is not None and math.isfinite(v) else -math.inf for v in r]

    trace: list[float] = []
    ll, grad, hess = curvature(beta)
    for _ in range(max_rounds):
        size = float(np.abs(grad).max()) / stat.n
        if size <= tol:
            break
        # the curvature made definite: directions that bend up are climbed by their gradient
        value, vector = np.linalg.eigh(-hess)
        step = vector @ ((vector.T @ grad) / np.maximum(np.abs(value), 1e-9 * stat.n))
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-300))
        options = [beta + step * 0.5 ** k for k in range(8)]
        found = likelihoods(options)
        k = int(np.argmax(found))
        if found[k] <= ll:
            # at the precision of the sums no step climbs: done if the gradient says so too
            if size <= max(tol, 1e-7):
                break
            raise RuntimeError(f"the fit stands still at a gradient of {size:.3g} a row")
        beta = options[k]
        ll, grad, hess = curvature(beta)
        trace.append(ll)
    else:
        raise RuntimeError(f"no convergence in {max_rounds} rounds: a gradient of {size:.3g} a row")
    trace = trace or [ll]

    def unscaled(b):
        own = b / scale
        own[0] = b[0] - float((b[1:] * centre[1:] / scale[1:]).sum())
        return own.tolist()
    return ZeroInflatedPoisson(list(features), unscaled(beta[:p]), unscaled(beta[p:]), trace, stat.n, size)
