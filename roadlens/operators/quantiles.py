"""Exact quantiles of large tables, global and per group, many at once.

No value set meets in one task. A mergeable sketch brackets each wanted rank by
two values; the rows below a bracket are counted exactly and only the rows in
it are kept, equal values as one row with a count. Whether the rank does lie in
its bracket is known from these counts; if a sketch was off, the bracket is
widened and counted again, up to the whole range. The few values left (about
six in ten thousand rows a quantile) are ranked by running sums over range
partitions, so their number has no bound either.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Relative rank error of the sketch is 1 / SKETCH; a bracket spans 2 * MARGIN of it.
SKETCH, MARGIN = 10_000, 3
#: Up to so many bracketed values are ranked by a window per quantile.
FEW = 100_000


def _written(df: DataFrame) -> DataFrame:
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/quantiles-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], by: list[str] = ()) -> DataFrame:
    """``by..., column, p, value``: the linearly interpolated quantiles of each
    numeric column, per group of the ``by`` columns (null keys are left out).
    Null and NaN values do not count; a group without values has no row."""
    by, probs = list(by), [float(p) for p in probs]
    wide = df.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)])
    keys = [f"_g{i}" for i in range(len(by))]
    for k in keys:
        wide = wide.where(F.col(k).isNotNull())
    rows = (wide.select(*keys, F.explode(F.array(*[F.struct(F.lit(i).alias("_c"), F.col(f"_x{i}").alias("_x")) for i in range(len(columns))])).alias("_v"))
            .select(*keys, "_v._c", "_v._x").where(F.col("_x").isNotNull() & ~F.isnan("_x")))
    rows = _written(rows)  # narrow, and whatever it takes to make ``df`` is done once
    keys = [*keys, "_c"]
    rank = (F.col("_n") - 1) * F.col("_p")
    found, margin = [], MARGIN / SKETCH
    while True:
        ends = [min(max(p + s * margin, 0.0), 1.0) for p in probs for s in (-1, 1)]
        sketch = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"),
                                         F.percentile_approx("_x", ends, SKETCH).alias("_e"))
        targets = _written(sketch.select(*keys, "_n", F.array(*[F.struct(
            F.lit(t).alias("_t"), (F.col("_lo") if ends[2 * t] <= 0 else F.get("_e", F.lit(2 * t))).alias("a"),
            (F.col("_hi") if ends[2 * t + 1] >= 1 else F.get("_e", F.lit(2 * t + 1))).alias("b")) for t in range(len(probs))]).alias("_s")))
        # one row per column where there are no groups; else Spark decides by size
        met = rows.join(F.broadcast(targets) if not by else targets, keys)
        below = met.groupBy(*keys).agg(*[F.count_if(F.col("_x") < F.get("_s", F.lit(t))["a"]).alias(f"_b{t}") for t in range(len(probs))])
        inside = lambda s: (F.col("_x") >= s["a"]) & (F.col("_x") <= s["b"])
        kept = _written(met.where(F.exists("_s", inside)).select(*keys, "_x", F.explode(F.filter("_s", inside)).alias("_s"))
                        .groupBy(*keys, F.col("_s._t").alias("_t"), "_x").agg(F.count(F.lit(1)).alias("_w")))
        state = (targets.join(below, keys).select(*keys, "_n", F.explode(F.array(*[F.struct(
            F.lit(t).alias("_t"), F.lit(p).alias("_p"), F.col(f"_b{t}").alias("_below")) for t, p in enumerate(probs)])).alias("_q"))
            .select(*keys, "_n", "_q.*").withColumns({"_k0": F.floor(rank), "_k1": F.ceil(rank)})
            .join(kept.groupBy(*keys, "_t").agg(F.sum("_w").alias("_in")), [*keys, "_t"], "left"))
        state = _written(state.withColumn("_ok", (F.col("_below") <= F.col("_k0")) & (F.col("_k1") < F.col("_below") + F.coalesce("_in", F.lit(0)))))
        found.append(_pick(kept, state.where("_ok"), keys))
        missed = state.where("not _ok").select(*keys).distinct()
        if margin >= 1 or missed.isEmpty():
            break
        # only groups with a missed rank are looked at again
        rows, margin = _written(rows.join(missed, keys, "left_semi")), margin * 100
    out = found[0]
    if len(found) > 1:
        for more in found[1:]:
            out = out.unionByName(more)
        out = out.dropDuplicates([*keys, "_t"])
    return out.select(*[F.col(f"_g{i}").alias(c) for i, c in enumerate(by)],
                      F.element_at(F.array(*map(F.lit, columns)), F.col("_c") + 1).alias("column"), F.col("_p").alias("p"), F.col("_v").alias("value"))


def _pick(kept: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """The values at the ranks of ``state``, interpolated."""
    group = [*keys, "_t"]
    if kept.count() <= FEW:
        w = Window.partitionBy(*group).orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
        ranked = kept.withColumn("_before", F.coalesce(F.sum("_w").over(w), F.lit(0)))
    else:
        from .ranking import prefix_offsets
        summed = prefix_offsets(kept, [*group, "_x"], ["_w"])
        first = summed.groupBy(*group).agg(F.min("before__w").alias("_first"))
        ranked = summed.join(first, group).withColumn("_before", F.col("before__w") - F.col("_first"))
    at = ranked.join(state, group).withColumn("_r", F.col("_below") + F.col("_before"))
    holds = lambda k: F.max(F.when((F.col("_r") <= F.col(k)) & (F.col(k) < F.col("_r") + F.col("_w")), F.col("_x")))
    got = at.groupBy(*group, "_n", "_p", "_k0", "_k1").agg(holds("_k0").alias("_v0"), holds("_k1").alias("_v1"))
    rank = (F.col("_n") - 1) * F.col("_p")
    value = F.when((F.col("_k0") == F.col("_k1")) | (F.col("_v0") == F.col("_v1")), F.col("_v0")).otherwise(
        (F.col("_k1") - rank) * F.col("_v0") + (rank - F.col("_k0")) * F.col("_v1"))
    return got.withColumn("_v", value).select(*group, "_p", "_v")


def quantile(df: DataFrame, column: str | Column, p: float | list[float]) -> Column:
    """One quantile of a column as a literal, or several as a literal array;
    null where the column has no values."""
    probs = list(p) if isinstance(p, (list, tuple)) else [p]
    rows = exact_quantiles(df.select((F.col(column) if isinstance(column, str) else column).alias("x")), ["x"], probs).collect()  # a row per p
    value = {r.p: r.value for r in rows}
    if isinstance(p, (list, tuple)):
        return F.array(*[F.lit(value[float(q)]).cast("double") for q in probs]) if value else F.lit(None).cast("array<double>")
    return F.lit(value.get(float(p))).cast("double")


def medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """The median of each column (a row per column reaches the driver)."""
    found = {r["column"]: r.value for r in exact_quantiles(df, columns, [0.5]).collect()} if columns else {}
    return {c: found.get(c) for c in columns}
