"""Dedup, rank, top-N, binning by data.

Scale notes: one key may hold a third of all rows, so "first row per key" is
a ``min_by`` aggregate (partial aggregation collapses a hot key on every
mapper) instead of a window that would sort the whole hot key in one task.
Global orders are computed by ``prefix_offsets``: range partitions on the
whole order tuple plus a prefix sum over the (small) partition table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.binning import bin_right_closed


def dedup_keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the row with the smallest ``order`` tuple."""
    rest = [c for c in df.columns if c not in keys]
    ordkey = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), ordkey).alias("_r"))
            .select(*keys, "_r.*"))


def dedup_full(df: DataFrame, features: list[str]) -> DataFrame:
    """Distinct over the feature columns."""
    return df.select(*features).distinct()


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first per key (``count - count distinct``)."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.sum(F.col("_n") - 1).cast("long").alias("duplicates"),
                   F.count(F.lit(1)).alias("distinct_keys"))


def centered_rolling_mean(daily: DataFrame, order: str, value: str, window: int = 30) -> DataFrame:
    """I4: centred rolling mean over a per-period series (one row per date,
    so the global window runs over #periods rows, not #events); null where
    the frame of ``window`` periods is incomplete."""
    lo, hi = -(window // 2), window - 1 - window // 2
    w = Window.orderBy(order).rowsBetween(lo, hi)
    return daily.withColumn("rolling_mean", F.when(F.count(value).over(w) == window, F.avg(value).over(w)))


def group_first(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Per key the first non-null value of each column in ``order``
    (pandas ``groupby.first`` skips nulls column by column)."""
    return df.groupBy(key).agg(*[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
                                 for c in columns])


def top_n(df: DataFrame, measure: str, n: int, tiebreak: list[str]) -> DataFrame:
    """N largest (TakeOrderedAndProject: top-N per partition, then merge)."""
    return df.orderBy(F.desc(measure), *[F.asc(c) for c in tiebreak]).limit(n)


def top_n_or_other(df: DataFrame, column: str, n: int, other: str = "other", out: str | None = None) -> DataFrame:
    """Keep the n most frequent values, the rest become ``other``. The
    top-n table has at most n rows, so its broadcast is bounded."""
    top = (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
           .orderBy(F.desc("_n"), F.asc(column)).limit(n).select(F.col(column).alias("_top")))
    out = out or f"{column}_top{n}"
    j = df.join(F.broadcast(top), F.col(column) == F.col("_top"), "left")
    return j.withColumn(out, F.coalesce(F.col("_top"), F.lit(other))).drop("_top")


def frequency_bucket(df: DataFrame, column: str, large: int = 1000, medium: int = 100,
                     out: str = "size_category") -> DataFrame:
    """I8: category size by frequency; counts come from a groupBy joined back
    (no window over a possibly hot key); a null value counts 0 -> small."""
    cnt = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_cnt"))
    j = df.join(cnt, column, "left")
    n = F.coalesce(F.col("_cnt"), F.lit(0))
    return j.withColumn(out, F.when(n > large, "large").when(n > medium, "medium").otherwise("small")).drop("_cnt")


def prefix_offsets(df: DataFrame, order: str | list[str], sums: list[str], partitions: int | None = None) -> DataFrame:
    """Exclusive running sums of ``sums`` in ``order`` (ascending; the order
    tuple must be unique), computed distributed: rows are range-partitioned
    on the whole order tuple (Spark's sampled range bounds, so even a value
    of the first column holding a third of the rows is split by the next
    column), the partition id is frozen with a reliable checkpoint, the
    per-partition totals (one row per partition) get a prefix sum, and a
    window adds the running sum inside each partition only."""
    from .spatial import _checkpoint
    order = [order] if isinstance(order, str) else list(order)
    n = partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8)
    t = _checkpoint(df.repartitionByRange(n, *order).withColumn("_b", F.spark_partition_id()))
    tot = t.groupBy("_b").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    wb = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("_b", *[F.coalesce(F.sum(f"_t_{c}").over(wb), F.lit(0)).alias(f"_o_{c}") for c in sums])
    wl = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    j = t.join(F.broadcast(off), "_b")
    return j.select(*df.columns, *[(F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(wl), F.lit(0))).alias(f"before_{c}")
                                   for c in sums])


def temporal_order_split(df: DataFrame, order: str | list[str], train_frac: float = 0.8) -> DataFrame:
    """First ``train_frac`` of the rows by a unique order key -> train.
    Only the keys are ranked; the first key of the test rows is read and
    every row compared with it."""
    order = [order] if isinstance(order, str) else list(order)
    ranked = prefix_offsets(df.select(*order, F.lit(1).alias("_one")), order, ["_one"])
    first = ranked.where(F.col("before__one") == F.floor(df.select(F.count(F.lit(1))).scalar() * train_frac)).select(*order).first()
    if first is None:  # no rows, or all of them train
        return df.withColumn("split", F.lit("train"))
    types = df.select(*order).schema
    cut = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(first, types.fields, strict=True)])
    return df.withColumn("split", F.when(F.struct(*order) < cut, "train").otherwise("test"))


def equal_width_edges(df: DataFrame, column: str, k: int) -> list[Column]:
    lo = df.select(F.min(column)).scalar()
    hi = df.select(F.max(column)).scalar()
    return [lo + (hi - lo) * j / k for j in range(k + 1)]


def bin_equal_width(df: DataFrame, column: str, k: int, out: str = "bin") -> DataFrame:
    """L2: k equal-width right-closed bins over min..max; the first bin also
    takes the minimum (pandas widens the first edge by 0.1 % of the range)."""
    e = equal_width_edges(df, column, k)
    x = F.col(column)
    idx = sum((F.when(x > e[j], 1).otherwise(0) for j in range(1, k)), F.lit(0))
    return df.withColumn(out, F.when(x.isNull() | F.isnan(x), F.lit(None)).otherwise(idx))


def quantile_edges(df: DataFrame, column: str, q: int) -> Column:
    """Sorted distinct quantile edges (exact and linearly interpolated)."""
    from .quantiles import quantile
    probs = [j / q for j in range(q + 1)]
    return F.sort_array(F.array_distinct(quantile(df, column, probs)))


def bin_quantile(df: DataFrame, column: str, q: int, out: str = "bin", edges: Column | None = None) -> DataFrame:
    """L3: ``qcut(q, duplicates='drop')``: bin i = (e_i, e_{i+1}], the first
    bin includes its lower edge; equal values always share a bin. The bin is
    the number of inner edges below x (edges 1 .. size-2 of the distinct
    sorted edge array). ``edges`` takes the ``quantile_edges`` of another table."""
    x = F.col(column)
    e = quantile_edges(df, column, q) if edges is None else edges
    idx = sum((F.when((F.lit(j) < F.size(e) - 1) & (x > F.get(e, j)), 1).otherwise(0) for j in range(1, q)),
              F.lit(0))
    return df.withColumn(out, F.when(x.isNull(), F.lit(None)).otherwise(idx))


def quantile_flag(df: DataFrame, column: str, q: float, out: str = "flag") -> DataFrame:
    """L4: ``x >= quantile(x, q)``."""
    from .quantiles import quantile
    t = quantile(df, column, q)
    return df.withColumn(out, F.coalesce(F.col(column) >= t, F.lit(False)).cast("int"))


def dense_codes(df: DataFrame, column: str, out: str, partitions: int | None = None) -> DataFrame:
    """Alphabetical 0-based code of every distinct value of ``column`` for any
    orderable type, distributed: distinct values are range-partitioned
    (partition k holds only values below partition k+1), the partition id
    is frozen by a reliable checkpoint, per-partition counts (<= partitions
    rows) get a prefix sum, and the window ranks inside one partition only."""
    from .spatial import _checkpoint
    partitions = partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8)
    vals = df.select(column).where(F.col(column).isNotNull()).distinct()
    ranged = _checkpoint(vals.repartitionByRange(partitions, column).withColumn("_pid", F.spark_partition_id()))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    wo = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_pid", F.coalesce(F.sum("_n").over(wo), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_pid").orderBy(column)
    return (ranged.join(F.broadcast(offs), "_pid")
            .select(column, (F.col("_off") + F.row_number().over(w) - 1).cast("int").alias(out)))


__all__ = ["bin_right_closed", "dedup_keep_first", "dedup_full", "duplicate_count", "centered_rolling_mean",
           "group_first", "top_n", "top_n_or_other", "frequency_bucket", "prefix_offsets",
           "temporal_order_split", "bin_equal_width", "bin_quantile", "quantile_flag"]
