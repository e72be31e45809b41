"""Aggregations (H1-H25). All are ``groupBy().agg()`` with map-side partial
aggregation; global statistics are scalar subqueries (computed once, used as
a literal), never a cross join or a collect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles, quantile


def rate_by_group(df: DataFrame, key: str | list[str], target: str, rate: str = "rate",
                  n: str = "n") -> DataFrame:
    """H5: mean of a 0/1 target and the row count per key; null keys are
    dropped first like pandas ``groupby`` (Q23)."""
    keys = [key] if isinstance(key, str) else list(key)
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.where(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias(n), F.avg(target).alias(rate))


def _nonnull(df: DataFrame, keys: list[str]) -> DataFrame:
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.where(cond) if cond is not None else df


def crashes_per_segment(pairs: DataFrame, key: str, target: str) -> DataFrame:
    """H1: crash count and high-severity count per segment."""
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias("crash_count"),
                                  F.sum(target).cast("long").alias("high_severity_count"))


def workzone_features(df: DataFrame, zone: str, count_col: str, mean_cols: dict[str, str],
                      meta_cols: list[str], order_col: str, q: float = 0.75) -> DataFrame:
    """H2: count + means per zone, the first meta row per zone (by an explicit
    order column, via ``min_by`` so a hot zone is reduced map-side), and
    ``high_risk = count >= quantile(count, q)`` over the (one row per zone)
    result."""
    meta = F.min_by(F.struct(*[F.col(c) for c in meta_cols]), F.col(order_col)).alias("_meta")
    aggs = [F.count(count_col).alias("crash_count")] + [F.avg(src).alias(dst) for src, dst in mean_cols.items()]
    per = df.groupBy(zone).agg(meta, *aggs).select(zone, "_meta.*", *[a for a in ["crash_count", *mean_cols.values()]])
    q75 = quantile(per, "crash_count", q)
    return per.withColumn("high_risk", (F.col("crash_count") >= q75).cast("int"))


def value_counts(df: DataFrame, column: str, name: str = "value") -> DataFrame:
    """H8: count and percent per non-null value; the total is a scalar
    subquery, so no single-partition window over the groups."""
    base = df.where(F.col(column).isNotNull())
    total = base.select(F.count(F.lit(1))).scalar()
    return (base.groupBy(F.col(column).alias(name)).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("pct", F.col("n") * 100.0 / total))


def multi_value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """H9: value counts of many columns at once in long form: one unpivot,
    one ``groupBy(column, value)``; per-column totals (one row per column, a
    plan-time bound) are joined back."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], columns, "column", "value").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("column").agg(F.sum("n").alias("_total"))
    return (counts.join(F.broadcast(totals), "column")
            .select("column", "value", "n", (F.col("n") * 100.0 / F.col("_total")).alias("pct")))


def crosstab(df: DataFrame, row: str, col: str, values: list) -> DataFrame:
    """Counts of ``row`` x ``col`` with ``col`` values as columns; the
    value list is explicit so pivot needs no extra distinct job."""
    return df.groupBy(row).pivot(col, values).count().na.fill(0)


def resample_counts(df: DataFrame, ts: str, unit: str = "day") -> DataFrame:
    """Rows per period, empty periods = 0. The calendar is generated from
    the one-row min/max aggregate (its size is the number of periods, not the
    number of rows) and left-joined to the per-period counts."""
    p = F.date_trunc(unit, F.col(ts)).cast("date")
    counts = df.where(F.col(ts).isNotNull()).groupBy(p.alias("period")).agg(F.count(F.lit(1)).alias("n"))
    step = {"day": "1 day", "week": "7 days", "month": "1 month", "year": "1 year"}[unit]
    cal = counts.agg(F.min("period").alias("lo"), F.max("period").alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr(f"interval {step}"))).alias("period"))
    return cal.join(counts, "period", "left").select("period", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max and zero share per
    column in long form: one aggregate, and the exact quartiles of all columns
    together, joined (a row per column)."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs.append(F.struct(
            F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
            (F.count_if(x == 0) / F.count(F.lit(1))).alias("zero_share")).alias(c))
    one = df.agg(*aggs)
    at = lambda p: F.max(F.when(F.col("p") == p, F.col("value")))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).groupBy("column").agg(
        at(0.25).alias("p25"), at(0.5).alias("p50"), at(0.75).alias("p75"))
    long = one.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("s")).select("s.*")
    return long.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max", "zero_share")


def correlation_long(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise Pearson correlation (pairwise-complete rows), all pairs
    in one aggregate, long form."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    return one.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                                                    F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs]))
                      .alias("s")).select("s.*")


def target_correlation(df: DataFrame, columns: list[str], target: str, top_n: int) -> DataFrame:
    """H15 + H16: correlation of each feature with a 0/1 target, the
    point-biserial t statistic and its two-sided p-value, ranked by |r|, top N."""
    from ..functions.stats import correlation_p_value
    structs = []
    for c in columns:
        x, y = F.col(c).cast("double"), F.col(target).cast("double")
        n = F.count(F.when(x.isNotNull() & y.isNotNull(), 1))
        structs.append(F.struct(F.lit(c).alias("feature"), F.corr(x, y).alias("r"), n.alias("n")))
    one = df.agg(*[s.alias(f"s{i}") for i, s in enumerate(structs)])
    long = one.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(columns))])).alias("s")).select("s.*")
    t = F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("r") * F.col("r")))
    return (long.withColumn("abs_r", F.abs("r")).withColumns({"t": t, "p_value": correlation_p_value(F.col("r"), F.col("n"))})
            .orderBy(F.desc("abs_r"), F.asc("feature")).limit(top_n))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal bins between min and max (scalar subqueries); the last bin
    is closed."""
    x = F.col(column)
    base = df.where(x.isNotNull())
    lo = base.select(F.min(x)).scalar()
    hi = base.select(F.max(x)).scalar()
    width = (hi - lo) / bins
    b = F.when(width == 0, 0).otherwise(F.least(F.floor((x - lo) / width), F.lit(bins - 1)))
    return base.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")).withColumns(
        {"lo": lo + F.col("bin") * width, "hi": lo + (F.col("bin") + 1) * width})


def box_stats(df: DataFrame, group: str, column: str) -> DataFrame:
    """Exact quartiles per category, 1.5 IQR whiskers, outlier count (a
    last pass joined on the per-category quartile table)."""
    x = F.col(column)
    base = df.where(F.col(group).isNotNull() & x.isNotNull())
    at = lambda p: F.max(F.when(F.col("p") == p, F.col("value")))
    q = exact_quantiles(base, [column], [0.25, 0.5, 0.75], [group]).groupBy(group).agg(
        at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    q = q.withColumns({"lower_fence": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
                       "upper_fence": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))})
    out = (base.join(q, group).groupBy(group).agg(
        F.count_if((x < F.col("lower_fence")) | (x > F.col("upper_fence"))).alias("outliers")))
    return q.join(out, group)


def distinct_count(df: DataFrame, columns: list[str], approx_rsd: float | None = None) -> DataFrame:
    """Distinct values per column in one aggregate; exact by default,
    ``approx_rsd`` switches to the HyperLogLog++ sketch for huge columns."""
    f = (lambda c: F.count_distinct(c)) if approx_rsd is None else (lambda c: F.approx_count_distinct(c, approx_rsd))
    return df.agg(*[f(c).alias(c) for c in columns])


def mode_value(df: DataFrame, column: str) -> DataFrame:
    """Most frequent value, ties -> smallest value. ``groupBy`` then a
    top-1 (TakeOrdered keeps one row per partition)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(column)).limit(1))


def county_stats(crashes: DataFrame, county: str = "county", ts: str = "start_time",
                 severity: str = "severity", injury_min: int = 2, fatal: int = 4) -> DataFrame:
    """H4 + G4: totals, injury/fatal counts, rates, average severity,
    first/last date, whole days covered and crashes per day, all in one
    ``groupBy().agg()``; a zero-day span gives a null rate (Q14)."""
    from ..functions.temporal import duration_days
    s = F.col(severity)
    g = crashes.where(F.col(county).isNotNull()).groupBy(county).agg(
        F.count(F.lit(1)).alias("total_crashes"),
        F.sum(F.when(s >= injury_min, 1).otherwise(0)).cast("long").alias("injury_crashes"),
        F.sum(F.when(s == fatal, 1).otherwise(0)).cast("long").alias("fatal_crashes"),
        F.avg(s).alias("avg_severity"),
        F.avg(F.when(s >= injury_min, 1.0).otherwise(0.0)).alias("injury_rate"),
        F.min(ts).alias("first_crash_date"), F.max(ts).alias("last_crash_date"))
    g = g.withColumn("days_covered", duration_days("last_crash_date", "first_crash_date"))
    return g.withColumn("crashes_per_day", F.try_divide(F.col("total_crashes"), F.nullif(F.col("days_covered"), F.lit(0))))
