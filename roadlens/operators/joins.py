"""Joins (G1-G8) and the fallback fill (U1). Catalyst/AQE choose the
physical join; an explicit broadcast appears only where the small side has
a size bound that does not grow with the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_equi_join(left: DataFrame, right: DataFrame, on: list[str], fill: dict | None = None) -> DataFrame:
    """G1: left join; absent right values filled (counts -> 0)."""
    j = left.join(right, on, "left")
    return j.na.fill(fill) if fill else j


def left_join_normalised_key(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                             suffixes=("_wz", "_crash")) -> DataFrame:
    """Keys normalised with upper(trim()); clashing column names get the
    suffixes."""
    from ..functions.cleaning import normalise_key
    clash = (set(left.columns) & set(right.columns))
    l2 = left.select(*[F.col(c).alias(c + suffixes[0] if c in clash else c) for c in left.columns])
    r2 = right.select(*[F.col(c).alias(c + suffixes[1] if c in clash else c) for c in right.columns])
    lk = left_key + suffixes[0] if left_key in clash else left_key
    rk = right_key + suffixes[1] if right_key in clash else right_key
    return l2.join(r2, normalise_key(l2[lk]) == normalise_key(r2[rk]), "left")


def dimension_lookup(facts: DataFrame, dim: DataFrame, fact_keys: list[Column], dim_keys: list[str],
                     bounded_dim: bool = False) -> DataFrame:
    """Lookup into a dimension on derived keys (e.g. ``bround(lat, 1)``:
    half-even like pandas). The broadcast hint is given only when the caller
    states that the dimension has a fixed size bound; otherwise AQE decides
    from the measured size."""
    names = [f"_k{i}" for i in range(len(fact_keys))]
    f = facts.withColumns(dict(zip(names, fact_keys)))
    d = dim.withColumnsRenamed(dict(zip(dim_keys, names)))
    d = F.broadcast(d) if bounded_dim else d
    return f.join(d, names, "left").drop(*names)


def aggregate_with_span(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Count plus first/last date in one aggregate (no self-join)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_date"),
                               F.max(ts).alias("last_date"))


#: Levels of day blocks (2^22 days).
LEVELS = 22


def interval_cover(points: DataFrame, point_ts: str, intervals: DataFrame, start: str, end: str, key: str,
                   count: str = "active", first: str = "first") -> DataFrame:
    """G5 without pairs: every row of ``points`` with the number of intervals
    whose days ``[start, end]`` hold its day, and the lowest ``key`` of them
    (0 and null if none). An interval is cut into blocks of 1, 2, 4, ... days
    that lie at multiples of their length: two for each length at most. Blocks
    are summed up; a day looks up the blocks that hold it, one of each length.
    So an interval of n days makes 2 log2(n) rows and a day LEVELS, whatever
    the number of pairs. Null dates are in nothing; intervals that end before
    they start hold nothing."""
    day = lambda c: F.unix_date(F.to_date(c)).cast("long")
    iv = intervals.select(day(start).alias("_s"), (day(end) + 1).alias("_e"), F.col(key).alias("_k")).where("_s < _e")
    blocks = []
    for level in range(LEVELS):
        low, high = -F.shiftright(-F.col("_s"), level), F.shiftright(F.col("_e"), level)
        blocks += [F.when((low < high) & (low % 2 != 0), F.struct(F.lit(level).alias("level"), low.alias("at"))),
                   F.when((low < high) & (high % 2 != 0), F.struct(F.lit(level).alias("level"), (high - 1).alias("at")))]
    held = (iv.select("_k", F.explode(F.array_compact(F.array(*blocks))).alias("b"))
            .groupBy("b.level", "b.at").agg(F.count(F.lit(1)).alias("n"), F.min("_k").alias("k")))
    days = points.select(day(point_ts).alias("_day")).where(F.col("_day").isNotNull()).distinct()
    up = days.select("_day", F.explode(F.array(*[F.struct(F.lit(level).alias("level"), F.shiftright(F.col("_day"), level).alias("at"))
                                                 for level in range(LEVELS)])).alias("b"))
    per_day = (up.select("_day", "b.level", "b.at").join(held, ["level", "at"])
               .groupBy("_day").agg(F.sum("n").alias(count), F.min("k").alias(first)))
    return (points.withColumn("_day", day(point_ts)).join(per_day, "_day", "left").drop("_day")
            .withColumn(count, F.coalesce(count, F.lit(0)).cast("long")))


def range_interval_join(points: DataFrame, point_ts: str, intervals: DataFrame, start: str, end: str,
                        max_span_months: int | None = None) -> DataFrame:
    """``start <= t <= end`` theta join made an equi-join: each interval is
    exploded to the months it touches (a few rows per interval), each point
    carries its month; the equi-join is on the month, the exact range test is
    the residual filter. No nested-loop join."""
    m = lambda c: F.date_trunc("month", F.col(c)).cast("date")
    iv = intervals.withColumn("_month", F.explode(F.sequence(m(start), m(end), F.expr("interval 1 month"))))
    pts = points.withColumn("_month", m(point_ts))
    t = F.col(point_ts).cast("date")
    return pts.join(iv, "_month").where((F.col(start) <= t) & (t <= F.col(end))).drop("_month")


def semi(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """G6."""
    return left.join(right, on, "left_semi")


def anti(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """G6."""
    return left.join(right, on, "left_anti")


def match_report(matched: DataFrame, total_rows: DataFrame, key: str, distance: str) -> DataFrame:
    """Match count, rate, distance mean/median/max, distinct right keys."""
    total = total_rows.select(F.count(F.lit(1))).scalar()
    from .quantiles import quantile
    m = matched.where(F.col(distance).isNotNull())
    return m.agg(F.count(F.lit(1)).alias("matched"), (F.count(F.lit(1)) / total).alias("match_rate"),
                 F.avg(distance).alias("mean_distance"), quantile(m, distance, 0.5).alias("median_distance"),
                 F.max(distance).alias("max_distance"), F.count_distinct(key).alias("distinct_right"))


def fallback_fill(df: DataFrame, value: str, group: str, out: str = "filled",
                  source: str = "source") -> DataFrame:
    """Value -> mean of its group (non-null values) -> global median of
    the non-null values, with a label of the source (Q12: the group column
    is whatever the caller passes). Group means: one row per group, joined."""
    known = df.where(F.col(value).isNotNull())
    gm = known.where(F.col(group).isNotNull()).groupBy(group).agg(F.avg(value).alias("_gm"))
    from .quantiles import quantile
    med = quantile(known, value, 0.5)
    j = df.join(gm, group, "left")
    return (j.withColumn(out, F.coalesce(F.col(value), F.col("_gm"), med))
            .withColumn(source, F.when(F.col(value).isNotNull(), "matched")
                        .when(F.col("_gm").isNotNull(), "county_avg").otherwise("state_median"))
            .drop("_gm"))
