"""Sampling and splitting (N1-N6). Randomness is a deterministic integer mix
of the key, so reruns (and retried tasks after executor loss) give the same
split, and a SQL engine can reproduce it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Multiplicative hash constants (fixed values): a prime below 2^31 and a factor
# below it, so products stay in 64 bits for any key.
MIX_MULT = 1103515245
MIX_MOD = 2147483629


def mix(key: str | Column, salt: int = 0) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    mod = F.lit(MIX_MOD).cast("long")
    return F.pmod((F.pmod(k.cast("long"), mod) + salt) * F.lit(MIX_MULT).cast("long"), mod)


def sample_n(df: DataFrame, key: str, n: int, salt: int = 0) -> DataFrame:
    """Exactly n rows, seeded (order by the mix, then the key)."""
    return df.orderBy(mix(key, salt), F.col(key)).limit(n)


def temporal_split(df: DataFrame, ts: str, ranges: dict[str, tuple]) -> DataFrame:
    """Split label by inclusive ranges; rows outside every range dropped."""
    expr = None
    for name, (lo, hi) in ranges.items():
        cond = F.col(ts).between(F.lit(lo), F.lit(hi))
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return df.withColumn("split", expr).where(F.col("split").isNotNull())


#: Rows of a sub-bucket that ``rank_within`` sorts in one task, about.
BUCKET_ROWS = 100_000


def rank_within(df: DataFrame, strata: list[str], key: str, rows: int | None = None, salt: int = 0) -> DataFrame:
    """Exact 0-based rank of each row inside its stratum in mix order, plus
    the stratum size, without sorting a whole stratum in one task: rows are
    split by mix range into sub-groups (uniform by construction; as many as
    keep one of the whole table at ``BUCKET_ROWS``, 64 at least), sub-group
    sizes get a prefix sum and a window ranks inside each sub-group only.
    ``rows``: the table's size, where it is known (else it is counted)."""
    from pyspark.sql import Window
    buckets = max(64, -(-(df.count() if rows is None else rows) // BUCKET_ROWS))
    m = mix(key, salt)
    t = df.withColumn("_m", m).withColumn("_sb", F.floor(F.col("_m") * buckets / MIX_MOD).cast("int"))
    sizes = t.groupBy(*strata, "_sb").agg(F.count(F.lit(1)).alias("_c"))
    wp = Window.partitionBy(*strata).orderBy("_sb")
    offs = sizes.select(*strata, "_sb", (F.sum("_c").over(wp) - F.col("_c")).alias("_off"),
                        F.sum("_c").over(Window.partitionBy(*strata)).alias("stratum_size"))
    wl = Window.partitionBy(*strata, "_sb").orderBy("_m", key)
    return (t.join(offs, [*strata, "_sb"]).withColumn("rank", F.col("_off") + F.row_number().over(wl) - 1)
            .drop("_m", "_sb", "_off"))


def stratified_split(df: DataFrame, strata: list[str], key: str, fractions=(0.7, 0.15, 0.15), rows: int | None = None) -> DataFrame:
    """70/15/15 inside every stratum (sizes floored, remainder to test)."""
    r = rank_within(df, strata, key, rows)
    n = F.col("stratum_size")
    # exact cut-offs: integer products divided once (no float fraction drift)
    ka, kb = round(fractions[0] * 1_000_000), round((fractions[0] + fractions[1]) * 1_000_000)
    a, b = F.floor(n * ka / 1_000_000), F.floor(n * kb / 1_000_000)
    return r.withColumn("split", F.when(F.col("rank") < a, "train").when(F.col("rank") < b, "val")
                        .otherwise("test")).drop("rank", "stratum_size")


def stratified_kfold(df: DataFrame, label: str, key: str, k: int = 5) -> DataFrame:
    """fold = rank within class mod k."""
    r = rank_within(df, [label], key)
    return r.withColumn("fold", (F.col("rank") % k).cast("int")).drop("rank", "stratum_size")


def group_kfold(df: DataFrame, group: str, k: int = 5, salt: int = 0) -> DataFrame:
    """Whole groups to one fold (fold = mix(group) mod k)."""
    return df.withColumn("fold", (mix(group, salt) % k).cast("int"))


def group_split(df: DataFrame, group: str, test_share: float = 0.2, salt: int = 0) -> DataFrame:
    """Whole groups to train or test by the group's mix."""
    return df.withColumn("split", F.when(mix(group, salt) < int(test_share * MIX_MOD), "test").otherwise("train"))


def permute_labels(df: DataFrame, key: str, label: str, salt: int = 7) -> DataFrame:
    """Pair each row with the label of another row (a fixed permutation
    of the labels): rank rows by key and by mix, join rank to rank. Both ranks
    are computed with range-partitioned prefix offsets; ``key`` must be
    unique."""
    from .ranking import prefix_offsets
    one = df.select(key, label).withColumn("_one", F.lit(1))
    by_key = prefix_offsets(one.select(key, "_one"), key, ["_one"]).select(key, F.col("before__one").alias("_r"))
    mixed = one.withColumn("_m", mix(key, salt))
    by_mix = prefix_offsets(mixed.select("_m", key, label, "_one"), ["_m", key], ["_one"]).select(
        F.col("before__one").alias("_r"), F.col(label).alias("permuted_" + label))
    return df.join(by_key, key).join(by_mix, "_r").drop("_r")
