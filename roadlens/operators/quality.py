"""Data-quality and validation (M1-M10). Each report is one aggregate over
the table (all checks evaluated in the same scan) turned to long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def validate(df: DataFrame, checks: list[tuple[str, str, Column]], unique: list[str] = ()) -> DataFrame:
    """M1: every failing check is reported (lazy validation): ``(column,
    check, failures, sample)`` where a check fails on rows where its
    condition is false (null counts as failure only if the check says so),
    plus uniqueness of ``unique`` columns via ``groupBy().having``."""
    aggs = []
    for i, (col, name, ok) in enumerate(checks):
        bad = ~F.coalesce(ok, F.lit(True))
        aggs.append(F.struct(F.lit(col).alias("column"), F.lit(name).alias("check"),
                             F.count_if(bad).alias("failures"),
                             F.min(F.when(bad, F.col(col).cast("string"))).alias("sample")).alias(f"c{i}"))
    one = df.agg(*aggs)
    out = one.select(F.explode(F.array(*[F.col(f"c{i}") for i in range(len(checks))])).alias("r")).select("r.*")
    for u in unique:
        d = (df.groupBy(u).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
             .agg(F.sum(F.col("_n") - 1).alias("failures"), F.min(F.col(u).cast("string")).alias("sample")))
        out = out.unionByName(d.select(F.lit(u).alias("column"), F.lit("unique").alias("check"),
                                       F.coalesce("failures", F.lit(0)).cast("long").alias("failures"), "sample"))
    return out


def missing_profile(df: DataFrame, columns: list[str] | None = None, alert: float = 50.0) -> DataFrame:
    """M4: null count and percent per column (NaN counts as missing for
    floating columns), with an alert flag above ``alert`` percent."""
    cols = columns or df.columns
    dtypes = dict(df.dtypes)
    def miss(c):
        x = F.col(c)
        return x.isNull() | F.isnan(x) if dtypes[c] in ("double", "float") else x.isNull()
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(miss(c)).alias(c) for c in cols])
    long = one.unpivot(["_rows"], cols, "column", "missing")
    pct = F.col("missing") * 100.0 / F.col("_rows")
    return long.select("column", "missing", pct.alias("pct"), (pct > alert).cast("int").alias("alert"))


def missing_grade(pct: Column) -> Column:
    """M4: severity grade of a missing share: > 95 % critical, > 80 % high,
    > 50 % medium, else low."""
    return (F.when(pct > 95, "critical").when(pct > 80, "high").when(pct > 50, "medium").otherwise("low"))


def completeness_by_family(profile: DataFrame, families: dict[str, list[str]]) -> DataFrame:
    """M5: mean non-null share per column family (the family of a column is
    a plan-time CASE over its name)."""
    fam = None
    for name, members in families.items():
        cond = F.col("column").isin(*members)
        fam = F.when(cond, name) if fam is None else fam.when(cond, name)
    return (profile.withColumn("family", fam.otherwise("other"))
            .groupBy("family").agg(F.avg(100.0 - F.col("pct")).alias("completeness_pct"),
                                   F.count(F.lit(1)).alias("columns")))


def class_balance(df: DataFrame, target: str, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """M6: share per class with an imbalance alert (share < 5 % or > 95 %)."""
    n = df.select(F.count(F.lit(1))).scalar()
    g = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / n
    return g.select(target, "n", share.alias("share"), ((share < low) | (share > high)).cast("int").alias("alert"))


def zero_share_alert(df: DataFrame, column: str, limit: float = 0.9) -> DataFrame:
    """M6: share of zeros in a count column, alert above 90 %."""
    return df.agg(F.avg(F.when(F.col(column) == 0, 1.0).otherwise(0.0)).alias("zero_share")) \
        .withColumn("alert", (F.col("zero_share") > limit).cast("int"))


def compare_splits(df: DataFrame, split: str, target: str, drift: float = 0.05) -> DataFrame:
    """M7: size and target rate per split, largest rate difference over all
    splits, drift flag above 5 points (the per-split table has one row per
    split, so its global window is tiny)."""
    from pyspark.sql import Window
    g = df.groupBy(split).agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("rate"))
    w = Window.partitionBy()
    spread = F.max("rate").over(w) - F.min("rate").over(w)
    return g.withColumn("max_rate_diff", spread).withColumn("drift", (F.col("max_rate_diff") > drift).cast("int"))


def percentile_outliers(df: DataFrame, columns: list[str], lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """M8: rows outside [p1, p99] per column: the exact percentiles of all
    columns together (a row per column and percentile), then one aggregate."""
    from .quantiles import exact_quantiles
    edge = {(r["column"], r.p): r.value for r in exact_quantiles(df, columns, [lo, hi]).collect()}
    ends = {c: (F.lit(edge.get((c, lo))).cast("double"), F.lit(edge.get((c, hi))).cast("double")) for c in columns}
    one = df.agg(*[F.struct(F.lit(c).alias("column"), a.alias("p_lo"), b.alias("p_hi"),
                            F.count_if((F.col(c) < a) | (F.col(c) > b)).alias("outliers")).alias(c) for c, (a, b) in ends.items()])
    return one.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("s")).select("s.*")


def low_variance_columns(df: DataFrame, columns: list[str], limit: float = 0.01) -> DataFrame:
    """M9: sample variance per column; flag below ``limit``."""
    one = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(c) for c in columns])
    long = one.unpivot([], columns, "column", "variance")
    return long.withColumn("low_variance", (F.col("variance") < limit).cast("int"))


def before_after_report(before: DataFrame, after: DataFrame, key_cols: list[str], numeric: list[str],
                        limit: float = 0.01) -> DataFrame:
    """Rows, duplicate rows and low-variance column counts before and
    after cleaning: the union of two one-row aggregates."""
    def stats(df, stage):
        dup = df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_n")).agg(
            F.sum(F.col("_n") - 1).cast("long").alias("duplicates"))
        lv = low_variance_columns(df, numeric, limit).agg(F.sum("low_variance").cast("long").alias("low_variance_cols"))
        return df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(stage).alias("stage"), "rows", dup.select("duplicates").scalar().alias("duplicates"),
            lv.select("low_variance_cols").scalar().alias("low_variance_cols"))
    return stats(before, "before").unionByName(stats(after, "after"))


def source_profile(df: DataFrame, required: list[str], recommended: list[str] = ()) -> DataFrame:
    """Required / recommended columns present (plan-time metadata), the
    row count and distinct count of each present column, in one aggregate."""
    present = [c for c in [*required, *recommended] if c in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_distinct(c).alias(c) for c in present])
    rows = []
    for c in [*required, *recommended]:
        kind = "required" if c in required else "recommended"
        if c in df.columns:
            rows.append(F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.lit(1).alias("present"),
                                 F.col("_rows").alias("rows"), F.col(c).alias("distinct")))
        else:
            rows.append(F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.lit(0).alias("present"),
                                 F.col("_rows").alias("rows"), F.lit(None).cast("long").alias("distinct")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
