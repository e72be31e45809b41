"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import testviews as V
from ..operators import quality as M
from ..operators.ranking import dedup_full
from .base import query, r6
from .groups import CF_SQL, cf

CRASH_CHECKS_SQL = """
SELECT 'severity' AS "column", 'in_range_1_4' AS "check", CAST(count(*) FILTER (WHERE NOT coalesce(severity BETWEEN 1 AND 4, true)) AS BIGINT) AS failures,
       min(CASE WHEN NOT coalesce(severity BETWEEN 1 AND 4, true) THEN CAST(severity AS VARCHAR) END) AS sample FROM crashes
UNION ALL
SELECT 'temperature_f', 'in_range_0_100', CAST(count(*) FILTER (WHERE NOT coalesce(temperature_f BETWEEN 0 AND 100, true)) AS BIGINT),
       min(CASE WHEN NOT coalesce(temperature_f BETWEEN 0 AND 100, true) THEN CAST(temperature_f AS VARCHAR) END) FROM crashes
UNION ALL
SELECT 'visibility_mi', 'not_null', CAST(count(*) FILTER (WHERE visibility_mi IS NULL) AS BIGINT), NULL FROM crashes
UNION ALL
SELECT 'city', 'member', CAST(count(*) FILTER (WHERE NOT coalesce(city IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY'), true)) AS BIGINT),
       min(CASE WHEN NOT coalesce(city IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY'), true) THEN city END) FROM crashes
UNION ALL
SELECT 'county', 'unique', CAST(coalesce(sum(n - 1), 0) AS BIGINT), min(county) FROM (
  SELECT county, count(*) AS n FROM crashes GROUP BY county HAVING count(*) > 1)"""


def crash_checks():
    return [("severity", "in_range_1_4", F.col("severity").between(1, 4)),
            ("temperature_f", "in_range_0_100", F.col("temperature_f").between(0, 100)),
            ("visibility_mi", "not_null", F.col("visibility_mi").isNotNull()),
            ("city", "member", F.col("city").isin("AUTOMOBILE", "BUILDING", "MACHINERY"))]


@query("validate_schema", CRASH_CHECKS_SQL, ("crashes",))
def validate_schema(spark, d):
    """M1: range, nullability, membership and uniqueness checks, all failures
    reported with a sample value."""
    return M.validate(V.crashes(spark, d), crash_checks(), unique=["county"])


MISSING_COLS = ["weather_condition", "temperature_f", "visibility_mi", "junction", "county", "lat"]


def _missing_sql():
    parts = []
    for c in MISSING_COLS:
        miss = f"{c} IS NULL" + (f" OR isnan({c})" if c in ("temperature_f", "visibility_mi", "lat") else "")
        parts.append(f"""SELECT '{c}' AS "column", CAST(count(*) FILTER (WHERE {miss}) AS BIGINT) AS missing,
  round_even(count(*) FILTER (WHERE {miss}) * 100.0 / count(*), 6) AS pct,
  CAST(count(*) FILTER (WHERE {miss}) * 100.0 / count(*) > 50 AS INTEGER) AS alert FROM crashes""")
    return " UNION ALL ".join(parts)


@query("missing_profile", f"""SELECT *, CASE WHEN pct > 95 THEN 'critical' WHEN pct > 80 THEN 'high' WHEN pct > 50 THEN 'medium'
ELSE 'low' END AS grade FROM ({_missing_sql()})""", ("crashes",))
def missing_profile(spark, d):
    """M4: missing count, percent, > 50 % alert and severity grade."""
    m = M.missing_profile(V.crashes(spark, d), MISSING_COLS)
    return m.select("column", "missing", r6("pct").alias("pct"), "alert", M.missing_grade(F.col("pct")).alias("grade"))


FAMILIES = {"weather": ["weather_condition", "temperature_f", "visibility_mi"], "location": ["county", "lat"]}


@query("completeness_by_family", f"""
WITH m AS ({_missing_sql()})
SELECT CASE WHEN "column" IN ('weather_condition', 'temperature_f', 'visibility_mi') THEN 'weather'
            WHEN "column" IN ('county', 'lat') THEN 'location' ELSE 'other' END AS family,
       round_even(avg(100.0 - pct), 6) AS completeness_pct, CAST(count(*) AS BIGINT) AS columns FROM m GROUP BY 1""",
       ("crashes",))
def completeness_by_family(spark, d):
    """M5 (pct already rounded like the oracle's profile)."""
    m = M.missing_profile(V.crashes(spark, d), MISSING_COLS).withColumn("pct", r6("pct"))
    c = M.completeness_by_family(m, FAMILIES)
    return c.select("family", r6("completeness_pct").alias("completeness_pct"), "columns")


@query("class_balance", f"""WITH cf AS ({CF_SQL})
SELECT high_severity, CAST(count(*) AS BIGINT) AS n, round_even(count(*) / (SELECT count(*) FROM cf), 6) AS share,
       CAST(count(*) / (SELECT count(*) FROM cf) < 0.05 OR count(*) / (SELECT count(*) FROM cf) > 0.95 AS INTEGER) AS alert
FROM cf GROUP BY high_severity""", ("crashes",))
def class_balance(spark, d):
    """M6."""
    b = M.class_balance(cf(spark, d), "high_severity")
    return b.select("high_severity", "n", r6("share").alias("share"), "alert")


@query("zero_share_alert", """
SELECT round_even(avg(CASE WHEN y = 0 THEN 1.0 ELSE 0.0 END), 6) AS zero_share,
       CAST(avg(CASE WHEN y = 0 THEN 1.0 ELSE 0.0 END) > 0.9 AS INTEGER) AS alert FROM counts""", ("counts",))
def zero_share_alert(spark, d):
    """M6: zero-inflation alert on segment crash counts."""
    z = M.zero_share_alert(V.counts(spark, d), "y")
    return z.select(r6("zero_share").alias("zero_share"), "alert")


SPLIT_SQL = f"""WITH cf AS ({CF_SQL}),
s AS (SELECT *, CASE WHEN year <= 1997 THEN 'train' WHEN year = 1998 THEN 'val' ELSE 'test' END AS split FROM cf)"""


@query("compare_splits", SPLIT_SQL + """,
g AS (SELECT split, count(*) AS n, avg(high_severity) AS rate FROM s GROUP BY split)
SELECT split, CAST(n AS BIGINT) AS n, round_even(rate, 6) AS rate, round_even(max(rate) OVER () - min(rate) OVER (), 6) AS max_rate_diff,
       CAST(max(rate) OVER () - min(rate) OVER () > 0.05 AS INTEGER) AS drift FROM g""", ("crashes",))
def compare_splits(spark, d):
    """M7."""
    s = cf(spark, d).withColumn("split", F.when(F.col("year") <= 1997, "train").when(F.col("year") == 1998, "val")
                                .otherwise("test"))
    c = M.compare_splits(s, "split", "high_severity")
    return c.select("split", "n", r6("rate").alias("rate"), r6("max_rate_diff").alias("max_rate_diff"), "drift")


@query("percentile_outliers", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", round_even(quantile_cont({c}, 0.01), 6) AS p_lo, round_even(quantile_cont({c}, 0.99), 6) AS p_hi,
       CAST((SELECT count(*) FROM crashes WHERE {c} < (SELECT quantile_cont({c}, 0.01) FROM crashes)
             OR {c} > (SELECT quantile_cont({c}, 0.99) FROM crashes)) AS BIGINT) AS outliers FROM crashes"""
                                                 for c in ("temperature_f", "x")), ("crashes",))
def percentile_outliers(spark, d):
    """M8."""
    o = M.percentile_outliers(V.crashes(spark, d), ["temperature_f", "x"])
    return o.select("column", r6("p_lo").alias("p_lo"), r6("p_hi").alias("p_hi"), "outliers")


LV_COLS = ["severity", "distance_km", "precip_in", "visibility_mi"]


@query("low_variance_columns", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round_even(var_samp({c}), 6) AS variance, CAST(var_samp({c}) < 0.01 AS INTEGER) AS low_variance
FROM wzcrash""" for c in LV_COLS), ("wzcrash",))
def low_variance_columns(spark, d):
    """M9."""
    lv = M.low_variance_columns(V.wzcrash(spark, d), LV_COLS)
    return lv.select("column", r6("variance").alias("variance"), "low_variance")


@query("before_after_report", """
WITH b AS (SELECT severity, road_name, vehicle_impact, wind_mph, precip_in FROM wzcrash),
a AS (SELECT DISTINCT * FROM b),
st AS (SELECT 'before' AS stage, * FROM b UNION ALL SELECT 'after', * FROM a)
SELECT stage, CAST(count(*) AS BIGINT) AS rows,
       CAST(count(*) - count(DISTINCT (severity, road_name, vehicle_impact, wind_mph)) AS BIGINT) AS duplicates,
       CAST((var_samp(severity) < 0.01)::INT + (var_samp(wind_mph) < 0.01)::INT + (var_samp(precip_in) < 0.01)::INT AS BIGINT) AS low_variance_cols
FROM st GROUP BY stage""", ("wzcrash",))
def before_after_report(spark, d):
    """Rows, duplicate keys and low-variance columns before and after
    removing duplicate feature rows (I2)."""
    cols = ["severity", "road_name", "vehicle_impact", "wind_mph", "precip_in"]
    before = V.wzcrash(spark, d).select(*cols)
    after = dedup_full(before, cols)
    return M.before_after_report(before, after, ["severity", "road_name", "vehicle_impact", "wind_mph"],
                                 ["severity", "wind_mph", "precip_in"])


@query("source_profile", """
SELECT 'id' AS "column", 'required' AS kind, 1 AS present, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT id) AS BIGINT) AS distinct FROM crashes
UNION ALL SELECT 'start_time', 'required', 1, count(*), count(DISTINCT start_time) FROM crashes
UNION ALL SELECT 'severity', 'required', 1, count(*), count(DISTINCT severity) FROM crashes
UNION ALL SELECT 'end_time', 'recommended', 0, count(*), NULL FROM crashes
UNION ALL SELECT 'weather_condition', 'recommended', 1, count(*), count(DISTINCT weather_condition) FROM crashes""",
       ("crashes",))
def source_profile(spark, d):
    """Required / recommended columns, row and distinct counts."""
    return M.source_profile(V.crashes(spark, d), ["id", "start_time", "severity"], ["end_time", "weather_condition"])


@query("quality_report", f"""
WITH v AS ({CRASH_CHECKS_SQL}), m AS ({_missing_sql()}), cf AS ({CF_SQL}),
sp AS (SELECT CASE WHEN year <= 1998 THEN 'train' WHEN year = 1999 THEN 'val' ELSE 'test' END AS split, count(*) AS n, avg(high_severity) AS rate FROM cf GROUP BY 1),
dr AS (SELECT CASE WHEN max(rate) - min(rate) > 0.05 THEN 1 ELSE 0 END AS drift FROM sp)
SELECT 'validation' AS section, "column" || ':' || "check" AS item, CAST(failures AS DOUBLE) AS value FROM v
UNION ALL SELECT 'missing_pct', "column", pct FROM m
UNION ALL SELECT 'class_share', CAST(high_severity AS VARCHAR), round_even(count(*) / (SELECT count(*) FROM cf), 6) FROM cf GROUP BY high_severity
UNION ALL SELECT 'duplicates', 'id', CAST(count(*) - count(DISTINCT id) AS DOUBLE) FROM crashes
UNION ALL SELECT 'split', split || ':n', CAST(n AS DOUBLE) FROM sp
UNION ALL SELECT 'split', split || ':rate', round_even(rate, 6) FROM sp
UNION ALL SELECT 'split', split || ':drift', CAST(drift AS DOUBLE) FROM sp, dr""", ("crashes",))
def quality_report(spark, d):
    """Validation + missing profile + class balance + duplicates + split
    comparison (M7) in one long report."""
    from ..plans.workzones import quality_report as report
    c = V.crashes(spark, d)
    target = cf(spark, d).withColumn("split", F.when(F.col("year") <= 1998, "train").when(F.col("year") == 1999, "val").otherwise("test"))
    t = c.join(target.select("id", "high_severity", "split"), "id")
    r = report(t, crash_checks(), "id", MISSING_COLS, "high_severity", "split", unique=["county"])
    return r.withColumn("value", r6("value"))
