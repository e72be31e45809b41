"""Grouping, ranking, data-driven binning, joins and splits (H*, I*, L2-L4,
G*, U1, N*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import testviews as V
from ..functions import features as E
from ..functions import temporal as T
from ..operators import aggregates as H
from ..operators import joins as G
from ..operators import ranking as I
from ..operators import splits as N
from ..session import read_table
from .base import query, r6
from .scalars import WEATHER_SQL, crash_features

CF_SQL = f"""
SELECT *, hour(start_time) AS hour, isodow(start_time) - 1 AS day_of_week, month(start_time) AS month,
       year(start_time) AS year, CAST(start_time AS DATE) AS crash_date,
       CASE WHEN severity >= 3 THEN 1 ELSE 0 END AS high_severity,
       {WEATHER_SQL} AS weather_category
FROM (SELECT *, lower(weather_condition) AS w FROM crashes)"""


def cf(spark, d):
    return crash_features(spark, d).withColumns({
        "crash_date": F.to_date("start_time"), "weather_category": E.weather_category("weather_condition")})


def _rate(key):
    return f"""WITH cf AS ({CF_SQL})
SELECT {key}, CAST(count(*) AS BIGINT) AS n, round_even(avg(high_severity), 6) AS rate
FROM cf WHERE {key} IS NOT NULL GROUP BY {key}"""


for _key in ("day_of_week", "month", "weather_category", "city"):
    def _mk(key):
        def fn(spark, d):
            g = H.rate_by_group(cf(spark, d), key, "high_severity")
            return g.select(key, "n", r6("rate").alias("rate"))
        fn.__doc__ = f"H5: high-severity rate and count per {key}."
        return fn
    query(f"rate_by_{_key}", _rate(_key), ("crashes",))(_mk(_key))


@query("rate_by_lanes", """
SELECT through_lanes, CAST(count(*) AS BIGINT) AS n, round_even(avg(CASE WHEN y > 0 THEN 1 ELSE 0 END), 6) AS rate
FROM segments JOIN counts USING (segment_id) GROUP BY through_lanes HAVING through_lanes <= 5""",
       ("segments", "counts"))
def rate_by_lanes(spark, d):
    """H5: keys filtered after grouping (lanes <= 5)."""
    s = V.segments(spark, d).join(V.counts(spark, d), "segment_id")
    g = H.rate_by_group(s.withColumn("any_crash", (F.col("y") > 0).cast("int")), "through_lanes", "any_crash")
    return g.where(F.col("through_lanes") <= 5).select("through_lanes", "n", r6("rate").alias("rate"))


@query("rate_by_equal_width_bin", """
WITH b AS (SELECT min(temperature_f) AS lo, max(temperature_f) AS hi FROM crashes),
cf AS (""" + CF_SQL + """)
SELECT bin, CAST(count(*) AS BIGINT) AS n, round_even(avg(high_severity), 6) AS rate FROM (
  SELECT high_severity, """ + " + ".join(
    f"CASE WHEN temperature_f > lo + (hi - lo) * {j} / 10 THEN 1 ELSE 0 END" for j in range(1, 10)) + """ AS bin
  FROM cf, b WHERE temperature_f IS NOT NULL) GROUP BY bin""", ("crashes",))
def rate_by_equal_width_bin(spark, d):
    """H6 over L2: 10 equal-width temperature bins."""
    c = cf(spark, d).where(F.col("temperature_f").isNotNull())
    b = I.bin_equal_width(c, "temperature_f", 10)
    return H.rate_by_group(b, "bin", "high_severity").select("bin", "n", r6("rate").alias("rate"))


QBIN_SQL = """
WITH e AS (SELECT list_sort(list_distinct(quantile_cont(aadt, [0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS edges FROM segments)
SELECT segment_id, len(list_filter(edges[2:len(edges) - 1], lambda v: aadt > v)) AS bin FROM segments, e"""


@query("rate_by_fixed_bin", f"""WITH cf AS ({CF_SQL})
SELECT temp_category, CAST(count(*) AS BIGINT) AS n, round_even(avg(high_severity), 6) AS rate FROM (
  SELECT high_severity, CASE WHEN temperature_f IS NULL OR isnan(temperature_f) THEN NULL
    WHEN temperature_f <= 32 THEN 'freezing' WHEN temperature_f <= 50 THEN 'cold' WHEN temperature_f <= 70 THEN 'mild'
    WHEN temperature_f <= 90 THEN 'warm' ELSE 'hot' END AS temp_category FROM cf)
WHERE temp_category IS NOT NULL GROUP BY temp_category""", ("crashes",))
def rate_by_fixed_bin(spark, d):
    """H6 over L1: high-severity rate per fixed-edge temperature bin."""
    from ..functions.binning import TRAINING, bin_right_closed
    c = cf(spark, d).withColumn("temp_category", bin_right_closed("temperature_f", *TRAINING["temp"]))
    return H.rate_by_group(c, "temp_category", "high_severity").select("temp_category", "n", r6("rate").alias("rate"))


@query("bin_quantile", QBIN_SQL, ("segments",))
def bin_quantile(spark, d):
    """L3: 5 quantile bins of segment AADT (qcut, duplicate edges dropped)."""
    s = V.segments(spark, d)
    return I.bin_quantile(s, "aadt", 5).select("segment_id", "bin")


@query("rate_by_quantile_bin", """
WITH b AS (""" + QBIN_SQL + """)
SELECT bin, CAST(count(*) AS BIGINT) AS n, round_even(avg(CASE WHEN y > 0 THEN 1 ELSE 0 END), 6) AS rate
FROM b JOIN counts USING (segment_id) GROUP BY bin""", ("segments", "counts"))
def rate_by_quantile_bin(spark, d):
    """H6 over L3."""
    s = I.bin_quantile(V.segments(spark, d), "aadt", 5).join(V.counts(spark, d), "segment_id")
    s = s.withColumn("any_crash", (F.col("y") > 0).cast("int"))
    return H.rate_by_group(s, "bin", "any_crash").select("bin", "n", r6("rate").alias("rate"))


@query("quantile_flag", """
SELECT id, CASE WHEN p >= (SELECT quantile_cont(p, 0.9) FROM scored) THEN 1 ELSE 0 END AS top_decile FROM scored""",
       ("scored",))
def quantile_flag(spark, d):
    """L4."""
    return I.quantile_flag(V.scored(spark, d), "p", 0.9, "top_decile").select("id", "top_decile")


@query("rate_pivot", f"""WITH cf AS ({CF_SQL})
SELECT day_of_week,
  round_even(avg(CASE WHEN weather_category = 'clear' THEN high_severity END), 6) AS clear,
  round_even(avg(CASE WHEN weather_category = 'cloudy' THEN high_severity END), 6) AS cloudy,
  round_even(avg(CASE WHEN weather_category = 'fog' THEN high_severity END), 6) AS fog,
  round_even(avg(CASE WHEN weather_category = 'rain' THEN high_severity END), 6) AS rain,
  round_even(avg(CASE WHEN weather_category = 'snow' THEN high_severity END), 6) AS snow
FROM cf GROUP BY day_of_week""", ("crashes",))
def rate_pivot(spark, d):
    """H7: two-key mean with the second key as columns (explicit values)."""
    vals = ["clear", "cloudy", "fog", "rain", "snow"]
    p = cf(spark, d).groupBy("day_of_week").pivot("weather_category", vals).avg("high_severity")
    return p.select("day_of_week", *[r6(v).alias(v) for v in vals])


@query("value_counts", """
SELECT weather_condition AS value, CAST(count(*) AS BIGINT) AS n,
       round_even(count(*) * 100.0 / (SELECT count(weather_condition) FROM crashes), 6) AS pct
FROM crashes WHERE weather_condition IS NOT NULL GROUP BY weather_condition""", ("crashes",))
def value_counts(spark, d):
    v = H.value_counts(V.crashes(spark, d), "weather_condition")
    return v.select("value", "n", r6("pct").alias("pct"))


@query("multi_value_counts", f"""WITH cf AS ({CF_SQL}),
l AS (SELECT 'county' AS "column", county AS value FROM cf UNION ALL SELECT 'city', city FROM cf
      UNION ALL SELECT 'weather_category', weather_category FROM cf
      UNION ALL SELECT 'severity', CAST(severity AS VARCHAR) FROM cf),
c AS (SELECT "column", value, count(*) AS n FROM l WHERE value IS NOT NULL GROUP BY ALL)
SELECT "column", value, CAST(n AS BIGINT) AS n, round_even(n * 100.0 / sum(n) OVER (PARTITION BY "column"), 6) AS pct FROM c
""", ("crashes",))
def multi_value_counts(spark, d):
    """H9."""
    m = H.multi_value_counts(cf(spark, d), ["county", "city", "weather_category", "severity"])
    return m.select("column", "value", "n", r6("pct").alias("pct"))


@query("crosstab", """
SELECT y AS actual, CAST(count(*) FILTER (WHERE p < 0.5) AS BIGINT) AS pred_0,
       CAST(count(*) FILTER (WHERE p >= 0.5) AS BIGINT) AS pred_1 FROM scored GROUP BY y""", ("scored",))
def crosstab(spark, d):
    """Actual x predicted counts."""
    s = V.scored(spark, d).select(F.col("y").alias("actual"), (F.col("p") >= 0.5).cast("int").alias("pred"))
    ct = H.crosstab(s, "actual", "pred", [0, 1])
    return ct.select("actual", F.col("0").alias("pred_0"), F.col("1").alias("pred_1"))


@query("region_stats", """
SELECT county, CAST(count(*) AS BIGINT) AS n, round_even(avg(severity), 6) AS mean_severity,
       CAST(sum(severity) AS BIGINT) AS total_severity FROM crashes GROUP BY county""", ("crashes",))
def region_stats(spark, d):
    """H11."""
    c = V.crashes(spark, d)
    return c.groupBy("county").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("severity")).alias("mean_severity"),
                                   F.sum("severity").cast("long").alias("total_severity"))


@query("resample_counts", """
WITH c AS (SELECT CAST(date_trunc('week', start_time) AS DATE) AS period, count(*) AS n FROM crashes GROUP BY 1),
cal AS (SELECT CAST(unnest(generate_series(min(period), max(period), INTERVAL 7 DAY)) AS DATE) AS period FROM c)
SELECT cal.period, CAST(coalesce(n, 0) AS BIGINT) AS n FROM cal LEFT JOIN c USING (period)""", ("crashes",))
def resample_counts(spark, d):
    """Weekly counts with empty weeks as 0."""
    return H.resample_counts(V.crashes(spark, d), "start_time", "week")


def _describe_sql(cols):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS count, round_even(avg({c}), 6) AS mean,
  round_even(stddev_samp({c}), 6) AS std, min({c}) AS min, round_even(quantile_cont({c}, 0.25), 6) AS p25,
  round_even(quantile_cont({c}, 0.5), 6) AS p50, round_even(quantile_cont({c}, 0.75), 6) AS p75, max({c}) AS max,
  round_even(count(*) FILTER (WHERE {c} = 0) / count(*), 6) AS zero_share FROM crashes""")
    return " UNION ALL ".join(parts)


@query("describe", _describe_sql(["temperature_f", "visibility_mi", "x"]), ("crashes",))
def describe(spark, d):
    """H13."""
    s = H.describe(V.crashes(spark, d), ["temperature_f", "visibility_mi", "x"])
    return s.select("column", "count", *[r6(c).alias(c) for c in ("mean", "std")], "min",
                    *[r6(c).alias(c) for c in ("p25", "p50", "p75")], "max", r6("zero_share").alias("zero_share"))


CORR_COLS = ["severity", "temperature_f", "visibility_mi", "x", "y"]


@query("correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round_even(corr({a}, {b}), 6) AS r FROM crashes"
    for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]), ("crashes",))
def correlation_matrix(spark, d):
    """H14."""
    c = H.correlation_long(V.crashes(spark, d), CORR_COLS)
    return c.select("a", "b", r6("r").alias("r"))


@query("target_correlation", f"""WITH RECURSIVE cf AS ({CF_SQL}),
l AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, high_severity) AS r, count({c}) AS n FROM cf"
                          for c in ["temperature_f", "visibility_mi", "hour", "x", "y", "day_of_week"])}),
a AS (SELECT feature, n - 2 AS v, abs(r) AS sn, sqrt(1 - r * r) AS cs FROM l),
series AS (
  SELECT feature, v, cs, CASE WHEN v % 2 = 0 THEN 2 ELSE 3 END AS k, CASE WHEN v % 2 = 0 THEN 1.0::DOUBLE ELSE cs END AS term,
         CASE WHEN v % 2 = 0 THEN 1.0::DOUBLE WHEN v = 1 THEN 0.0::DOUBLE ELSE cs END AS total FROM a
  UNION ALL SELECT feature, v, cs, k + 2, term * cs * cs * (k - 1) / k, total + term * cs * cs * (k - 1) / k
  FROM series WHERE k + 2 <= v AND term > 1e-18),
pv AS (
  SELECT a.feature, greatest(0.0, 1 - CASE WHEN a.v % 2 = 0 THEN sn * total ELSE 2 / pi() * (asin(sn) + sn * total) END) AS p_value
  FROM a JOIN (SELECT feature, max(total) AS total FROM series GROUP BY feature) s USING (feature))
SELECT feature, round_even(r, 6) AS r, CAST(n AS BIGINT) AS n, round_even(abs(r), 6) AS abs_r,
       round_even(r * sqrt((n - 2) / (1 - r * r)), 6) AS t, round_even(p_value, 6) AS p_value
FROM l JOIN pv USING (feature) ORDER BY abs(r) DESC, feature LIMIT 4""", ("crashes",))
def target_correlation(spark, d):
    """H15 + H16: |r| with the target ranked, top 4, with point-biserial t."""
    t = H.target_correlation(cf(spark, d), ["temperature_f", "visibility_mi", "hour", "x", "y", "day_of_week"],
                             "high_severity", 4)
    return t.select("feature", r6("r").alias("r"), "n", r6("abs_r").alias("abs_r"), r6("t").alias("t"),
                    r6("p_value").alias("p_value"))


@query("histogram", """
WITH b AS (SELECT min(temperature_f) AS lo, max(temperature_f) AS hi FROM crashes)
SELECT CAST(least(floor((temperature_f - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n,
       round_even(min(lo + least(floor((temperature_f - lo) / ((hi - lo) / 20)), 19) * ((hi - lo) / 20)), 6) AS lo,
       round_even(min(lo + (least(floor((temperature_f - lo) / ((hi - lo) / 20)), 19) + 1) * ((hi - lo) / 20)), 6) AS hi
FROM crashes, b WHERE temperature_f IS NOT NULL GROUP BY 1""", ("crashes",))
def histogram(spark, d):
    """20 equal bins, last closed."""
    h = H.histogram(V.crashes(spark, d), "temperature_f", 20)
    return h.select("bin", "n", r6("lo").alias("lo"), r6("hi").alias("hi"))


@query("box_stats", """
WITH q AS (SELECT county, quantile_cont(temperature_f, 0.25) AS q1, quantile_cont(temperature_f, 0.5) AS median,
                  quantile_cont(temperature_f, 0.75) AS q3 FROM crashes WHERE temperature_f IS NOT NULL GROUP BY county),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
SELECT f.county, round_even(q1, 6) AS q1, round_even(median, 6) AS median, round_even(q3, 6) AS q3,
       round_even(lower_fence, 6) AS lower_fence, round_even(upper_fence, 6) AS upper_fence,
       CAST(count(*) FILTER (WHERE temperature_f < lower_fence OR temperature_f > upper_fence) AS BIGINT) AS outliers
FROM f JOIN crashes c ON c.county = f.county WHERE temperature_f IS NOT NULL
GROUP BY ALL""", ("crashes",))
def box_stats(spark, d):
    """Per county temperature box statistics."""
    b = H.box_stats(V.crashes(spark, d), "county", "temperature_f")
    return b.select("county", *[r6(c).alias(c) for c in ("q1", "median", "q3", "lower_fence", "upper_fence")],
                    "outliers")


@query("mode_value", """
SELECT weather_condition, CAST(count(*) AS BIGINT) AS n FROM crashes WHERE weather_condition IS NOT NULL
GROUP BY 1 ORDER BY n DESC, weather_condition LIMIT 1""", ("crashes",))
def mode_value(spark, d):
    """H19."""
    return H.mode_value(V.crashes(spark, d), "weather_condition")


@query("group_consolidate", """
SELECT road_event_id, round_even(avg(visibility_mi), 6) AS visibility_mi, round_even(avg(temperature_f), 6) AS temperature_f,
       CAST(count(*) AS BIGINT) AS crash_count, max(severity) AS max_severity FROM wzcrash GROUP BY road_event_id""",
       ("wzcrash",))
def group_consolidate(spark, d):
    """Mean of features, count, max label per id."""
    w = V.wzcrash(spark, d)
    return w.groupBy("road_event_id").agg(r6(F.avg("visibility_mi")).alias("visibility_mi"),
                                          r6(F.avg("temperature_f")).alias("temperature_f"),
                                          F.count(F.lit(1)).alias("crash_count"),
                                          F.max("severity").alias("max_severity"))


@query("distinct_count", """
SELECT CAST(count(DISTINCT road_event_id) AS BIGINT) AS zones, CAST(count(DISTINCT road_name) AS BIGINT) AS roads,
       CAST(count(DISTINCT vehicle_impact) AS BIGINT) AS impacts FROM wzcrash""", ("wzcrash",))
def distinct_count(spark, d):
    """H21 (exact; ``approx_count_distinct`` is the at-scale option)."""
    w = V.wzcrash(spark, d).select(F.col("road_event_id").alias("zones"), F.col("road_name").alias("roads"),
                                   F.col("vehicle_impact").alias("impacts"))
    return H.distinct_count(w, ["zones", "roads", "impacts"])


@query("date_span", """
SELECT min(start_time) AS first, max(start_time) AS last,
       CAST(floor((epoch_us(max(start_time)) - epoch_us(min(start_time))) / 86400000000) AS BIGINT) AS days
FROM crashes""", ("crashes",))
def date_span(spark, d):
    """H22."""
    c = V.crashes(spark, d).agg(F.min("start_time").alias("first"), F.max("start_time").alias("last"))
    return c.withColumn("days", T.duration_days("last", "first"))


@query("weather_summary", """
SELECT vehicle_impact AS metro, round_even(avg(temperature_f), 6) AS mean_temp, min(temperature_f) AS min_temp,
       max(temperature_f) AS max_temp, round_even(sum(precip_in), 6) AS total_precip,
       CAST(count(*) FILTER (WHERE precip_in > 0) AS BIGINT) AS wet_rows,
       round_even(avg(CASE WHEN wind_mph = 0 THEN 1.0 ELSE 0.0 END), 6) AS calm_share
FROM wzcrash GROUP BY vehicle_impact""", ("wzcrash",))
def weather_summary(spark, d):
    """Per group weather summary."""
    w = V.wzcrash(spark, d)
    return w.groupBy(F.col("vehicle_impact").alias("metro")).agg(
        r6(F.avg("temperature_f")).alias("mean_temp"), F.min("temperature_f").alias("min_temp"),
        F.max("temperature_f").alias("max_temp"), r6(F.sum("precip_in")).alias("total_precip"),
        F.count_if(F.col("precip_in") > 0).alias("wet_rows"),
        r6(F.avg(F.when(F.col("wind_mph") == 0, 1.0).otherwise(0.0))).alias("calm_share"))


@query("cluster_profile", """
SELECT label, round(avg(px), 2) AS px, round(avg(py), 2) AS py, CAST(count(*) AS BIGINT) AS n
FROM planar WHERE label <> -1 GROUP BY label""", ("planar",))
def cluster_profile(spark, d):
    """Mean features per cluster label (noise -1 excluded), rounded 2."""
    p = V.planar(spark, d).where(F.col("label") != -1)
    return p.groupBy("label").agg(F.round(F.avg("px"), 2).alias("px"), F.round(F.avg("py"), 2).alias("py"),
                                  F.count(F.lit(1)).alias("n"))


@query("conditional_profile", f"""WITH cf AS ({CF_SQL})
SELECT weather_category AS value, CAST(count(*) AS BIGINT) AS n,
       round_even(count(*) * 100.0 / (SELECT count(*) FROM cf WHERE severity = 4), 6) AS pct
FROM cf WHERE severity = 4 GROUP BY weather_category""", ("crashes",))
def conditional_profile(spark, d):
    """Value counts inside the fatal (severity 4) sub-population."""
    v = H.value_counts(cf(spark, d).where(F.col("severity") == 4), "weather_category")
    return v.select("value", "n", r6("pct").alias("pct"))


@query("county_stats", """
SELECT county, CAST(count(*) AS BIGINT) AS total_crashes, CAST(sum(CASE WHEN severity >= 2 THEN 1 ELSE 0 END) AS BIGINT) AS injury_crashes,
       CAST(sum(CASE WHEN severity = 4 THEN 1 ELSE 0 END) AS BIGINT) AS fatal_crashes, round_even(avg(severity), 6) AS avg_severity,
       round_even(avg(CASE WHEN severity >= 2 THEN 1.0 ELSE 0.0 END), 6) AS injury_rate,
       min(start_time) AS first_crash_date, max(start_time) AS last_crash_date,
       CAST(floor((epoch_us(max(start_time)) - epoch_us(min(start_time))) / 86400000000) AS BIGINT) AS days_covered,
       round_even(count(*) / nullif(floor((epoch_us(max(start_time)) - epoch_us(min(start_time))) / 86400000000), 0), 6) AS crashes_per_day
FROM crashes WHERE county IS NOT NULL GROUP BY county""", ("crashes",))
def county_stats(spark, d):
    """H4 + G4: totals, injury/fatal counts and rates, span and crashes/day
    in one aggregate (no self-join); zero-day spans give null (Q14)."""
    from ..operators.aggregates import county_stats as cs
    r = cs(V.crashes(spark, d))
    return r.withColumns({c: r6(c) for c in ("avg_severity", "injury_rate", "crashes_per_day")})


# --------------------------------------------------------------- I*

@query("dedup_keep_first", """
SELECT road_event_id, arg_min(crash_id, crash_id) AS crash_id, arg_min(severity, crash_id) AS severity,
       arg_min(road_name, crash_id) AS road_name FROM wzcrash GROUP BY road_event_id""", ("wzcrash",))
def dedup_keep_first(spark, d):
    """First row per zone by crash id (min_by aggregate)."""
    w = V.wzcrash(spark, d).select("road_event_id", "crash_id", "severity", "road_name")
    return I.dedup_keep_first(w, ["road_event_id"], ["crash_id"])


@query("dedup_full_features", """
SELECT DISTINCT severity, road_name, vehicle_impact, CAST(wind_mph AS DOUBLE) AS wind_mph FROM wzcrash""", ("wzcrash",))
def dedup_full_features(spark, d):
    """I2."""
    return I.dedup_full(V.wzcrash(spark, d), ["severity", "road_name", "vehicle_impact", "wind_mph"])


@query("duplicate_count", """
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates, CAST(count(*) AS BIGINT) AS distinct_keys
FROM (SELECT count(*) AS n FROM crashes GROUP BY county, city, severity)""", ("crashes",))
def duplicate_count(spark, d):
    """I3."""
    return I.duplicate_count(V.crashes(spark, d), ["county", "city", "severity"])


@query("centered_rolling_mean", """
WITH daily AS (SELECT CAST(start_time AS DATE) AS date, count(*) AS n FROM crashes GROUP BY 1)
SELECT date, CAST(n AS BIGINT) AS n,
       CASE WHEN count(n) OVER w = 30 THEN round_even(avg(n) OVER w, 6) END AS rolling_mean
FROM daily WINDOW w AS (ORDER BY date ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING)""", ("crashes",))
def centered_rolling_mean(spark, d):
    """I4: 30-day centred mean of daily counts."""
    daily = V.crashes(spark, d).groupBy(F.to_date("start_time").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    r = I.centered_rolling_mean(daily, "date", "n", 30)
    return r.select("date", "n", r6("rolling_mean").alias("rolling_mean"))


@query("group_first", """
SELECT county, arg_min(weather_condition, id) FILTER (WHERE weather_condition IS NOT NULL) AS weather_condition,
       arg_min(temperature_f, id) FILTER (WHERE temperature_f IS NOT NULL) AS temperature_f
FROM crashes GROUP BY county""", ("crashes",))
def group_first(spark, d):
    """First non-null per column in id order."""
    return I.group_first(V.crashes(spark, d), "county", "id", ["weather_condition", "temperature_f"])


@query("top_n", """
SELECT county, CAST(count(*) AS BIGINT) AS n FROM crashes GROUP BY county ORDER BY n DESC, county LIMIT 10""",
       ("crashes",))
def top_n(spark, d):
    """I6."""
    g = V.crashes(spark, d).groupBy("county").agg(F.count(F.lit(1)).alias("n"))
    return I.top_n(g, "n", 10, ["county"])


@query("top_n_or_other", """
WITH top AS (SELECT county FROM crashes WHERE county IS NOT NULL GROUP BY county ORDER BY count(*) DESC, county LIMIT 20)
SELECT id, coalesce(top.county, 'other') AS county_top20 FROM crashes LEFT JOIN top USING (county)""", ("crashes",))
def top_n_or_other(spark, d):
    """I7."""
    return I.top_n_or_other(V.crashes(spark, d), "county", 20, out="county_top20").select("id", "county_top20")


@query("frequency_bucket", """
WITH c AS (SELECT city, count(*) AS n FROM crashes WHERE city IS NOT NULL GROUP BY city)
SELECT id, CASE WHEN coalesce(n, 0) > 3000 THEN 'large' WHEN coalesce(n, 0) > 2950 THEN 'medium' ELSE 'small' END AS size_category
FROM crashes LEFT JOIN c USING (city)""", ("crashes",))
def frequency_bucket(spark, d):
    """I8 (thresholds chosen to split the five test cities)."""
    return I.frequency_bucket(V.crashes(spark, d), "city", 3000, 2950).select("id", "size_category")


@query("union_splits", """
SELECT id, 'train' AS split FROM crashes WHERE year(start_time) <= 1998
UNION ALL SELECT id, 'test' AS split FROM crashes WHERE year(start_time) >= 2000""", ("crashes",))
def union_splits(spark, d):
    """I9."""
    c = V.crashes(spark, d)
    tr = c.where(F.col("start_time") < F.lit("1999-01-01").cast("timestamp_ntz")).select("id", F.lit("train").alias("split"))
    te = c.where(F.col("start_time") >= F.lit("2000-01-01").cast("timestamp_ntz")).select("id", F.lit("test").alias("split"))
    return tr.unionByName(te)


@query("key_overlap", """
SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A'""")
def key_overlap(spark, d):
    """Ids present in both sets."""
    li = read_table(spark, d, "lineitem")
    a = li.where(F.col("l_returnflag") == "R").select("l_orderkey")
    b = li.where(F.col("l_returnflag") == "A").select("l_orderkey")
    return a.intersect(b)


@query("temporal_order_split", """
SELECT id, CASE WHEN row_number() OVER (ORDER BY start_time, id) - 1 < floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'test' END AS split
FROM crashes""", ("crashes",))
def temporal_order_split(spark, d):
    """First 80 % by time -> train (distributed prefix offsets)."""
    c = V.crashes(spark, d).select("id", "start_time")
    c = c.withColumn("_t", F.unix_micros(F.col("start_time").cast("timestamp")))
    return I.temporal_order_split(c, ["_t", "id"]).select("id", "split")


# --------------------------------------------------------------- G*, U1

@query("left_equi_join", """
SELECT segment_id, through_lanes, CAST(coalesce(n, 0) AS BIGINT) AS crash_count
FROM segments LEFT JOIN (SELECT l_partkey AS segment_id, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
USING (segment_id)""", ("segments",))
def left_equi_join(spark, d):
    """G1: segment features left-joined to per-segment counts, absent -> 0."""
    li = read_table(spark, d, "lineitem").where(F.col("l_returnflag") == "R")
    agg = li.groupBy(F.col("l_partkey").alias("segment_id")).agg(F.count(F.lit(1)).alias("crash_count"))
    s = V.segments(spark, d).select("segment_id", "through_lanes")
    return G.left_equi_join(s, agg, ["segment_id"], {"crash_count": 0})


@query("left_join_normalised_key", """
WITH cs AS (SELECT county AS county_name, count(*) AS total_crashes FROM crashes GROUP BY county)
SELECT road_event_id, w.county_name AS county_name_wz, cs.county_name AS county_name_crash,
       CAST(total_crashes AS BIGINT) AS total_crashes
FROM workzones w LEFT JOIN cs ON upper(trim(w.county_name)) = upper(trim(cs.county_name))""", ("workzones", "crashes"))
def left_join_normalised_key(spark, d):
    """Work zones (lower-case padded county) to county stats."""
    cs = V.crashes(spark, d).groupBy(F.col("county").alias("county_name")).agg(F.count(F.lit(1)).alias("total_crashes"))
    w = V.workzones(spark, d).select("road_event_id", "county_name")
    j = G.left_join_normalised_key(w, cs, "county_name", "county_name")
    return j.select("road_event_id", "county_name_wz", "county_name_crash", "total_crashes")


@query("range_interval_join", """
SELECT id, CAST(count(road_event_id) AS BIGINT) AS active_zones, min(road_event_id) AS first_zone
FROM crashes c LEFT JOIN workzones w ON CAST(c.start_time AS DATE) BETWEEN w.start_date AND w.end_date
GROUP BY id""", ("crashes", "workzones"))
def range_interval_join(spark, d):
    """Per crash, how many work zones are active on its date and the first
    of them (blocks of days, no pairs)."""
    c = V.crashes(spark, d).select("id", "start_time")
    w = V.workzones(spark, d).select("road_event_id", "start_date", "end_date")
    return G.interval_cover(c, "start_time", w, "start_date", "end_date", "road_event_id", "active_zones", "first_zone").select(
        "id", "active_zones", "first_zone")


@query("semi_join", """
SELECT road_event_id FROM workzones WHERE road_event_id IN (SELECT road_event_id FROM wzcrash)""",
       ("workzones", "wzcrash"))
def semi_join(spark, d):
    """Matched only."""
    return G.semi(V.workzones(spark, d).select("road_event_id"), V.wzcrash(spark, d), ["road_event_id"])


@query("anti_join", """
SELECT road_event_id FROM workzones WHERE road_event_id NOT IN (SELECT road_event_id FROM wzcrash)""",
       ("workzones", "wzcrash"))
def anti_join(spark, d):
    """Unmatched only."""
    return G.anti(V.workzones(spark, d).select("road_event_id"), V.wzcrash(spark, d), ["road_event_id"])


@query("fallback_fill", """
WITH gm AS (SELECT county, avg(aadt) AS gm FROM stations WHERE aadt IS NOT NULL AND county IS NOT NULL GROUP BY county),
med AS (SELECT median(aadt) AS med FROM stations WHERE aadt IS NOT NULL)
SELECT statn_id, round_even(coalesce(aadt, gm, med), 6) AS aadt_filled,
       CASE WHEN aadt IS NOT NULL THEN 'matched' WHEN gm IS NOT NULL THEN 'county_avg' ELSE 'state_median' END AS aadt_source
FROM stations LEFT JOIN gm USING (county), med""", ("stations",))
def fallback_fill(spark, d):
    """U1 on stations: own value -> county mean -> global median."""
    f = G.fallback_fill(V.stations(spark, d), "aadt", "county", "aadt_filled", "aadt_source")
    return f.select("statn_id", r6("aadt_filled").alias("aadt_filled"), "aadt_source")


# --------------------------------------------------------------- N*

@query("sample_n", """
SELECT id, severity FROM crashes ORDER BY ((CAST(id AS BIGINT) % 2147483629) * 1103515245) % 2147483629, id LIMIT 500""", ("crashes",))
def sample_n(spark, d):
    """Exactly 500 rows by a seeded integer mix."""
    return N.sample_n(V.crashes(spark, d).select("id", "severity"), "id", 500)


@query("temporal_split", """
SELECT id, CASE WHEN start_time BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1997-12-31 23:59:59' THEN 'train'
                WHEN start_time BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31 23:59:59' THEN 'val'
                WHEN start_time BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-12-31 23:59:59' THEN 'test' END AS split
FROM crashes WHERE start_time BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1999-12-31 23:59:59'""", ("crashes",))
def temporal_split(spark, d):
    """Year ranges (rows outside dropped)."""
    import datetime as dt
    r = {"train": (dt.datetime(1995, 1, 1), dt.datetime(1997, 12, 31, 23, 59, 59)),
         "val": (dt.datetime(1998, 1, 1), dt.datetime(1998, 12, 31, 23, 59, 59)),
         "test": (dt.datetime(1999, 1, 1), dt.datetime(1999, 12, 31, 23, 59, 59))}
    return N.temporal_split(V.crashes(spark, d), "start_time", r).select("id", "split")


STRAT_SQL = """
SELECT id, CASE WHEN rk < floor(sz * 700000 / 1000000) THEN 'train' WHEN rk < floor(sz * 850000 / 1000000) THEN 'val' ELSE 'test' END AS split
FROM (SELECT id, row_number() OVER (PARTITION BY severity, county ORDER BY ((CAST(id AS BIGINT) % 2147483629) * 1103515245) % 2147483629, id) - 1 AS rk,
             count(*) OVER (PARTITION BY severity, county) AS sz FROM crashes)"""


@query("stratified_split", STRAT_SQL, ("crashes",))
def stratified_split(spark, d):
    """70/15/15 within (severity, county) strata."""
    return N.stratified_split(V.crashes(spark, d).select("id", "severity", "county"), ["severity", "county"], "id") \
        .select("id", "split")


@query("stratified_kfold", """
SELECT id, CAST((row_number() OVER (PARTITION BY y ORDER BY ((CAST(id AS BIGINT) % 2147483629) * 1103515245) % 2147483629, id) - 1) % 5 AS INTEGER) AS fold
FROM scored""", ("scored",))
def stratified_kfold(spark, d):
    """N4."""
    return N.stratified_kfold(V.scored(spark, d).select("id", "y"), "y", "id").select("id", "fold")


@query("group_kfold", """
SELECT crash_id, CAST((((CAST(road_event_id AS BIGINT) % 2147483629) * 1103515245) % 2147483629) % 5 AS INTEGER) AS fold,
       CASE WHEN ((CAST(road_event_id AS BIGINT) % 2147483629) * 1103515245) % 2147483629 < 429496725 THEN 'test' ELSE 'train' END AS split FROM wzcrash""",
       ("wzcrash",))
def group_kfold(spark, d):
    """Whole work zones to one fold / one side."""
    w = V.wzcrash(spark, d).select("crash_id", "road_event_id")
    return N.group_split(N.group_kfold(w, "road_event_id"), "road_event_id", 0.2).select("crash_id", "fold", "split")


@query("permute_labels", f"""WITH cf AS ({CF_SQL}),
k AS (SELECT id, high_severity, row_number() OVER (ORDER BY id) AS r FROM cf),
m AS (SELECT high_severity, row_number() OVER (ORDER BY ((id % {N.MIX_MOD} + 7) * {N.MIX_MULT}) % {N.MIX_MOD}, id) AS r FROM cf)
SELECT k.id, k.high_severity, m.high_severity AS permuted_high_severity FROM k JOIN m USING (r)""", ("crashes",))
def permute_labels(spark, d):
    """Crash labels re-paired with other crashes (the key must be unique:
    crash ids are)."""
    return N.permute_labels(cf(spark, d).select("id", "high_severity"), "id", "high_severity")
