"""Scalar, cleaning, filter and projection queries (C*, D*, E*, L1, F13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import testviews as V
from ..functions import cleaning as D
from ..functions import features as E
from ..functions import temporal as T
from ..functions.binning import TRAINING, bin_right_closed
from ..operators import filters as C
from ..operators.aggregates import rate_by_group
from ..session import read_table
from .base import query, r6


def crash_features(spark, d):
    """crashes + calendar + target: the shared base of the crash queries."""
    c = V.crashes(spark, d)
    cal = T.calendar("start_time")
    return c.withColumns(cal).withColumn("high_severity", E.severity_target("severity", "year"))


# --------------------------------------------------------------- phase 0 slice

RATE_BY_HOUR_SQL = """
SELECT hour, CAST(count(*) AS BIGINT) AS n, round_even(avg(high_severity), 6) AS rate
FROM (SELECT hour(start_time) AS hour,
             CASE WHEN year(start_time) < 2021 THEN (severity >= 3) ELSE (severity >= 3) END::INT AS high_severity
      FROM crashes)
GROUP BY hour
"""


@query("rate_by_hour", RATE_BY_HOUR_SQL, ("crashes",))
def rate_by_hour(spark, d):
    """H5 on E1 + E10: high-severity rate per hour of day."""
    g = rate_by_group(crash_features(spark, d), "hour", "high_severity")
    return g.select("hour", "n", r6("rate").alias("rate"))


# --------------------------------------------------------------- E1-E3, E8-E12

@query("calendar_features", """
SELECT id, hour(start_time) AS hour, isodow(start_time) - 1 AS day_of_week, month(start_time) AS month,
       year(start_time) AS year, day(start_time) AS day,
       CASE WHEN isodow(start_time) - 1 IN (5, 6) THEN 1 ELSE 0 END AS is_weekend
FROM crashes""", ("crashes",))
def calendar_features(spark, d):
    return V.crashes(spark, d).select("id", *[v.alias(k) for k, v in T.calendar("start_time").items()])


@query("rush_hour_flag", """
SELECT id, CASE WHEN hour(start_time) BETWEEN 6 AND 9 OR hour(start_time) BETWEEN 16 AND 19 THEN 1 ELSE 0 END AS is_rush_hour
FROM crashes""", ("crashes",))
def rush_hour_flag(spark, d):
    return V.crashes(spark, d).select("id", T.rush_hour(F.hour("start_time")).alias("is_rush_hour"))


@query("time_of_day_category", """
SELECT id, CASE WHEN h >= 6 AND h < 10 THEN 'Morning Rush (6-10am)' WHEN h >= 10 AND h < 16 THEN 'Midday (10am-4pm)'
                WHEN h >= 16 AND h < 20 THEN 'Evening Rush (4-8pm)' ELSE 'Night (8pm-6am)' END AS time_category
FROM (SELECT id, hour(start_time) AS h FROM crashes)""", ("crashes",))
def time_of_day_category(spark, d):
    return V.crashes(spark, d).select("id", T.time_of_day_category(F.hour("start_time")).alias("time_category"))


WEATHER_SQL = """CASE WHEN w IS NULL THEN 'clear'
  WHEN contains(w, 'rain') OR contains(w, 'drizzle') OR contains(w, 'shower') THEN 'rain'
  WHEN contains(w, 'snow') OR contains(w, 'sleet') OR contains(w, 'ice') OR contains(w, 'hail') THEN 'snow'
  WHEN contains(w, 'fog') OR contains(w, 'mist') THEN 'fog'
  WHEN contains(w, 'cloud') OR contains(w, 'overcast') THEN 'cloudy' ELSE 'clear' END"""


@query("weather_category", f"""
SELECT id, weather_category, CASE WHEN weather_category IN ('rain', 'snow', 'fog') THEN 1 ELSE 0 END AS adverse_weather,
       CASE WHEN visibility_mi < 2 THEN 1 ELSE 0 END AS low_visibility
FROM (SELECT id, visibility_mi, {WEATHER_SQL} AS weather_category FROM (SELECT *, lower(weather_condition) AS w FROM crashes))
""", ("crashes",))
def weather_category(spark, d):
    c = V.crashes(spark, d).withColumn("weather_category", E.weather_category("weather_condition"))
    return c.select("id", "weather_category", E.adverse_weather("weather_category").alias("adverse_weather"),
                    E.low_visibility("visibility_mi").alias("low_visibility"))


@query("severity_target", """
SELECT id, CASE WHEN year(start_time) < 1998 THEN (severity >= 3) ELSE (severity >= 4) END::INT AS high_severity
FROM crashes""", ("crashes",))
def severity_target(spark, d):
    """E10 with a year-dependent threshold (pivot year 1998 in the test
    views so both branches fire)."""
    c = V.crashes(spark, d)
    return c.select("id", E.severity_target("severity", F.year("start_time"), 3, 4, 1998).alias("high_severity"))


@query("membership_flag", """
SELECT id, CASE WHEN city IN ('BUILDING', 'MACHINERY') THEN 1 ELSE 0 END AS is_major_city FROM crashes""", ("crashes",))
def membership_flag(spark, d):
    return V.crashes(spark, d).select("id", E.membership_flag("city", ["BUILDING", "MACHINERY"]).alias("is_major_city"))


@query("notnull_flag", """
SELECT id, CASE WHEN junction IS NOT NULL THEN 1 ELSE 0 END AS is_junction,
       CASE WHEN junction THEN 1 ELSE 0 END AS is_junction_true FROM crashes""", ("crashes",))
def notnull_flag(spark, d):
    return V.crashes(spark, d).select("id", E.notnull_flag("junction").alias("is_junction"),
                                      E.notnull_flag("junction", "true").alias("is_junction_true"))


def _cut_sql(col: str, edges, labels, na: str | None = None) -> str:
    na_sql = "NULL" if na is None else f"'{na}'"
    parts = []
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = [f"{col} IS NOT NULL" if lo == float("-inf") else f"{col} > {lo}"]
        if hi != float("inf"):
            cond.append(f"{col} <= {hi}")
        parts.append(f"WHEN {' AND '.join(cond)} THEN '{lab}'")
    return f"CASE WHEN {col} IS NULL OR isnan({col}) THEN {na_sql} {' '.join(parts)} ELSE {na_sql} END"


@query("bin_right_closed", f"""
SELECT id, {_cut_sql('temperature_f', *TRAINING['temp'])} AS temp_category,
       {_cut_sql('visibility_mi', [0, 2, 5, 10], ['poor', 'moderate', 'good'], 'unknown')} AS visibility_category
FROM crashes""", ("crashes",))
def bin_right_closed_q(spark, d):
    """L1 (Q1): right-closed bins, lowest edge excluded (visibility 0 falls
    outside and gets the na label)."""
    c = V.crashes(spark, d)
    return c.select("id", bin_right_closed("temperature_f", *TRAINING["temp"]).alias("temp_category"),
                    bin_right_closed("visibility_mi", [0, 2, 5, 10], ["poor", "moderate", "good"], "unknown")
                    .alias("visibility_category"))


@query("grid_zones", f"""
SELECT id, lat_zone, lng_zone, lat_zone || '_' || lng_zone AS region FROM (
  SELECT id, {_cut_sql('lat', *TRAINING['lat'], 'unknown')} AS lat_zone,
         {_cut_sql('lng', *TRAINING['lng'], 'unknown')} AS lng_zone FROM crashes)""", ("crashes",))
def grid_zones(spark, d):
    """F13 + E24: lat/lng zones (right-closed) and the combined region."""
    c = V.crashes(spark, d)
    z = c.select("id", bin_right_closed("lat", *TRAINING["lat"], na_label="unknown").alias("lat_zone"),
                 bin_right_closed("lng", *TRAINING["lng"], na_label="unknown").alias("lng_zone"))
    return z.withColumn("region", E.concat_region("lat_zone", "lng_zone"))


# --------------------------------------------------------------- C*

@query("filter_year_range", """
SELECT id, start_time FROM crashes WHERE year(start_time) BETWEEN 1996 AND 1998""", ("crashes",))
def filter_year_range(spark, d):
    return C.filter_years(V.crashes(spark, d), "start_time", 1996, 1998).select("id", "start_time")


@query("filter_ts_range", """
SELECT id, start_time FROM crashes WHERE start_time BETWEEN TIMESTAMP '1997-03-01 00:00:00' AND TIMESTAMP '1997-06-30 00:00:00'
""", ("crashes",))
def filter_ts_range(spark, d):
    """C2 (Q6): the end day is compared at its midnight."""
    import datetime as dt
    return C.filter_between(V.crashes(spark, d), "start_time", dt.datetime(1997, 3, 1),
                            dt.datetime(1997, 6, 30)).select("id", "start_time")


@query("filter_equals", "SELECT id, county FROM crashes WHERE county = 'NATION_7'", ("crashes",))
def filter_equals(spark, d):
    return C.filter_equals(V.crashes(spark, d), "county", "NATION_7").select("id", "county")


@query("require_not_null", """
SELECT id, temperature_f, visibility_mi FROM crashes WHERE temperature_f IS NOT NULL AND visibility_mi IS NOT NULL""",
       ("crashes",))
def require_not_null(spark, d):
    return C.require_not_null(V.crashes(spark, d), ["temperature_f", "visibility_mi"]).select(
        "id", "temperature_f", "visibility_mi")


@query("active_at", """
SELECT road_event_id, start_date, end_date FROM workzones
WHERE start_date <= DATE '1998-06-15' AND end_date >= DATE '1998-06-15'""", ("workzones",))
def active_at(spark, d):
    import datetime as dt
    return C.active_at(V.workzones(spark, d), "start_date", "end_date", dt.date(1998, 6, 15)).select(
        "road_event_id", "start_date", "end_date")


@query("filter_bbox", """
SELECT id, lat, lng FROM crashes WHERE lat BETWEEN 29 AND 31 AND lng BETWEEN -100 AND -97""", ("crashes",))
def filter_bbox(spark, d):
    return C.filter_bbox(V.crashes(spark, d), "lng", "lat", -100, 29, -97, 31).select("id", "lat", "lng")


@query("filter_bbox_open", """
SELECT id, lat, lng FROM crashes WHERE lat > 29 AND lat < 31 AND lng > -100 AND lng < -97""", ("crashes",))
def filter_bbox_open(spark, d):
    return C.filter_bbox(V.crashes(spark, d), "lng", "lat", -100, 29, -97, 31, inclusive=False).select(
        "id", "lat", "lng")


@query("drop_columns_if_present", """
SELECT id, start_time, lat, lng, x, y, county, city, weather_condition, temperature_f, visibility_mi, junction FROM crashes
""", ("crashes",))
def drop_columns_if_present(spark, d):
    """Leakage columns removed; ``end_time``/``end_lat`` are absent and ignored."""
    return C.drop_columns_if_present(V.crashes(spark, d), ["severity", "end_time", "end_lat", "end_lng"])


@query("select_existing", """
SELECT id, county AS county_name, city AS city_name FROM crashes""", ("crashes",))
def select_existing(spark, d):
    c = C.select_existing(V.crashes(spark, d), ["id", "county", "city", "state", "zipcode"])
    return C.rename_existing(c, {"county": "county_name", "city": "city_name", "state": "state_code"})


@query("lowercase_columns", """
SELECT o_orderkey AS orderkey, o_orderpriority AS priority FROM orders""")
def lowercase_columns(spark, d):
    o = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("OrderKey"),
                                              F.col("o_orderpriority").alias("PRIORITY"))
    return C.lowercase_columns(o)


@query("select_numeric", """
SELECT severity, lat, lng, x, y, temperature_f, visibility_mi FROM crashes""", ("crashes",))
def select_numeric(spark, d):
    return C.select_numeric(V.crashes(spark, d), exclude=["id"])


@query("isin_filter", """
SELECT id, county FROM crashes WHERE county IN (
  SELECT county FROM crashes WHERE county IS NOT NULL GROUP BY county ORDER BY count(*) DESC, county LIMIT 5)
""", ("crashes",))
def isin_filter(spark, d):
    return C.isin_filter(V.crashes(spark, d), "county", 5).select("id", "county")


@query("scan_columns", "SELECT l_orderkey, l_quantity FROM lineitem")
def scan_columns(spark, d):
    """Two-column projection; only these columns reach the parquet
    ReadSchema."""
    return read_table(spark, d, "lineitem").select("l_orderkey", "l_quantity")


@query("scan_head", """
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100""")
def scan_head(spark, d):
    """First N rows under an explicit order (the feature is the limit)."""
    return (read_table(spark, d, "orders").select("o_orderkey", "o_orderdate")
            .orderBy("o_orderdate", "o_orderkey").limit(100))


# --------------------------------------------------------------- D*

@query("to_numeric_null_token", """
SELECT segment_id, speed_limit AS speed_limit_text, TRY_CAST(nullif(trim(speed_limit), 'NULL') AS DOUBLE) AS speed_limit
FROM segments""", ("segments",))
def to_numeric_null_token(spark, d):
    s = V.segments(spark, d)
    return s.select("segment_id", F.col("speed_limit").alias("speed_limit_text"),
                    D.to_numeric_null_token("speed_limit").alias("speed_limit"))


def _event_text_spark(spark, d):
    e = read_table(spark, d, "events")
    n = F.floor(F.col("value") * 100).cast("bigint").cast("string")
    k = F.col("event_id") % 5
    txt = (F.when(k == 0, F.concat(F.lit("−"), n)).when(k == 1, F.concat(n, F.lit("abc")))
           .when(k == 2, F.concat(F.lit(" "), n, F.lit(" "))).when(k == 3, F.concat(F.lit("["), n, F.lit("E-2]")))
           .otherwise(F.lit("NULL")))
    return e.select("event_id", "ts", "value", txt.alias("txt"))


EVENT_TEXT_SQL = """
SELECT event_id, ts, value,
  CASE event_id % 5 WHEN 0 THEN '−' || n WHEN 1 THEN n || 'abc' WHEN 2 THEN ' ' || n || ' '
                    WHEN 3 THEN '[' || n || 'E-2]' ELSE 'NULL' END AS txt
FROM (SELECT *, CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) AS n FROM events)"""


@query("to_timestamp_coerce", """
SELECT event_id, try_strptime(txt, '%Y-%m-%d %H:%M') AS parsed FROM (
  SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'not a time' ELSE strftime(ts, '%Y-%m-%d %H:%M') END AS txt FROM events)
""")
def to_timestamp_coerce(spark, d):
    e = read_table(spark, d, "events")
    txt = F.when(F.col("event_id") % 17 == 0, F.lit("not a time")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm"))
    return e.select("event_id", D.to_timestamp_coerce(txt, "yyyy-MM-dd HH:mm").cast("timestamp_ntz").alias("parsed"))


@query("strip_brackets_to_number", """
SELECT crash_id, TRY_CAST(trim(regexp_replace(visibility_txt, '[\\[\\]]', '', 'g')) AS DOUBLE) AS visibility_mi
FROM wzcrash""", ("wzcrash",))
def strip_brackets_to_number(spark, d):
    w = V.wzcrash(spark, d)
    return w.select("crash_id", D.strip_brackets_to_number("visibility_txt").alias("visibility_mi"))


@query("scrub_numeric_text", f"""
WITH t AS ({EVENT_TEXT_SQL})
SELECT event_id, TRY_CAST(regexp_replace(replace(txt, '−', '-'), '[^0-9.\\-Ee]', '', 'g') AS DOUBLE) AS number,
       coalesce(TRY_CAST(txt AS DOUBLE), -1.0) AS safe_number
FROM t""")
def scrub_numeric_text(spark, d):
    """D4 and D5 on the same messy text column."""
    t = _event_text_spark(spark, d)
    return t.select("event_id", D.scrub_numeric_text("txt").alias("number"),
                    D.safe_number("txt", -1.0).alias("safe_number"))


@query("normalise_key", "SELECT road_event_id, upper(trim(county_name)) AS county_key FROM workzones", ("workzones",))
def normalise_key(spark, d):
    return V.workzones(spark, d).select("road_event_id", D.normalise_key("county_name").alias("county_key"))


@query("fill_category", "SELECT id, coalesce(weather_condition, 'missing') AS weather_condition FROM crashes",
       ("crashes",))
def fill_category(spark, d):
    return V.crashes(spark, d).select("id", D.fill_category("weather_condition").alias("weather_condition"))


@query("finite_or", """
SELECT event_id, CASE WHEN isinf(v) OR isnan(v) THEN 0.0 ELSE v END AS v
FROM (SELECT event_id, pow(CAST(event_id % 3 AS DOUBLE), -1.0) AS v FROM events)""")
def finite_or(spark, d):
    e = read_table(spark, d, "events")
    v = F.pow((F.col("event_id") % 3).cast("double"), F.lit(-1.0))
    return e.select("event_id", D.finite_or(v, 0.0).alias("v"))


@query("map_codes", """
SELECT road_event_id, CAST(coalesce(CASE vehicle_impact WHEN 'all-lanes-closed' THEN 3.0 WHEN 'some-lanes-closed' THEN 2.0
  WHEN 'all-lanes-open' THEN 1.0 WHEN 'alternating-one-way-traffic' THEN 2.5 WHEN 'unknown' THEN 1.5 END, 1.5) AS DOUBLE) AS weight
FROM workzones""", ("workzones",))
def map_codes(spark, d):
    return V.workzones(spark, d).select("road_event_id", D.map_codes("vehicle_impact", E.VEHICLE_IMPACT_WEIGHT,
                                                                     E.DEFAULT_IMPACT_WEIGHT).alias("weight"))


@query("unit_convert", """
SELECT event_id, round_even(p / 10, 6) AS precipitation_mm,
       round_even(t / 10, 6) AS temp_max_c, round_even(t / 10 * 9 / 5 + 32, 6) AS temp_max_f,
       round_even(lo / 10, 6) AS temp_min_c, round_even(lo / 10 * 9 / 5 + 32, 6) AS temp_min_f,
       round_even(av / 10, 6) AS temp_avg_c, round_even(av / 10 * 9 / 5 + 32, 6) AS temp_avg_f,
       round_even(w / 10, 6) AS wind_speed_ms, round_even(w / 10 * 2.237, 6) AS wind_speed_mph
FROM (SELECT event_id, TRY_CAST(CAST(user_id AS VARCHAR) AS DOUBLE) AS p,
             TRY_CAST(CAST(CAST(floor(value * 10) AS BIGINT) - 100 AS VARCHAR) AS DOUBLE) AS t,
             TRY_CAST(CAST(CAST(floor(value * 10) AS BIGINT) - 150 AS VARCHAR) AS DOUBLE) AS lo,
             CASE WHEN event_id % 3 > 0 THEN CAST(event_id % 400 AS DOUBLE) END AS av,
             TRY_CAST(CAST(event_id % 150 AS VARCHAR) AS DOUBLE) AS w FROM events)""")
def unit_convert(spark, d):
    e = read_table(spark, d, "events")
    prcp = F.col("user_id").cast("string")
    tmax = (F.floor(F.col("value") * 10).cast("bigint") - 100).cast("string")
    awnd = (F.col("event_id") % 150).cast("string")
    tmin = (F.floor(F.col("value") * 10).cast("bigint") - 150).cast("string")
    tavg = F.when(F.col("event_id") % 3 > 0, (F.col("event_id") % 400).cast("string")).otherwise("n/a")  # some are no numbers
    u = D.unit_convert(prcp, tmax, tmin, tavg, awnd)
    return e.select("event_id", *[r6(c).alias(n) for n, c in u.items()])


# --------------------------------------------------------------- E4, E13-E25

@query("duration_days", """
SELECT road_event_id, CAST(floor((epoch_us(end_ts) - epoch_us(start_ts)) / 86400000000) AS BIGINT) AS duration_days,
       date_diff('day', start_date, end_date) AS calendar_days
FROM workzones""", ("workzones",))
def duration_days(spark, d):
    w = V.workzones(spark, d)
    return w.select("road_event_id", T.duration_days("end_ts", "start_ts").alias("duration_days"),
                    F.datediff("end_date", "start_date").alias("calendar_days"))


@query("interaction_features", """
SELECT segment_id, sp * aadt AS speed_x_aadt, f_system * urban_id AS fsystem_x_urban,
       f_system * CASE WHEN urban_id > 0 THEN 1 ELSE 0 END AS fsystem_x_urban_flag, through_lanes * aadt AS lanes_x_aadt
FROM (SELECT *, TRY_CAST(nullif(trim(speed_limit), 'NULL') AS DOUBLE) AS sp FROM segments)""", ("segments",))
def interaction_features(spark, d):
    """E13 (Q16): training product and the serving 0/1-flag product."""
    s = V.segments(spark, d).withColumn("sp", D.to_numeric_null_token("speed_limit"))
    tr = E.interaction_features("sp", "aadt", "f_system", "urban_id", "through_lanes")
    sv = E.interaction_features("sp", "aadt", "f_system", "urban_id", "through_lanes", profile="serving")
    return s.select("segment_id", tr["speed_x_aadt"].alias("speed_x_aadt"),
                    tr["fsystem_x_urban"].alias("fsystem_x_urban"),
                    sv["fsystem_x_urban"].alias("fsystem_x_urban_flag"), tr["lanes_x_aadt"].alias("lanes_x_aadt"))


RULE_SQL = """CAST(least(greatest(
    CASE WHEN adverse_weather = 1 THEN CAST(0.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END + CASE WHEN low_visibility = 1 THEN CAST(0.20 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
  + CASE WHEN hour >= 22 OR hour <= 4 THEN CAST(0.15 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END + CASE WHEN is_rush_hour = 1 THEN CAST(0.10 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
  + CASE WHEN is_weekend = 1 AND (hour >= 22 OR hour <= 4) THEN CAST(0.15 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
  + CASE WHEN coalesce(speed, 0) > 65 THEN CAST(0.15 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END + CASE WHEN coalesce(aadt, 0) > 50000 THEN CAST(0.10 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END, 0), 1) AS DOUBLE)"""

CRASH_FEATURE_SQL = f"""
SELECT id, hour, is_weekend, visibility_mi,
       CASE WHEN hour BETWEEN 6 AND 9 OR hour BETWEEN 16 AND 19 THEN 1 ELSE 0 END AS is_rush_hour,
       CASE WHEN weather_category IN ('rain', 'snow', 'fog') THEN 1 ELSE 0 END AS adverse_weather,
       CASE WHEN visibility_mi < 2 THEN 1 ELSE 0 END AS low_visibility,
       CAST(15 + 5 * (id % 15) AS DOUBLE) AS speed, CAST((id * 613) % 120000 AS DOUBLE) AS aadt
FROM (SELECT id, visibility_mi, hour(start_time) AS hour,
             CASE WHEN isodow(start_time) - 1 IN (5, 6) THEN 1 ELSE 0 END AS is_weekend,
             {WEATHER_SQL} AS weather_category FROM (SELECT *, lower(weather_condition) AS w FROM crashes))"""


def crash_rule_inputs(spark, d):
    """Per-crash inputs of the rule score; road speed/aadt stand-ins are
    derived from the crash key (the road join is exercised elsewhere)."""
    c = V.crashes(spark, d)
    cal = T.calendar("start_time")
    wc = E.weather_category("weather_condition")
    return c.select(
        "id", cal["hour"].alias("hour"), cal["is_weekend"].alias("is_weekend"), "visibility_mi",
        T.rush_hour(cal["hour"]).alias("is_rush_hour"), E.adverse_weather(wc).alias("adverse_weather"),
        E.low_visibility("visibility_mi").alias("low_visibility"),
        (F.lit(15) + 5 * (F.col("id") % 15)).cast("double").alias("speed"),
        ((F.col("id") * 613) % 120000).cast("double").alias("aadt"))


@query("rule_severity_score", f"""
SELECT id, round_even({RULE_SQL}, 6) AS risk_score FROM ({CRASH_FEATURE_SQL})""", ("crashes",))
def rule_severity_score(spark, d):
    f = crash_rule_inputs(spark, d)
    s = E.rule_severity_score("adverse_weather", "low_visibility", "hour", "is_rush_hour", "is_weekend",
                              "speed", "aadt")
    return f.select("id", r6(s).alias("risk_score"))


@query("rule_segment_risk", """
SELECT segment_id, round_even(greatest(coalesce(sp, 0) / 10 * 0.3 + coalesce(aadt, 0) / 10000 * 0.4
                                       + coalesce(through_lanes, 0) * 0.3, 0), 6) AS predicted_crashes
FROM (SELECT *, TRY_CAST(nullif(trim(speed_limit), 'NULL') AS DOUBLE) AS sp FROM segments)""", ("segments",))
def rule_segment_risk(spark, d):
    s = V.segments(spark, d).withColumn("sp", D.to_numeric_null_token("speed_limit"))
    return s.select("segment_id", r6(E.rule_segment_risk("sp", "aadt", "through_lanes")).alias("predicted_crashes"))


@query("score_to_decision", """
SELECT id, CASE WHEN p >= 0.45 THEN 'HIGH' ELSE 'LOW' END AS prediction,
       CASE WHEN p > 0.70 THEN 'HIGH' WHEN p >= 0.40 THEN 'MEDIUM' ELSE 'LOW' END AS dispatch_tier
FROM scored""", ("scored",))
def score_to_decision(spark, d):
    s = V.scored(spark, d)
    dec = E.score_to_decision("p", 0.45)
    return s.select("id", dec["prediction"].alias("prediction"), dec["dispatch_tier"].alias("dispatch_tier"))


@query("segment_tier", """
SELECT segment_id, CASE WHEN yhat >= 3 THEN 'High' WHEN yhat >= 1 THEN 'Medium' ELSE 'Low' END AS tier FROM counts""",
       ("counts",))
def segment_tier(spark, d):
    return V.counts(spark, d).select("segment_id", E.segment_tier("yhat").alias("tier"))


SERVING_SQL = """
SELECT id, hour, temperature_f, visibility_mi, start_lat, start_lng, hpms_speed_limit, hpms_lanes,
  day_of_week, month, is_weekend, is_junction, aadt, aadt AS hpms_aadt, CAST(adverse_weather AS DOUBLE) AS adverse_weather, CAST(low_visibility AS DOUBLE) AS low_visibility, fc AS hpms_functional_class,
  lat_zone, lng_zone, coalesce(size, 'medium') AS city_size_category, coalesce(county, 'other') AS county_top20,
  CASE WHEN urban > 0 OR coalesce(size, '') = 'large' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_urban,
  0.0::DOUBLE AS is_rush_hour, 30.0::DOUBLE AS pressure_in, 60.0::DOUBLE AS humidity_pct, 5.0::DOUBLE AS wind_speed_mph, 0.0::DOUBLE AS is_major_city,
  0.5::DOUBLE AS distance_mi, 50.0::DOUBLE AS distance_to_aadt_m, 50.0::DOUBLE AS hpms_distance_m,
  CASE WHEN adverse_weather = 1 THEN 'rain' WHEN low_visibility = 1 THEN 'fog' ELSE 'clear' END AS weather_category,
  CASE WHEN temperature_f < 32 THEN 'freezing' WHEN temperature_f < 50 THEN 'cold' WHEN temperature_f < 70 THEN 'mild'
       WHEN temperature_f < 85 THEN 'warm' ELSE 'hot' END AS temp_category,
  lat_zone || '_' || lng_zone AS region,
  CASE WHEN hpms_speed_limit < 35 THEN 'low' WHEN hpms_speed_limit < 50 THEN 'medium' WHEN hpms_speed_limit < 65 THEN 'high'
       ELSE 'highway' END AS speed_category,
  CASE WHEN hpms_lanes <= 1 THEN 'narrow' WHEN hpms_lanes <= 3 THEN 'standard' ELSE 'wide' END AS lane_category,
  CASE WHEN floor(fc) <= 1 THEN 'interstate' WHEN floor(fc) <= 3 THEN 'principal_arterial'
       WHEN floor(fc) <= 5 THEN 'minor_arterial' ELSE 'collector' END AS road_class
FROM (SELECT *,
  CASE WHEN start_lat < 29 THEN 'south' WHEN start_lat < 31 THEN 'south_central' WHEN start_lat < 33 THEN 'central'
       ELSE 'north' END AS lat_zone,
  CASE WHEN start_lng < -100 THEN 'west' WHEN start_lng < -98 THEN 'west_central' WHEN start_lng < -96 THEN 'central'
       ELSE 'east' END AS lng_zone
  FROM (SELECT id, coalesce(CAST(hour(start_time) AS DOUBLE), 12.0) AS hour,
               coalesce(temperature_f, 70.0) AS temperature_f, coalesce(visibility_mi, 10.0) AS visibility_mi,
               CASE WHEN weather_condition IN ('Light Rain', 'Heavy Snow', 'Fog') THEN 1.0 ELSE 0.0 END AS adverse_weather,
               CASE WHEN visibility_mi < 2 THEN 1.0 ELSE 0.0 END AS low_visibility,
               lat AS start_lat, lng AS start_lng,
               CASE WHEN id % 5 = 0 THEN 45.0 ELSE CAST(15 + 5 * (id % 15) AS DOUBLE) END AS hpms_speed_limit,
               CASE WHEN id % 4 = 0 THEN 2.0 ELSE CAST(id % 7 AS DOUBLE) END AS hpms_lanes,
               CASE WHEN id % 6 = 0 THEN 1.0 ELSE CAST(1 + id % 7 AS DOUBLE) END AS fc,
               CAST(isodow(start_time) - 1 AS DOUBLE) AS day_of_week, CAST(month(start_time) AS DOUBLE) AS month,
               CASE WHEN isodow(start_time) >= 6 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_weekend,
               CASE WHEN junction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_junction,
               CASE WHEN id % 8 = 0 THEN 15000.0 ELSE CAST(id % 50000 AS DOUBLE) END AS aadt,
               CASE id % 3 WHEN 0 THEN 'large' WHEN 1 THEN 'small' END AS size, CASE WHEN id % 5 > 0 THEN id % 5 - 2 END AS urban,
               CASE WHEN id % 7 > 0 THEN county END AS county
        FROM crashes))"""


@query("serving_features", SERVING_SQL, ("crashes",))
def serving_features(spark, d):
    """E22 re-aimed: a table of raw requests (some fields missing) -> model
    features with the serving defaults and serving bins (Q15)."""
    c = V.crashes(spark, d)
    k = F.col("id")
    req = c.select(
        "id", F.hour("start_time").alias("hour"), F.col("temperature_f").alias("temperature"),
        F.col("visibility_mi").alias("visibility"),
        F.when(F.col("weather_condition").isin("Light Rain", "Heavy Snow", "Fog"), 1).otherwise(0).alias("adverse"),
        F.when(F.col("visibility_mi") < 2, 1).otherwise(0).alias("lowvis"), "lat", "lng",
        F.when(k % 5 == 0, F.lit(None)).otherwise(15 + 5 * (k % 15)).alias("speed_limit"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(k % 7).alias("through_lanes"),
        F.when(k % 6 == 0, F.lit(None)).otherwise(1 + k % 7).alias("f_system"),
        F.weekday("start_time").alias("day_of_week"), F.month("start_time").alias("month"), (F.weekday("start_time") >= 5).cast("int").alias("is_weekend"),
        F.col("junction").cast("int").alias("is_junction"), F.when(k % 8 > 0, k % 50000).alias("aadt"),
        F.when(k % 3 == 0, "large").when(k % 3 == 1, "small").alias("city_size_category"), F.when(k % 5 > 0, k % 5 - 2).alias("urban_id"),
        F.when(k % 7 > 0, F.col("county")).alias("county"))
    cols = {n: F.col(n) for n in ("hour", "temperature", "visibility", "lat", "lng", "speed_limit",
                                  "through_lanes", "f_system", "day_of_week", "month", "is_weekend", "is_junction", "aadt",
                                  "city_size_category", "urban_id", "county")}
    cols["adverse_weather"], cols["low_visibility"] = F.col("adverse"), F.col("lowvis")
    f = E.serving_features(cols)
    return req.select("id", *[c_.alias(n) for n, c_ in f.items()])


@query("serving_segment_features", """
SELECT segment_id, sp * a AS speed_x_aadt, fs * CASE WHEN u > 0 THEN 1 ELSE 0 END AS fsystem_x_urban, ln * a AS lanes_x_aadt
FROM (SELECT segment_id, coalesce(TRY_CAST(speed_limit AS DOUBLE), 30.0) AS sp, CAST(aadt AS DOUBLE) AS a,
             CAST(f_system AS DOUBLE) AS fs, CAST(urban_id AS DOUBLE) AS u, CAST(through_lanes AS DOUBLE) AS ln
      FROM segments)""", ("segments",))
def serving_segment_features(spark, d):
    s = V.segments(spark, d)
    f = E.serving_segment_features({k: F.col(k) for k in ("speed_limit", "through_lanes", "f_system",
                                                          "urban_id", "aadt")})
    return s.select("segment_id", *[f[k].alias(k) for k in ("speed_x_aadt", "fsystem_x_urban", "lanes_x_aadt")])


@query("what_if_variants", f"""
SELECT id, step, round_even({RULE_SQL.replace('low_visibility = 1', 'vis_low = 1')}, 6) AS risk_score
FROM (SELECT *, CASE WHEN visibility_mi * (1 + step / 100.0) < 2 THEN 1 ELSE 0 END AS vis_low
      FROM ({CRASH_FEATURE_SQL}), range(-10, 11) t(step))""", ("crashes",))
def what_if_variants(spark, d):
    """One-way sensitivity of the rule score to visibility over a
    21-step +-10 % grid. The grid is a generator (``explode(sequence)``) on
    each row, not a join."""
    f = crash_rule_inputs(spark, d).withColumn("step", F.explode(F.sequence(F.lit(-10), F.lit(10))))
    vis_low = E.low_visibility(F.col("visibility_mi") * (1 + F.col("step") / 100.0))
    s = E.rule_severity_score("adverse_weather", vis_low, "hour", "is_rush_hour", "is_weekend", "speed", "aadt")
    return f.select("id", F.col("step").cast("bigint").alias("step"), r6(s).alias("risk_score"))
