"""End-to-end builds (X1 flagship, X2, X6, X7, X8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import testviews as V
from ..functions.binning import TRAINING
from ..plans import builds as X
from .base import query, r6
from .scalars import WEATHER_SQL, _cut_sql
from .spatial import D2, PIECE_D, PIECE_T

CRASH_OUT = ["id", "split", "high_severity", "start_time", "hour", "day_of_week", "month", "is_weekend",
             "is_rush_hour", "weather_category", "adverse_weather", "low_visibility", "temperature_f",
             "visibility_mi", "temp_category", "lat_zone", "lng_zone", "region", "is_major_city",
             "city_size_category", "county_top20", "is_junction", "hpms_segment_id", "hpms_distance_m",
             "hpms_speed_limit", "hpms_lanes", "hpms_functional_class", "hpms_aadt", "speed_category",
             "lane_category", "road_class", "aadt", "distance_to_aadt_m"]

CRASH_TABLE_SQL = f"""
WITH c0 AS (SELECT * FROM crashes WHERE year(start_time) BETWEEN 1995 AND 2001),
pc AS (SELECT c.id, p.segment_id, px, py, ax, ay, bx, b_y
       FROM (SELECT id, x AS px, y AS py FROM c0) c, segment_pieces p),
pd AS (SELECT id, segment_id, {PIECE_D} AS d FROM (SELECT *, {PIECE_T} AS t FROM pc)),
ps AS (SELECT id, segment_id, min(d) AS d FROM pd WHERE d <= 100 GROUP BY id, segment_id),
road AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round_even(d, 6), segment_id) AS rn FROM ps) WHERE rn = 1),
seg AS (SELECT segment_id, TRY_CAST(nullif(trim(speed_limit), 'NULL') AS DOUBLE) AS hpms_speed_limit,
               CAST(through_lanes AS DOUBLE) AS hpms_lanes, f_system AS hpms_functional_class, CAST(aadt AS DOUBLE) AS hpms_aadt
        FROM segments),
sp AS (SELECT c.id, s.statn_id, s.aadt, {D2.format(a='c', b='s')} AS d FROM c0 c, stations s),
st AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round_even(d, 6), statn_id) AS rn FROM sp) WHERE rn = 1),
top AS (SELECT county FROM c0 WHERE county IS NOT NULL GROUP BY county ORDER BY count(*) DESC, county LIMIT 20),
cs AS (SELECT city, count(*) AS n FROM c0 WHERE city IS NOT NULL GROUP BY city),
t AS (
  SELECT c0.id, c0.start_time, CASE WHEN severity >= 3 THEN 1 ELSE 0 END AS high_severity,
         hour(start_time) AS hour, isodow(start_time) - 1 AS day_of_week, month(start_time) AS month,
         CASE WHEN isodow(start_time) - 1 IN (5, 6) THEN 1 ELSE 0 END AS is_weekend,
         temperature_f, visibility_mi, lat, lng, junction, c0.city, c0.county,
         {WEATHER_SQL.replace('w ', 'lower(weather_condition) ').replace('(w,', '(lower(weather_condition),')} AS weather_category,
         road.segment_id AS hpms_segment_id, round_even(road.d, 3) AS hpms_distance_m,
         hpms_speed_limit, hpms_lanes, hpms_functional_class, hpms_aadt,
         st.aadt, round_even(st.d, 3) AS distance_to_aadt_m,
         coalesce(top.county, 'other') AS county_top20, coalesce(cs.n, 0) AS city_n
  FROM c0 LEFT JOIN road ON c0.id = road.id LEFT JOIN seg ON road.segment_id = seg.segment_id
       LEFT JOIN st ON c0.id = st.id LEFT JOIN top ON c0.county = top.county LEFT JOIN cs ON c0.city = cs.city)
SELECT id, split, high_severity, start_time, hour, day_of_week, month, is_weekend,
       CASE WHEN hour BETWEEN 6 AND 9 OR hour BETWEEN 16 AND 19 THEN 1 ELSE 0 END AS is_rush_hour,
       weather_category, CASE WHEN weather_category IN ('rain', 'snow', 'fog') THEN 1 ELSE 0 END AS adverse_weather,
       CASE WHEN visibility_mi < 2 THEN 1 ELSE 0 END AS low_visibility, temperature_f, visibility_mi,
       {_cut_sql('temperature_f', *TRAINING['temp'])} AS temp_category, lat_zone, lng_zone, lat_zone || '_' || lng_zone AS region,
       CASE WHEN city IN ('Houston', 'Dallas', 'Austin', 'San Antonio', 'Fort Worth', 'El Paso') THEN 1 ELSE 0 END AS is_major_city,
       CASE WHEN city_n > 1000 THEN 'large' WHEN city_n > 100 THEN 'medium' ELSE 'small' END AS city_size_category,
       county_top20, CASE WHEN junction IS NOT NULL THEN 1 ELSE 0 END AS is_junction,
       hpms_segment_id, hpms_distance_m, hpms_speed_limit, hpms_lanes, hpms_functional_class, hpms_aadt,
       {_cut_sql('hpms_speed_limit', *TRAINING['speed'], 'unknown')} AS speed_category,
       {_cut_sql('hpms_lanes', *TRAINING['lanes'], 'unknown')} AS lane_category,
       coalesce(CAST(hpms_functional_class AS VARCHAR), 'unknown') AS road_class, aadt, distance_to_aadt_m
FROM (SELECT *, {_cut_sql('lat', *TRAINING['lat'], 'unknown')} AS lat_zone, {_cut_sql('lng', *TRAINING['lng'], 'unknown')} AS lng_zone,
             CASE WHEN start_time BETWEEN TIMESTAMP '1995-01-01 00:00:00' AND TIMESTAMP '1998-12-31 23:59:59' THEN 'train'
                  WHEN start_time BETWEEN TIMESTAMP '1999-01-01 00:00:00' AND TIMESTAMP '1999-12-31 23:59:59' THEN 'val'
                  WHEN start_time BETWEEN TIMESTAMP '2000-01-01 00:00:00' AND TIMESTAMP '2000-12-31 23:59:59' THEN 'test' END AS split
      FROM t)
WHERE split IS NOT NULL"""


@query("build_crash_table", CRASH_TABLE_SQL, ("crashes", "segments", "segment_pieces", "stations"))
def build_crash_table(spark, d):
    """X1 (flagship): crash-level ML table."""
    t = X.build_crash_table(V.crashes(spark, d), V.segments(spark, d), V.stations(spark, d))
    t = t.withColumns({"hpms_distance_m": r6("hpms_distance_m", 3), "distance_to_aadt_m": r6("distance_to_aadt_m", 3)})
    return t.select(*CRASH_OUT)


SEGMENT_OUT = ["segment_id", "speed_limit_num", "through_lanes", "f_system", "urban_id", "aadt", "crash_count",
               "high_severity_count", "length_miles", "crash_rate_per_100m_vmt", "high_severity_rate_per_100m_vmt",
               "speed_x_aadt", "fsystem_x_urban", "lanes_x_aadt", "aadt_bin", "split"]

SEGMENT_TABLE_SQL = f"""
WITH c0 AS (SELECT id, x, y, CASE WHEN severity >= 3 THEN 1 ELSE 0 END AS high_severity FROM crashes
            WHERE year(start_time) BETWEEN 1995 AND 2001),
pc AS (SELECT c.id, p.segment_id, px, py, ax, ay, bx, b_y FROM (SELECT id, x AS px, y AS py FROM c0) c, segment_pieces p),
pd AS (SELECT id, segment_id, {PIECE_D} AS d FROM (SELECT *, {PIECE_T} AS t FROM pc)),
ps AS (SELECT id, segment_id, min(d) AS d FROM pd WHERE d <= 100 GROUP BY id, segment_id),
near AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY id ORDER BY round_even(d, 6)) AS rk FROM ps) WHERE rk = 1),
per AS (SELECT segment_id, count(*) AS crash_count, sum(high_severity) AS high_severity_count FROM near JOIN c0 USING (id)
        GROUP BY segment_id),
e AS (SELECT list_sort(list_distinct(quantile_cont(aadt, [0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS edges FROM segments),
s AS (SELECT seg.*, TRY_CAST(nullif(trim(speed_limit), 'NULL') AS DOUBLE) AS speed_limit_num,
             CAST(coalesce(crash_count, 0) AS BIGINT) AS crash_count, CAST(coalesce(high_severity_count, 0) AS BIGINT) AS high_severity_count,
             (0.0 + sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)) + sqrt(power(x2 - x1, 2) + power(y2 - y1, 2))) / 1609.34 AS length_miles,
             len(list_filter(edges[2:len(edges) - 1], lambda v: aadt > v)) AS aadt_bin
      FROM segments seg LEFT JOIN per USING (segment_id), e),
r AS (SELECT *, aadt * length_miles * 365 / 1e8 AS per100m,
             row_number() OVER (PARTITION BY f_system ORDER BY ((CAST(segment_id AS BIGINT) % 2147483629) * 1103515245) % 2147483629, segment_id) - 1 AS rk,
             count(*) OVER (PARTITION BY f_system) AS sz FROM s)
SELECT segment_id, speed_limit_num, through_lanes, f_system, urban_id, aadt, crash_count, high_severity_count,
       round_even(length_miles, 6) AS length_miles,
       round_even(coalesce(crash_count / nullif(per100m, 0), 0.0), 6) AS crash_rate_per_100m_vmt,
       round_even(coalesce(high_severity_count / nullif(per100m, 0), 0.0), 6) AS high_severity_rate_per_100m_vmt,
       speed_limit_num * aadt AS speed_x_aadt, f_system * urban_id AS fsystem_x_urban, through_lanes * aadt AS lanes_x_aadt,
       aadt_bin,
       CASE WHEN rk < floor(sz * 700000 / 1000000) THEN 'train' WHEN rk < floor(sz * 850000 / 1000000) THEN 'val' ELSE 'test' END AS split
FROM r"""


@query("build_segment_table", SEGMENT_TABLE_SQL, ("crashes", "segments", "segment_pieces"))
def build_segment_table(spark, d):
    """Segment-level ML table."""
    t = X.build_segment_table(V.segments(spark, d), V.crashes(spark, d))
    t = t.withColumns({c: r6(c) for c in ("length_miles", "crash_rate_per_100m_vmt", "high_severity_rate_per_100m_vmt")})
    return t.select(*SEGMENT_OUT)


COUNTY_RISK_SQL = """
WITH w AS (SELECT *, CAST(floor((epoch_us(end_ts) - epoch_us(start_ts)) / 86400000000) AS BIGINT) AS duration_days FROM workzones),
pe AS (SELECT w.road_event_id, e.county_id, e.county_name,
              CASE WHEN (e.ay > w.y) != (e.b_y > w.y) AND w.x < (e.bx - e.ax) * (w.y - e.ay) / (e.b_y - e.ay) + e.ax THEN 1 ELSE 0 END AS cr
       FROM w, county_edges e),
ins AS (SELECT road_event_id, county_id, county_name FROM pe GROUP BY ALL HAVING sum(cr) % 2 = 1),
best AS (SELECT road_event_id, min(county_id) AS county_id, arg_min(county_name, county_id) AS county_name FROM ins GROUP BY 1),
cs AS (SELECT county AS county_key, count(*) AS total_crashes,
              count(*) / nullif(floor((epoch_us(max(start_time)) - epoch_us(min(start_time))) / 86400000000), 0) AS crashes_per_day
       FROM crashes WHERE county IS NOT NULL GROUP BY county),
j AS (SELECT w.road_event_id, best.county_id, best.county_name, w.duration_days, cs.total_crashes, cs.crashes_per_day,
             cs.crashes_per_day * coalesce(CAST(w.duration_days AS DOUBLE), 30.0)
             * CAST(coalesce(CASE w.vehicle_impact WHEN 'all-lanes-closed' THEN 3.0 WHEN 'some-lanes-closed' THEN 2.0
                  WHEN 'all-lanes-open' THEN 1.0 WHEN 'alternating-one-way-traffic' THEN 2.5 WHEN 'unknown' THEN 1.5 END, 1.5) AS DOUBLE) AS score
      FROM w LEFT JOIN best USING (road_event_id) LEFT JOIN cs ON upper(trim(best.county_name)) = upper(trim(cs.county_key)))
SELECT road_event_id, county_id, county_name, duration_days, CAST(total_crashes AS BIGINT) AS total_crashes, round_even(crashes_per_day, 6) AS crashes_per_day,
       round_even(score, 6) AS work_zone_crash_risk_score,
       CASE WHEN score IS NULL OR isnan(score) THEN 'Unknown' WHEN score < 10 THEN 'Low' WHEN score < 50 THEN 'Medium'
            WHEN score < 100 THEN 'High' ELSE 'Very High' END AS risk_category
FROM j"""


@query("county_risk", COUNTY_RISK_SQL, ("workzones", "county_edges", "crashes"))
def county_risk(spark, d):
    """Work-zone risk from county crash statistics."""
    r = X.county_risk(V.workzones(spark, d), V.counties(spark, d), V.crashes(spark, d))
    return r.withColumns({"work_zone_crash_risk_score": r6("work_zone_crash_risk_score"),
                          "crashes_per_day": r6("crashes_per_day")})


LIGHT_SQL = """
WITH sun AS (SELECT * FROM suntimes WHERE day(date) <> 13),
j AS (SELECT c.id, c.start_time AS t, sun.* FROM crashes c LEFT JOIN sun
      ON round_even(c.lat, 1) = sun.lat_r AND round_even(c.lng, 1) = sun.lng_r AND CAST(c.start_time AS DATE) = sun.date),
k AS (SELECT id, t, sunrise, sunset,
  CASE WHEN sunrise IS NULL OR sunset IS NULL THEN 'unknown'
       WHEN sunrise <= t AND t <= sunset THEN 'daylight'
       WHEN civil_twilight_begin <= t AND t < sunrise THEN 'civil_twilight_dawn'
       WHEN sunset < t AND t <= civil_twilight_end THEN 'civil_twilight_dusk'
       WHEN nautical_twilight_begin <= t AND t < civil_twilight_begin THEN 'nautical_twilight_dawn'
       WHEN civil_twilight_end < t AND t <= nautical_twilight_end THEN 'nautical_twilight_dusk'
       WHEN astronomical_twilight_begin <= t AND t < nautical_twilight_begin THEN 'astronomical_twilight_dawn'
       WHEN nautical_twilight_end < t AND t <= astronomical_twilight_end THEN 'astronomical_twilight_dusk'
       ELSE 'dark' END AS lighting_condition FROM j)
SELECT id, lighting_condition, round_even((epoch_us(t) - epoch_us(sunrise)) / 60000000.0, 6) AS minutes_since_sunrise,
       round_even((epoch_us(sunset) - epoch_us(t)) / 60000000.0, 6) AS minutes_until_sunset,
       CASE WHEN lighting_condition = 'daylight' THEN 1 ELSE 0 END AS is_daylight,
       CASE WHEN contains(lighting_condition, 'civil_twilight') THEN 1 ELSE 0 END AS is_civil_twilight,
       CASE WHEN lighting_condition = 'civil_twilight_dawn' THEN 1 ELSE 0 END AS is_twilight_dawn,
       CASE WHEN lighting_condition = 'civil_twilight_dusk' THEN 1 ELSE 0 END AS is_twilight_dusk,
       CASE WHEN lighting_condition = 'dark' THEN 1 ELSE 0 END AS is_dark
FROM k"""


@query("lighting_features", LIGHT_SQL, ("crashes", "suntimes"))
def lighting_features(spark, d):
    """Lighting class, minutes to sunrise/sunset and flags (sun rows for
    the 13th of each month withheld, so 'unknown' occurs)."""
    sun = V.suntimes(spark, d).where(F.dayofmonth("date") != 13)
    j = X.lighting_features(V.crashes(spark, d), sun)
    return j.select("id", "lighting_condition", r6("minutes_since_sunrise").alias("minutes_since_sunrise"),
                    r6("minutes_until_sunset").alias("minutes_until_sunset"), "is_daylight", "is_civil_twilight",
                    "is_twilight_dawn", "is_twilight_dusk", "is_dark")


WZ_MODEL_SQL = """
WITH m AS (SELECT *, TRY_CAST(trim(regexp_replace(visibility_txt, '[\\[\\]]', '', 'g')) AS DOUBLE) AS vis FROM wzcrash),
f AS (SELECT road_event_id, arg_min(road_name, crash_id) AS road_name, arg_min(duration_hr, crash_id) AS duration_hr,
             arg_min(vehicle_impact, crash_id) AS vehicle_impact, arg_min(latitude, crash_id) AS latitude,
             arg_min(longitude, crash_id) AS longitude, count(crash_id) AS crash_count, avg(severity) AS avg_severity,
             avg(distance_km) AS avg_distance_km, avg(vis) AS avg_visibility_mi, avg(precip_in) AS avg_precip_in,
             avg(temperature_f) AS avg_temp_f, avg(wind_mph) AS avg_wind_mph FROM m GROUP BY road_event_id)
SELECT DISTINCT road_event_id, road_name, duration_hr, vehicle_impact, latitude, longitude, CAST(crash_count AS BIGINT) AS crash_count,
       round_even(avg_severity, 6) AS avg_severity, round_even(avg_distance_km, 6) AS avg_distance_km,
       round_even(avg_visibility_mi, 6) AS avg_visibility_mi, round_even(avg_precip_in, 6) AS avg_precip_in,
       round_even(avg_temp_f, 6) AS avg_temp_f, round_even(avg_wind_mph, 6) AS avg_wind_mph,
       CAST(crash_count >= (SELECT quantile_cont(crash_count, 0.75) FROM f) AS INTEGER) AS high_risk
FROM f"""


@query("workzone_model_table", WZ_MODEL_SQL, ("wzcrash",))
def workzone_model_table(spark, d):
    """X8 (+ H2, H20, I2): work-zone feature table."""
    t = X.workzone_model_table(V.wzcrash(spark, d))
    means = ["avg_severity", "avg_distance_km", "avg_visibility_mi", "avg_precip_in", "avg_temp_f", "avg_wind_mph"]
    return t.withColumns({m: r6(m) for m in means})


@query("workzone_features", WZ_MODEL_SQL.replace("SELECT DISTINCT", "SELECT"), ("wzcrash",))
def workzone_features(spark, d):
    """H2 alone: per-zone count, means, first meta row and the q75 high-risk flag."""
    from ..functions.cleaning import strip_brackets_to_number
    from ..operators.aggregates import workzone_features as features
    m = V.wzcrash(spark, d).withColumn("vis", strip_brackets_to_number("visibility_txt"))
    means = {"severity": "avg_severity", "distance_km": "avg_distance_km", "vis": "avg_visibility_mi", "precip_in": "avg_precip_in",
             "temperature_f": "avg_temp_f", "wind_mph": "avg_wind_mph"}
    t = features(m, "road_event_id", "crash_id", means, ["road_name", "duration_hr", "vehicle_impact", "latitude", "longitude"], "crash_id")
    return t.withColumns({c: r6(c) for c in means.values()})


NEAR_ALL_SQL = SEGMENT_TABLE_SQL.split("e AS (")[0].rstrip().rstrip(",")


@query("crashes_per_segment", NEAR_ALL_SQL + """
SELECT segment_id, CAST(crash_count AS BIGINT) AS crash_count, CAST(high_severity_count AS BIGINT) AS high_severity_count
FROM per""", ("crashes", "segments", "segment_pieces"))
def crashes_per_segment(spark, d):
    """H1: crashes and high-severity crashes per road segment (every tied
    nearest segment within 100 m counts)."""
    from ..functions import features as E
    from ..operators import aggregates as H
    from ..operators import spatial as S
    c = V.crashes(spark, d).withColumn("high_severity", E.severity_target("severity", F.year("start_time")))
    near = S.nearest_line_within(c, V.segments(spark, d), "id", "segment_id", "geometry", 100.0, ties="all", how="inner")
    return H.crashes_per_segment(near.join(c.select("id", "high_severity"), "id"), "segment_id", "high_severity")


@query("dimension_lookup", """
SELECT c.id, s.sunrise, s.sunset FROM crashes c LEFT JOIN suntimes s
  ON round_even(c.lat, 1) = s.lat_r AND round_even(c.lng, 1) = s.lng_r AND CAST(c.start_time AS DATE) = s.date""",
       ("crashes", "suntimes"))
def dimension_lookup(spark, d):
    """Lookup on derived keys (half-even rounded lat/lng, date)."""
    from ..operators.joins import dimension_lookup as lookup
    c = V.crashes(spark, d)
    j = lookup(c, V.suntimes(spark, d), [F.bround("lat", 1), F.bround("lng", 1), F.to_date("start_time")],
               ["lat_r", "lng_r", "date"])
    return j.select("id", "sunrise", "sunset")


@query("vmt_and_rates", """
SELECT segment_id, round_even(aadt * miles * 365, 6) AS vmt_annual,
       round_even(coalesce(y / nullif(aadt * miles * 365 / 1e8, 0), 0.0), 6) AS crash_rate_per_100m_vmt
FROM (SELECT segment_id, aadt, y, (0.0 + sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)) + sqrt(power(x2 - x1, 2) + power(y2 - y1, 2))) / 1609.34 AS miles
      FROM segments JOIN counts USING (segment_id))""", ("segments", "counts"))
def vmt_and_rates(spark, d):
    """Annual VMT and crashes per 100 M VMT (0 when undefined)."""
    from ..functions import features as E
    from ..functions import geo as GEO
    s = V.segments(spark, d).join(V.counts(spark, d), "segment_id").withColumn(
        "miles", GEO.polyline_length("geometry") / GEO.METRES_PER_MILE)
    r = E.vmt_and_rates("aadt", "miles", "y", "y")
    return s.select("segment_id", r6(r["vmt_annual"]).alias("vmt_annual"),
                    r6(r["crash_rate_per_100m_vmt"]).alias("crash_rate_per_100m_vmt"))
