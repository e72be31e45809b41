"""Spatial queries (F1-F14, C7, G8, X3-X5). The oracle side is brute force
over all pairs (DuckDB); the Spark side is the grid equi-join."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import testviews as V
from ..functions import geo as GEO
from ..operators import joins as G
from ..operators import spatial as S
from ..plans import workzones as W
from .base import query, r6, r_many

D2 = "sqrt(power({a}.x - {b}.x, 2) + power({a}.y - {b}.y, 2))"
# point-to-piece distance, written exactly like the Spark expression
PIECE_D = """sqrt(power(px - (ax + t * (bx - ax)), 2) + power(py - (ay + t * (b_y - ay)), 2))"""
PIECE_T = """CASE WHEN (bx - ax) * (bx - ax) + (b_y - ay) * (b_y - ay) = 0 THEN 0.0
  ELSE greatest(0.0, least(1.0, ((px - ax) * (bx - ax) + (py - ay) * (b_y - ay)) / ((bx - ax) * (bx - ax) + (b_y - ay) * (b_y - ay)))) END"""


@query("project_mercator", """
SELECT id, round_even(6378137.0 * (lng * (pi() / 180.0)), 3) AS mx,
       round_even(6378137.0 * ln(tan(pi() / 4 + (lat * (pi() / 180.0)) / 2)), 3) AS my FROM crashes""", ("crashes",))
def project_mercator(spark, d):
    """EPSG:4326 -> EPSG:3857 (spherical Mercator) as column expressions."""
    x, y = GEO.mercator("lng", "lat")
    return V.crashes(spark, d).select("id", r6(x, 3).alias("mx"), r6(y, 3).alias("my"))


@query("project_roundtrip", """
SELECT id, round_even(lng, 6) AS lng, round_even(lat, 6) AS lat FROM crashes""", ("crashes",))
def project_roundtrip(spark, d):
    """3857 -> 4326 inverse recovers the input (to 1e-6 degrees)."""
    x, y = GEO.mercator("lng", "lat")
    c = V.crashes(spark, d).select("id", x.alias("mx"), y.alias("my"))
    lon, lat = GEO.inverse_mercator("mx", "my")
    return c.select("id", r6(lon).alias("lng"), r6(lat).alias("lat"))


@query("within_buffer", f"""
SELECT c.id, w.road_event_id, round_even({D2.format(a='c', b='w')}, 3) AS distance
FROM crashes c JOIN workzones w ON {D2.format(a='c', b='w')} <= 500""", ("crashes", "workzones"))
def within_buffer(spark, d):
    """every crash-work zone pair within 500 m."""
    p = S.within_pairs(V.crashes(spark, d), V.workzones(spark, d), "id", "road_event_id", 500.0)
    return p.select("id", "road_event_id", r_many("distance", 3).alias("distance"))


NEAREST_STATION_SQL = f"""
WITH p AS (SELECT w.road_event_id, s.statn_id, {D2.format(a='w', b='s')} AS d
           FROM workzones w JOIN stations s ON {D2.format(a='w', b='s')} <= 500),
r AS (SELECT *, row_number() OVER (PARTITION BY road_event_id ORDER BY round_even(d, 6), statn_id) AS rn FROM p)
SELECT w.road_event_id, r.statn_id, round_even(r.d, 3) AS distance
FROM workzones w LEFT JOIN r ON w.road_event_id = r.road_event_id AND r.rn = 1"""


@query("nearest_within", NEAREST_STATION_SQL, ("workzones", "stations"))
def nearest_within(spark, d):
    """nearest traffic station within 500 m per work zone (left join,
    ties -> lowest station id)."""
    n = S.nearest_within(V.workzones(spark, d), V.stations(spark, d), "road_event_id", "statn_id", 500.0)
    return n.select("road_event_id", "statn_id", r6("distance", 3).alias("distance"))


@query("nearest_within_all_ties", f"""
WITH p AS (SELECT c.id, s.statn_id, {D2.format(a='c', b='s')} AS d
           FROM crashes c JOIN stations s ON {D2.format(a='c', b='s')} <= 1500),
r AS (SELECT *, rank() OVER (PARTITION BY id ORDER BY round_even(d, 6)) AS rk FROM p)
SELECT c.id, r.statn_id, round_even(r.d, 3) AS distance FROM crashes c LEFT JOIN r ON c.id = r.id AND r.rk = 1""",
       ("crashes", "stations"))
def nearest_within_all_ties(spark, d):
    """F2 with ``ties='all'`` (Q7): every equally near station is kept."""
    n = S.nearest_within(V.crashes(spark, d), V.stations(spark, d), "id", "statn_id", 1500.0, ties="all")
    return n.select("id", "statn_id", r6("distance", 3).alias("distance"))


NEAREST_LINE_SQL = f"""
WITH pc AS (SELECT c.id, p.segment_id, px, py, ax, ay, bx, b_y
            FROM (SELECT id, x AS px, y AS py FROM crashes) c, segment_pieces p),
pd AS (SELECT id, segment_id, {PIECE_D} AS d FROM (SELECT *, {PIECE_T} AS t FROM pc)),
ps AS (SELECT id, segment_id, min(d) AS d FROM pd WHERE d <= 100 GROUP BY id, segment_id),
r AS (SELECT *, rank() OVER (PARTITION BY id ORDER BY round_even(d, 6)) AS rk FROM ps)
SELECT c.id, r.segment_id, round_even(r.d, 3) AS distance FROM crashes c LEFT JOIN r ON c.id = r.id AND r.rk = 1"""


@query("nearest_line_within", NEAREST_LINE_SQL, ("crashes", "segment_pieces"))
def nearest_line_within(spark, d):
    """nearest road polyline within 100 m per crash (all ties kept)."""
    n = S.nearest_line_within(V.crashes(spark, d), V.segments(spark, d), "id", "segment_id", "geometry", 100.0)
    return n.select("id", "segment_id", r6("distance", 3).alias("distance"))


@query("nearest_unbounded", f"""
WITH p AS (SELECT c.id, s.statn_id, {D2.format(a='c', b='s')} AS d FROM crashes c, stations s),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round_even(d, 6), statn_id) AS rn FROM p)
SELECT id, statn_id, round_even(d, 3) AS distance FROM r WHERE rn = 1""", ("crashes", "stations"))
def nearest_unbounded(spark, d):
    """nearest station with no limit (doubling-radius rounds)."""
    n = S.nearest_unbounded(V.crashes(spark, d), V.stations(spark, d), "id", "statn_id")
    return n.select("id", "statn_id", r6("distance", 3).alias("distance"))


@query("count_within", f"""
SELECT c.id, CAST(count(w.road_event_id) AS BIGINT) AS wz_count_1km
FROM crashes c LEFT JOIN workzones w ON {D2.format(a='c', b='w')} <= 1000 GROUP BY c.id""", ("crashes", "workzones"))
def count_within(spark, d):
    """work zones within 1 km per crash (0 if none)."""
    return S.count_within(V.crashes(spark, d), V.workzones(spark, d), "id", "road_event_id", 1000.0,
                          out="wz_count_1km")


SPACE_TIME_SQL = f"""
WITH m AS (SELECT c.id, w.road_event_id, {D2.format(a='c', b='w')} AS d,
                  row_number() OVER (PARTITION BY c.id ORDER BY w.road_event_id) AS rn
           FROM crashes c JOIN workzones w ON {D2.format(a='c', b='w')} <= 500
                AND w.start_date <= CAST(c.start_time AS DATE) AND CAST(c.start_time AS DATE) <= w.end_date)
SELECT c.id, m.road_event_id, round_even(m.d, 3) AS distance FROM crashes c LEFT JOIN m ON c.id = m.id AND m.rn = 1"""


@query("space_time_match", SPACE_TIME_SQL, ("crashes", "workzones"))
def space_time_match(spark, d):
    """within 500 m and active on the crash date; first zone by key."""
    c = V.crashes(spark, d).withColumn("crash_date", F.to_date("start_time"))
    m = S.space_time_match(c, V.workzones(spark, d), "id", "road_event_id", 500.0, "crash_date",
                           "start_date", "end_date")
    return m.select("id", "road_event_id", r6("distance", 3).alias("distance"))


PIP_SQL = """
WITH pe AS (SELECT c.id, e.county_id, e.county_name,
                   CASE WHEN (e.ay > c.y) != (e.b_y > c.y) AND c.x < (e.bx - e.ax) * (c.y - e.ay) / (e.b_y - e.ay) + e.ax
                        THEN 1 ELSE 0 END AS cr
            FROM crashes c, county_edges e),
ins AS (SELECT id, county_id, county_name FROM pe GROUP BY id, county_id, county_name HAVING sum(cr) % 2 = 1),
best AS (SELECT id, min(county_id) AS county_id, arg_min(county_name, county_id) AS county_name FROM ins GROUP BY id)
SELECT c.id, best.county_id, best.county_name FROM crashes c LEFT JOIN best USING (id)"""


@query("point_in_polygon", PIP_SQL, ("crashes", "county_edges"))
def point_in_polygon(spark, d):
    """F8: county polygon of each crash point; unmatched (in the gaps) -> null."""
    return S.point_in_polygon(V.crashes(spark, d), V.counties(spark, d), "id", "county_id", "ring", 2000.0,
                              extra=["county_name"])


@query("polyline_length", """
SELECT segment_id, round_even(len, 6) AS length_m, round_even(len / 1609.34, 6) AS length_miles FROM (
  SELECT segment_id, 0.0 + sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)) + sqrt(power(x2 - x1, 2) + power(y2 - y1, 2)) AS len
  FROM segments)""", ("segments",))
def polyline_length(spark, d):
    """F9 (Q9 fixed: length in projected metres)."""
    ln = GEO.polyline_length("geometry")
    return V.segments(spark, d).select("segment_id", r6(ln).alias("length_m"),
                                       r6(ln / GEO.METRES_PER_MILE).alias("length_miles"))


@query("planar_distance", """
SELECT id, round_even(sqrt(power(x - 20000, 2) + power(y - 20000, 2)), 6) AS dist_to_centre_m,
       round_even(abs(lat - 30.0) * 111.0, 6) AS lat_offset_km FROM crashes""", ("crashes",))
def planar_distance(spark, d):
    """point-point distance and degrees -> km."""
    c = V.crashes(spark, d)
    return c.select("id", r6(GEO.planar_distance("x", "y", F.lit(20000.0), F.lit(20000.0))).alias("dist_to_centre_m"),
                    r6(GEO.degrees_to_km(F.abs(F.col("lat") - 30.0))).alias("lat_offset_km"))


def _box_sql(x0, y0, x1, y1):
    side = lambda cx, cy: f"((bx - ax) * ({cy} - ay) - (b_y - ay) * ({cx} - ax))"
    s = [side(x0, y0), side(x0, y1), side(x1, y0), side(x1, y1)]
    return (f"(greatest(ax, bx) >= {x0} AND least(ax, bx) <= {x1} AND greatest(ay, b_y) >= {y0} AND least(ay, b_y) <= {y1}"
            f" AND NOT (({' AND '.join(v + ' > 0' for v in s)}) OR ({' AND '.join(v + ' < 0' for v in s)})))")


@query("bbox_intersects_line", f"""
SELECT DISTINCT segment_id FROM segment_pieces WHERE {_box_sql(17000, 17000, 23000, 23000)}""", ("segment_pieces",))
def bbox_intersects_line(spark, d):
    """Road polylines crossing a 6 km box around (20 km, 20 km)."""
    return S.bbox_intersects_line(V.segments(spark, d), "geometry", 20000.0, 20000.0, 3000.0).select("segment_id")


@query("segment_at_location", f"""
WITH pc AS (SELECT segment_id, 20000.0 AS px, 20000.0 AS py, ax, ay, bx, b_y FROM segment_pieces),
pd AS (SELECT segment_id, min({PIECE_D}) AS d FROM (SELECT *, {PIECE_T} AS t FROM pc) GROUP BY segment_id)
SELECT segment_id, d AS distance FROM pd WHERE d <= 600 ORDER BY d, segment_id LIMIT 1""", ("segment_pieces",))
def segment_at_location(spark, d):
    """the closest road within 600 m of one location."""
    return S.segment_at_location(V.segments(spark, d), "segment_id", "geometry", 20000.0, 20000.0, 600.0)


HEX_SQL = """
WITH e AS (SELECT min(px) AS xmin, max(px) AS xmax, min(py) AS ymin, max(py) AS ymax FROM planar),
s AS (SELECT (px - xmin) / ((xmax - xmin) / 50) AS ix, (py - ymin) / ((ymax - ymin) / 28) AS iy FROM planar, e
      WHERE px IS NOT NULL AND py IS NOT NULL),
t AS (SELECT *, round_even(ix, 0) AS ix1, round_even(iy, 0) AS iy1, floor(ix) AS ix2, floor(iy) AS iy2 FROM s),
u AS (SELECT *, power(ix - ix1, 2) + 3 * power(iy - iy1, 2) < power(ix - ix2 - 0.5, 2) + 3 * power(iy - iy2 - 0.5, 2) AS first FROM t)
SELECT CASE WHEN first THEN 1 ELSE 2 END AS lattice, CAST(CASE WHEN first THEN ix1 ELSE ix2 END AS BIGINT) AS i,
       CAST(CASE WHEN first THEN iy1 ELSE iy2 END AS BIGINT) AS j, CAST(count(*) AS BIGINT) AS n FROM u GROUP BY 1, 2, 3"""


@query("hexbin_density", HEX_SQL, ("planar",))
def hexbin_density(spark, d):
    """hexagonal bins (gridsize 50), empty bins absent."""
    return S.hexbin_density(V.planar(spark, d), "px", "py", 50)


@query("extent_centroid", """
SELECT min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax, round_even(avg(x), 6) AS cx,
       round_even(avg(y), 6) AS cy FROM crashes""", ("crashes",))
def extent_centroid(spark, d):
    """F14."""
    e = S.extent_centroid(V.crashes(spark, d), "x", "y")
    return e.select("xmin", "ymin", "xmax", "ymax", r6("cx").alias("cx"), r6("cy").alias("cy"))


@query("match_report", f"""
WITH n AS ({NEAREST_STATION_SQL})
SELECT CAST(count(distance) AS BIGINT) AS matched, round_even(count(distance) / (SELECT count(*) FROM workzones), 6) AS match_rate,
       round_even(avg(distance), 3) AS mean_distance, round_even(median(distance), 3) AS median_distance,
       max(distance) AS max_distance, CAST(count(DISTINCT statn_id) AS BIGINT) AS distinct_right FROM n""",
       ("workzones", "stations"))
def match_report(spark, d):
    """Match count, rate and distance statistics of the station join."""
    w = V.workzones(spark, d)
    n = S.nearest_within(w, V.stations(spark, d), "road_event_id", "statn_id", 500.0)
    n = n.withColumn("distance", r6("distance", 3))
    m = G.match_report(n, w, "statn_id", "distance")
    return m.select("matched", r6("match_rate").alias("match_rate"), r6("mean_distance", 3).alias("mean_distance"),
                    r6("median_distance", 3).alias("median_distance"), "max_distance", "distinct_right")


# --------------------------------------------------------------- X3-X5

@query("build_workzone_traffic", f"""
WITH n AS ({NEAREST_STATION_SQL}),
j AS (SELECT w.*, n.statn_id, n.distance, s.aadt AS aadt_rpt_qty, s.county AS station_county
      FROM workzones w JOIN n USING (road_event_id) LEFT JOIN stations s ON n.statn_id = s.statn_id),
gm AS (SELECT station_county, avg(aadt_rpt_qty) AS gm FROM j WHERE aadt_rpt_qty IS NOT NULL AND station_county IS NOT NULL GROUP BY 1),
med AS (SELECT median(aadt_rpt_qty) AS med FROM j WHERE aadt_rpt_qty IS NOT NULL),
cc AS (SELECT w.road_event_id, count(c.id) AS crash_count FROM workzones w LEFT JOIN crashes c ON {D2.format(a='w', b='c')} <= 500 GROUP BY 1),
f AS (SELECT j.*, coalesce(aadt_rpt_qty, gm, med) AS aadt_filled,
             CASE WHEN aadt_rpt_qty IS NOT NULL THEN 'matched' WHEN gm IS NOT NULL THEN 'county_avg' ELSE 'state_median' END AS aadt_source,
             CAST(floor((epoch_us(end_ts) - epoch_us(start_ts)) / 86400000000) AS BIGINT) AS duration_days, crash_count
      FROM j LEFT JOIN gm USING (station_county) JOIN cc USING (road_event_id), med)
SELECT road_event_id, statn_id, distance, round_even(aadt_filled, 6) AS aadt_filled, aadt_source, duration_days,
       CAST(crash_count AS BIGINT) AS crash_count,
       round_even(aadt_filled * duration_days * 0.5, 6) AS vmt,
       round_even(CASE WHEN aadt_filled * duration_days * 0.5 > 0 THEN crash_count / (aadt_filled * duration_days * 0.5) * 1000000 END, 6) AS crash_rate_per_mvmt,
       {"CASE WHEN aadt_filled IS NULL OR isnan(aadt_filled) THEN NULL WHEN aadt_filled > 0 AND aadt_filled <= 1000 THEN 'very_low' WHEN aadt_filled > 1000 AND aadt_filled <= 5000 THEN 'low' WHEN aadt_filled > 5000 AND aadt_filled <= 15000 THEN 'medium' WHEN aadt_filled > 15000 AND aadt_filled <= 30000 THEN 'high' WHEN aadt_filled > 30000 AND aadt_filled <= 100000 THEN 'very_high' END"} AS traffic_volume_category,
       round_even(aadt_filled / 10000 * ln(1 + duration_days), 6) AS exposure_score,
       round_even(CASE WHEN vehicle_impact = 'some-lanes-closed' THEN aadt_filled / nullif(total_num_lanes, 0) ELSE 0.0 END, 6) AS lane_closure_risk
FROM f""", ("workzones", "stations", "crashes"))
def build_workzone_traffic(spark, d):
    """X3 on the test views."""
    t = W.build_workzone_traffic(V.workzones(spark, d), V.stations(spark, d), V.crashes(spark, d))
    return t.withColumns({c: r6(c, 3 if c == "distance" else 6) for c in (
        "distance", "aadt_filled", "vmt", "crash_rate_per_mvmt", "exposure_score", "lane_closure_risk")})


@query("crash_workzone_match", f"""
WITH c AS (SELECT *, 1 + id % 5 AS code, CASE WHEN id % 7 = 0 THEN 'NULL' ELSE CAST(id % 3 AS VARCHAR) END AS deaths, id % 4 AS injuries
           FROM crashes WHERE junction AND x IS NOT NULL AND y IS NOT NULL),
p AS (SELECT c.*, w.road_event_id, {D2.format(a='c', b='w')} AS d FROM c JOIN workzones w ON {D2.format(a='c', b='w')} <= 500)
SELECT road_event_id, CAST(count(*) AS BIGINT) AS crash_count,
       {', '.join(f"CAST(count(*) FILTER (WHERE code = {k}) AS BIGINT) AS {n}_count" for k, n in W.SEVERITY_NAMES.items())},
       sum(coalesce(TRY_CAST(deaths AS DOUBLE), 0.0)) AS death_cnt_sum, CAST(sum(injuries) AS DOUBLE) AS injury_cnt_sum,
       round_even(min(d), 3) AS distance_min, round_even(avg(d), 3) AS distance_mean, round_even(max(d), 3) AS distance_max
FROM p GROUP BY road_event_id""", ("crashes", "workzones"))
def crash_workzone_match(spark, d):
    """C3 (junction crashes) -> C4 -> F5 (500 m) -> H3 with all five
    severity codes, deaths (text with 'NULL') and injuries."""
    i = F.col("id")
    c = V.crashes(spark, d).withColumns({
        "code": 1 + i % 5, "deaths": F.when(i % 7 == 0, "NULL").otherwise((i % 3).cast("string")), "injuries": i % 4})
    pairs = W.match_crashes_to_workzones(c, V.workzones(spark, d))
    s = W.zone_crash_stats(pairs, severity="code", deaths="deaths", injuries="injuries")
    return s.withColumns({f"distance_{k}": r6(f"distance_{k}", 3) for k in ("min", "mean", "max")})


@query("workzone_proximity", f"""
WITH p AS (SELECT c.id, w.road_event_id, {D2.format(a='c', b='w')} AS d FROM crashes c, workzones w),
nn AS (SELECT id, min(d) AS d FROM p GROUP BY id),
cnt AS (SELECT id, count(*) FILTER (WHERE d <= 1000) AS n FROM p GROUP BY id)
SELECT id, round_even(nn.d, 3) AS wz_nearest_distance_m, CAST(n AS BIGINT) AS wz_count_1km,
       CASE WHEN n > -1 AND n <= 0 THEN 'none' WHEN n > 0 AND n <= 2 THEN 'low' WHEN n > 2 AND n <= 5 THEN 'medium'
            WHEN n > 5 THEN 'high' END AS wz_density_cat
FROM nn JOIN cnt USING (id)""", ("crashes", "workzones"))
def workzone_proximity(spark, d):
    """X5 on the test views."""
    t = W.workzone_proximity(V.crashes(spark, d), V.workzones(spark, d))
    return t.withColumn("wz_nearest_distance_m", r6("wz_nearest_distance_m", 3))


def _tm_sql(lon: str, lat: str) -> tuple[str, str]:
    a, f = GEO.WGS84
    p = GEO.UTM14N
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    d2r = repr(GEO.DEG2RAD)
    phi = f"({lat} * {d2r})"
    n_ = f"({a!r} / sqrt(1 - {e2!r} * sin({phi}) * sin({phi})))"
    t = f"(tan({phi}) * tan({phi}))"
    c = f"({ep2!r} * cos({phi}) * cos({phi}))"
    A = f"(({lon} - ({p['lon0']!r})) * {d2r} * cos({phi}))"
    m = (f"({a!r} * (({1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256!r}) * {phi}"
         f" - ({3 * e2 / 8 + 3 * e2 ** 2 / 32 + 45 * e2 ** 3 / 1024!r}) * sin(2 * {phi})"
         f" + ({15 * e2 ** 2 / 256 + 45 * e2 ** 3 / 1024!r}) * sin(4 * {phi})"
         f" - ({35 * e2 ** 3 / 3072!r}) * sin(6 * {phi})))")
    x = (f"({p['fe']!r} + {p['k0']!r} * {n_} * ({A} + (1 - {t} + {c}) * power({A}, 3) / 6"
         f" + (5 - 18 * {t} + {t} * {t} + 72 * {c} - 58 * {ep2!r}) * power({A}, 5) / 120))")
    y = (f"({p['fn']!r} + {p['k0']!r} * ({m} + {n_} * tan({phi}) * ({A} * {A} / 2"
         f" + (5 - {t} + 9 * {c} + 4 * {c} * {c}) * power({A}, 4) / 24"
         f" + (61 - 58 * {t} + {t} * {t} + 600 * {c} - 330 * {ep2!r}) * power({A}, 6) / 720)))")
    return x, y


def _albers_sql(lon: str, lat: str) -> tuple[str, str]:
    k = GEO.albers_constants()
    p = GEO.TX_ALBERS
    e, n = k["e"], k["n"]
    s = f"sin({lat} * {GEO.DEG2RAD!r})"
    q = f"({1 - e * e!r} * ({s} / (1 - {e * e!r} * {s} * {s}) - {1 / (2 * e)!r} * ln((1 - {e!r} * {s}) / (1 + {e!r} * {s}))))"
    rho = f"({k['a']!r} * sqrt({k['C']!r} - {n!r} * {q}) / {n!r})"
    theta = f"({n!r} * ({lon} - ({p['lon0']!r})) * {GEO.DEG2RAD!r})"
    return f"({p['fe']!r} + {rho} * sin({theta}))", f"({p['fn']!r} + {k['rho0']!r} - {rho} * cos({theta}))"


_TMX, _TMY = _tm_sql("lng", "lat")
_ALX, _ALY = _albers_sql("lng", "lat")


@query("project_utm", f"SELECT id, round_even({_TMX}, 3) AS ux, round_even({_TMY}, 3) AS uy FROM crashes", ("crashes",))
def project_utm(spark, d):
    """EPSG:4326 -> EPSG:32614 (UTM 14N, ellipsoidal transverse Mercator)."""
    x, y = GEO.transverse_mercator("lng", "lat")
    return V.crashes(spark, d).select("id", r6(x, 3).alias("ux"), r6(y, 3).alias("uy"))


@query("project_albers", f"SELECT id, round_even({_ALX}, 3) AS ax, round_even({_ALY}, 3) AS ay FROM crashes",
       ("crashes",))
def project_albers(spark, d):
    """EPSG:4326 -> EPSG:3083 (Texas Centric Albers equal area, GRS80)."""
    x, y = GEO.albers("lng", "lat")
    return V.crashes(spark, d).select("id", r6(x, 3).alias("ax"), r6(y, 3).alias("ay"))


@query("project_utm_roundtrip", "SELECT id, round_even(lng, 5) AS lng, round_even(lat, 5) AS lat FROM crashes",
       ("crashes",))
def project_utm_roundtrip(spark, d):
    """4326 -> 32614 -> 4326 recovers the input to 1e-5 degrees over the
    whole test area (the series is sub-mm inside the zone, about 0.2 m at
    8 degrees from its central meridian)."""
    x, y = GEO.transverse_mercator("lng", "lat")
    c = V.crashes(spark, d).select("id", x.alias("ux"), y.alias("uy"))
    lon, lat = GEO.inverse_transverse_mercator("ux", "uy")
    return c.select("id", r6(lon, 5).alias("lng"), r6(lat, 5).alias("lat"))


@query("project_albers_roundtrip", "SELECT id, round_even(lng, 6) AS lng, round_even(lat, 6) AS lat FROM crashes",
       ("crashes",))
def project_albers_roundtrip(spark, d):
    """4326 -> 3083 -> 4326 recovers the input to 1e-6 degrees."""
    x, y = GEO.albers("lng", "lat")
    c = V.crashes(spark, d).select("id", x.alias("ax"), y.alias("ay"))
    inv = GEO.inverse_albers(c, "ax", "ay", "lon", "lat_b")
    return inv.select("id", r6("lon").alias("lng"), r6("lat_b").alias("lat"))
