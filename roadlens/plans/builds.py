"""Composed table builds (X1, X2, X6, X7, X8): each is one lazy Spark plan
over the input DataFrames; Catalyst prunes the columns each step needs and
AQE picks join strategies from measured sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as D
from ..functions import features as E
from ..functions import geo as GEO
from ..functions import temporal as T
from ..functions.binning import TRAINING, bin_right_closed
from ..operators import aggregates as H
from ..operators import filters as C
from ..operators import joins as G
from ..operators import ranking as I
from ..operators import spatial as S
from ..operators import splits as N


def build_crash_table(crashes: DataFrame, segments: DataFrame, stations: DataFrame, years=(1995, 2001),
                      split_ranges: dict | None = None, road_radius: float = 100.0, na_label: str = "unknown",
                      major_cities=E.MAJOR_CITIES) -> DataFrame:
    """C1 -> E10 -> C8 -> I1 -> F3 (nearest road within 100 m, first of
    ties by segment id, as the reference's post-join de-dup keeps) -> D1 ->
    F4 (nearest traffic station, unbounded) -> E1-E3, E8-E12, L1, F13, I7,
    I8 -> N2."""
    c = C.filter_years(crashes, "start_time", *years)
    c = c.withColumn("high_severity", E.severity_target("severity", F.year("start_time")))
    c = C.drop_columns_if_present(c, ["severity", "end_time", "end_lat", "end_lng"])
    c = I.dedup_keep_first(c, ["id"], ["start_time"])
    # I7 / I8 statistics on the crash rows themselves (the joins below are
    # 1:1 per crash), so the spatial joins are not recomputed for them
    c = I.top_n_or_other(c, "county", 20, out="county_top20")
    c = I.frequency_bucket(c, "city", 1000, 100, out="city_size_category")
    # both spatial joins read the narrow point set; materialise it once
    # (three columns, reliable checkpoint) instead of recomputing the crash base
    pts = S._checkpoint(c.select("id", "x", "y"))
    road = S.nearest_line_within(pts, segments, "id", "segment_id", "geometry", road_radius, ties="first")
    seg = segments.select(F.col("segment_id"), D.to_numeric_null_token("speed_limit").alias("hpms_speed_limit"),
                          F.col("through_lanes").cast("double").alias("hpms_lanes"),
                          F.col("f_system").alias("hpms_functional_class"), F.col("aadt").cast("double").alias("hpms_aadt"))
    # only crashes near a road look its attributes up: no join on the null key of the others
    road = (road.where(F.col("segment_id").isNotNull()).join(seg, "segment_id")
            .withColumnsRenamed({"segment_id": "hpms_segment_id", "distance": "hpms_distance_m"}))
    st = S.nearest_unbounded(pts, stations, "id", "statn_id")
    st = st.join(stations.select("statn_id", F.col("aadt")), "statn_id", "left").select(
        "id", "aadt", F.col("distance").alias("distance_to_aadt_m"))
    t = c.join(road, "id", "left").join(st, "id")
    cal = T.calendar("start_time")
    t = t.withColumns({k: cal[k] for k in ("hour", "day_of_week", "month", "is_weekend")})
    wc = E.weather_category("weather_condition")
    t = t.withColumns({
        "is_rush_hour": T.rush_hour("hour"), "weather_category": wc,
        "adverse_weather": E.adverse_weather(wc), "low_visibility": E.low_visibility("visibility_mi"),
        "temp_category": bin_right_closed("temperature_f", *TRAINING["temp"]),
        "lat_zone": bin_right_closed("lat", *TRAINING["lat"], na_label=na_label),
        "lng_zone": bin_right_closed("lng", *TRAINING["lng"], na_label=na_label),
        "is_major_city": E.membership_flag("city", list(major_cities)),
        "is_junction": E.notnull_flag("junction"),
        "speed_category": bin_right_closed("hpms_speed_limit", *TRAINING["speed"], na_label=na_label),
        "lane_category": bin_right_closed("hpms_lanes", *TRAINING["lanes"], na_label=na_label),
        "road_class": F.coalesce(F.col("hpms_functional_class").cast("string"), F.lit(na_label)),
    }).withColumn("region", E.concat_region("lat_zone", "lng_zone"))
    ranges = split_ranges or {
        "train": ("1995-01-01 00:00:00", "1998-12-31 23:59:59"), "val": ("1999-01-01 00:00:00", "1999-12-31 23:59:59"),
        "test": ("2000-01-01 00:00:00", "2000-12-31 23:59:59")}
    ranges = {k: tuple(F.lit(v).cast("timestamp_ntz") for v in r) for k, r in ranges.items()}
    return N.temporal_split(t, "start_time", ranges)


def build_segment_table(segments: DataFrame, crashes: DataFrame, years=(1995, 2001), radius: float = 100.0,
                        quantile_bins: int = 5, strata: str = "f_system") -> DataFrame:
    """D1 -> C1 -> E10 -> F3 (every tied nearest segment counts, as in
    the reference) -> G6 -> H1 -> G1 -> F9 -> E14 -> I1 -> E13 -> L3 -> N3."""
    s = segments.withColumn("speed_limit_num", D.to_numeric_null_token("speed_limit"))
    c = C.filter_years(crashes, "start_time", *years)
    c = c.withColumn("high_severity", E.severity_target("severity", F.year("start_time")))
    pts = S._checkpoint(c.select("id", "x", "y", "high_severity"))
    near = S.nearest_line_within(pts, segments, "id", "segment_id", "geometry", radius, ties="all", how="inner")
    matched = near.join(pts.select("id", "high_severity"), "id")
    per = H.crashes_per_segment(matched, "segment_id", "high_severity")
    t = G.left_equi_join(s, per, ["segment_id"], {"crash_count": 0, "high_severity_count": 0})
    t = t.withColumn("length_miles", GEO.polyline_length("geometry") / GEO.METRES_PER_MILE)
    r = E.vmt_and_rates("aadt", "length_miles", "crash_count", "high_severity_count")
    t = t.withColumns({"crash_rate_per_100m_vmt": r["crash_rate_per_100m_vmt"],
                       "high_severity_rate_per_100m_vmt": r["high_severity_rate_per_100m_vmt"]}).drop("geometry")
    t = I.dedup_keep_first(t, ["segment_id"], ["segment_id"])
    t = t.withColumns(E.interaction_features("speed_limit_num", "aadt", "f_system", "urban_id", "through_lanes"))
    # the edges are those of the segments: nothing of the joins above is needed for them
    once = I.dedup_keep_first(segments.select("segment_id", "aadt"), ["segment_id"], ["segment_id"])
    t = I.bin_quantile(t, "aadt", quantile_bins, out="aadt_bin", edges=I.quantile_edges(once, "aadt", quantile_bins))
    return N.stratified_split(t, [strata], "segment_id", rows=segments.count())


def county_risk(workzones: DataFrame, counties: DataFrame, crashes: DataFrame, cell: float = 2000.0) -> DataFrame:
    """E4 -> F8 (county polygon of each work zone) -> D6 -> H4 (county
    crash statistics) -> G2 -> E17 -> E18."""
    w = workzones.withColumn("duration_days", T.duration_days("end_ts", "start_ts"))
    pip = S.point_in_polygon(w, counties, "road_event_id", "county_id", "ring", cell, extra=["county_name"])
    w = w.drop("county_name", "county").join(pip, "road_event_id")
    stats = H.county_stats(crashes).select(F.col("county").alias("county_key"), "total_crashes", "crashes_per_day")
    j = w.join(stats, D.normalise_key("county_name") == D.normalise_key("county_key"), "left")
    score = E.wz_risk_score("crashes_per_day", "duration_days", "vehicle_impact")
    return j.select("road_event_id", "county_id", "county_name", "duration_days", "total_crashes", "crashes_per_day",
                    score.alias("work_zone_crash_risk_score"), E.risk_category(score).alias("risk_category"))


def lighting_features(crashes: DataFrame, sun: DataFrame, time_col: str = "start_time", time_zone: str | None = None) -> DataFrame:
    """Sun instants looked up once per (lat 0.1, lng 0.1, date) with
    half-even rounding (G3), then E6 class, E5 minutes, E7 flags. The sun
    table grows with the data, so no broadcast hint: AQE decides. Naive crash
    times count as UTC (Q17), or with ``time_zone`` as local times of it: the
    sun table is looked up by the local date, instants are compared in UTC."""
    local = time_col
    if time_zone is not None:
        crashes = crashes.withColumn("_utc", F.to_utc_timestamp(F.col(time_col).cast("timestamp_ntz"), time_zone).cast("timestamp_ntz"))
        time_col = "_utc"
    keys = [F.bround("lat", 1), F.bround("lng", 1), F.to_date(local)]
    j = G.dimension_lookup(crashes, sun, keys, ["lat_r", "lng_r", "date"])
    cond = T.lighting_condition(time_col, "sunrise", "sunset", "civil_twilight_begin", "civil_twilight_end",
                                "nautical_twilight_begin", "nautical_twilight_end", "astronomical_twilight_begin",
                                "astronomical_twilight_end")
    j = j.withColumn("lighting_condition", cond)
    j = j.withColumns({"minutes_since_sunrise": T.minutes_between(time_col, "sunrise"),
                       "minutes_until_sunset": T.minutes_between("sunset", time_col)})
    return j.withColumns(T.lighting_flags("lighting_condition")).drop("_utc")


def workzone_model_table(merged: DataFrame, q: float = 0.75) -> DataFrame:
    """D3 (bracketed visibility text) -> H2 (count, means, first meta row,
    high_risk by the 75th percentile) -> I2 (duplicate feature rows
    removed)."""
    m = merged.withColumn("visibility_clean", D.strip_brackets_to_number("visibility_txt"))
    f = H.workzone_features(
        m, "road_event_id", "crash_id",
        {"severity": "avg_severity", "distance_km": "avg_distance_km", "visibility_clean": "avg_visibility_mi",
         "precip_in": "avg_precip_in", "temperature_f": "avg_temp_f", "wind_mph": "avg_wind_mph"},
        ["road_name", "duration_hr", "vehicle_impact", "latitude", "longitude"], "crash_id", q)
    return I.dedup_full(f, f.columns)
