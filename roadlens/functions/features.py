"""Feature scalars (E8-E25): weather, flags, targets, exposure, risk scores,
serving features. All CASE / arithmetic, no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binning import profile_bin
from .cleaning import _c, ColumnOrName, safe_number


def _flag(cond: Column) -> Column:
    """pandas semantics for a 0/1 flag: a null comparison counts as False."""
    return F.coalesce(cond, F.lit(False)).cast("int")


# Weather keyword groups, tested in this order (fixed values).
WEATHER_KEYWORDS = [
    ("rain", ["rain", "drizzle", "shower"]),
    ("snow", ["snow", "sleet", "ice", "hail"]),
    ("fog", ["fog", "mist"]),
    ("cloudy", ["cloud", "overcast"]),
]
ADVERSE = ["rain", "snow", "fog"]


def weather_category(c: ColumnOrName) -> Column:
    """Free text -> rain/snow/fog/cloudy/clear; null -> clear (Q3)."""
    low = F.lower(_c(c))
    expr = F.when(low.isNull(), F.lit("clear"))
    for cat, words in WEATHER_KEYWORDS:
        cond = None
        for w in words:
            cond = low.contains(w) if cond is None else (cond | low.contains(w))
        expr = expr.when(cond, F.lit(cat))
    return expr.otherwise(F.lit("clear"))


def adverse_weather(category: ColumnOrName) -> Column:
    """E9."""
    return _flag(_c(category).isin(*ADVERSE))


def low_visibility(vis: ColumnOrName, limit: float = 2.0) -> Column:
    """``visibility < 2``; null -> 0."""
    return _flag(_c(vis) < limit)


def severity_target(sev: ColumnOrName, year: ColumnOrName, thr_before: int = 3,
                    thr_after: int = 3, pivot_year: int = 2021) -> Column:
    """Year-dependent threshold (Q5: both thresholds default to 3)."""
    s, y = _c(sev), _c(year)
    return _flag(F.when(y < pivot_year, s >= thr_before).otherwise(s >= thr_after))


# Major metro areas (fixed values).
MAJOR_CITIES = ["Houston", "Dallas", "Austin", "San Antonio", "Fort Worth", "El Paso"]


def membership_flag(c: ColumnOrName, values: list) -> Column:
    """E11."""
    return _flag(_c(c).isin(*values))


def notnull_flag(c: ColumnOrName, mode: str = "notnull") -> Column:
    """E12 (Q4): ``notnull`` counts a False as 1 like the reference;
    ``true`` counts only True."""
    c = _c(c)
    return _flag(c.isNotNull()) if mode == "notnull" else _flag(c == F.lit(True))


def interaction_features(speed: ColumnOrName, aadt: ColumnOrName, fsystem: ColumnOrName,
                         urban: ColumnOrName, lanes: ColumnOrName,
                         profile: str = "training") -> dict[str, Column]:
    """E13 (Q16): products, null if either factor is null; the serving
    profile multiplies f_system by a 0/1 urban flag."""
    u = _c(urban) if profile == "training" else F.when(_c(urban) > 0, 1).otherwise(0)
    return {"speed_x_aadt": _c(speed) * _c(aadt),
            "fsystem_x_urban": _c(fsystem) * u,
            "lanes_x_aadt": _c(lanes) * _c(aadt)}


def vmt_and_rates(aadt: ColumnOrName, miles: ColumnOrName, crashes: ColumnOrName,
                  high_sev: ColumnOrName) -> dict[str, Column]:
    """Annual VMT and crashes per 100 M VMT; undefined rates -> 0 (Q14)."""
    vmt = _c(aadt) * _c(miles) * 365
    per = vmt / F.lit(1e8)
    return {"vmt_annual": vmt,
            "crash_rate_per_100m_vmt": F.coalesce(F.try_divide(_c(crashes), per), F.lit(0.0)),
            "high_severity_rate_per_100m_vmt": F.coalesce(F.try_divide(_c(high_sev), per), F.lit(0.0))}


def wz_exposure(aadt: ColumnOrName, days: ColumnOrName, crash_count: ColumnOrName,
                segment_miles: float | ColumnOrName = 0.5) -> dict[str, Column]:
    """VMT = aadt x days x miles; crashes per million VMT where VMT > 0."""
    miles = F.lit(segment_miles) if isinstance(segment_miles, (int, float)) else _c(segment_miles)
    vmt = _c(aadt) * _c(days) * miles
    return {"vehicle_miles_traveled": vmt,
            "crash_rate_per_mvmt": F.when(vmt > 0, _c(crash_count) / vmt * 1_000_000)}


def traffic_risk(aadt: ColumnOrName, days: ColumnOrName, impact: ColumnOrName,
                 lanes: ColumnOrName) -> dict[str, Column]:
    """Exposure score and lane-closure risk; division by zero lanes ->
    null (Q14) instead of inf."""
    return {
        "exposure_score": _c(aadt) / 10000 * F.log1p(_c(days)),
        "lane_closure_risk": F.when(_c(impact) == "some-lanes-closed",
                                    F.try_divide(_c(aadt), _c(lanes))).otherwise(F.lit(0.0)),
    }


# Vehicle-impact weights and the weight for unmapped values (fixed values).
VEHICLE_IMPACT_WEIGHT = {"all-lanes-closed": 3.0, "some-lanes-closed": 2.0, "all-lanes-open": 1.0,
                         "alternating-one-way-traffic": 2.5, "unknown": 1.5}
DEFAULT_IMPACT_WEIGHT = 1.5
DEFAULT_DURATION_DAYS = 30


def wz_risk_score(crashes_per_day: ColumnOrName, duration_days: ColumnOrName,
                  impact: ColumnOrName) -> Column:
    """crashes/day x coalesce(days, 30) x impact weight."""
    from .cleaning import map_codes
    w = map_codes(impact, VEHICLE_IMPACT_WEIGHT, DEFAULT_IMPACT_WEIGHT)
    return _c(crashes_per_day) * F.coalesce(_c(duration_days).cast("double"),
                                            F.lit(float(DEFAULT_DURATION_DAYS))) * w


def risk_category(score: ColumnOrName) -> Column:
    """Left-closed risk bands."""
    s = _c(score)
    return (F.when(s.isNull() | F.isnan(s), "Unknown").when(s < 10, "Low").when(s < 50, "Medium")
            .when(s < 100, "High").otherwise("Very High"))


# The weights, limits and tiers of the rule scores below.
def rule_severity_score(adverse: ColumnOrName, low_vis: ColumnOrName, hour: ColumnOrName,
                        rush: ColumnOrName, weekend: ColumnOrName, speed: ColumnOrName,
                        aadt: ColumnOrName) -> Column:
    """Additive rule score clipped to [0, 1]; missing road values add
    nothing."""
    h = _c(hour)
    night = (h >= 22) | (h <= 4)
    add = lambda cond, w: F.when(F.coalesce(cond, F.lit(False)), F.lit(w)).otherwise(F.lit(0.0))
    s = (add(_c(adverse) == 1, 0.25) + add(_c(low_vis) == 1, 0.20) + add(night, 0.15)
         + add(_c(rush) == 1, 0.10) + add((_c(weekend) == 1) & night, 0.15)
         + add(F.coalesce(_c(speed), F.lit(0)) > 65, 0.15)
         + add(F.coalesce(_c(aadt), F.lit(0)) > 50000, 0.10))
    return F.least(F.greatest(s, F.lit(0.0)), F.lit(1.0))


def rule_segment_risk(speed: ColumnOrName, aadt: ColumnOrName, lanes: ColumnOrName) -> Column:
    """0.3 speed/10 + 0.4 aadt/1e4 + 0.3 lanes, nulls as 0, floor 0."""
    z = lambda c: F.coalesce(_c(c).cast("double"), F.lit(0.0))
    return F.greatest(z(speed) / 10 * 0.3 + z(aadt) / 10000 * 0.4 + z(lanes) * 0.3, F.lit(0.0))


def score_to_decision(p: ColumnOrName, threshold: float = 0.5) -> dict[str, Column]:
    """Label at a threshold and the dispatch tier (> 0.70 high,
    0.40-0.70 medium, < 0.40 low)."""
    p = _c(p)
    return {"prediction": F.when(p >= threshold, "HIGH").otherwise("LOW"),
            "dispatch_tier": F.when(p > 0.70, "HIGH").when(p >= 0.40, "MEDIUM").otherwise("LOW")}


def segment_tier(pred: ColumnOrName, high: float = 3.0, medium: float = 1.0) -> Column:
    """Predicted-crash tier for segments."""
    c = _c(pred)
    return F.when(c >= high, "High").when(c >= medium, "Medium").otherwise("Low")


# Serving defaults for absent request fields (fixed values).
SERVING_DEFAULTS = {
    "hour": 12, "day_of_week": 0, "month": 6, "is_weekend": 0, "is_rush_hour": 0,
    "temperature": 70, "visibility": 10, "pressure": 30.0, "humidity": 60, "wind_speed": 5,
    "adverse_weather": 0, "low_visibility": 0, "lat": 30.27, "lng": -97.74,
    "is_major_city": 0, "is_junction": 0, "distance": 0.5, "aadt": 15000,
    "distance_to_aadt_m": 50, "speed_limit": 45, "through_lanes": 2, "f_system": 1,
    "hpms_distance_m": 50, "city_size_category": "medium", "county": "other", "urban_id": 0,
}


def serving_features(cols: dict[str, Column]) -> dict[str, Column]:
    """Raw request columns (possibly absent) -> the model's feature
    columns with defaults. ``cols`` maps request field -> Column; absent
    fields take the defaults."""
    D = SERVING_DEFAULTS
    g = lambda k: safe_number(cols[k], D[k]) if k in cols else F.lit(float(D[k]))
    out: dict[str, Column] = {}
    for k in ("hour", "day_of_week", "month", "is_weekend", "is_rush_hour"):
        out[k] = g(k)
    temp, vis = g("temperature"), g("visibility")
    out["temperature_f"], out["visibility_mi"] = temp, vis
    out["pressure_in"], out["humidity_pct"], out["wind_speed_mph"] = g("pressure"), g("humidity"), g("wind_speed")
    out["adverse_weather"], out["low_visibility"] = g("adverse_weather"), g("low_visibility")
    lat, lng = g("lat"), g("lng")
    out["start_lat"], out["start_lng"] = lat, lng
    city_size = cols.get("city_size_category", F.lit(D["city_size_category"]))
    urban = cols.get("urban_id", F.lit(0))
    out["is_urban"] = F.when(F.coalesce(urban > 0, F.lit(False)) | (F.coalesce(city_size, F.lit("")) == "large"), 1.0).otherwise(0.0)
    out["is_major_city"], out["is_junction"], out["distance_mi"] = g("is_major_city"), g("is_junction"), g("distance")
    out["aadt"] = g("aadt")
    out["distance_to_aadt_m"] = g("distance_to_aadt_m")
    out["hpms_speed_limit"] = g("speed_limit")
    out["hpms_lanes"] = g("through_lanes")
    out["hpms_functional_class"] = g("f_system")
    out["hpms_aadt"] = out["aadt"]
    out["hpms_distance_m"] = g("hpms_distance_m")
    out["weather_category"] = (F.when(out["adverse_weather"] == 1, "rain")
                               .when(out["low_visibility"] == 1, "fog").otherwise("clear"))
    out["temp_category"] = profile_bin(temp, "temp", "serving")
    out["lat_zone"] = profile_bin(lat, "lat", "serving")
    out["lng_zone"] = profile_bin(lng, "lng", "serving")
    out["region"] = F.concat_ws("_", out["lat_zone"], out["lng_zone"])
    out["city_size_category"] = F.coalesce(city_size, F.lit(D["city_size_category"]))
    out["county_top20"] = F.coalesce(cols.get("county", F.lit(None).cast("string")), F.lit(D["county"]))
    out["speed_category"] = profile_bin(out["hpms_speed_limit"], "speed", "serving")
    out["lane_category"] = profile_bin(out["hpms_lanes"], "lanes", "serving")
    out["road_class"] = profile_bin(F.floor(out["hpms_functional_class"]), "road_class", "serving")
    return out


SEGMENT_DEFAULTS = {"speed_limit": 30, "through_lanes": 2, "f_system": 1, "urban_id": 0, "aadt": 10000}


def serving_segment_features(cols: dict[str, Column]) -> dict[str, Column]:
    """Segment request -> features with defaults and serving interactions."""
    D = SEGMENT_DEFAULTS
    out = {k: (safe_number(cols[k], D[k]) if k in cols else F.lit(float(D[k]))) for k in D}
    out.update(interaction_features(out["speed_limit"], out["aadt"], out["f_system"],
                                    out["urban_id"], out["through_lanes"], profile="serving"))
    return out


def concat_region(lat_zone: ColumnOrName, lng_zone: ColumnOrName) -> Column:
    """E24."""
    return F.concat_ws("_", _c(lat_zone), _c(lng_zone))
