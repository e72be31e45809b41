"""Work-zone builds on a user's DataFrames (X3-X5, H3) and the quality report
and sensitivity tables that go with them (X10, E25)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as D
from ..functions import features as E
from ..functions import temporal as T
from ..functions.binning import TRAINING, bin_right_closed
from ..operators import filters as C
from ..operators import joins as G
from ..operators import quality as M
from ..operators import spatial as S

#: Severity codes of the crash records and the columns they are counted in.
SEVERITY_NAMES = {1: "incap_injury", 2: "non_incap_injury", 3: "possible_injury", 4: "fatal", 5: "no_injury"}


def build_workzone_traffic(workzones: DataFrame, stations: DataFrame, crashes: DataFrame, radius: float = 500.0,
                           crash_radius: float = 500.0) -> DataFrame:
    """C4 -> F2 (nearest station within ``radius`` metres) -> U1 (its AADT,
    the mean of its county, the median) -> F6 -> E4 / E15 -> L1 -> E16; a row
    per work zone that lies somewhere."""
    w = C.require_not_null(workzones, ["x", "y"])
    n = S.nearest_within(w, stations, "road_event_id", "statn_id", radius)
    known = stations.select("statn_id", F.col("aadt").alias("aadt_rpt_qty"), F.col("county").alias("station_county"))
    # only zones near a station look its attributes up: no join on the null key of the others
    near = n.where(F.col("statn_id").isNotNull()).join(known, "statn_id")
    j = w.join(near, "road_event_id", "left")
    f = G.fallback_fill(j, "aadt_rpt_qty", "station_county", "aadt_filled", "aadt_source")
    count = S.count_within(w, crashes, "road_event_id", "id", crash_radius, out="crash_count")
    f = f.join(count, "road_event_id").withColumn("duration_days", T.duration_days("end_ts", "start_ts"))
    exposure = E.wz_exposure("aadt_filled", "duration_days", "crash_count")
    risk = E.traffic_risk("aadt_filled", "duration_days", "vehicle_impact", "total_num_lanes")
    return f.select(
        "road_event_id", "statn_id", "distance", "aadt_filled", "aadt_source", "duration_days", "crash_count",
        exposure["vehicle_miles_traveled"].alias("vmt"), exposure["crash_rate_per_mvmt"].alias("crash_rate_per_mvmt"),
        bin_right_closed("aadt_filled", *TRAINING["aadt"]).alias("traffic_volume_category"),
        risk["exposure_score"].alias("exposure_score"), risk["lane_closure_risk"].alias("lane_closure_risk"))


def zone_crash_stats(pairs: DataFrame, zone: str = "road_event_id", severity: str = "severity", distance: str = "distance",
                     deaths: str | None = None, injuries: str | None = None) -> DataFrame:
    """H3: per work zone the matched crashes, a count for each severity code
    1 to 5, deaths and injuries (text or numbers; what is no number counts 0;
    columns that are not there are left out) and the distances."""
    aggs = [F.count(F.lit(1)).alias("crash_count")]
    aggs += [F.count_if(F.col(severity) == k).alias(f"{name}_count") for k, name in SEVERITY_NAMES.items()]
    # numbers need no parsing, and there may be very many pairs
    plain = {f.name for f in pairs.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long")}
    number = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in plain else D.safe_number(F.col(c), 0.0)
    aggs += [F.sum(number(c)).alias(out) for c, out in ((deaths, "death_cnt_sum"), (injuries, "injury_cnt_sum")) if c is not None and c in pairs.columns]
    aggs += [f(distance).alias(f"distance_{name}") for f, name in ((F.min, "min"), (F.avg, "mean"), (F.max, "max"))]
    return pairs.groupBy(zone).agg(*aggs)


def match_crashes_to_workzones(crashes: DataFrame, workzones: DataFrame, radius: float = 500.0, flag: str = "junction") -> DataFrame:
    """C3 (flagged crashes) -> C4 -> F5: every pair of a crash and a work
    zone within ``radius`` metres, with the crash's columns."""
    c = C.require_not_null(C.filter_equals(crashes, flag, True), ["x", "y"])
    more = c.drop("road_event_id", "distance")
    # crashes meet the rows of their id before they meet zones: there are far more pairs than crashes
    c = c.select("id", F.col("x").alias("_atx"), F.col("y").alias("_aty")).join(more, "id")
    own = [n for n in more.columns if n != "id"]
    return S.within_pairs(c, workzones, "id", "road_event_id", radius, lx="_atx", ly="_aty", carry=own).drop("_cx", "_cy")


def workzone_proximity(crashes: DataFrame, workzones: DataFrame, radius: float = 1000.0) -> DataFrame:
    """F4 (nearest work zone at any distance) -> F6 (zones within
    ``radius`` metres) -> L1, a row per crash."""
    near = S.nearest_unbounded(crashes, workzones, "id", "road_event_id")
    count = S.count_within(crashes, workzones, "id", "road_event_id", radius, out="wz_count_1km")
    return near.join(count, "id").select(
        "id", F.col("distance").alias("wz_nearest_distance_m"), "wz_count_1km",
        bin_right_closed("wz_count_1km", *TRAINING["wz_density"]).alias("wz_density_cat"))


def quality_report(df: DataFrame, checks, key: str, columns: list[str], target: str | None = None, split: str | None = None,
                   unique: list[str] = (), drift: float = 0.05) -> DataFrame:
    """``section, item, value`` in one long table: M1 failures per check, M4
    missing share per column, M6 class shares of ``target``, duplicates of
    ``key``, and with ``split`` M7: rows and target rate per split and whether
    the rates drift apart."""
    row = lambda section, item, value: [F.lit(section).alias("section"), item.cast("string").alias("item"), value.cast("double").alias("value")]
    out = M.validate(df, checks, unique=list(unique)).select(*row("validation", F.concat_ws(":", "column", "check"), F.col("failures")))
    out = out.unionByName(M.missing_profile(df, columns).select(*row("missing_pct", F.col("column"), F.col("pct"))))
    if target is not None:
        out = out.unionByName(M.class_balance(df, target).select(*row("class_share", F.col(target), F.col("share"))))
    # one row per key that occurs more than once: no distinct set in one task
    extra = df.groupBy(key).agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    out = out.unionByName(extra.select(*row("duplicates", F.lit(key), F.col("n"))))
    if split is not None and target is not None:
        s = M.compare_splits(df, split, target, drift)
        item = F.explode(F.array(*[F.struct(F.concat_ws(":", F.col(split).cast("string"), F.lit(c)).alias("i"), F.col(c).cast("double").alias("v"))
                                   for c in ("n", "rate", "drift")])).alias("r")
        out = out.unionByName(s.select(item).select(*row("split", F.col("r.i"), F.col("r.v"))))
    return out


def sensitivity(df: DataFrame, features: list[str], score: Callable[[DataFrame], DataFrame], out: str, key: str,
                delta: float = 0.1, steps: int = 21) -> DataFrame:
    """``key, feature, step, score`` for each feature in turn changed by
    -delta .. +delta in ``steps`` equal steps, the others as they are.
    ``score`` adds the column ``out`` to a table: a rule or a fitted model. All
    features and steps are generated on each row, so the model sees one table."""
    at = lambda s: (F.lit(-delta) + s * (2 * delta / (steps - 1))) if steps > 1 else F.lit(0.0)
    grid = df.select("*", F.explode(F.array(*map(F.lit, features))).alias("_feature"))
    grid = grid.select("*", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("_step"))
    grid = grid.withColumns({f: F.when(F.col("_feature") == f, F.col(f) * (1 + at(F.col("_step")))).otherwise(F.col(f).cast("double")) for f in features})
    return score(grid).select(key, F.col("_feature").alias("feature"), F.col("_step").alias("step"), F.col(out).alias("score"))
