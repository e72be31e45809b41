"""Streaming queries (R1-R4): the driver tables are landed as feed files,
processed by an ``availableNow`` stream, and the sink table is returned. The
oracle is the equivalent batch SQL (stream == batch)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import testviews as V
from ..functions import features as E
from ..session import read_table
from ..sources.readers import shared_dir
from ..streaming import feeds as R
from .base import query, r6
from .scalars import CRASH_FEATURE_SQL, RULE_SQL, crash_rule_inputs

EVENT_SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double"


def _land_events(spark, d, chunks: int = 4, resend_first: bool = True) -> str:
    """Land events as JSON files, one folder write per time-ordered chunk;
    the first chunk is sent twice (a duplicate delivery)."""
    e = read_table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id",
                                             "event_type", "value")
    land = shared_dir(spark, "landing")
    n = e.select(F.max("event_id")).first()[0] or 0
    step = n // chunks + 1
    order = list(range(chunks)) + ([0] if resend_first else [])
    for i, c in enumerate(order):
        part = e.where((F.col("event_id") >= c * step) & (F.col("event_id") < (c + 1) * step))
        part.write.mode("overwrite").option("timestampFormat", R.TS_FORMAT).json(f"{land}/part-{i:04d}")
    return land


@query("ingest_feed_stream", "SELECT event_id, ts, user_id, event_type, value FROM events")
def ingest_feed_stream(spark, d):
    """Feed files -> bronze once per event id (duplicate delivery of a
    whole file is removed within the watermark)."""
    land = _land_events(spark, d)
    s = R.read_feed_stream(spark, f"{land}/*", EVENT_SCHEMA)
    out = R.ingest_feed_stream(s, ["event_id"], "ts", "2 days", shared_dir(spark, "bronze"), shared_dir(spark, "ckpt"))
    return out.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value")


SNAP_SCHEMA = "road_event_id long, status string, update_ts timestamp, vehicle_impact string"


@query("latest_snapshot", """
SELECT road_event_id, CASE WHEN road_event_id % 3 = 0 THEN 'completed' WHEN road_event_id % 2 = 0 THEN 'active'
                           ELSE 'planned' END AS status,
       CASE WHEN road_event_id % 3 = 0 THEN end_ts WHEN road_event_id % 2 = 0 THEN start_ts
            ELSE start_ts - INTERVAL 1 DAY END AS update_ts, vehicle_impact FROM workzones""", ("workzones",))
def latest_snapshot(spark, d):
    """R2: three snapshot files (planned / active / completed) merged batch by
    batch; the state keeps the latest update per work zone."""
    w = V.workzones(spark, d)
    land = shared_dir(spark, "snapshots")
    snaps = [
        w.select("road_event_id", F.lit("planned").alias("status"),
                 (F.col("start_ts") - F.expr("INTERVAL 1 DAY")).alias("update_ts"), "vehicle_impact"),
        w.where(F.col("road_event_id") % 2 == 0).select("road_event_id", F.lit("active").alias("status"),
                                                        F.col("start_ts").alias("update_ts"), "vehicle_impact"),
        w.where(F.col("road_event_id") % 3 == 0).select("road_event_id", F.lit("completed").alias("status"),
                                                        F.col("end_ts").alias("update_ts"), "vehicle_impact"),
    ]
    for i, s in enumerate(snaps):
        s.withColumn("update_ts", F.col("update_ts").cast("timestamp")).write.option(
            "timestampFormat", R.TS_FORMAT).json(f"{land}/snap-{i}")
    st = R.read_feed_stream(spark, f"{land}/*", SNAP_SCHEMA, max_files_per_trigger=1)
    out = R.latest_snapshot(st, "road_event_id", "update_ts", shared_dir(spark, "state"), shared_dir(spark, "ckpt"))
    return out.select("road_event_id", "status", F.col("update_ts").cast("timestamp_ntz").alias("update_ts"),
                      "vehicle_impact")


@query("score_stream", f"""
SELECT id, round_even({RULE_SQL}, 6) AS risk_score,
       CASE WHEN {RULE_SQL} >= 0.5 THEN 'HIGH' ELSE 'LOW' END AS prediction,
       CASE WHEN {RULE_SQL} > 0.70 THEN 'HIGH' WHEN {RULE_SQL} >= 0.40 THEN 'MEDIUM' ELSE 'LOW' END AS dispatch_tier
FROM ({CRASH_FEATURE_SQL})""", ("crashes",))
def score_stream(spark, d):
    """Rule score and decision on arriving crash rows (stream == batch)."""
    f = crash_rule_inputs(spark, d)
    land = shared_dir(spark, "crash-feed")
    f.write.parquet(land)
    s = R.read_feed_stream(spark, land, f.schema, fmt="parquet", max_files_per_trigger=2)
    score = E.rule_severity_score("adverse_weather", "low_visibility", "hour", "is_rush_hour", "is_weekend",
                                  "speed", "aadt")
    dec = E.score_to_decision(score, 0.5)
    out = R.score_stream(s, {"risk_score": r6(score), "prediction": dec["prediction"],
                             "dispatch_tier": dec["dispatch_tier"]}, ["id"], shared_dir(spark, "scored"),
                         shared_dir(spark, "ckpt"))
    return out


@query("windowed_counts", """
WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, CAST(n AS BIGINT) AS n FROM w
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def windowed_counts(spark, d):
    """Hourly counts per event type with a 10-minute watermark; windows
    whose end the watermark has not passed are still open (not emitted)."""
    land = _land_events(spark, d, chunks=4, resend_first=False)
    s = R.read_feed_stream(spark, f"{land}/*", EVENT_SCHEMA)
    out = R.windowed_counts(s, "ts", "1 hour", "10 minutes", shared_dir(spark, "windows"), shared_dir(spark, "ckpt"),
                            by=["event_type"])
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "event_type", "n")
