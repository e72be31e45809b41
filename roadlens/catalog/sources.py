"""Source and sink queries (A1-A6, A10, A11, B1-B3). Each writes the driver
tables (or views derived from them) in the landed format, then reads them
back through the operator, so the work grows with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import testviews as V
from ..session import read_table
from ..sources import readers as A
from ..sources import sinks as B
from .base import query, r6

SUPPLIER_SCHEMA = "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"


@query("read_table_csv", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def read_table_csv(spark, d):
    """A1: CSV round trip with a declared schema."""
    path = A.shared_dir(spark, "csv")
    read_table(spark, d, "supplier").write.option("header", True).csv(path)
    return A.read_csv(spark, path, SUPPLIER_SCHEMA)


FEED_SCHEMA = ("road_event_id long, start_date string, end_date string, county string, subidentifier string, "
               "vehicle_impact string, core_details struct<direction: string, road_names: array<string>>, "
               "geometry struct<type: string, coordinates: array<array<double>>>")


def _write_feed(spark, d):
    """Land the work zones as a JSON feed (nested, some rows without
    coordinates, some without county)."""
    w = V.workzones(spark, d)
    k = F.col("road_event_id")
    county = F.when(k % 4 == 0, F.lit(None)).otherwise(F.upper(F.trim("county_name")))
    feed = w.select(
        "road_event_id", F.date_format("start_date", "yyyy-MM-dd").alias("start_date"),
        F.when(k % 6 == 0, F.lit("not a date")).otherwise(F.date_format("end_date", "yyyy-MM-dd")).alias("end_date"),
        county.alias("county"), F.concat(F.lit("SUB_"), F.col("county")).alias("subidentifier"), "vehicle_impact",
        F.struct(F.when(k % 2 == 0, "northbound").otherwise("southbound").alias("direction"),
                 F.array("road_name", F.concat(F.lit("FM "), F.col("county"))).alias("road_names")).alias("core_details"),
        F.struct(F.lit("MultiPoint").alias("type"),
                 F.when(k % 17 == 0, F.lit(None)).otherwise(F.array(F.array("lng", "lat"))).alias("coordinates"))
        .alias("geometry"))
    path = A.shared_dir(spark, "feed")
    feed.write.json(path)
    return path


FEED_SQL = """
SELECT road_event_id, lng AS lon, lat, CAST(start_date AS TIMESTAMP) AS start_ts,
       CASE WHEN road_event_id % 6 = 0 THEN NULL ELSE CAST(end_date AS TIMESTAMP) END AS end_ts,
       coalesce(CASE WHEN road_event_id % 4 = 0 THEN NULL ELSE upper(trim(county_name)) END, 'SUB_' || county) AS county_name,
       road_name || ', FM ' || CAST(county AS VARCHAR) AS road_names
FROM workzones WHERE road_event_id % 17 <> 0"""


@query("read_json_feed", FEED_SQL, ("workzones",))
def read_json_feed(spark, d):
    """A2: nested JSON feed -> rows (first coordinate, parsed dates, rows
    without coordinates dropped, county fallback)."""
    f = A.read_json_feed(spark, _write_feed(spark, d), FEED_SCHEMA)
    return f.select("road_event_id", "lon", "lat", F.col("start_ts").cast("timestamp_ntz").alias("start_ts"),
                    F.col("end_ts").cast("timestamp_ntz").alias("end_ts"), "county_name", "road_names")


@query("flatten_json", """
SELECT road_event_id, CASE WHEN road_event_id % 2 = 0 THEN 'northbound' ELSE 'southbound' END AS "core_details.direction",
       'MultiPoint' AS "geometry.type" FROM workzones""", ("workzones",))
def flatten_json(spark, d):
    """A3: nested struct columns -> dotted flat columns."""
    raw = spark.read.schema(FEED_SCHEMA).json(_write_feed(spark, d))
    flat = A.flatten_struct(raw.select("road_event_id", "core_details", "geometry"))
    return flat.select("road_event_id", "`core_details.direction`", "`geometry.type`")


@query("read_geojson", """
SELECT event_type, CAST(count(*) AS BIGINT) AS n, round_even(avg(lat), 6) AS mean_lat FROM (
  SELECT CASE road_event_id % 3 WHEN 0 THEN 'restriction' WHEN 1 THEN 'work-zone' ELSE 'detour' END AS event_type, lat
  FROM workzones) GROUP BY event_type""", ("workzones",))
def read_geojson(spark, d):
    """A4: FeatureCollection files (bounded features per document) ->
    one row per feature; features counted by nested event type."""
    w = V.workzones(spark, d)
    k = F.col("road_event_id")
    feat = F.struct(F.lit("Feature").alias("type"),
                    F.struct("road_event_id", F.when(k % 3 == 0, "restriction").when(k % 3 == 1, "work-zone")
                             .otherwise("detour").alias("event_type")).alias("properties"),
                    F.struct(F.lit("Point").alias("type"), F.array("lng", "lat").alias("coordinates")).alias("geometry"))
    docs = (w.select(F.floor(k / 500).alias("_doc"), feat.alias("f")).groupBy("_doc")
            .agg(F.lit("FeatureCollection").alias("type"), F.collect_list("f").alias("features")).drop("_doc"))
    path = A.shared_dir(spark, "geojson")
    docs.write.json(path)
    from pyspark.sql.types import StructType
    props = StructType.fromDDL("road_event_id long, event_type string")
    g = A.read_geojson(spark, path, props)
    return g.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("lat")).alias("mean_lat"))


@query("parse_json_column", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def parse_json_column(spark, d):
    """A5: JSON text column -> typed field."""
    e = read_table(spark, d, "events").select("event_id", "props")
    return A.with_json_fields(e, "props", "k int").select("event_id", "k")


@query("read_geometry_table", """
SELECT segment_id, round_even((-11000000.0 + x0) / 6378137.0 * (180.0 / pi()), 6) AS lon,
       round_even((2 * atan(exp((3500000.0 + y0) / 6378137.0)) - pi() / 2) * (180.0 / pi()), 6) AS lat FROM segments""",
       ("segments",))
def read_geometry_table(spark, d):
    """A geometry table stored in EPSG:3857 metres read back and
    normalised to EPSG:4326 (first vertex shown)."""
    s = V.segments(spark, d).select("segment_id", F.transform("geometry", lambda p: F.struct(
        (p["x"] - 11000000.0).alias("x"), (p["y"] + 3500000.0).alias("y"))).alias("geometry"))
    path = A.shared_dir(spark, "geom")
    s.write.parquet(path)
    g = A.read_geometry(spark, path, "geometry", 3857)
    return g.select("segment_id", r6(F.get("geometry", 0)["x"]).alias("lon"), r6(F.get("geometry", 0)["y"]).alias("lat"))


@query("combine_pages", """
SELECT event_id, ts, value FROM events
WHERE event_type = 'click' AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'""")
def combine_pages(spark, d):
    """A10: page files of one extract -> one table with the filter pushed to
    the scan."""
    import datetime as dt
    e = read_table(spark, d, "events").withColumn("page", F.floor(F.col("event_id") / 1000))
    path = A.shared_dir(spark, "pages")
    e.write.partitionBy("page").parquet(path)
    where = (F.col("event_type") == "click") & F.col("ts").between(F.lit(dt.datetime(2024, 1, 5)),
                                                                  F.lit(dt.datetime(2024, 1, 20)))
    out = A.combine_pages(spark, path, where)
    return out.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


TAGS = {"click": {"metro": "Austin", "station_id": "USW00013904"},
        "view": {"metro": "Houston", "station_id": "USW00012960"},
        "purchase": {"metro": "Dallas", "station_id": "USW00003927"}}


@query("union_tagged", """
SELECT event_id, event_type, CASE event_type WHEN 'click' THEN 'Austin' WHEN 'view' THEN 'Houston' ELSE 'Dallas' END AS metro,
       CASE event_type WHEN 'click' THEN 'USW00013904' WHEN 'view' THEN 'USW00012960' ELSE 'USW00003927' END AS station_id
FROM events WHERE event_type IN ('click', 'view', 'purchase')""")
def union_tagged(spark, d):
    """Per-type extracts tagged with station constants; types without a
    station are skipped."""
    e = read_table(spark, d, "events").select("event_id", "event_type")
    types = ["click", "view", "purchase", "error", "signup"]
    frames = {t: e.where(F.col("event_type") == t) for t in types}
    return A.union_tagged(frames, TAGS)


@query("write_versioned", """
SELECT id, CASE WHEN year(start_time) <= 1997 THEN 'train' WHEN year(start_time) = 1998 THEN 'val' ELSE 'test' END AS split,
       severity FROM crashes""", ("crashes",))
def write_versioned(spark, d):
    """B1: two versions written, the reader picks the newest."""
    c = V.crashes(spark, d).select("id", "severity", F.when(F.year("start_time") <= 1997, "train")
                                   .when(F.year("start_time") == 1998, "val").otherwise("test").alias("split"))
    base = A.shared_dir(spark, "versioned")
    B.write_versioned(c.where(F.col("split") == "train"), base, "crash_level", "20240101T000000")
    B.write_versioned(c, base, "crash_level", "20240201T000000")
    return B.read_latest(spark, base, "crash_level").select("id", "split", "severity")


@query("write_flat_export", """
SELECT road_event_id, road_name, strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS start_ts, vehicle_impact FROM workzones""",
       ("workzones",))
def write_flat_export(spark, d):
    """B2: existing columns only, timestamps as text, geometry dropped, CSV."""
    w = V.workzones(spark, d).withColumn("geometry", F.array(F.struct("x", "y")))
    path = A.shared_dir(spark, "export")
    B.export_csv(w, ["road_event_id", "road_name", "start_ts", "vehicle_impact", "geometry", "not_there"], path)
    return A.read_csv(spark, path, "road_event_id long, road_name string, start_ts string, vehicle_impact string")


@query("write_summary_json", """
SELECT 'total' AS section, 'rows' AS item, CAST(count(*) AS DOUBLE) AS value FROM crashes
UNION ALL SELECT 'total', 'total', CAST(sum(severity) AS DOUBLE) FROM crashes
UNION ALL SELECT 'distribution', county, CAST(count(*) AS DOUBLE) FROM crashes GROUP BY county
UNION ALL SELECT 'top', CAST(id AS VARCHAR), CAST(severity AS DOUBLE) FROM (SELECT id, severity FROM crashes ORDER BY severity DESC, id LIMIT 5)""", ("crashes",))
def write_summary_json(spark, d):
    """Summary as JSON lines, written and read back."""
    return B.write_summary_json(V.crashes(spark, d), A.shared_dir(spark, "summary"), "county", "severity", "id", 5)
