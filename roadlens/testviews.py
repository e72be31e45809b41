"""Deterministic road-safety views over the driver's TPC-H-like tables.

One definition, two engines: every view exists as a Spark DataFrame builder
(DataFrame API, so Catalyst prunes and pushes down into the parquet scans)
and as DuckDB SQL text used by the independent oracle.  All derived values
are integer arithmetic on the source keys so both engines see identical
rows.  Coordinates ``x``/``y`` are metres in a 40 km x 40 km square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import prepare, read_table

# Fixed vocabularies of the views (values the reference's code tests for).
WEATHER_BY_KEY_MOD7 = ["Light Rain", "Heavy Snow", "Fog", "Mostly Cloudy", "Fair", "Ice Pellets", None]
VEHICLE_IMPACT_BY_MOD5 = ["all-lanes-closed", "some-lanes-closed", "all-lanes-open",
                          "alternating-one-way-traffic", "unknown"]


def _pick(key_mod: Column, values: list) -> Column:
    expr = None
    for i, v in enumerate(values):
        val = F.lit(v) if v is not None else F.lit(None).cast("string")
        expr = F.when(key_mod == i, val) if expr is None else expr.when(key_mod == i, val)
    return expr


def _lat(k: Column) -> Column:
    return F.lit(25.0) + ((k * 7919) % 12000) / 1000.0


def _lng(k: Column) -> Column:
    return F.lit(-107.0) + ((k * 6007) % 14000) / 1000.0


# --------------------------------------------------------------------------- Spark

def crashes(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, d, "nation").select("n_nationkey", "n_name")
    k = F.col("o_orderkey")
    start = F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), ((k * 7) % 24).cast("int"), ((k * 13) % 60).cast("int"), F.lit(0))
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        # nation is a fixed 25-row dimension: broadcast is size-bounded
        .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            k.alias("id"),
            start.alias("start_time"),
            (F.lit(1) + (k * 31) % 4).cast("int").alias("severity"),
            _lat(k).alias("lat"),
            _lng(k).alias("lng"),
            ((k * 7919) % 40000).cast("double").alias("x"),
            ((k * 6007) % 40000).cast("double").alias("y"),
            F.col("n_name").alias("county"),
            F.col("c_mktsegment").alias("city"),
            _pick(k % 7, WEATHER_BY_KEY_MOD7).alias("weather_condition"),
            F.when(k % 11 == 0, F.lit(None).cast("double"))
            .otherwise(((k * 37) % 130 - 10).cast("double")).alias("temperature_f"),
            F.when(k % 13 == 0, F.lit(None).cast("double"))
            .otherwise(((k * 17) % 100) / 10.0).alias("visibility_mi"),
            F.when(k % 3 == 0, F.lit(None).cast("boolean"))
            .otherwise(k % 3 == 2).alias("junction"),
        )
    )


def segments(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    p = read_table(spark, d, "part").select("p_partkey", "p_size")
    k = F.col("p_partkey")
    x0 = ((k * 8713 + 17) % 40000).cast("double")
    y0 = ((k * 5519 + 71) % 40000).cast("double")
    x1 = x0 + (50 + (k * 37) % 450)
    y1 = y0 + ((k * 53) % 900 - 450)
    x2 = x1 + (50 + (k * 29) % 450)
    y2 = y1 + ((k * 61) % 900 - 450)
    return p.select(
        k.alias("segment_id"),
        F.array(F.struct(x0.alias("x"), y0.alias("y")),
                F.struct(x1.alias("x"), y1.alias("y")),
                F.struct(x2.alias("x"), y2.alias("y"))).alias("geometry"),
        F.when(k % 9 == 0, F.lit("NULL"))
        .otherwise((F.lit(15) + 5 * (F.col("p_size") % 15)).cast("string")).alias("speed_limit"),
        (F.lit(1) + k % 6).cast("int").alias("through_lanes"),
        (F.lit(1) + k % 7).cast("int").alias("f_system"),
        F.when(k % 3 == 0, F.lit(0)).otherwise(10000 + (k * 7) % 90000).cast("long").alias("urban_id"),
        ((k * 613) % 120000).alias("aadt"),
    )


def stations(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    s = read_table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    k = F.col("s_suppkey")
    return s.select(
        k.alias("statn_id"),
        ((k * 9973 + 137) % 40000).cast("double").alias("x"),
        ((k * 3571 + 911) % 40000).cast("double").alias("y"),
        F.when(k % 10 == 0, F.lit(None).cast("double"))
        .otherwise(((k * 977) % 120000).cast("double")).alias("aadt"),
        F.col("s_nationkey").alias("county"),
    )


def workzones(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    c = read_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, d, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    start = F.date_add(F.lit("1995-01-01").cast("date"), ((k * 13) % 2400).cast("int"))
    end = F.date_add(start, (F.lit(1) + k % 90).cast("int"))
    return (
        c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            k.alias("road_event_id"),
            ((k * 7717 + 53) % 40000).cast("double").alias("x"),
            ((k * 4441 + 29) % 40000).cast("double").alias("y"),
            _lat(k).alias("lat"),
            _lng(k).alias("lng"),
            start.alias("start_date"),
            end.alias("end_date"),
            (start.cast("timestamp_ntz") + F.make_dt_interval(
                F.lit(0), ((k * 7) % 24).cast("int"), F.lit(0), F.lit(0))).alias("start_ts"),
            (end.cast("timestamp_ntz") + F.make_dt_interval(
                F.lit(0), ((k * 11) % 24).cast("int"), F.lit(0), F.lit(0))).alias("end_ts"),
            _pick(k % 5, VEHICLE_IMPACT_BY_MOD5).alias("vehicle_impact"),
            (k % 5).cast("int").alias("total_num_lanes"),
            F.concat(F.lit("Road "), (k % 97).cast("string")).alias("road_name"),
            F.concat(F.lit(" "), F.lower(F.col("n_name")), F.lit(" ")).alias("county_name"),
            F.col("c_nationkey").alias("county"),
        )
    )


# hexagon vertex offsets around each county centre (metres), fixed values
HEX_DX = [3500, 1750, -1750, -3500, -1750, 1750]
HEX_DY = [0, 3000, 3000, 0, -3000, -3000]


def counties(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    n = read_table(spark, d, "nation").select("n_nationkey", "n_name")
    k = F.col("n_nationkey")
    cx = (F.lit(4000) + 8000 * (k % 5)).cast("double")
    cy = (F.lit(4000) + 8000 * F.floor(k / 5)).cast("double")
    ring = F.array(*[F.struct((cx + dx).alias("x"), (cy + dy).alias("y"))
                     for dx, dy in zip(HEX_DX, HEX_DY)])
    return n.select(k.alias("county_id"), F.col("n_name").alias("county_name"), ring.alias("ring"))


def wzcrash(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    li = read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    z = F.col("l_suppkey")
    return li.select(
        z.alias("road_event_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("crash_id"),
        (F.lit(1) + F.col("l_linenumber") % 4).cast("int").alias("severity"),
        (F.col("l_discount") * 10).alias("distance_km"),
        (F.col("l_quantity") / 5).alias("visibility_mi"),
        F.concat(F.lit("["), F.col("l_quantity").cast("bigint").cast("string"), F.lit("E-1]")).alias("visibility_txt"),
        (F.col("l_tax") * 10).alias("precip_in"),
        (F.lit(20) + F.col("l_partkey") % 80).cast("double").alias("temperature_f"),
        (F.col("l_orderkey") % 30).cast("double").alias("wind_mph"),
        F.concat(F.lit("Road "), (z % 37).cast("string")).alias("road_name"),
        (F.lit(24.0) * (F.lit(1) + z % 30)).alias("duration_hr"),
        _pick(z % 5, VEHICLE_IMPACT_BY_MOD5).alias("vehicle_impact"),
        _lat(z).alias("latitude"),
        _lng(z).alias("longitude"),
    )


def scored(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % 1000 / 1000.0).alias("p"),
    )


def counts(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    p = read_table(spark, d, "part").select("p_partkey")
    per_part = (read_table(spark, d, "lineitem").groupBy("l_partkey")
                .agg(F.count(F.lit(1)).alias("n")))
    return (p.join(per_part, p.p_partkey == per_part.l_partkey, "left")
            .select(F.col("p_partkey").alias("segment_id"),
                    (F.coalesce(F.col("n"), F.lit(0)) % 9).cast("long").alias("y"),
                    (F.lit(0.1) + (F.col("p_partkey") % 50) / 10.0).alias("yhat")))


def suntimes(spark: SparkSession, d: str) -> DataFrame:
    """Synthetic sun table: one row per distinct (lat 0.1, lng 0.1, date) of
    the crashes, sunrise 12:00 UTC +- 60 min by key, the rest at fixed
    offsets from sunrise / sunset."""
    c = crashes(spark, d)
    keys = c.select(F.bround("lat", 1).alias("lat_r"), F.bround("lng", 1).alias("lng_r"),
                    F.to_date("start_time").alias("date")).distinct()
    off = ((F.round(F.col("lat_r") * 10).cast("long") * 7
            + F.round(-F.col("lng_r") * 10).cast("long") * 3
            + F.dayofmonth("date")) % 121 - 60).cast("int")
    base = F.col("date").cast("timestamp_ntz")
    rise = base + F.make_dt_interval(F.lit(0), F.lit(12), off, F.lit(0))
    sset = rise + F.make_dt_interval(F.lit(0), F.lit(11), F.lit(30), F.lit(0))

    def mins(m: int) -> Column:
        return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(m), F.lit(0))

    return keys.select(
        "lat_r", "lng_r", "date",
        rise.alias("sunrise"), sset.alias("sunset"),
        (rise - mins(25)).alias("civil_twilight_begin"), (sset + mins(25)).alias("civil_twilight_end"),
        (rise - mins(55)).alias("nautical_twilight_begin"), (sset + mins(55)).alias("nautical_twilight_end"),
        (rise - mins(85)).alias("astronomical_twilight_begin"), (sset + mins(85)).alias("astronomical_twilight_end"),
    )


def planar(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    e = read_table(spark, d, "embeddings")
    return e.select(
        F.col("vec_id"),
        F.round(F.element_at("embedding", 1).cast("double") * 10, 3).alias("px"),
        F.round(F.element_at("embedding", 2).cast("double") * 10, 3).alias("py"),
        F.col("label"),
    )


SPARK_VIEWS = {
    "crashes": crashes, "segments": segments, "stations": stations, "workzones": workzones,
    "counties": counties, "wzcrash": wzcrash, "scored": scored, "counts": counts,
    "suntimes": suntimes, "planar": planar,
}


# --------------------------------------------------------------------------- DuckDB

def _case(key: str, values: list) -> str:
    parts = []
    for i, v in enumerate(values):
        parts.append(f"WHEN {i} THEN " + ("NULL" if v is None else "'" + v + "'"))
    return f"CASE {key} " + " ".join(parts) + " END"


SQL_VIEWS: dict[str, str] = {}

SQL_VIEWS["crashes"] = f"""
SELECT o_orderkey AS id,
       o_orderdate + to_hours(CAST((o_orderkey*7) % 24 AS BIGINT)) + to_minutes(CAST((o_orderkey*13) % 60 AS BIGINT)) AS start_time,
       CAST(1 + (o_orderkey*31) % 4 AS INTEGER) AS severity,
       25.0 + ((o_orderkey*7919) % 12000) / 1000.0 AS lat,
       -107.0 + ((o_orderkey*6007) % 14000) / 1000.0 AS lng,
       CAST((o_orderkey*7919) % 40000 AS DOUBLE) AS x,
       CAST((o_orderkey*6007) % 40000 AS DOUBLE) AS y,
       n_name AS county, c_mktsegment AS city,
       {_case('o_orderkey % 7', WEATHER_BY_KEY_MOD7)} AS weather_condition,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST((o_orderkey*37) % 130 - 10 AS DOUBLE) END AS temperature_f,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE ((o_orderkey*17) % 100) / 10.0 END AS visibility_mi,
       CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN false ELSE true END AS junction
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

SQL_VIEWS["segments"] = """
SELECT p_partkey AS segment_id,
       x0, y0, x1, y1, x1 + 50 + (p_partkey*29) % 450 AS x2, y1 + (p_partkey*61) % 900 - 450 AS y2,
       CASE WHEN p_partkey % 9 = 0 THEN 'NULL' ELSE CAST(15 + 5 * (p_size % 15) AS VARCHAR) END AS speed_limit,
       CAST(1 + p_partkey % 6 AS INTEGER) AS through_lanes,
       CAST(1 + p_partkey % 7 AS INTEGER) AS f_system,
       CAST(CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 10000 + (p_partkey*7) % 90000 END AS BIGINT) AS urban_id,
       (p_partkey*613) % 120000 AS aadt
FROM (SELECT *, x0 + 50 + (p_partkey*37) % 450 AS x1, y0 + (p_partkey*53) % 900 - 450 AS y1
      FROM (SELECT p_partkey, p_size,
                   CAST((p_partkey*8713+17) % 40000 AS DOUBLE) AS x0,
                   CAST((p_partkey*5519+71) % 40000 AS DOUBLE) AS y0 FROM part))
"""

# the two straight pieces of every segment polyline
SQL_VIEWS["segment_pieces"] = """
SELECT segment_id, 0 AS piece, x0 AS ax, y0 AS ay, x1 AS bx, y1 AS b_y FROM segments
UNION ALL
SELECT segment_id, 1 AS piece, x1 AS ax, y1 AS ay, x2 AS bx, y2 AS b_y FROM segments
"""

SQL_VIEWS["stations"] = """
SELECT s_suppkey AS statn_id,
       CAST((s_suppkey*9973+137) % 40000 AS DOUBLE) AS x,
       CAST((s_suppkey*3571+911) % 40000 AS DOUBLE) AS y,
       CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE CAST((s_suppkey*977) % 120000 AS DOUBLE) END AS aadt,
       s_nationkey AS county
FROM supplier
"""

SQL_VIEWS["workzones"] = f"""
SELECT road_event_id, x, y, lat, lng, start_date, end_date,
       CAST(start_date AS TIMESTAMP) + to_hours(CAST((road_event_id*7) % 24 AS BIGINT)) AS start_ts,
       CAST(end_date AS TIMESTAMP) + to_hours(CAST((road_event_id*11) % 24 AS BIGINT)) AS end_ts,
       vehicle_impact, total_num_lanes, road_name, county_name, county
FROM (SELECT c_custkey AS road_event_id,
             CAST((c_custkey*7717+53) % 40000 AS DOUBLE) AS x,
             CAST((c_custkey*4441+29) % 40000 AS DOUBLE) AS y,
             25.0 + ((c_custkey*7919) % 12000) / 1000.0 AS lat,
             -107.0 + ((c_custkey*6007) % 14000) / 1000.0 AS lng,
             DATE '1995-01-01' + CAST((c_custkey*13) % 2400 AS INTEGER) AS start_date,
             DATE '1995-01-01' + CAST((c_custkey*13) % 2400 AS INTEGER) + CAST(1 + c_custkey % 90 AS INTEGER) AS end_date,
             {_case('c_custkey % 5', VEHICLE_IMPACT_BY_MOD5)} AS vehicle_impact,
             CAST(c_custkey % 5 AS INTEGER) AS total_num_lanes,
             'Road ' || CAST(c_custkey % 97 AS VARCHAR) AS road_name,
             ' ' || lower(n_name) || ' ' AS county_name,
             c_nationkey AS county
      FROM customer JOIN nation ON c_nationkey = n_nationkey)
"""

SQL_VIEWS["county_edges"] = f"""
SELECT county_id, county_name, k,
       cx + [{', '.join(map(str, HEX_DX))}][k + 1] AS ax, cy + [{', '.join(map(str, HEX_DY))}][k + 1] AS ay,
       cx + [{', '.join(map(str, HEX_DX))}][(k + 1) % 6 + 1] AS bx, cy + [{', '.join(map(str, HEX_DY))}][(k + 1) % 6 + 1] AS b_y
FROM (SELECT n_nationkey AS county_id, n_name AS county_name,
             CAST(4000 + 8000 * (n_nationkey % 5) AS DOUBLE) AS cx,
             CAST(4000 + 8000 * (n_nationkey // 5) AS DOUBLE) AS cy FROM nation),
     range(0, 6) t(k)
"""

SQL_VIEWS["wzcrash"] = f"""
SELECT l_suppkey AS road_event_id,
       l_orderkey*10 + l_linenumber AS crash_id,
       CAST(1 + l_linenumber % 4 AS INTEGER) AS severity,
       l_discount * 10 AS distance_km,
       l_quantity / 5 AS visibility_mi,
       '[' || CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR) || 'E-1]' AS visibility_txt,
       l_tax * 10 AS precip_in,
       CAST(20 + l_partkey % 80 AS DOUBLE) AS temperature_f,
       CAST(l_orderkey % 30 AS DOUBLE) AS wind_mph,
       'Road ' || CAST(l_suppkey % 37 AS VARCHAR) AS road_name,
       CAST(24.0 * (1 + l_suppkey % 30) AS DOUBLE) AS duration_hr,
       {_case('l_suppkey % 5', VEHICLE_IMPACT_BY_MOD5)} AS vehicle_impact,
       25.0 + ((l_suppkey*7919) % 12000) / 1000.0 AS latitude,
       -107.0 + ((l_suppkey*6007) % 14000) / 1000.0 AS longitude
FROM lineitem
"""

SQL_VIEWS["scored"] = """
SELECT l_orderkey*10 + l_linenumber AS id,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
       ((l_orderkey*7 + l_linenumber*13) % 1000) / 1000.0 AS p
FROM lineitem
"""

SQL_VIEWS["counts"] = """
SELECT p_partkey AS segment_id, CAST(coalesce(n, 0) % 9 AS BIGINT) AS y, 0.1 + (p_partkey % 50) / 10.0 AS yhat
FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) ON p_partkey = l_partkey
"""

SQL_VIEWS["suntimes"] = """
SELECT lat_r, lng_r, date, sunrise, sunset,
       sunrise - INTERVAL 25 MINUTE AS civil_twilight_begin, sunset + INTERVAL 25 MINUTE AS civil_twilight_end,
       sunrise - INTERVAL 55 MINUTE AS nautical_twilight_begin, sunset + INTERVAL 55 MINUTE AS nautical_twilight_end,
       sunrise - INTERVAL 85 MINUTE AS astronomical_twilight_begin, sunset + INTERVAL 85 MINUTE AS astronomical_twilight_end
FROM (SELECT *, sunrise + INTERVAL 11 HOUR + INTERVAL 30 MINUTE AS sunset
      FROM (SELECT *, CAST(date AS TIMESTAMP) + INTERVAL 12 HOUR
                      + to_minutes(CAST((CAST(round(lat_r*10) AS BIGINT)*7 + CAST(round(-lng_r*10) AS BIGINT)*3 + day(date)) % 121 - 60 AS BIGINT)) AS sunrise
            FROM (SELECT DISTINCT round_even(lat, 1) AS lat_r, round_even(lng, 1) AS lng_r, CAST(start_time AS DATE) AS date
                  FROM crashes)))
"""

SQL_VIEWS["planar"] = """
SELECT vec_id, round(CAST(embedding[1] AS DOUBLE) * 10, 3) AS px, round(CAST(embedding[2] AS DOUBLE) * 10, 3) AS py, label
FROM embeddings
"""

# views another view depends on
_DEPENDS = {"segment_pieces": ["segments"], "suntimes": ["crashes"]}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs of the named views (and their
    dependencies).  ``body`` may itself start with ``WITH``."""
    ordered: list[str] = []

    def add(n: str) -> None:
        for dep in _DEPENDS.get(n, []):
            add(dep)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({SQL_VIEWS[n]})" for n in ordered)
    body = body.strip()
    if not ctes:
        return body
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
