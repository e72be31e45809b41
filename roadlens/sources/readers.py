"""Scans / sources (A1-A11). Readers take landed files (the network clients
of the reference are out of scope) and always declare a schema."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.cleaning import to_timestamp_coerce


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location
    (``spark.checkpoint.dir``); never a machine-local temporary folder."""
    from ..session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/roadlens-io/{name}-{uuid.uuid4().hex}"


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A1: CSV with header and declared types (no inference pass)."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_json_feed(spark: SparkSession, path: str, schema: StructType | str, date_fmt: str = "yyyy-MM-dd",
                   coords: str = "geometry.coordinates", county: str = "county",
                   fallback: str = "subidentifier") -> DataFrame:
    """A2: JSON feed of work zones -> rows: first coordinate -> lon/lat,
    dates parsed (bad -> null), rows without coordinates dropped, county
    falls back to the sub-identifier."""
    raw = spark.read.schema(schema).json(path)
    c = F.col(coords)
    first = F.get(c, 0)
    out = raw.withColumns({
        "lon": F.get(first, 0), "lat": F.get(first, 1),
        "start_ts": to_timestamp_coerce("start_date", date_fmt),
        "end_ts": to_timestamp_coerce("end_date", date_fmt),
        "county_name": F.coalesce(F.col(county), F.col(fallback)),
    })
    if "core_details" in raw.columns:
        # A5: road names list -> one text, 'Unknown' when absent or empty
        names = F.concat_ws(", ", F.col("core_details.road_names"))
        out = out.withColumn("road_names", F.when(names == "", F.lit("Unknown")).otherwise(names))
    return out.where(F.col("lon").isNotNull() & F.col("lat").isNotNull())


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """A3: nested structs -> flat columns named ``a.b.c`` (plan-time walk of
    the schema; arrays stay as they are)."""
    cols: list[Column] = []

    def walk(dt, path: list[str]):
        if isinstance(dt, StructType):
            for f in dt.fields:
                walk(f.dataType, path + [f.name])
        else:
            ref = F.col(".".join(f"`{p}`" for p in path))
            cols.append(ref.alias(sep.join(path)))

    walk(df.schema, [])
    return df.select(*cols)


def read_geojson(spark: SparkSession, path: str, properties: StructType) -> DataFrame:
    """A4: FeatureCollection documents (one per line, many files) -> one row
    per feature with its properties and coordinates."""
    schema = StructType.fromJson({"type": "struct", "fields": [
        {"name": "type", "type": "string", "nullable": True, "metadata": {}},
        {"name": "features", "nullable": True, "metadata": {}, "type": {
            "type": "array", "containsNull": True, "elementType": {"type": "struct", "fields": [
                {"name": "type", "type": "string", "nullable": True, "metadata": {}},
                {"name": "properties", "type": properties.jsonValue(), "nullable": True, "metadata": {}},
                {"name": "geometry", "nullable": True, "metadata": {}, "type": {"type": "struct", "fields": [
                    {"name": "type", "type": "string", "nullable": True, "metadata": {}},
                    {"name": "coordinates", "type": {"type": "array", "elementType": "double", "containsNull": True},
                     "nullable": True, "metadata": {}}]}}]}}}]})
    fc = spark.read.schema(schema).json(path)
    feats = fc.select(F.explode("features").alias("f"))
    return feats.select("f.properties.*", F.col("f.geometry.type").alias("geometry_type"),
                        F.get("f.geometry.coordinates", 0).alias("lon"), F.get("f.geometry.coordinates", 1).alias("lat"))


def with_json_fields(df: DataFrame, column: str, schema: StructType | str, prefix: str = "") -> DataFrame:
    """A5: JSON text column -> typed fields; bad JSON -> null fields
    (PERMISSIVE), single quotes tolerated (Python-literal text)."""
    parsed = F.from_json(F.col(column), schema, {"mode": "PERMISSIVE", "allowSingleQuotes": "true"})
    t = df.withColumn("_j", parsed)
    names = (schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).fieldNames()
    return t.select(*df.columns, *[F.col(f"_j.{n}").alias(prefix + n) for n in names])


def read_geometry(spark: SparkSession, path: str, geometry: str = "geometry", crs: int = 4326) -> DataFrame:
    """A6 (re-aimed from GeoPackage/GDB): parquet with a coordinate-array
    geometry; coordinates in EPSG:3857 are normalised to EPSG:4326."""
    from ..functions.geo import inverse_mercator
    df = spark.read.parquet(path)
    if crs == 4326:
        return df
    if crs != 3857:
        raise ValueError(f"unsupported CRS {crs}")

    def to_ll(p):
        lon, lat = inverse_mercator(p["x"], p["y"])
        return F.struct(lon.alias("x"), lat.alias("y"))
    return df.withColumn(geometry, F.transform(geometry, to_ll))


def combine_pages(spark: SparkSession, directory: str, where: Column | None = None) -> DataFrame:
    """A10 (re-aimed from paged HTTP): all landed page files of one extract ->
    one table, short pages included; the filter is pushed into the scan."""
    df = spark.read.parquet(directory)
    return df if where is None else df.where(where)


def union_tagged(frames: dict[str, DataFrame], tags: dict[str, dict]) -> DataFrame:
    """Concatenate extracts, each tagged with its constant columns;
    extracts whose key is not in the tag dimension are skipped."""
    out = None
    for key, df in frames.items():
        if key not in tags:
            continue
        t = df.withColumns({k: F.lit(v) for k, v in tags[key].items()})
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out
