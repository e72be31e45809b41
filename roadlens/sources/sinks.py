"""Sinks (B1-B3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, TimestampNTZType, TimestampType


def write_versioned(df: DataFrame, base: str, name: str, version: str, partition_by: str | None = "split") -> str:
    """B1: write a stamped dataset (partitioned by split, so readers prune
    by split) and append a pointer row to the manifest table."""
    path = f"{base}/{name}/version={version}"
    w = df.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    spark = df.sparkSession
    spark.createDataFrame([(name, version, path)], "name string, version string, path string") \
        .write.mode("append").parquet(f"{base}/_manifest")
    return path


def read_latest(spark: SparkSession, base: str, name: str) -> DataFrame:
    """B1: the newest version of a dataset via the manifest (one tiny
    metadata row is looked up; the data itself is read lazily)."""
    m = spark.read.parquet(f"{base}/_manifest").where(F.col("name") == name)
    path = m.agg(F.max_by("path", "version")).first()[0]
    return spark.read.parquet(path)


def export_csv(df: DataFrame, columns: list[str], path: str, ts_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """B2: keep the requested columns that exist, timestamps as text, drop
    geometry/nested columns, write CSV with a header. Returns the exported
    frame."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cols = []
    for c in columns:
        if c not in types or isinstance(types[c], (ArrayType, MapType, StructType)):
            continue
        if isinstance(types[c], (TimestampType, TimestampNTZType)):
            cols.append(F.date_format(F.col(c), ts_format).alias(c))
        else:
            cols.append(F.col(c))
    out = df.select(*cols)
    out.write.mode("overwrite").option("header", True).csv(path)
    return out


def write_summary_json(df: DataFrame, path: str, group: str, measure: str, top_key: str, top_n: int = 5) -> DataFrame:
    """A summary as JSON lines ``section, item, value``: the totals, the
    rows of each group value (a line each, so any number of groups) and the
    ``top_n`` records of the largest measure. Returns what was written."""
    value = lambda c: F.col(c).cast("double").alias("value")
    one = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(measure).alias("total"))
    total = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).cast("double").alias("value")) for c in ("rows", "total")])).alias("r"))
    total = total.select(F.lit("total").alias("section"), "r.item", "r.value")
    dist = df.groupBy(F.col(group).cast("string").alias("item")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("distribution").alias("section"), "item", value("n"))
    top = df.orderBy(F.desc(measure), F.asc(top_key)).limit(top_n).select(F.lit("top").alias("section"), F.col(top_key).cast("string").alias("item"), value(measure))
    total.unionByName(dist).unionByName(top).write.mode("overwrite").json(path)
    return df.sparkSession.read.schema("section string, item string, value double").json(path)
