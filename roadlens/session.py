"""Session helpers. The library itself never creates a session; these are for
tests, the bench and the query catalogue."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "embeddings")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "roadlens") -> SparkSession:
    """A local session configured the way the cluster jobs expect: AQE with
    skew-join splitting, UTC session time, no UI."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # split a hot grid cell even when the ranking after the join then
        # needs its own shuffle (AQE skips the split otherwise)
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        # remove reliable checkpoint files once their DataFrames are gone
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``;
    only when nothing is configured and the master is local (tests) fall back
    to a fresh temporary folder. On a cluster that would be a folder of one
    machine, so a session without the setting is an error there."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    else:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="roadlens-ckpt-"))
    return sc.getCheckpointDir()


def prepare(spark: SparkSession) -> None:
    """Runtime settings every query relies on (zone-less timestamps are read
    as wall-clock values; outputs use UTC)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this library: where the workers' PYTHONPATH
    does not name its folder, send it along once per application."""
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    sc = spark.sparkContext
    if getattr(sc, "_roadlens_shipped", False) or root in [
            os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]:
        return
    target = os.path.join(tempfile.mkdtemp(prefix="roadlens-py-"), "roadlens_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), root))
    sc.addPyFile(target)  # Spark copies it to every executor
    sc._roadlens_shipped = True
