"""Connected components of an edge table in a logarithmic number of rounds."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst",
                         node: str = "node", component: str = "component") -> DataFrame:
    """(node, component) for every node of ``edges``; the component is its
    smallest node. Alternates the large-star and small-star steps (every node
    hangs its larger, then its smaller neighbours below the smallest node it
    knows), so paths of any length need logarithmically many rounds. Each
    round is a written table in the shared checkpoint folder, read again in as
    many partitions as its size asks for; only a count and a checksum reach
    the driver. Self loops and null ends are ignored; no edges give no rows."""
    spark = edges.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/components-{uuid.uuid4().hex}"

    def written(table: DataFrame, step: int) -> DataFrame:
        table.write.parquet(f"{folder}/{step}")
        return spark.read.schema(table.schema).parquet(f"{folder}/{step}")

    step = 0
    pairs = written(edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).filter("u > v").distinct(), step)
    state = _checksum(pairs)
    while state[0]:
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter("u > v").distinct())
        step += 1
        pairs = written(small, step)
        after = _checksum(pairs)
        if after == state:
            break
        state = after
    # at the fixed point every node hangs directly below its component's root
    roots = pairs.select("v").distinct().select(F.col("v").alias(node), F.col("v").alias(component))
    return pairs.select(F.col("u").alias(node), F.col("v").alias(component)).unionAll(roots)


def _checksum(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]
