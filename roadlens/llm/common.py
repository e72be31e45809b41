"""Helpers shared by the operators of this package."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Words longer than this many bytes are hashed with BLAKE2 instead of the
#: vectorised multilinear hash.
LONG_WORD = 1024


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this library: where the workers' PYTHONPATH
    does not name its folder, send it along once per application."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc = spark.sparkContext
    if root in paths or getattr(sc, "_roadlens_shipped", False):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="roadlens-py-"), "roadlens_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(root, "roadlens")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)  # Spark copies it to every executor
    sc._roadlens_shipped = True


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: cuts the
    lineage and survives lost executors like a checkpoint, but is compressed."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def among(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The ``rows`` whose ``key`` is in ``keys`` (one column), and perhaps some
    more: a bitmap of 2^26 hashes in pages of 2^15 is broadcast (8 MB, whatever
    the input), so that what no join would keep is not moved."""
    hashed = F.xxhash64(F.col(key)).bitwiseAND((1 << 26) - 1)
    page, place = F.shiftright(hashed, 15).cast("int"), hashed.bitwiseAND((1 << 15) - 1)
    bitmap = (keys.toDF(key).select(page.alias("__page"), place.alias("s")).groupBy("__page")
              .agg(F.expr("bitmap_construct_agg(s)").alias("__bits")))
    byte = F.conv(F.hex(F.substring("__bits", F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (rows.withColumn("__page", page).join(F.broadcast(bitmap), "__page")
            .filter(F.getbit(byte, place.bitwiseAND(7).cast("int")) == 1).drop("__page", "__bits"))


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser on unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream64(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers (the SplitMix64 sequence of a seed)."""
    step = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix64(step + np.uint64(seed))


_POSITION = stream64(LONG_WORD + 1, 11)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 texts, A-Z lower-cased: their
    64-bit hashes in order, the start byte of each within its text, and the
    words' offsets per text (length ``len(texts) + 1``). Each text must fit
    in memory a few times over; no text is cut."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    begin = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begin[1:])
    low = _LOWER[raw]
    space = _SPACE[low]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(space) and not space[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    size = end - start
    inside = np.flatnonzero(~space)
    place = inside - np.repeat(start, size)
    part = _POSITION[np.minimum(place, LONG_WORD - 1)] * (low[inside].astype(np.uint64) + np.uint64(1))
    first = np.zeros(len(size), np.int64)
    np.cumsum(size[:-1], out=first[1:])
    h = mix64(np.add.reduceat(part, first) + _POSITION[LONG_WORD] * size.astype(np.uint64))
    for i in np.flatnonzero(size > LONG_WORD):
        import hashlib
        h[i] = int.from_bytes(hashlib.blake2b(low[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    word_at = np.searchsorted(start, begin)
    owner = np.searchsorted(begin, start, side="right") - 1
    return h, start - begin[owner], word_at


def text_batches(texts: list, size: int = 2_000_000):
    """Index ranges of consecutive texts of about ``size`` bytes together."""
    at, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t) + 1
        if total >= size:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def as_bytes(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column; null becomes empty."""
    import pyarrow as pa
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def npy(a: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, a, allow_pickle=False)
    return out.getvalue()
