"""Token-id shards: a zstandard dictionary trained on serialized id arrays,
one compressed frame per document, dictionary hash and offset index per shard.

A store is a Parquet table with one row per shard, so Spark's commit protocol
covers lost executors and any file system Spark can write:

    part, seq            the shard's place in ascending doc_id order
    start_in_part        tokens of the part before this shard
    first_doc, last_doc  statistics that let a reader skip shards
    dict_sha256          hash of the dictionary the frames need
    doc_ids              the documents, ascending
    offsets              frame i is frames[offsets[i]:offsets[i + 1]]
    n_tokens             ids of each document, the end id included
    frames               the documents' frames, each decodable alone

Beside it lies ``dictionary`` with the dictionary's bytes. Ids are
little-endian unsigned 32-bit integers.

Edge cases: a null or empty text is the end id alone; equal doc_ids keep all
their rows, in an order fixed by the text; rows with a null doc_id come first;
an empty table gives an empty store; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from array import array

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_package

#: White space of the tokenizer's split pattern (Unicode White_Space).
_WS = "\t-\r \x85\xa0  -     　"
#: White space stays with the word after it; such chunks encode independently.
_CHUNK = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")

SHARD_SCHEMA = ("part int, seq int, start_in_part long, first_doc long, last_doc long, dict_sha256 string, "
                "doc_ids array<long>, offsets array<long>, n_tokens array<long>, frames binary")
#: Cached chunks of a Python worker; a full cache starts again.
CACHE_ENTRIES = 800_000
_CHUNK_INNER = re.compile(f"[{_WS}]+[^{_WS}]")
_cache: dict[str, dict[str, bytes]] = {}
_tokenizers: dict = {}
_token_bytes: dict = {}


def tokenizer(path: str):
    """The worker's tokenizer of a file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _tokenizers:
        from tokenizers import Tokenizer
        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as serialized uint32. A byte-level tokenizer without
    normalizer never merges across the start of white space, so each distinct
    chunk is encoded once and its bytes are reused; a text that holds one of
    the tokenizer's added tokens is encoded whole."""
    tok = tokenizer(path)
    cache = _cache.setdefault(path, {})
    if len(cache) > CACHE_ENTRIES:
        cache.clear()
    added = [t.content for t in tok.get_added_tokens_decoder().values()]
    split = [None if any(a in t for a in added) else _CHUNK.findall(t) for t in texts]
    new = list(set().union(*(chunks for chunks in split if chunks)).difference(cache))
    inner = [c for c in new if _CHUNK_INNER.match(c)]
    for at in range(0, len(inner), 10_000):
        _encode_run(tok, path, inner[at:at + 10_000], cache)
    new = [c for c in new if c not in cache]
    for c, e in zip(new, tok.encode_batch_fast(new, add_special_tokens=False), strict=True):
        cache[c] = array("I", e.ids).tobytes()
    get = cache.__getitem__
    return [array("I", tok.encode(t, add_special_tokens=False).ids).tobytes() if chunks is None
            else b"".join(map(get, chunks)) for t, chunks in zip(texts, split, strict=True)]


def _encode_run(tok, path: str, chunks: list[str], cache: dict[str, bytes]) -> None:
    """Encode chunks that begin with white space in one run of text, and cut
    the ids where the chunks end; byte-level tokens have a byte per character."""
    if path not in _token_bytes:
        _token_bytes[path] = np.array([len(tok.id_to_token(i) or "") for i in range(tok.get_vocab_size())], np.int64)
    ids = np.array(tok.encode_batch_fast(["".join(chunks)], add_special_tokens=False)[0].ids, np.uint32)
    ends = np.cumsum([len(c.encode()) for c in chunks])
    reached = np.cumsum(_token_bytes[path][ids])
    stop = np.searchsorted(reached, ends) + 1
    if len(reached) and (reached[np.minimum(stop, len(ids)) - 1] == ends).all():
        raw, stop = ids.tobytes(), [0, *(4 * stop).tolist()]
        for c, a, b in zip(chunks, stop, stop[1:], strict=False):
            cache[c] = raw[a:b]


def train_dictionary(docs: DataFrame, path: str, sample_docs: int = 500, sample_chars: int = 20_000,
                     size: int = 65_536) -> bytes:
    """A dictionary from a bounded sample: the first ``sample_docs`` rows that
    Spark finds, ``sample_chars`` characters each at most. The sample changes
    the compression ratio only. Too little text gives no dictionary (empty)."""
    import zstandard
    rows = docs.select(F.substring(F.coalesce("text", F.lit("")), 1, sample_chars).alias("t")).limit(sample_docs).collect()
    samples = [b for b in encode_texts([r.t for r in rows], path) if len(b) >= 64]
    _cache.pop(path, None)
    size = min(size, sum(map(len, samples)) // 10)
    if len(samples) < 16 or size < 1024:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # samples too alike or too few to train on
        return b""


def write_store(docs: DataFrame, target: str, path: str, end_id: int = 0, shard_bytes: int = 1 << 20,
                level: int = 3, dictionary: bytes | None = None) -> None:
    """Encode ``docs`` (doc_id, text) into a new store at ``target``. One range
    shuffle puts the documents in order; a shard closes at ``shard_bytes`` of
    frames (a longer document has a shard of its own)."""
    spark = docs.sparkSession
    ship_package(spark)
    if dictionary is None:
        dictionary = train_dictionary(docs, path)
    sha = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(sha, bytearray(dictionary))], "dict_sha256 string, dictionary binary") \
        .coalesce(1).write.parquet(f"{target}/dictionary")

    def shards(batches):
        import pyarrow as pa
        import zstandard
        press = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        end = array("I", [end_id]).tobytes()
        names = [f.split()[0] for f in SHARD_SCHEMA.split(", ")]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
                 pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        ids, frames, counts, held = [], [], [], 0

        def close():
            nonlocal seq, before, ids, frames, counts, held
            offsets = [0]
            for f in frames:
                offsets.append(offsets[-1] + len(f))
            known = [i for i in ids if i is not None]
            row = [part, seq, before, min(known, default=None), max(known, default=None), sha, ids, offsets, counts, b"".join(frames)]
            seq, before = seq + 1, before + sum(counts)
            ids, frames, counts, held = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for at in range(0, len(texts), 256):
                for d, b in zip(doc_ids[at:at + 256], encode_texts(texts[at:at + 256], path), strict=True):
                    b += end
                    f = press.compress(b)
                    ids.append(d)
                    frames.append(f)
                    counts.append(len(b) // 4)
                    held += len(f)
                    if held >= shard_bytes:
                        yield close()
        if ids:
            yield close()

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(shards, SHARD_SCHEMA)
     .write.option("compression", "none").parquet(f"{target}/shards"))


def _open(spark, target: str):
    row = spark.read.parquet(f"{target}/dictionary").first()
    raw = bytes(row.dictionary)
    if hashlib.sha256(raw).hexdigest() != row.dict_sha256:
        raise ValueError(f"the dictionary of {target} does not match its hash")
    return raw, row.dict_sha256


def read_store(spark, target: str) -> DataFrame:
    """Documents of a store in rows (doc_id, start, n_tokens, ids): ``start``
    counts the ids of all documents before it, ``ids`` are the serialized
    uint32. Decompresses every frame; no prefix sum runs in one task but the
    one over a row for each written part."""
    ship_package(spark)
    raw, sha = _open(spark, target)
    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{target}/shards")

    def frames(batches):
        import pyarrow as pa
        import zstandard
        unpress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
        for batch in batches:
            for r in batch.to_pylist():
                if r["dict_sha256"] != sha:
                    raise ValueError("a shard needs another dictionary")
                start, blob, at = r["start_in_part"], r["frames"], r["offsets"]
                out = []
                for d, n, a, b in zip(r["doc_ids"], r["n_tokens"], at, at[1:], strict=False):
                    ids = unpress.decompress(blob[a:b])
                    if len(ids) != 4 * n:
                        raise ValueError(f"document {d} does not have the length of its index entry")
                    out.append((d, r["part"], start, n, ids))
                    start += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                    ["doc_id", "part", "local", "n_tokens", "ids"])

    rows = shards.mapInArrow(frames, "doc_id long, part int, local long, n_tokens long, ids binary")
    sizes = shards.groupBy("part").agg(F.sum(F.expr("aggregate(n_tokens, 0L, (a, x) -> a + x)")).alias("size"))
    base = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("base"))
    # one row for each part of the written table, so the side is bounded by its task count
    return rows.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids")


def read_document(spark, target: str, doc_id: int) -> list[list[int]]:
    """Ids of the documents of one id: only shards whose range holds it are
    read, and only its frames are decompressed."""
    import zstandard
    raw, _ = _open(spark, target)
    unpress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    found = (spark.read.schema(SHARD_SCHEMA).parquet(f"{target}/shards")
             .filter((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
             .select(F.explode(F.arrays_zip("doc_ids", "offsets", F.expr("slice(offsets, 2, size(doc_ids))").alias("ends"))).alias("x"), "frames")
             .filter(F.col("x.doc_ids") == doc_id)
             .select(F.expr("substring(frames, cast(x.offsets + 1 as int), cast(x.ends - x.offsets as int))").alias("f")))
    return [list(array("I", unpress.decompress(bytes(r.f)))) for r in found.collect()]


def token_digest(store: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids of ``read_store``."""
    return store.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
