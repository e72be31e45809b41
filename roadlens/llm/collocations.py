"""Phrase collocations by stripes.

Every prefix keys an associative counter of the words that follow it, its
stripe. A task counts the stripes of the texts it holds, and stripes of equal
prefix are merged elementwise (their entries meet by prefix and next word, so
the long stripe of a common word is spread over all tasks). The entry 0 of a
one-word stripe is the total of its prefix. One merged structure then gives
all that is asked: an entry is the frequency of a phrase (prefix + next word),
entry 0 that of a word, and the largest entries of a phrase seen as a prefix
and as a suffix decide whether a longer phrase subsumes it.

Two passes over the texts: stripes of one-word prefixes first; then stripes of
two- and three-word prefixes, of phrases whose adjacent pairs are all frequent
(a longer phrase is never more frequent than its pairs, so nothing is lost).
The frequent pairs reach the second pass as a bitmap of at most ``max_bits``
bits (2^19 at least). Where that is too small for them, the pass is repeated for slices of the
pairs. A bit set by another pair lets a rare phrase through, which the exact
count then drops.

Words are counted under a 64-bit hash. The second pass brings the texts of
every word that hashes like a word of a frequent pair; if two different words
share a hash there, all is counted again under another one.

Edge cases: a null text is empty, a null lang is ``und``; texts without words
add nothing; every row counts, repeated rows too; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LONG_WORD, as_bytes, mix64, ship_package, stream64, text_batches, written

#: Words a task holds before it emits its stripes.
FLUSH_WORDS = 1_000_000
#: Entries of the stripes that leave a task together.
BATCH = 1 << 17
#: Bits of a piece of the pair bitmap, as a power of two.
CHUNK = 19
_STRIPES = "lang string, h1 long, h2 long, h3 long, nexts array<long>, counts array<long>, word string"

_CLASS = np.zeros(256, np.uint8)  # 1 parts words, 2 parts pieces
_CLASS[[32, 9]] = 1
_CLASS[[ord(c) for c in ".,;:!?\n\v\f\r"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Hasher:
    """Word hashes of one seed (never 0)."""

    def __init__(self, seed: int):
        self.keys = stream64(LONG_WORD + 1, 1000 + seed)

    def words(self, texts: list[bytes]):
        """Hash and piece number of every word of the texts, their bytes and where they start and end."""
        low = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        kind = _CLASS[low]
        inner = kind == 0
        edge = np.flatnonzero(inner[1:] != inner[:-1]) + 1
        if inner[0]:
            edge = np.concatenate(([0], edge))
        start, end = edge[0::2], edge[1::2]
        if not len(start):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), low, start, end
        size = end - start
        at = np.flatnonzero(inner)
        first = np.zeros(len(size), np.int64)
        np.cumsum(size[:-1], out=first[1:])
        place = np.arange(len(at)) - np.repeat(first, size)
        part = self.keys[np.minimum(place, LONG_WORD - 1)] * (low[at].astype(np.uint64) + np.uint64(1))
        h = mix64(np.add.reduceat(part, first) + self.keys[LONG_WORD] * size.astype(np.uint64))
        for i in np.flatnonzero(size > LONG_WORD):
            raw = low[start[i]:end[i]].tobytes()
            h[i] = int.from_bytes(hashlib.blake2b(raw, digest_size=8, salt=self.keys[:2].tobytes()).digest(), "little")
        h[h == 0] = 1
        return h, np.cumsum(kind == 2, dtype=np.int64)[start], low, start, end


def lang_key(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def pair_hash(key, a, b):
    """Hash of a pair of words of a language (``b`` 0: of the word alone, whatever the language)."""
    return mix64(mix64(a + key) * np.uint64(3) + b)


class Bitmap:
    """Which pairs and words may be frequent, of one slice of the pairs."""

    def __init__(self, bits: np.ndarray, size: int, part: int, parts: int):
        self.bits, self.size, self.part, self.parts = bits, size, part, parts

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h & np.uint64(self.size - 1)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def pairs(self, h: np.ndarray):
        """(may begin a phrase in this pass, may go on in one) per pair."""
        found = self.has(h)
        if self.parts == 1:
            return found, found
        return found & ((h >> np.uint64(40)) % np.uint64(self.parts) == self.part), np.ones(len(h), bool)


def _rows(lang, prefix: list[np.ndarray], nexts: np.ndarray, counts: np.ndarray):
    """Stripes as Arrow batches; equal prefixes (lists of word hashes) are adjacent."""
    new = np.ones(len(nexts), bool)
    if len(nexts):
        new[1:] = np.any([p[1:] != p[:-1] for p in prefix], axis=0)
    ends = np.append(np.flatnonzero(new), len(nexts))
    for a, b in _spans(ends):
        yield _batch(lang, [p[ends[a]:ends[b]] for p in prefix], nexts[ends[a]:ends[b]], counts[ends[a]:ends[b]], ends[a:b] - ends[a])


def _spans(ends: np.ndarray):
    """Ranges of consecutive stripes of about ``BATCH`` entries together."""
    a = 0
    while a < len(ends) - 1:
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + BATCH, side="right")) - 1)
        yield a, b
        a = b


def _batch(lang, prefix, nexts, counts, at):
    import pyarrow as pa
    off = pa.array(np.append(at, len(nexts)).astype(np.int32))
    zero = np.zeros(len(at), np.int64)
    keys = [p[at].view(np.int64) for p in prefix] + [zero] * (3 - len(prefix))
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(at), pa.string()), *map(pa.array, keys), pa.ListArray.from_arrays(off, pa.array(nexts.view(np.int64))),
         pa.ListArray.from_arrays(off, pa.array(counts.astype(np.int64))), pa.nulls(len(at), pa.string())],
        ["lang", "h1", "h2", "h3", "nexts", "counts", "word"])


def _one_word_stripes(lang, h, piece):
    words, own, n = np.unique(h, return_inverse=True, return_counts=True)
    near = piece[1:] == piece[:-1]
    key, count = np.unique((own[:-1][near].astype(np.uint64) << np.uint64(32)) | (own[1:][near] + 1).astype(np.uint64), return_counts=True)
    key = np.concatenate((key, np.arange(len(words), dtype=np.uint64) << np.uint64(32)))
    count = np.concatenate((count, n))
    order = np.argsort(key)
    key, count = key[order], count[order]
    following = np.concatenate((np.zeros(1, np.uint64), words))[(key & np.uint64(0xFFFFFFFF)).astype(np.int64)]
    yield from _rows(lang, [words[(key >> np.uint64(32)).astype(np.int64)]], following, count)


def _longer_stripes(lang, h, piece, bitmap):
    if len(h) < 3:
        return
    begin, go = bitmap.pairs(pair_hash(lang_key(lang), h[:-1], h[1:]))
    near = piece[1:] == piece[:-1]
    begin, go = begin & near, go & near
    words, own = np.unique(h, return_inverse=True)
    start = np.flatnonzero(begin[:-1] & go[1:])
    ids, group = np.unique((own[start].astype(np.uint64) << np.uint64(32)) | own[start + 1].astype(np.uint64), return_inverse=True)
    for width in (2, 3):  # a prefix of ``width`` words has the number ``group``, its first occurrence stands at ``first``
        if not len(start):
            return
        first = np.zeros(len(ids), np.int64)
        first[group] = start
        ids, group, n = np.unique((group.astype(np.uint64) << np.uint64(32)) | own[start + width].astype(np.uint64),
                                  return_inverse=True, return_counts=True)
        at = first[(ids >> np.uint64(32)).astype(np.int64)]
        yield from _rows(lang, [h[at + i] for i in range(width)], words[(ids & np.uint64(0xFFFFFFFF)).astype(np.int64)], n)
        more = start + 2 < len(go)
        more[more] = go[start[more] + 2]
        start, group = start[more], group[more]


def _texts(lang_h: np.ndarray, low, start, end, bitmap, lang):
    """The words that may belong to a frequent pair, once each."""
    import pyarrow as pa
    h, at = np.unique(lang_h, return_index=True)
    keep = bitmap.has(pair_hash(np.uint64(0), h, np.uint64(0)))
    h, at = h[keep], at[keep]
    raw = low.tobytes()
    zero = pa.array(np.zeros(len(h), np.int64))
    empty = pa.ListArray.from_arrays(pa.array(np.zeros(len(h) + 1, np.int32)), pa.array(np.zeros(0, np.int64)))
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(h), pa.string()), pa.array(h.view(np.int64)), zero, zero, empty, empty,
         pa.array([raw[a:b].decode() for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)], pa.string())],
        ["lang", "h1", "h2", "h3", "nexts", "counts", "word"])


def stripes(docs: DataFrame, seed: int, bitmap=None) -> DataFrame:
    """The stripes that each task counts; with a broadcast ``bitmap`` those of
    two- and three-word prefixes, and the texts of the words."""

    def count(batches):
        hasher, held = Hasher(seed), {}
        total = 0

        def emit():
            for lang, parts in held.items():
                h, piece = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield from _one_word_stripes(lang, h, piece) if bitmap is None else _longer_stripes(lang, h, piece, bitmap.value)
            held.clear()
        for batch in batches:
            langs = np.array([x or "" if x is not None else "und" for x in batch.column(0).to_pylist()], object)
            texts = as_bytes(batch.column(1))
            for lang in dict.fromkeys(langs):
                own = [texts[i] for i in np.flatnonzero(langs == lang)]
                for a, b in text_batches(own, 500_000):
                    h, piece, low, start, end = hasher.words(own[a:b])
                    if not len(h):
                        continue
                    parts = held.setdefault(lang, [])
                    parts.append((h, piece + (parts[-1][1][-1] + 1 if parts else 0)))
                    total += len(h)
                    if bitmap is not None and bitmap.value.part == 0:
                        yield _texts(h, low, start, end, bitmap.value, lang)
                    if total >= FLUSH_WORDS:
                        yield from emit()
                        total = 0
        yield from emit()
    return docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(count, _STRIPES)


def merged(found: DataFrame) -> DataFrame:
    """Stripes of equal prefix merged elementwise: lang, h1, h2, h3, next, n per entry."""
    return (found.select("lang", "h1", "h2", "h3", F.explode(F.arrays_zip("nexts", "counts")).alias("x"))
            .groupBy("lang", "h1", "h2", "h3", F.col("x.nexts").alias("next")).agg(F.sum("x.counts").alias("n")))


def _bitmaps(pairs: DataFrame, n: int, max_bits: int):
    """The frequent pairs (lang, h1, next) and their words as bitmaps, one for
    each slice of the pairs; every one is at most ``max_bits`` bits."""
    parts = max(1, -(-16 * n // max_bits))
    size = 1 << max(CHUNK, min(max_bits, 48 * n // parts).bit_length() - 1)

    def places(batches):
        import pyarrow as pa
        for batch in batches:
            a, b = (batch.column(i).to_numpy().view(np.uint64) for i in (1, 2))
            lang, which = np.unique(np.array(batch.column(0).to_pylist(), object).astype(str), return_inverse=True)
            h = pair_hash(np.array([lang_key(x) for x in lang], np.uint64)[which], a, b)
            part = ((h >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
            word = [pair_hash(np.uint64(0), x, np.uint64(0)) for x in (a, b)]
            at = np.concatenate((h, *word)) & np.uint64(size - 1)
            part = np.concatenate((part, np.zeros(2 * len(a), np.int64)))  # the first slice brings the words
            where = np.unique(part * size + at.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(where >> CHUNK), pa.array(where)], ["chunk", "place"])

    def draw(batches):
        import pyarrow as pa
        drawn: dict = {}
        for batch in batches:
            chunk, place = batch.column(0).to_numpy(), batch.column(1).to_numpy() & ((1 << CHUNK) - 1)
            for c in np.unique(chunk):
                bits = drawn.setdefault(int(c), np.zeros(1 << (CHUNK - 3), np.uint8))
                np.bitwise_or.at(bits, place[chunk == c] >> 3, (1 << (place[chunk == c] & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(drawn), pa.int64()), pa.array([x.tobytes() for x in drawn.values()], pa.binary())], ["chunk", "bits"])

    table = pairs.select("lang", "h1", "next").mapInArrow(places, "chunk long, place long").repartition("chunk").mapInArrow(draw, "chunk long, bits binary")
    drawn = written(table, "collocation-bitmap")
    wide = 1 << (CHUNK - 3)
    for part in range(parts):
        bits = np.zeros(size >> 3, np.uint8)
        low = part * size >> CHUNK
        for r in drawn.filter(F.col("chunk").between(low, low + (size >> CHUNK) - 1)).toLocalIterator():
            bits[(r.chunk - low) * wide:(r.chunk - low + 1) * wide] |= np.frombuffer(r.bits, np.uint8)
        yield Bitmap(bits, size, part, parts)


def phrase_counts(docs: DataFrame, least: int = 30, max_bits: int = 1 << 28):
    """(totals, counts, words): words per lang; lang, phrase (its words'
    hashes, 1 to 4), a for every phrase that occurs ``least`` times; and h,
    word for the hashes of the phrases of two words and more."""
    spark = docs.sparkSession
    ship_package(spark)
    for seed in range(8):
        ones = written(merged(stripes(docs, seed)).filter((F.col("n") >= least) | (F.col("next") == 0)), "collocation-stripes")
        pairs = ones.filter((F.col("next") != 0) & (F.col("n") >= least))
        found = []
        for bitmap in _bitmaps(pairs, pairs.count(), max_bits):
            shared = spark.sparkContext.broadcast(bitmap)
            found.append(written(stripes(docs, seed, shared), "collocation-stripes"))
            shared.unpersist()
        texts = written(found[0].filter(F.col("word").isNotNull()).groupBy(F.col("h1").alias("h"))
                        .agg(F.min("word").alias("word"), F.max("word").alias("other")), "collocation-words")
        if not texts.filter("word <> other").take(1):
            break
    else:
        raise RuntimeError("different words share a hash under every seed")
    longer = found[0].filter(F.col("word").isNull())
    for x in found[1:]:
        longer = longer.unionByName(x)
    totals = ones.filter("next = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    one = ones.filter((F.col("next") == 0) & (F.col("n") >= least)).select("lang", F.array("h1").alias("phrase"), F.col("n").alias("a"))
    two = pairs.select("lang", F.array("h1", "next").alias("phrase"), F.col("n").alias("a"))
    more = merged(longer).filter(F.col("n") >= least).select(
        "lang", F.when(F.col("h3") == 0, F.array("h1", "h2", "next")).otherwise(F.array("h1", "h2", "h3", "next")).alias("phrase"), F.col("n").alias("a"))
    return totals, written(one.unionAll(two).unionAll(more), "collocation-phrases"), texts.select("h", "word")


def collocations(docs: DataFrame, least: int = 30, best: int = 2000, salts: int = 16, max_bits: int = 1 << 28) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``best``
    phrases of 2 to 4 words (see the module's text). Subsumption needs the
    phrases one word longer only: what subsumes a phrase from further out is
    no more frequent than one of these."""
    totals, counts, words = phrase_counts(docs, least, max_bits)
    size = F.size("phrase")
    longest = (counts.filter(size > 2)
               .select("lang", F.explode(F.array(F.slice("phrase", F.lit(1), size - 1), F.slice("phrase", F.lit(2), size - 1))).alias("phrase"), "a")
               .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = (counts.filter(size > 1).join(longest, ["lang", "phrase"], "left")
            .filter(F.coalesce(F.col("longer") * 100 < F.col("a") * 80, F.lit(True))).select("lang", "phrase", "a"))
    cut = (kept.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
           .withColumn("first", F.slice("phrase", F.lit(1), F.col("k"))).withColumn("rest", F.slice("phrase", F.col("k") + 1, size - F.col("k"))))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    score = F.expr("cast(2000000 as decimal(8, 0)) * cast(a as decimal(20, 0)) div (l + r)")
    scored = (cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", score)
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    named = (scored.select("lang", "phrase", "a", "cut", F.posexplode("phrase").alias("at", "h")).join(words, "h")
             .groupBy("lang", "phrase", "a", "cut").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
             .select("lang", F.array_join("w.word", " ").alias("phrase"), "a", "cut.l", "cut.r", "cut.score"))
    return (_first(named, best, salts).join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")))


def _first(df: DataFrame, best: int, salts: int) -> DataFrame:
    """The first ``best`` rows of each lang with their rank: first within
    salts, so that no task ranks more than ``salts * best`` rows at the end."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    own = Window.partitionBy("lang", "salt").orderBy(*order)
    some = (df.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts))).withColumn("rank", F.row_number().over(own))
            .filter(F.col("rank") <= best).drop("salt", "rank"))
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= best)
