"""Benchmark decontamination by CGK embeddings and bit-sampling LSH.

Texts are sequences of lower-cased words; a document is contaminated by an item
when some stretch of it is within ``1 - similarity`` of the item's word count
in word edits. The windows of a text start at words whose hash is the least of
some run of RUN words (winnowing), those of an item at each of its words, so a
leak has as many windows in common with its item as it has such words. The
window size is the largest of SIZES up to half of the item.

Each repetition draws a random walk (the CGK embedding: step j writes the word
under the pointer and moves on or not by a random bit of word and step) and
samples coordinates of its output. Windows with the same samples as an item's
window are candidates; windows that already differ in the first samples are
left at once. The repetitions are as many as reach ``recall`` for windows whose
embeddings agree in as many coordinates as the similarity says (see
``repetitions``). Candidates are verified with a bit-parallel edit distance of
the whole item against the stretch around them.

Items of fewer than SHORT words have no room for windows that edits spare: they
are cut into one piece more than the edits allowed, one of which every leak
holds unchanged, and looked up by pieces, which misses none.

Items are packed into chunks of bounded size; every chunk is broadcast in a
pass over the documents.

Edge cases: null and empty texts match nothing; items without words are left
out; equal rows give equal results; an empty table gives
no rows; extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_words, mix64, ship_package, stream64, text_batches

#: Every RUN consecutive words of a text hold a window start.
RUN = 8
#: Items of fewer words are found by pieces that the edits leave.
SHORT = 24
SIZES = (32, 16, 8)
SAMPLES = 5


def repetitions(recall: float, agree: float = 0.78) -> int:
    """Repetitions that find a window, whose embedding agrees in ``agree`` of
    its coordinates, with probability ``recall``. A leak has several windows,
    so it is found more surely than each of them: of items with a fifth of
    their words changed 97 % and more are, see the tests."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agree ** SAMPLES))


def window_starts(h: np.ndarray) -> np.ndarray:
    """Positions of the least hash (the last of equals) of each run."""
    if len(h) < RUN:
        return np.arange(len(h))
    runs = np.lib.stride_tricks.sliding_window_view(mix64(h + np.uint64(77))[::-1], RUN)
    return np.unique(len(h) - 1 - (np.argmin(runs, axis=1) + np.arange(len(runs))))


def all_starts(h: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``window_starts`` of texts laid end to end, border runs included: those
    only add starts."""
    if len(h) < RUN:
        return np.arange(len(h))
    m = mix64(h + np.uint64(77))
    low = m.copy()
    for step in (1, 2, 4):  # least of 8 from pairs, fours, eights
        low = np.minimum(low[:-step], low[step:])
    # a word starts a window when it is the least of a run that holds it
    least = np.zeros(len(h), bool)
    for k in range(RUN):
        least[k:k + len(low)] |= m[k:k + len(low)] == low
    edge = np.zeros(len(h), bool)  # words whose runs cross a border of texts
    for e in ends:
        edge[max(e - RUN, 0):e + RUN] = True
    return np.flatnonzero(least | edge)


class Walk:
    """One repetition for one window size: step bits and sampled steps."""

    def __init__(self, size: int, number: int):
        seeds = stream64(2 * size * 2 + 2 * SAMPLES * 4, 1000 * size + number)
        self.bits = seeds[:2 * size] | np.uint64(1)
        order = np.argsort(seeds[2 * size:4 * size], kind="stable")[:SAMPLES]
        self.steps = sorted(int(i) for i in order)
        self.size = size

    def keys(self, h: np.ndarray, start: np.ndarray, stop: np.ndarray, known: list | None = None, common: np.ndarray | None = None):
        """Sample hashes of the windows, and which windows are left: with
        ``known``, windows are dropped when their hash of the first samples is
        not among those known; at once where the first sampled word is not
        ``common`` (no word of any item). ``stop`` is the end of each window's text."""
        left = np.arange(len(start))
        at, end = start.copy(), np.minimum(start + self.size, stop)
        key, out, sample = np.zeros(len(start), np.uint64), [], 0
        for j in range(self.steps[-1] + 1):
            inside = at < end
            here = np.minimum(at, len(h) - 1)
            if known is not None and j == self.steps[0]:
                keep = common[here] | ~inside
                left, at, end, key, inside, here = left[keep], at[keep], end[keep], key[keep], inside[keep], here[keep]
            word = np.where(inside, h[here], np.uint64(0))
            if j == self.steps[sample]:
                key = mix64(key * np.uint64(3) + word + np.uint64(sample))
                sample += 1
                if known is not None:
                    keep = _among(key, known[sample - 1])
                    left, at, end, key, word, inside = left[keep], at[keep], end[keep], key[keep], word[keep], inside[keep]
                    if not len(left):
                        return key, left
                else:
                    out.append(key)
            at = at + (((word * self.bits[j]) >> np.uint64(63)).astype(np.int64) & inside)
        return (key, left) if known is not None else out


def _among(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = np.searchsorted(table, x)
    return table[np.minimum(at, len(table) - 1)] == x


def _run_keys(words: np.ndarray) -> np.ndarray:
    """A hash of each row of words."""
    key = np.full(len(words), np.uint64(words.shape[1]))
    for i in range(words.shape[1]):
        key = mix64(key * np.uint64(3) + words[:, i])
    return key


class Index:
    """Hash tables of a chunk of items."""

    def __init__(self, items: list[tuple[int, bytes]], similarity: float, recall: float):
        self.similarity = similarity
        h, _, at = hash_words([t for _, t in items])
        self.items = [(i, h[a:b]) for (i, _), a, b in zip(items, at, at[1:], strict=False) if b > a]
        self.words = np.unique(h)
        self.sets = [frozenset(w.tolist()) for _, w in self.items]
        groups: dict[int, list] = {}
        pieces: dict[int, list] = {}
        for k, (_, w) in enumerate(self.items):
            if len(w) < SHORT:  # of allowed + 1 pieces the edits leave one as it is
                parts = self.allowed(len(w)) + 1
                cuts = [len(w) * i // parts for i in range(parts + 1)]
                for x, y in zip(cuts, cuts[1:], strict=False):
                    pieces.setdefault(y - x, []).append((k, x))
                continue
            size = next(s for s in SIZES if 2 * s <= len(w))
            groups.setdefault(size, []).extend((k, s) for s in range(len(w) - size + 1))
        self.pieces = []
        for size, windows in sorted(pieces.items()):
            key = _run_keys(np.stack([self.items[k][1][x:x + size] for k, x in windows]))
            order = np.argsort(key, kind="stable")
            self.pieces.append((size, np.unique([self.items[k][1][x] for k, x in windows]), key[order], [windows[i] for i in order]))
        self.walks = []
        flat = np.concatenate([w for _, w in self.items]) if self.items else np.zeros(0, np.uint64)
        base = np.cumsum([0, *(len(w) for _, w in self.items)])
        for size, windows in sorted(groups.items()):
            start = np.array([base[k] + s for k, s in windows])
            stop = np.array([base[k + 1] for k, _ in windows])
            for number in range(repetitions(recall)):
                walk = Walk(size, number)
                stages = walk.keys(flat, start, stop)
                order = np.argsort(stages[-1], kind="stable")
                self.walks.append((walk, [np.unique(s) for s in stages], stages[-1][order], [windows[i] for i in order]))

    def allowed(self, words: int) -> int:
        return int(words * (1 - self.similarity) + 1e-9)

    def hits(self, h: np.ndarray, at: np.ndarray):
        """(start of the window, item, place of the window in the item) of all candidates."""
        common = _among(h, self.words)
        shared = np.flatnonzero(common)
        for size, firsts, table, windows in self.pieces:
            start = shared[_among(h[shared], firsts)]
            start = start[start + size <= at[np.searchsorted(at, start, side="right")]]
            yield start, _run_keys(h[start[:, None] + np.arange(size)]), table, windows
        if not self.walks:
            return
        start = all_starts(h, at[1:-1])
        stop = at[np.searchsorted(at, start, side="right")]
        for walk, stages, table, windows in self.walks:
            key, left = walk.keys(h, start, stop, stages, common)
            yield start[left], key, table, windows

    def search(self, h: np.ndarray, at: np.ndarray):
        """(text, item, first word, end word, edits) of texts laid end to end,
        ``at`` their offsets: the best stretch of each pair."""
        best: dict[tuple[int, int], tuple] = {}
        if not len(h) or not self.items:
            return []
        tried = set()
        for start, key, table, windows in self.hits(h, at):
            low, high = np.searchsorted(table, key), np.searchsorted(table, key, side="right")
            met = np.flatnonzero(high > low)
            owner = np.searchsorted(at, start[met], side="right") - 1
            for begin_at, text, a, b in zip(start[met].tolist(), owner.tolist(), low[met].tolist(), high[met].tolist(), strict=True):
                for k, s in windows[a:b]:
                    item = self.items[k][1]
                    allowed = self.allowed(len(item))
                    begin = begin_at - s - allowed
                    if (text, k, begin) in tried:
                        continue
                    tried.add((text, k, begin))
                    begin, end = max(begin, int(at[text])), min(begin + len(item) + 2 * allowed + 1, int(at[text + 1]))
                    words = h[begin:end].tolist()
                    # unchanged words of the item stand in the stretch
                    if sum(map(self.sets[k].__contains__, words)) < len(item) - allowed:
                        continue
                    found = best_stretch(item, words, allowed)
                    if found[0] <= allowed:
                        row = (found[0], begin + found[1] - int(at[text]), begin + found[2] - int(at[text]))
                        if row < best.get((text, k), (1 << 60,)):
                            best[text, k] = row
        return [(t, self.items[k][0], a, b, d) for (t, k), (d, a, b) in sorted(best.items())]


def _distances(item, words):
    """Myers' bit-parallel search: edits of the item against the best stretch
    that ends at each word."""
    n, where = len(item), {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << n - 1
    vp, vn, score, out = full, 0, n, []
    for w in words:
        m = where.get(w, 0)
        d0 = ((((m & vp) + vp) ^ vp) | m | vn) & full
        hp, hn = (vn | ~(d0 | vp)) & full, d0 & vp
        score += bool(hp & top) - bool(hn & top)
        hp, hn = hp << 1 & full, hn << 1 & full
        vp, vn = (hn | ~(d0 | hp)) & full, d0 & hp
        out.append(score)
    return out


def best_stretch(item, words, most: int | None = None) -> tuple[int, int, int]:
    """Fewest word edits between the item and a stretch of ``words``, and the
    stretch; the earliest end, then the shortest stretch, of equals. Over
    ``most`` edits the stretch is not looked for."""
    item, words = np.asarray(item).tolist(), list(words)
    if not words:
        return len(item), 0, 0
    score = _distances(item, words)
    d = min(score)
    if most is not None and d > most:
        return d, 0, 0
    end = score.index(d) + 1
    back = _distances(item[::-1], words[:end][::-1])
    return d, end - 1 - back.index(min(back)), end


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.95,
                 chunk_bytes: int = 16_000_000) -> DataFrame:
    """(doc_id, item_id, start, end, edits): the best stretch, in code points,
    of every document and item within the similarity."""
    spark = docs.sparkSession
    ship_package(spark)
    texts = benchmark.filter("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    chunks = max(1, math.ceil((size[0] or 0) / chunk_bytes))
    out = None
    for c in range(chunks):
        part = texts.filter(F.pmod(F.xxhash64("item_id"), F.lit(chunks)) == c).orderBy("item_id", "text")
        index = Index([(r.item_id, lowered(r.text)) for r in part.toLocalIterator()], similarity, recall)  # about chunk_bytes
        held = spark.sparkContext.broadcast(index)
        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            _finder(held), "doc_id long, item_id long, start long, end long, edits int")
        out = found if out is None else out.unionAll(found)
    return out


def lowered(text: str | None) -> bytes:
    """The text in lower case, of the same length in code points."""
    text = text or ""
    low = text.lower()
    return (low if len(low) == len(text) else text).encode()


def _finder(held):
    def run(batches):
        import pyarrow as pa
        index = held.value
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [lowered(t) for t in batch.column(1).to_pylist()]
            rows = []
            for a, b in text_batches(texts):
                h, byte_at, at = hash_words(texts[a:b])
                for t, item, first, end, edits in index.search(h, at):
                    raw = texts[a + t]
                    begin = int(byte_at[at[t] + first])
                    stop = int(byte_at[at[t] + end - 1])
                    while stop < len(raw) and raw[stop] not in b" \t\n\v\f\r":
                        stop += 1
                    rows.append((ids[a + t], item, len(raw[:begin].decode()), len(raw[:stop].decode()), edits))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()))], ["doc_id", "item_id", "start", "end", "edits"])
    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.95) -> DataFrame:
    """The rows of ``docs`` whose document holds no benchmark item."""
    found = contaminated(docs, benchmark, similarity, recall).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
