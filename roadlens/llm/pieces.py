"""SentencePiece encoding by N-best segmentation, and decoding.

A text, with the model's leading space, is segmented into the pieces of largest
total score. Its piece lattice falls apart at the borders of pre-tokens (no
piece crosses the start of a run of spaces, nor a line end), so the forward
Viterbi scores are computed once for each distinct pre-token. They are exact
heuristics for a backward A* search from the end of the lattice, which yields
segmentations best first; every segmentation comes from that search. The N best
of a text combine those of its pre-tokens: only the N - 1 places that lose least
by their second choice can differ from the best segmentation.

A character that no piece covers is its UTF-8 byte pieces, together at the
lowest score less 10. The order of segmentations of equal score is fixed by the
search.

Edge cases: null and empty texts have one segmentation, without pieces, of
score 0; a text may have fewer than N segmentations; every input row gives one
row; an empty table gives no rows; extra columns are not read. A literal space
mark (U+2581) in a text decodes to a space, as in the model's own decoder.
"""

from __future__ import annotations

import heapq
import zlib
from array import array
from math import inf
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_package
from .token_counts import MARK, model, pretokens

CACHE_ENTRIES = 300_000
_lattices: dict = {}


class _Kept(dict):
    """Results of a function by its argument."""

    def __init__(self, function):
        self.function = function

    def __missing__(self, key):
        self[key] = found = self.function(key)
        return found


class Lattice:
    """Segmentation of pre-tokens with the pieces of a model file."""

    def __init__(self, path: str):
        sp = model(path)
        n = sp.get_piece_size()
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        # every prefix of a piece is a key, so a search ends where no piece goes on
        self.known: dict[str, tuple[float, int] | None] = {}
        for i in normal:
            for k in range(1, len(self.pieces[i])):
                self.known.setdefault(self.pieces[i][:k], None)
            self.known[self.pieces[i]] = (sp.get_score(i), (i,))
        # the same as a tree: (score or None, ids, next) for each next character
        below: dict[str, dict] = {"": {}}
        for text in sorted(self.known, key=len, reverse=True):
            score, ids = self.known[text] or (None, ())
            below.setdefault(text[:-1], {})[text[-1]] = (score, ids, below.pop(text, {}).get)
        self.root = below[""].get
        self.lowest = min(sp.get_score(i) for i in normal if self.pieces[i].strip(MARK)) - 10.0
        self.unknown = sp.unk_id()
        self.byte_of = {i: v for v, i in self.bytes.items()}
        self.kept: dict[int, _Kept] = {}

    def edges(self, word: str):
        """Edges into each position: (start, score, ids); and the forward
        Viterbi score of every position."""
        n, root = len(word), self.root
        into: list[list] = [[] for _ in range(n + 1)]
        best = [0.0] + [-1e300] * n
        for i in range(n):
            here, get, end, covered = best[i], root, i, False
            for c in word[i:]:
                node = get(c)
                if node is None:
                    break
                end += 1
                score, ids, get = node
                if score is None:
                    continue
                if end == i + 1:
                    covered = True
                into[end].append((i, score, ids))  # a tuple of one id
                if here + score > best[end]:
                    best[end] = here + score
            if not covered:
                into[i + 1].append((i, self.lowest, self.uncovered(word[i])))
                if here + self.lowest > best[i + 1]:
                    best[i + 1] = here + self.lowest
        return into, best

    def nbest(self, pretoken: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """Up to ``n`` segmentations of a pre-token, best first."""
        return self._search(*self.edges(pretoken.replace(" ", MARK)), n)

    def _search(self, into, best, n: int):
        """Backward A* from the end: what is left to the start is known
        exactly, so of equal totals the path nearest its start goes on first,
        and long runs of ties don't fan out."""
        heap = [(-best[-1], len(best) - 1, 0, 0.0, None)]  # total, position, order, score of the tail, its pieces
        out: list[tuple[float, tuple[int, ...]]] = []
        order = 0
        while heap and len(out) < n:
            _, at, _, tail, ids = heapq.heappop(heap)
            if at == 0:
                flat: list[int] = []
                while ids:
                    flat += ids[0]
                    ids = ids[1]
                out.append((tail, tuple(flat)))
                continue
            for start, score, piece in into[at]:
                order += 1
                heapq.heappush(heap, (-(tail + score + best[start]), start, order, tail + score, (piece, ids)))
        return out

    def uncovered(self, character: str) -> tuple[int, ...]:
        """The byte pieces of a character that no piece covers."""
        raw = character.encode("utf-8", "replace")
        return tuple(self.bytes.get(b, self.unknown) for b in raw) if self.bytes else (self.unknown,)

    def ways(self, pretoken: str, n: int) -> tuple[bytes, float, float, list[tuple[float, bytes]]]:
        """The best of a pre-token's ``n`` best segmentations (ids serialized as
        uint32, score), what the second loses, and all of them."""
        found = [(score, array("I", ids).tobytes()) for score, ids in self.nbest(pretoken, n)]
        return found[0][1], found[0][0], found[0][0] - found[1][0] if len(found) > 1 else inf, found

    def encode_all(self, text: str, n: int) -> list[tuple[float, bytes]]:
        """The ``n`` best segmentations of a text, best first: score and ids
        (serialized uint32). Every pre-token is searched; the text's combine
        the choices at the n - 1 places that lose least."""
        words = pretokens(text)
        if not words:
            return [(0.0, b"")]
        kept = self.kept.setdefault(n, _Kept(lambda w: self.ways(w, n)))
        if len(kept) > CACHE_ENTRIES:
            kept.clear()
        found = list(map(kept.__getitem__, words))
        total = sum(map(itemgetter(1), found))
        parts = list(map(itemgetter(0), found))
        gaps = np.fromiter(map(itemgetter(2), found), np.float64, len(found))
        some = min(n - 1, len(gaps))
        lists = [(0.0, ())]
        # the first of equal gaps, so that the order does not hang on the partition
        for i in np.argsort(gaps, kind="stable")[:some].tolist():
            if gaps[i] < inf:
                best, own = found[i][1], found[i][3]
                lists = heapq.nsmallest(n, ((loss + best - s, (*picks, (i, k))) for loss, picks in lists for k, (s, _) in enumerate(own)))
        out = []
        for loss, picks in lists:
            held = [(i, parts[i]) for i, _ in picks]
            for i, k in picks:
                parts[i] = found[i][3][k][1]
            out.append((total - loss, b"".join(parts)))
            for i, part in held:
                parts[i] = part
        return out

    def encode(self, text: str, n: int) -> tuple[bytes, list[float]]:
        """The best segmentation's ids (serialized uint32) and the scores of
        the ``n`` best."""
        found = self.encode_all(text, n)
        return found[0][1], [score for score, _ in found]

    def segmentations(self, text: str, n: int) -> list[tuple[float, list[int]]]:
        """The ``n`` best segmentations of a text with their ids, best first."""
        return [(score, np.frombuffer(raw, np.uint32).tolist()) for score, raw in self.encode_all(text, n)]

    def decode(self, ids) -> str:
        """The text of ids: pieces joined, bytes put together, marks as spaces,
        the leading space taken off."""
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.pieces[i])
        out.append(raw.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ")[1:]


def lattice(path: str) -> Lattice:
    """The worker's lattice of a model file."""
    if path not in _lattices:
        _lattices[path] = Lattice(path)
    return _lattices[path]


def encode(docs: DataFrame, path: str, n: int = 4) -> DataFrame:
    """doc_id, ids (array of the best segmentation), scores (of the n best)."""
    ship_package(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        own = lattice(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a in range(0, len(texts), 512):
                found = [own.encode(t or "", n) for t in texts[a:a + 512]]
                ids = np.frombuffer(b"".join(f[0] for f in found), np.uint32).astype(np.int32)
                ends = np.cumsum([0, *(len(f[0]) // 4 for f in found)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, len(found)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                     pa.array([f[1] for f in found], pa.list_(pa.float64()))], ["doc_id", "ids", "scores"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>, scores array<double>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (with ``ids``) with the ``text`` that its ids stand for."""
    ship_package(encoded.sparkSession)
    at = encoded.columns.index("ids")

    def run(batches):
        import pyarrow as pa
        own = lattice(path)
        for batch in batches:
            texts = [None if ids is None else own.decode(ids) for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("text", T.StringType())]))


def encode_digest(docs: DataFrame, path: str, n: int = 4) -> DataFrame:
    """doc_id, n_pieces, scores of the n best, ids_crc32 of the best, whether
    its ids decode to the text, and nbest_crc32, that of each of the n best:
    one pass, ids do not leave the task."""
    ship_package(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        own = lattice(path)
        pieces = _Decoder(own)
        for batch in batches:
            out = []
            for t in batch.column(1).to_pylist():
                t = t or ""
                found = own.encode_all(t, n)
                best, digests = found[0][1], [zlib.crc32(raw) for _, raw in found]
                out.append((len(best) // 4, [score for score, _ in found], digests[0], pieces.decode(best) == t.replace(MARK, " "), digests))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([o[i] for o in out], t) for i, t in enumerate(
                (pa.int64(), pa.list_(pa.float64()), pa.int64(), pa.bool_(), pa.list_(pa.int64()))))],
                                                  ["doc_id", "n_pieces", "scores", "ids_crc32", "round_trip", "nbest_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_pieces long, scores array<double>, ids_crc32 long, round_trip boolean, nbest_crc32 array<long>")


class _Decoder:
    """Bytes of every id in one table, so a text is one gather."""

    def __init__(self, own: Lattice):
        self.parts = [bytes([own.byte_of[i]]) if i in own.byte_of else p.replace(MARK, " ").encode() for i, p in enumerate(own.pieces)]

    def decode(self, raw: bytes) -> str:
        return b"".join(map(self.parts.__getitem__, np.frombuffer(raw, np.uint32).tolist())).decode("utf-8", "replace")[1:]
