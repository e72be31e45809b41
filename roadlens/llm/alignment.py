"""Alignment of two tokenizers, with corpus-wide counts of the id pairs that end together.

Both tokenizers see a space and the text; tokens are byte ranges of it. Where a
token of either ends, a group ends and its two last tokens are linked.

White space after other characters starts a new stretch in both tokenizers (the
byte-level one splits there, and no piece of the other crosses it), so a text
falls into stretches that are aligned each by itself, once per distinct stretch.

1. The first pass counts the linked pairs of the texts a task holds.
2. The distinct pairs are dealt to shards by a hash, and each shard builds a
   minimal perfect hash: levels of bits, a bit set where just one of the level's
   keys falls, a key's index being the rank of its bit. Bits of all shards in
   line, ranks are indexes of the whole.
3. Every task adds its counts into a dense vector indexed by the hash, having
   verified the key at its index; the vectors are summed in a tree.
4. The second pass aligns the documents again and looks the counts up, the keys
   verified as before.

A perfect hash with its keys and counts is broadcast for at most ``most_pairs``
pairs at a time. More pairs are taken in as many further rounds, each of which
adds what its pairs give, so nothing is left out.

Edge cases: texts that are null or empty, or that either tokenizer does not
give back byte for byte, have no tokens: zeros and an empty digest; repeated
rows and equal or null doc_ids keep all their rows; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import Counter
from itertools import chain

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import token_counts
from .common import LONG_WORD, mix64, npy, ship_package, stream64, text_batches, written

#: A stretch: white space and what follows it, up to a space or line end after another character.
_STRETCH = re.compile(r"\s*\S+(?:[^\S \n]\s*\S+)*(?:[^\S \n]\s*\Z)?|\s+")
#: Keys of a shard of the perfect hash, slots of a piece of a dense vector.
SHARD_KEYS, PIECE = 32_768, 65_536
#: Vectors that meet in one node of the summing tree.
FAN_IN = 32
#: Distinct stretches a worker keeps (half of them the most recently used), and their longest.
CACHED, LONGEST_CACHED = 600_000, 64


class _Numbers(dict):
    """Numbers its keys in order of first use."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


class Pair:
    """Two tokenizers, and the alignments of stretches seen lately."""

    def __init__(self, bytes_path: str, pieces_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.a, self.b = Tokenizer.from_file(bytes_path), token_counts.model(pieces_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        byte = _byte_alphabet()
        names = self.a.get_vocab()
        self.a_bytes: list = [b""] * (max(names.values()) + 1)
        for token, i in names.items():
            # a token outside the byte alphabet (an added one) is no result of a text
            self.a_bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.ranks = _ranks(bytes_path)
        self.mark = self.b.piece_to_id("▁")
        top = max(len(self.a_bytes), len(self.b_bytes))
        self.width = np.array([len(str(i)) for i in range(top)], np.int64)
        wide = int(self.width[-1]) + 1
        self.digits = np.frombuffer("".join(str(i).ljust(wide) for i in range(top)).encode(), np.uint8).reshape(top, wide)
        self.new: dict = {}
        self.old: dict = {}

    def stretches(self, text: str) -> list[str]:
        return _STRETCH.findall(" " + text)

    def encode_a(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids in line, how many each stretch has) by the byte-level tokenizer."""
        ids = [e.ids for e in self.a.encode_batch_fast(stretches, add_special_tokens=False)]
        return np.array(list(chain.from_iterable(ids)), np.int64), np.array(list(map(len, ids)), np.int64)

    def encode_plain(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for plain stretches (see ``_PLAIN``), by merge ranks, many
        in one run: each begins at a split, so the run's ids are theirs."""
        runs = [self.ranks.encode_ordinary("".join(stretches[i:i + 5000])) for i in range(0, len(stretches), 5000)]
        flat = np.array(list(chain.from_iterable(runs)), np.int64)
        stop = np.searchsorted(np.cumsum(self.a_size[flat]), np.cumsum(list(map(len, map(str.encode, stretches))))) + 1
        return flat, np.diff(stop, prepend=0)

    def encode_b(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same by the piece model, which puts a space of its own before a text."""
        ids = self.b.encode([s[1:] if s[0] == " " else s for s in stretches], num_threads=1)
        ids = [[self.mark] if s == " " else x if s[0] == " " else x[1:] for s, x in zip(stretches, ids, strict=True)]
        return np.array(list(chain.from_iterable(ids)), np.int64), np.array(list(map(len, ids)), np.int64)

    def align_all(self, stretches) -> list:
        """For each stretch (n_a, n_b, groups as text, linked pairs as bytes), or () where bytes differ."""
        out: list = []
        unseen: tuple = ([], [])  # plain ones and others
        new, old, plain = self.new, self.old, _PLAIN.fullmatch
        for i, s in enumerate(stretches):
            x = new.get(s)
            if x is None:
                x = old.get(s)
                if x is not None:
                    new[s] = x
                else:
                    unseen[self.ranks is None or not plain(s)].append((i, s))
            out.append(x)
        for some, encode in zip(unseen, (self.encode_plain, self.encode_a), strict=True):
            own = [s for _, s in some]
            for (i, s), x in zip(some, self.align(own, encode(own), self.encode_b(own)) if own else (), strict=True):
                out[i] = x
                if len(s) <= LONGEST_CACHED:
                    new[s] = x
        if len(new) > CACHED // 2:
            self.old, self.new = new, {}
        return out

    def align(self, stretches: list[str], a: tuple, b: tuple) -> list:
        raw = [s.encode() for s in stretches]
        (flat_a, n_a), (flat_b, n_b) = a, b
        end_a, end_b = np.cumsum(self.a_size[flat_a]), np.cumsum(self.b_size[flat_b])
        ends = np.cumsum(np.array(list(map(len, raw)), np.int64))
        same = (b"".join(map(self.a_bytes.__getitem__, flat_a.tolist())) == b"".join(map(self.b_bytes.__getitem__, flat_b.tolist())) == b"".join(raw)
                and all(n.min() > 0 and (e[np.cumsum(n) - 1] == ends).all() for n, e in ((n_a, end_a), (n_b, end_b))))
        if not same:  # told apart one by one, the others again
            def parts(flat, n):
                return np.split(flat, np.cumsum(n)[:-1])
            each = list(zip(stretches, raw, parts(flat_a, n_a), parts(flat_b, n_b), strict=True))
            good = [i for i, (_, r, x, y) in enumerate(each) if b"".join(self.a_bytes[k] for k in x) == b"".join(self.b_bytes[k] for k in y) == r]
            out: list = [()] * len(raw)
            if good:
                flat, n = ([np.concatenate([each[i][c] for i in good]) for c in (2, 3)], [np.array([len(each[i][c]) for i in good]) for c in (2, 3)])
                for i, x in zip(good, self.align([stretches[i] for i in good], (flat[0], n[0]), (flat[1], n[1])), strict=True):
                    out[i] = x
            return out
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        last_a, last_b = common[group_a] == end_a, common[group_b] == end_b
        links = flat_a[last_a] << 32 | flat_b[last_b]
        # the tokens in order of the text: of each group those of the first, then those of the second
        until_a, until_b = np.cumsum(np.bincount(group_a, minlength=len(common))), np.cumsum(np.bincount(group_b, minlength=len(common)))
        order = np.empty(len(flat_a) + len(flat_b), np.int64)
        ids, mark = np.empty_like(order), np.empty(len(order), np.uint8)
        for flat, place, last, end in ((flat_a, np.arange(len(flat_a)) + np.concatenate(([0], until_b))[group_a], last_a, ord("|")),
                                       (flat_b, np.arange(len(flat_b)) + until_a[group_b], last_b, ord(";"))):
            ids[place], mark[place] = flat, np.where(last, end, ord(","))
        width = self.width[ids]
        rows = self.digits[ids]
        rows[np.arange(len(ids)), width] = mark
        text = rows[np.arange(rows.shape[1]) <= width[:, None]].tobytes()
        stop = np.cumsum(width + 1)[np.cumsum(n_a + n_b) - 1].tolist()
        link_stop = (8 * np.searchsorted(common, ends, side="right")).tolist()
        packed = links.tobytes()
        return [(x, y, text[t0:t1 - 1], packed[l0:l1]) for x, y, t0, t1, l0, l1 in
                zip(n_a.tolist(), n_b.tolist(), [0, *stop], stop, [0, *link_stop], link_stop, strict=False)]

    def documents(self, texts: list):
        """For sub-batches of texts: (alignments of the distinct stretches, the
        number of every stretch of the texts in line, where those of a text
        begin and end, whether a text has tokens)."""
        for at, to in text_batches([t or "" for t in texts], 2_000_000):
            own = texts[at:to]
            numbers, until, distinct = cut([f" {t}".encode() if t else b"" for t in own])
            found = self.align_all(distinct)
            good = np.array([bool(x) for x in found], bool)
            ok = np.diff(until) > 0
            if not good.all():
                bad = np.concatenate(([0], np.cumsum(~good[numbers])))
                ok &= bad[until[1:]] == bad[until[:-1]]
            yield found, numbers, until, ok


#: Keys of two hashes of a stretch, by place.
_KEYS = [stream64(LONG_WORD + 1, seed) for seed in (17, 19)]
#: ASCII white space as the stretches' pattern has it.
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
#: Other white space, in UTF-8 (fixed values).
_WIDE = {c.encode() for c in "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"}
_WIDE_ENDS = np.zeros(256, bool)
_WIDE_ENDS[[c[-1] for c in _WIDE]] = True


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(the number of every stretch in line, their offsets per text, the
    distinct stretches by number): ``_STRETCH`` on all texts at once. Equal
    stretches are told by two 64-bit hashes; if the two disagree, by their text."""
    joined = b"".join(texts)
    begin = np.concatenate(([0], np.cumsum(np.array(list(map(len, texts)), np.int64))))
    raw = np.frombuffer(joined, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64), []
    edge = np.flatnonzero((raw[1:] == 32) | (raw[1:] == 10)) + 1
    before = raw[edge - 1]
    edge, before = edge[~_SPACES[before]], before[~_SPACES[before]]
    wide = np.flatnonzero(_WIDE_ENDS[before])
    if len(wide):
        odd = np.array([joined[e - 3:e] in _WIDE or joined[e - 2:e] in _WIDE for e in edge[wide].tolist()], bool)
        edge = np.delete(edge, wide[odd])
    start = np.unique(np.concatenate((begin[:-1][np.diff(begin) > 0], edge)))
    size = np.diff(start, append=len(raw))
    place = np.minimum(np.arange(len(raw)) - np.repeat(start, size), LONG_WORD - 1)
    value = raw.astype(np.uint64) + np.uint64(1)
    one, two = (mix64(np.add.reduceat(k[place] * value, start) + k[LONG_WORD] * size.astype(np.uint64)) for k in _KEYS)
    for i in np.flatnonzero(size > LONG_WORD):
        digest = hashlib.blake2b(joined[start[i]:start[i] + size[i]], digest_size=16).digest()
        one[i], two[i] = int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little")
    _, first, numbers = np.unique(one, return_index=True, return_inverse=True)
    if (two[first][numbers] != two).any():
        every = [joined[x:x + n] for x, n in zip(start.tolist(), size.tolist(), strict=True)]
        number = _Numbers()
        numbers = np.array(list(map(number.__getitem__, every)), np.int64)
        distinct = [x.decode() for x in number]
    else:
        distinct = [joined[x:x + n].decode() for x, n in zip(start[first].tolist(), size[first].tolist(), strict=True)]
    return numbers, np.searchsorted(start, begin), distinct


#: Stretches that begin with a space or line end and end with another character, of characters whose classes no
#: two versions of Unicode see differently: printable ASCII, line end, tab, Latin letters.
_PLAIN = re.compile("[ \n](?:[\n\t\x20-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]*[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f])?(?<![ \n\t])")


def _ranks(path: str):
    """The byte-level tokenizer by merge ranks, or None where its file does not
    say the same: byte-level split by its pattern, no normalizer, every merge's
    product known and numbered in the order of the merges."""
    try:
        import tiktoken
    except ImportError:
        return None
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    model, split = told["model"], told.get("pre_tokenizer") or {}
    if (told.get("normalizer") is not None or model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges") or split.get("type") != "ByteLevel"
            or split.get("add_prefix_space") or not split.get("use_regex", True)):
        return None
    byte, vocab = _byte_alphabet(), model["vocab"]
    made = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    numbers = [vocab.get(m, -1) for m in made]
    if any(x >= y for x, y in zip(numbers, numbers[1:], strict=False)) or not made or numbers[0] < 256 or len(set(made)) + 256 != len(vocab):
        return None
    ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if all(c in byte for c in t)}
    return tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}) if len(ranks) == len(vocab) else None


#: The split pattern of byte-level tokenizers (a fixed value).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_alphabet() -> dict:
    """Character -> byte of byte-level vocabularies: printable Latin-1
    characters stand for themselves, the other bytes in order for U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


_pairs: dict = {}


def pair(bytes_path: str, pieces_path: str) -> Pair:
    """The worker's tokenizers of two files."""
    key = bytes_path, pieces_path
    if key not in _pairs:
        _pairs[key] = Pair(*key)
    return _pairs[key]


# ------------------------------------------------------------ perfect hash

def _hash(keys: np.ndarray, level: int) -> np.ndarray:
    return mix64(keys * np.uint64(0x9E3779B97F4A7C15) + stream64(level + 1, 13)[level])


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix64(keys ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(20)) % np.uint64(shards)


def build_levels(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bits per level, bits packed into whole 64-bit words) for distinct keys."""
    sizes, bits = [], []
    while len(keys):
        size = max(64, 2 * len(keys))
        at = (_hash(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        keys = keys[~alone[at]]
        if len(sizes) > 200:
            raise ValueError("the keys are not distinct")
    flat = np.concatenate(bits) if bits else np.zeros(0, bool)
    flat = np.pad(flat, (0, -len(flat) % 64))
    return np.array(sizes, np.int64), np.packbits(flat, bitorder="little").view(np.uint64)


class PerfectHash:
    """Index of each key of some shards, 0 to their number less 1; -1 for any
    other key once ``keys`` (the keys in order of index) is there to verify by."""

    def __init__(self, shards: int, parts: dict):
        """``parts``: shard -> (bits per level, words)."""
        self.shards = shards
        depth = max([1, *(len(s) for s, _ in parts.values())])
        self.sizes, self.bases = np.zeros((shards, depth), np.int64), np.zeros((shards, depth), np.int64)
        words, total = [], 0
        for k in sorted(parts):
            own, bits = parts[k]
            self.sizes[k, :len(own)] = own
            self.bases[k, :len(own)] = total + np.cumsum(own) - own
            words.append(bits)
            total += 64 * len(bits)
        self.words = np.concatenate([*words, np.zeros(1, np.uint64)])
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))
        self.size = int(self.before[-1])
        self.keys = None

    def index(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        if not self.size:
            return out
        shard = shard_of(keys, self.shards).astype(np.int64)
        live = np.arange(len(keys))
        for level in range(self.sizes.shape[1]):
            live = live[self.sizes[shard[live], level] > 0]
            if not len(live):
                break
            own = shard[live]
            at = self.bases[own, level] + (_hash(keys[live], level) % self.sizes[own, level].astype(np.uint64)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            found = (word >> bit) & np.uint64(1) > 0
            rank = self.before[at >> 6] + np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[live[found]] = rank[found]
            live = live[~found]
        if self.keys is not None:
            out[(out >= 0) & (self.keys[out] != keys)] = -1
        return out


class PairCounts:
    """The counted pairs of a block: a verified perfect hash over a dense vector of counts."""

    def __init__(self, spark, table: DataFrame, shards: int, low: int, high: int):
        import io

        def load(raw):
            return np.load(io.BytesIO(raw), allow_pickle=False)
        rows = table.filter(F.col("shard").between(low, high - 1)).collect()  # a block: bounded by most_pairs
        self.hash = PerfectHash(shards, {r.shard: (load(r.sizes), load(r.words)) for r in rows})
        keys = np.concatenate([np.zeros(0, np.uint64), *(load(r.keys) for r in rows)])
        ordered = np.zeros(len(keys), np.uint64)
        ordered[self.hash.index(keys)] = keys
        self.hash.keys = ordered
        self.counts = np.zeros(len(keys), np.int64)
        self.best = None


def _links(found: list) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs of stretches in line, and how many each has."""
    packed = [x[3] if x else b"" for x in found]
    return np.frombuffer(b"".join(packed), np.int64), np.array(list(map(len, packed)), np.int64) // 8


def count_links(docs: DataFrame, bytes_path: str, pieces_path: str) -> DataFrame:
    """pair (first id << 32 | second id), n: the links each task finds."""

    def count(batches):
        import pyarrow as pa
        both, sums = pair(bytes_path, pieces_path), Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())], ["pair", "n"])
        for batch in batches:
            for found, numbers, until, ok in both.documents(batch.column(0).to_pylist()):
                times = np.bincount(numbers[np.repeat(ok, np.diff(until))], minlength=len(found))
                links, size = _links(found)
                keys, own = np.unique(links, return_inverse=True)
                n = np.zeros(len(keys), np.int64)
                np.add.at(n, own, np.repeat(times, size))
                for key, k in zip(keys.tolist(), n.tolist(), strict=True):
                    if k:
                        sums[key] += k
                if len(sums) > 1_000_000:
                    yield out()
                    sums.clear()
        yield out()
    return docs.select("text").mapInArrow(count, "pair long, n long")


def perfect_hash(found: DataFrame) -> tuple[DataFrame, int]:
    """(a row per shard of the distinct pairs: shard, sizes, words, keys; the number of shards)."""
    distinct = written(found.select("pair").distinct(), "aligned-pairs")
    shards = max(1, -(-distinct.count() // SHARD_KEYS))

    def deal(batches):
        import pyarrow as pa
        for batch in batches:
            keys = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shard_of(keys.view(np.uint64), shards).astype(np.int32))], ["pair", "shard"])

    def build(key, table):
        import pyarrow as pa
        keys = table.column("pair").to_numpy().view(np.uint64)
        sizes, words = build_levels(keys)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), *(pa.array([npy(x)], pa.binary()) for x in (sizes, words, keys))],
                        ["shard", "sizes", "words", "keys"])
    return written(distinct.mapInArrow(deal, "pair long, shard int").groupBy("shard")
                   .applyInArrow(build, "shard int, sizes binary, words binary, keys binary"), "aligned-hash"), shards


def dense_counts(found: DataFrame, block) -> DataFrame:
    """piece, counts: the tasks' dense vectors (in pieces of ``PIECE`` slots) summed in a tree."""

    def add(batches):
        import pyarrow as pa
        known = block.value.hash
        total = np.zeros(known.size, np.int64)
        for batch in batches:
            at = known.index(batch.column(0).to_numpy().view(np.uint64))
            here = at >= 0
            np.add.at(total, at[here], batch.column(1).to_numpy()[here])
        pieces = [(i, total[i * PIECE:(i + 1) * PIECE]) for i in range(-(-len(total) // PIECE))]
        pieces = [(i, x) for i, x in pieces if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in pieces], pa.int32()), pa.array([TaskContext.get().partitionId()] * len(pieces), pa.int64()),
                                          pa.array([x.tobytes() for _, x in pieces], pa.binary())], ["piece", "node", "counts"])

    def merge(key, table):
        import pyarrow as pa
        total = 0
        for x in table.column("counts"):
            total = total + np.frombuffer(x.as_buffer(), np.int64)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                        ["piece", "node", "counts"])
    schema = "piece int, node long, counts binary"
    level = found.mapInArrow(add, schema)
    for _ in range(4):  # 32 ** 4 tasks and fewer
        level = level.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("long")).groupBy("piece", "node").applyInArrow(merge, schema)
    return level.withColumn("node", F.lit(0).cast("long")).groupBy("piece", "node").applyInArrow(merge, schema)


def align(docs: DataFrame, bytes_path: str, pieces_path: str, most_pairs: int = 1 << 22) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ship_package(spark)
    found = written(count_links(docs, bytes_path, pieces_path), "aligned-links")
    table, shards = perfect_hash(found)
    wide = max(1, most_pairs // SHARD_KEYS)
    best = np.zeros(1, np.int64)
    blocks = []
    for low in range(0, shards, wide):
        block = PairCounts(spark, table, shards, low, low + wide)
        shared = spark.sparkContext.broadcast(block)
        sums = written(dense_counts(found, shared), "aligned-counts")
        shared.unpersist()
        for r in sums.toLocalIterator():
            own = np.frombuffer(r.counts, np.int64)
            block.counts[r.piece * PIECE:r.piece * PIECE + len(own)] = own
        # the highest count of each second id: as many places as the vocabulary
        second = (block.hash.keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        best = np.pad(best, (0, max(0, second.max(initial=0) + 1 - len(best))))
        np.maximum.at(best, second, block.counts)
        blocks.append((low, block if shards <= wide else sums))
    state = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *(F.lit(0).cast("long").alias(c) for c in ("n_best", "count_sum")))
    for low, block in blocks:
        if shards > wide:  # told again from its table: one block at a time is in memory
            sums, block = block, PairCounts(spark, table, shards, low, low + wide)
            for r in sums.toLocalIterator():
                own = np.frombuffer(r.counts, np.int64)
                block.counts[r.piece * PIECE:r.piece * PIECE + len(own)] = own
        block.best = best
        last = low == blocks[-1][0]
        state = state.mapInArrow(_looked_up(spark.sparkContext.broadcast(block), bytes_path, pieces_path, last),
                                 _RESULT if last else "doc_id long, text string, n_best long, count_sum long")
        if not last:
            state = written(state, "aligned-documents")
    return state


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _looked_up(shared, bytes_path: str, pieces_path: str, last: bool):
    """The second pass: adds what the block's pairs give to n_best and count_sum."""

    def look_up(batches):
        import pyarrow as pa
        both, block = pair(bytes_path, pieces_path), shared.value
        for batch in batches:
            sums, digests = [], []
            for found, numbers, until, ok in both.documents(batch.column(1).to_pylist()):
                links, size = _links(found)
                keys = links.view(np.uint64)
                at = block.hash.index(keys)
                here = at >= 0
                n, high = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
                n[here] = block.counts[at[here]]
                high[here] = n[here] == block.best[links[here] & 0xFFFFFFFF]
                stop = np.concatenate(([0], np.cumsum(size)))
                each = np.zeros((len(found), 6), np.int64)
                each[:, 0], each[:, 1] = [x[0] if x else 0 for x in found], [x[1] if x else 0 for x in found]
                each[:, 2] = each[:, 3] = size
                for c, v in ((4, high), (5, n)):
                    run = np.concatenate(([0], np.cumsum(v)))
                    each[:, c] = run[stop[1:]] - run[stop[:-1]]
                run = np.concatenate((np.zeros((1, 6), np.int64), np.cumsum(each[numbers], 0)))
                sums.append((run[until[1:]] - run[until[:-1]]) * ok[:, None])
                if last:
                    texts = [x[2] if x else b"" for x in found]
                    in_line, ends = numbers.tolist(), until.tolist()
                    digests += [hashlib.sha256(b";".join([texts[i] for i in in_line[x:y]])).hexdigest() if good else ""
                                for x, y, good in zip(ends, ends[1:], ok.tolist(), strict=False)]
            table = np.concatenate([np.zeros((0, 6), np.int64), *sums])
            new = [pa.array(table[:, 4] + batch.column(2).to_numpy()), pa.array(table[:, 5] + batch.column(3).to_numpy())]
            if last:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(table[:, i]) for i in range(4)), *new, pa.array(digests, pa.string())],
                                                 ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *new], ["doc_id", "text", "n_best", "count_sum"])
    return look_up
