"""Cross-tokenizer alignment against brute force, and the perfect hash."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from roadlens.llm import alignment

ODD = [None, "", " ", "\n\n", "one", "a  b\n c", "x" * 30_000, "same text here", "same text here", "é日本😀 mark <|endoftext|> <s> </s> <unk>", "\t tab\x0bvt\x1c gs\x1cx",
       "has ▁ mark", "trail  ", "trail\t\n", "  nb　 wide   sep", "it's we'll 12345 ,,, ...", "a\r\nb\r\n\r\n c", "​zero ﻿bom é ﬁ ① \u0000 nul", "ي عربي हिन्दी 한국어",
       "word\x85next \x1f us", "tab\t tab \t\tx", "日本語のテキスト。改行\n　全角", "퟿  \U0010ffff"]
WORDS = "the of and under pressure wind Stone, glass paper. light: night internationalisation 2024 e.g. don't naïve 東京 x_y a/b".split()


def paths():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model")


def brute(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a_path, b_path = paths()
    tok, sp = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
    tok.encode_special_tokens = True
    byte = alignment._byte_alphabet()
    docs = []
    for t in texts:
        if not t:
            docs.append(None)
            continue
        a, b = tok.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)
        raw_a = [bytes(byte[c] for c in tok.id_to_token(i)) for i in a]
        raw_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + t).encode():
            docs.append(None)
            continue
        end_a, end_b = np.cumsum([len(x) for x in raw_a]), np.cumsum([len(x) for x in raw_b])
        links = [(a[i], b[j]) for i in range(len(a)) for j in np.flatnonzero(end_b == end_a[i])]
        cuts = sorted(set(end_a) & set(end_b))
        groups, i, j = [], 0, 0
        for c in cuts:
            i1, j1 = i, j
            while i1 < len(a) and end_a[i1] <= c:
                i1 += 1
            while j1 < len(b) and end_b[j1] <= c:
                j1 += 1
            groups.append(",".join(map(str, a[i:i1])) + "|" + ",".join(map(str, b[j:j1])))
            i, j = i1, j1
        docs.append((len(a), len(b), groups, links))
    n = Counter(x for d in docs if d for x in d[3])
    best = {}
    for (_, b), k in n.items():
        best[b] = max(k, best.get(b, 0))
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (d[0], d[1], len(d[2]), len(d[3]), sum(n[x] == best[x[1]] for x in d[3]), sum(n[x] for x in d[3]), hashlib.sha256(";".join(d[2]).encode()).hexdigest())
            for d in docs]


def test_alignment(spark, monkeypatch):
    rng = random.Random(41)
    texts = ODD + [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 60))) + rng.choice(["", "\n", " \t", "  "]) for _ in range(120)]
    texts += ["".join(rng.choice(" \n\t ab9.é日'") for _ in range(30)) for _ in range(300)] + ["the wind " * 4000]
    rows = [(None if i == 5 else 3 * (i // 2), t, "x", 1, 2) for i, t in enumerate(texts)]  # ids repeat, one is null
    docs = spark.createDataFrame(rows, "doc_id long, text string, pair string, n_a long, node long").repartition(4)
    want = Counter((r[0], *x) for r, x in zip(rows, brute(texts), strict=True))
    assert sum(x[2] > 0 for x in want) > 300
    assert Counter(tuple(r) for r in alignment.align(docs, *paths()).collect()) == want
    # several shards of the hash, several rounds, several pieces of a vector
    for name, value in (("SHARD_KEYS", 64), ("PIECE", 16), ("FAN_IN", 2), ("CACHED", 40)):
        monkeypatch.setattr(alignment, name, value)
    assert Counter(tuple(r) for r in alignment.align(docs, *paths(), most_pairs=512).collect()) == want
    assert alignment.align(docs.limit(0), *paths()).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r) for r in alignment.align(nothing, *paths()).collect()) == [(1, *[0] * 6, ""), (2, *[0] * 6, "")]


def test_perfect_hash():
    rng = np.random.default_rng(42)
    keys = np.unique(rng.integers(0, 2 ** 62, 5000).astype(np.uint64))
    for shards in (1, 7):
        own = alignment.shard_of(keys, shards)
        parts = {k: alignment.build_levels(keys[own == k]) for k in range(shards) if (own == k).any()}
        table = alignment.PerfectHash(shards, parts)
        index = table.index(keys)
        assert table.size == len(keys) and sorted(index) == list(range(len(keys)))
        table.keys = np.zeros(len(keys), np.uint64)
        table.keys[index] = keys
        other = np.setdiff1d(rng.integers(0, 2 ** 62, 5000).astype(np.uint64), keys)
        assert (table.index(other) == -1).all() and (table.index(keys) == index).all()
    assert alignment.PerfectHash(1, {}).index(keys[:3]).tolist() == [-1, -1, -1]


def test_plain_stretches_are_encoded_alike():
    """Merge ranks give the ids of the tokenizer itself on every kind of plain stretch."""
    both = alignment.pair(*paths())
    assert both.ranks is not None
    rng = random.Random(43)
    plain = [chr(c) for c in [10, 9, *range(32, 127), *range(0xC0, 0x180)] if c not in (0xD7, 0xF7)]
    texts = ["".join(rng.choice(plain) for _ in range(rng.randint(1, 40))) for _ in range(4000)] + ["'s 're's\n'll '" + c + "x " + c for c in plain]
    seen = {s for t in texts for s in both.stretches(t) if alignment._PLAIN.fullmatch(s)}
    own = sorted(seen)
    assert len(own) > 4000 and not any(s[-1].isspace() or s[0] not in " \n" for s in own)
    for x, y in zip(both.encode_plain(own), both.encode_a(own), strict=True):
        assert (x == y).all()
    assert not alignment._PLAIN.fullmatch(" ") and not alignment._PLAIN.fullmatch("\n ") and not alignment._PLAIN.fullmatch(" 日")


def test_texts_are_cut_at_once(monkeypatch):
    """All texts together fall into the stretches that each gives alone, with odd white space and equal hashes."""
    rng = random.Random(44)
    odd = " \n\t\x0b\x1c\x85\xa0\u1680\u2003\u2028\u202f\u205f\u3000\u200b\ufeff"
    texts = ["".join(rng.choice(odd + "ab.é\u00a9\u2020日😀") for _ in range(rng.randint(0, 25))) for _ in range(3000)] + ["x" * 3000, "x" * 3000 + " y", ""]
    for keys in (alignment._KEYS, [alignment._KEYS[0] * 0, alignment._KEYS[1]]):
        monkeypatch.setattr(alignment, "_KEYS", keys)
        numbers, until, distinct = alignment.cut([f" {t}".encode() if t else b"" for t in texts])
        assert len(set(distinct)) == len(distinct)
        for t, a, b in zip(texts, until, until[1:], strict=False):
            assert [distinct[i] for i in numbers[a:b]] == (alignment._STRETCH.findall(" " + t) if t else [])
    assert alignment.cut([])[2] == [] and alignment.cut([b""])[1].tolist() == [0, 0]
