"""Phrase collocations against brute force."""
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import types as T

from roadlens.llm import collocations

WORDS = "the of Stone stone, river glass paper! light night cold; warm engine signal é日本 a".split()


def brute(rows, least, best):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\v\f\r]", low):
            w = tuple(re.findall("[^ \t]+", piece))
            n[lang] += len(w)
            for size in (1, 2, 3, 4):
                f[lang].update(w[i:i + size] for i in range(len(w) - size + 1))
    out = set()
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}

        def inside(p, q):
            return len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
        found = []
        for p, a in cand.items():
            if any(100 * b >= 80 * a and inside(p, q) for q, b in cand.items()):
                continue
            score, _, left, right = min((2000000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:best], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return out


def test_collocations(spark, monkeypatch):
    rng = random.Random(21)
    rows = [(None, None), ("en", ""), ("en", " \t\n.,;"), ("", "empty name"), ("de", "x" * 3000 + " y" * 40), ("de", "x" * 3000 + " y\x0bz")]
    rows += [(rng.choice(["en", "en", "en", "de", None]), " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 40))) + rng.choice(["\n", "\t", "?", ""])
              + rng.choice(["Hot dog stand here", "hot dog stand\there now", "hot  dog", "new york"])) for _ in range(400)]
    rows += [("en", "very long " * 5000 + ". " + "the the the the")] + [("en", "same line of text again")] * 60
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("lang", "text", "word", "n", "h1")])
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema).repartition(5)
    want = brute(rows, 5, 2000)
    assert len(want) > 100 and {tuple(r) for r in collocations.collocations(docs, least=5).collect()} == want
    monkeypatch.setattr(collocations, "FLUSH_WORDS", 300)
    # pairs that fill more than one bitmap take more passes; few rows are the first of a fuller ranking
    assert {tuple(r) for r in collocations.collocations(docs, least=5, best=40, salts=3, max_bits=1024).collect()} == brute(rows, 5, 40)
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_shared_hashes_are_told(spark, monkeypatch):
    docs = spark.createDataFrame([("en", "one two " * 40 + "three two " * 40)], "lang string, text string")
    real, used = collocations.Hasher.words, []

    def words(self, texts):
        h, *rest = real(self, texts)
        return (h % 2 + 1 if (self.keys == collocations.Hasher(0).keys).all() else h, *rest)
    monkeypatch.setattr(collocations.Hasher, "words", words)
    monkeypatch.setattr(collocations, "ship_package", lambda s: used.append(s))
    assert {r.phrase for r in collocations.collocations(docs, least=30).collect()} == {r[2] for r in brute([("en", "one two " * 40 + "three two " * 40)], 30, 2000)}
