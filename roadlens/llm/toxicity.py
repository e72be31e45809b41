"""Toxicity by maximum-scoring segments of token log-odds.

Learning. Documents with a label count, for every word and every word prefix of
3 to 8 letters, in how many toxic and clean documents it occurs. Dirichlet
priors shrink the toxic share of each node towards that of the next shorter
prefix (the shortest towards the share of all documents); a node whose counts do
not differ significantly from its parent's share (likelihood ratio) has the
parent's, so unseen and rare words take the odds of their stem. A token's weight
is its log-odds against the base share, less a small drift, so that ordinary
prose scores below zero. Every occurrence counts in full, so that a passage
scores the same wherever it stands and whatever came before.

Search. One linear scan finds every maximal segment of a text whose score is
positive (Ruzzo and Tompa's set). The best segment of a clean text of n words
follows an extreme-value law with location ln(K n) / lambda; lambda and K are
fitted on clean calibration documents. A segment with an expected count
E = K n exp(-lambda S) of at most ``significant`` is a toxic passage. A logistic
curve over -ln E of the best segment and the total of the passages, fitted on
labelled documents that did not train the weights, gives the score.

Edge cases: null and empty texts have no segment and get the curve's value for
none; without labels of both kinds the score is the toxic share of the labels
(0 without labels); a document's label is the largest of its rows; every input
row gives one row; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package

_WORD = re.compile(r"[^\W\d_]+")
PREFIXES = range(8, 2, -1)


def nodes_of(word: str) -> list[str]:
    """The word and its prefixes, the most specific first."""
    return [word + "$", *(word[:k] for k in PREFIXES if len(word) >= k)]


class Model:
    """Weights, extreme-value law and score curve. ``spans`` finds segments."""

    def __init__(self, weights: dict[str, float], drift: float, base: float):
        self.weights, self.drift, self.base = weights, drift, base
        self.lam, self.k, self.curve, self.significant = 1.0, 1.0, None, 0.05
        self._words: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"_words": {}}

    def weight(self, word: str) -> float:
        get = self.weights.get
        for node in nodes_of(word):
            w = get(node)
            if w is not None:
                return w
        return 0.0

    def word_weights(self, words: list[str]) -> list[float]:
        known = self._words
        if len(known) > 1_000_000:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self.weight(w)
        return list(map(known.__getitem__, words))

    def weighted(self, words: list[str]):
        """(position, weight) of the words that have one."""
        return ((i, w) for i, w in enumerate(self.word_weights(words)) if w)

    def spans(self, words: list[str]) -> list[tuple[float, int, int]]:
        """(score, first word, end word) of every maximal segment, in order."""
        return maximal_segments(self.weighted(words), self.drift)

    def expected(self, score: float, n_words: int) -> float:
        return self.k * max(n_words, 1) * math.exp(-min(self.lam * score, 700.0))

    def features(self, found: list[tuple[float, int, int]], n_words: int) -> tuple[float, float]:
        best = max((s for s, _, _ in found), default=0.0)
        clear = sum(s for s, _, _ in found if self.expected(s, n_words) <= self.significant)
        return min(max(-math.log(max(self.expected(best, n_words), 1e-300)), -20.0), 60.0) / 10, math.log1p(clear)

    def score(self, found: list[tuple[float, int, int]], n_words: int) -> float:
        if self.curve is None:
            return self.base
        a, b, c = self.curve
        x, y = self.features(found, n_words)
        return 1 / (1 + math.exp(-min(max(a + b * x + c * y, -30.0), 30.0)))


def maximal_segments(weighted, drift: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments, in linear time. ``weighted`` yields
    (position, weight) of the tokens that have a weight; every token costs
    ``drift`` besides. Keeps the candidate segments with the running totals at
    their ends; a new positive token either starts a candidate or closes over
    the candidates back to the last one that began lower."""
    total, at, kept = 0.0, 0, []  # kept: [total before, total after, first, end, index of the last lower start]
    for i, w in weighted:
        total -= drift * (i - at)
        at = i + 1
        value = w - drift
        if value <= 0:
            total += value
            continue
        low, first = total, i
        total += value
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][0] >= low:
                j = kept[j][4]
            if j < 0 or kept[j][1] >= total:
                kept.append([low, total, first, i + 1, j])
                break
            low, first = kept[j][0], kept[j][2]  # the segment grows to the left, over all between
            del kept[j:]
            j -= 1
    return [(high - low, a, b) for low, high, a, b, _ in kept]


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic curve by Newton steps with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, ridge = np.zeros(3), np.diag([1e-6, 1e-2, 1e-2])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(3), x.T @ (y - p) - ridge @ beta)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, beta))


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def learn(docs: DataFrame, labels: DataFrame, max_docs: int = 40_000, lexicon: int = 100_000, least_docs: int = 3,
          prior: float = 4.0, drift: float = 0.05, least_ratio: float = 18.0) -> Model:
    """Fit a model on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic);
    leave out of ``labels`` what must not be learned from. At most ``max_docs``
    labelled documents are used, those of the smallest hash of doc_id, a fixed
    random sample; three in five train the weights and the others calibrate."""
    spark = docs.sparkSession
    ship_package(spark)
    chosen = (labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
              .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5)) < 3)).checkpoint()
    sizes = {(r.fold, r.toxic > 0): r["count"] for r in chosen.groupBy("fold", "toxic").count().collect()}
    n, bad = sum(sizes.values()), sum(v for k, v in sizes.items() if k[1])
    model = Model({}, drift, bad / n if n else 0.0)
    bad_train, n_train = sizes.get((True, True), 0), sum(v for k, v in sizes.items() if k[0])
    if not 0 < bad_train < n_train:
        return model
    # bounded by max_docs rows of a few bytes
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")

    def count(batches):
        import pyarrow as pa
        bad_in, all_in = Counter(), Counter()

        def out():
            keys = list(all_in)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([bad_in[k] for k in keys], pa.int64()),
                                               pa.array(list(all_in.values()), pa.int64())], ["node", "bad", "n"])
        for batch in batches:
            for t, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = {k for w in set(words_of(t)) for k in nodes_of(w)}
                all_in.update(found)
                if toxic:
                    bad_in.update(found)
            if len(all_in) > 500_000:
                yield out()
                bad_in.clear()
                all_in.clear()
        yield out()

    share = bad_train / n_train
    counts = (texts.filter("fold").select("text", "toxic").mapInArrow(count, "node string, bad long, n long")
              .groupBy("node").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).filter(F.col("n") >= least_docs)
              .orderBy(F.desc(F.abs(F.col("bad") - F.col("n") * share) / F.sqrt("n")), "node").limit(lexicon).collect())
    logit = lambda p: math.log(p / (1 - p))
    shares: dict[str, float] = {}
    for r in sorted(counts, key=lambda r: (len(r.node), r.node)):
        whole = r.node.endswith("$")
        stem = r.node[:-1] if whole else r.node
        above = [stem[:k] for k in PREFIXES if k < len(stem) or whole and k == len(stem)]
        parent = next((shares[p] for p in above if p in shares), share)
        good = r.n - r.bad
        ratio = 2 * ((r.bad and r.bad * math.log(r.bad / (r.n * parent))) + (good and good * math.log(good / (r.n * (1 - parent)))))
        if ratio >= least_ratio:
            shares[r.node] = (r.bad + prior * parent) / (r.n + prior)
    model.weights = {k: logit(min(max(p, 1e-4), 1 - 1e-4)) - logit(share) for k, p in shares.items()}

    def held(batches):
        import pyarrow as pa
        for batch in batches:
            out = []
            for t, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(t)
                out.append((int(toxic > 0), len(words), [s for s, _, _ in model.spans(words)]))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], ty) for i, ty in
                                              enumerate((pa.int64(), pa.int64(), pa.list_(pa.float64())))], ["toxic", "n", "scores"])

    rows = [(r.toxic, r.n, [(s, 0, 0) for s in r.scores]) for r in  # bounded by max_docs
            texts.filter("NOT fold").select("text", "toxic").mapInArrow(held, "toxic long, n long, scores array<double>").collect()]
    clean = [(max((s for s, _, _ in found), default=0.0), max(n, 1)) for toxic, n, found in rows if not toxic]
    if not clean or len(clean) == len(rows):
        return model
    best, length = np.array([c[0] for c in clean]), np.log([c[1] for c in clean])
    # Gumbel law by two quantiles, which mislabelled documents hardly move:
    # lambda q_p = ln K + ln n - ln(-ln p)
    middle, high = (float(np.quantile(best, p)) for p in (0.5, 0.95))
    model.lam = (math.log(math.log(2)) - math.log(-math.log(0.95))) / max(high - middle, 0.5)
    model.k = math.exp(model.lam * high - float(np.mean(length)) + math.log(-math.log(0.95)))
    x = np.array([model.features(found, n) for _, n, found in rows])
    model.curve = _fit_curve(x, np.array([r[0] for r in rows], float))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, n_words and ``passages``: the significant segments with
    their word range, code-point range, score and expected count."""
    spark = docs.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast(model)  # lexicon nodes at most

    def run(batches):
        import pyarrow as pa
        kind = pa.list_(pa.struct([("first_word", pa.int32()), ("end_word", pa.int32()), ("start", pa.int32()),
                                   ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
        model = held.value
        for batch in batches:
            scores, sizes, passages = [], [], []
            for t in batch.column(1).to_pylist():
                words = words_of(t)
                n, found = len(words), model.spans(words)
                scores.append(model.score(found, n))
                sizes.append(n)
                clear = [(a, b, s, e) for s, a, b in found if (e := model.expected(s, n)) <= model.significant]
                # lower() can change a text's length, so offsets come from the text itself
                at = [m.span() for m in _WORD.finditer(t)] if clear else []
                passages.append([{"first_word": a, "end_word": b, "start": at[a][0] if b <= len(at) else None,
                                  "end": at[b - 1][1] if b <= len(at) else None, "score": s, "expected": e} for a, b, s, e in clear])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(sizes, pa.int64()), pa.array(passages, kind)],
                                             ["doc_id", "score", "n_words", "passages"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double, n_words long, passages array<struct<first_word:int,end_word:int,start:int,end:int,score:double,expected:double>>")


def drop_toxic(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, all columns kept."""
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa
        model = held.value
        for batch in batches:
            keep = []
            for t in batch.column(text_at).to_pylist():
                words = words_of(t)
                keep.append(model.score(model.spans(words), len(words)) < limit)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
