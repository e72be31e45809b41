"""Exact search for the k largest inner products, by KD-trees.

Components become the integers ``floor(64 * x)``, so scores are exact. Vectors
are dealt to shards by a coarse KD-tree (median splits of a bounded sample;
it decides where a vector lies, not what is found); a shard too large for a
task is dealt on by a hash. Each shard builds a KD-tree: median splits along
the widest side, down to leaves, with tight boxes of smallest and largest
component. A box bounds the scores it can hold, since ``sum(max(q * low,
q * high))`` is no less than any inner product in it.

The search goes in waves. Every query knows the boxes of all shards (a bounded
table: few shards, two corners each) and visits them best bound first: one shard in
the first wave, then 1, 2, 4, ... 64 more, and only those whose bound reaches the
k-th best score it has by then. In a shard it walks the tree best first and
stops where no box reaches its k-th score. What ties with the k-th is looked
at, as ties go to the smaller id. Whatever the bounds prune, the result is exact.

Edge cases: vectors that are null or hold null or non-finite components take no
part, neither do rows without an id; vectors of other lengths than a query's do
not meet it; a row is no candidate of queries of its own id; a query with
fewer candidates gets them all; queries repeated in the table are answered once
each; an empty table gives no rows; other columns are not read. Scores beyond
64 bits are ranked exactly and returned as the nearest 64-bit integer.
"""

from __future__ import annotations

import heapq
import io
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import npy, ship_package, written

#: Vectors of a leaf.
LEAF = 256
#: Products up to here are exact in doubles.
EXACT = 2.0 ** 53
#: Components beyond it count as infinite (no 32-bit float is), so that sums of products stay finite.
LARGEST = 1e100
_STATE = "query long, id long, dim int, code binary, seen int, scores array<double>, ids array<long>, high array<string>"


def scaled(values: list) -> np.ndarray:
    """floor(64 * x) of float32 or float64 components, as float64 (whole numbers)."""
    with np.errstate(over="ignore"):
        return np.floor(np.asarray(values, np.float64) * 64.0)


def build_tree(codes: np.ndarray, leaf: int = LEAF) -> tuple:
    """(order, first, last, child, low, high): node i holds rows
    ``order[first[i]:last[i]]``; its children are ``child[i]`` and
    ``child[i] + 1``, 0 for a leaf; ``low``, ``high`` are its tight box."""
    order = np.arange(len(codes))
    first, last, child, low, high = [0], [len(codes)], [0], [], []
    at = 0
    while at < len(first):
        a, b = first[at], last[at]
        own = codes[order[a:b]]
        low.append(own.min(0))
        high.append(own.max(0))
        with np.errstate(over="ignore", invalid="ignore"):
            side = high[-1] - low[-1]
        if b - a > leaf and (side > 0).any():
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, np.argmax(side)], middle)]
            child[at] = len(first)
            first += [a, a + middle]
            last += [a + middle, b]
            child += [0, 0]
        at += 1
    return order, np.array(first), np.array(last), np.array(child), np.array(low), np.array(high)


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The largest score that each query (row) can reach in each box (column).
    Whole numbers are summed in doubles: the result is raised by what their
    rounding may have taken where a sum can pass 2^53."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    size = np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T
    b = up @ high.T + down @ low.T
    return np.where(size < EXACT, b, b + size * (q.shape[1] * 2.0 ** -50))


class Tree:
    """A shard's KD-tree, its rows in tree order: those of node i are
    ``first[i]:last[i]``."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        order, first, last, child, self.low, self.high = build_tree(codes, leaf)
        self.first, self.last, self.child = first.tolist(), last.tolist(), child.tolist()
        self.codes, self.ids = np.ascontiguousarray(codes[order]), ids[order]
        self.most = np.abs(codes).max(0)
        self.single = self.codes.astype(np.float32) if (self.most < 2.0 ** 24).all() else None

    def products(self, q: np.ndarray):
        """A function of a row range: its exact inner products with q."""
        size = float(np.abs(q) @ self.most)
        if size < 2.0 ** 24 and self.single is not None:  # whole numbers that single precision holds
            x, v = self.single, q.astype(np.float32)
        elif size < EXACT:
            x, v = self.codes, q
        else:
            own = [int(c) for c in q]
            return lambda a, b: np.array([sum(int(c) * d for c, d in zip(row, own, strict=True)) for row in self.codes[a:b]], object)
        return lambda a, b: x[a:b] @ v

    def search(self, q: np.ndarray, own: int, reach: list, best: list, k: int) -> list:
        """The k best of ``best`` and the tree as (score, -id), a heap; nodes
        best first by ``reach``, the query's bound in every node."""
        first, last, child, products = self.first, self.last, self.child, self.products(q)
        heapq.heapify(best)
        waiting = [(-reach[0], 0)]
        while waiting:
            bound, node = heapq.heappop(waiting)
            if len(best) >= k and -bound < best[0][0]:
                break
            if c := child[node]:
                heapq.heappush(waiting, (-reach[c], c))
                heapq.heappush(waiting, (-reach[c + 1], c + 1))
                continue
            a = first[node]
            score = products(a, last[node])
            some = np.flatnonzero(score >= best[0][0]) if len(best) >= k else np.arange(len(score))
            for s, i in zip(score[some].tolist(), self.ids[a + some].tolist(), strict=True):
                if i == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (s, -i))
                elif (s, -i) > best[0]:
                    heapq.heapreplace(best, (s, -i))
        return best


def _pack(codes: np.ndarray) -> bytes:
    """Whole numbers in the smallest type that holds them."""
    most = np.abs(codes).max(initial=0)
    kind = np.int8 if most < 128 else np.int16 if most < 32768 else np.int32 if most < 2 ** 31 else np.float64
    return npy(codes.astype(kind))


def _unpack(raw: bytes) -> np.ndarray:
    return np.load(io.BytesIO(raw), allow_pickle=False).astype(np.float64)


def _coded(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """id, dim, code (the scaled vector as bytes) of the rows that take part."""
    x = F.col(vector)
    fit = x.isNotNull() & F.col(id_col).isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) <= LARGEST))

    def code(batches):
        import pyarrow as pa
        for batch in batches:
            arrays = batch.column(1)
            flat, size = arrays.flatten().to_numpy(zero_copy_only=False), np.diff(arrays.offsets.to_numpy())
            at = np.concatenate(([0], np.cumsum(size)))
            codes = scaled(flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size.astype(np.int32)),
                                              pa.array([_pack(codes[a:b]) for a, b in zip(at, at[1:], strict=False)], pa.binary())], ["id", "dim", "code"])
    return (df.filter(fit).select(F.col(id_col).cast("long").alias("id"), x.cast("array<double>").alias("v"))
            .mapInArrow(code, "id long, dim int, code binary"))


def _coarse(rows: list, target: int, total: int) -> dict:
    """Median splits of the sampled vectors, per length: (axis, value) nodes in heap order."""
    by_dim: dict = {}
    for dim, code in rows:
        by_dim.setdefault(dim, []).append(_unpack(code))
    plans = {}
    for dim, own in by_dim.items():
        if not dim:
            continue
        x = np.stack(own)
        depth = max(0, int(np.ceil(np.log2(max(1, total * len(own) / len(rows) / target)))))
        nodes, parts = [], [x]
        for _ in range(min(depth, 12)):
            halves = []
            for p in parts:
                side = p.max(0) - p.min(0) if len(p) else np.zeros(dim)
                axis = int(np.argmax(side))
                cut = float(np.median(p[:, axis])) if len(p) else 0.0
                nodes.append((axis, cut))
                halves += [p[p[:, axis] < cut], p[p[:, axis] >= cut]]
            parts = halves
        plans[dim] = nodes
    return plans


def _place(plan: list, x: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), np.int64)
    if plan:
        axis, cut = np.array([a for a, _ in plan]), np.array([c for _, c in plan])
        for _ in range(int(np.log2(len(plan) + 1))):
            at = 2 * at + 1 + (x[np.arange(len(x)), axis[at]] >= cut[at])
        at -= len(plan)
    return at


def build_shards(coded: DataFrame, k: int, target: int, sample: int) -> DataFrame:
    """A row per shard: shard, dim, ids, codes and box. Rows that k + 1 equal
    vectors of smaller id precede are in nobody's k best and left out here."""
    spark = coded.sparkSession
    kept = written(coded.withColumn("copy", F.row_number().over(Window.partitionBy("dim", "code").orderBy("id")))
                   .filter(F.col("copy") <= k + 1).drop("copy"), "kd-vectors")
    total = kept.count()
    target = max(target, total // 16_384)
    some = kept.select("dim", "code").orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    plans = spark.sparkContext.broadcast(_coarse([(r.dim, r.code) for r in some], target, total))

    def deal(batches):
        import pyarrow as pa
        for batch in batches:
            dim, code = batch.column(1).to_numpy(), batch.column(2).to_pylist()
            at = np.zeros(len(dim), np.int64)
            for d in np.unique(dim):
                own = np.flatnonzero(dim == d)
                if d:
                    at[own] = _place(plans.value.get(int(d), []), np.stack([_unpack(code[i]) for i in own]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], ["id", "dim", "code", "place"])
    dealt = written(kept.mapInArrow(deal, "id long, dim int, code binary, place long"), "kd-vectors")
    # a place with many vectors (of one group, say) becomes several shards of like size
    sizes = dealt.groupBy("dim", "place").count().withColumn("salts", F.ceil(F.col("count") / (2 * target))).drop("count")
    salted = (dealt.join(sizes, ["dim", "place"])
              .withColumn("shard", F.xxhash64("dim", "place", F.pmod(F.xxhash64("id"), F.col("salts")))))

    def tree(key, table):
        import pyarrow as pa
        codes = np.stack([_unpack(c) for c in table.column("code").to_pylist()])
        low, high = codes.min(0), codes.max(0)
        return pa.table([pa.array([key[0].as_py()]), pa.array([codes.shape[1]], pa.int32()), pa.array([npy(table.column("id").to_numpy())], pa.binary()),
                         pa.array([_pack(codes)], pa.binary()), pa.array([_pack(np.stack([low, high]))], pa.binary())],
                        ["shard", "dim", "ids", "codes", "box"])
    return written(salted.select("shard", "id", "code").groupBy("shard").applyInArrow(
        tree, "shard long, dim int, ids binary, codes binary, box binary"), "kd-shards")


def _clip(score) -> int:
    return max(-2 ** 63, min(2 ** 63 - 1, int(score)))


def top_products(df: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector: str = "embedding",
                 target: int = 8192, sample: int = 16_384, block: int = 512) -> DataFrame:
    """query_id, rank (int, from 1), vec_id, score: the k candidates of largest
    inner product, ties to the smaller id, for every row whose id is divisible
    by ``every``. ``target`` vectors make a shard (more where there would be over 16,384 shards,
    whose boxes every task knows), split by ``sample`` vectors; ``block``
    queries meet a shard together."""
    spark = df.sparkSession
    ship_package(spark)
    coded = _coded(df, id_col, vector)
    shards = build_shards(coded, k, target, sample)
    boxes = [(r.shard, r.dim, _unpack(r.box)) for r in shards.select("shard", "dim", "box").toLocalIterator()]
    by_dim = {d: ([s for s, e, _ in boxes if e == d], np.stack([b[0] for _, e, b in boxes if e == d]), np.stack([b[1] for _, e, b in boxes if e == d]))
              for d in {d for _, d, _ in boxes}}
    known = spark.sparkContext.broadcast(by_dim)
    nothing = F.array()
    state = written(coded.filter(F.pmod("id", F.lit(every)) == 0).select(
        F.monotonically_increasing_id().alias("query"), "id", "dim", "code", F.lit(0).alias("seen"), nothing.cast("array<double>").alias("scores"),
        nothing.cast("array<long>").alias("ids"), nothing.cast("array<string>").alias("high")), "kd-queries")
    step = 0

    def ahead(batches):
        """The shards that each query goes to in this wave: an array, empty where it is done."""
        import pyarrow as pa
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for r in rows:
                names, low, high = known.value[r["dim"]]
                if r["seen"] >= len(names):
                    out.append([])
                    continue
                b = bounds(_unpack(r["code"])[None], low, high)[0]
                order = np.lexsort((np.arange(len(b)), -b))[r["seen"]:r["seen"] + wide]
                least = min(_exact(r["scores"], r["high"])) if len(r["scores"]) >= k else None
                out.append([names[i] for i in order if least is None or b[i] >= least])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], [*batch.schema.names, "next"])

    def visit(key, queries, trees):
        import pyarrow as pa
        cols = ("query", "scores", "ids", "high")
        out: dict = {c: [] for c in cols}
        if trees.num_rows and queries.num_rows:
            codes, ids = _unpack(trees.column("codes")[0].as_py()), np.load(io.BytesIO(trees.column("ids")[0].as_py()), allow_pickle=False)
            made = Tree(codes, ids)
            rows = queries.to_pylist()
            for at in range(0, len(rows), 256):
                q = np.stack([_unpack(r["code"]) for r in rows[at:at + 256]])
                for r, x, b in zip(rows[at:at + 256], q, bounds(q, made.low, made.high).tolist(), strict=True):
                    have = [(s, -i) for s, i in zip(_exact(r["scores"], r["high"]), r["ids"], strict=True)]
                    found = made.search(x, r["id"], b, list(have), k)
                    new = sorted((Counter(found) - Counter(have)).elements(), reverse=True)
                    out["query"].append(r["query"])
                    out["scores"].append([float(s) for s, _ in new])
                    out["ids"].append([-i for _, i in new])
                    out["high"].append([str(int(s)) for s, _ in new] if any(abs(s) >= EXACT for s, _ in new) else [])
        types = [pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.string())]
        return pa.table([pa.array(out[c], t) for c, t in zip(cols, types, strict=True)], list(cols))

    def best_of(batches):
        """The k best of what a query had and what its shards sent."""
        import pyarrow as pa
        for batch in batches:
            scores, ids, high = [], [], []
            for r in batch.to_pylist():
                have = list(zip(_exact(r["scores"], r["high"]), r["ids"], strict=True))
                for x in r["found"] or []:
                    have += zip(_exact(x["scores"], x["high"]), x["ids"], strict=True)
                have = sorted(have, key=lambda x: (-x[0], x[1]))[:k]
                scores.append([float(s) for s, _ in have])
                ids.append([i for _, i in have])
                high.append([str(int(s)) for s, _ in have] if any(abs(s) >= EXACT for s, _ in have) else [])
            keep = [batch.column(c) for c in ("query", "id", "dim", "code", "seen")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(scores, pa.list_(pa.float64())), pa.array(ids, pa.list_(pa.int64())),
                                              pa.array(high, pa.list_(pa.string()))], ["query", "id", "dim", "code", "seen", "scores", "ids", "high"])

    while True:
        wide = 1 if step == 0 else min(64, 1 << (step - 1))
        planned = written(state.mapInArrow(ahead, _STATE + ", next array<long>"), "kd-wave")
        pairs = planned.select("query", "id", "code", "scores", "ids", "high", F.explode("next").alias("shard"))
        loads = [(r.shard, -(-r["count"] // block)) for r in pairs.groupBy("shard").count().toLocalIterator()]
        if not loads:
            break
        blocks = spark.createDataFrame(loads, "shard long, blocks long")  # a row per shard
        queries = (pairs.join(F.broadcast(blocks), "shard").withColumn("part", F.pmod(F.xxhash64("query"), F.col("blocks"))).drop("blocks"))
        trees = (shards.select("shard", "ids", "codes").withColumnRenamed("ids", "tree_ids").join(F.broadcast(blocks), "shard")
                 .select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("part"), F.col("tree_ids").alias("ids"), "codes"))
        found = (queries.groupBy("shard", "part").cogroup(trees.groupBy("shard", "part"))
                 .applyInArrow(visit, "query long, scores array<double>, ids array<long>, high array<string>"))
        # at most k candidates from each of the wave's shards
        found = found.groupBy("query").agg(F.collect_list(F.struct("scores", "ids", "high")).alias("found"))
        state = written(planned.withColumn("seen", F.col("seen") + wide).drop("next").join(found, "query", "left").mapInArrow(best_of, _STATE), "kd-queries")
        step += 1

    def results(batches):
        import pyarrow as pa
        for batch in batches:
            rows = [(r["id"], n, i, _clip(s)) for r in batch.to_pylist()
                    for n, (s, i) in enumerate(zip(_exact(r["scores"], r["high"]), r["ids"], strict=True), 1)]
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], t) for c, t in enumerate(types)], ["query_id", "rank", "vec_id", "score"])
    return state.mapInArrow(results, "query_id long, rank int, vec_id long, score long")


def _exact(scores, high) -> list:
    """Scores as exact whole numbers: the texts where doubles would not do."""
    return [int(h) for h in high] if high else list(scores)
