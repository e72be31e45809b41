"""Embedding near-duplicates over hierarchical navigable small-world graphs.

Vectors are dealt to shards; each shard builds a layered graph, which is a table
with a row per vector, so no row is larger than a vector and its neighbours. Every
vector queries every shard: bundles of blocks of queries meet each shard's graph in
a task of their own, which for every block widens its beams until an audit of the
block's queries with ``id % 20 = 0`` against the whole shard reaches the target
recall, and widens single queries whose beam is full of links. Links are verified
in double precision, counted, and joined into components inside the task, so a
large group of copies leaves rows in proportion to its members, not to its pairs.

Edge cases: null vectors, zero vectors and vectors with null or non-finite
components link with nothing; vectors of different lengths do not link; rows
without an id are left out; rows of equal id are one vector, the smallest;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import ship_package, written

#: Neighbours a node keeps, candidates looked at while building, first beam.
NEIGHBOURS, BUILD_BEAM, FIRST_BEAM = 24, 48, 48
#: Each layer holds one in LAYER nodes of the layer below.
LAYER = 16
#: A shard's graph is sent to this many bundles of blocks, to more where one would have over ``BUNDLE_ROWS`` queries.
BUNDLES, BUNDLE_ROWS = 16, 1 << 16
#: Marks of seen nodes that searches hold together (32 MB).
SEEN = 32_000_000


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of float64 scaled to length 1 (large components first scaled down)."""
    x = vectors / np.abs(vectors).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def beam_search(adj: np.ndarray, x: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int, expand: int = 4):
    """Best-first search of many queries together: ids and similarities,
    best first, (len(q), beam); -1 where fewer nodes are reachable."""
    nq, n, m = len(q), len(adj), adj.shape[1]
    seen = np.zeros((nq, n), bool)
    ids = np.full((nq, beam), -1, np.int32)
    sims = np.full((nq, beam), -np.inf, np.float32)
    done = np.ones((nq, beam), bool)
    ids[:, 0] = entry
    sims[:, 0] = np.einsum("ij,ij->i", x[entry], q)
    done[:, 0] = False
    seen[np.arange(nq), entry] = True
    live = np.arange(nq)
    e = min(expand, beam)
    while len(live):
        waiting = np.where(done[live], -np.inf, sims[live])
        pick = np.argpartition(-waiting, e - 1, axis=1)[:, :e] if e < beam else np.argsort(-waiting, axis=1)[:, :e]
        valid = np.take_along_axis(waiting, pick, 1) > -np.inf
        go = valid.any(1)
        live, pick, valid = live[go], pick[go], valid[go]
        if not len(live):
            break
        node = np.where(valid, ids[live[:, None], pick], -1)
        done[live[:, None], pick] = True
        new_ids = np.full((len(live), e * m), -1, np.int32)
        for k in range(e):
            near = np.where(node[:, k:k + 1] >= 0, adj[node[:, k]], -1)
            r, c = np.nonzero(near >= 0)
            v = near[r, c]
            fresh = ~seen[live[r], v]
            r, c, v = r[fresh], c[fresh], v[fresh]
            seen[live[r], v] = True
            new_ids[r, k * m + c] = v
        r, c = np.nonzero(new_ids >= 0)
        new_sims = np.full(new_ids.shape, -np.inf, np.float32)
        new_sims[r, c] = np.einsum("ij,ij->i", x[new_ids[r, c]], q[live[r]])
        all_ids, all_sims = np.concatenate((ids[live], new_ids), 1), np.concatenate((sims[live], new_sims), 1)
        all_done = np.concatenate((done[live], new_ids < 0), 1)
        best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        ids[live], sims[live], done[live] = (np.take_along_axis(a, best, 1) for a in (all_ids, all_sims, all_done))
    order = np.argsort(-sims, axis=1)
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _diverse(x: np.ndarray, cand: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
    """Of each row's candidates (best first, -1 empty) those that are nearer
    to the row's node than to any kept before them; free places take the
    nearest others."""
    ok = cand >= 0
    v = x[np.maximum(cand, 0)]
    between = np.matmul(v, v.transpose(0, 2, 1))
    chosen = np.zeros(cand.shape, bool)
    for j in range(cand.shape[1]):
        blocked = (chosen[:, :j] & (between[:, j, :j] > sims[:, j:j + 1])).any(1)
        chosen[:, j] = ok[:, j] & ~blocked & (chosen[:, :j].sum(1) < keep)
    rank = np.where(chosen, 0, np.where(ok, 1, 2)) * cand.shape[1] + np.arange(cand.shape[1])
    order = np.argsort(rank, axis=1)[:, :keep]
    out = np.take_along_axis(np.where(ok, cand, -1), order, 1)
    return np.pad(out, ((0, 0), (0, keep - out.shape[1])), constant_values=-1)


def _link(x, adj, nodes, cand, sims):
    """Give ``nodes`` their neighbours and the neighbours the way back."""
    keep = adj.shape[1]
    adj[nodes] = _diverse(x, cand, sims, keep)
    rows, cols = np.nonzero(adj[nodes] >= 0)
    target, source = adj[nodes[rows], cols], nodes[rows]
    targets = np.unique(target)
    old_t, old_c = np.nonzero(adj[targets] >= 0)
    t = np.concatenate((targets[old_t], target))
    s = np.concatenate((adj[targets[old_t], old_c], source))
    t, s = np.unique(np.stack((t, s)), axis=1)
    sim = np.einsum("ij,ij->i", x[t], x[s])
    order = np.lexsort((-sim, t))
    t, s, sim = t[order], s[order], sim[order]
    first = np.searchsorted(t, targets)
    place = np.arange(len(t)) - first[np.searchsorted(targets, t)]
    wide = keep + keep // 2
    fits = place < wide
    c = np.full((len(targets), wide), -1, np.int32)
    w = np.full((len(targets), wide), -np.inf, np.float32)
    at = np.searchsorted(targets, t[fits])
    c[at, place[fits]], w[at, place[fits]] = s[fits], sim[fits]
    for a in range(0, len(targets), 2048):
        adj[targets[a:a + 2048]] = _diverse(x, c[a:a + 2048], w[a:a + 2048], keep)


def _enter_all(adj: np.ndarray) -> None:
    """Every node that no other one points to takes the last place of its
    nearest neighbour whose occupant can be spared."""
    into = np.bincount(adj[adj >= 0], minlength=len(adj))
    for node in np.flatnonzero(into == 0):
        for near in adj[node][adj[node] >= 0]:
            last = adj[near, -1]
            if last < 0 or into[last] > 1:
                adj[near, -1] = node
                into[node] += 1
                if last >= 0:
                    into[last] -= 1
                break


def _entries(x, layers, q, upto):
    """Where queries enter layer ``upto``: greedy descent through those above."""
    at = np.zeros(len(q), np.int32)
    for adj in layers[:upto]:
        for a in range(0, len(q), 512):
            at[a:a + 512] = beam_search(adj, x, q[a:a + 512], at[a:a + 512], 4, 1)[0][:, 0]
    return at


def build_graph(x: np.ndarray) -> list[np.ndarray]:
    """Adjacency of every layer, the top first; layer nodes are the first rows
    of ``x`` (float32 unit rows in random order), so the layers nest."""
    sizes = [len(x)]
    while sizes[-1] > 4 * LAYER:
        sizes.append(max(sizes[-1] // LAYER, 1))
    layers: list[np.ndarray] = []
    for depth, n in enumerate(sizes[::-1]):
        adj = np.full((n, NEIGHBOURS), -1, np.int32)
        have = min(n, 2 * LAYER)
        near = x[:have] @ x[:have].T
        np.fill_diagonal(near, -np.inf)
        if have > 1:
            order = np.argsort(-near, axis=1)[:, :have - 1].astype(np.int32)
            _link(x, adj, np.arange(have), order, np.take_along_axis(near, order, 1))
        while have < n:
            take = min(n - have, have, 512)
            q = x[have:have + take]
            entry = _entries(x, layers, q, depth)
            entry = np.where(entry < have, entry, 0)  # the entered node may not be placed in this layer yet
            step = max(1, SEEN // have)
            found = [beam_search(adj[:have], x, q[a:a + step], entry[a:a + step], BUILD_BEAM) for a in range(0, take, step)]
            ids, sims = (np.concatenate(v) for v in zip(*found, strict=True))
            own = q @ q.T
            np.fill_diagonal(own, -np.inf)
            k = min(take - 1, NEIGHBOURS)
            if k:
                mates = np.argpartition(-own, k - 1, axis=1)[:, :k]
                ids = np.concatenate((ids, (mates + have).astype(np.int32)), 1)
                sims = np.concatenate((sims, np.take_along_axis(own, mates, 1)), 1)
            order = np.argsort(-sims, axis=1)[:, :BUILD_BEAM]
            _link(x, adj, np.arange(have, have + take), np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1))
            have += take
        _enter_all(adj)
        layers.append(adj)
    return layers


def range_search(x, layers, q, threshold: float, beam: int):
    """For each query the ids and similarities at or over ``threshold`` that
    beams find; a beam that is mostly links is doubled for its query."""
    base, n = layers[-1], len(x)
    entry = _entries(x, layers, q, len(layers) - 1)
    out: list = [None] * len(q)
    todo, width = np.arange(len(q)), min(beam, n)
    while len(todo):
        step = max(1, min(512, SEEN // n))
        again = []
        for a in range(0, len(todo), step):
            rows = todo[a:a + step]
            ids, sims = beam_search(base, x, q[rows], entry[rows], width)
            hits = (sims >= threshold) & (ids >= 0)
            full = (hits.sum(1) * 4 >= width * 3) & (width < n)
            for i in np.flatnonzero(~full):
                out[rows[i]] = ids[i, hits[i]]
            again.append(rows[full])
        todo, width = np.concatenate(again), min(2 * width, n)
    return out


class _Union:
    """Disjoint sets over 0..n-1 whose root is the member of smallest id."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.up = ids, list(range(len(ids)))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            if self.ids[i] > self.ids[j]:
                i, j = j, i
            self.up[j] = i


def _units(column, order: np.ndarray, kind) -> np.ndarray:
    """Unit rows of an Arrow list column, its row ``order[i]`` as row i, some
    rows at a time: the column itself is not copied."""
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    out, at = None, 0
    for chunk in column.chunks:
        for a in range(0, len(chunk), 10_000):
            part = chunk.slice(a, 10_000)
            x = part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
            out = np.empty((len(order), x.shape[1]), kind) if out is None else out
            out[place[at:at + len(part)]] = unit_rows(x)
            at += len(part)
    return out


def _build(table):
    """Rows ``rep, at, links``: a node's place in the graph and its neighbours in
    the layers that it is in, the lowest first."""
    import pyarrow as pa
    order = np.argsort(table.column("mixed").to_numpy(), kind="stable")
    layers = build_graph(_units(table.column("embedding"), order, np.float32))[::-1]
    held = sum((np.arange(len(order)) < len(adj)).astype(np.int64) for adj in layers)
    start = np.concatenate(([0], np.cumsum(held * NEIGHBOURS)))
    flat = np.empty(start[-1], np.int32)
    for depth, adj in enumerate(layers):
        for c in range(NEIGHBOURS):
            flat[start[:len(adj)] + depth * NEIGHBOURS + c] = adj[:, c]
    links = pa.ListArray.from_arrays(pa.array(start.astype(np.int32)), pa.array(flat))
    return pa.table([pa.array(table.column("rep").to_numpy()[order]), pa.array(np.arange(len(order), dtype=np.int32)), links], ["rep", "at", "links"])


def _layers(column, order: np.ndarray) -> list[np.ndarray]:
    """The adjacency that ``_build`` gave as ``links``, the top first."""
    links = column.combine_chunks()
    links = links if not hasattr(links, "chunks") else links.chunk(0)
    start, values = links.offsets.to_numpy(), links.values.to_numpy(zero_copy_only=False)
    held, start = np.diff(start)[order] // NEIGHBOURS, start[:-1][order]
    out = []
    for depth in range(int(held.max())):
        n = int((held > depth).sum())  # layers nest
        out.append(np.empty((n, NEIGHBOURS), np.int32))
        for c in range(NEIGHBOURS):
            out[-1][:, c] = values[start[:n] + depth * NEIGHBOURS + c]
    return out[::-1]


def _search(threshold: float, target: float):
    def task(asked, nodes):
        import pyarrow as pa
        if not asked.num_rows or not nodes.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, ["src", "dst", "links"])
        order = np.argsort(nodes.column("at").to_numpy(), kind="stable")
        ids, copies = (nodes.column(c).to_numpy()[order] for c in ("rep", "copies"))
        layers, full = _layers(nodes.column("links"), order), _units(nodes.column("embedding"), order, np.float64)
        x = full.astype(np.float32)
        qid, block = (asked.column(c).to_numpy() for c in ("query", "block"))
        qfull, low = _units(asked.column("vector"), np.arange(len(qid)), np.float64), threshold - 1e-5
        sets = _Union(np.concatenate((qid, ids)))
        links = np.zeros(len(qid), np.int64)
        for b in np.unique(block):
            rows = np.flatnonzero(block == b)
            q = qfull[rows].astype(np.float32)
            audit = np.flatnonzero(qid[rows] % 20 == 0)
            true = [np.flatnonzero(x @ q[i] >= low) for i in audit]
            total, beam = sum(map(len, true)), FIRST_BEAM
            while True:
                found = range_search(x, layers, q, low, beam)
                hit = sum(len(np.intersect1d(found[i], t)) for i, t in zip(audit, true, strict=True))
                if hit >= target * total or beam >= len(x):
                    break
                beam *= 2
            for i, near in zip(rows.tolist(), found, strict=True):
                near = near[full[near] @ qfull[i] >= threshold]
                near = near[ids[near] != qid[i]]
                links[i] = copies[near].sum()
                for j in near:
                    sets.join(i, len(qid) + int(j))
        at = [k for k in range(len(sets.up)) if sets.root(k) != k or (k < len(qid) and links[k])]
        return pa.table([pa.array(sets.ids[at]), pa.array(sets.ids[[sets.root(k) for k in at]]),
                         pa.array(np.array([links[k] if k < len(qid) else 0 for k in at], np.int64))], ["src", "dst", "links"])
    return task


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, target_recall: float = 0.99, shards: int = 4,
                    shard_rows: int = 250_000, block_rows: int = 8_192, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """One row per vector: ``id_col``, n_links (other vectors with a cosine of
    at least ``threshold``), component_id, kept. ``shards`` is the least number
    of shards; a shard holds about ``shard_rows`` vectors at most."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = (vectors.filter(F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("embedding"))
            .groupBy("id").agg(F.min("embedding").alias("embedding")))
    sound = F.expr("size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
                   " AND exists(embedding, x -> x <> 0)")
    rows = written(rows.withColumn("sound", F.coalesce(sound, F.lit(False))), "vectors")
    reps = rows.filter("sound").groupBy("embedding").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    reps = written(reps.select("rep", "copies", "embedding", F.size("embedding").alias("dim"), F.xxhash64("rep").alias("mixed")), "vector-reps")
    n = reps.count()
    pieces, blocks = max(shards, math.ceil(n / shard_rows)), max(1, math.ceil(n / block_rows))
    bundles = max(min(blocks, BUNDLES), math.ceil(n / BUNDLE_ROWS))
    shard = F.pmod("mixed", F.lit(pieces)).cast("int").alias("shard")
    graphs = written(reps.select("rep", "mixed", "embedding", "dim", shard).groupBy("dim", "shard")
                     .applyInArrow(_build, "rep long, at int, links array<int>"), "vector-graphs")
    keys = ["dim", "shard", "bundle"]
    asked = (reps.withColumn("block", F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(blocks)).cast("int"))
             .select(F.col("rep").alias("query"), "block", F.col("embedding").alias("vector"), F.size("embedding").alias("dim"),
                     F.pmod("block", F.lit(bundles)).alias("bundle"), F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("shard")))
    nodes = (reps.select("rep", "copies", "embedding", "dim", shard).join(graphs, "rep")
             .withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(bundles - 1)))))
    found = written(asked.groupBy(*keys).cogroup(nodes.groupBy(*keys))
                    .applyInArrow(_search(threshold, target_recall), "src long, dst long, links long"), "vector-links")
    comp = connected_components(found.filter("src <> dst"))
    links = found.groupBy("src").agg(F.sum("links").alias("links"))
    per_rep = (reps.join(links.withColumnRenamed("src", "rep"), "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
               .select("rep", "copies", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                       F.coalesce("component", "rep").alias("component_id")))
    alone = per_rep.filter("copies = 1").select(F.col("rep").alias("id"), "n_links", "component_id")
    # members of large groups of equal vectors meet their group under 16 salted keys
    copied = per_rep.filter("copies > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    members = (rows.filter("sound").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(16)).cast("int"))
               .join(copied, ["embedding", "salt"]).select("id", "n_links", "component_id"))
    lone = rows.filter("NOT sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return (alone.unionAll(members).unionAll(lone).withColumnRenamed("id", id_col)
            .withColumn("kept", F.col(id_col) == F.col("component_id")))
