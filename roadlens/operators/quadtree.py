"""Searches in a quadtree that is a table (F4 nearest without a limit, F6 counts).

The right points are counted per cell in a pyramid of grids, each twice as fine
as the one above. A cell with more than ``LEAF`` points has children, any other
is a leaf, so the tree is deep where points are dense and shallow where there
are few. Every node knows how many points it holds and their tight box.

Left rows that lie near each other go down the tree as one box, two levels a
round, with the nodes that can still matter to any of them: for the nearest
point those whose box is no farther than the farthest that the nearest can be,
for a count those that the circles' edges cross (a box inside all circles counts
as a whole, one outside is dropped). Boxes are cells of a grid over the left
rows, finer where a cell holds many rows or many points, so what is carried
down and written grows with the boxes. Rows meet points in the leaves left to
their box only, a block of rows and a slice of leaves at a time, as arrays;
points of equal coordinates count as one there.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

#: A cell of more points is divided (down to 2^-DEPTH of the extent).
LEAF = 16
DEPTH = 28
#: Nodes that every row looks at first are those of this level (4 ** FIRST).
FIRST = 3
#: What distances are compared with: ties are those that agree to 1e-6.
SLACK = 1e-5
#: Left rows of a box on average, at most; a cell of more than ``MOST`` rows, or points, is divided.
ROWS, MOST = 512, 4096
#: Leaves, and distances, that a task looks at together.
SLICE, TOGETHER = 1024, 1 << 20


def _written(df: DataFrame, name: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _node(level, cx: Column, cy: Column) -> Column:
    """The number of the cell that a finest cell lies in at a level (a column or a number)."""
    down = F.lit(DEPTH) - level
    at = lambda c: F.call_function("shiftright", c, down)
    return F.lit(level).cast("long") * (1 << 56) + at(cx) * (1 << 28) + at(cy)


def _extent(points: DataFrame, x: str, y: str):
    """Low corner ``x, y``, side and row count ``n`` of the square that holds the points."""
    return points.agg(F.min(x).alias("x"), F.min(y).alias("y"), F.greatest(F.max(x) - F.min(x), F.max(y) - F.min(y)).alias("side"),
                      F.count(F.lit(1)).alias("n")).first()


def _finest(ext, x: str, y: str) -> dict[str, Column]:
    """Columns ``cx, cy``: the finest cell of a point of the extent."""
    side = float(ext.side or 0) or 1.0
    cell = lambda c, low: F.least(F.floor((F.col(c) - F.lit(float(low or 0))) / side * (1 << DEPTH)), F.lit((1 << DEPTH) - 1)).cast("long")
    return {"cx": cell(x, ext.x), "cy": cell(y, ext.y)}


def build(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, leaves) of distinct points ``x, y, n, key``. Nodes: node, up (the
    node above), level, n (rows), leaf and the tight box; leaves: the points
    with their leaf. No points give no nodes."""
    ext = _extent(points, "x", "y")
    pending = points.withColumns(_finest(ext, "x", "y"))
    low, high = -1, min(DEPTH, math.ceil(math.log(max(ext.n / LEAF, 1), 4)) + 2)
    nodes, leaves = [], []
    while True:
        levels = F.sequence(F.lit(low + 1), F.lit(high))
        found = (pending.select("x", "y", "n", "cx", "cy", F.explode(levels).alias("level"))
                 .groupBy(_node(F.col("level"), F.col("cx"), F.col("cy")).alias("node"), "level",
                          F.when(F.col("level") > 0, _node(F.col("level") - 1, F.col("cx"), F.col("cy"))).alias("up"))
                 .agg(F.count(F.lit(1)).alias("places"), F.sum("n").alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"),
                      F.min("y").alias("y0"), F.max("y").alias("y1"))
                 .withColumn("leaf", (F.col("places") <= LEAF) | (F.col("level") == DEPTH)))
        found = _written(found, "quadtree-cells")
        # a node is in the tree if the node above is divided
        divided = found.where(~F.col("leaf")).select(F.col("node").alias("up"))
        top = found.where(F.col("level") == low + 1)
        nodes.append(top.unionByName(found.where(F.col("level") > low + 1).join(divided, "up", "left_semi").select(*top.columns)))
        # the shallowest leaf of a point: as many levels down as there are divided nodes above it
        own = pending.select("*", F.explode(levels).alias("level")).withColumn("node", _node(F.col("level"), F.col("cx"), F.col("cy")))
        own = own.join(found.where("leaf").select("node"), "node", "left_semi")
        leaves.append(own.groupBy("x", "y", "n", "key").agg(F.min_by("node", "level").alias("node")))
        over = found.where((F.col("level") == high) & ~F.col("leaf")).select("node")
        if high == DEPTH or over.isEmpty():
            break
        pending = _written(pending.withColumn("node", _node(F.lit(high), F.col("cx"), F.col("cy"))).join(over, "node", "left_semi").drop("node"), "quadtree-points")
        low, high = high, min(DEPTH, high + 8)
    union = lambda parts: parts[0] if len(parts) == 1 else union([parts[0].unionByName(parts[1]), *parts[2:]])
    return _written(union(nodes).drop("places"), "quadtree-nodes"), _written(union(leaves), "quadtree-leaves")


_BOX = ["node", "leaf", "n", "x0", "x1", "y0", "y1"]


def _steps(nodes: DataFrame) -> DataFrame:
    """For every divided node what lies two levels below it (one where that is a leaf)."""
    box = F.struct(*_BOX).alias("b")
    kids = nodes.where(F.col("up").isNotNull()).groupBy("up").agg(F.collect_list(box).alias("kids"))  # 4 at most
    below = (kids.select(F.col("up").alias("node"), F.explode("kids").alias("k"))
             .join(kids.select(F.col("up").alias("kid"), F.col("kids").alias("grand")), F.col("k.node") == F.col("kid"), "left"))
    return _written(below.groupBy("node").agg(F.flatten(F.collect_list(F.coalesce("grand", F.array("k")))).alias("next")), "quadtree-steps")


def _apart(b: Column) -> Column:
    """Least distance of the left box from a box."""
    gap = lambda p, lo, hi: F.greatest(b[lo] - F.col(f"_{p}1"), F.col(f"_{p}0") - b[hi], F.lit(0.0))
    dx, dy = gap("x", "x0", "x1"), gap("y", "y0", "y1")
    return F.sqrt(dx * dx + dy * dy)


def _across(b: Column) -> Column:
    """Largest distance of the left box from a box."""
    dx, dy = (F.greatest(F.abs(F.col(f"_{p}0") - b[f"{p}1"]), F.abs(F.col(f"_{p}1") - b[f"{p}0"])) for p in "xy")
    return F.sqrt(dx * dx + dy * dy)


def _surely(b: Column) -> Column:
    """The farthest that the nearest point of a tight box can be from any place
    of the left box: each side of the tight box holds a point."""
    def parts(p):
        c0, c1, lo, hi = F.col(f"_{p}0"), F.col(f"_{p}1"), b[f"{p}0"], b[f"{p}1"]
        near = lambda c: F.least(F.abs(c - lo), F.abs(c - hi))
        middle = (lo + hi) / 2  # the place farthest from both sides
        return (F.greatest(near(c0), near(c1), F.when((c0 <= middle) & (middle <= c1), (hi - lo) / 2).otherwise(0.0)),
                F.greatest(F.abs(c0 - lo), F.abs(c0 - hi), F.abs(c1 - lo), F.abs(c1 - hi)))
    (nx, fx), (ny, fy) = parts("x"), parts("y")
    return F.sqrt(F.least(nx * nx + fy * fy, fx * fx + ny * ny))


def descend(left: DataFrame, nodes: DataFrame, prune, state: list[str]) -> DataFrame:
    """Rows ``_row, state..., _leaves``: the leaves that each left box ``_row,
    _x0, _x1, _y0, _y1`` ends in. ``prune(df)`` keeps of the array ``_nodes``
    what still matters, and may fold the rest into the ``state`` columns."""
    first = nodes.where((F.col("level") == FIRST) | (F.col("leaf") & (F.col("level") < FIRST))).select(*_BOX).collect()  # 64 at most
    if not first:
        return left.select("_row", *state, F.array().cast("array<long>").alias("_leaves"))
    start = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in _BOX]) for r in first])
    steps = None
    cur = _written(prune(left.withColumn("_nodes", start)), "quadtree-search")
    while not cur.where(F.exists("_nodes", lambda b: ~b["leaf"])).isEmpty():
        steps = _steps(nodes) if steps is None else steps
        gone = (cur.select("_row", F.explode(F.filter("_nodes", lambda b: ~b["leaf"])).alias("b")).select("_row", F.col("b.node").alias("node"))
                .join(steps, "node").groupBy("_row").agg(F.flatten(F.collect_list("next")).alias("_more")))
        nxt = cur.join(gone, "_row", "left").withColumn("_nodes", F.concat(
            F.filter("_nodes", lambda b: b["leaf"]), F.coalesce("_more", F.expr("filter(_nodes, b -> false)")))).drop("_more")
        cur = _written(prune(nxt), "quadtree-search")
    return cur.select("_row", *state, F.transform("_nodes", lambda b: b["node"]).alias("_leaves"))


def _prepared(left: DataFrame, key: str, x: str, y: str) -> tuple[DataFrame, DataFrame]:
    """Left rows numbered (a row number of this job), and those that lie
    somewhere, each with the box that is its place alone."""
    rows = _written(left.select(F.col(key).alias("_lkey"), F.col(x).cast("double").alias("_lx"), F.col(y).cast("double").alias("_ly"))
                    .withColumn("_row", F.monotonically_increasing_id()), "quadtree-left")
    return rows, _placed(rows, "_lx", "_ly").drop("_lkey").withColumns({"_x0": F.col("_lx"), "_x1": F.col("_lx"), "_y0": F.col("_ly"), "_y1": F.col("_ly")})


def _placed(df: DataFrame, x: str, y: str) -> DataFrame:
    fit = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    return df.where(fit(x) & fit(y))


def _right(right: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """Distinct places with their number of rows and lowest key; null coordinates are nowhere."""
    r = right.select(F.col(key).alias("key"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    return _written(_placed(r, "x", "y").groupBy((F.col("x") + 0.0).alias("x"), (F.col("y") + 0.0).alias("y")).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("key")), "quadtree-places")


def _boxes(placed: DataFrame, places: DataFrame, rows_most: int | None = None, most: int | None = None, seen: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, boxes) of the left rows: ``_row, _lx, _ly, _box`` and ``_row`` (the
    box), ``_n`` (its rows) and the tight box. Cells of more than ``MOST`` rows
    or right places are divided again, unless all their rows lie in one place.
    ``rows_most, most``: other numbers than ``ROWS, MOST``; with ``seen`` also
    the tight box ``_rx0, _rx1, _ry0, _ry1`` of the right places of the cell."""
    rows_most, most = rows_most or ROWS, most or MOST
    ext = _extent(placed, "_lx", "_ly")
    rows = placed.select("_row", "_lx", "_ly").withColumns(_finest(ext, "_lx", "_ly"))
    side = float(ext.side or 0) or 1.0
    within = lambda c, low: F.col(c).between(float(low or 0), float(low or 0) + side)
    beside = places.where(within("x", ext.x) & within("y", ext.y)).select("x", "y", *[c.alias(k) for k, c in _finest(ext, "x", "y").items()])
    extra = {f"_r{c}{i}": f(c) for c in "xy" for i, f in enumerate((F.min, F.max))} if seen else {}
    level = min(DEPTH, math.ceil(math.log(max(ext.n / rows_most, 1), 4)))
    named, boxes = None, None
    while True:
        box = _node(F.lit(level), F.col("cx"), F.col("cy"))
        own = rows.withColumn("_box", box)
        found = own.groupBy("_box").agg(F.count(F.lit(1)).alias("_n"), F.min("_lx").alias("_x0"), F.max("_lx").alias("_x1"),
                                        F.min("_ly").alias("_y0"), F.max("_ly").alias("_y1"))
        found = found.join(beside.groupBy(box.alias("_box")).agg(F.count(F.lit(1)).alias("_load"), *[c.alias(k) for k, c in extra.items()]), "_box", "left")
        many = (F.col("_n") > most) | ((F.col("_n") > 1) & (F.coalesce("_load", F.lit(0)) > most))
        apart = (F.col("_x1") > F.col("_x0")) | (F.col("_y1") > F.col("_y0"))
        found = _written(found.withColumn("_split", many & apart & F.lit(level < DEPTH)), "quadtree-boxes")
        split = found.where("_split").select("_box")
        last = split.isEmpty()
        own, found = (own if last else own.join(split, "_box", "left_anti")), found.where("not _split")
        own, found = own.select("_row", "_lx", "_ly", "_box"), found.select(F.col("_box").alias("_row"), "_n", "_x0", "_x1", "_y0", "_y1", *extra)
        named, boxes = (own, found) if named is None else (named.unionByName(own), boxes.unionByName(found))
        if last:
            return named, boxes
        rows = _written(rows.withColumn("_box", box).join(split, "_box", "left_semi").drop("_box"), "quadtree-rows")
        level = min(DEPTH, level + 3)


def _meet(rows: DataFrame, ends: DataFrame, leaves: DataFrame, state: list[str], held: list[str], visit: Callable, schema: str) -> DataFrame:
    """``visit(rows, points)`` (Arrow tables) for every block of a box's rows
    (``_row, _lx, _ly, state...``) and slice of its leaves (a struct ``_p`` of
    ``held`` for every point; no rows where there are none). ``state`` columns
    come with the first slice, 0 with the others."""
    ship_package(rows.sparkSession)
    ends = ends.withColumnRenamed("_row", "_box").withColumns({
        "_slices": F.greatest(F.ceil(F.size("_leaves") / SLICE), F.lit(1)).cast("long"), "_blocks": F.ceil(F.col("_n") / MOST).cast("long")})
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    asked = (rows.join(ends.select("_box", *state, "_slices", "_blocks"), "_box").withColumn("_block", F.pmod(F.xxhash64("_row"), F.col("_blocks")))
             .select("_row", "_lx", "_ly", "_box", "_block", *state, upto("_slices").alias("_slice"))
             .withColumns({c: F.when(F.col("_slice") == 0, F.col(c)).otherwise(F.lit(0)) for c in state}))
    points = leaves.groupBy("node").agg(F.collect_list(F.struct(*held)).alias("_p"))  # LEAF at most, but in a finest cell
    seen = (ends.select("_box", "_blocks", F.posexplode("_leaves").alias("_at", "node")).join(points, "node")
            .select("_box", F.floor(F.col("_at") / SLICE).cast("long").alias("_slice"), upto("_blocks").alias("_block"), "_p"))
    group = ["_box", "_block", "_slice"]

    def both(key, q, m):
        p = m.column("_p").combine_chunks()
        return visit(q, (p if not hasattr(p, "chunks") else p.chunk(0)).flatten() if m.num_rows else None)
    return asked.groupBy(*group).cogroup(seen.groupBy(*group)).applyInArrow(both, schema)


def _distances(q, p):
    """Distances of the rows of ``q`` from the points ``p``, some rows at a time: (first row, matrix)."""
    x, y = q.column("_lx").to_numpy(), q.column("_ly").to_numpy()
    px, py = (p.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
    step = max(1, TOGETHER // max(len(px), 1))
    for at in range(0, len(x), step):
        dx, dy = x[at:at + step, None] - px, y[at:at + step, None] - py
        dx *= dx
        dy *= dy
        dx += dy
        yield at, np.sqrt(dx, out=dx)


def nearest_unbounded(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                      lx: str = "x", ly: str = "y", rx: str = "x", ry: str = "y", ties: str = "first") -> DataFrame:
    """``left_key, right_key, distance``: the nearest right point at any
    distance (Q7: ``ties='all'`` keeps every right row as near, to 1e-6,
    ``'first'`` the lowest right key). Left rows without coordinates, and all
    where the right side has none, get null."""
    rows, placed = _prepared(left, left_key, lx, ly)
    places = _right(right, right_key, rx, ry)
    nodes, leaves = build(places)

    def prune(df):
        limit = F.array_min(F.transform("_nodes", _surely)) + SLACK
        # an array of one binds the limit, which is then computed once a row and not once a node
        kept = F.transform(F.array(limit), lambda most: F.filter("_nodes", lambda b: _apart(b) <= most))
        return df.withColumn("_nodes", F.element_at(kept, 1))

    def visit(q, p):
        import pyarrow as pa
        row, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        d = [np.zeros(0)]
        for first, m in _distances(q, p) if p is not None else ():
            i, j = np.nonzero(m <= m.min(1)[:, None] + SLACK)  # the nearest, and what may tie with it
            row.append(i + first)
            at.append(j)
            d.append(m[i, j])
        row, at = np.concatenate(row), np.concatenate(at)
        points = (p.field(c).take(pa.array(at)) for c in held) if p is not None else (pa.array([], t) for t in (None, pa.float64(), pa.float64()))
        return pa.table([q.column("_row").take(pa.array(row)), *points, pa.array(np.concatenate(d))], ["_row", *held, "_d"])
    rows_in, boxes = _boxes(placed, places)
    held = ["key", "x", "y"]
    ends = descend(boxes, nodes, prune, ["_n"]).where(F.size("_leaves") > 0)
    met = _meet(rows_in, ends, leaves, [], held, visit, f"_row long, key {leaves.schema['key'].dataType.simpleString()}, x double, y double, _d double")
    if ties == "all":
        met = _written(met, "quadtree-near")
        least = met.groupBy("_row").agg(F.min(F.bround("_d", 6)).alias("_least"))
        best = met.join(least, "_row").where(F.bround("_d", 6) == F.col("_least")).select("_row", "x", "y", F.col("_d").alias("distance"))
        again = _placed(right.select(F.col(right_key), (F.col(rx).cast("double") + 0.0).alias("x"), (F.col(ry).cast("double") + 0.0).alias("y")), "x", "y")
        best = best.join(again, ["x", "y"]).drop("x", "y")
    else:
        best = met.groupBy("_row").agg(F.min_by(F.struct(F.col("key").alias(right_key), F.col("_d").alias("distance")),
                                                F.struct(F.bround("_d", 6), F.col("key"))).alias("_b")).select("_row", "_b.*")
    return rows.join(best, "_row", "left").select(F.col("_lkey").alias(left_key), right_key, "distance")


def count_within(left: DataFrame, right: DataFrame, left_key: str, right_key: str, radius: float, out: str = "count_within",
                 lx: str = "x", ly: str = "y", rx: str = "x", ry: str = "y") -> DataFrame:
    """``left_key, out``: the number of right rows within ``radius`` of
    each left row (0 if none, or without coordinates). Boxes inside the
    circle are summed unseen; distances are looked at in the leaves that its
    edge crosses only."""
    rows, placed = _prepared(left, left_key, lx, ly)
    places = _right(right.where(F.col(right_key).isNotNull()), right_key, rx, ry)
    nodes, leaves = build(places)
    inside = lambda b: _across(b) < radius * (1 - 1e-12)

    def prune(df):
        whole = F.aggregate(F.filter("_nodes", inside), F.lit(0).cast("long"), lambda acc, b: acc + b["n"])
        return (df.withColumn("_sum", F.col("_sum") + whole)
                .withColumn("_nodes", F.filter("_nodes", lambda b: ~inside(b) & (_apart(b) <= radius * (1 + 1e-12)))))

    def visit(q, p):
        import pyarrow as pa
        n = q.column("_sum").to_numpy().copy()
        if p is not None:
            w = p.field("n").to_numpy(zero_copy_only=False)
            for at, m in _distances(q, p):
                near = m <= radius
                n[at:at + len(m)] += np.count_nonzero(near, 1) if (w == 1).all() else np.where(near, w, 0).sum(1)
        return pa.table([q.column("_row"), pa.array(n)], ["_row", "n"])
    rows_in, boxes = _boxes(placed, places)
    ends = descend(boxes.withColumn("_sum", F.lit(0).cast("long")), nodes, prune, ["_n", "_sum"])
    met = _meet(rows_in, ends, leaves, ["_sum"], ["x", "y", "n"], visit, "_row long, n long")
    parts = met.groupBy("_row").agg(F.sum("n").alias(out))
    return rows.join(parts, "_row", "left").select(F.col("_lkey").alias(left_key), F.coalesce(out, F.lit(0)).cast("long").alias(out))
