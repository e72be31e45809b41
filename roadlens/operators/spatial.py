"""Distributed spatial joins (F2-F8, F11, F12, F14, C7; F4 and F6 are in
``quadtree``, the search of F2 and F3 is in ``nearest``).

Spark has no spatial index, so joins that list pairs are rewritten as an
**equi-join on a grid cell**: with cell side >= the search radius, every
pair within the radius lies in the same or a neighbouring cell. One side is
replicated to its 3x3 neighbourhood, the other side keeps its own cell, the join
key is the cell and the exact distance is a residual filter. That is a sort-merge
or hash join partitioned by cell, never a nested loop; ``salt`` spreads a cell
that holds much of all rows. Nearest joins list no pairs within the radius: places
find what is nearest to them, rows are joined to that by place and ranked by (cell,
left key) (``_nearest``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import planar_distance, point_in_ring, point_piece_distance, polyline_pieces
from .nearest import ENDS, near_pieces, sound
from .quadtree import _placed, _written, count_within, nearest_unbounded  # noqa: F401  F4 and F6: searches in a tree of cells

NEIGHBOURS = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]


def _cell(v: Column, size: float) -> Column:
    return F.floor(v / F.lit(float(size))).cast("long")


def _prep_points(df: DataFrame, key: str, x: str, y: str, prefix: str, more: Column | None = None) -> DataFrame:
    return df.select(*([] if more is None else [more]), F.col(key).alias(f"{prefix}key"), F.col(x).cast("double").alias(f"{prefix}x"),
                     F.col(y).cast("double").alias(f"{prefix}y"))


def _replicate_3x3(df: DataFrame, xcol: str, ycol: str, size: float, salt: int = 1) -> DataFrame:
    cx, cy = _cell(F.col(xcol), size), _cell(F.col(ycol), size)
    nb = F.explode(F.array(*[F.struct((cx + dx).alias("_cx"), (cy + dy).alias("_cy")) for dx, dy in NEIGHBOURS]))
    out = df.select("*", nb.alias("_c")).select(*df.columns, "_c._cx", "_c._cy")
    return _replicate_salt(out, salt)


def _replicate_salt(df: DataFrame, salt: int) -> DataFrame:
    """Copy every row to each salt value 0..salt-1 (right / replicated side)."""
    if salt <= 1:
        return df.withColumn("_salt", F.lit(0))
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))


def _salt_of(key: str, salt: int) -> Column:
    """Salt of a left row: a hash of its key, so a hot cell is spread over
    ``salt`` join partitions while each left row still meets every right
    row of its cell exactly once."""
    return F.lit(0) if salt <= 1 else F.pmod(F.xxhash64(F.col(key)), F.lit(salt)).cast("int")


def _in_cells(df: DataFrame, key: str, x: str, y: str, size: float, salt: int, carry: list[str] = ()) -> DataFrame:
    """Left rows ``_lkey, _lx, _ly`` (and a struct ``_carry`` of more columns) in
    their own cell ``_cx, _cy, _salt``."""
    return _prep_points(df, key, x, y, "_l", F.struct(*carry).alias("_carry") if carry else None).withColumns(
        {"_cx": _cell(F.col("_lx"), size), "_cy": _cell(F.col("_ly"), size), "_salt": _salt_of("_lkey", salt)})


def within_pairs(left: DataFrame, right: DataFrame, left_key: str, right_key: str, radius: float,
                 lx: str = "x", ly: str = "y", rx: str = "x", ry: str = "y",
                 cell: float | None = None, how: str = "inner", salt: int = 1, carry: list[str] = ()) -> DataFrame:
    """all (left, right) pairs with distance <= radius, plus the distance.
    Output columns: ``left_key, right_key, distance``, the left columns
    ``carry``, ``_cx, _cy``; with
    ``how='left'`` unmatched left rows appear once with null right columns.
    ``salt > 1`` spreads every cell over that many join partitions (left rows
    by key hash, right rows copied per salt) for data with very hot cells."""
    size = float(cell or radius)
    assert size >= radius, "cell side must be >= radius for the 3x3 neighbourhood to be complete"
    L = _in_cells(left, left_key, lx, ly, size, salt, carry)
    cell_of = ["_cx", "_cy", "_salt"][:3 if salt > 1 else 2]
    R = _replicate_3x3(_prep_points(right, right_key, rx, ry, "_r"), "_rx", "_ry", size, salt).withColumnsRenamed({c: f"_r{c}" for c in cell_of})
    dist = planar_distance("_lx", "_ly", "_rx", "_ry")
    # products decide where they are sure, the distance, which costs more, where it is close
    dx, dy = F.col("_lx") - F.col("_rx"), F.col("_ly") - F.col("_ry")
    square = dx * dx + dy * dy
    met = (square <= radius * radius * (1 + 1e-9)) & ((square < radius * radius * (1 - 1e-9)) | (dist <= radius))
    for c in reversed(cell_of):
        met = (F.col(c) == F.col(f"_r{c}")) & met
    j = _dealt(L, cell_of).join(_dealt(R, [f"_r{c}" for c in cell_of]).hint("merge"), met, how)
    return j.select(F.col("_lkey").alias(left_key), F.col("_rkey").alias(right_key),
                    F.when(F.col("_rkey").isNotNull(), dist).alias("distance"),
                    *[F.col("_carry")[c].alias(c) for c in carry], "_cx", "_cy")


def _dealt(df: DataFrame, cell: list[str]) -> DataFrame:
    """Rows dealt by cell to as many tasks as the session shuffles into. Few
    bytes make many pairs, so the tasks must not be merged by the size of what
    they read."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cell)


def _nearest(L: DataFrame, pieces: DataFrame, held: list[str], dist: Column, radius: float, size: float, ties: str, how: str, salt: int, once: bool) -> DataFrame:
    """``_lkey, _rkey, distance``: the nearest right row(s) within ``radius``
    per left key and cell. ``L``: ``_lkey, _lx, _ly`` and its cell; ``pieces``:
    ``_rkey`` and its ends, of which ``dist`` reads ``held``. No pairs are listed
    but those of a place and the pieces nearest to it (``near_pieces``).
    Distances are compared rounded to 1e-6 so tie semantics do not depend on the
    last ulp. ``once``: a pair that is met several times is one row. Nothing is
    broadcast: a place may have many right rows as near."""
    cell, known = ["_cx", "_cy", "_salt"][:3 if salt > 1 else 2], F.col("_rkey").isNotNull()
    L, pieces = _written(L, "nearest-left"), _written(sound(pieces), "nearest-pieces")
    places = _written(_placed(L, "_lx", "_ly").groupBy((F.col("_lx") + 0.0).alias("_lx"), (F.col("_ly") + 0.0).alias("_ly")).agg(F.count(F.lit(1))).select("_lx", "_ly"), "nearest-places")
    found = near_pieces(places, pieces.where(known), radius, size)
    blank = pieces.where(~known)
    if not blank.isEmpty():  # rows without a key are no match, but they count
        found = found.unionByName(near_pieces(places, blank, radius, size, every=ties == "all"))
    name = lambda x, y: F.xxhash64(F.col(x) + 0.0, F.col(y) + 0.0, *cell[2:])
    found = found.select(F.col("_lx").alias("_px"), F.col("_ly").alias("_py"), "_rkey", *held).withColumn("_distance", dist).where(F.col("_distance") <= radius)
    rounded, place = F.bround("_distance", 6), ["_px", "_py"]
    own = [F.min(F.when(known, rounded)).alias("_least"), F.max(~known).alias("_blank")]
    least = found.groupBy(*place).agg(*own).withColumnsRenamed({"_px": "_qx", "_py": "_qy"})
    best = found.join(least.hint("merge"), (F.col("_px") == F.col("_qx")) & (F.col("_py") == F.col("_qy"))).where((known & (rounded == F.col("_least"))) | F.col("_least").isNull())
    best = best.select(*place, "_least", "_blank", "_rkey", F.when(known, F.col("_distance")).alias("distance"))
    if ties != "all":
        best = best.groupBy(*place).agg(F.max("_blank").alias("_blank"), F.min(F.when(known, F.struct("_least", "_rkey", "distance"))).alias("_best"))
    best = (best if salt <= 1 else _replicate_salt(best, salt)).withColumn("_place", name("_px", "_py")).withColumnRenamed("_salt", "_psalt")
    same = F.col("_lplace") == F.col("_place")  # a number of both coordinates; they are equal if neither is the larger
    for a, b in [("_lx", "_px"), ("_ly", "_py"), *([("_salt", "_psalt")] if salt > 1 else [])]:
        same = same & (F.col(a) <= F.col(b)) & (F.col(a) >= F.col(b))
    j = _dealt(L.withColumn("_lplace", name("_lx", "_ly")), ["_lplace"]).join(_dealt(best, ["_place"]).hint("merge"), same, how)
    if ties != "all":  # a right row without a key goes before all others
        j = j.groupBy(*cell, "_lkey").agg(F.min("_best").alias("_best"), F.max("_blank").alias("_blank"))
        return j.select("_lkey", *[F.when(~F.coalesce("_blank", F.lit(False)), F.col("_best")[c]).alias(c) for c in ("_rkey", "distance")])
    j = j.withColumn("_nearest", F.min("_least").over(Window.partitionBy(*cell, "_lkey"))).where((F.col("_least") == F.col("_nearest")) | F.col("_nearest").isNull())
    if once:
        return j.groupBy(*cell, "_lkey", "_rkey").agg(F.min("distance").alias("distance")).drop(*cell)
    return j.select("_lkey", "_rkey", "distance")


def nearest_within(left: DataFrame, right: DataFrame, left_key: str, right_key: str, max_distance: float,
                   lx: str = "x", ly: str = "y", rx: str = "x", ry: str = "y", ties: str = "first",
                   how: str = "left", cell: float | None = None, salt: int = 1) -> DataFrame:
    """nearest right point per left row within ``max_distance`` (Q7:
    ``ties='all'`` keeps every tied right row, ``'first'`` the lowest right
    key). ``how='left'`` keeps unmatched left rows (right key and distance
    null)."""
    size = float(cell or max_distance)
    assert size >= max_distance, "cell side must be >= radius for the 3x3 neighbourhood to be complete"
    R = _prep_points(right, right_key, rx, ry, "_r").select("_rkey", F.col("_rx").alias("ax"), F.col("_ry").alias("ay"), F.col("_rx").alias("bx"), F.col("_ry").alias("by"))
    best = _nearest(_in_cells(left, left_key, lx, ly, size, salt), R, ["ax", "ay"], planar_distance("_px", "_py", "ax", "ay"), max_distance, size, ties, how, salt, once=False)
    return best.withColumnsRenamed({"_lkey": left_key, "_rkey": right_key})


def nearest_line_within(points: DataFrame, lines: DataFrame, point_key: str, line_key: str, geometry: str,
                        max_distance: float, px: str = "x", py: str = "y", ties: str = "all",
                        how: str = "left", cell: float | None = None, salt: int = 1) -> DataFrame:
    """nearest polyline per point within ``max_distance``, by the least
    distance over the line's pieces. Default cell side is 2 x radius, as road
    pieces are usually longer than the radius: the cell of a left key's rank and
    of the finest grid that pieces meet boxes in."""
    size = float(cell or 2 * max_distance)
    pieces = lines.select(F.col(line_key).alias("_rkey"), F.explode(polyline_pieces(geometry)).alias("_p")).select("_rkey", *[F.col(f"_p.{c}").cast("double").alias(c) for c in ENDS])
    best = _nearest(_in_cells(points, point_key, px, py, size, salt), pieces, ENDS,
                    point_piece_distance("_px", "_py", *ENDS), max_distance, size, ties, how, salt, once=True)
    return best.withColumnsRenamed({"_lkey": point_key, "_rkey": line_key})


def _checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (survives executor
    loss; cuts the lineage of iterative rounds)."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def space_time_match(points: DataFrame, zones: DataFrame, point_key: str, zone_key: str, radius: float,
                     point_date: str, start: str, end: str, px: str = "x", py: str = "y",
                     zx: str = "x", zy: str = "y") -> DataFrame:
    """per point the first zone (lowest key, Q11) within ``radius`` whose
    ``[start, end]`` covers the point's date; left join. The global-overlap
    guard is a scalar-subquery flag in the join condition: when the two date
    ranges do not overlap at all, nothing matches and the columns stay null."""
    pdates = points.agg(F.min(point_date).alias("lo"), F.max(point_date).alias("hi"))
    zdates = zones.agg(F.min(start).alias("lo"), F.max(end).alias("hi"))
    overlap = (pdates.select("hi").scalar() >= zdates.select("lo").scalar()) & \
              (pdates.select("lo").scalar() <= zdates.select("hi").scalar())
    size = float(radius)
    P = points.select(F.col(point_key).alias("_pk"), F.col(px).cast("double").alias("_px"),
                      F.col(py).cast("double").alias("_py"), F.col(point_date).alias("_pd"))
    P = P.withColumns({"_cx": _cell(F.col("_px"), size), "_cy": _cell(F.col("_py"), size), "_ov": overlap})
    Z = zones.select(F.col(zone_key).alias("_zk"), F.col(zx).cast("double").alias("_zx"),
                     F.col(zy).cast("double").alias("_zy"), F.col(start).alias("_zs"), F.col(end).alias("_ze"))
    Z = _replicate_3x3(Z, "_zx", "_zy", size).drop("_salt").withColumnsRenamed({"_cx": "_zcx", "_cy": "_zcy"})
    dist = planar_distance("_px", "_py", "_zx", "_zy")
    cond = ((F.col("_cx") == F.col("_zcx")) & (F.col("_cy") == F.col("_zcy")) & (dist <= radius)
            & (F.col("_zs") <= F.col("_pd")) & (F.col("_pd") <= F.col("_ze")) & F.col("_ov"))
    j = _dealt(P, ["_cx", "_cy"]).join(_dealt(Z, ["_zcx", "_zcy"]).hint("merge"), cond, "left")
    # plain numbers are held in place by a hash aggregate; a struct would have every pair sorted first
    best = j.groupBy("_cx", "_cy", "_pk").agg(F.min("_zk").alias("_zk"), F.min_by(dist, F.col("_zk")).alias("distance"))
    return best.select(F.col("_pk").alias(point_key), F.col("_zk").alias(zone_key), "distance")


def point_in_polygon(points: DataFrame, polygons: DataFrame, point_key: str, poly_key: str, ring: str,
                     cell: float, px: str = "x", py: str = "y", extra: list[str] = ()) -> DataFrame:
    """F8: polygon of each point; the lowest polygon key wins where polygons
    overlap; unmatched -> null. Polygons are replicated to the grid cells
    their bounding box touches (a polygon table is not broadcast: its size
    is not bounded by construction), points join by cell, then a bbox test
    and ray casting over the ring with a higher-order ``aggregate``."""
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    poly = polygons.select(F.col(poly_key).alias("_gk"), F.col(ring).alias("_ring"), *extra,
                           F.array_min(xs).alias("_x0"), F.array_max(xs).alias("_x1"),
                           F.array_min(ys).alias("_y0"), F.array_max(ys).alias("_y1"))
    poly = (poly.withColumn("_cx", F.explode(F.sequence(_cell(F.col("_x0"), cell), _cell(F.col("_x1"), cell))))
            .withColumn("_cy", F.explode(F.sequence(_cell(F.col("_y0"), cell), _cell(F.col("_y1"), cell)))))
    P = points.select(F.col(point_key).alias("_pk"), F.col(px).cast("double").alias("_px"),
                      F.col(py).cast("double").alias("_py"))
    P = P.withColumns({"_cx": _cell(F.col("_px"), cell), "_cy": _cell(F.col("_py"), cell)})
    inside = (F.col("_px").between(F.col("_x0"), F.col("_x1")) & F.col("_py").between(F.col("_y0"), F.col("_y1"))
              & point_in_ring("_px", "_py", "_ring"))
    j = P.join(poly, (P["_cx"] == poly["_cx"]) & (P["_cy"] == poly["_cy"]) & inside, "left")
    best = j.groupBy(P["_cx"], P["_cy"], "_pk").agg(
        F.min_by(F.struct("_gk", *extra), F.col("_gk")).alias("_g"))
    return best.select(F.col("_pk").alias(point_key), F.col("_g._gk").alias(poly_key),
                       *[F.col(f"_g.{e}").alias(e) for e in extra])


def piece_hits_box(ax: Column, ay: Column, bx: Column, by: Column, x0, y0, x1, y1) -> Column:
    """Exact test whether the closed piece a-b intersects the closed box:
    bounding boxes overlap and the box corners are not all strictly on one
    side of the piece's line."""
    bb = (F.greatest(ax, bx) >= x0) & (F.least(ax, bx) <= x1) & (F.greatest(ay, by) >= y0) & (F.least(ay, by) <= y1)
    side = lambda cx, cy: (bx - ax) * (F.lit(cy) - ay) - (by - ay) * (F.lit(cx) - ax)
    s = [side(x0, y0), side(x0, y1), side(x1, y0), side(x1, y1)]
    all_pos = s[0] > 0
    all_neg = s[0] < 0
    for v in s[1:]:
        all_pos = all_pos & (v > 0)
        all_neg = all_neg & (v < 0)
    return bb & ~(all_pos | all_neg)


def bbox_intersects_line(lines: DataFrame, geometry: str, x: float, y: float, half: float) -> DataFrame:
    """Polylines crossing the box of half-size ``half`` around (x, y):
    cheap bbox prefilter on the whole line, then the exact piece test with
    ``exists`` over the pieces."""
    x0, y0, x1, y1 = x - half, y - half, x + half, y + half
    xs, ys = F.transform(geometry, lambda p: p["x"]), F.transform(geometry, lambda p: p["y"])
    pre = lines.where((F.array_max(xs) >= x0) & (F.array_min(xs) <= x1) & (F.array_max(ys) >= y0)
                      & (F.array_min(ys) <= y1))
    hit = F.exists(polyline_pieces(geometry), lambda p: piece_hits_box(p["ax"], p["ay"], p["bx"], p["by"],
                                                                      x0, y0, x1, y1))
    return pre.where(hit)


def segment_at_location(lines: DataFrame, key: str, geometry: str, x: float, y: float,
                        max_distance: float) -> DataFrame:
    """the closest polyline to one location, none if farther than
    ``max_distance`` (C7 prefilter + ``min_by``)."""
    near = bbox_intersects_line(lines, geometry, x, y, max_distance)
    d = F.array_min(F.transform(polyline_pieces(geometry), lambda p: point_piece_distance(
        F.lit(x), F.lit(y), p["ax"], p["ay"], p["bx"], p["by"])))
    c = near.select(key, d.alias("distance")).where(F.col("distance") <= max_distance)
    return c.agg(F.min_by(F.struct(key, "distance"), F.struct("distance", key)).alias("m")).select("m.*") \
        .where(F.col(key).isNotNull())


def hexbin_density(points: DataFrame, x: str, y: str, gridsize: int) -> DataFrame:
    """hexagonal binning as two offset rectangular lattices; each point
    goes to the nearer lattice centre (half-even rounding like numpy), empty
    bins are absent. Extent from scalar subqueries."""
    ext = points.agg(F.min(x).alias("a"), F.max(x).alias("b"), F.min(y).alias("c"), F.max(y).alias("d"))
    xmin, xmax = ext.select("a").scalar(), ext.select("b").scalar()
    ymin, ymax = ext.select("c").scalar(), ext.select("d").scalar()
    nx = gridsize
    ny = int(gridsize / 3 ** 0.5)
    # a constant axis has one bin
    width = lambda span, n: F.when(span > 0, span / n).otherwise(F.lit(1.0))
    ix = (F.col(x) - xmin) / width(xmax - xmin, nx)
    iy = (F.col(y) - ymin) / width(ymax - ymin, ny)
    ix1, iy1 = F.bround(ix, 0), F.bround(iy, 0)
    ix2, iy2 = F.floor(ix), F.floor(iy)
    d1 = F.pow(ix - ix1, 2) + 3 * F.pow(iy - iy1, 2)
    d2 = F.pow(ix - ix2 - 0.5, 2) + 3 * F.pow(iy - iy2 - 0.5, 2)
    first = d1 < d2
    p = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.when(first, 1).otherwise(2).alias("lattice"),
        F.when(first, ix1).otherwise(ix2).cast("long").alias("i"),
        F.when(first, iy1).otherwise(iy2).cast("long").alias("j"))
    return p.groupBy("lattice", "i", "j").agg(F.count(F.lit(1)).alias("n"))


def extent_centroid(points: DataFrame, x: str, y: str) -> DataFrame:
    """bounding box and mean centre."""
    return points.agg(F.min(x).alias("xmin"), F.min(y).alias("ymin"), F.max(x).alias("xmax"),
                      F.max(y).alias("ymax"), F.avg(x).alias("cx"), F.avg(y).alias("cy"))
