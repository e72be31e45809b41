"""Search for the nearest straight pieces (F2, F3) within a radius; a point is a
piece of no length.

Left places are parted in boxes (``quadtree``), small where places or pieces are
many. A box whose cell holds a piece knows how far the nearest can be from any of
its places, so pieces are sent to the boxes that they come as near as that, and no
farther than the radius. A task halves the places of a box again and again and
keeps for each part the pieces that may be the nearest of one of its places, by
the triangle inequality from the middle of the part; distances of places from
pieces are looked at for the few that are left. So a place meets a handful of
pieces however many lie within the radius.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .quadtree import SLACK, _boxes, _placed, _written

#: Places of a box on average, at most; a cell of more than ``MOST`` places, or pieces, is divided.
PLACES, MOST = 8192, 1 << 15
#: Pieces that a task holds together.
PIECES = 1 << 17
#: Distances that are looked at without parting the places again.
TOGETHER = 1 << 13
#: A grid's cells are so many times as wide as those of the grid before.
COARSER = 4

ENDS = ["ax", "ay", "bx", "by"]


def _gaps(x, y, ends):
    """Distances of places (numbers, or columns of them) from the pieces."""
    ax, ay, dx, dy, inverse = ends
    px, py = x - ax, y - ay
    if inverse is not None:
        t = np.clip((px * dx + py * dy) * inverse, 0.0, 1.0)
        px -= t * dx
        py -= t * dy
    px *= px
    py *= py
    px += py
    return np.nan_to_num(np.sqrt(px, out=px), copy=False, nan=np.inf, posinf=np.inf)


def closest(x: np.ndarray, y: np.ndarray, pieces: np.ndarray, radius: float, every: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(place, piece) of all pieces (rows ``ENDS``) that are the nearest of a
    place or may tie with it, and ``every`` piece within the radius if asked."""
    ax, ay, bx, by = pieces
    dx, dy = bx - ax, by - ay
    length = dx * dx + dy * dy
    inverse = np.divide(1.0, length, out=np.zeros_like(length), where=length > 0) if length.any() else None
    slack = SLACK + 1e-11 * max((float(np.abs(v).max()) for v in (x, y, pieces) if v.size), default=0.0)
    of = lambda j: (ax[j], ay[j], dx[j], dy[j], None if inverse is None else inverse[j])
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    parts = [(np.arange(len(x)), np.arange(len(ax)))]
    while parts:
        i, j = parts.pop()
        if not len(i) or not len(j):
            continue
        if len(i) * len(j) <= TOGETHER or len(i) == 1:
            d = _gaps(x[i, None], y[i, None], of(j))
            most = radius if every else np.minimum(d.min(1), radius)[:, None]
            r, c = np.nonzero(d <= most + slack)
            found.append((i[r], j[c]))
            continue
        px, py = x[i], y[i]
        x0, x1, y0, y1 = px.min(), px.max(), py.min(), py.max()
        around = np.hypot(x1 - x0, y1 - y0) / 2
        d = _gaps((x0 + x1) / 2, (y0 + y1) / 2, of(j))
        j = j[d <= (radius if every else min(d.min() + around, radius)) + around + 2 * slack]
        order = np.argpartition(px if x1 - x0 >= y1 - y0 else py, len(i) // 2)
        parts += [(i[order[:len(i) // 2]], j), (i[order[len(i) // 2:]], j)]
    return tuple(np.concatenate(v) for v in zip(*found, strict=True))


def _touched(x0: Column, x1: Column, y0: Column, y1: Column, side: Column) -> dict[str, Column]:
    """First and last cell of a grid that a box touches."""
    at = lambda c: F.floor(c / side).cast("long")
    return {"_i0": at(x0), "_i1": at(x1), "_j0": at(y0), "_j1": at(y1)}


def _by_cell(df: DataFrame) -> DataFrame:
    return df.withColumn("_i", F.explode(F.sequence("_i0", "_i1"))).withColumn("_j", F.explode(F.sequence("_j0", "_j1")))


def near_pieces(places: DataFrame, pieces: DataFrame, radius: float, size: float, every: bool = False) -> DataFrame:
    """``_lx, _ly`` and the columns of ``pieces`` for every place and each piece
    nearest to it, or that may tie, within the radius (to ``SLACK``); ``every``
    piece within it if asked. ``places``: distinct ``_lx, _ly``; ``pieces``:
    ``_rkey, ax, ay, bx, by``; both are read several times. ``size``: cell side
    of the finest grid that pieces and boxes meet in."""
    spark = places.sparkSession
    ship_package(spark)
    middle = pieces.select(((F.col("ax") + F.col("bx")) / 2).alias("x"), ((F.col("ay") + F.col("by")) / 2).alias("y"))
    rows, boxes = _boxes(places.select(F.lit(0).alias("_row"), "_lx", "_ly"), middle, PLACES, MOST, seen=True)
    # how far the nearest can be: a piece of the cell has its middle in the box of the middles
    wide = lambda p: F.greatest(F.col(f"_{p}1") - F.col(f"_r{p}0"), F.col(f"_r{p}1") - F.col(f"_{p}0"))
    reach = F.lit(float(radius)) if every else F.least(F.hypot(wide("x"), wide("y")), F.lit(float(radius)))
    boxes = boxes.withColumn("_reach", F.coalesce(reach, F.lit(float(radius))) * (1 + 1e-9) + SLACK)
    span = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0")) + 2 * F.col("_reach")
    boxes = boxes.withColumn("_grid", F.greatest(F.ceil(F.log(float(COARSER), span / size)), F.lit(0)).cast("int"))
    boxes = _written(boxes.withColumnRenamed("_row", "_box"), "nearest-boxes")
    side = F.lit(float(size)) * F.pow(F.lit(float(COARSER)), F.col("_grid"))
    pad = lambda c, s: F.col(c) + s * F.col("_reach")
    boxes = _by_cell(boxes.withColumns(_touched(pad("_x0", -1), pad("_x1", 1), pad("_y0", -1), pad("_y1", 1), side)))
    grids = [r[0] for r in boxes.select("_grid").distinct().collect()]  # a row per power of COARSER
    if not grids:
        grids = [0]
    own = pieces.withColumn("_grid", F.explode(F.array(*map(F.lit, grids))))
    own = _by_cell(own.withColumns(_touched(F.least("ax", "bx"), F.greatest("ax", "bx"), F.least("ay", "by"), F.greatest("ay", "by"), side)))
    cell = ["_grid", "_i", "_j"]
    # slices of a box by what its cells hold
    load = boxes.select("_box", *cell).join(own.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")), cell).groupBy("_box").agg(
        F.ceil(F.sum("_n") / PIECES).alias("_slices"))
    load = _written(load, "nearest-loads")
    boxes = boxes.select("_box", "_x0", "_x1", "_y0", "_y1", "_reach", *cell, F.col("_i0").alias("_bi"), F.col("_j0").alias("_bj")).join(load, "_box")
    # a piece and a box that meet in several cells do so in the first of them
    once = (F.col("_i") == F.greatest("_i0", "_bi")) & (F.col("_j") == F.greatest("_j0", "_bj"))
    apart = lambda p: F.greatest(F.least(f"a{p}", f"b{p}") - F.col(f"_{p}1"), F.col(f"_{p}0") - F.greatest(f"a{p}", f"b{p}"), F.lit(0.0))
    met = own.join(boxes, cell).where(once & (F.hypot(apart("x"), apart("y")) <= F.col("_reach")) & (_across() <= F.col("_reach")))
    seen = met.select("_box", F.pmod(F.xxhash64("_rkey", *ENDS), F.col("_slices")).alias("_slice"), *pieces.columns)
    asked = rows.join(load, "_box").select("_box", "_lx", "_ly", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slices") - 1)).alias("_slice"))
    group, held = ["_box", "_slice"], pieces.columns

    def both(key, q, p):
        import pyarrow as pa
        x, y = (q.column(c).to_numpy() for c in ("_lx", "_ly"))
        with np.errstate(all="ignore"):
            i, j = closest(x, y, np.stack([p.column(c).to_numpy() for c in ENDS]), radius, every)
        return pa.table([pa.array(x[i]), pa.array(y[i]), *(p.column(c).take(pa.array(j)) for c in held)], ["_lx", "_ly", *held])
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    # few bytes are much work: boxes are dealt to all tasks, not merged by the size of what is read
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _written(asked.repartition(tasks, *group).groupBy(*group).cogroup(seen.repartition(tasks, *group).groupBy(*group)).applyInArrow(both, f"_lx double, _ly double, {types}"), "nearest-found")


def _across() -> Column:
    """Distance of the piece's line from the middle of the box, less what the
    box extends to both sides of it: how far the line is from the box."""
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    length = F.hypot(dx, dy)
    off = F.abs(dx * ((F.col("_y0") + F.col("_y1")) / 2 - F.col("ay")) - dy * ((F.col("_x0") + F.col("_x1")) / 2 - F.col("ax")))
    half = (F.abs(dx) * (F.col("_y1") - F.col("_y0")) + F.abs(dy) * (F.col("_x1") - F.col("_x0"))) / 2
    return F.when(length > 0, (off - half) / length * (1 - 1e-9) - SLACK).otherwise(0.0)


def sound(df: DataFrame) -> DataFrame:
    """The pieces that lie somewhere."""
    return _placed(_placed(df, "ax", "ay"), "bx", "by")
