"""Planar geometry as column expressions (F1, F9, F10 and the point-to-piece
distance used by the grid joins). Coordinates are metres unless noted."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import _c, ColumnOrName

# WGS84 semi-major axis (spherical Mercator, EPSG:3857) and degree length.
EARTH_A = 6378137.0
KM_PER_DEGREE = 111.0
DEG2RAD = math.pi / 180.0


def mercator(lon: ColumnOrName, lat: ColumnOrName) -> tuple[Column, Column]:
    """EPSG:4326 -> EPSG:3857."""
    lam = _c(lon) * DEG2RAD
    phi = _c(lat) * DEG2RAD
    return (F.lit(EARTH_A) * lam,
            F.lit(EARTH_A) * F.ln(F.tan(F.lit(math.pi / 4) + phi / 2)))


def inverse_mercator(x: ColumnOrName, y: ColumnOrName) -> tuple[Column, Column]:
    """EPSG:3857 -> EPSG:4326."""
    lon = F.degrees(_c(x) / EARTH_A)
    lat = F.degrees(2 * F.atan(F.exp(_c(y) / EARTH_A)) - F.lit(math.pi / 2))
    return lon, lat


def planar_distance(ax: ColumnOrName, ay: ColumnOrName, bx: ColumnOrName, by: ColumnOrName) -> Column:
    """Euclidean distance."""
    return F.sqrt(F.pow(_c(ax) - _c(bx), 2) + F.pow(_c(ay) - _c(by), 2))


def degrees_to_km(d: ColumnOrName) -> Column:
    """degrees x 111."""
    return _c(d) * KM_PER_DEGREE


def point_piece_distance(px: ColumnOrName, py: ColumnOrName, ax: ColumnOrName, ay: ColumnOrName,
                         bx: ColumnOrName, by: ColumnOrName) -> Column:
    """Distance from a point to the closed straight piece a-b (degenerate piece
    = point a)."""
    px, py, ax, ay, bx, by = map(_c, (px, py, ax, ay, bx, by))
    dx, dy = bx - ax, by - ay
    len2 = dx * dx + dy * dy
    t = F.when(len2 == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / len2)))
    qx, qy = ax + t * dx, ay + t * dy
    return F.sqrt(F.pow(px - qx, 2) + F.pow(py - qy, 2))


def polyline_length(points: ColumnOrName) -> Column:
    """sum of piece lengths of an ``array<struct<x,y>>`` polyline."""
    pts = _c(points)
    idx = F.sequence(F.lit(1), F.greatest(F.size(pts) - 1, F.lit(1)))
    return F.when(F.size(pts) < 2, F.lit(0.0)).otherwise(
        F.aggregate(idx, F.lit(0.0), lambda acc, i: acc + F.sqrt(
            F.pow(pts[i]["x"] - pts[i - 1]["x"], 2) + F.pow(pts[i]["y"] - pts[i - 1]["y"], 2))))


METRES_PER_MILE = 1609.34


def polyline_pieces(points: ColumnOrName) -> Column:
    """Array of ``struct<piece, ax, ay, bx, by>`` for exploding a polyline."""
    pts = _c(points)
    idx = F.sequence(F.lit(0), F.size(pts) - 2)
    return F.transform(idx, lambda i: F.struct(
        i.alias("piece"), pts[i]["x"].alias("ax"), pts[i]["y"].alias("ay"),
        pts[i + 1]["x"].alias("bx"), pts[i + 1]["y"].alias("by")))


def point_in_ring(px: ColumnOrName, py: ColumnOrName, ring: ColumnOrName) -> Column:
    """Ray casting over a closed ring ``array<struct<x,y>>`` (last vertex
    connects to the first) with a higher-order ``aggregate``: the number of
    edges crossed by a ray to +x is odd."""
    px, py, r = _c(px), _c(py), _c(ring)
    n = F.size(r)
    idx = F.sequence(F.lit(0), n - 1)

    def step(acc, i):
        a = r[i]
        b = r[(i + 1) % n]
        # the division only runs when the edge straddles the ray (CASE is lazy)
        crosses = F.when((a["y"] > py) != (b["y"] > py),
                         px < (b["x"] - a["x"]) * (py - a["y"]) / (b["y"] - a["y"]) + a["x"]).otherwise(F.lit(False))
        return acc + F.when(crosses, 1).otherwise(0)

    return (F.aggregate(idx, F.lit(0), step) % 2) == 1


# Ellipsoids and projection parameters (fixed values, public EPSG definitions).
WGS84 = (6378137.0, 1 / 298.257223563)
GRS80 = (6378137.0, 1 / 298.257222101)
UTM14N = {"lon0": -99.0, "k0": 0.9996, "fe": 500000.0, "fn": 0.0}                      # EPSG:32614
TX_ALBERS = {"lat1": 27.5, "lat2": 35.0, "lat0": 18.0, "lon0": -100.0,                 # EPSG:3083
             "fe": 1500000.0, "fn": 6000000.0}


def transverse_mercator(lon: ColumnOrName, lat: ColumnOrName, lon0: float = UTM14N["lon0"],
                        k0: float = UTM14N["k0"], fe: float = UTM14N["fe"], fn: float = UTM14N["fn"],
                        ellipsoid=WGS84) -> tuple[Column, Column]:
    """EPSG:4326 -> transverse Mercator (UTM zone 14N by default), the
    ellipsoidal series of Snyder (1987), eq. 8-9 to 8-10 (sub-mm inside a
    zone)."""
    a, f = ellipsoid
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    phi = _c(lat) * DEG2RAD
    s, co = F.sin(phi), F.cos(phi)
    n_ = F.lit(a) / F.sqrt(1 - e2 * s * s)
    t = F.tan(phi) * F.tan(phi)
    c = ep2 * co * co
    A = (_c(lon) - lon0) * DEG2RAD * co
    m = a * ((1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256) * phi
             - (3 * e2 / 8 + 3 * e2 ** 2 / 32 + 45 * e2 ** 3 / 1024) * F.sin(2 * phi)
             + (15 * e2 ** 2 / 256 + 45 * e2 ** 3 / 1024) * F.sin(4 * phi)
             - (35 * e2 ** 3 / 3072) * F.sin(6 * phi))
    x = fe + k0 * n_ * (A + (1 - t + c) * F.pow(A, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * F.pow(A, 5) / 120)
    y = fn + k0 * (m + n_ * F.tan(phi) * (A * A / 2 + (5 - t + 9 * c + 4 * c * c) * F.pow(A, 4) / 24
                                          + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * F.pow(A, 6) / 720))
    return x, y


def _albers_q(sinphi, e):
    """Snyder eq. 3-12 (works for Columns and floats)."""
    if isinstance(sinphi, Column):
        return (1 - e * e) * (sinphi / (1 - e * e * sinphi * sinphi)
                              - 1 / (2 * e) * F.ln((1 - e * sinphi) / (1 + e * sinphi)))
    return (1 - e * e) * (sinphi / (1 - e * e * sinphi * sinphi)
                          - 1 / (2 * e) * math.log((1 - e * sinphi) / (1 + e * sinphi)))


def albers(lon: ColumnOrName, lat: ColumnOrName, p: dict = TX_ALBERS, ellipsoid=GRS80) -> tuple[Column, Column]:
    """EPSG:4326 -> Albers equal-area conic (Texas Centric, EPSG:3083
    by default), Snyder (1987) eq. 14-1 to 14-6 on the ellipsoid. The
    projection constants are computed once in Python."""
    a, f = ellipsoid
    e = math.sqrt(f * (2 - f))
    m = lambda ph: math.cos(ph) / math.sqrt(1 - e * e * math.sin(ph) ** 2)
    p1, p2, p0 = (math.radians(p["lat1"]), math.radians(p["lat2"]), math.radians(p["lat0"]))
    q1, q2, q0 = (_albers_q(math.sin(v), e) for v in (p1, p2, p0))
    n = (m(p1) ** 2 - m(p2) ** 2) / (q2 - q1)
    cc = m(p1) ** 2 + n * q1
    rho0 = a * math.sqrt(cc - n * q0) / n
    q = _albers_q(F.sin(_c(lat) * DEG2RAD), e)
    rho = F.lit(a) * F.sqrt(cc - n * q) / n
    theta = n * (_c(lon) - p["lon0"]) * DEG2RAD
    return p["fe"] + rho * F.sin(theta), p["fn"] + rho0 - rho * F.cos(theta)


def albers_constants(p: dict = TX_ALBERS, ellipsoid=GRS80) -> dict:
    """The derived Albers constants (n, C, rho0, e) for SQL twins and tests."""
    a, f = ellipsoid
    e = math.sqrt(f * (2 - f))
    m = lambda ph: math.cos(ph) / math.sqrt(1 - e * e * math.sin(ph) ** 2)
    p1, p2, p0 = (math.radians(p["lat1"]), math.radians(p["lat2"]), math.radians(p["lat0"]))
    q1, q2, q0 = (_albers_q(math.sin(v), e) for v in (p1, p2, p0))
    n = (m(p1) ** 2 - m(p2) ** 2) / (q2 - q1)
    cc = m(p1) ** 2 + n * q1
    return {"n": n, "C": cc, "rho0": a * math.sqrt(cc - n * q0) / n, "e": e, "a": a}


def inverse_transverse_mercator(x: ColumnOrName, y: ColumnOrName, lon0: float = UTM14N["lon0"],
                                k0: float = UTM14N["k0"], fe: float = UTM14N["fe"], fn: float = UTM14N["fn"],
                                ellipsoid=WGS84) -> tuple[Column, Column]:
    """transverse Mercator (UTM 14N by default) -> EPSG:4326, footpoint
    latitude series of Snyder (1987), eq. 8-18 to 8-25."""
    a, f = ellipsoid
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    mu = ((_c(y) - fn) / k0) / (a * (1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256))
    p1 = (mu + (3 * e1 / 2 - 27 * e1 ** 3 / 32) * F.sin(2 * mu) + (21 * e1 ** 2 / 16 - 55 * e1 ** 4 / 32) * F.sin(4 * mu)
          + (151 * e1 ** 3 / 96) * F.sin(6 * mu) + (1097 * e1 ** 4 / 512) * F.sin(8 * mu))
    s1, c1_ = F.sin(p1), F.cos(p1)
    c1 = ep2 * c1_ * c1_
    t1 = F.tan(p1) * F.tan(p1)
    n1 = F.lit(a) / F.sqrt(1 - e2 * s1 * s1)
    r1 = a * (1 - e2) / F.pow(1 - e2 * s1 * s1, 1.5)
    d = (_c(x) - fe) / (n1 * k0)
    lat = p1 - (n1 * F.tan(p1) / r1) * (d * d / 2 - (5 + 3 * t1 + 10 * c1 - 4 * c1 * c1 - 9 * ep2) * F.pow(d, 4) / 24
                                       + (61 + 90 * t1 + 298 * c1 + 45 * t1 * t1 - 252 * ep2 - 3 * c1 * c1)
                                       * F.pow(d, 6) / 720)
    lon = lon0 * DEG2RAD + (d - (1 + 2 * t1 + c1) * F.pow(d, 3) / 6
                            + (5 - 2 * c1 + 28 * t1 - 3 * c1 * c1 + 8 * ep2 + 24 * t1 * t1) * F.pow(d, 5) / 120) / c1_
    return lon / DEG2RAD, lat / DEG2RAD


def inverse_albers(df, x: str, y: str, lon_out: str = "lon", lat_out: str = "lat", p: dict = TX_ALBERS,
                   ellipsoid=GRS80, iterations: int = 6):
    """Albers equal-area (EPSG:3083 by default) -> EPSG:4326 on a
    DataFrame, Snyder (1987) eq. 14-8 to 14-11. The latitude iteration
    (3-16) is applied as one column per step, so each step references the
    previous column instead of re-expanding it (the expression stays linear
    in the number of iterations)."""
    k = albers_constants(p, ellipsoid)
    a, e, n, cc, rho0 = k["a"], k["e"], k["n"], k["C"], k["rho0"]
    xx, yy = F.col(x) - p["fe"], rho0 - (F.col(y) - p["fn"])
    t = df.withColumns({"_rho": F.sqrt(xx * xx + yy * yy), "_theta": F.atan2(xx, yy)})
    t = t.withColumn("_q", (cc - F.col("_rho") * F.col("_rho") * n * n / (a * a)) / n)
    t = t.withColumn("_phi", F.asin(F.col("_q") / 2))
    for _ in range(iterations):
        sp = F.sin("_phi")
        t = t.withColumn("_phi", F.col("_phi") + F.pow(1 - e * e * sp * sp, 2) / (2 * F.cos("_phi")) * (
            F.col("_q") / (1 - e * e) - sp / (1 - e * e * sp * sp) + 1 / (2 * e) * F.ln((1 - e * sp) / (1 + e * sp))))
    return (t.withColumns({lon_out: p["lon0"] + F.col("_theta") / n / DEG2RAD, lat_out: F.col("_phi") / DEG2RAD})
            .drop("_rho", "_theta", "_q", "_phi"))
