"""Labelled binning (L1) and the two bin profiles (Q15)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import _c, ColumnOrName

INF = math.inf


def bin_right_closed(c: ColumnOrName, edges: list[float], labels: list[str],
                     na_label: str | None = None) -> Column:
    """L1: ``(a, b]`` bins like ``pd.cut``: the lowest edge is excluded, values
    outside every bin, null and NaN get ``na_label`` (null by default)."""
    assert len(edges) == len(labels) + 1
    c = _c(c)
    expr = F.when(c.isNull() | F.isnan(c), F.lit(na_label))
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) if lo != -INF else c.isNotNull()
        if hi != INF:
            cond = cond & (c <= F.lit(hi))
        expr = expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(na_label))


def bin_thresholds(c: ColumnOrName, thresholds: list[float], labels: list[str],
                   closed: str = "lt") -> Column:
    """Serving-style if/elif ladder: ``x < t0 -> l0, x < t1 -> l1, ... else
    last``; ``closed='le'`` uses ``<=``."""
    assert len(labels) == len(thresholds) + 1
    c = _c(c)
    expr = None
    for t, lab in zip(thresholds, labels):
        cond = (c < t) if closed == "lt" else (c <= t)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return expr.otherwise(labels[-1])


# Bin edges and labels (fixed values), training profile: right-closed pd.cut.
TRAINING = {
    "temp": ([-INF, 32, 50, 70, 90, INF], ["freezing", "cold", "mild", "warm", "hot"]),
    "lat": ([25, 29, 31, 33, 37], ["south", "south_central", "central", "north"]),
    "lng": ([-107, -103, -99, -96, -93], ["west", "west_central", "central", "east"]),
    "speed": ([0, 35, 50, 65, 100], ["low", "medium", "high", "highway"]),
    "lanes": ([0, 2, 4, 10], ["narrow", "standard", "wide"]),
    "aadt": ([0, 1000, 5000, 15000, 30000, 100000], ["very_low", "low", "medium", "high", "very_high"]),
    "wz_density": ([-1, 0, 2, 5, INF], ["none", "low", "medium", "high"]),
}

# Serving profile: if/elif thresholds (fixed values).
SERVING = {
    "temp": ([32, 50, 70, 85], ["freezing", "cold", "mild", "warm", "hot"], "lt"),
    "lat": ([29, 31, 33], ["south", "south_central", "central", "north"], "lt"),
    "lng": ([-100, -98, -96], ["west", "west_central", "central", "east"], "lt"),
    "speed": ([35, 50, 65], ["low", "medium", "high", "highway"], "lt"),
    "lanes": ([1, 3], ["narrow", "standard", "wide"], "le"),
    "road_class": ([1, 3, 5], ["interstate", "principal_arterial", "minor_arterial", "collector"], "le"),
}


def profile_bin(c: ColumnOrName, feature: str, profile: str = "training",
                na_label: str | None = None) -> Column:
    if profile == "training":
        edges, labels = TRAINING[feature]
        return bin_right_closed(c, edges, labels, na_label)
    th, labels, closed = SERVING[feature]
    return bin_thresholds(c, th, labels, closed)
