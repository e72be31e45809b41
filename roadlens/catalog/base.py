from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..testviews import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a Spark query and (optionally) its DuckDB oracle text."""
    def deco(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = with_views(sql, *views)
        return fn
    return deco


def r6(c: Column | str, n: int = 6) -> Column:
    """Round half-even for the cross-engine value hash (DuckDB ``round_even``)."""
    return F.bround(F.col(c) if isinstance(c, str) else c, n)


def r_many(c: Column | str, n: int) -> Column:
    """``r6`` for very many numbers: what is clearly off a tie, and positive, is
    rounded by arithmetic with the same result; ``bround`` goes through
    decimal text and is left for the rest."""
    c = F.col(c) if isinstance(c, str) else c
    up = c * F.lit(10.0 ** n)
    off_tie = (up > 0) & (up < 1e9) & (F.abs(up - F.rint(up)) < 0.49999)
    return F.when(off_tie, F.rint(up) / F.lit(10.0 ** n)).otherwise(r6(c, n))
