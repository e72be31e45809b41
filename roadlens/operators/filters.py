"""Projections, filters and predicates (C1-C13). Every filter is written so
Catalyst can push it into the parquet scan (ranges on the raw column, not on
``year(ts)``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def filter_years(df: DataFrame, ts: str, y0: int, y1: int) -> DataFrame:
    """``y0 <= year(ts) <= y1`` as a pushable half-open range."""
    c = F.col(ts)
    lo = F.make_timestamp_ntz(F.lit(y0), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    hi = F.make_timestamp_ntz(F.lit(y1 + 1), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return df.where((c >= lo) & (c < hi))


def filter_between(df: DataFrame, ts: str, lo, hi) -> DataFrame:
    """Inclusive range (Q6: an end given as a date means its midnight)."""
    return df.where(F.col(ts).between(F.lit(lo), F.lit(hi)))


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    """C3."""
    return df.where(F.col(column) == F.lit(value))


def require_not_null(df: DataFrame, subset: list[str]) -> DataFrame:
    """C4."""
    return df.na.drop(subset=subset)


def active_at(df: DataFrame, start: str, end: str, at) -> DataFrame:
    """Rows whose ``[start, end]`` covers the instant ``at``."""
    a = F.lit(at)
    return df.where((F.col(start) <= a) & (F.col(end) >= a))


def filter_bbox(df: DataFrame, x: str, y: str, xmin: float, ymin: float, xmax: float,
                ymax: float, inclusive: bool = True) -> DataFrame:
    """Points in a box, inclusive or open bounds."""
    cx, cy = F.col(x), F.col(y)
    if inclusive:
        cond = cx.between(xmin, xmax) & cy.between(ymin, ymax)
    else:
        cond = (cx > xmin) & (cx < xmax) & (cy > ymin) & (cy < ymax)
    return df.where(cond)


def drop_columns_if_present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Plan-time check of ``df.columns``; absent names are ignored."""
    present = [c for c in columns if c in df.columns]
    return df.drop(*present)


def select_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """C9."""
    return df.select(*[c for c in columns if c in df.columns])


def rename_existing(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """C9."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def lowercase_columns(df: DataFrame) -> DataFrame:
    """C10."""
    return df.toDF(*[c.lower() for c in df.columns])


def select_numeric(df: DataFrame, exclude: list[str] = ()) -> DataFrame:
    """C11: numeric columns minus exclusions (schema metadata only)."""
    return df.select(*[f.name for f in df.schema.fields
                       if isinstance(f.dataType, NumericType) and f.name not in exclude])


def top_k_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` most frequent non-null keys (ties broken by key)."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .orderBy(F.desc("_n"), F.asc(key)).limit(k).select(key))


def isin_filter(df: DataFrame, key: str, k: int) -> DataFrame:
    """Keep rows of the top-k groups with a left-semi join against the
    k-row aggregate (k is a bounded parameter, so the right side is small)."""
    return df.join(F.broadcast(top_k_keys(df, key, k)), on=key, how="left_semi")
