"""Date / time scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import _c, ColumnOrName


def calendar(ts: ColumnOrName) -> dict[str, Column]:
    """Hour, day_of_week (Monday = 0, pandas convention), month, year, day,
    is_weekend."""
    ts = _c(ts)
    dow = F.weekday(ts)
    return {
        "hour": F.hour(ts), "day_of_week": dow, "month": F.month(ts), "year": F.year(ts),
        "day": F.dayofmonth(ts), "is_weekend": F.coalesce(dow.isin(5, 6), F.lit(False)).cast("int"),
    }


def rush_hour(hour: ColumnOrName) -> Column:
    """6-9 or 16-19 inclusive."""
    h = _c(hour)
    return F.coalesce(h.between(6, 9) | h.between(16, 19), F.lit(False)).cast("int")


# Time-of-day labels (fixed values).
TIME_OF_DAY = ["Morning Rush (6-10am)", "Midday (10am-4pm)", "Evening Rush (4-8pm)",
               "Night (8pm-6am)", "Unknown"]


def time_of_day_category(hour: ColumnOrName) -> Column:
    """Half-open ranges; null or out of 0-23 -> Unknown."""
    h = _c(hour)
    return (F.when(h.isNull(), TIME_OF_DAY[4])
            .when((h >= 6) & (h < 10), TIME_OF_DAY[0])
            .when((h >= 10) & (h < 16), TIME_OF_DAY[1])
            .when((h >= 16) & (h < 20), TIME_OF_DAY[2])
            .when(((h >= 20) & (h < 24)) | ((h >= 0) & (h < 6)), TIME_OF_DAY[3])
            .otherwise(TIME_OF_DAY[4]))


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def duration_days(end: ColumnOrName, start: ColumnOrName) -> Column:
    """Whole days of (end - start), floored like ``timedelta.days``."""
    return F.floor((_micros(_c(end)) - _micros(_c(start))) / F.lit(86_400_000_000)).cast("long")


def minutes_between(a: ColumnOrName, b: ColumnOrName) -> Column:
    """E5: signed minutes a - b."""
    return (_micros(_c(a)) - _micros(_c(b))) / F.lit(60_000_000.0)


# Lighting classes (fixed values).
LIGHTING = ["daylight", "civil_twilight_dawn", "civil_twilight_dusk", "nautical_twilight_dawn",
            "nautical_twilight_dusk", "astronomical_twilight_dawn", "astronomical_twilight_dusk",
            "dark", "unknown"]


def lighting_condition(t: ColumnOrName, sunrise: ColumnOrName, sunset: ColumnOrName,
                       civil_begin: ColumnOrName, civil_end: ColumnOrName,
                       nautical_begin: ColumnOrName, nautical_end: ColumnOrName,
                       astro_begin: ColumnOrName, astro_end: ColumnOrName) -> Column:
    """Ordered classification of a crash instant against eight sun
    instants; the boundary rules differ per branch. No sun row -> unknown."""
    t, sr, ss = _c(t), _c(sunrise), _c(sunset)
    cb, ce, nb, ne, ab, ae = map(_c, (civil_begin, civil_end, nautical_begin, nautical_end,
                                      astro_begin, astro_end))
    return (F.when(sr.isNull() | ss.isNull() | t.isNull(), LIGHTING[8])
            .when((sr <= t) & (t <= ss), LIGHTING[0])
            .when((cb <= t) & (t < sr), LIGHTING[1])
            .when((ss < t) & (t <= ce), LIGHTING[2])
            .when((nb <= t) & (t < cb), LIGHTING[3])
            .when((ce < t) & (t <= ne), LIGHTING[4])
            .when((ab <= t) & (t < nb), LIGHTING[5])
            .when((ne < t) & (t <= ae), LIGHTING[6])
            .otherwise(LIGHTING[7]))


def lighting_flags(cond: ColumnOrName) -> dict[str, Column]:
    """0/1 indicators from the lighting class."""
    c = _c(cond)
    flag = lambda e: F.coalesce(e, F.lit(False)).cast("int")
    return {
        "is_daylight": flag(c == "daylight"),
        "is_civil_twilight": flag(c.contains("civil_twilight")),
        "is_twilight_dawn": flag(c == "civil_twilight_dawn"),
        "is_twilight_dusk": flag(c == "civil_twilight_dusk"),
        "is_dark": flag(c == "dark"),
    }
