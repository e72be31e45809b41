"""Type coercion and cleaning scalars (D1-D10). ANSI mode is on in Spark 4,
so every text -> number path goes through ``try_cast`` / ``try_to_timestamp``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_numeric_null_token(c: ColumnOrName, token: str = "NULL", to: str = "double") -> Column:
    """Text -> number; the null token and unparsable text become null."""
    return F.nullif(F.trim(_c(c)), F.lit(token)).try_cast(to)


def to_timestamp_coerce(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Text -> timestamp, bad text -> null."""
    c = _c(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def strip_brackets_to_number(c: ColumnOrName) -> Column:
    """D3: ``'[5E-1]'`` -> 0.5; anything unparsable -> null."""
    return F.trim(F.regexp_replace(_c(c).cast("string"), r"[\[\]]", "")).try_cast("double")


def scrub_numeric_text(c: ColumnOrName) -> Column:
    """Map the unicode minus to '-', keep only ``0-9 . - E e``."""
    s = F.regexp_replace(_c(c).cast("string"), "−", "-")
    return F.regexp_replace(s, r"[^0-9.\-Ee]", "").try_cast("double")


def safe_number(c: ColumnOrName, default: float) -> Column:
    """Numeric value or the default. Text that begins like a word, and not
    like infinity or not-a-number, is not parsed: failing costs far more."""
    text = _c(c).cast("string")
    first = F.ascii(F.lower(F.substring(text, 1, 1)))
    word = first.between(ord("a"), ord("z")) & (first != ord("i")) & (F.lower(F.substring(text, 1, 3)) != "nan")
    return F.when(word, F.lit(float(default))).otherwise(F.coalesce(text.try_cast("double"), F.lit(float(default))))


def normalise_key(c: ColumnOrName) -> Column:
    """Join key normalisation (trim + upper)."""
    return F.upper(F.trim(_c(c)))


def fill_category(c: ColumnOrName, label: str = "missing") -> Column:
    """Null category -> label, as text."""
    return F.coalesce(_c(c).cast("string"), F.lit(label))


def finite_or(c: ColumnOrName, fill: ColumnOrName | float | None = 0.0) -> Column:
    """+-inf and NaN -> null, then fill (a literal or a column, e.g. a mean)."""
    c = _c(c)
    cleaned = F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)
    if fill is None:
        return cleaned
    fillc = fill if isinstance(fill, Column) else F.lit(fill)
    return F.coalesce(cleaned, fillc)


def map_codes(c: ColumnOrName, mapping: dict, default=None) -> Column:
    """Dictionary lookup as a literal map (no join); unmapped -> default."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    looked = F.try_element_at(m, _c(c))
    return looked if default is None else F.coalesce(looked, F.lit(default))


# Weather unit conversion factors (fixed values): NOAA daily values arrive in
# tenths; wind m/s -> mph factor.
TENTHS = 10.0
MPS_TO_MPH = 2.237


def unit_convert(prcp: ColumnOrName, tmax: ColumnOrName, tmin: ColumnOrName,
                 tavg: ColumnOrName, awnd: ColumnOrName) -> dict[str, Column]:
    """NOAA text fields -> metric/imperial columns (returned by name)."""
    num = lambda x: _c(x).cast("string").try_cast("double")
    out = {"precipitation_mm": num(prcp) / TENTHS}
    for name, src in (("max", tmax), ("min", tmin), ("avg", tavg)):
        c_ = num(src) / TENTHS
        out[f"temp_{name}_c"] = c_
        out[f"temp_{name}_f"] = c_ * 9 / 5 + 32
    out["wind_speed_ms"] = num(awnd) / TENTHS
    out["wind_speed_mph"] = out["wind_speed_ms"] * MPS_TO_MPH
    return out
