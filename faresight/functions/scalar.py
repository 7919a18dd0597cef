"""Scalar column functions. All return native Spark ``Column`` expressions,
so they stay inside whole-stage code generation."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Fixed values (reference semantics): peak months, bin edges and labels.
PEAK_MONTHS = (1, 4, 5, 6, 12)
PEAK_MONTHS_SHORT = (1, 4, 5, 12)
BOOKING_WINDOW_EDGES = (-1, 3, 7, 14, 30, 60, 999)
BOOKING_WINDOW_LABELS = ("last_min", "3_7d", "1_2wk", "2_4wk", "1_2mo", "2mo_plus")
HAUL_EDGES = (-1, 2, 5, 10, 999)
HAUL_LABELS = ("short", "medium", "long", "ultra_long")
CLASS_ORDINAL = {"Economy": 1, "Business": 2, "First Class": 3}
NAN = "nan"  # how a missing category prints after a string cast


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F1 -----------------------------------------------------------------------
def parse_ts(c, fmt: str | None = None) -> Column:
    """Parse a timestamp; an unparsable value becomes null (never an error)."""
    c = _c(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


# F2 / F3 ------------------------------------------------------------------
def month(c) -> Column:
    return F.month(_c(c))


def hour(c) -> Column:
    return F.hour(_c(c))


def day_of_week(c) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(_c(c))


def day_name(c) -> Column:
    return F.date_format(_c(c), "EEEE")


# F4 -----------------------------------------------------------------------
def cyclic_sin(c, period: float) -> Column:
    return F.sin(F.lit(2 * math.pi) * _c(c) / F.lit(float(period)))


def cyclic_cos(c, period: float) -> Column:
    return F.cos(F.lit(2 * math.pi) * _c(c) / F.lit(float(period)))


# F5 / F6 / F7 / F15 / P7 --------------------------------------------------
def flag(cond: Column) -> Column:
    """Boolean → 0/1 int; null → 0 (a comparison with a missing value is false)."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def is_weekend(dow) -> Column:
    return flag(_c(dow) >= 5)


def in_set_flag(c, values: Sequence) -> Column:
    return flag(_c(c).isin(list(values)))


def equals_flag(c, value) -> Column:
    return flag(_c(c) == F.lit(value))


def cross(a, b, sep: str = "__") -> Column:
    """Null-propagating concatenation a__b."""
    return F.concat(_c(a), F.lit(sep), _c(b))


def as_category(c) -> Column:
    """String form of a category; a missing value prints as 'nan'."""
    return F.coalesce(_c(c).cast("string"), F.lit(NAN))


def cross_str(*cols, sep: str = "__") -> Column:
    """Concatenation of string casts; a missing part reads 'nan'."""
    return F.concat_ws(sep, *[as_category(c) for c in cols])


# F9 / F10 -----------------------------------------------------------------
def clip_lower(c, lower: float = 0.0) -> Column:
    """Clip from below; a null stays null (``greatest`` alone would give ``lower``)."""
    c = _c(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(c, F.lit(lower)))


def log1p(c) -> Column:
    return F.log1p(_c(c))


def square(c) -> Column:
    c = _c(c)
    return c * c


def expm1(c) -> Column:
    return F.expm1(_c(c))


# F11 ----------------------------------------------------------------------
def cut_labels(c, edges: Sequence[float], labels: Sequence[str], default: str = NAN) -> Column:
    """Right-closed bins (e0,e1], (e1,e2], …; values outside or null → ``default``."""
    assert len(labels) == len(edges) - 1
    c = _c(c)
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out.otherwise(F.lit(default))


def cut_codes(c, edges: Sequence[float], include_lowest: bool = False) -> Column:
    """Right-closed bin index 0..k-1 for the given edges; outside → null.

    With ``include_lowest`` the first bin is closed on the left too.
    """
    c = _c(c)
    out = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        left = (c >= F.lit(lo)) if (include_lowest and i == 0) else (c > F.lit(lo))
        cond = left & (c <= F.lit(hi))
        out = F.when(cond, F.lit(i)) if out is None else out.when(cond, F.lit(i))
    return out


def cut_codes_array(c, edges_col: Column, include_lowest: bool = True) -> Column:
    """Right-closed bin index against an array column of sorted edges.

    ``edges_col`` holds k+1 ascending edges; bin i is (e_i, e_{i+1}], the
    first one closed on the left when ``include_lowest``. Outside → null.
    Counting edges strictly below the value gives the bin in one pass.
    """
    c = _c(c)
    below = F.size(F.filter(edges_col, lambda e: e < c))
    k = F.size(edges_col) - 1
    first = F.element_at(edges_col, 1)
    last = F.element_at(edges_col, -1)
    idx = below - 1
    if include_lowest:
        idx = F.when(c == first, F.lit(0)).otherwise(idx)
    return F.when(c.isNull() | (c > last) | (idx < 0) | (idx >= k), F.lit(None)).otherwise(idx)


def equal_width_code(c, lo: Column, hi: Column, bins: int) -> Column:
    """``pd.cut(x, bins=k, labels=False)``: k equal-width right-closed bins
    between min and max, the lowest edge moved down by 0.1 % of the range."""
    c = _c(c)
    width = (hi - lo) / F.lit(float(bins))
    # bin i covers (lo + i*w, lo + (i+1)*w]; the minimum lands in bin 0
    raw = F.ceil((c - lo) / width) - F.lit(1)
    idx = F.when(c == lo, F.lit(0)).otherwise(raw)
    idx = F.least(F.greatest(idx, F.lit(0)), F.lit(bins - 1))
    const = F.when(hi == lo, F.lit(0))  # constant column: one bin
    return F.when(c.isNull(), F.lit(None)).otherwise(F.coalesce(const, idx)).cast("int")


# J4 / F14 -----------------------------------------------------------------
def recode(c, mapping: dict, default=None) -> Column:
    """Dictionary recode with a default for unmapped or null values."""
    m = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.coalesce(m[_c(c)], F.lit(default))


# F16 ----------------------------------------------------------------------
def wall_clock_micros(c) -> Column:
    """Microseconds since the epoch of a timestamp_ntz read as UTC wall clock
    (no session time zone, so no daylight-saving jumps)."""
    c = _c(c)
    micros = F.date_format(c, "SSSSSS").cast("decimal(16,6)")
    secs = (F.second(c).cast("decimal(16,6)") + micros / F.lit(1_000_000)).cast("decimal(16,6)")
    return F.unix_micros(F.make_timestamp_ltz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                                              secs, F.lit("UTC")))


def elapsed_hours(start, end) -> Column:
    """Hours between two timestamp_ntz values (wall-clock difference)."""
    return (wall_clock_micros(end) - wall_clock_micros(start)) / F.lit(3.6e9)


# F17 ----------------------------------------------------------------------
def sanitize_metric_name(c) -> Column:
    """Keep letters, digits, ``_ - . /`` and space; anything else → ``_``."""
    return F.regexp_replace(_c(c), r"[^a-zA-Z0-9_\-\. /]", "_")


# F18 ----------------------------------------------------------------------
def code_from_display(c) -> Column:
    """'City (ABC)' → 'ABC'; text without a parenthesis is returned trimmed."""
    c = _c(c)
    return F.trim(F.regexp_replace(F.substring_index(c, "(", -1), r"\)", ""))


# F19 ----------------------------------------------------------------------
def serve_prediction(c, digits: int = 2) -> Column:
    """Floor at 0 and round, as a served price."""
    return F.round(F.greatest(_c(c), F.lit(0.0)), digits)


# F22 ----------------------------------------------------------------------
def json_first(c, *paths: str) -> Column:
    """First non-null JSON path among ``paths`` (fallback keys)."""
    return F.coalesce(*[F.get_json_object(_c(c), p) for p in paths])
