"""Feature builders (E1–E4, E13). Each is a single projection: no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from faresight.functions import scalar as S
from faresight.roles import FLIGHT_ROLES, Roles


def _raw_kept(df: DataFrame, roles: Roles, extra: Sequence[str] = ()) -> list[str]:
    """Raw feature columns: those with a categorical or numeric role (plus
    ``extra``), in frame order. Target, leaky, redundant, date and any
    bookkeeping columns (keys, split flags) are left out."""
    want = set(roles.cat) | set(roles.num) | set(extra)
    return [c for c in df.columns if c in want]


def date_parts(ts, peak_months: Sequence[int] = S.PEAK_MONTHS, with_hour: bool = True) -> dict:
    """Month/day-of-week/hour, cyclic encodings and weekend/peak flags."""
    m, dow, hr = S.month(ts), S.day_of_week(ts), S.hour(ts)
    out = {"month": m, "day_of_week": dow}
    if with_hour:
        out["hour"] = hr
    out["month_sin"] = S.cyclic_sin(m, 12)
    out["month_cos"] = S.cyclic_cos(m, 12)
    if with_hour:
        out["hour_sin"] = S.cyclic_sin(hr, 24)
        out["hour_cos"] = S.cyclic_cos(hr, 24)
        out["is_weekend"] = S.is_weekend(dow)
    out["is_peak"] = S.in_set_flag(m, peak_months)
    return out


def _timestamp(df: DataFrame, name: str):
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return S.parse_ts(F.col(name))
    return F.col(name)


def engineer_features(df: DataFrame, roles: Roles = FLIGHT_ROLES, keep: Sequence[str] = (),
                      peak_months: Sequence[int] = S.PEAK_MONTHS) -> DataFrame:
    """The full feature builder.

    Kept raw columns (everything but target, leaky, redundant and date
    columns, in input order), then date parts, crosses, numeric transforms
    and labelled bins. ``keep`` names extra pass-through columns (target,
    row keys) appended at the end.
    """
    ts = _timestamp(df, roles.date)
    dur = S.clip_lower(roles.duration, 0.0)
    dbd = S.clip_lower(roles.days_before, 0)
    feats = date_parts(ts, peak_months)
    feats.update({
        "route": S.cross(roles.source, roles.destination),
        "airline_class": S.cross(roles.airline, roles.travel_class),
        "log_duration": S.log1p(dur),
        "duration_sq": S.square(dur),
        "log_days_before": S.log1p(dbd),
        "booking_window": S.cut_labels(dbd, S.BOOKING_WINDOW_EDGES, S.BOOKING_WINDOW_LABELS),
        "haul_type": S.cut_labels(dur, S.HAUL_EDGES, S.HAUL_LABELS),
        "is_direct": S.equals_flag(roles.stopovers, "Direct"),
    })
    raw = [c for c in _raw_kept(df, roles) if c not in keep]
    return df.select(*raw, *[v.alias(k) for k, v in feats.items()], *keep)


def short_date_features(df: DataFrame, date_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Month, day of week, hour, month cyclic pair and the short peak list;
    the date column is replaced by its parts."""
    ts = _timestamp(df, date_col)
    m = S.month(ts)
    others = [c for c in df.columns if c != date_col and c not in keep]
    return df.select(*others,
                     m.alias("month"), S.day_of_week(ts).alias("day_of_week"), S.hour(ts).alias("hour"),
                     S.cyclic_sin(m, 12).alias("month_sin"), S.cyclic_cos(m, 12).alias("month_cos"),
                     S.in_set_flag(m, S.PEAK_MONTHS_SHORT).alias("is_peak_season"), *keep)


def leaky_experiment_features(df: DataFrame, roles: Roles = FLIGHT_ROLES, include_tax: bool = False,
                              keep: Sequence[str] = ()) -> DataFrame:
    """E1 with string-cast crosses ('nan' for missing parts), the class
    ordinal (default 1) and class products; optionally keeps the tax column."""
    ts = _timestamp(df, roles.date)
    dur = S.clip_lower(roles.duration, 0.0)
    dbd = S.clip_lower(roles.days_before, 0)
    cls_num = S.recode(roles.travel_class, S.CLASS_ORDINAL, 1)
    feats = date_parts(ts)
    feats.update({
        "route": S.cross_str(roles.source, roles.destination),
        "airline_class": S.cross_str(roles.airline, roles.travel_class),
        "log_duration": S.log1p(dur),
        "duration_sq": S.square(dur),
        "log_days_before": S.log1p(dbd),
        "booking_window": S.cut_labels(dbd, S.BOOKING_WINDOW_EDGES, S.BOOKING_WINDOW_LABELS),
        "haul_type": S.cut_labels(dur, S.HAUL_EDGES, S.HAUL_LABELS),
        "is_direct": S.equals_flag(roles.stopovers, "Direct"),
        "class_numeric": cls_num,
        "duration_x_class": dur * cls_num,
        "days_before_x_class": dbd * cls_num,
    })
    raw = [c for c in _raw_kept(df, roles, ["tax"] if include_tax else []) if c not in keep]
    return df.select(*raw, *[v.alias(k) for k, v in feats.items()], *keep)


def class_crosses(df: DataFrame, cls: str = "travel_class") -> DataFrame:
    """E4 (cross part): class × route / destination / haul / booking window,
    the class ordinal and class × duration / days products."""
    cls_num = S.recode(F.col(cls).cast("string"), S.CLASS_ORDINAL, 1)
    return df.withColumns({
        "class_route": S.cross_str(cls, "route"),
        "class_dest": S.cross_str(cls, "destination"),
        "class_haul": S.cross_str(cls, "haul_type"),
        "class_book_win": S.cross_str(cls, "booking_window"),
        "class_numeric": cls_num,
        "duration_x_class": F.col("duration_hrs") * cls_num,
        "days_before_x_class": F.col("days_before") * cls_num,
    })


def feature_schema(df: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str]) -> DataFrame:
    """One-row schema record (counts, role lists, types, column order) with the rows
    and the present values of every column, from one aggregate."""
    def names(cols):
        return F.array(*[F.lit(c) for c in cols]).cast("array<string>")
    dtypes = F.map_from_arrays(names(df.columns), names([f.dataType.simpleString() for f in df.schema.fields]))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.map_from_arrays(names(df.columns), F.array(*[F.count(F.col(f"`{c}`")) for c in df.columns]))
                  .alias("present")).select(
        F.lit(len(df.columns)).alias("total_features"), names(cat_cols).alias("categorical_features"), names(num_cols).alias("numeric_features"),
        dtypes.alias("dtypes"), names(df.columns).alias("columns_ordered"), "rows", "present")


def split_roles(df: DataFrame, cat_candidates: Sequence[str]) -> tuple[list[str], list[str]]:
    """categorical = the candidates present (in candidate order); numeric =
    every other column (in frame order)."""
    cats = [c for c in cat_candidates if c in df.columns]
    nums = [c for c in df.columns if c not in cats]
    return cats, nums


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns of numeric type (booleans excluded), minus ``exclude``."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in set(exclude)]


def drop_if_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns, ignoring names that are absent."""
    return df.drop(*[n for n in names if n in df.columns])


def reorder_like(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project to a fixed (training) column order."""
    return df.select(*columns)
