"""Splits and samples (T1–T5, T8) over a deterministic total order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from faresight.operators.prefix import prefix_sums, row_index_and_count
from faresight.session import drop_table, materialize


def total_order(df: DataFrame, ts: str, tiebreak: Sequence[str] | None = None) -> list[Column]:
    """Time ascending with missing times last, then every other column
    (so rows with equal keys are identical and interchangeable)."""
    rest = list(tiebreak) if tiebreak is not None else [c for c in df.columns if c != ts]
    return [F.col(ts).asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in rest]


def split_index(n: int, test_size: float) -> int:
    """First ``int(n·(1−test_size))`` positions are train."""
    return int(n * (1 - test_size))


def temporal_split(df: DataFrame, ts: str, test_size: float = 0.2, tiebreak: Sequence[str] | None = None,
                   idx_col: str = "row_idx", split_col: str = "split") -> DataFrame:
    """Sort by time, the first ``int(n·(1−test_size))`` rows are
    'train', the rest 'test'. Adds the global position and the split flag;
    the data stays one frame (partition by ``split`` when writing)."""
    x = materialize(df)        # the sort reads its rows twice and keeps no upstream shuffle beside its own
    indexed, n = row_index_and_count(x, total_order(x, ts, tiebreak), idx_col)
    drop_table(x)
    cut = split_index(n, test_size)
    return indexed.withColumn(split_col, F.when(F.col(idx_col) < cut, F.lit("train")).otherwise(F.lit("test")))


def _time_value(ts: str, dtype: str) -> Column:
    """A time as a value that Python neither rounds nor moves to another zone."""
    return F.unix_micros(ts) if dtype == "timestamp" else F.col(ts).cast("string")


def temporal_flag(df: DataFrame, ts: str, columns: Sequence[str], test_size: float = 0.2, tiebreak: Sequence[str] | None = None,
                  split_col: str = "split", rows_at: Callable[[Callable[[Column], Column]], DataFrame] | None = None) -> DataFrame:
    """``columns`` and the flag of ``temporal_split``, without positions and without sorting the
    table: a row's time decides, by the counts of the distinct times, on which side it falls.
    Only the rows of the one time that the cut divides are put in the total order. The columns
    are written once, without the tie-breaking ones. ``rows_at``: gives the rows of ``df`` whose
    time meets a condition, where there is a cheaper way than to filter ``df``."""
    dtype = dict(df.dtypes)[ts]
    x = materialize(df.select(*dict.fromkeys([*columns, ts])))
    times = x.groupBy(ts).agg(F.count(F.lit(1)).alias("_c"))
    n = x.count()
    cut = split_index(n, test_size)
    cum = prefix_sums(times, [F.col(ts).asc_nulls_last()], ["_c"])
    at = cum.where((F.col("cum__c") - F.col("_c") <= cut) & (F.col("cum__c") > cut)).select(
        _time_value(ts, dtype).alias("t"), (F.col("cum__c") - F.col("_c")).alias("before")).collect()  # the one time at the cut
    if not at:        # no row lies beyond the cut
        return x.select(*columns, F.lit("train").alias(split_col))
    t = at[0]["t"]
    if t is None:
        at_cut, earlier = Column.isNull, F.col(ts).isNotNull()
    else:
        time = F.timestamp_micros(F.lit(t)) if dtype == "timestamp" else F.lit(t).cast(dtype)

        def at_cut(c):
            return F.coalesce(c == time, F.lit(False))
        earlier = F.coalesce(F.col(ts) < time, F.lit(False))
    edge = at_cut(F.col(ts))
    first = cut - at[0]["before"]
    if first == 0:
        return x.select(*columns, F.when(earlier, F.lit("train")).otherwise(F.lit("test")).alias(split_col))
    tied, _ = row_index_and_count(df.where(edge) if rows_at is None else rows_at(at_cut), total_order(df, ts, tiebreak), "_at")
    tied = tied.select(*columns, F.when(F.col("_at") < first, F.lit("train")).otherwise(F.lit("test")).alias(split_col))
    return x.where(~edge).select(*columns, F.when(earlier, F.lit("train")).otherwise(F.lit("test")).alias(split_col)).unionByName(tied)


def temporal_positions(df: DataFrame, ts: str, columns: Sequence[str], test_size: float = 0.2, tiebreak: Sequence[str] | None = None,
                       idx_col: str = "row_idx", split_col: str = "split") -> DataFrame:
    """``columns`` with the position and flag of ``temporal_split``: the other columns take part
    in the sort and are not written with the result."""
    x = materialize(df)
    indexed, n = row_index_and_count(x, total_order(x, ts, tiebreak), idx_col, keep=columns)
    drop_table(x)
    return indexed.withColumn(split_col, F.when(F.col(idx_col) < split_index(n, test_size), F.lit("train")).otherwise(F.lit("test")))


def _block(n: int, k: int) -> int:
    if n < k + 1:
        raise ValueError(f"{k} walk-forward folds need at least {k + 1} rows, not {n}")
    return n // (k + 1)


def walk_forward_bounds(n: int, k: int) -> list[tuple[int, int]]:
    """T4 (``TimeSeriesSplit``): fold i tests positions [n−(k−i)·m, n−(k−i−1)·m)
    with m = n div (k+1) and trains on everything before."""
    m = _block(n, k)
    return [(n - (k - i) * m, n - (k - i - 1) * m) for i in range(k)]


def walk_forward_blocks(indexed: DataFrame, n: int, k: int, idx_col: str = "row_idx",
                        block_col: str = "block") -> DataFrame:
    """Tag each row with its test block (fold number, or −1 for rows that
    are only ever trained on). Fold i trains on blocks < i."""
    m = _block(n, k)
    first = n - k * m
    blk = F.when(F.col(idx_col) < first, F.lit(-1)).otherwise(
        F.floor((F.col(idx_col) - F.lit(first)) / F.lit(m)).cast("int"))
    return indexed.withColumn(block_col, blk)


def row_hash(cols: Sequence, seed: int = 42, portable: bool = False) -> Column:
    """64-bit hash of row content. ``portable``: the first 15 hex digits of the MD5 of the
    values' text (nulls left out) joined by "|", which any engine can reproduce for string
    and integer columns; else the faster ``xxhash64``."""
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    if portable:
        text = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols])
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    return F.xxhash64(F.lit(seed), *cols)


def sql_row_hash(cols: Sequence[str], seed: int = 42) -> str:
    """DuckDB form of the portable hash."""
    return f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', {', '.join(f'CAST({c} AS VARCHAR)' for c in cols)})), 1, 15) AS BIGINT)"


def hash_fold(cols: Sequence, k: int, seed: int = 42, portable: bool = False) -> Column:
    """T5: a deterministic fold id in [0, k) from a row-content hash."""
    return F.pmod(row_hash(cols, seed, portable), F.lit(k)).cast("int")


def hash_split(df: DataFrame, cols: Sequence[str], test_size: float = 0.2, seed: int = 42,
               split_col: str = "split", portable: bool = False) -> DataFrame:
    """Stable random split by row-content hash (same rows → same side,
    independent of partitioning, unlike ``randomSplit``)."""
    u = F.pmod(row_hash(cols, seed, portable), F.lit(1_000_000)) / F.lit(1_000_000.0)
    return df.withColumn(split_col, F.when(u < F.lit(1 - test_size), F.lit("train")).otherwise(F.lit("test")))


def deterministic_sample(df: DataFrame, n: int, cols: Sequence[str] | None = None, seed: int = 42,
                         portable: bool = False) -> DataFrame:
    """``min(n, N)`` rows without replacement: order by a content hash and
    keep the first ``n`` (a top-k, planned as TakeOrderedAndProject)."""
    cols = list(cols) if cols is not None else df.columns
    return df.orderBy(row_hash(cols, seed, portable), *[F.col(c).asc_nulls_last() for c in cols]).limit(n)
