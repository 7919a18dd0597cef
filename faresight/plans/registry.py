"""Registry of named analyses: a Spark builder plus, where the result is
SQL-expressible, the DuckDB form used as a correctness oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = decimal_rounding(sql)
        return fn
    return deco


def rnd(c, digits: int = 6) -> Column:
    """Round a double for engine-independent comparison."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits)


def _matching_paren(sql: str, start: int) -> int:
    """Index of the ')' closing the '(' at ``start`` (string literals skipped)."""
    depth, i, quote = 0, start, False
    while i < len(sql):
        ch = sql[i]
        if quote:
            if ch == "'":
                if i + 1 < len(sql) and sql[i + 1] == "'":
                    i += 1
                else:
                    quote = False
        elif ch == "'":
            quote = True
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
            if depth == 0:
                return i
        i += 1
    raise ValueError("unbalanced parentheses in oracle SQL")


def _split_last_arg(body: str) -> tuple[str, str] | None:
    depth, quote, last = 0, False, -1
    for i, ch in enumerate(body):
        if quote:
            quote = ch != "'"
        elif ch == "'":
            quote = True
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "," and depth == 0:
            last = i
    return None if last < 0 else (body[:last], body[last + 1:].strip())


def decimal_rounding(sql: str) -> str:
    """Make the oracle's ``round(x, d)`` round like Spark: Spark rounds the
    decimal form of a double half-up, DuckDB rounds x·10^d in floating point,
    which differs on near-ties. Rounding a DECIMAL cast agrees with Spark."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        close = _matching_paren(sql, j + 5)
        parts = _split_last_arg(sql[j + 6:close])
        out.append(sql[i:j])
        if parts is None or not parts[1].isdigit():
            out.append("round(" + decimal_rounding(sql[j + 6:close]) + ")")
        else:
            expr, d = decimal_rounding(parts[0]), int(parts[1])
            out.append(f"CAST(round(CAST(({expr}) AS DECIMAL(38,{min(d + 4, 18)})), {d}) AS DOUBLE)")
        i = close + 1
