"""Rounding used only where a result is compared with another engine.

Sums of floating-point numbers differ in the last digits between engines.
Sums of money are exact multiples of a decimal, so decimal rounding is safe.
Other reals are rounded to multiples of 2^-20 (about six decimals): decimal
ties such as ...5 are common in averages of cents, binary ties are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

_GRID = 1048576.0
_COARSE = 64.0


def steady(df: DataFrame, real=(), pnl=(), money=(), coarse=()) -> DataFrame:
    """Round the named columns in place, keeping the column order."""

    def grid(c, g):
        return f"case when abs({c}) < 1e12D then floor({c} * {g}D + 0.5D) / {g}D else {c} end as {c}"

    out = []
    for name in df.columns:
        c = f"`{name}`"
        if name in real:
            out.append(grid(c, _GRID))
        elif name in coarse:
            out.append(grid(c, _COARSE))
        elif name in pnl:
            out.append(f"round({c}, 4) as {c}")
        elif name in money:
            out.append(f"round({c}, 2) as {c}")
        else:
            out.append(c)
    return df.selectExpr(*out)


def real(expr: str, grid: float = _GRID) -> str:
    e = f"cast({expr} as double)"
    return f"(case when abs({e}) < 1e12 then floor({e} * {grid}e0 + 0.5e0) / {grid}e0 else {e} end)"


def coarse(expr: str) -> str:
    return real(expr, _COARSE)


def pnl(expr: str) -> str:
    return f"round({expr}, 4)"


def money(expr: str) -> str:
    return f"round({expr}, 2)"
