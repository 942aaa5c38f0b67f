"""Aggregate column builders for profit and risk; all usable inside any ``groupBy().agg``."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from tradewinds.functions.trade import as_col


def profit_factor(pnl="closed_pnl", no_loss="inf") -> Column:
    """Gains over absolute losses.

    ``no_loss`` picks what a group without losses gets: ``"inf"`` (infinite, or
    NaN when there is no gain either), ``"nan"``, ``"null"`` or a number.
    """
    c = as_col(pnl)
    gains = F.coalesce(F.sum(F.when(c > 0, c)), F.lit(0.0))
    losses = F.coalesce(F.sum(F.when(c < 0, -c)), F.lit(0.0))
    if no_loss == "inf":
        fallback = F.when(gains == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    elif no_loss == "nan":
        fallback = F.lit(float("nan"))
    elif no_loss == "null":
        fallback = F.lit(None).cast("double")
    else:
        fallback = F.lit(float(no_loss))
    return F.when(losses > 0, gains / losses).otherwise(fallback)


def correlation(a, b) -> Column:
    """Pearson correlation; NULL when a side is constant (the built-in ``corr`` raises there in ANSI mode)."""
    x, y = as_col(a), as_col(b)
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), spread)


def volatility(r) -> Column:
    return F.coalesce(F.stddev_samp(as_col(r)), F.lit(0.0))


def downside_deviation(r, target: float = 0.0) -> Column:
    c = as_col(r)
    below = c < target
    rows = F.count(c)
    squares = F.sum(F.when(below, (c - target) * (c - target)))
    return F.when((rows >= 2) & (F.count_if(below) >= 2), F.sqrt(squares / (rows - 1))).otherwise(0.0)


def _annualised(mean: Column, deviation: Column, factor) -> Column:
    factor = factor if isinstance(factor, Column) else F.lit(float(factor))
    return F.when(deviation > 0, mean / deviation * F.sqrt(factor)).otherwise(0.0)


def sharpe_ratio(r, risk_free: float = 0.0, factor=365.0) -> Column:
    return _annualised(F.avg(as_col(r)) - risk_free, volatility(r), factor)


def sortino_ratio(r, target: float = 0.0, risk_free: float = 0.0, factor=365.0) -> Column:
    return _annualised(F.avg(as_col(r)) - risk_free, downside_deviation(r, target), factor)


def calmar_ratio(annualised, drawdown) -> Column:
    depth = F.abs(as_col(drawdown))
    return F.when(depth > 0, as_col(annualised) / depth).otherwise(0.0)


def tail_probability(alpha: float) -> float:
    """The percentile position of a VaR level (0.95 -> 0.05), without float dust."""
    return round(1.0 - alpha, 12) if not math.isnan(alpha) else alpha


def value_at_risk(pnl, alpha: float = 0.95) -> Column:
    """Linear-interpolated tail percentile; for one small group. Large groups: ``operators.percentiles``."""
    return F.percentile(as_col(pnl), F.lit(tail_probability(alpha)))
