"""Risk budget by contribution, and sizes bounded by what was known when a trade was made."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewinds.operators.ordered import asof

#: Leverage allowed in greed (score above the first number) and in fear (score below it).
GREED_CAP, FEAR_CAP = (75, 2.0), (30, 5.0)


def risk_contribution(realized: DataFrame, portfolio: str = "account", part: str = "coin", day: str = "date", pnl: str = "closed_pnl") -> DataFrame:
    """Volatility of each portfolio's daily PnL and what its parts add to it.

    ``portfolio, part, part_volatility, portfolio_volatility, contribution, share``.
    A part's contribution is the covariance of its daily PnL with the
    portfolio's, over the portfolio's volatility; contributions add up to that
    volatility, shares to 1. Days count on which the portfolio traded; a part
    that did not trade on one earned 0, and such days need no rows. A portfolio
    of fewer than two days or without volatility has contributions of 0 and no shares.
    """
    cells = realized.where(F.col(day).isNotNull()).groupBy(portfolio, day, part).agg(F.sum(pnl).alias("_x"))
    days = cells.groupBy(portfolio, day).agg(F.sum("_x").alias("_t"))
    whole = days.groupBy(portfolio).agg(F.count(F.lit(1)).alias("_days"), F.sum("_t").alias("_st"), F.stddev_samp("_t").alias("_vol"))
    # the day's total meets the few parts traded that day
    joined = cells.withColumn("_t", F.sum("_x").over(Window.partitionBy(portfolio, day)))
    sums = joined.groupBy(portfolio, part).agg(
        F.sum("_x").alias("_sx"), F.sum(F.col("_x") * F.col("_x")).alias("_sxx"), F.sum(F.col("_x") * F.col("_t")).alias("_sxt"))
    both = sums.withColumnRenamed(portfolio, "_p").join(whole, F.col("_p").eqNullSafe(F.col(portfolio))).drop("_p")
    spare = F.nullif(F.col("_days") - 1, F.lit(0))
    covariance = (F.col("_sxt") - F.col("_sx") * F.col("_st") / F.col("_days")) / spare
    variance = F.greatest((F.col("_sxx") - F.col("_sx") * F.col("_sx") / F.col("_days")) / spare, F.lit(0.0))
    volatility = F.coalesce("_vol", F.lit(0.0))
    contribution = F.when(volatility > 0, covariance / volatility).otherwise(0.0)
    return both.select(
        portfolio, part, F.coalesce(F.sqrt(variance), F.lit(0.0)).alias("part_volatility"), volatility.alias("portfolio_volatility"),
        contribution.alias("contribution"), F.when(volatility > 0, contribution / volatility).alias("share"))


def within_budget(contributions: DataFrame, limit: float = 0.25) -> DataFrame:
    """Adds ``over_budget`` and ``size_factor``: a part that carries more than ``limit`` of the volatility is to shrink to its budget."""
    over = F.coalesce(F.col("share") > limit, F.lit(False))
    return contributions.withColumns({"over_budget": over, "size_factor": F.when(over, F.lit(limit) / F.col("share")).otherwise(1.0)})


def banded_leverage(leverage: str = "leverage", score: str = "sentiment_score") -> Column:
    """Leverage under the cap of its sentiment band."""
    return F.when(F.col(score) > GREED_CAP[0], F.least(F.col(leverage).cast("double"), F.lit(GREED_CAP[1]))).when(
        F.col(score) < FEAR_CAP[0], F.least(F.col(leverage).cast("double"), F.lit(FEAR_CAP[1]))).otherwise(F.col(leverage).cast("double"))


def bounded_sizes(trades: DataFrame, risk: DataFrame, keys: Sequence[str] = ("account",), time: str = "ts", order: str = "fill_seq",
                  level: str = "rolling_var", limit: float = 500.0) -> DataFrame:
    """Adds ``known_var, bounded_size, bounded_leverage`` to every trade.

    ``risk`` holds the VaR of a series at times (``level``, a loss below 0).
    ``known_var`` is the last one from before the trade's time, never one of the
    same moment. The size shrinks so that this VaR scales down to ``limit``; a
    trade without known risk, or with one within the limit, keeps its size.
    """
    known = asof(trades, risk.where(F.col(level).isNotNull()), list(keys), time, order, {"known_var": level})
    factor = F.when(F.col("known_var") < -limit, F.lit(-limit) / F.col("known_var")).otherwise(1.0)
    return known.withColumns({"bounded_size": F.col("size_usd") * factor, "bounded_leverage": banded_leverage()})
