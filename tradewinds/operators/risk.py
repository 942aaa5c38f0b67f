"""Tail risk and the per-group risk report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tradewinds.functions import risk as r
from tradewinds.operators.ordered import BLOCK_ROWS, ORDER, bounded_frame, max_drawdown
from tradewinds.operators.percentiles import agg_with_percentiles, exact_percentiles, same_keys
from tradewinds.operators.performance import order_by_class
from tradewinds.operators.silver import realized_trades


def tail_risk_by_class(silver: DataFrame) -> DataFrame:
    losing = F.col("closed_pnl") < 0
    out = agg_with_percentiles(
        realized_trades(silver), ["sentiment_class"],
        [
            F.min("closed_pnl").alias("worst_loss"),
            F.avg(F.when(losing, F.col("closed_pnl"))).alias("avg_loss"),
            F.count_if(losing).alias("num_losses"),
            (F.count_if(losing) / F.count(F.lit(1))).alias("loss_ratio"),
        ],
        {"var_95": ("closed_pnl", 0.05), "var_99": ("closed_pnl", 0.01)})
    return order_by_class(out)


def value_at_risk(df: DataFrame, keys: Sequence[str], pnl: str, levels: dict[str, float]) -> DataFrame:
    """Historical VaR of each group, ``levels`` from name to confidence; groups may be of any size."""
    return exact_percentiles(df, keys, pnl, {name: r.tail_probability(alpha) for name, alpha in levels.items()})


def expected_shortfall(df: DataFrame, keys: Sequence[str], pnl: str, levels: dict[str, float]) -> DataFrame:
    """Mean of the rows at or below each group's VaR, ``levels`` from name to confidence; one search, no join back."""
    var = {f"_var_{name}": r.tail_probability(alpha) for name, alpha in levels.items()}
    return exact_percentiles(df, keys, pnl, var, {name: f"_var_{name}" for name in levels}).select(*keys, *levels)


def rows_beyond_var(df: DataFrame, var: DataFrame, key: str, pnl: str = "closed_pnl", level: str = "var_95") -> DataFrame:
    """Rows at or below their group's VaR (equality plus range condition). Groups may be many: the join is planned by size."""
    levels = var.select(F.col(key).alias(f"_k_{key}"), level)
    return df.join(levels, same_keys(df, levels, [key]) & (F.col(pnl) <= F.col(level))).drop(f"_k_{key}")


def risk_metrics_report(silver: DataFrame, group_col: str = "sentiment_class", order: Sequence[str] = ORDER) -> DataFrame:
    """Volatility, downside, drawdowns, risk-adjusted ratios, VaR and expected shortfall per group.

    The annualisation factor is 365 over the distinct days of all realized
    trades, and the annualised return is divided by the number of all realized
    trades; both are scalar subqueries.
    """
    realized = realized_trades(silver)
    overall = realized.groupBy("date").agg(F.count(F.lit(1)).alias("_n")).agg(
        F.count("date").alias("days"), F.sum("_n").alias("rows"))
    factor = F.when(F.col("_days") > 0, F.lit(365.0) / F.col("_days")).otherwise(365.0)
    base = agg_with_percentiles(
        realized, [group_col],
        [
            F.count(F.lit(1)).alias("trade_count"),
            F.sum("roe").alias("_total_roe"),
            r.volatility("roe").alias("volatility"),
            r.downside_deviation("roe").alias("downside_dev"),
            r.sharpe_ratio("roe", factor=1.0).alias("_sharpe"),
            r.sortino_ratio("roe", factor=1.0).alias("_sortino"),
        ],
        {"var_95": ("closed_pnl", 0.05), "var_99": ("closed_pnl", 0.01)}, {"cvar_95": "var_95", "cvar_99": "var_99"})
    falls = max_drawdown(realized, [group_col], order, {"max_drawdown_usd": "closed_pnl", "max_drawdown_roe": "roe"})
    out = base.join(falls, group_col).withColumns({
        "_days": overall.select("days").scalar(), "_rows": overall.select("rows").scalar()})
    return out.select(
        group_col, "volatility", "downside_dev", "max_drawdown_usd", "max_drawdown_roe",
        (F.col("_sharpe") * F.sqrt(factor)).alias("sharpe_ratio"),
        (F.col("_sortino") * F.sqrt(factor)).alias("sortino_ratio"),
        r.calmar_ratio(F.col("_total_roe") * (factor / F.col("_rows")), "max_drawdown_roe").alias("calmar_ratio"),
        "var_95", "var_99", "cvar_95", "cvar_99", "trade_count")


def rolling_var(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER, pnl: str = "closed_pnl",
                n: int = 30, alpha: float = 0.95, rows: int = BLOCK_ROWS, whole_if_short: bool = True) -> DataFrame:
    """VaR of the last ``n`` rows; NULL for the first n-1; the whole-series VaR when the series is shorter than ``n``.

    That last value knows the rows after a trade. Without ``whole_if_short`` a short series has NULL only.
    """
    p = F.lit(r.tail_probability(alpha))

    def compute(trades: DataFrame, part: list[str]) -> DataFrame:
        frame = Window.partitionBy(*part).orderBy(*order).rowsBetween(-(n - 1), 0)
        whole = Window.partitionBy(*part)
        size = F.count(F.lit(1)).over(whole)
        # a short series fits the frame of its last row, so no second percentile over the partition is needed
        whole_ordered = whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        with_frame = trades.withColumn("_in_frame", F.count(F.lit(1)).over(frame)).withColumn("_size", size).withColumn(
            "_var", F.percentile(pnl, p).over(frame))
        return with_frame.withColumn("_last", F.last("_var").over(whole_ordered)).withColumn(
            "rolling_var",
            F.when(F.lit(whole_if_short) & (F.col("_size") < n), F.col("_last")).when(F.col("_in_frame") == n, F.col("_var")),
        ).drop("_in_frame", "_size", "_var", "_last")

    return bounded_frame(df, keys, order, n - 1, compute, rows)
