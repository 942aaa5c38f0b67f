"""Gold from monthly states: a ledger's sums per month and group, merged over the months.

A state is one row per month and group. States of different months merge by
adding, and the drawdown's tuple by the order of the months, so a month that
arrives late, or is corrected, is computed alone: its partition is replaced and
the ledgers are merged anew from rows that are few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewinds.operators.ordered import ORDER, drawdown_states, merged_drawdowns
from tradewinds.operators.silver import realized_trades
from tradewinds.sources.writers import write_table

#: Ledgers by the columns they group by.
LEDGERS = {
    "by_sentiment": ["sentiment_class"], "by_coin": ["coin"], "by_trader": ["account"], "by_leverage": ["leverage_bucket"],
    "coin_by_sentiment": ["coin", "sentiment_class"], "trader_by_sentiment": ["account", "sentiment_class"],
}

_ADDED = ["n", "wins", "gains", "losses", "volume", "pnl_sum", "pnl_m2", "roe_sum", "roe_m2", "active_days", "leverage_sum"]


def monthly_states(silver: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """``month, keys`` and the mergeable state of the realized trades: counts, sums, squared deviations, extremes, drawdown tuple."""
    trades, by, pnl = realized_trades(silver), ["month", *keys], F.col("closed_pnl")
    sums = trades.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum("win_flag").alias("wins"), F.sum(F.when(pnl > 0, pnl).otherwise(0.0)).alias("gains"),
        F.sum(F.when(pnl < 0, -pnl).otherwise(0.0)).alias("losses"), F.sum("size_usd").alias("volume"),
        F.sum("closed_pnl").alias("pnl_sum"), (F.var_pop("closed_pnl") * F.count("closed_pnl")).alias("pnl_m2"),
        F.sum("roe").alias("roe_sum"), (F.var_pop("roe") * F.count("roe")).alias("roe_m2"), F.countDistinct("date").alias("active_days"),
        F.sum("leverage").alias("leverage_sum"), F.min("closed_pnl").alias("worst"), F.max("closed_pnl").alias("best"))
    falls = drawdown_states(trades, by, order, {"pnl": "closed_pnl"}, "month").drop("_span").withColumnsRenamed({c: f"_k_{c}" for c in by})
    same = F.lit(True)
    for c in by:
        same = same & sums[c].eqNullSafe(falls[f"_k_{c}"])
    return sums.join(falls, same, "left").drop(*[f"_k_{c}" for c in by])


def merged(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The ledger of a group's states over any months."""
    keys = list(keys)
    mean = {x: F.sum(f"{x}_sum") / F.sum("n") for x in ("pnl", "roe")}
    # squared deviations from the common mean: inside the months, and of the months' means
    spread = {x: F.sum(F.col(f"{x}_m2") + F.col(f"{x}_sum") * F.col(f"{x}_sum") / F.col("n")) - F.sum(f"{x}_sum") * mean[x] for x in ("pnl", "roe")}
    deviation = {x: F.sqrt(F.greatest(spread[x], F.lit(0.0)) / F.nullif(F.sum("n") - 1, F.lit(0))) for x in spread}
    out = states.groupBy(*keys).agg(
        F.sum("n").alias("trade_count"), F.sum("pnl_sum").alias("total_pnl"), mean["pnl"].alias("avg_pnl"), deviation["pnl"].alias("std_pnl"),
        (F.sum("wins") / F.sum("n")).alias("win_rate"), F.sum("volume").alias("volume"), mean["roe"].alias("avg_roe"),
        deviation["roe"].alias("volatility"), F.when(F.sum("losses") > 0, F.sum("gains") / F.sum("losses")).alias("profit_factor"),
        F.sum("active_days").alias("active_days"), (F.sum("leverage_sum") / F.sum("n")).alias("avg_leverage"),
        F.min("worst").alias("worst_loss"), F.max("best").alias("best_win"))
    falls = merged_drawdowns(states.withColumn("_span", F.col("month").cast("string")), keys, ["pnl"]).withColumnsRenamed(
        {**{c: f"_k_{c}" for c in keys}, "pnl": "max_drawdown"})
    same = F.lit(True)
    for c in keys:
        same = same & out[c].eqNullSafe(falls[f"_k_{c}"])
    return out.join(falls, same).drop(*[f"_k_{c}" for c in keys])


def refresh(spark: SparkSession, silver: DataFrame, gold: str, months: Sequence[str] | None = None, ledgers: dict[str, list[str]] | None = None) -> None:
    """Store the states of ``months`` (all, if None) of every ledger and merge each ledger from its stored states.

    ``silver`` is partitioned by month, so only those months are read; their state partitions are replaced.
    """
    rows = silver if months is None else silver.where(F.col("month").isin(list(months)))
    for name, keys in (ledgers or LEDGERS).items():
        write_table(monthly_states(rows, keys), f"{gold}/states/{name}", ["month"])
        write_table(merged(spark.read.parquet(f"{gold}/states/{name}"), keys), f"{gold}/{name}")
