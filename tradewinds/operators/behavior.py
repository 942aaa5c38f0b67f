"""Behavioural-bias flags, risk score and archetype per account."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewinds.operators.ordered import BLOCK_ROWS, ORDER, bounded_frame
from tradewinds.operators.silver import drop_unparsed_time, realized_trades

GREED_ABOVE, FEAR_BELOW = 55, 40
BIASES = ["fomo_bias", "panic_bias", "overconfidence_bias", "loss_chasing_bias"]


def trade_sequence(realized: DataFrame, streak: int = 3, order: Sequence[str] = ORDER,
                   rows: int = BLOCK_ROWS) -> DataFrame:
    """Add the account's next trade (size, leverage, time) and whether a winning streak ends here.

    A streak of at least ``streak`` wins up to a row means the last ``streak``
    rows are all wins, so a bounded frame replaces the running counter.
    """

    def compute(trades: DataFrame, part: list[str]) -> DataFrame:
        spec = Window.partitionBy(*part).orderBy(*order)
        wins = F.sum("win_flag").over(spec.rowsBetween(-(streak - 1), 0))
        return trades.withColumns({
            "next_size_usd": F.lead("size_usd").over(spec),
            "next_leverage": F.lead("leverage").over(spec),
            "next_ts": F.lead("ts").over(spec),
            "on_streak": F.coalesce(wins == streak, F.lit(False)),
        })

    return bounded_frame(realized, ["account"], order, max(1, streak - 1), compute, rows)


def loss_chased() -> Column:
    """A loss followed within 24 hours by a clearly larger or more leveraged trade."""
    soon = F.col("next_ts") <= F.col("ts") + F.expr("interval 24 hours")
    bigger = (F.col("next_size_usd") > F.col("size_usd") * 1.2) | (F.col("next_leverage") > F.col("leverage"))
    return F.coalesce((F.col("win_flag") == 0) & soon & bigger, F.lit(False))


def account_profile(sequence: DataFrame, min_trades: int = 5) -> DataFrame:
    """One row per account with every number the flags need; partial aggregation, no join back.

    "Some next trade after a streak exceeds 1.25 times the mean" is the same as
    "the largest next trade after a streak does", so the mean is only needed
    after the aggregation.
    """
    pnl = F.col("closed_pnl")
    greed, fear = F.col("sentiment_score") > GREED_ABOVE, F.col("sentiment_score") < FEAR_BELOW
    return sequence.groupBy("account").agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.avg("leverage").alias("avg_leverage"),
        F.avg("size_usd").alias("avg_trade_size"),
        F.sum("closed_pnl").alias("total_realized_pnl"),
        F.avg("win_flag").alias("win_rate"),
        F.coalesce(F.sum(F.when(pnl > 0, pnl)), F.lit(0.0)).alias("gains"),
        F.coalesce(F.sum(F.when(pnl < 0, -pnl)), F.lit(0.0)).alias("losses"),
        F.coalesce(F.abs(F.avg(F.when(pnl < 0, pnl))), F.lit(10.0)).alias("avg_loss"),
        F.count_if(greed).alias("greed_trades"),
        F.avg(F.when(greed, F.col("leverage"))).alias("greed_leverage"),
        F.avg(F.when(greed, F.col("size_usd"))).alias("greed_size"),
        F.count_if(fear).alias("fear_trades"),
        F.avg(F.when(fear, F.col("win_flag"))).alias("fear_win_rate"),
        F.coalesce(F.abs(F.avg(F.when(fear & (pnl < 0), pnl))), F.lit(0.0)).alias("fear_avg_loss"),
        F.max(F.when(F.col("on_streak"), F.col("next_size_usd"))).alias("streak_next_size"),
        F.max(F.when(F.col("on_streak"), F.col("next_leverage"))).alias("streak_next_leverage"),
        F.max(loss_chased().cast("int")).alias("loss_chasing_bias"),
    ).where(F.col("trade_count") >= min_trades)


def _exceeds(value: str, base: str, factor: float) -> Column:
    return F.coalesce(F.try_divide(F.col(value), F.col(base)) > factor, F.lit(False))


def fomo_bias() -> Column:
    larger = _exceeds("greed_leverage", "avg_leverage", 1.2) | _exceeds("greed_size", "avg_trade_size", 1.2)
    return F.when((F.col("greed_trades") > 2) & larger, 1).otherwise(0)


def panic_bias() -> Column:
    worse = (F.col("fear_win_rate") < 0.35) & _exceeds("fear_avg_loss", "avg_loss", 1.2)
    return F.when((F.col("fear_trades") > 2) & worse, 1).otherwise(0)


def overconfidence_bias() -> Column:
    scaled_up = (_exceeds("streak_next_size", "avg_trade_size", 1.25)
                 | _exceeds("streak_next_leverage", "avg_leverage", 1.25))
    return F.when(scaled_up, 1).otherwise(0)


def behavioral_risk_score() -> Column:
    score = (10.0 + 15.0 * F.col("fomo_bias") + 25.0 * F.col("panic_bias")
             + 30.0 * F.col("overconfidence_bias") + 30.0 * F.col("loss_chasing_bias"))
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), score))


def trader_archetype() -> Column:
    factor = F.when(F.col("losses") > 0, F.col("gains") / F.col("losses")).otherwise(1.0)
    total = F.col("total_realized_pnl")
    return (
        F.when((F.col("avg_leverage") <= 3.0) & (factor >= 1.8), "Institutional Trader")
        .when((F.col("avg_leverage") >= 15.0) & (total < 0), "High-Leverage Speculator")
        .when((F.col("fomo_bias") == 1) & (total > 0), "Momentum Chaser")
        .when((F.col("panic_bias") == 1) & (F.col("win_rate") < 0.40), "Fear-Driven Trader")
        .when((F.col("fear_trades") > F.col("trade_count") * 0.4) & (factor >= 1.5), "Contrarian Trader")
        .otherwise("Systematic Trader")
    )


def trader_personas(silver: DataFrame, min_trades: int = 5, order: Sequence[str] = ORDER,
                    rows: int = BLOCK_ROWS) -> DataFrame:
    """Flags, score and archetype of every account with enough realized trades."""
    trades = drop_unparsed_time(realized_trades(silver)).select(
        "account", *order, "closed_pnl", "size_usd", "leverage", "sentiment_score", "win_flag")
    profile = account_profile(trade_sequence(trades, order=order, rows=rows), min_trades)
    flagged = profile.withColumns({
        "fomo_bias": fomo_bias(), "panic_bias": panic_bias(), "overconfidence_bias": overconfidence_bias()})
    scored = flagged.withColumn("behavioral_risk_score", behavioral_risk_score())
    return scored.withColumn("trader_archetype", trader_archetype()).select(
        "account", *BIASES, "behavioral_risk_score", "trader_archetype", "total_realized_pnl", "win_rate",
        "avg_leverage", "avg_trade_size", "trade_count")


# ---- tables derived from the personas ---------------------------------------

def behavioral_insights(personas: DataFrame) -> DataFrame:
    return personas.select("account", *BIASES, "behavioral_risk_score", "trader_archetype")


def persona_ledger(personas: DataFrame) -> DataFrame:
    return personas.select("account", "trader_archetype", "behavioral_risk_score", "total_realized_pnl", "win_rate",
                           "avg_leverage", "avg_trade_size", "trade_count")


def risk_ranking(personas: DataFrame, n: int | None = None) -> DataFrame:
    ranked = personas.select("account", "behavioral_risk_score", "trader_archetype", "win_rate").orderBy(
        F.desc("behavioral_risk_score"), "account")
    return ranked.limit(n) if n else ranked


def archetype_summary(personas: DataFrame) -> DataFrame:
    return personas.groupBy("trader_archetype").agg(
        F.count(F.lit(1)).alias("accounts"), F.avg("total_realized_pnl").alias("avg_realized_pnl"))


def bias_prevalence(personas: DataFrame) -> DataFrame:
    """Flagged accounts per bias beside the number of accounts; biases nobody shows are 0."""
    melted = personas.unpivot([], BIASES, "bias_type", "flag")
    return melted.groupBy("bias_type").agg(
        F.count_if(F.col("flag") == 1).alias("flagged_accounts"), F.count(F.lit(1)).alias("accounts"))
