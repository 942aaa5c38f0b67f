"""Staging projections, the fact table and two dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradewinds.functions.risk import profit_factor

from tradewinds.functions.trade import fill_time


def stg_fills(bronze: DataFrame) -> DataFrame:
    """Typed staging view; dirty text becomes NULL, the id is 64-bit."""
    typed = lambda name, kind: F.col(f"`{name}`").try_cast(kind)
    return bronze.select(
        typed("Trade ID", "bigint").alias("trade_id"),
        typed("Account", "string").alias("account_address"),
        typed("Coin", "string").alias("token_symbol"),
        typed("Execution Price", "double").alias("execution_price"),
        typed("Size USD", "double").alias("size_usd"),
        typed("Closed PnL", "double").alias("closed_pnl"),
        typed("Direction", "string").alias("raw_direction"),
        typed("Timestamp IST", "string").alias("timestamp_ist"))


def stg_sentiment(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("date").try_cast("date").alias("sentiment_date"),
        F.col("value").try_cast("int").alias("sentiment_score"),
        F.col("classification").try_cast("string").alias("sentiment_class"))


def fact_trades(fills: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Fills left-joined with the day's sentiment, without gap filling.

    The sentiment side has one row per calendar day, so it is broadcast.
    """
    day = F.to_date(fill_time("timestamp_ist"))
    joined = fills.withColumn("_day", day).join(
        F.broadcast(sentiment), F.col("_day") == F.col("sentiment_date"), "left")
    pnl = F.col("closed_pnl")
    return joined.select(
        *fills.columns, "sentiment_score", "sentiment_class",
        F.when(pnl > 0, 1).otherwise(0).alias("is_win"),
        F.when(pnl != 0, 1).otherwise(0).alias("is_closing_trade"))


def dim_traders(fact: DataFrame) -> DataFrame:
    """Totals of every account; rates of an account without realized trades or losses are NULL."""
    base = fact.groupBy("account_address").agg(
        F.count("trade_id").alias("total_trades"), F.count_if(F.col("is_closing_trade") == 1).alias("realized_trades"),
        F.sum("closed_pnl").alias("total_realized_pnl"), F.avg("size_usd").alias("avg_position_size"),
        F.count_if(F.col("is_win") == 1).alias("_wins"), profit_factor(no_loss="null").alias("profit_factor"))
    # a trade that is not realized has no profit or loss, so the total is that of the realized ones
    return base.select(
        "account_address", "total_trades", "realized_trades", "total_realized_pnl",
        F.try_divide("total_realized_pnl", "realized_trades").alias("avg_pnl_per_trade"), "avg_position_size",
        F.try_divide(F.col("_wins").cast("double"), F.col("realized_trades")).alias("win_rate"), "profit_factor")


def dim_coins(fact: DataFrame) -> DataFrame:
    return fact.groupBy("token_symbol").agg(
        F.count("trade_id").alias("total_trades"),
        F.sum("closed_pnl").alias("total_realized_pnl"),
        F.avg("execution_price").alias("avg_execution_price"),
        F.avg("size_usd").alias("avg_trade_size"),
        F.try_divide(F.count_if(F.col("is_win") == 1).cast("double"), F.count_if(F.col("is_closing_trade") == 1)).alias("win_rate"))
