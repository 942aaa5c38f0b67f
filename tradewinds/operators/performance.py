"""Grouped performance ledgers over the silver table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tradewinds import vocab
from tradewinds.functions.risk import correlation, profit_factor
from tradewinds.functions.trade import class_rank
from tradewinds.operators.percentiles import agg_with_percentiles
from tradewinds.operators.silver import realized_trades


def order_by_class(df: DataFrame, col: str = "sentiment_class", order: Sequence[str] | None = None) -> DataFrame:
    return df.orderBy(class_rank(col, order))


def sentiment_performance(silver: DataFrame) -> DataFrame:
    out = agg_with_percentiles(
        realized_trades(silver), ["sentiment_class"],
        [
            F.sum("closed_pnl").alias("total_pnl"),
            F.avg("closed_pnl").alias("avg_pnl"),
            F.stddev_samp("closed_pnl").alias("std_pnl"),
            F.avg("win_flag").alias("win_rate"),
            F.sum("size_usd").alias("total_volume"),
            F.avg("size_usd").alias("avg_volume"),
            F.avg("roe").alias("avg_roe"),
            F.count("closed_pnl").alias("trade_count"),
            profit_factor().alias("profit_factor"),
        ],
        {"median_pnl": ("closed_pnl", 0.5)})
    return order_by_class(out)


def leverage_by_sentiment(silver: DataFrame) -> DataFrame:
    out = agg_with_percentiles(
        silver, ["sentiment_class"],
        [
            F.avg("leverage").alias("avg_leverage"),
            F.max("leverage").alias("max_leverage"),
            F.count("leverage").alias("total_trades"),
        ],
        {"median_leverage": ("leverage", 0.5)})
    return order_by_class(out)


def leverage_distribution(silver: DataFrame) -> DataFrame:
    """Row percentages of leverage buckets per class, 0 where a bucket is empty."""
    counts = silver.groupBy("sentiment_class").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col("leverage_bucket") == label).alias(label) for label in vocab.BUCKET_LABELS])
    share = counts.select("sentiment_class", *[
        (F.col(f"`{label}`") / F.col("_rows") * 100).alias(label) for label in vocab.BUCKET_LABELS])
    return order_by_class(share)


def frequency_sizing(silver: DataFrame) -> DataFrame:
    # a set of days is bounded by the calendar and combines map-side, whereas a
    # distinct count would shuffle partial rows by (class, date)
    out = agg_with_percentiles(
        silver, ["sentiment_class"],
        [
            F.count("trade_id").alias("total_trades"),
            F.sum("size_usd").alias("total_volume"),
            F.avg("size_usd").alias("avg_trade_size"),
            F.size(F.collect_set("date")).cast("bigint").alias("unique_days"),
        ],
        {"median_trade_size": ("size_usd", 0.5)})
    rated = out.withColumns({
        "avg_trades_per_day": F.try_divide("total_trades", "unique_days"),
        "avg_volume_per_day": F.try_divide("total_volume", "unique_days"),
    })
    return order_by_class(rated)


def coin_by_sentiment(silver: DataFrame) -> DataFrame:
    return realized_trades(silver).groupBy("coin", "sentiment_class").agg(
        F.sum("closed_pnl").alias("total_pnl"),
        F.avg("closed_pnl").alias("avg_pnl"),
        F.avg("win_flag").alias("win_rate"),
        F.count("closed_pnl").alias("trade_count"),
        F.sum("size_usd").alias("volume"))


def coin_overall(silver: DataFrame) -> DataFrame:
    return realized_trades(silver).groupBy("coin").agg(
        F.sum("closed_pnl").alias("total_pnl"),
        F.avg("closed_pnl").alias("avg_pnl"),
        F.avg("win_flag").alias("win_rate"),
        F.count("closed_pnl").alias("trade_count"),
        F.sum("size_usd").alias("volume"),
        profit_factor().alias("profit_factor"),
    ).orderBy(F.desc("total_pnl"), "coin")


def leverage_binned(silver: DataFrame) -> DataFrame:
    return agg_with_percentiles(
        realized_trades(silver), ["leverage_bucket"],
        [
            F.avg("closed_pnl").alias("avg_pnl"),
            F.avg("roe").alias("avg_roe"),
            F.avg("win_flag").alias("win_rate"),
            F.sum("closed_pnl").alias("total_pnl"),
            F.count("closed_pnl").alias("trade_count"),
        ],
        {"median_pnl": ("closed_pnl", 0.5)})


def trader_aggs() -> list:
    return [
        F.sum("closed_pnl").alias("total_pnl"),
        F.avg("closed_pnl").alias("avg_pnl"),
        F.avg("win_flag").alias("win_rate"),
        F.avg("leverage").alias("avg_leverage"),
        F.avg("size_usd").alias("avg_trade_size"),
        F.count("closed_pnl").alias("trade_count"),
        profit_factor().alias("profit_factor"),
    ]


def trader_by_sentiment(silver: DataFrame) -> DataFrame:
    return realized_trades(silver).groupBy("account", "sentiment_class").agg(*trader_aggs())


def trader_overall(silver: DataFrame) -> DataFrame:
    return realized_trades(silver).groupBy("account").agg(*trader_aggs()).orderBy(F.desc("total_pnl"), "account")


def leverage_correlation(silver: DataFrame, min_rows: int = 5) -> DataFrame:
    """Pearson correlations overall and per class with more than ``min_rows`` trades."""
    out = realized_trades(silver).groupingSets([[], ["sentiment_class"]], "sentiment_class").agg(
        F.grouping_id().alias("_level"),
        correlation("leverage", "closed_pnl").alias("corr_leverage_pnl"),
        correlation("leverage", "roe").alias("corr_leverage_roe"),
        correlation("leverage", "pnl_pct").alias("corr_leverage_pnl_pct"),
        F.count(F.lit(1)).alias("sample_size"))
    scope = F.when(F.col("_level") == 1, "Overall").otherwise(F.col("sentiment_class"))
    return (
        out.where((F.col("_level") == 1) | (F.col("sample_size") > min_rows))
        .withColumn("scope", scope)
        .orderBy(class_rank("scope", ["Overall", *vocab.CLASS_ORDER]))
        .select("scope", "corr_leverage_pnl", "corr_leverage_roe", "corr_leverage_pnl_pct", "sample_size"))


def kpi_summary(filtered: DataFrame) -> DataFrame:
    """One row of headline numbers; leverage is averaged over all filtered rows, the rest over realized ones."""
    closing = F.col("is_closing_trade")
    pnl = F.when(closing, F.col("closed_pnl"))
    return filtered.agg(
        F.coalesce(F.sum(pnl), F.lit(0.0)).alias("total_pnl"),
        F.coalesce(F.avg(F.when(closing, F.col("win_flag"))) * 100, F.lit(0.0)).alias("win_rate_pct"),
        profit_factor(pnl, no_loss="nan").alias("profit_factor"),
        F.coalesce(F.sum(F.when(closing, F.col("size_usd"))), F.lit(0.0)).alias("total_volume"),
        F.avg("leverage").alias("avg_leverage"),
        F.count_if(closing).alias("total_trades"))


def dataset_summary(silver: DataFrame) -> DataFrame:
    """Long table of row, account and coin counts and of the value counts of three columns."""
    totals = silver.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("account").alias("accounts"),
        F.count_distinct("coin").alias("coins"),
    ).unpivot([], ["rows", "accounts", "coins"], "value", "n").select(F.lit("total").alias("item"), "value", "n")
    cube = silver.groupBy("leverage_bucket", "trade_direction", "is_closing_trade").agg(F.count(F.lit(1)).alias("n"))
    parts = [
        cube.groupBy(F.col(c).cast("string").alias("value")).agg(F.sum("n").alias("n"))
        .select(F.lit(c).alias("item"), "value", "n")
        for c in ("leverage_bucket", "trade_direction", "is_closing_trade")]
    for part in parts:
        totals = totals.unionByName(part)
    return totals


def distinct_values(silver: DataFrame, col: str) -> DataFrame:
    """Sorted choices for a filter list, as rows."""
    return silver.select(col).distinct().orderBy(col)


def extreme_losses(silver: DataFrame, n: int = 20) -> DataFrame:
    return realized_trades(silver).orderBy("closed_pnl", "fill_seq").limit(n).select(
        "account", "coin", "execution_price", "size_usd", "ts", "direction", "closed_pnl",
        "leverage", "leverage_bucket", "sentiment_class", "sentiment_score")
