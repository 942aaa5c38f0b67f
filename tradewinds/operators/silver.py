"""Bronze to silver: typed fills joined with the gap-filled daily sentiment, plus derived trade columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tradewinds import vocab
from tradewinds.functions import trade as t


def parse_fill_time(df: DataFrame, text: str = "timestamp_text") -> DataFrame:
    """Add ``ts, date, hour, day_of_week, month`` from the day-first text."""
    return add_calendar(df.withColumn("ts", t.fill_time(text)))


def add_calendar(df: DataFrame, ts: str = "ts") -> DataFrame:
    c = F.col(ts)
    return df.withColumns({
        "date": F.to_date(c),
        "hour": F.hour(c),
        "day_of_week": F.date_format(c, "EEEE"),
        "month": F.date_format(c, "yyyy-MM"),
    })


def normalize_sentiment(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.to_date("date").alias("date"),
        F.col("value").cast("int").alias("sentiment_score"),
        F.col("classification").alias("sentiment_class"))


def fill_gaps(df: DataFrame, order: str, defaults: dict[str, object]) -> DataFrame:
    """Forward fill, then backward fill, then a default.

    For daily tables only: one row per calendar day, so the unpartitioned
    window is bounded by the calendar, not by the data.
    """
    back = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({
        name: F.coalesce(
            F.last(name, ignorenulls=True).over(back),
            F.last(name, ignorenulls=True).over(ahead),
            F.lit(default))
        for name, default in defaults.items()
    })


def sentiment_by_fill_day(fills: DataFrame, sentiment: DataFrame) -> DataFrame:
    """One row per day that carries fills; days without an index value borrow from neighbouring fill days."""
    days = fills.select(F.to_date("ts").alias("date")).where(F.col("date").isNotNull()).distinct()
    scored = days.join(sentiment.select(
        "date", F.col("sentiment_score").cast("double").alias("sentiment_score"), "sentiment_class"), "date", "left")
    return fill_gaps(scored, "date", {
        "sentiment_score": vocab.DEFAULT_SENTIMENT_SCORE,
        "sentiment_class": vocab.DEFAULT_SENTIMENT_CLASS,
    })


def join_sentiment(fills: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Left join on the calendar day.

    The broadcast side has one row per calendar day, a few thousand for decades
    of trading; it does not grow with the number of fills.
    """
    dated = fills if "date" in fills.columns else fills.withColumn("date", F.to_date("ts"))
    return with_days(dated, sentiment_by_fill_day(fills, sentiment))


def with_days(dated: DataFrame, days: DataFrame) -> DataFrame:
    """Fills with the columns of their day from ``sentiment_by_fill_day``."""
    return dated.join(F.broadcast(days), "date", "left").withColumns({
        "sentiment_score": F.coalesce("sentiment_score", F.lit(vocab.DEFAULT_SENTIMENT_SCORE)),
        "sentiment_class": F.coalesce("sentiment_class", F.lit(vocab.DEFAULT_SENTIMENT_CLASS)),
    })


def derive_trade_columns(df: DataFrame) -> DataFrame:
    # the uniform number gets its own projection so that the tiers below do not hash again
    out = df.withColumn("_u", t.leverage_uniform()).withColumns({
        "trade_direction": t.trade_direction("direction"),
        "leverage": t.leverage_for("_u"),
        "pnl_pct": t.pnl_pct(),
        "is_closing_trade": t.is_closing(),
        "win_flag": t.win_flag(),
    })
    return out.withColumns({
        "leverage_bucket": t.leverage_bucket("leverage"),
        "roe": F.col("pnl_pct") * F.col("leverage"),
    }).drop("_u")


def silver_trades(fills: DataFrame, sentiment: DataFrame) -> DataFrame:
    """The curated trade table every gold operator reads."""
    return derive_trade_columns(join_sentiment(add_calendar(fills), sentiment))


def stored_trades(fills: DataFrame) -> DataFrame:
    """What a stored silver table holds of every fill: all that is not read off its day or two of its numbers."""
    return derive_trade_columns(add_calendar(fills)).drop("pnl_pct", "roe")


def silver_of(trades: DataFrame, days: DataFrame) -> DataFrame:
    """The silver table from ``stored_trades`` and its ``sentiment_by_fill_day``."""
    derived = ["trade_direction", "leverage", "pnl_pct", "is_closing_trade", "win_flag", "leverage_bucket"]
    named = ["date", *[c for c in trades.columns if c not in ("date", *derived)], "sentiment_score", "sentiment_class", *derived]
    return with_days(trades, days).withColumn("pnl_pct", t.pnl_pct()).select(*named, (F.col("pnl_pct") * F.col("leverage")).alias("roe"))


# ---- filters ----------------------------------------------------------------

def realized_trades(silver: DataFrame) -> DataFrame:
    return silver.where("is_closing_trade")


def drop_unparsed_time(df: DataFrame, col: str = "ts") -> DataFrame:
    return df.dropna(subset=[col])


def filter_trades(silver: DataFrame, accounts=(), coins=(), classes=()) -> DataFrame:
    """Optional IN-lists; an empty list does not filter."""
    out = silver
    for column, values in (("account", accounts), ("coin", coins), ("sentiment_class", classes)):
        if values:
            out = out.where(F.col(column).isin(list(values)))
    return out


def active_accounts(silver: DataFrame, min_trades: int = 5) -> DataFrame:
    """Realized trades of accounts that have at least ``min_trades`` of them."""
    realized = realized_trades(silver)
    busy = realized.groupBy("account").count().where(F.col("count") >= min_trades).select("account")
    return realized.join(busy, "account", "left_semi")


# ---- display columns --------------------------------------------------------

def with_plot_columns(df: DataFrame) -> DataFrame:
    """Percent and absolute versions of whichever of these columns the table has."""
    out = df
    if "win_rate" in df.columns:
        out = out.withColumn("win_rate_pct", F.col("win_rate") * 100)
    for name in ("var_95", "var_99", "cvar_95", "cvar_99"):
        if name in df.columns:
            out = out.withColumn(f"{name}_abs", F.abs(name))
    return out
