"""Trade-table queries: projections, filters, joins, performance ledgers, marts, rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewinds import vocab
from tradewinds.functions import trade as t
from tradewinds.functions.risk import profit_factor
from tradewinds.operators import marts, performance as perf, silver as sv
from tradewinds.plans import oracle, testdata as td
from tradewinds.plans.catalog import query
from tradewinds.plans.compare import money, pnl, real, steady
from tradewinds.sources import layers

ORDER_VALUES = oracle.quoted(vocab.CLASS_ORDER)


def built_silver(spark, sf):
    return sv.silver_trades(td.fills(spark, sf), td.sentiment(spark, sf))


def silver_inputs(sf):
    return [f"{sf}/{t}.parquet" for t in ("lineitem", "orders", "part")]


def silver(spark, sf):
    """The silver table that gold reads: trades and their days, stored at first use for a state of the given tables.

    The fills are joined once; days are read off the stored trades, and join them where they are read.
    """
    trades = layers.stored(spark, "trades", silver_inputs(sf), lambda: sv.stored_trades(td.fills(spark, sf)))
    days = layers.stored(spark, "fill_days", silver_inputs(sf), lambda: sv.sentiment_by_fill_day(trades, td.sentiment(spark, sf)))
    return sv.silver_of(trades, days)


# ---- projections ------------------------------------------------------------

@query("parse_fill_time", oracle.sql(f"""
select trade_id, ts, cast(ts as date) as date, cast(hour(ts) as int) as hour, strftime(ts, '%A') as day_of_week,
       strftime(ts, '%Y-%m') as month
from (select "Trade ID" as trade_id, strptime("Timestamp IST", '%d-%m-%Y %H:%M') as ts from bronze_fills)""",
    oracle.SENTIMENT, oracle.FILLS, oracle.BRONZE))
def parse_fill_time(spark, sf):
    raw = td.bronze_fills(spark, sf).select(F.col("Trade ID").alias("trade_id"), F.col("Timestamp IST").alias("text"))
    return sv.parse_fill_time(raw, "text").drop("text").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("normalize_sentiment", oracle.sql("select date, sentiment_score, sentiment_class from fx_sentiment", oracle.SENTIMENT))
def normalize_sentiment(spark, sf):
    return sv.normalize_sentiment(td.bronze_sentiment(spark, sf))


def _silver_columns(name, columns, real_cols=()):
    body = ", ".join(f"{real(c)} as {c}" if c in real_cols else c for c in columns)

    @query(name, oracle.on_silver(f"select {body} from silver"))
    def run(spark, sf):
        return steady(built_silver(spark, sf).select(*columns), real=real_cols)

    return run


_silver_columns("trade_direction", ["trade_id", "direction", "trade_direction"])
_silver_columns("assign_leverage", ["trade_id", "size_usd", "leverage"])
_silver_columns("leverage_bucket", ["trade_id", "leverage", "leverage_bucket"])
_silver_columns("pnl_pct", ["trade_id", "pnl_pct"], ["pnl_pct"])
_silver_columns("roe", ["trade_id", "roe"], ["roe"])
_silver_columns("trade_flags", ["trade_id", "closed_pnl", "is_closing_trade", "win_flag"])
_silver_columns("silver_trades", [
    "trade_id", "account", "coin", "execution_price", "size_usd", "closed_pnl", "direction", "ts", "date", "hour",
    "day_of_week", "month", "sentiment_score", "sentiment_class", "trade_direction", "leverage", "leverage_bucket",
    "pnl_pct", "roe", "is_closing_trade", "win_flag"], ["pnl_pct", "roe"])
_silver_columns("join_sentiment", ["trade_id", "date", "sentiment_score", "sentiment_class"])


@query("fill_gaps", oracle.sql("select * from fx_days", oracle.SENTIMENT, oracle.FILLS, oracle.DAYS))
def fill_gaps(spark, sf):
    return sv.sentiment_by_fill_day(td.fills(spark, sf), td.sentiment(spark, sf))


# ---- staging and marts ------------------------------------------------------

MART_CTES = (oracle.SENTIMENT, oracle.FILLS, oracle.BRONZE, oracle.FACT)


def fact(spark, sf):
    return marts.fact_trades(
        marts.stg_fills(td.bronze_fills(spark, sf)), marts.stg_sentiment(td.bronze_sentiment(spark, sf)))


@query("stg_fills", oracle.sql("""
select "Trade ID" as trade_id, "Account" as account_address, "Coin" as token_symbol, "Execution Price" as execution_price,
       "Size USD" as size_usd, "Closed PnL" as closed_pnl, "Direction" as raw_direction, "Timestamp IST" as timestamp_ist
from bronze_fills""", *MART_CTES[:3]))
def stg_fills(spark, sf):
    return marts.stg_fills(td.bronze_fills(spark, sf))


@query("stg_sentiment", oracle.sql("""
select date as sentiment_date, value as sentiment_score, classification as sentiment_class from bronze_sentiment""",
    *MART_CTES[:3]))
def stg_sentiment(spark, sf):
    return marts.stg_sentiment(td.bronze_sentiment(spark, sf))


@query("fact_trades", oracle.sql(
    "select * replace (cast(sentiment_score as double) as sentiment_score) from fact", *MART_CTES))
def fact_trades(spark, sf):
    # days without an index value stay NULL; as double both engines show that alike
    return fact(spark, sf).withColumn("sentiment_score", F.col("sentiment_score").cast("double"))


@query("dim_traders", oracle.sql(f"""
select account_address, count(trade_id) as total_trades, cast(sum(is_closing_trade) as bigint) as realized_trades,
       {pnl('sum(closed_pnl)')} as total_realized_pnl,
       {real('avg(closed_pnl) filter (where closed_pnl <> 0)')} as avg_pnl_per_trade,
       {real('avg(size_usd)')} as avg_position_size,
       {real('count(*) filter (where closed_pnl > 0) / nullif(count(*) filter (where closed_pnl <> 0), 0)')} as win_rate,
       {real('coalesce(sum(closed_pnl) filter (where closed_pnl > 0), 0) / -sum(closed_pnl) filter (where closed_pnl < 0)')} as profit_factor
from fact group by account_address""", *MART_CTES))
def dim_traders(spark, sf):
    return steady(marts.dim_traders(fact(spark, sf)), pnl=["total_realized_pnl"],
                  real=["avg_pnl_per_trade", "avg_position_size", "win_rate", "profit_factor"])


@query("dim_coins", oracle.sql(f"""
select token_symbol, count(trade_id) as total_trades, {pnl('sum(closed_pnl)')} as total_realized_pnl,
       {real('avg(execution_price)')} as avg_execution_price, {real('avg(size_usd)')} as avg_trade_size,
       {real('count(*) filter (where closed_pnl > 0) / nullif(count(*) filter (where closed_pnl <> 0), 0)')} as win_rate
from fact group by token_symbol""", *MART_CTES))
def dim_coins(spark, sf):
    return steady(marts.dim_coins(fact(spark, sf)), pnl=["total_realized_pnl"],
                  real=["avg_execution_price", "avg_trade_size", "win_rate"])


# ---- filters ----------------------------------------------------------------

FILL_COLUMNS = ["trade_id", "account", "coin", "size_usd", "closed_pnl", "ts"]


@query("realized_trades", oracle.on_silver(f"select {', '.join(FILL_COLUMNS)} from realized"))
def realized_trades(spark, sf):
    return sv.realized_trades(silver(spark, sf)).select(*FILL_COLUMNS)


@query("filter_trades", oracle.on_silver(f"""
select {', '.join(FILL_COLUMNS)}, sentiment_class from silver
where account in ('acct_1', 'acct_2', 'acct_77') and sentiment_class in ('Fear', 'Greed')"""))
def filter_trades(spark, sf):
    return sv.filter_trades(silver(spark, sf), accounts=["acct_1", "acct_2", "acct_77"], classes=["Fear", "Greed"]).select(
        *FILL_COLUMNS, "sentiment_class")


@query("drop_unparsed_time", oracle.sql("""
select "Trade ID" as trade_id, strptime("Timestamp IST", '%d-%m-%Y %H:%M') as ts from bronze_fills
where "Direction" <> 'Settlement'""", oracle.SENTIMENT, oracle.FILLS, oracle.BRONZE))
def drop_unparsed_time(spark, sf):
    # settlement rows get a time text in another format, so they fail to parse and are dropped
    text = F.when(F.col("Direction") == "Settlement", F.lit("n/a")).otherwise(F.col("Timestamp IST"))
    raw = td.bronze_fills(spark, sf).select(F.col("Trade ID").alias("trade_id"), t.fill_time(text).alias("ts"))
    return sv.drop_unparsed_time(raw).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("active_accounts", oracle.on_silver("""
select trade_id, account, ts, closed_pnl from realized
where account in (select account from realized group by account having count(*) >= 180)"""))
def active_accounts(spark, sf):
    return sv.active_accounts(silver(spark, sf), 180).select("trade_id", "account", "ts", "closed_pnl")


# ---- performance ledgers ----------------------------------------------------

PF_SQL = real("""case when coalesce(sum(case when closed_pnl < 0 then -closed_pnl end), 0) > 0
 then sum(case when closed_pnl > 0 then closed_pnl else 0 end) / sum(case when closed_pnl < 0 then -closed_pnl end)
 when coalesce(sum(case when closed_pnl > 0 then closed_pnl end), 0) = 0 then 'nan'::double else 'inf'::double end""")
BASIC_SQL = f"""{pnl('sum(closed_pnl)')} as total_pnl, {real('avg(closed_pnl)')} as avg_pnl,
 {real('avg(win_flag)')} as win_rate, count(closed_pnl) as trade_count"""
TRADER_SQL = f"""{BASIC_SQL}, {real('avg(leverage)')} as avg_leverage, {real('avg(size_usd)')} as avg_trade_size,
 {PF_SQL} as profit_factor"""


@query("profit_factor", oracle.on_silver(f"select coin, {PF_SQL} as profit_factor from realized group by coin"))
def profit_factor_query(spark, sf):
    realized = sv.realized_trades(silver(spark, sf))
    return steady(realized.groupBy("coin").agg(profit_factor().alias("profit_factor")), real=["profit_factor"])


@query("sentiment_performance", oracle.on_silver(f"""
select sentiment_class, {BASIC_SQL}, {real('stddev_samp(closed_pnl)')} as std_pnl, {money('sum(size_usd)')} as total_volume,
       {real('avg(size_usd)')} as avg_volume, {real('avg(roe)')} as avg_roe, {PF_SQL} as profit_factor,
       {real('quantile_cont(closed_pnl, 0.5)')} as median_pnl
from realized group by sentiment_class"""))
def sentiment_performance(spark, sf):
    return steady(perf.sentiment_performance(silver(spark, sf)), pnl=["total_pnl"], money=["total_volume"],
                  real=["avg_pnl", "std_pnl", "win_rate", "avg_volume", "avg_roe", "profit_factor", "median_pnl"])


@query("leverage_by_sentiment", oracle.on_silver(f"""
select sentiment_class, {real('avg(leverage)')} as avg_leverage, {real('quantile_cont(leverage, 0.5)')} as median_leverage,
       max(leverage) as max_leverage, count(leverage) as total_trades
from silver group by sentiment_class"""))
def leverage_by_sentiment(spark, sf):
    return steady(perf.leverage_by_sentiment(silver(spark, sf)), real=["avg_leverage", "median_leverage"])


@query("leverage_distribution", oracle.on_silver(
    "select sentiment_class, " + ", ".join(
        real(f"count(*) filter (leverage_bucket = '{b}') * 100e0 / count(*)") + f' as "{b}"' for b in vocab.BUCKET_LABELS)
    + " from silver group by sentiment_class"))
def leverage_distribution(spark, sf):
    return steady(perf.leverage_distribution(silver(spark, sf)), real=vocab.BUCKET_LABELS)


@query("frequency_sizing", oracle.on_silver(f"""
select sentiment_class, count(trade_id) as total_trades, {money('sum(size_usd)')} as total_volume,
       {real('avg(size_usd)')} as avg_trade_size, {real('quantile_cont(size_usd, 0.5)')} as median_trade_size,
       count(distinct date) as unique_days, {real('count(trade_id) * 1e0 / count(distinct date)')} as avg_trades_per_day,
       {real('sum(size_usd) / count(distinct date)')} as avg_volume_per_day
from silver group by sentiment_class"""))
def frequency_sizing(spark, sf):
    return steady(perf.frequency_sizing(silver(spark, sf)), money=["total_volume"],
                  real=["avg_trade_size", "median_trade_size", "avg_trades_per_day", "avg_volume_per_day"])


@query("coin_by_sentiment", oracle.on_silver(f"""
select coin, sentiment_class, {BASIC_SQL}, {money('sum(size_usd)')} as volume from realized group by coin, sentiment_class"""))
def coin_by_sentiment(spark, sf):
    return steady(perf.coin_by_sentiment(silver(spark, sf)), pnl=["total_pnl"], money=["volume"], real=["avg_pnl", "win_rate"])


@query("coin_overall", oracle.on_silver(f"""
select coin, {BASIC_SQL}, {money('sum(size_usd)')} as volume, {PF_SQL} as profit_factor from realized group by coin"""))
def coin_overall(spark, sf):
    return steady(perf.coin_overall(silver(spark, sf)), pnl=["total_pnl"], money=["volume"],
                  real=["avg_pnl", "win_rate", "profit_factor"])


@query("leverage_binned", oracle.on_silver(f"""
select leverage_bucket, {BASIC_SQL}, {real('avg(roe)')} as avg_roe, {real('quantile_cont(closed_pnl, 0.5)')} as median_pnl
from realized group by leverage_bucket"""))
def leverage_binned(spark, sf):
    return steady(perf.leverage_binned(silver(spark, sf)), pnl=["total_pnl"],
                  real=["avg_pnl", "win_rate", "avg_roe", "median_pnl"])


@query("trader_by_sentiment", oracle.on_silver(f"""
select account, sentiment_class, {TRADER_SQL} from realized group by account, sentiment_class"""))
def trader_by_sentiment(spark, sf):
    return steady(perf.trader_by_sentiment(silver(spark, sf)), pnl=["total_pnl"],
                  real=["avg_pnl", "win_rate", "avg_leverage", "avg_trade_size", "profit_factor"])


@query("trader_overall", oracle.on_silver(f"select account, {TRADER_SQL} from realized group by account"))
def trader_overall(spark, sf):
    return steady(perf.trader_overall(silver(spark, sf)), pnl=["total_pnl"],
                  real=["avg_pnl", "win_rate", "avg_leverage", "avg_trade_size", "profit_factor"])


CORR_SQL = ", ".join(f"{real(f'corr(leverage, {c})')} as corr_leverage_{n}" for c, n in
                     (("closed_pnl", "pnl"), ("roe", "roe"), ("pnl_pct", "pnl_pct")))


@query("leverage_correlation", oracle.on_silver(f"""
select 'Overall' as scope, {CORR_SQL}, count(*) as sample_size from realized
union all
select sentiment_class, {CORR_SQL}, count(*) from realized group by sentiment_class having count(*) > 5"""))
def leverage_correlation(spark, sf):
    return steady(perf.leverage_correlation(silver(spark, sf)),
                  real=["corr_leverage_pnl", "corr_leverage_roe", "corr_leverage_pnl_pct"])


KPI_FILTER = "coin in ('Brand#11', 'Brand#12', 'Brand#23', 'Brand#34')"


@query("kpi_summary", oracle.on_silver(f"""
select {pnl('sum(closed_pnl) filter (is_closing_trade)')} as total_pnl,
       {real('avg(win_flag) filter (is_closing_trade) * 100')} as win_rate_pct,
       {real('sum(case when closed_pnl > 0 then closed_pnl else 0 end) / nullif(sum(case when closed_pnl < 0 then -closed_pnl else 0 end), 0)')} as profit_factor,
       {money('sum(size_usd) filter (is_closing_trade)')} as total_volume, {real('avg(leverage)')} as avg_leverage,
       count(*) filter (is_closing_trade) as total_trades
from silver where {KPI_FILTER}"""))
def kpi_summary(spark, sf):
    chosen = sv.filter_trades(silver(spark, sf), coins=["Brand#11", "Brand#12", "Brand#23", "Brand#34"])
    return steady(perf.kpi_summary(chosen), pnl=["total_pnl"], money=["total_volume"],
                  real=["win_rate_pct", "profit_factor", "avg_leverage"])


@query("dataset_summary", oracle.on_silver("""
select 'total' as item, 'rows' as value, count(*) as n from silver
union all select 'total', 'accounts', count(distinct account) from silver
union all select 'total', 'coins', count(distinct coin) from silver
union all select 'leverage_bucket', leverage_bucket, count(*) from silver group by leverage_bucket
union all select 'trade_direction', trade_direction, count(*) from silver group by trade_direction
union all select 'is_closing_trade', cast(is_closing_trade as varchar), count(*) from silver group by is_closing_trade"""))
def dataset_summary(spark, sf):
    return perf.dataset_summary(silver(spark, sf))


@query("distinct_coins", oracle.on_silver("select distinct coin from silver"))
def distinct_coins(spark, sf):
    return perf.distinct_values(silver(spark, sf), "coin")


@query("plot_columns", oracle.on_silver(f"""
select coin, {real('avg(win_flag)')} as win_rate, {real('avg(win_flag) * 100')} as win_rate_pct from realized group by coin"""))
def plot_columns(spark, sf):
    wins = sv.realized_trades(silver(spark, sf)).groupBy("coin").agg(F.avg("win_flag").alias("win_rate"))
    return steady(sv.with_plot_columns(wins), real=["win_rate", "win_rate_pct"])


# ---- sort and top-k ---------------------------------------------------------

@query("order_by_class", oracle.on_silver("select sentiment_class, count(*) as trades from silver group by sentiment_class"))
def order_by_class(spark, sf):
    counts = silver(spark, sf).groupBy("sentiment_class").agg(F.count(F.lit(1)).alias("trades"))
    return perf.order_by_class(counts)


LOSS_COLUMNS = ("account, coin, execution_price, size_usd, ts, direction, closed_pnl, leverage, leverage_bucket, "
                "sentiment_class, sentiment_score")


@query("extreme_losses", oracle.on_silver(
    f"select {LOSS_COLUMNS} from realized order by closed_pnl, fill_seq limit 20"))
def extreme_losses(spark, sf):
    return perf.extreme_losses(silver(spark, sf))
