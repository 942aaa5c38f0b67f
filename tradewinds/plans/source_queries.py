"""Source and sink queries: the given tables are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewinds.operators import marts
from tradewinds.plans import oracle, testdata as td
from tradewinds.plans.catalog import query
from tradewinds.plans.compare import real, steady
from tradewinds.plans.trade_queries import silver
from tradewinds.session import scratch_path
from tradewinds.sources import readers, writers


@query("read_fills", oracle.sql("""
select account, coin, execution_price, size_usd, date_trunc('minute', ts) as ts, direction, closed_pnl, trade_id from fx_fills""",
    oracle.FILLS))
def read_fills(spark, sf):
    path = scratch_path(spark, "fills-csv")
    writers.write_ledger(td.bronze_fills(spark, sf).select(
        "Trade ID", F.lit("3.0").alias("Size Tokens"), "Size USD", "Account", "Closed PnL", "Coin", "Execution Price", "Timestamp IST", "Direction"), path)
    return readers.read_fills(spark, path).drop("fill_seq").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("read_sentiment", oracle.sql("select date, sentiment_score, sentiment_class from fx_sentiment", oracle.SENTIMENT))
def read_sentiment(spark, sf):
    path = scratch_path(spark, "sentiment-csv")
    writers.write_ledger(td.bronze_sentiment(spark, sf).select("classification", F.lit(1).alias("timestamp"), "value", "date"), path)
    return readers.read_sentiment(spark, path)


ARTICLES_SQL = oracle.sql("""
select cast(article_id as varchar) as article_id, title, content, source, author,
       strftime(published_date, '%Y-%m-%dT%H:%M:%SZ') as published_date from fx_articles""", oracle.ARTICLES)


def raw_articles(spark, sf):
    return td.articles(spark, sf).withColumns({
        "article_id": F.col("article_id").cast("string"),
        "published_date": F.date_format("published_date", "yyyy-MM-dd'T'HH:mm:ss'Z'")})


@query("read_articles", ARTICLES_SQL)
def read_articles(spark, sf):
    path = scratch_path(spark, "articles-json")
    writers.write_articles(raw_articles(spark, sf), path)
    return readers.read_articles(spark, path, multi_line=False).drop("url")


@query("read_article_files", ARTICLES_SQL)
def read_article_files(spark, sf):
    """Objects over many lines, a few hundred to a file."""
    path = scratch_path(spark, "articles-files")
    docs = raw_articles(spark, sf)
    bundles = docs.groupBy(F.expr("cast(article_id as bigint) div 250").alias("bundle")).agg(
        F.to_json(F.collect_list(F.struct(*docs.columns)), {"pretty": "true"}).alias("value"))
    bundles.repartition("bundle").write.partitionBy("bundle").text(path)
    return readers.read_articles(spark, path).drop("url", "bundle")


@query("read_silver", oracle.on_silver(f"""
select month, count(*) as trades, {real('avg(roe)')} as avg_roe from silver group by month"""))
def read_silver(spark, sf):
    path = scratch_path(spark, "silver")
    writers.write_table(silver(spark, sf), path, ["month"])
    months = readers.read_silver(spark, path).groupBy(F.col("month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("trades"), F.avg("roe").alias("avg_roe"))
    return steady(months, real=["avg_roe"])


@query("write_ledger", oracle.sql(
    "select token_symbol, count(*) as total_trades from fact group by token_symbol",
    oracle.SENTIMENT, oracle.FILLS, oracle.BRONZE, oracle.FACT))
def write_ledger(spark, sf):
    path = scratch_path(spark, "coins-csv")
    fact = marts.fact_trades(marts.stg_fills(td.bronze_fills(spark, sf)), marts.stg_sentiment(td.bronze_sentiment(spark, sf)))
    writers.write_ledger(marts.dim_coins(fact).select("token_symbol", "total_trades"), path)
    return spark.read.schema("token_symbol string, total_trades bigint").option("header", True).csv(path)
