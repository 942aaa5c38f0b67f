"""Views of the given tables in this library's domain: fills, sentiment, articles, dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# small stand-in dictionaries: the invented prose holds none of the domain words
LEXICON = {"en": 1.0, "er": 0.5, "re": -0.5, "th": -1.0, "tion": 1.0, "ha": 0.5, "nd": -0.5, "ea": -1.0}
ENTITIES = [
    ("the", "The Token", "Coin"),
    ("an", "An Exchange", "Exchange"),
    ("on", "On Office", "Regulator"),
    ("on", "On Office", "Institution"),
    ("la", "La Land", "Country"),
]
CREDIBILITY = {"src0": 95.0, "src1": 90.0, "src2": 85.0, "src3": 80.0}
KEYWORDS = {"en": 1.0, "tion": 0.8, "ble": 0.5}
THEMES = {
    "Alpha": ["en", "er", "th"],
    "Beta": ["th", "re", "tion"],
    "Gamma": ["la", "nd", "ha", "ea"],
}
IMPORTANCES = {"leverage": 0.2, "size_usd": 0.3, "sentiment_score": 0.25, "hour": 0.1, "is_long": 0.05}


WIDE_TABLES = ("lineitem", "documents")
_OPENED: dict[tuple[SparkSession, str], DataFrame] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Open a table once per session, so that its footer is read once; the rows stay lazy.

    A large table stored in fewer splits than there are cores would be read and
    processed by as few tasks; only then its rows are dealt out first. Tables
    with at least as many splits as cores are never repartitioned.
    """
    path = f"{sf}/{name}.parquet"
    if (spark, path) not in _OPENED:
        df = spark.read.parquet(path)
        cores = spark.sparkContext.defaultParallelism
        if name in WIDE_TABLES and df.rdd.getNumPartitions() < cores:
            df = df.repartition(cores)
        _OPENED[(spark, path)] = df
    return _OPENED[(spark, path)]


def sentiment(spark: SparkSession, sf: str) -> DataFrame:
    daily = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.expr("cast(sum(o_custkey) % 101 as int)").alias("sentiment_score"))
    return daily.selectExpr("*", """
        case when sentiment_score < 25 then 'Extreme Fear' when sentiment_score <= 45 then 'Fear'
             when sentiment_score < 55 then 'Neutral' when sentiment_score <= 75 then 'Greed'
             else 'Extreme Greed' end as sentiment_class""")


def fills(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as trade executions.

    ``fill_seq`` is a scalar tiebreak hashed from the columns that identify a
    line item, so no global row number is needed to order equal times.
    """
    def cents(c):
        return f"cast(floor({c} * 100 + 0.5D) as bigint)"

    joined = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.expr("l_orderkey = o_orderkey")).join(
        table(spark, sf, "part"), F.expr("l_partkey = p_partkey"))
    return joined.selectExpr(
        "*", f"{cents('l_extendedprice')} as _price", f"{cents('l_discount')} as _discount", f"{cents('l_tax')} as _tax",
    ).selectExpr(
        "l_orderkey * 10 + l_linenumber as trade_id",
        """cast(conv(substring(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, _price,
             cast(l_quantity as bigint), _discount, _tax)), 1, 15), 16, 10) as bigint) as fill_seq""",
        "concat('acct_', cast(o_custkey % 300 as string)) as account",
        "p_brand as coin",
        "p_retailprice as execution_price",
        "l_extendedprice as size_usd",
        "_price * (_tax + 2 - _discount) / 10000D as closed_pnl",
        """case (l_orderkey + l_linenumber) % 11
             when 0 then 'Buy' when 1 then 'Open Long' when 2 then 'Close Long' when 3 then 'Short > Long'
             when 4 then 'Sell' when 5 then 'Open Short' when 6 then 'Close Short' when 7 then 'Long > Short'
             when 8 then 'Liquidated Isolated Short' when 9 then 'Spot Dust Conversion' else 'Settlement' end as direction""",
        "l_shipdate + make_interval(0, 0, 0, 0, cast(l_orderkey % 24 as int)) as ts")


def bronze_fills(spark: SparkSession, sf: str) -> DataFrame:
    """Fills under the raw column names with the day-first time text."""
    return fills(spark, sf).select(
        F.col("account").alias("Account"), F.col("coin").alias("Coin"),
        F.col("execution_price").alias("Execution Price"), F.col("size_usd").alias("Size USD"),
        F.date_format("ts", "dd-MM-yyyy HH:mm").alias("Timestamp IST"), F.col("direction").alias("Direction"),
        F.col("closed_pnl").alias("Closed PnL"), F.col("trade_id").alias("Trade ID"))


def bronze_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return sentiment(spark, sf).select(
        F.col("date"), F.col("sentiment_score").alias("value"), F.col("sentiment_class").alias("classification"))


def articles(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return docs.select(
        F.col("doc_id").alias("article_id"),
        F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("title"),
        F.col("text").alias("content"),
        "source",
        F.col("lang").alias("author"),
        (base + F.make_interval(hours=(F.col("doc_id") % 720).cast("int"))).alias("published_date"))
