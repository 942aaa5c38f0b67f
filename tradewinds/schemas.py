"""Explicit schemas; nothing is inferred at read time."""

from pyspark.sql import types as T

BRONZE_FILLS = T.StructType([
    T.StructField("Account", T.StringType()),
    T.StructField("Coin", T.StringType()),
    T.StructField("Execution Price", T.DoubleType()),
    T.StructField("Size USD", T.DoubleType()),
    T.StructField("Timestamp IST", T.StringType()),
    T.StructField("Direction", T.StringType()),
    T.StructField("Closed PnL", T.DoubleType()),
    T.StructField("Trade ID", T.LongType()),
    T.StructField("_corrupt_record", T.StringType()),
])

BRONZE_SENTIMENT = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("value", T.IntegerType()),
    T.StructField("classification", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])

ARTICLES = T.StructType([
    T.StructField("article_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("published_date", T.StringType()),
    T.StructField("url", T.StringType()),
])

# Type families the quality report expects on the silver table.
SILVER_EXPECTED = {
    "trade_id": "int",
    "account": "string",
    "size_usd": "float",
    "closed_pnl": "float",
    "sentiment_score": "float",
    "leverage": "int",
    "win_flag": "int",
}
