"""Trading-behaviour and news-sentiment analytics as Spark DataFrame operators."""
