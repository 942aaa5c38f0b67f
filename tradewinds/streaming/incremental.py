"""Incremental silver: new fill files become silver rows, each file once, equal to a batch over all files.

The sentiment of a day without an index value comes from neighbouring days that
carry fills, so a new day can change the rows of earlier ones. The stream
therefore keeps three tables under its output folder: ``fills`` (by month and
batch), ``days`` (one row per fill day with its filled sentiment) and ``silver``
(by month). A batch adds its fills, fills the day table anew, which is as long
as the calendar, and rewrites the months that hold new fills or changed days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tradewinds.operators.silver import add_calendar, derive_trade_columns, sentiment_by_fill_day
from tradewinds.session import cut_lineage
from tradewinds.sources import layers, readers
from tradewinds.sources.writers import write_table

CHANGED_DAYS = ["date", "sentiment_score", "sentiment_class"]


def silver_of(fills: DataFrame, days: DataFrame) -> DataFrame:
    """Silver rows of fills that have their calendar columns, with the sentiment of the day table (one row per calendar day)."""
    return derive_trade_columns(fills.join(F.broadcast(days), "date", "left"))


def add_fills(spark: SparkSession, fills: DataFrame, sentiment: DataFrame, out: str, batch: int) -> list[str]:
    """Take in one batch of fills (``readers.fills_from_bronze``); returns the months that were rewritten.

    A batch number that was taken in before is replaced, so a repeated batch changes nothing.
    """
    dated = add_calendar(fills).withColumn("batch", F.lit(batch))
    write_table(dated, f"{out}/fills", ["batch", "month"])
    # the new part's months, nulls (fills without a readable time) included
    touched = spark.read.parquet(f"{out}/fills").where(F.col("batch") == batch).select("month").distinct()
    every = spark.read.parquet(f"{out}/fills").withColumn("month", F.col("month").cast("string"))
    days = cut_lineage(sentiment_by_fill_day(every, sentiment).select(*CHANGED_DAYS))
    months = {r["month"] if r["month"] is None else str(r["month"]) for r in touched.collect()}
    if layers.is_complete(spark, f"{out}/days"):
        known = spark.read.schema(days.schema).parquet(f"{out}/days")
        changed = days.exceptAll(known).unionByName(known.exceptAll(days)).select(F.date_format("date", "yyyy-MM").alias("month")).distinct()
        months |= {r["month"] for r in changed.collect()}
    if months:
        named = [m for m in months if m is not None]
        mine = F.col("month").isin(named) | (F.col("month").isNull() if None in months else F.lit(False))
        rows = silver_of(every.where(mine).drop("batch"), days)
        write_table(rows, f"{out}/silver", ["month"])
    # last, so that a run that breaks off before finds its days changed again
    days.write.mode("overwrite").parquet(f"{out}/days")
    return sorted(m or "" for m in months)


def start(spark: SparkSession, path: str, sentiment: DataFrame, out: str, state: str, **trigger) -> StreamingQuery:
    """Follow a folder of CSV files. ``state`` is the stream's checkpoint folder, ``sentiment`` the daily index.

    The stream tells which files are new; they are read as in batch, each by its own header.
    """

    def take(lines: DataFrame, batch: int) -> None:
        files = [readers.unquote(r["file"]) for r in lines.select("file").distinct().collect()]
        if files:
            session = lines.sparkSession
            add_fills(session, readers.fills_from_bronze(readers.read_bronze_fills(session, files)), sentiment, out, batch)

    arriving = spark.readStream.text(path).select(F.col("_metadata.file_path").alias("file"))
    return arriving.writeStream.foreachBatch(take).option("checkpointLocation", state).trigger(**(trigger or {"availableNow": True})).start()


def run_available(spark: SparkSession, path: str, sentiment: DataFrame, out: str, state: str) -> None:
    """Process all files present now, then stop: an incremental batch run."""
    start(spark, path, sentiment, out, state).awaitTermination()
