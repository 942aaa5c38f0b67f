"""Readers with explicit schemas."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tradewinds import schemas
from tradewinds.functions.trade import fill_time


def header_groups(spark: SparkSession, path: str | Sequence[str]) -> list[tuple[str, list[str]]]:
    """The different first lines of some text files, each with its files.

    A driver that plans a read lists the files anyway; no more than that list
    comes back here. Empty files have no first line.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    first = lines.where("at = 0").withColumn("nth", F.monotonically_increasing_id()).groupBy("file").agg(F.min_by("value", "nth").alias("header"))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    return [(r["header"], [unquote(f) for f in r["files"]]) for r in groups]


def by_header(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """CSV files with headers, the columns of each file found by its own header: their order and further columns do not matter.

    A column that a file lacks is NULL in its rows. A value that is not of its
    column's type is NULL, and ``_corrupt_record`` then holds the row's values
    as JSON; a line of too few or too many values is kept there as it is. Files
    of one header are read together, in one scan of the columns that are asked for.
    """
    wanted = [f for f in schema if f.name != "_corrupt_record"]
    out = None
    for header, files in header_groups(spark, path):
        names = next(csv.reader([header.removeprefix("\ufeff")]))
        # a name that stands twice counts once, the first time
        columns = [n if names.index(n) == i else f"_again_{i}" for i, n in enumerate(names)]
        text = spark.read.schema(T.StructType([*(T.StructField(c, T.StringType()) for c in columns), T.StructField("_line", T.StringType())])).option(
            "header", True).option("columnNameOfCorruptRecord", "_line").csv(files)
        raw = {f.name: F.col(f"`{f.name}`") if f.name in columns else F.lit(None).cast("string") for f in wanted}
        values = {f.name: raw[f.name].try_cast(f.dataType) for f in wanted}
        broken = F.lit(False)
        for f in wanted:
            broken = broken | (raw[f.name].isNotNull() & values[f.name].isNull())
        as_json = F.when(broken, F.to_json(F.struct(*(raw[f.name].alias(f.name) for f in wanted))))
        part = text.select(*(values[f.name].alias(f.name) for f in wanted), F.coalesce("_line", as_json).alias("_corrupt_record"))
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], T.StructType([*wanted, T.StructField("_corrupt_record", T.StringType())]))


def read_bronze_fills(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Raw executions; a malformed row keeps its text in ``_corrupt_record``."""
    return by_header(spark, path, schemas.BRONZE_FILLS)


def fills_from_bronze(bronze: DataFrame) -> DataFrame:
    """Library names, parsed time, and ``fill_seq``: an order for equal times.

    Malformed rows are left out; they stay in the bronze table with their text.
    ``fill_seq`` is a hash of the fill itself, so it is the same however the
    files are split, read again, or arrive; only identical fills share one.
    """
    fills = bronze.where("_corrupt_record is null").select(
        F.col("Account").alias("account"), F.col("Coin").alias("coin"),
        F.col("`Execution Price`").alias("execution_price"), F.col("`Size USD`").alias("size_usd"),
        fill_time("`Timestamp IST`").alias("ts"), F.col("Direction").alias("direction"),
        F.col("`Closed PnL`").alias("closed_pnl"), F.col("`Trade ID`").alias("trade_id"))
    told = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in fills.columns]))
    return fills.withColumn("fill_seq", F.conv(F.substring(told, 1, 15), 16, 10).cast("long"))


def read_fills(spark: SparkSession, path: str) -> DataFrame:
    return fills_from_bronze(read_bronze_fills(spark, path))


def read_sentiment(spark: SparkSession, path: str) -> DataFrame:
    return by_header(spark, path, schemas.BRONZE_SENTIMENT).where("_corrupt_record is null").select(
        "date", F.col("value").alias("sentiment_score"), F.col("classification").alias("sentiment_class"))


def read_bronze_articles(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Article JSON, one object or array of objects per file (``multi_line``) or one object per line.

    What is no JSON, or holds a value of another type, is kept in ``_corrupt_record`` as it is.
    """
    schema = T.StructType([*schemas.ARTICLES, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_articles(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The readable articles of ``read_bronze_articles``."""
    return read_bronze_articles(spark, path, multi_line).where("_corrupt_record is null").drop("_corrupt_record")


def read_silver(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)
