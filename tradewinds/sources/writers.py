"""Sinks. Operators never write; callers choose the sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Overwrite a table; with partitions only those present in ``df`` are replaced, so a rerun is incremental.

    Rows of a partition value are spread by the writer's own rebalancing, so
    partitioned output does not leave one small file per task and value.
    """
    out = df
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    writer = out.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.save(path)


def write_articles(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "json") -> None:
    write_table(df, path, partition_by, fmt)


def write_ledger(df: DataFrame, path: str) -> None:
    """A result table as CSV with a header line per part."""
    df.write.mode("overwrite").option("header", True).csv(path)
