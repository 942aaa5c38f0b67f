"""Stored layers: a derived table is built once for a state of its inputs and read by everything after it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tradewinds.session import shared_dir


#: To be raised when the definition of a stored layer changes, so that layers of older code are not read.
DEFINITION = 1


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def input_state(spark: SparkSession, paths: Sequence[str]) -> str:
    """A fingerprint of the files of some tables: their paths, lengths and times of change."""
    found = []
    for path in paths:
        place, store = _place(spark, path)
        files = store.listFiles(place, True)
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:24]


def layer_path(spark: SparkSession, name: str, inputs: Sequence[str]) -> str:
    """Where the layer ``name`` over tables at the paths ``inputs`` lies, in the shared folder, for their present state."""
    return f"{shared_dir(spark).rstrip('/')}/layers/{name}-{DEFINITION}-{input_state(spark, inputs)}"


def is_complete(spark: SparkSession, path: str) -> bool:
    place, store = _place(spark, path + "/_SUCCESS")
    return store.exists(place)


def mark_complete(spark: SparkSession, path: str) -> None:
    """For layers of several tables or models; a table's own write leaves the mark itself."""
    place, store = _place(spark, path + "/_SUCCESS")
    store.create(place, True).close()


def stored(spark: SparkSession, name: str, inputs: Sequence[str], build: Callable[[], DataFrame]) -> DataFrame:
    """The layer, built and written if it is not there for the present state of its inputs.

    A write that was broken off leaves no mark and is done again.
    """
    path = layer_path(spark, name, inputs)
    if not is_complete(spark, path):
        build().write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
