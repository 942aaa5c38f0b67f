"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def get_session(app_name: str = "tradewinds", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator assumes (UTC, AQE, no UI)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor and the driver see.

    ``spark.checkpoint.dir`` names it. Where that is unset, a folder inside the
    session's warehouse is taken, which is shared storage by contract; a
    machine-local temporary folder never is.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path inside the shared folder for a table an operator writes."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df, **options):
    """Store the rows as a table in the shared folder and continue from there; ``options`` are the Parquet writer's.

    Losing an executor then costs nothing, repeated readers prune columns, and
    later plans see real sizes. The folder's owner clears it after the run.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
