"""Stored layers follow their inputs; small operators without a file of their own."""

import sys

from pyspark.sql import functions as F

from tradewinds.operators import news, quality
from tradewinds.sources import layers


def test_a_layer_is_built_once_for_a_state_of_its_inputs(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(5).write.parquet(source)
    built = []

    def build():
        built.append(1)
        return spark.read.parquet(source).withColumn("twice", F.col("id") * 2)

    assert layers.stored(spark, "twice", [source], build).count() == layers.stored(spark, "twice", [source], build).count() == 5
    assert len(built) == 1
    spark.range(3).write.mode("append").parquet(source)
    assert layers.stored(spark, "twice", [source], build).count() == 8 and len(built) == 2


def test_a_broken_write_is_done_again(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(4).write.parquet(source)
    path = layers.layer_path(spark, "half", [source])
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    assert not layers.is_complete(spark, path)
    assert layers.stored(spark, "half", [source], lambda: spark.read.parquet(source)).count() == 4
    assert layers.is_complete(spark, path)


def test_labels(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", 4)], "source string, n int")
    labels = spark.createDataFrame([("a", 9.0), ("c", None)], "source string, score double")
    got = {r["n"]: r["score"] for r in news.with_label(rows, labels, "source", "score", 60.0).collect()}
    assert got == {1: 9.0, 2: 60.0, 3: 60.0, 4: 60.0}


def test_schema_checks_count_what_cannot_be_read(spark):
    df = spark.createDataFrame([("1", "x", 1.5), ("oops", "y", 2.0), (None, "z", 3.0)], "n string, t string, v double")
    got = {r["column"]: (r["passed"], r["bad_values"]) for r in quality.schema_checks(df, {"n": "int", "t": "string", "v": "float", "gone": "int"}).collect()}
    assert got == {"n": (False, 1), "t": (True, 0), "v": (True, 0), "gone": (False, -1)}


def test_other_queries_without_the_packages_of_the_optional_operators(monkeypatch):
    """The entry imports, and keeps its queries, where a package that only the optional operators need is missing."""
    import importlib

    import __spark_entry__ as entry

    for name in [m for m in sys.modules if m.startswith("tradewinds.llm") or m in ("corpus_pipeline", "__spark_entry__")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    again = importlib.import_module("__spark_entry__")
    assert len(again.queries()) > 100 and not any(q.startswith("op1") for q in again.queries())
    monkeypatch.undo()
    sys.modules["__spark_entry__"] = entry


def test_silver_is_stored_once_and_equals_the_built_one(spark):
    from tradewinds.plans.trade_queries import built_silver, silver

    sf = "/root/testdata/sf0.001"
    got, want = silver(spark, sf), built_silver(spark, sf)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    files = [f for f in got.inputFiles() if "/layers/" in f]
    assert any("/trades-" in f for f in files) and any("/fill_days-" in f for f in files)
