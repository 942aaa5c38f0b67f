import pytest
from pyspark.sql import functions as F

from tradewinds import schemas
from tradewinds.operators import learn, quality
from tradewinds.plans.trade_queries import silver
from tradewinds.session import scratch_path
from tradewinds.sources import readers, writers

SF = "/root/testdata/sf0.001"


def test_checks_on_toy(spark, toy):
    assert all(r["passed"] for r in quality.null_checks(toy, ["account", "closed_pnl"]).collect())
    assert quality.duplicate_checks(toy).first()["passed"]
    ok = quality.schema_checks(toy, {"account": "string", "closed_pnl": "float", "leverage": "int"})
    assert all(r["passed"] for r in ok.collect())
    assert quality.zscore_outliers(toy, "closed_pnl").count() == 0
    assert quality.sentiment_drift(toy).count() == 0  # fewer than 100 rows


def test_null_keys_count_as_one_duplicate_group(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (None,), (2,)], "trade_id long")
    row = quality.duplicate_checks(df).first()
    assert row["duplicate_count"] == 3 and not row["passed"]
    assert quality.null_checks(df, ["trade_id", "gone"]).orderBy("column").collect() == [
        ("gone", -1, False), ("trade_id", 3, False)]


def test_schema_mismatch(spark):
    df = spark.range(1).select(F.lit(1.5).alias("leverage"))
    out = {r["column"]: r for r in quality.schema_checks(df, {"leverage": "int", "account": "string"}).collect()}
    assert not out["leverage"]["passed"] and out["account"]["actual"] == "missing"


def test_constant_column_has_no_outliers(spark):
    df = spark.range(10).select(F.lit(1.0).alias("v"))
    assert quality.zscore_outliers(df, "v").count() == 0


@pytest.mark.parametrize("rows,found", [(150, True), (100, True), (99, None)])
def test_drift_needs_a_hundred_rows(spark, rows, found):
    split = int(rows * 2 / 3)
    df = spark.range(rows).select(
        F.col("id").alias("ts"), F.col("id").alias("fill_seq"), F.when(F.col("id") < split, 50.0).otherwise(85.0).alias("sentiment_score"))
    out = quality.sentiment_drift(df).first()
    assert (out["drift_detected"] if out else None) == found


def test_overall_gate(spark, toy):
    overall = quality.data_quality_report(toy).where("check = 'overall'").first()
    assert overall["passed"]
    twice = toy.unionByName(toy)
    assert not quality.data_quality_report(twice).where("check = 'overall'").first()["passed"]


def test_step_metrics(spark, toy):
    metrics = quality.StepMetrics(spark)
    path = scratch_path(spark, "toy")
    with metrics.step("toy") as done:
        writers.write_table(toy, path)
        done(spark.read.parquet(path))
    metrics.log_model("Random Forest", 0.8, 0.9)
    row = metrics.table().first()
    assert row["step"] == "toy" and row["records_processed"] == 10 and row["execution_time_seconds"] > 0
    assert metrics.model_table().first()["f1_score"] == 0.9


# ---- learning ---------------------------------------------------------------

@pytest.fixture(scope="module")
def trades(spark):
    rows = silver(spark, SF).persist()
    yield rows
    rows.unpersist()  # else later plans in this session would read it from the cache


def test_features_cover_missing_longs_and_losses(spark, toy):
    shorts = toy.withColumn("trade_direction", F.lit("Short")).withColumn("closed_pnl", F.abs("closed_pnl"))
    rows = learn.trader_features(shorts).collect()
    assert {r["long_ratio"] for r in rows} == {0.5} and {r["profit_factor"] for r in rows} == {100.0}


def test_segments(spark, trades):
    out = learn.trader_segments(learn.trader_features(trades), seeds=(42,))
    rows = out.collect()
    assert len({(r["segment_id"], r["trader_segment"]) for r in rows}) == 4
    assert learn.segment_summary(out).agg(F.sum("traders")).first()[0] == len(rows)
    few = learn.trader_segments(learn.trader_features(trades).limit(3)).collect()
    assert {r["trader_segment"] for r in few} == {"Conservative / Tactical Retail"}


def test_unseen_level_encodes_as_zeros(spark, trades):
    rows = learn.model_rows(trades)
    encoder = learn.encode_features(rows)
    vector = encoder.transform(rows.limit(1).withColumns({
        "coin": F.lit("NEW"), "day_of_week": F.lit("?"), "trade_direction": F.lit("?")})).first()["features"]
    assert vector.size == len(learn.feature_names(encoder)) and all(v == 0 for v in vector.toArray()[len(learn.NUMERIC):])


def test_train_predict_save(spark, trades):
    table, models = learn.train_compare(trades, trees=5, depth=4)
    rows = table.collect()
    assert [r["model"] for r in rows] == ["Random Forest", "Logistic Regression"]
    for r in rows:
        assert r["accuracy"] == pytest.approx((r["tp"] + r["tn"]) / (r["tp"] + r["tn"] + r["fp"] + r["fn"]))
        assert 0 <= r["roc_auc"] <= 1
    best = learn.select_best(table).first()
    assert best["f1_score"] == max(r["f1_score"] for r in rows)
    path = scratch_path(spark, "model")
    learn.save_model(models["Random Forest"], path)
    again = learn.load_model(path)
    out = learn.predict_wins(again, learn.model_rows(trades)).collect()
    assert len(out) == learn.model_rows(trades).count()
    assert all((r["win_probability"] >= 0.55) == (r["action"] == "APPROVED") for r in out)
    importance = learn.feature_importance(again).collect()
    assert sum(r["importance"] for r in importance) == pytest.approx(1.0)
    assert {"leverage", "trade_direction_Long"} <= {r["feature"] for r in importance}


def test_boosted_trees_are_optional():
    assert "Gradient Boosting" in learn.classifiers(10, boosted=True) and "Gradient Boosting" not in learn.classifiers(10)


def test_split_is_disjoint_and_stratified(spark, trades):
    rows = learn.stratified_split_exact(learn.model_rows(trades))
    for r in rows.groupBy("win_flag").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")).collect():
        assert r["t"] == round(r["n"] * 0.3)


def test_metrics_on_zero_denominators(spark):
    df = spark.createDataFrame([(1, 0, 0.2), (0, 0, 0.3)], "win_flag int, prediction int, probability double")
    row = learn.classification_metrics(df).first()
    assert row["precision"] == row["recall"] == row["f1_score"] == 0.0 and row["roc_auc"] == 0.0
    one_class = df.where("win_flag = 1")
    assert learn.classification_metrics(one_class).first()["roc_auc"] is None


def test_select_best_prefers_the_first_on_ties(spark):
    df = spark.createDataFrame([(1, "b", .9), (0, "a", .9), (2, "c", .1)], "ordinal int, model string, f1_score double")
    assert learn.select_best(df).first()["model"] == "a"


def test_attribution_signs(spark):
    row = spark.createDataFrame([(1, 17.0, 10000.0, 40.0, 24.0, 1.0)], "id int, leverage double, size_usd double, sentiment_score double, hour double, coin_BTC double")
    out = {r["feature"]: r["attribution"] for r in learn.linear_attribution(
        row, "id", ["leverage", "size_usd", "sentiment_score", "hour", "coin_BTC"], {"leverage": .5}).collect()}
    assert out == {"leverage": pytest.approx(-.5), "size_usd": pytest.approx(-.01), "sentiment_score": pytest.approx(.2 * .5 * .01),
                   "hour": pytest.approx(.01), "coin_BTC": pytest.approx(.0075)}
    ranked = learn.ranked_attribution(learn.linear_attribution(row, "id", ["leverage", "hour"], {}), "id", top=1).collect()
    assert [r["feature"] for r in ranked] == ["hour"]


# ---- sources and sinks ------------------------------------------------------

HEADER = "Account,Coin,Execution Price,Size USD,Timestamp IST,Direction,Closed PnL,Trade ID\n"


def test_read_fills_keeps_malformed_lines(spark, tmp_path):
    (tmp_path / "f.csv").write_text(HEADER + "a,BTC,1.5,100,25-05-2026 10:00,Buy,5,123456789012345\nb,ETH,oops,1,bad,Buy,0,2\n")
    bronze = readers.read_bronze_fills(spark, str(tmp_path)).persist()
    rows = readers.fills_from_bronze(bronze).collect()
    assert [r["trade_id"] for r in rows] == [123456789012345]
    assert bronze.where("_corrupt_record is not null").count() == 1


def test_read_articles_one_object_per_file(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n "article_id": "1", "title": "t",\n "content": "c", "source": "s", "url": "u"}')
    (tmp_path / "b.json").write_text('{\n "article_id": "2", "title": "t"}')
    assert {r["article_id"] for r in readers.read_articles(spark, str(tmp_path)).collect()} == {"1", "2"}


def test_dynamic_partition_overwrite(spark, toy):
    path = scratch_path(spark, "parts")
    two = toy.withColumn("month", F.when(F.col("account") == "A", "2026-01").otherwise("2026-02"))
    writers.write_table(two, path, ["month"])
    writers.write_table(two.where("month = '2026-02'").limit(2), path, ["month"])
    counts = {str(r["month"]): r["count"] for r in readers.read_silver(spark, path).groupBy("month").count().collect()}
    assert counts == {"2026-01": 5, "2026-02": 2}
