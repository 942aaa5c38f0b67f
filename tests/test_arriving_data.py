"""Files of any column order, streamed silver equal to batch, and ledgers that take late months in."""

import random

import pytest
from pyspark.sql import functions as F

from tradewinds import schemas
from tradewinds.operators import gold_states, risk, silver as sv
from tradewinds.sources import readers
from tradewinds.sources.writers import write_table
from tradewinds.streaming import incremental

NAMES = ["Account", "Coin", "Execution Price", "Size USD", "Timestamp IST", "Direction", "Closed PnL", "Trade ID"]


def test_every_file_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,value,classification\n2026-01-01,40,Fear\n")
    (tmp_path / "b b.csv").write_text('value,note,classification,date\n70,"x, y",Greed,2026-01-02\n')
    (tmp_path / "c.csv").write_text("﻿classification,date\nNeutral,2026-01-03\n")
    (tmp_path / "d.csv").write_text("date,value,classification\n")
    (tmp_path / "e.csv").write_text("")
    got = sorted(tuple(r) for r in readers.read_sentiment(spark, str(tmp_path)).withColumn("date", F.col("date").cast("string")).collect())
    assert got == [("2026-01-01", 40, "Fear"), ("2026-01-02", 70, "Greed"), ("2026-01-03", None, "Neutral")]
    assert len(readers.header_groups(spark, str(tmp_path))) == 3


def test_malformed_lines_stay_in_bronze(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,value,classification\n2026-01-01,40,Fear\n2026-01-02,many,Fear\n2026-01-03\n")
    (tmp_path / "b.csv").write_text("value,date,classification\n1,2026-01-04,Fear,more\n")
    bronze = readers.by_header(spark, str(tmp_path), schemas.BRONZE_SENTIMENT)
    broken = sorted(r["_corrupt_record"] for r in bronze.where("_corrupt_record is not null").collect())
    assert broken == ["1,2026-01-04,Fear,more", "2026-01-03", '{"date":"2026-01-02","value":"many","classification":"Fear"}']
    assert [str(r["date"]) for r in readers.read_sentiment(spark, str(tmp_path)).collect()] == ["2026-01-01"]
    empty = tmp_path / "none"
    empty.mkdir()
    (empty / "x.csv").write_text("")
    assert readers.by_header(spark, str(empty), schemas.BRONZE_SENTIMENT).count() == 0


def test_articles_that_are_no_json_stay_in_bronze(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n "article_id": "1",\n "title": "t"}')
    (tmp_path / "b.json").write_text('[{"article_id": "2", "title": "u"},\n {"article_id": "3"}]')
    (tmp_path / "c.json").write_text('{"article_id": "4", "title": ')
    assert sorted(r["article_id"] for r in readers.read_articles(spark, str(tmp_path)).collect()) == ["1", "2", "3"]
    broken = readers.read_bronze_articles(spark, str(tmp_path)).where("_corrupt_record is not null").select("article_id", "_corrupt_record").collect()
    assert [r["_corrupt_record"] for r in broken] == ['{"article_id": "4", "title": ']


def lines(pick, days, n):
    out = []
    for _ in range(n):
        i = pick.randrange(10 ** 9)
        out.append([f"acct{i % 3}", pick.choice(["BTC", "ETH"]), "1.5", str(100 + i % 9000), f"{pick.choice(days)} {i % 24:02d}:30",
                    pick.choice(["Buy", "Close Long", "Sell"]), str(i % 200 - 100), str(i)])
    return out


def write_fills(path, rows, order):
    path.write_text("\n".join([",".join(order)] + [",".join(r[NAMES.index(c)] for c in order) for r in rows]) + "\n")


@pytest.fixture(scope="module")
def arriving(spark, tmp_path_factory):
    """Three batches: a month, a later one, and late fills on days before, between and after, without sentiment of their own."""
    folder, out, state = (tmp_path_factory.mktemp(n) for n in ("in", "out", "state"))
    pick = random.Random(6)
    sentiment = spark.createDataFrame([("2026-03-10", 20.0, "Extreme Fear"), ("2026-03-20", 40.0, "Fear"), ("2026-04-15", 80.0, "Extreme Greed")],
                                      "date string, sentiment_score double, sentiment_class string").withColumn("date", F.to_date("date"))
    batches = [["10-03-2026", "12-03-2026"], ["15-04-2026", "16-04-2026", "03-05-2026"], ["01-02-2026", "20-03-2026", "22-03-2026", "02-05-2026"]]
    for i, days in enumerate(batches):
        write_fills(folder / f"{i}.csv", lines(pick, days, 60), NAMES if i != 1 else NAMES[::-1])
        incremental.run_available(spark, str(folder), sentiment, str(out), str(state))
    fills = readers.read_fills(spark, str(folder))
    batch = sv.silver_trades(fills, sentiment)
    streamed = spark.read.parquet(f"{out}/silver").withColumn("month", F.col("month").cast("string"))
    return folder, str(out), sentiment, batch, streamed


def test_streamed_silver_equals_batch(spark, arriving):
    _, _, _, batch, streamed = arriving
    assert set(streamed.columns) == set(batch.columns) and schemas.SILVER_EXPECTED.keys() <= set(streamed.columns)
    a, b = sorted(map(str, batch.select(*sorted(batch.columns)).collect())), sorted(map(str, streamed.select(*sorted(batch.columns)).collect()))
    assert len(a) == 180 and a == b
    # the late first day borrowed from the day after it, days between from the days before them
    scores = {str(r["date"]): r["sentiment_score"] for r in streamed.select("date", "sentiment_score").distinct().collect()}
    assert scores["2026-02-01"] == 20.0 and scores["2026-03-22"] == 40.0 and scores["2026-05-02"] == 80.0


def test_ordered_operators_agree_on_streamed_silver(spark, arriving):
    _, _, _, batch, streamed = arriving
    a, b = (sorted(tuple(r) for r in risk.rolling_var(sv.realized_trades(s), ["account"], n=5).select(
        "account", "ts", "fill_seq", F.coalesce("rolling_var", F.lit(-1e9))).collect()) for s in (batch, streamed))
    assert a == b


def test_a_repeated_batch_changes_nothing(spark, arriving):
    folder, out, sentiment, _, streamed = arriving
    before = streamed.count()
    again = incremental.add_fills(spark, readers.read_fills(spark, str(folder / "2.csv")), sentiment, out, 2)
    assert spark.read.parquet(f"{out}/silver").count() == before
    assert "2026-04" not in again and "2026-02" in again  # only months with its fills or changed days


def test_a_late_month_gives_the_same_gold(spark, arriving, tmp_path):
    _, _, _, batch, _ = arriving
    silver = str(tmp_path / "silver")
    write_table(batch, silver, ["month"])
    rows = spark.read.parquet(silver).withColumn("month", F.col("month").cast("string"))
    gold, full = str(tmp_path / "gold"), str(tmp_path / "full")
    ledgers = {n: gold_states.LEDGERS[n] for n in ("by_trader", "coin_by_sentiment")}
    gold_states.refresh(spark, rows.where("month <> '2026-03'"), gold, ledgers=ledgers)
    gold_states.refresh(spark, rows, gold, ["2026-03"], ledgers)
    gold_states.refresh(spark, rows, full, ledgers=ledgers)
    for name, keys in ledgers.items():
        a = {tuple(r[k] for k in keys): r for r in spark.read.parquet(f"{gold}/{name}").collect()}
        b = {tuple(r[k] for k in keys): r for r in spark.read.parquet(f"{full}/{name}").collect()}
        direct = {tuple(r[k] for k in keys): r for r in sv.realized_trades(batch).groupBy(*keys).agg(
            F.sum("closed_pnl").alias("total_pnl"), F.stddev_samp("closed_pnl").alias("std_pnl"), F.countDistinct("date").alias("active_days"),
            F.avg("roe").alias("avg_roe"), F.min("closed_pnl").alias("worst_loss")).collect()}
        assert a.keys() == b.keys() == direct.keys()
        for k in a:
            for c in a[k].asDict():
                assert a[k][c] == (pytest.approx(b[k][c], rel=1e-9) if isinstance(b[k][c], float) else b[k][c])
            for c in ("total_pnl", "std_pnl", "active_days", "avg_roe", "worst_loss"):
                assert a[k][c] == (pytest.approx(direct[k][c], rel=1e-9) if direct[k][c] is not None else None)
