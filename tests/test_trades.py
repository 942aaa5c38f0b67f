import pytest
from pyspark.sql import functions as F

from tradewinds.operators import behavior, curves, marts, performance, regimes, risk, silver
from tradewinds.functions.trade import fill_time

FILLS = "trade_id long, fill_seq long, account string, coin string, execution_price double, size_usd double, closed_pnl double, direction string, ts timestamp"


def make_fills(spark, rows):
    df = spark.createDataFrame(rows, "trade_id long, size_usd double, closed_pnl double, time string")
    return df.select(
        "trade_id", F.col("trade_id").alias("fill_seq"), F.lit("a").alias("account"), F.lit("BTC").alias("coin"),
        F.lit(1.0).alias("execution_price"), "size_usd", "closed_pnl", F.lit("Buy").alias("direction"), fill_time("time").alias("ts"))


def sentiment(spark, rows):
    df = spark.createDataFrame(rows, "date string, sentiment_score int, sentiment_class string")
    return df.withColumn("date", F.to_date("date"))


def test_gap_fill_uses_fill_days_only(spark):
    fills = make_fills(spark, [(i, 100.0, 1.0, t) for i, t in enumerate(
        ["01-01-2026 09:00", "02-01-2026 09:00", "04-01-2026 09:00", "06-01-2026 09:00", "bad"])])
    # the 3rd has an index value but no fill, so it may not donate to the 4th
    known = sentiment(spark, [("2026-01-02", 30, "Fear"), ("2026-01-03", 90, "Extreme Greed"), ("2026-01-06", 60, "Greed")])
    out = silver.silver_trades(fills, known).orderBy("trade_id").collect()
    assert [r["sentiment_score"] for r in out] == [30.0, 30.0, 30.0, 60.0, 50.0]
    assert [r["sentiment_class"] for r in out] == ["Fear", "Fear", "Fear", "Greed", "Neutral"]


def test_no_sentiment_at_all(spark):
    fills = make_fills(spark, [(1, 0.0, 5.0, "01-01-2026 09:30")])
    row = silver.silver_trades(fills, sentiment(spark, []).limit(0)).first()
    assert (row["sentiment_score"], row["sentiment_class"], row["pnl_pct"], row["roe"]) == (50.0, "Neutral", 0.0, 0.0)
    assert (row["hour"], row["day_of_week"], row["month"]) == (9, "Thursday", "2026-01")


def test_empty_fills(spark):
    fills = make_fills(spark, [(1, 1.0, 1.0, "01-01-2026 09:30")]).limit(0)
    s = silver.silver_trades(fills, sentiment(spark, [("2026-01-02", 30, "Fear")]))
    assert performance.sentiment_performance(s).count() == 0
    assert risk.risk_metrics_report(s).count() == 0
    assert behavior.trader_personas(s).count() == 0
    assert curves.equity_curve(s).count() == 0


def test_filters(spark, toy):
    assert silver.filter_trades(toy).count() == 10
    assert silver.filter_trades(toy, accounts=["A"], coins=["BTC"], classes=["Fear"]).count() == 1
    assert silver.active_accounts(toy, 5).count() == 10 and silver.active_accounts(toy, 6).count() == 0


def test_class_order(spark, toy):
    classes = [r["sentiment_class"] for r in performance.sentiment_performance(toy).collect()]
    assert classes == ["Extreme Fear", "Fear", "Neutral", "Greed"]


def test_correlation_needs_more_than_five_rows(spark, toy):
    assert [r["scope"] for r in performance.leverage_correlation(toy).collect()] == ["Overall"]


def test_correlation_of_a_constant_is_null(spark, toy):
    flat = performance.leverage_correlation(toy.withColumn("leverage", F.lit(3)), min_rows=0).collect()
    assert {r["corr_leverage_pnl"] for r in flat} == {None} and len(flat) == 5


def test_toy_personas(spark, toy):
    rows = {r["account"]: r for r in behavior.trader_personas(toy).collect()}
    assert {a: r["behavioral_risk_score"] for a, r in rows.items()} == {"A": 40.0, "B": 40.0}
    assert all(r["loss_chasing_bias"] == 1 and r["fomo_bias"] == r["panic_bias"] == r["overconfidence_bias"] == 0
               for r in rows.values())


def seq(spark, rows):
    """rows: (account, minute, pnl, size, leverage, score)"""
    df = spark.createDataFrame(rows, "account string, minute int, closed_pnl double, size_usd double, leverage int, sentiment_score double")
    return df.withColumns({
        "ts": F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, minute)"),
        "fill_seq": F.col("minute").cast("long"), "win_flag": (F.col("closed_pnl") > 0).cast("int"),
        "is_closing_trade": F.lit(True)})


def persona(spark, rows):
    return behavior.trader_personas(seq(spark, [("a", *r) for r in rows])).first()


def test_four_trades_are_too_few(spark):
    assert persona(spark, [(i, 1.0, 1.0, 1, 50.0) for i in range(4)]) is None


def test_loss_chase_window_is_inclusive(spark):
    steady = [(i, 1.0, 100.0, 1, 50.0) for i in range(4)]
    exactly = steady + [(10, -1.0, 100.0, 1, 50.0), (10 + 1440, 1.0, 200.0, 1, 50.0)]
    later = steady + [(10, -1.0, 100.0, 1, 50.0), (11 + 1440, 1.0, 200.0, 1, 50.0)]
    assert persona(spark, exactly)["loss_chasing_bias"] == 1
    assert persona(spark, later)["loss_chasing_bias"] == 0


def test_streak_on_the_last_row_has_no_next_trade(spark):
    losses = [(0, -1.0, 100.0, 1, 50.0), (1, -1.0, 100.0, 1, 50.0)]
    wins = [(i, 1.0, 100.0, 1, 50.0) for i in (2, 3, 4)]
    assert persona(spark, losses + wins)["overconfidence_bias"] == 0
    assert persona(spark, losses + wins + [(5, 1.0, 300.0, 1, 50.0)])["overconfidence_bias"] == 1


def test_archetypes(spark):
    flat = [(i, 10.0, 100.0, 2, 50.0) for i in range(5)]
    assert persona(spark, flat)["trader_archetype"] == "Systematic Trader"  # no loss: factor 1
    assert persona(spark, flat + [(9, -1.0, 100.0, 2, 50.0)])["trader_archetype"] == "Institutional Trader"
    fast = [(i, -10.0, 100.0, 20, 50.0) for i in range(5)]
    assert persona(spark, fast)["trader_archetype"] == "High-Leverage Speculator"
    chaser = [(i, 10.0, 100.0, 5, 50.0) for i in range(5)] + [(10 + i, 10.0, 900.0, 5, 80.0) for i in range(3)]
    assert persona(spark, chaser)["trader_archetype"] == "Momentum Chaser"
    fearful = [(i, -100.0, 100.0, 5, 20.0) for i in range(4)] + [(10 + i, -1.0, 100.0, 5, 60.0) for i in range(6)]
    assert persona(spark, fearful)["trader_archetype"] == "Fear-Driven Trader"
    contrarian = [(i, 10.0, 100.0, 5, 20.0) for i in range(4)] + [(9, -1.0, 100.0, 5, 50.0)]
    assert persona(spark, contrarian)["trader_archetype"] == "Contrarian Trader"


def test_equity_curve_by_hand(spark, toy):
    out = curves.equity_curve(toy.where("account = 'A'")).orderBy("fill_seq").collect()
    base, frac, dyn = 100000.0, 100000.0, 100000.0
    wins, losses = [100.0, 200.0, 300.0], [150.0, 50.0]
    b = (sum(wins) / 3) / (sum(losses) / 2)
    kelly = max(0.0, min(0.5, 0.5 * (0.6 - 0.4 / b)))
    steps = [(.02 * 5, 45), (.02 * 5, 60), (-.015 * 5, 65), (.03 * 10, 30), (-.01 * 10, 20)]
    for row, (step, score) in zip(out, steps):
        multiplier = 2.0 if score < 25 else 1.25 if score < 45 else 0.25 if score > 75 else 0.75 if score > 55 else 1.0
        base += 5000 * step
        frac += frac * 0.02 * step
        dyn += dyn * kelly * multiplier * step
        assert row["baseline_fixed"] == pytest.approx(base)
        assert row["fixed_fractional_2pct"] == pytest.approx(frac)
        assert row["dynamic_sentiment_kelly"] == pytest.approx(dyn)


def test_equity_curve_survives_a_factor_below_zero(spark, toy):
    wild = toy.withColumn("pnl_pct", F.lit(-2.0)).withColumn("leverage", F.lit(50))
    last = curves.equity_curve(wild, ["account"]).where("fill_seq = 104").first()
    assert last["fixed_fractional_2pct"] == pytest.approx(100000.0 * (1 - 0.02 * 100) ** 5)


def test_risk_report_on_toy(spark, toy):
    rows = {r["sentiment_class"]: r for r in risk.risk_metrics_report(toy).collect()}
    greed = rows["Greed"]
    assert greed["trade_count"] == 4
    # order 101, 102, 106, 107: totals 200, 50, 250, 150
    assert greed["max_drawdown_usd"] == pytest.approx(-150.0)
    assert greed["cvar_95"] == -150.0 and greed["var_95"] == pytest.approx(-142.5)
    assert rows["Neutral"]["downside_dev"] == 0.0 and rows["Neutral"]["sortino_ratio"] == 0.0
    assert rows["Fear"]["max_drawdown_usd"] == 0.0


def test_rolling_var_short_series_uses_the_whole_series(spark, toy):
    rows = risk.rolling_var(toy.where("account = 'A'"), ["account"], n=30).collect()
    assert [r["rolling_var"] for r in rows] == [pytest.approx(-130.0)] * 5
    rows = risk.rolling_var(toy, [], n=5).orderBy("fill_seq").collect()
    assert [r["rolling_var"] is None for r in rows] == [True] * 4 + [False] * 6


def test_marts_null_policy(spark):
    bronze = spark.createDataFrame(
        [("7", "a", "BTC", "1.5", "x", "0", "Buy", "25-05-2026 10:00")],
        "`Trade ID` string, Account string, Coin string, `Execution Price` string, `Size USD` string, `Closed PnL` string, "
        "Direction string, `Timestamp IST` string")
    days = spark.createDataFrame([("2026-05-25", "40", "Fear")], "date string, value string, classification string")
    fact = marts.fact_trades(marts.stg_fills(bronze), marts.stg_sentiment(days))
    row = fact.first()
    assert row["trade_id"] == 7 and row["size_usd"] is None and row["sentiment_score"] == 40 and row["is_closing_trade"] == 0
    trader = marts.dim_traders(fact).first()
    assert trader["win_rate"] is None and trader["profit_factor"] is None and trader["total_trades"] == 1


def daily_silver(spark, days):
    return spark.range(days * 4).select(
        F.expr("date_add(date'2026-01-01', cast(id % {} as int))".format(days)).alias("date"),
        (F.sin("id") / 10).alias("roe"), (F.cos("id") * 100).alias("closed_pnl"), (F.col("id") * 10.0 + 1).alias("size_usd"),
        ((F.col("id") * 7) % 100).cast("double").alias("sentiment_score"))


def test_regimes_switch_from_rules_to_clusters_at_fifteen_days(spark):
    assert "cluster_id" not in regimes.market_regimes(daily_silver(spark, 14), seeds=(42,)).columns
    out = regimes.market_regimes(daily_silver(spark, 20), seeds=(42, 43))
    names = {"High Volatility / Turbulence", "Sideways Market", "Bull Market", "Bear Market"}
    rows = out.collect()
    assert len(rows) == 20 and {r["market_regime"] for r in rows} == names
    assert len({(r["cluster_id"], r["market_regime"]) for r in rows}) == 4


def test_latest_row(spark):
    daily = regimes.daily_macro(daily_silver(spark, 5))
    assert str(regimes.latest_row(daily).first()["date"]) == "2026-01-05"
    assert regimes.latest_row(daily.limit(0)).count() == 0
