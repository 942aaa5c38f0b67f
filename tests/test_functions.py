import math

import pytest
from pyspark.sql import functions as F

from tradewinds import vocab
from tradewinds.functions import risk, sizing, text, trade


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_fill_time_and_direction(spark):
    rows = spark.createDataFrame(
        [("25-05-2026 10:00", "Buy"), ("2026-05-25", "Liquidated Isolated Short"), (None, None)], "t string, d string")
    out = rows.select(trade.fill_time("t").isNotNull().alias("ok"), trade.trade_direction("d").alias("side")).collect()
    assert [r["ok"] for r in out] == [True, False, False]
    assert [r["side"] for r in out] == ["Long", "Short", "Other"]


def test_pnl_flags_handle_null_and_zero(spark):
    rows = spark.createDataFrame([(None, 10.0), (0.0, 10.0), (5.0, 0.0), (-5.0, 10.0)], "closed_pnl double, size_usd double")
    out = rows.select(trade.is_closing().alias("c"), trade.win_flag().alias("w"), trade.pnl_pct().alias("p")).collect()
    assert [r["c"] for r in out] == [False, False, True, True]
    assert [r["w"] for r in out] == [0, 0, 1, 0]
    assert [r["p"] for r in out] == [None, 0.0, 0.0, -0.5]


def test_leverage_tiers_follow_their_probabilities(spark):
    n = 20000
    sizes = {60000.0: 0, 20000.0: 1, 5000.0: 2, 100.0: 3}
    for size, tier in sizes.items():
        df = spark.range(n).select(F.col("id").alias("trade_id"), F.lit(size).alias("size_usd"), F.current_timestamp().alias("ts"))
        counts = df.withColumn("u", trade.leverage_uniform()).groupBy(trade.leverage_for("u").alias("l")).count().collect()
        _, choices, weights = vocab.LEVERAGE_TIERS[tier]
        got = {r["l"]: r["count"] / n for r in counts}
        assert set(got) == set(choices)
        for choice, weight in zip(choices, weights):
            assert abs(got[choice] - weight) < 0.015


def test_leverage_without_id_uses_the_time_and_null_size_the_last_tier(spark):
    df = spark.sql("select cast(null as bigint) trade_id, cast(null as double) size_usd, timestamp'2026-01-01 00:00:00' ts")
    value = df.withColumn("u", trade.leverage_uniform()).select(trade.leverage_for("u").alias("l")).first()["l"]
    assert value in vocab.LEVERAGE_TIERS[-1][1]


def test_leverage_bucket_edges(spark):
    df = spark.createDataFrame([(3,), (4,), (10,), (11,), (20,), (21,)], "leverage int")
    got = [r[0] for r in df.select(trade.leverage_bucket()).collect()]
    low, mid, high, extreme = vocab.BUCKET_LABELS
    assert got == [low, mid, mid, high, high, extreme]


@pytest.mark.parametrize("policy,expected", [("inf", math.inf), ("null", None), (1.0, 1.0)])
def test_profit_factor_without_losses(spark, policy, expected):
    df = spark.createDataFrame([(1.0,), (2.0,)], "closed_pnl double")
    assert df.agg(risk.profit_factor(no_loss=policy).alias("v")).first()["v"] == expected


def test_profit_factor_of_nothing_is_nan(spark):
    df = spark.createDataFrame([(0.0,)], "closed_pnl double")
    assert math.isnan(df.agg(risk.profit_factor().alias("v")).first()["v"])


RETURNS = [.01, .02, -.015, .03, -.005, .01, .02, -.01, .015, .025]


def test_risk_ratios_on_known_returns(spark):
    df = spark.createDataFrame([(r,) for r in RETURNS], "r double")
    row = df.agg(
        risk.volatility("r").alias("vol"), risk.downside_deviation("r").alias("dd"),
        risk.sharpe_ratio("r", factor=1.0).alias("sharpe"), risk.sortino_ratio("r", factor=1.0).alias("sortino")).first()
    mean = sum(RETURNS) / 10
    vol = math.sqrt(sum((r - mean) ** 2 for r in RETURNS) / 9)
    down = math.sqrt(sum(r * r for r in RETURNS if r < 0) / 9)
    assert row["vol"] == pytest.approx(vol) and row["dd"] == pytest.approx(down)
    assert row["sharpe"] == pytest.approx(mean / vol) and row["sortino"] == pytest.approx(mean / down)


def test_ratios_of_one_row_are_zero(spark):
    df = spark.createDataFrame([(0.1,)], "r double")
    assert list(df.agg(risk.volatility("r"), risk.downside_deviation("r"), risk.sharpe_ratio("r"), risk.sortino_ratio("r")).first()) == [0.0] * 4


def test_calmar(spark):
    assert one(spark, risk.calmar_ratio(F.lit(0.15), F.lit(-0.05))) == pytest.approx(3.0)
    assert one(spark, risk.calmar_ratio(F.lit(0.15), F.lit(0.0))) == 0.0


def test_sizing(spark):
    assert one(spark, sizing.size_fixed_fractional(F.lit(100000.0), 0.02)) == 2000.0
    assert one(spark, sizing.kelly_fraction(F.lit(0.6), F.lit(200.0), F.lit(100.0))) == pytest.approx(0.2)
    assert one(spark, sizing.kelly_fraction(F.lit(0.6), F.lit(200.0), F.lit(0.0))) == 0.0
    assert one(spark, sizing.kelly_fraction(F.lit(0.6), F.lit(0.0), F.lit(10.0))) == 0.0
    assert one(spark, sizing.kelly_fraction(F.lit(0.1), F.lit(1.0), F.lit(1.0))) == 0.0
    assert one(spark, sizing.size_vol_adjusted(F.lit(100000.0), F.lit(0.001))) == 50000.0
    assert one(spark, sizing.size_vol_adjusted(F.lit(100000.0), F.lit(0.0))) == 1000.0
    expected = {20: 2.0, 25: 1.25, 45: 1.0, 55: 1.0, 56: 0.75, 75: 0.75, 76: 0.25}
    for score, multiplier in expected.items():
        assert one(spark, sizing.size_sentiment_adjusted(F.lit(5000.0), F.lit(score))) == 5000.0 * multiplier


@pytest.mark.parametrize("score,vol,roe,regime", [
    (85, .05, .02, "Bull Market"), (50, .2, 0.0, "High Volatility / Turbulence"), (10, .05, -.06, "High Volatility / Turbulence"),
    (85, .05, .06, "High Volatility / Turbulence"), (30, .05, 0.0, "Bear Market"), (30, .05, .02, "Sideways Market"),
    (50, .05, 0.0, "Sideways Market"), (60, .05, -.02, "Sideways Market")])
def test_regime_rules(spark, score, vol, roe, regime):
    assert one(spark, sizing.regime_rule(F.lit(score), F.lit(vol), F.lit(roe))) == regime


def test_clean_and_tokenize(spark):
    dirty = "Rally \U0001F680 in <b>BTC</b> see https://x.io/a?b=1 and www.y.com now, up 5% at $3.50!"
    df = spark.createDataFrame([(dirty,)], "t string").withColumn("c", text.clean_text("t"))
    row = df.select("c", text.tokenize("c").alias("tok"), text.content_tokens("c").alias("fin")).first()
    assert "http" not in row["c"] and "www" not in row["c"] and "<" not in row["c"] and row["c"].isascii()
    assert row["tok"] == ["rally", "in", "btc", "see", "and", "now", "up", "5", "at", "3.50"]
    assert row["fin"] == ["rally", "btc", "see", "now", "3.50"]


def test_stem_rules_keep_empty_tokens(spark):
    df = spark.createDataFrame([(["coins", "loss", "ed", "ing", "ss", "us", "hacked", "rising", "x", "the"],)], "t array<string>")
    assert df.select(text.light_stem(text.remove_stop_words("t")).alias("v")).first()["v"] == [
        "coin", "loss", "", "", "ss", "u", "hack", "ris"]


def test_jaccard_edges(spark):
    df = spark.createDataFrame([([], ["a"]), (["a", "a", "b"], ["b", "c"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(text.jaccard("a", "b")).collect()] == [0.0, pytest.approx(1 / 3)]


def test_theme_ties_go_to_the_first_theme(spark):
    df = spark.createDataFrame([(["treasury"],), (["nothing"],), (["hack", "hacked", "sec"],), (["x", "liquidity"],)], "w array<string>")
    assert [r[0] for r in df.select(text.theme_of_words("w")).collect()] == [
        "Regulation", "Macroeconomic Events", "Security Breaches", "Exchange Activity"]


def test_keyword_hits_respect_word_boundaries(spark):
    df = spark.createDataFrame([("The US Federal Reserve and self-custody of fedex",)], "t string")
    got = df.select(text.keyword_hits("t", ["us", "fed", "federal reserve", "self-custody", "reserve"]).alias("v")).first()["v"]
    assert sorted(got) == ["federal reserve", "reserve", "self-custody", "us"]
