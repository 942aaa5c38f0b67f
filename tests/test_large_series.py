"""Scans in two levels and rank searches must give exactly what plain windows and buffers give."""

import pytest
from pyspark.sql import Window, functions as F

from tradewinds.operators import behavior, curves, learn, ordered, quality, risk
from tradewinds.operators.percentiles import agg_with_percentiles, exact_percentiles

ORDER = ["ts", "fill_seq"]


@pytest.fixture(scope="module")
def trades(spark):
    """4,000 trades; one account holds more than half, many share a timestamp."""
    df = spark.range(4000).select(
        F.when(F.col("id") % 5 < 3, F.lit("hot")).otherwise(F.concat(F.lit("a"), (F.col("id") % 37).cast("string"))).alias("account"),
        F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id % 50 as int))").alias("ts"),
        F.col("id").alias("fill_seq"),
        F.round(F.sin(F.col("id") * 1.7) * 100 + 10, 2).alias("closed_pnl"),
        (F.abs(F.cos("id")) * 1000 + 1).alias("size_usd"),
        (F.col("id") % 20 + 1).cast("int").alias("leverage"),
        (F.col("id") % 101).cast("double").alias("sentiment_score"),
        F.element_at(F.array(F.lit("Fear"), F.lit("Greed")), (F.col("id") % 2 + 1).cast("int")).alias("sentiment_class"))
    out = df.withColumns({
        "win_flag": (F.col("closed_pnl") > 0).cast("int"), "is_closing_trade": F.lit(True),
        "pnl_pct": F.col("closed_pnl") / 100000, "roe": F.col("closed_pnl") / 1000, "date": F.to_date("ts")})
    return out.persist()


def same(a, b, keys, cols):
    left = {tuple(r[k] for k in keys): r for r in a.collect()}
    right = {tuple(r[k] for k in keys): r for r in b.collect()}
    assert left.keys() == right.keys()
    for k, r in left.items():
        for c in cols:
            assert (r[c] is None) == (right[k][c] is None), (k, c)
            if r[c] is not None:
                assert r[c] == pytest.approx(right[k][c], rel=1e-9, abs=1e-9), (k, c)


SPANS = ["hour", "day", "year"]


def plain(trades, keys):
    """What windows over whole series give."""
    w = Window.partitionBy(*keys).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    return trades.withColumns({
        "s": F.sum("closed_pnl").over(w), "m": F.max("closed_pnl").over(w), "c": F.count(F.lit(1)).over(w),
        "p": F.product(1 + F.col("pnl_pct")).over(w), "cumulative": F.sum("closed_pnl").over(w)}).withColumn(
        "peak", F.max("cumulative").over(w)).withColumn("drawdown", F.col("cumulative") - F.col("peak"))


def jobs(spark, build):
    """Jobs that run while a query is built."""
    sc = spark.sparkContext
    sc.setJobGroup("counted", "")
    try:
        out = build()
        return out, len(sc.statusTracker().getJobIdsForGroup("counted"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_blocks_cut_the_hot_key_evenly(spark, trades):
    blocks = ordered.blocks(trades, ["account"], ORDER, rows=300)
    sizes = [r["count"] for r in blocks.groupBy("account", ordered.BLOCK).count().collect()]
    assert max(sizes) == 300 and sum(sizes) == 4000
    assert blocks.where("account = 'hot'").select(ordered.BLOCK).distinct().count() == 8


def test_a_hot_key_spreads_over_tasks(spark, trades):
    """Rows meet by (key, span): half of all rows under one key do not meet in one task."""
    numbered = ordered.running(trades, ["account"], ORDER, {"c": ("count", None)}, "hour")
    text = numbered._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_cell" in text
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = ordered.cells(trades, ["account"], ORDER, "hour").repartition(*ordered.CELL).withColumn("task", F.spark_partition_id())
        assert rows.where("account = 'hot'").groupBy("task").count().agg(F.max("count")).first()[0] < 0.4 * 2400
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("span", SPANS)
@pytest.mark.parametrize("keys", [["account"], []])
def test_running(spark, trades, keys, span):
    specs = {"s": ("sum", F.col("closed_pnl")), "m": ("max", F.col("closed_pnl")), "c": ("count", None),
             "p": ("product", 1 + F.col("pnl_pct"))}
    found = ordered.running(trades, keys, ORDER, specs, span)
    same(plain(trades, keys), found, ["fill_seq"], list(specs))
    assert found.columns == [*trades.columns, *specs]


@pytest.mark.parametrize("span", SPANS)
@pytest.mark.parametrize("keys", [["account"], ["sentiment_class"]])
def test_drawdowns(spark, trades, keys, span):
    curve = ordered.drawdown_curve(trades, keys, ORDER, "closed_pnl", span)
    same(plain(trades, keys), curve, ["fill_seq"], ["cumulative", "peak", "drawdown"])
    found = ordered.max_drawdown(trades, keys, ORDER, {"usd": "closed_pnl", "roe": "roe"}, span)
    lows = {r[keys[0]]: r["d"] for r in plain(trades, keys).groupBy(*keys).agg(F.min("drawdown").alias("d")).collect()}
    assert {r[keys[0]]: pytest.approx(r["usd"]) for r in found.collect()} == lows


def test_drawdown_states_merge_over_parts(spark, trades):
    """States of two halves of the time, taken together, are the states of the whole."""
    values, keys = {"usd": "closed_pnl"}, ["account"]
    early = trades.where("ts < '2026-01-02'")
    late = trades.where("ts >= '2026-01-02'")
    states = ordered.drawdown_states(early, keys, ORDER, values).unionByName(ordered.drawdown_states(late, keys, ORDER, values))
    same(ordered.max_drawdown(trades, keys, ORDER, values), ordered.merged_drawdowns(states, keys, ["usd"]), keys, ["usd"])


@pytest.mark.parametrize("rows", [300, 25, 1])
def test_sequences_and_rolling_var(spark, trades, rows):
    w = Window.partitionBy("account").orderBy(*ORDER)
    want = trades.withColumns({
        "next_size_usd": F.lead("size_usd").over(w), "next_leverage": F.lead("leverage").over(w),
        "on_streak": F.sum("win_flag").over(w.rowsBetween(-2, 0)) == 3})
    same(want, behavior.trade_sequence(trades, rows=rows), ["fill_seq"], ["next_size_usd", "next_leverage", "on_streak"])
    for n in (3, 30, 90):
        frame, size = w.rowsBetween(1 - n, 0), F.count(F.lit(1)).over(Window.partitionBy("account"))
        var = F.percentile("closed_pnl", F.lit(0.05))
        want = trades.withColumn("rolling_var", F.when(size < n, var.over(Window.partitionBy("account"))).when(
            F.count(F.lit(1)).over(frame) == n, var.over(frame)))
        same(want, risk.rolling_var(trades, ["account"], n=n, rows=max(rows, 10)), ["fill_seq"], ["rolling_var"])


def test_nothing_runs_while_queries_are_built(spark, trades):
    built = {
        "personas": lambda: behavior.trader_personas(trades), "report": lambda: risk.risk_metrics_report(trades),
        "curve": lambda: curves.equity_curve(trades), "var": lambda: risk.rolling_var(trades, ["account"]),
        "downsample": lambda: curves.downsample(trades), "drift": lambda: quality.sentiment_drift(trades),
        "split": lambda: learn.stratified_split_exact(trades), "tail": lambda: risk.tail_risk_by_class(trades),
        "shortfall": lambda: risk.expected_shortfall(trades, ["account"], "closed_pnl", {"es": 0.95}),
        "metrics": lambda: learn.classification_metrics(trades.selectExpr("win_flag", "win_flag as prediction", "sentiment_score / 100 as probability"))}
    for name, build in built.items():
        assert jobs(spark, build)[1] == 0, name


def test_downsample(spark, trades):
    found = [r["fill_seq"] for r in curves.downsample(trades, target=100).orderBy(*ORDER).collect()]
    assert found == [r["fill_seq"] for r in trades.orderBy(*ORDER).collect()][::40]


def test_split_and_auc(spark, trades):
    found = learn.stratified_split_exact(trades).groupBy("win_flag").agg(F.count_if("is_test").alias("t"), F.count(F.lit(1)).alias("n")).collect()
    assert all(r["t"] == round(r["n"] * 0.3) for r in found)
    scored = trades.withColumn("probability", F.col("sentiment_score") / 100)
    rows = scored.select("win_flag", "probability").collect()
    pos = [r[1] for r in rows if r[0] == 1]
    neg = [r[1] for r in rows if r[0] == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert learn.roc_auc(scored).first()[0] == pytest.approx(brute)


def test_drift(spark, trades):
    rows = [r["sentiment_score"] for r in trades.orderBy(*ORDER).collect()]
    base, rest = rows[:2800], rows[2800:]
    out = quality.sentiment_drift(trades).first()
    assert out["baseline_mean"] == pytest.approx(sum(base) / len(base))
    assert out["recent_mean"] == pytest.approx(sum(rest) / len(rest))
    assert quality.sentiment_drift(trades.limit(0)).count() == 0


VALUES = {
    "given": "closed_pnl", "few": "cast(leverage as double)", "one": "2.5D", "wide": "exp(closed_pnl * 5) * if(fill_seq % 2 = 0, -1, 1)",
    "zeros": "if(fill_seq % 3 = 0, closed_pnl, 0D)", "nulls": "if(account = 'hot', closed_pnl, null)", "tiny": "closed_pnl * 1e-300",
}


@pytest.mark.parametrize("values", VALUES)
@pytest.mark.parametrize("keys", [["sentiment_class"], ["account"], []])
def test_exact_percentiles(spark, trades, keys, values):
    wanted = {"p0": 0.0, "p1": 0.01, "p5": 0.05, "med": 0.5, "p999": 0.999, "top": 1.0}
    rows = trades.withColumn("x", F.expr(VALUES[values]))
    want = rows.where("x is not null").groupBy(*keys).agg(*[F.percentile("x", F.lit(p)).alias(n) for n, p in wanted.items()])
    same(want, exact_percentiles(rows, keys, "x", wanted), keys, list(wanted))


def test_tails_and_null_groups(spark, trades):
    rows = trades.withColumn("account", F.when(F.col("account") != "hot", F.col("account")))
    out = agg_with_percentiles(rows, ["account"], [F.count(F.lit(1)).alias("n")], {"var": ("closed_pnl", 0.05)}, {"cvar": "var"})
    groups = {}
    for r in rows.collect():
        groups.setdefault(r["account"], []).append(r["closed_pnl"])
    for r in out.collect():
        values = groups.pop(r["account"])
        below = [v for v in values if v <= r["var"]]
        assert r["n"] == len(values) and r["cvar"] == pytest.approx(sum(below) / len(below))
    assert not groups


def test_values_at_the_ends_of_numbers(spark):
    rows = [float("inf"), float("-inf"), float("nan"), 0.0, -0.0, 1e308, -1e308, 5e-324, 1.0, 2.0]
    df = spark.createDataFrame([(v,) for v in rows], "x double")
    wanted = {f"p{i}": i / 9 for i in range(10)}
    got = exact_percentiles(df, [], "x", wanted).first()
    want = df.agg(*[F.percentile("x", F.lit(p)).alias(n) for n, p in wanted.items()]).first()
    assert str(got) == str(want).replace("-0.0", "0.0")


def test_null_keys_keep_their_series(spark, trades):
    with_null = trades.withColumn("account", F.when(F.col("account") != "hot", F.col("account")))
    specs = {"s": ("sum", F.col("closed_pnl"))}
    same(plain(with_null, ["account"]), ordered.running(with_null, ["account"], ORDER, specs), ["fill_seq"], ["s"])
