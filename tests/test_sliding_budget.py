"""Sliding ratios, risk contribution and as-of sizes against plain Python."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tradewinds.operators import ordered, risk_budget, sliding


@pytest.fixture(scope="module")
def trades(spark):
    pick = random.Random(4)
    rows = [(("hot" if i % 5 < 3 else f"a{i % 7}"), i // 3, i, round(pick.gauss(0, 100), 2), round(pick.gauss(0, 0.1), 4),
             pick.choice(["BTC", "ETH", "SOL"]), 1000.0 + i, i % 20 + 1, float(i % 101)) for i in range(900)]
    df = spark.createDataFrame(rows, "account string, hour int, fill_seq long, closed_pnl double, roe double, coin string, size_usd double, leverage int, sentiment_score double")
    return df.withColumns({"ts": F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, hour)")}).withColumn("date", F.to_date("ts")).persist()


def series(trades):
    out = {}
    for r in trades.orderBy("ts", "fill_seq").collect():
        out.setdefault(r["account"], []).append(r)
    return out


def percentile(values, p):
    values = sorted(values)
    place = p * (len(values) - 1)
    low = int(place)
    return values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (place - low)


@pytest.mark.parametrize("n, rows", [(30, 1 << 16), (30, 40), (7, 10), (2, 3), (1, 5)])
def test_sliding_risk(spark, trades, n, rows):
    got = {r["fill_seq"]: r for r in sliding.sliding_risk(trades, ["account"], n=n, rows=rows).collect()}
    assert len(got) == 900
    for rows_ in series(trades).values():
        for i, r in enumerate(rows_):
            g = got[r["fill_seq"]]
            if i < n - 1:
                assert g["sliding_volatility"] is None and g["sliding_max_drawdown"] is None and g["sliding_shortfall"] is None
                continue
            frame = rows_[i - n + 1:i + 1]
            x, pnl = [f["roe"] for f in frame], [f["closed_pnl"] for f in frame]
            total, peak, fall = 0.0, None, 0.0
            for v in x:
                total += v
                peak = total if peak is None else max(peak, total)
                fall = min(fall, total - peak)
            cut = percentile(pnl, 0.05)
            tail = [v for v in pnl if v <= cut]
            vol = statistics.stdev(x) if n > 1 else 0.0
            low = [v for v in x if v < 0]
            down = (sum(v * v for v in low) / (n - 1)) ** 0.5 if len(low) >= 2 else 0.0
            mean = sum(x) / n
            assert g["sliding_max_drawdown"] == pytest.approx(fall, abs=1e-9)
            assert g["sliding_shortfall"] == pytest.approx(sum(tail) / len(tail))
            assert (g["sliding_volatility"], g["sliding_downside"]) == pytest.approx((vol, down), abs=1e-9)
            assert g["sliding_sharpe"] == pytest.approx(mean / vol * 365 ** 0.5 if vol > 0 else 0.0, abs=1e-6)
            assert g["sliding_sortino"] == pytest.approx(mean / down * 365 ** 0.5 if down > 0 else 0.0, abs=1e-6)


def test_contributions_add_up(spark, trades):
    got = risk_budget.risk_contribution(trades).collect()
    cells = {}
    for rows_ in series(trades).values():
        for r in rows_:
            cells.setdefault(r["account"], {}).setdefault(r["date"], {}).setdefault(r["coin"], []).append(r["closed_pnl"])
    for account, days in cells.items():
        totals = [sum(sum(v) for v in day.values()) for day in days.values()]
        vol = statistics.stdev(totals)
        mine = [g for g in got if g["account"] == account]
        assert sum(g["contribution"] for g in mine) == pytest.approx(vol) and sum(g["share"] for g in mine) == pytest.approx(1)
        for g in mine:
            x = [sum(day.get(g["coin"], [0.0])) for day in days.values()]
            assert g["contribution"] == pytest.approx(statistics.covariance(x, totals) / vol)
            assert g["part_volatility"] == pytest.approx(statistics.stdev(x))
    budget = risk_budget.within_budget(risk_budget.risk_contribution(trades), 0.4).collect()
    assert all(b["size_factor"] == (pytest.approx(0.4 / b["share"]) if b["share"] > 0.4 else 1.0) and b["over_budget"] == (b["share"] > 0.4) for b in budget)


def test_a_single_day_has_no_shares(spark, trades):
    out = risk_budget.risk_contribution(trades.where("date = '2026-01-01'")).collect()
    assert out and all(r["share"] is None and r["contribution"] == 0.0 for r in out)


@pytest.mark.parametrize("span", ["hour", "day", "year"])
def test_asof(spark, trades, span):
    told = trades.where("fill_seq % 4 = 0").select("account", "ts", "fill_seq", F.col("closed_pnl").alias("level"))
    got = {r["fill_seq"]: r["known"] for r in ordered.asof(trades, told, ["account"], "ts", "fill_seq", {"known": "level"}, span).collect()}
    events = [r for rows_ in series(told.withColumn("x", F.lit(1))).values() for r in rows_]
    assert len(got) == 900
    for rows_ in series(trades).values():
        for r in rows_:
            before = [e for e in events if e["account"] == r["account"] and e["ts"] < r["ts"]]
            want = max(before, key=lambda e: (e["ts"], e["fill_seq"]))["level"] if before else None
            assert got[r["fill_seq"]] == want


def test_sizes_shrink_to_the_limit(spark, trades):
    risks = trades.select("account", "ts", "fill_seq", F.lit(-1000.0).alias("rolling_var"))
    for r in risk_budget.bounded_sizes(trades, risks).collect():
        assert r["bounded_size"] == (pytest.approx(r["size_usd"] / 2) if r["known_var"] is not None else r["size_usd"])
        cap = 2.0 if r["sentiment_score"] > 75 else 5.0 if r["sentiment_score"] < 30 else 1e9
        assert r["bounded_leverage"] == min(float(r["leverage"]), cap)


def test_a_frame_is_sorted_once(trades):
    plan = sliding.sliding_risk(trades, ["account"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array(") == 1
