"""The driver contract, comparison SQL on the smallest tables, and the shape of the plans."""

import os
import re
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import TABLES, canonical  # noqa: E402
from tradewinds.operators import behavior, performance, silver as sv  # noqa: E402
from tradewinds.plans import testdata as td  # noqa: E402
from tradewinds.plans.trade_queries import silver  # noqa: E402

SF = "/root/testdata/sf0.001"

COMPARED = [
    "silver_trades", "fact_trades", "dim_traders", "sentiment_performance", "frequency_sizing", "leverage_correlation",
    "tail_risk_by_class", "risk_metrics_report", "rolling_var", "equity_curve", "drawdown_curve", "regime_rules",
    "trader_personas", "bias_prevalence", "clean_news", "jaccard_self_join", "lexicon_sentiment", "extract_entities",
    "impact_score", "sentiment_trends", "daily_brief", "data_quality_report", "trader_features", "classification_metrics",
    "linear_attribution", "read_fills", "article_id", "sliding_risk", "risk_contribution", "bounded_sizes", "monthly_by_trader",
    "encode_features", "stratified_folds", "value_at_risk", "expected_shortfall", "global_equity_curve", "schema_checks", "batch_sentiment",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100


def test_entry(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("name", COMPARED)
def test_matches_sql(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = ["silver_trades", "coin_overall", "trader_overall", "leverage_correlation", "kpi_summary", "lexicon_sentiment",
        "extract_entities", "impact_score", "zscore_outliers", "linear_attribution", "dim_traders", "stratified_split"]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for node in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node


@pytest.mark.parametrize("name", ["coin_overall", "trader_overall", "dim_traders", "stratified_split"])
def test_no_single_task_over_trades(spark, name):
    # none of these needs the sentiment, so not even the window over calendar days is left
    assert "SinglePartition" not in plan(entry.queries()[name](spark, SF))


def test_text_scoring_does_not_shuffle(spark):
    for name in ("lexicon_sentiment", "extract_entities", "impact_score"):
        assert not re.search(r"Exchange (hash|range|Single)", plan(entry.queries()[name](spark, SF)))


def test_scan_reads_only_what_is_needed(spark):
    text = plan(td.fills(spark, SF).select("trade_id", "size_usd").where("size_usd > 1000"))
    assert "l_tax" not in text.split("ReadSchema")[1] and "GreaterThan(l_extendedprice,1000.0)" in text
    assert "p_retailprice" not in text and "o_orderdate" not in text


def test_filters_reach_the_silver_table(spark, toy, tmp_path):
    from tradewinds.sources.writers import write_table

    write_table(toy.withColumn("month", toy["sentiment_class"]), str(tmp_path / "s"), ["month"])
    table = spark.read.parquet(str(tmp_path / "s"))
    text = plan(sv.realized_trades(sv.filter_trades(table, accounts=["A"])).where("month = 'Greed'").select("closed_pnl"))
    assert "In(account" in text or "EqualTo(account" in text
    assert "PartitionFilters: [isnotnull(month" in text
    assert "ReadSchema: struct<account:string,closed_pnl:double,is_closing_trade:boolean>" in text


def test_behaviour_meets_accounts_in_blocks(spark):
    """Trades are shuffled by (account, day) and by (account, block); by account alone only rows that are summed up already."""
    text = plan(behavior.trader_personas(silver(spark, SF)))
    assert "hashpartitioning(_cell" in text and re.search(r"Exchange hashpartitioning\(account#\d+, _block#", text)
    for line in text.splitlines():
        if re.search(r"Exchange hashpartitioning\(account#\d+, \d+\)", line):
            assert "closed_pnl" not in line
    assert "SinglePartition" not in text


def test_performance_is_one_aggregation(spark):
    text = plan(performance.trader_overall(silver(spark, SF)))
    assert text.count("Exchange hashpartitioning(account") == 1
