"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewinds import schemas
from tradewinds.operators import quality as q, silver as sv
from tradewinds.plans import oracle
from tradewinds.plans.catalog import query
from tradewinds.plans.compare import real, steady
from tradewinds.plans.trade_queries import silver
from tradewinds.session import scratch_path
from tradewinds.sources.writers import write_table


def dirty_silver(spark, sf):
    """Silver with some NULLs: sizes of settlement rows and accounts of dust conversions."""
    s = silver(spark, sf)
    return s.withColumns({
        "size_usd": F.when(F.col("direction") != "Settlement", F.col("size_usd")),
        "account": F.when(F.col("direction") != "Spot Dust Conversion", F.col("account")),
    })


DIRTY_CTE = """
dirty as (select * replace (case when direction <> 'Settlement' then size_usd end as size_usd,
                            case when direction <> 'Spot Dust Conversion' then account end as account) from silver)"""


@query("null_checks", oracle.on_silver("""
select 'account' as column, count(*) - count(account) as null_count, count(*) = count(account) as passed from dirty
union all select 'trade_id', count(*) - count(trade_id), count(*) = count(trade_id) from dirty
union all select 'size_usd', count(*) - count(size_usd), count(*) = count(size_usd) from dirty
union all select 'closed_pnl', count(*) - count(closed_pnl), count(*) = count(closed_pnl) from dirty
union all select 'venue', -1, false""", DIRTY_CTE))
def null_checks(spark, sf):
    return q.null_checks(dirty_silver(spark, sf), [*q.KEY_COLUMNS, "venue"])


@query("duplicate_checks", oracle.on_silver("""
select 'trade_id' as key, cast(sum(c - 1) as bigint) as duplicate_count, sum(c - 1) = 0 as passed
from (select count(*) as c from silver group by trade_id)"""))
def duplicate_checks(spark, sf):
    return q.duplicate_checks(silver(spark, sf))


@query("schema_checks", oracle.on_silver("""
select 'coin' as "column", 'float' as expected, 'string' as actual, false as passed, count(coin) filter (try_cast(coin as double) is null) as bad_values from silver
union all select 'month', 'int', 'string', false, count(month) filter (try_cast(month as bigint) is null) from silver
union all select 'venue', 'string', 'missing', false, -1
union all select 'account', 'string', 'string', true, 0 union all select 'size_usd', 'float', 'double', true, 0"""))
def schema_checks(spark, sf):
    return q.schema_checks(silver(spark, sf), {"coin": "float", "month": "int", "venue": "string", "account": "string", "size_usd": "float"})


OUTLIER_SQL = """from silver cross join (select avg({c}) as mean, nullif(stddev_samp({c}), 0) as std from silver)
where abs(({c} - mean) / std) > 3"""


@query("zscore_outliers", oracle.on_silver(
    f"select trade_id, ts, closed_pnl, {real('(closed_pnl - mean) / std')} as z_score " + OUTLIER_SQL.format(c="closed_pnl")))
def zscore_outliers(spark, sf):
    rows = silver(spark, sf).select("trade_id", "ts", "closed_pnl")
    return steady(q.zscore_outliers(rows, "closed_pnl"), real=["z_score"])


def _outlier_part(c):
    return f"""select '{c}' as column, (select count(*) {OUTLIER_SQL.format(c=c)}) as outlier_count,
 {real(f'avg({c})')} as mean, {real(f'stddev_samp({c})')} as std from silver"""


@query("outlier_summary", oracle.on_silver(f"{_outlier_part('closed_pnl')} union all {_outlier_part('size_usd')}"))
def outlier_summary(spark, sf):
    return steady(q.outlier_summary(silver(spark, sf), ["closed_pnl", "size_usd"]), real=["mean", "std"])


DRIFT_CTE = """
drift as (
  select avg(sentiment_score) filter (i <= cut) as base, avg(sentiment_score) filter (i > cut) as recent, max(n) as n
  from (select *, cast(floor(n * 0.7e0) as bigint) as cut
        from (select sentiment_score, row_number() over (order by ts, fill_seq) as i, count(*) over () as n from silver)))"""


@query("sentiment_drift", oracle.on_silver(f"""
select {real('base')} as baseline_mean, {real('recent')} as recent_mean, {real('abs(recent - base)')} as mean_difference,
       abs(recent - base) > 15 as drift_detected from drift where n >= 100""", DRIFT_CTE))
def sentiment_drift(spark, sf):
    return steady(q.sentiment_drift(silver(spark, sf)), real=["baseline_mean", "recent_mean", "mean_difference"])


@query("data_quality_report", oracle.on_silver(f"""
select 'null' as "check", k as item, cast(n as double) as value, n = 0 as passed from (
  select 'account' as k, count(*) - count(account) as n from silver union all select 'trade_id', count(*) - count(trade_id) from silver
  union all select 'size_usd', count(*) - count(size_usd) from silver
  union all select 'closed_pnl', count(*) - count(closed_pnl) from silver)
union all select 'duplicate', 'trade_id', cast(sum(c - 1) as double), sum(c - 1) = 0 from (select count(*) as c from silver group by trade_id)
union all select 'schema', k, 0e0, true from (values {', '.join(f"('{c}')" for c in schemas.SILVER_EXPECTED)}) v(k)
union all select 'outlier', 'closed_pnl', (select cast(count(*) as double) {OUTLIER_SQL.format(c='closed_pnl')}), true
union all select 'outlier', 'size_usd', (select cast(count(*) as double) {OUTLIER_SQL.format(c='size_usd')}), true
union all select 'drift', 'sentiment_score', {real('abs(recent - base)')}, not (abs(recent - base) > 15) from drift
union all select 'overall', 'all', case when sum(c - 1) = 0 then 0e0 else 1e0 end, sum(c - 1) = 0
          from (select count(*) as c from silver group by trade_id)""", DRIFT_CTE))
def data_quality_report(spark, sf):
    return steady(q.data_quality_report(silver(spark, sf)), real=["value"])


@query("run_metrics", oracle.on_silver("""
select 'silver' as step, count(*) as records_processed, true as timed from silver
union all select 'realized', count(*), true from realized"""))
def run_metrics(spark, sf):
    """Rows of each step of a run; of its seconds only that they were taken, as they differ from run to run."""
    metrics = q.StepMetrics(spark)
    path = scratch_path(spark, "silver")
    with metrics.step("silver") as done:
        write_table(silver(spark, sf), path)
        done(spark.read.parquet(path))
    with metrics.step("realized") as done:
        done(sv.realized_trades(spark.read.parquet(path)))
    return metrics.table().select("step", "records_processed", (F.col("execution_time_seconds") > 0).alias("timed"))
