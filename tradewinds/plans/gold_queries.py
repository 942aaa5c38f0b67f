"""Ledgers merged from stored monthly states, the last month of which arrives late."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewinds.operators import gold_states
from tradewinds.plans import oracle
from tradewinds.plans.catalog import query
from tradewinds.plans.compare import coarse, pnl, real, steady
from tradewinds.plans.trade_queries import silver
from tradewinds.session import scratch_path

REALS = ["win_rate", "avg_roe", "volatility", "profit_factor", "avg_leverage"]
COARSE = ["avg_pnl", "std_pnl"]
MONEY = ["total_pnl", "volume", "max_drawdown"]


def _ledger(name: str, keys: list[str]) -> None:
    by = ", ".join(keys)
    join = " and ".join(f"a.{k} = d.{k}" for k in keys)

    @query(f"monthly_{name}", oracle.on_silver(f"""
select {", ".join(f"a.{k}" for k in keys)}, trade_count, {pnl('total_pnl')} as total_pnl, {coarse('avg_pnl')} as avg_pnl, {coarse('std_pnl')} as std_pnl,
       {real('win_rate')} as win_rate, {pnl('volume')} as volume, {real('avg_roe')} as avg_roe, {real('volatility')} as volatility,
       {real('profit_factor')} as profit_factor, active_days, {real('avg_leverage')} as avg_leverage, worst_loss, best_win, {pnl('max_drawdown')} as max_drawdown
from (select {by}, count(*) as trade_count, sum(closed_pnl) as total_pnl, avg(closed_pnl) as avg_pnl, stddev_samp(closed_pnl) as std_pnl,
             avg(win_flag) as win_rate, sum(size_usd) as volume, avg(roe) as avg_roe, stddev_samp(roe) as volatility,
             coalesce(sum(closed_pnl) filter (closed_pnl > 0), 0) / nullif(-sum(closed_pnl) filter (closed_pnl < 0), 0) as profit_factor,
             count(distinct date) as active_days, avg(leverage) as avg_leverage, min(closed_pnl) as worst_loss, max(closed_pnl) as best_win
      from realized group by {by}) a
join (select {by}, min(cum - peak) as max_drawdown from (
        select *, max(cum) over (partition by {by} order by ts, fill_seq rows unbounded preceding) as peak from (
          select *, sum(closed_pnl) over (partition by {by} order by ts, fill_seq rows unbounded preceding) as cum from realized))
      group by {by}) d on {join}"""))
    def run(spark, sf):
        gold, rows = scratch_path(spark, "gold"), silver(spark, sf)
        last = rows.agg(F.max("month")).first()[0]
        ledger = {name: keys}
        gold_states.refresh(spark, rows.where(F.col("month") != last), gold, ledgers=ledger)
        gold_states.refresh(spark, rows, gold, [last], ledger)
        return steady(spark.read.parquet(f"{gold}/{name}"), real=REALS, coarse=COARSE, pnl=MONEY)


for _name, _keys in gold_states.LEDGERS.items():
    _ledger(_name, _keys)
