"""Behavioural-bias queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewinds.operators import behavior as b, silver as sv
from tradewinds.plans import oracle
from tradewinds.plans.catalog import query
from tradewinds.plans.compare import pnl, real, steady
from tradewinds.plans.trade_queries import silver

SEQUENCE_CTE = """
sequenced as (
  select *, lead(size_usd) over w as next_size_usd, lead(leverage) over w as next_leverage, lead(ts) over w as next_ts,
         sum(win_flag) over (partition by account order by ts, fill_seq rows between 2 preceding and current row) = 3 as on_streak
  from realized window w as (partition by account order by ts, fill_seq))"""

PERSONA_CTE = """
base as (
  select account, count(*) as trade_count, avg(leverage) as avg_leverage, avg(size_usd) as avg_trade_size,
         sum(closed_pnl) as total_realized_pnl, avg(win_flag) as win_rate,
         coalesce(sum(closed_pnl) filter (closed_pnl > 0), 0e0) as gains,
         coalesce(-sum(closed_pnl) filter (closed_pnl < 0), 0e0) as losses,
         coalesce(abs(avg(closed_pnl) filter (closed_pnl < 0)), 10e0) as avg_loss,
         count(*) filter (sentiment_score > 55) as greed_n,
         avg(leverage) filter (sentiment_score > 55) as greed_lev, avg(size_usd) filter (sentiment_score > 55) as greed_size,
         count(*) filter (sentiment_score < 40) as fear_n, avg(win_flag) filter (sentiment_score < 40) as fear_win,
         coalesce(abs(avg(closed_pnl) filter (sentiment_score < 40 and closed_pnl < 0)), 0e0) as fear_loss
  from realized group by account having count(*) >= 5),
flags as (
  select b.*,
         case when greed_n > 2 and (greed_lev / avg_leverage > 1.2e0 or greed_size / avg_trade_size > 1.2e0) then 1 else 0 end as fomo_bias,
         case when fear_n > 2 and fear_win < 0.35e0 and fear_loss / avg_loss > 1.2e0 then 1 else 0 end as panic_bias,
         coalesce(s.over_flag, 0) as overconfidence_bias, coalesce(s.chase_flag, 0) as loss_chasing_bias
  from base b left join (
    select q.account,
           max(case when on_streak and (next_size_usd / avg_trade_size > 1.25e0 or next_leverage / avg_leverage > 1.25e0) then 1 else 0 end) as over_flag,
           max(case when win_flag = 0 and next_ts <= ts + interval '24' hour
                     and (next_size_usd > size_usd * 1.2e0 or next_leverage > leverage) then 1 else 0 end) as chase_flag
    from sequenced q join base b2 on q.account = b2.account group by q.account) s on s.account = b.account),
scored as (
  select *, 10e0 + 15 * fomo_bias + 25 * panic_bias + 30 * overconfidence_bias + 30 * loss_chasing_bias as behavioral_risk_score,
         case when losses > 0 then gains / losses else 1e0 end as pf from flags),
personas as (
  select *, case when avg_leverage <= 3 and pf >= 1.8e0 then 'Institutional Trader'
                 when avg_leverage >= 15 and total_realized_pnl < 0 then 'High-Leverage Speculator'
                 when fomo_bias = 1 and total_realized_pnl > 0 then 'Momentum Chaser'
                 when panic_bias = 1 and win_rate < 0.40e0 then 'Fear-Driven Trader'
                 when fear_n > trade_count * 0.4e0 and pf >= 1.5e0 then 'Contrarian Trader'
                 else 'Systematic Trader' end as trader_archetype
  from scored)"""

NUMBERS = ["win_rate", "avg_leverage", "avg_trade_size", "avg_realized_pnl"]
NUMBER_SQL = f"""{pnl('total_realized_pnl')} as total_realized_pnl, {real('win_rate')} as win_rate,
 {real('avg_leverage')} as avg_leverage, {real('avg_trade_size')} as avg_trade_size, trade_count"""
FLAG_SQL = "fomo_bias, panic_bias, overconfidence_bias, loss_chasing_bias"


def personas(spark, sf):
    return b.trader_personas(silver(spark, sf))


def _persona_query(name, body, build):
    @query(name, oracle.on_silver(body, SEQUENCE_CTE, PERSONA_CTE))
    def run(spark, sf):
        return steady(build(personas(spark, sf)), pnl=["total_realized_pnl"], real=NUMBERS)


@query("next_trade", oracle.on_silver(
    "select account, trade_id, ts, next_size_usd, cast(next_leverage as double) as next_leverage, next_ts from sequenced",
    SEQUENCE_CTE))
def next_trade(spark, sf):
    rows = b.trade_sequence(sv.realized_trades(silver(spark, sf)))
    return rows.select("account", "trade_id", "ts", "next_size_usd", F.col("next_leverage").cast("double").alias("next_leverage"),
                       "next_ts")


@query("win_streak", oracle.on_silver("select account, trade_id, ts, on_streak from sequenced", SEQUENCE_CTE))
def win_streak(spark, sf):
    return b.trade_sequence(sv.realized_trades(silver(spark, sf))).select("account", "trade_id", "ts", "on_streak")


for _flag in b.BIASES:
    _persona_query(_flag, f"select account, {_flag} from personas", lambda p, f=_flag: p.select("account", f))

_persona_query("behavioral_risk_score", "select account, behavioral_risk_score from personas",
               lambda p: p.select("account", "behavioral_risk_score"))
_persona_query("trader_archetype", "select account, trader_archetype from personas",
               lambda p: p.select("account", "trader_archetype"))
_persona_query("trader_personas",
               f"select account, {FLAG_SQL}, behavioral_risk_score, trader_archetype, {NUMBER_SQL} from personas",
               lambda p: p)
_persona_query("behavioral_insights",
               f"select account, {FLAG_SQL}, behavioral_risk_score, trader_archetype from personas",
               b.behavioral_insights)
_persona_query("persona_ledger", f"select account, trader_archetype, behavioral_risk_score, {NUMBER_SQL} from personas",
               b.persona_ledger)
_persona_query("risk_ranking", f"""
select account, behavioral_risk_score, trader_archetype, {real('win_rate')} as win_rate from personas
order by behavioral_risk_score desc, account limit 15""", lambda p: b.risk_ranking(p, 15))
_persona_query("archetype_summary", f"""
select trader_archetype, count(*) as accounts, {real('avg(total_realized_pnl)')} as avg_realized_pnl
from personas group by trader_archetype""", b.archetype_summary)
_persona_query("bias_prevalence", " union all ".join(
    f"select '{f}' as bias_type, count(*) filter ({f} = 1) as flagged_accounts, count(*) as accounts from personas"
    for f in b.BIASES), b.bias_prevalence)
