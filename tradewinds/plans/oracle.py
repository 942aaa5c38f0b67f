"""Shared SQL for the comparison engine: the domain views of ``testdata`` as common table expressions."""

from __future__ import annotations

from itertools import accumulate

from tradewinds import vocab
from tradewinds.plans import testdata


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def values_rows(rows) -> str:
    def lit(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"{float(v)}e0"
    return "(values " + ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows) + ")"


def _pick(choices, weights) -> str:
    bounds = [round(b, 10) for b in accumulate(weights)]
    whens = " ".join(f"when u < {b}e0 then {c}" for b, c in zip(bounds[:-1], choices[:-1]))
    return f"case {whens} else {choices[-1]} end"


def _leverage() -> str:
    parts = [
        (f"when size_usd > {floor} then ({_pick(c, w)})" if floor is not None else f"else ({_pick(c, w)})")
        for floor, c, w in vocab.LEVERAGE_TIERS]
    return "case " + " ".join(parts) + " end"


def _bucket() -> str:
    parts = [
        (f"when leverage <= {top} then '{label}'" if top is not None else f"else '{label}'")
        for top, label in vocab.LEVERAGE_BUCKETS]
    return "case " + " ".join(parts) + " end"


SENTIMENT = """
fx_sentiment as (
  select d as date, sc as sentiment_score,
         case when sc < 25 then 'Extreme Fear' when sc <= 45 then 'Fear' when sc < 55 then 'Neutral'
              when sc <= 75 then 'Greed' else 'Extreme Greed' end as sentiment_class
  from (select cast(o_orderdate as date) d, cast(sum(o_custkey) % 101 as int) sc
        from orders group by cast(o_orderdate as date)) q)"""

FILLS = """
fx_fills as (
  select l_orderkey * 10 + l_linenumber as trade_id,
         cast('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
              cast(round(l_extendedprice * 100) as bigint), cast(l_quantity as bigint),
              cast(round(l_discount * 100) as bigint), cast(round(l_tax * 100) as bigint))), 1, 15) as bigint) as fill_seq,
         concat('acct_', cast(o_custkey % 300 as varchar)) as account,
         p_brand as coin, p_retailprice as execution_price, l_extendedprice as size_usd,
         (cast(round(l_extendedprice * 100) as bigint)
          * (cast(round(l_tax * 100) as bigint) + 2 - cast(round(l_discount * 100) as bigint))) / 10000e0 as closed_pnl,
         case cast((l_orderkey + l_linenumber) % 11 as int)
              when 0 then 'Buy' when 1 then 'Open Long' when 2 then 'Close Long' when 3 then 'Short > Long'
              when 4 then 'Sell' when 5 then 'Open Short' when 6 then 'Close Short' when 7 then 'Long > Short'
              when 8 then 'Liquidated Isolated Short' when 9 then 'Spot Dust Conversion' else 'Settlement' end as direction,
         l_shipdate + (l_orderkey % 24) * interval '1' hour as ts
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey)"""

DAYS = """
fx_days as (
  select date,
         cast(coalesce(last_value(sentiment_score ignore nulls) over (order by date rows between unbounded preceding and current row),
                  first_value(sentiment_score ignore nulls) over (order by date rows between current row and unbounded following),
                  50) as double) as sentiment_score,
         coalesce(last_value(sentiment_class ignore nulls) over (order by date rows between unbounded preceding and current row),
                  first_value(sentiment_class ignore nulls) over (order by date rows between current row and unbounded following),
                  'Neutral') as sentiment_class
  from (select distinct cast(ts as date) as date from fx_fills) left join fx_sentiment using (date))"""

SILVER = f"""
silver as (
  select *, {_bucket()} as leverage_bucket, pnl_pct * leverage as roe
  from (select *, {_leverage()} as leverage
        from (select f.*, d.sentiment_score, d.sentiment_class,
                     cast(ts as date) as date, cast(hour(ts) as int) as hour, strftime(ts, '%A') as day_of_week,
                     strftime(ts, '%Y-%m') as month,
                     case when direction in ({quoted(vocab.LONG_LABELS)}) then 'Long'
                          when direction in ({quoted(vocab.SHORT_LABELS)}) then 'Short' else 'Other' end as trade_direction,
                     case when size_usd > 0 then closed_pnl / size_usd else 0e0 end as pnl_pct,
                     closed_pnl <> 0 as is_closing_trade,
                     case when closed_pnl > 0 then 1 else 0 end as win_flag,
                     cast('0x' || substr(md5(cast(trade_id as varchar)), 1, 8) as bigint) / 4294967296e0 as u
              from fx_fills f join fx_days d on cast(f.ts as date) = d.date) a) b),
realized as (select * from silver where is_closing_trade)"""

BRONZE = """
bronze_fills as (
  select account as "Account", coin as "Coin", execution_price as "Execution Price", size_usd as "Size USD",
         strftime(ts, '%d-%m-%Y %H:%M') as "Timestamp IST", direction as "Direction",
         closed_pnl as "Closed PnL", trade_id as "Trade ID" from fx_fills),
bronze_sentiment as (select date, sentiment_score as value, sentiment_class as classification from fx_sentiment)"""

FACT = """
fact as (
  select f."Trade ID" as trade_id, f."Account" as account_address, f."Coin" as token_symbol,
         f."Execution Price" as execution_price, f."Size USD" as size_usd, f."Closed PnL" as closed_pnl,
         f."Direction" as raw_direction, f."Timestamp IST" as timestamp_ist,
         s.value as sentiment_score, s.classification as sentiment_class,
         case when f."Closed PnL" > 0 then 1 else 0 end as is_win,
         case when f."Closed PnL" <> 0 then 1 else 0 end as is_closing_trade
  from bronze_fills f left join bronze_sentiment s
    on cast(strptime(f."Timestamp IST", '%d-%m-%Y %H:%M') as date) = s.date)"""

ARTICLES = """
fx_articles as (
  select doc_id as article_id, concat('doc ', cast(doc_id as varchar)) as title, text as content, source, lang as author,
         timestamp '2024-01-01 00:00:00' + (doc_id % 720) * interval '1' hour as published_date
  from documents)"""

TOKENS = f"""
cleaned as (
  select *, regexp_replace(regexp_replace(regexp_replace(content, '[^\\x00-\\x7F]+', ' ', 'g'),
            '<[^>]*>', ' ', 'g'), 'https?://\\S+|www\\.\\S+', ' ', 'g') as content_clean
  from fx_articles),
tokenized as (
  select *, list_transform(
     list_filter(regexp_extract_all(lower(content_clean), '\\b[a-zA-Z0-9$%\\-\\.]+\\b'),
                 lambda t: length(t) > 1 and t not in ({quoted(vocab.STOP_WORDS)})),
     lambda t: case when t like '%s' and t not like '%ss' then substr(t, 1, length(t) - 1)
                    when t like '%ed' then substr(t, 1, length(t) - 2)
                    when t like '%ing' then substr(t, 1, length(t) - 3) else t end) as tokens
  from cleaned)"""

PAIRS = """
token_rows as (select article_id, unnest(list_distinct(tokens)) as token from tokenized),
set_sizes as (select article_id, count(*) as n from token_rows group by article_id),
pairs as (
  select a as first, b as second, shared * 1e0 / (x.n + y.n - shared) as jaccard
  from (select p.article_id as a, q.article_id as b, count(*) as shared
        from token_rows p join token_rows q on p.token = q.token and p.article_id < q.article_id group by 1, 2) c
  join set_sizes x on x.article_id = a join set_sizes y on y.article_id = b
  where shared * 1e0 / (x.n + y.n - shared) > 0.70e0)"""


def _greedy_cte(rounds: int) -> str:
    """Greedy keep-first over ``pairs``, unrolled far enough for this data (checked by the leftover column)."""
    parts = ["e0 as (select first, second from pairs)"]
    for i in range(rounds):
        parts.append(f"heads{i} as (select distinct first as id from e{i} where first not in (select second from e{i}))")
        parts.append(f"gone{i} as (select distinct second as id from e{i} where first in (select id from heads{i}))")
        parts.append(f"e{i + 1} as (select * from e{i} where first not in (select id from heads{i}) "
                     f"and first not in (select id from gone{i}) and second not in (select id from gone{i}))")
    parts.append("dropped as (" + " union ".join(f"select id from gone{i}" for i in range(rounds)) + ")")
    return ",\n".join(parts)


GREEDY = _greedy_cte(6)

#: The articles that every news stage after cleaning works on; the check of the leftover pairs guards the unrolling.
KEPT = "kept as (select * from tokenized where article_id not in (select id from dropped) or (select count(*) from e6) > 0)"

LEXICON = f"lexicon as (select * from {values_rows(testdata.LEXICON.items())} v(token, weight))"
KEYWORDS = f"keywords as (select * from {values_rows(testdata.KEYWORDS.items())} v(token, weight))"
CREDIBILITY = f"credibility as (select * from {values_rows(testdata.CREDIBILITY.items())} v(source, score))"
ENTITY_ROWS = f"entity_dictionary as (select * from {values_rows(testdata.ENTITIES)} v(keyword, entity, entity_type))"

SCORES = """
hits as (select article_id, unnest(tokens) as token from kept),
hit_sums as (select article_id, sum(weight) as w, count(*) as n from hits join lexicon using (token) group by article_id),
scores as (
  select article_id, title, source, published_date,
         case when n is null then 0e0 else least(1e0, greatest(-1e0, w / n)) end as sentiment_score,
         case when n is null then 1e0 else least(1e0, greatest(0.5e0, n * 0.15e0 + 0.5e0)) end as confidence_score,
         case when w / n > 0.15e0 then 'Bullish' when w / n < -0.15e0 then 'Bearish' else 'Neutral' end as sentiment_class
  from kept left join hit_sums using (article_id))"""

ENTITIES = """
entities as (
  select distinct a.article_id, d.entity, d.entity_type, s.sentiment_score as sentiment_association, a.published_date
  from kept a join entity_dictionary d on regexp_matches(lower(a.content_clean), concat('\\b', d.keyword, '\\b'))
  join scores s on s.article_id = a.article_id)"""

IMPACT = """
impact as (
  select article_id, title, sentiment_score, source, published_date, impact_value as market_impact_score,
         case when impact_value >= 75 then 'Critical Impact' when impact_value >= 50 then 'High Impact'
              when impact_value >= 25 then 'Medium Impact' else 'Low Impact' end as market_impact_class
  from (
    select s.*, least(100e0, greatest(0e0,
             0.35e0 * (abs(sentiment_score) * 100e0) + 0.25e0 * coalesce(c.score, 60e0)
             + 0.20e0 * least(100e0, greatest(0e0, coalesce(k.w, 0e0) * 20e0))
             + 0.20e0 * (case when hour(published_date) between 13 and 19 then 95e0
                              when hour(published_date) between 8 and 12 then 75e0 else 50e0 end))) as impact_value
    from scores s left join credibility c on c.source = s.source
    left join (select article_id, sum(weight) as w from hits join keywords using (token) group by article_id) k
      on k.article_id = s.article_id))"""

TRADE_CTES = [SENTIMENT, FILLS, DAYS, SILVER]
KEPT_CTES = [ARTICLES, TOKENS, PAIRS, GREEDY, KEPT]
NEWS_CTES = [*KEPT_CTES, LEXICON, SCORES]


def sql(body: str, *ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + body


def on_silver(body: str, *more: str) -> str:
    return sql(body, *TRADE_CTES, *more)


def on_news(body: str, *more: str) -> str:
    return sql(body, *NEWS_CTES, *more)
