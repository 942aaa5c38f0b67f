"""News-text queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tradewinds.functions import text as x
from tradewinds.functions.trade import as_col
from tradewinds.operators import near_dup, news, regimes, topics, trends
from tradewinds.plans import oracle, testdata as td
from tradewinds.plans.catalog import query
from tradewinds.plans.compare import real, steady
from tradewinds.plans.risk_queries import DAILY_CTE, STEADY_CTE, ruled_days
from tradewinds.plans.trade_queries import silver
from tradewinds.sources import layers


def cleaned(spark, sf):
    return news.clean_articles(td.articles(spark, sf))


def kept(spark, sf):
    """The cleaned articles without their near duplicates: stored once, read by every later stage. The raw text is not stored again."""
    def build():
        return near_dup.drop_near_duplicates(cleaned(spark, sf)).drop("content", "title_clean")

    return layers.stored(spark, "kept_news", [f"{sf}/documents.parquet"], build)


def scored(spark, sf):
    return news.lexicon_sentiment(kept(spark, sf), td.LEXICON)


def scores(spark, sf):
    return news.score_table(scored(spark, sf))


def impact(spark, sf):
    return news.impact_score(scored(spark, sf), td.CREDIBILITY, td.KEYWORDS)


def entities(spark, sf):
    # score and dictionary hits come from the same row: no join back to the scores
    found = news.extract_entities(scored(spark, sf), td.ENTITIES)
    return found.select("article_id", "published_date", "sentiment_score", F.explode("extracted_entities").alias("e")).select(
        "article_id", "e.entity", "e.entity_type", F.col("sentiment_score").alias("sentiment_association"), "published_date")


def joined(tokens):
    return F.array_join(as_col(tokens), "|")


# ---- ids and cleaning -------------------------------------------------------

@query("article_id", """
select md5(url) as article_id, url, arg_max(html, [cast(page_id as varchar).lpad(12, '0'), html]) as content
from (select 'https://' || split_part(split_part(url, '://', 2), '/', 1) as url, html, page_id from pages) group by url""")
def article_id(spark, sf):
    # pages of one site share a URL here, so that later pages replace earlier ones
    pages = td.table(spark, sf, "pages")
    site = F.concat(F.lit("https://"), F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1)))
    raw = pages.select(
        site.alias("url"), F.lit("").alias("title"), F.col("html").alias("content"),
        F.lpad(F.col("page_id").cast("string"), 12, "0").alias("published_date"))
    return news.article_ids(raw).select("article_id", "url", "content")


@query("published_parts", oracle.sql("""
select article_id, cast(hour(published_date) as int) as published_hour, cast(published_date as date) as published_day
from fx_articles""", oracle.ARTICLES))
def published_parts(spark, sf):
    return news.with_published_parts(td.articles(spark, sf)).select("article_id", "published_hour", "published_day")


@query("clean_text", oracle.sql("""
select page_id, regexp_replace(regexp_replace(regexp_replace(html, '[^\\x00-\\x7F]+', ' ', 'g'),
       '<[^>]*>', ' ', 'g'), 'https?://\\S+|www\\.\\S+', ' ', 'g') as content_clean from pages""".replace("\\\\", "\\"), "one as (select 1)"))
def clean_text(spark, sf):
    return td.table(spark, sf, "pages").select("page_id", x.clean_text("html").alias("content_clean"))


RAW_TOKENS_SQL = "regexp_extract_all(lower(content_clean), '\\b[a-zA-Z0-9$%\\-\\.]+\\b')"


@query("tokenize", oracle.sql(f"select article_id, array_to_string({RAW_TOKENS_SQL}, '|') as tokens from cleaned",
                              oracle.ARTICLES, oracle.TOKENS))
def tokenize(spark, sf):
    docs = td.articles(spark, sf).select("article_id", x.clean_text("content").alias("c"))
    return docs.select("article_id", joined(x.tokenize("c")).alias("tokens"))


@query("remove_stop_words", oracle.sql(f"""
select article_id, array_to_string(list_filter({RAW_TOKENS_SQL},
  lambda t: length(t) > 1 and t not in ({oracle.quoted(x.vocab.STOP_WORDS)})), '|') as tokens from cleaned""",
    oracle.ARTICLES, oracle.TOKENS))
def remove_stop_words(spark, sf):
    docs = td.articles(spark, sf).select("article_id", x.clean_text("content").alias("c"))
    return docs.select("article_id", joined(x.remove_stop_words(x.tokenize("c"))).alias("tokens"))


@query("light_stem", oracle.sql("select article_id, array_to_string(tokens, '|') as tokens from tokenized",
                                oracle.ARTICLES, oracle.TOKENS))
def light_stem(spark, sf):
    return cleaned(spark, sf).select("article_id", joined("tokens").alias("tokens"))


# ---- near duplicates --------------------------------------------------------

SETS_CTE = """
set_copies as (
  select article_id, count(*) over (partition by s) as copies
  from (select article_id, list_sort(list_distinct(tokens)) as s from tokenized where len(tokens) > 0))"""


@query("jaccard", oracle.sql(f"""
select c.article_id, {real('''case when len(c.a) = 0 or len(c.b) = 0 then 0e0 else len(list_intersect(c.a, c.b)) * 1e0
       / len(list_distinct(list_concat(c.a, c.b))) end''')} as jaccard
from (select article_id, list_distinct(tokens) as a,
             list_distinct(list_filter({RAW_TOKENS_SQL}, lambda t: length(t) > 1)) as b from tokenized) c""",
    oracle.ARTICLES, oracle.TOKENS))
def jaccard(spark, sf):
    # overlap of the stemmed token set with the unstemmed one
    docs = cleaned(spark, sf).withColumn("raw", F.filter(x.tokenize("content_clean"), lambda t: F.length(t) > 1))
    return steady(docs.select("article_id", x.jaccard("tokens", "raw").alias("jaccard")), real=["jaccard"])


@query("jaccard_self_join", oracle.sql(f"""
select first, second, {real('jaccard')} as jaccard, f.copies as first_copies, s.copies as second_copies
from pairs join set_copies f on f.article_id = first join set_copies s on s.article_id = second""",
    oracle.ARTICLES, oracle.TOKENS, oracle.PAIRS, SETS_CTE))
def jaccard_self_join(spark, sf):
    return steady(near_dup.article_pairs(cleaned(spark, sf)), real=["jaccard"])


@query("drop_near_duplicates", oracle.sql("""
select article_id, title, source from tokenized
where article_id not in (select id from dropped) or (select count(*) from e6) > 0""",
    oracle.ARTICLES, oracle.TOKENS, oracle.PAIRS, oracle.GREEDY))
def drop_near_duplicates(spark, sf):
    return near_dup.drop_near_duplicates(cleaned(spark, sf)).select("article_id", "title", "source")


@query("clean_news", oracle.sql("""
select article_id, title, content_clean, array_to_string(tokens, '|') as tokens, source, author, published_date from tokenized
where article_id not in (select id from dropped) or (select count(*) from e6) > 0""",
    oracle.ARTICLES, oracle.TOKENS, oracle.PAIRS, oracle.GREEDY))
def clean_news(spark, sf):
    return kept(spark, sf).select(
        "article_id", "title", "content_clean", joined("tokens").alias("tokens"), "source", "author", "published_date")


# ---- sentiment --------------------------------------------------------------

@query("lexicon_join", oracle.on_news(
    "select article_id, token, weight, count(*) as hits from hits join lexicon using (token) group by all"))
def lexicon_join(spark, sf):
    table = spark.createDataFrame(list(td.LEXICON.items()), "token string, weight double")
    hits = news.lexicon_join(kept(spark, sf), table)
    return hits.groupBy("article_id", "token", "weight").agg(F.count(F.lit(1)).alias("hits"))


SCORE_SQL = f"""select article_id, title, {real('sentiment_score')} as sentiment_score,
 {real('confidence_score')} as confidence_score, sentiment_class, source, published_date from scores"""


@query("lexicon_sentiment", oracle.on_news(SCORE_SQL))
def lexicon_sentiment(spark, sf):
    return steady(scores(spark, sf), real=["sentiment_score", "confidence_score"])


@query("batch_sentiment", oracle.on_news(f"""
select article_id, {real('s')} as sentiment_score, {real('least(1e0, n / 5000)')} as confidence_score,
       case when s > 0.15 then 'Bullish' when s < -0.15 then 'Bearish' else 'Neutral' end as sentiment_class
from (select article_id, length(content_clean) * 1e0 as n,
             (length(replace(content_clean, 'e', '**')) - length(replace(content_clean, 'a', '**'))) * 4e0 / greatest(1, length(content_clean)) as s from kept)"""))
def batch_sentiment(spark, sf):
    """The batch hook with a stand-in model, which weighs two letters."""

    def model(texts):
        chars = texts.str.len()
        score = (texts.str.count("e") - texts.str.count("a")) * 4.0 / chars.clip(lower=1)
        return pd.DataFrame({"sentiment_score": score, "confidence_score": (chars / 5000).clip(upper=1.0)})

    out = news.batch_sentiment(kept(spark, sf), model)
    return steady(out.select("article_id", "sentiment_score", "confidence_score", "sentiment_class"), real=["sentiment_score", "confidence_score"])


@query("sentiment_class", oracle.on_news("select article_id, sentiment_class from scores"))
def sentiment_class(spark, sf):
    return scores(spark, sf).select("article_id", "sentiment_class")


@query("sentiment_overview", oracle.on_news(f"""
select count(*) as total_articles,
       {real("count(*) filter (sentiment_class = 'Bullish') * 1e0 / count(*)")} as bullish_ratio,
       {real("count(*) filter (sentiment_class = 'Bearish') * 1e0 / count(*)")} as bearish_ratio,
       {real("count(*) filter (sentiment_class = 'Neutral') * 1e0 / count(*)")} as neutral_ratio,
       {real('avg(sentiment_score)')} as average_sentiment_score,
       case when avg(sentiment_score) > 0.15 then 'Bullish' when avg(sentiment_score) < -0.15 then 'Bearish' else 'Neutral' end
         as market_sentiment_bias
from scores"""))
def sentiment_overview(spark, sf):
    return steady(news.sentiment_overview(scores(spark, sf)), real=[
        "bullish_ratio", "bearish_ratio", "neutral_ratio", "average_sentiment_score"])


@query("source_counts", oracle.on_news("select source, count(*) as articles from scores group by source"))
def source_counts(spark, sf):
    return news.value_counts(scores(spark, sf), "source")


@query("sentiment_class_counts", oracle.on_news(
    "select sentiment_class, count(*) as articles from scores group by sentiment_class"))
def sentiment_class_counts(spark, sf):
    return news.value_counts(scores(spark, sf), "sentiment_class")


@query("latest_news", oracle.sql(
    "select article_id, title, source, published_date from fx_articles order by published_date desc, article_id limit 20",
    oracle.ARTICLES))
def latest_news(spark, sf):
    return news.latest_news(td.articles(spark, sf)).select("article_id", "title", "source", "published_date")


# ---- entities ---------------------------------------------------------------

ENTITY_CTES = (oracle.ENTITY_ROWS, oracle.ENTITIES)


@query("entity_dictionary_join", oracle.sql("""
select article_id, entity, entity_type, published_date from kept a
join entity_dictionary d on regexp_matches(lower(a.content_clean), concat('\\b', d.keyword, '\\b'))""",
    *oracle.KEPT_CTES, oracle.ENTITY_ROWS))
def entity_dictionary_join(spark, sf):
    return news.entity_rows(news.extract_entities(kept(spark, sf), td.ENTITIES))


@query("extract_entities", oracle.on_news(
    f"select article_id, entity, entity_type, {real('sentiment_association')} as sentiment_association, published_date from entities",
    *ENTITY_CTES))
def extract_entities(spark, sf):
    return steady(entities(spark, sf), real=["sentiment_association"])


@query("entity_sentiment_join", oracle.on_news(f"""
select article_id, entity, entity_type,
       {real("case when article_id % 7 = 0 then 0e0 else sentiment_association end")} as sentiment_association, published_date
from entities""", *ENTITY_CTES))
def entity_sentiment_join(spark, sf):
    # every seventh article has no score: its entities get 0.0
    rows = news.entity_rows(news.extract_entities(kept(spark, sf), td.ENTITIES))
    known = scores(spark, sf).where(F.col("article_id") % 7 != 0)
    return steady(news.entity_sentiment_join(rows, known), real=["sentiment_association"])


@query("distinct_entities", oracle.on_news(
    "select article_id, count(*) as n_entities from entities group by article_id", *ENTITY_CTES))
def distinct_entities(spark, sf):
    found = news.extract_entities(kept(spark, sf), td.ENTITIES).where(F.size("extracted_entities") > 0)
    return found.select("article_id", F.size("extracted_entities").cast("bigint").alias("n_entities"))


@query("entity_frequency", oracle.on_news(
    "select entity, entity_type, count(*) as frequency from entities group by entity, entity_type", *ENTITY_CTES))
def entity_frequency(spark, sf):
    return news.entity_frequency(entities(spark, sf))


@query("entity_sentiment", oracle.on_news(
    f"select entity, {real('avg(sentiment_association)')} as sentiment_association from entities group by entity", *ENTITY_CTES))
def entity_sentiment(spark, sf):
    return steady(news.entity_sentiment(entities(spark, sf)), real=["sentiment_association"])


@query("top_entities", oracle.on_news(
    "select entity, entity_type, count(*) as frequency from entities group by entity, entity_type "
    "order by frequency desc, entity, entity_type limit 3", *ENTITY_CTES))
def top_entities(spark, sf):
    return news.top_counts(news.entity_frequency(entities(spark, sf)), "frequency", 3, "entity", "entity_type")


@query("entity_extremes", oracle.on_news(f"""
select entity, {real('s')} as sentiment_association from (
  (select * from m order by s desc, entity limit 3) union all (select * from m order by s, entity desc limit 3))""",
    *ENTITY_CTES, "m as (select entity, avg(sentiment_association) as s from entities group by entity)"))
def entity_extremes(spark, sf):
    return steady(news.entity_extremes(news.entity_sentiment(entities(spark, sf)), 3), real=["sentiment_association"])


# ---- impact -----------------------------------------------------------------

IMPACT_CTES = (oracle.KEYWORDS, oracle.CREDIBILITY, oracle.IMPACT)


@query("impact_score", oracle.on_news(f"""
select article_id, title, {real('sentiment_score')} as sentiment_score, {real('market_impact_score')} as market_impact_score,
       market_impact_class, source, published_date from impact""", *IMPACT_CTES))
def impact_score(spark, sf):
    return steady(impact(spark, sf), real=["sentiment_score", "market_impact_score"])


@query("label_map_join", oracle.sql("""
select source, coalesce(score, 60e0) as credibility, count(*) as articles
from fx_articles left join credibility using (source) group by all""", oracle.ARTICLES, oracle.CREDIBILITY))
def label_map_join(spark, sf):
    # label table joined to rows already counted per source; 60 for sources without a label
    labels = spark.createDataFrame(list(td.CREDIBILITY.items()), "source string, credibility double")
    return news.with_label(news.value_counts(td.articles(spark, sf), "source"), labels, "source", "credibility", 60.0)


@query("high_impact_articles", oracle.on_news(f"""
select title, {real('market_impact_score')} as market_impact_score, market_impact_class,
       {real('sentiment_score')} as sentiment_score, source from impact where market_impact_score >= 50""", *IMPACT_CTES))
def high_impact_articles(spark, sf):
    return steady(news.high_impact_articles(impact(spark, sf)), real=["market_impact_score", "sentiment_score"])


@query("top_impacts", oracle.on_news(f"""
select article_id, {real('market_impact_score')} as market_impact_score from impact
order by market_impact_score desc, article_id limit 5""", *IMPACT_CTES))
def top_impacts(spark, sf):
    ranked = news.top_counts(impact(spark, sf), "market_impact_score", 5, "article_id")
    return steady(ranked.select("article_id", "market_impact_score"), real=["market_impact_score"])


# ---- themes and topics ------------------------------------------------------

def _theme_sql() -> str:
    names = list(td.THEMES)
    sizes = [f"len(list_intersect(list_distinct(tokens), [{oracle.quoted(td.THEMES[n])}]))" for n in names]
    best = "greatest(" + ", ".join(sizes) + ")"
    cases = " ".join(f"when {s} = {best} then '{n}'" for n, s in zip(names, sizes))
    return f"case when {best} = 0 then 'Macroeconomic Events' {cases} end"


THEME_CTE = f"themes as (select article_id, title, published_date, {_theme_sql()} as topic_theme from kept)"


def themed(spark, sf):
    return kept(spark, sf).select("article_id", "title", "published_date", x.theme_of_words("tokens", td.THEMES).alias("topic_theme"))


@query("theme_of_words", oracle.sql("select article_id, topic_theme from themes", *oracle.KEPT_CTES, THEME_CTE))
def theme_of_words(spark, sf):
    return themed(spark, sf).select("article_id", "topic_theme")


@query("topic_counts", oracle.sql("select topic_theme, count(*) as articles from themes group by topic_theme",
                                  *oracle.KEPT_CTES, THEME_CTE))
def topic_counts(spark, sf):
    return news.value_counts(themed(spark, sf), "topic_theme")


@query("top_topics", oracle.sql(
    "select topic_theme, count(*) as articles from themes group by topic_theme order by articles desc, topic_theme limit 2",
    *oracle.KEPT_CTES, THEME_CTE))
def top_topics(spark, sf):
    return news.top_counts(news.value_counts(themed(spark, sf), "topic_theme"), "articles", 2, "topic_theme")


@query("topic_evolution", oracle.sql("""
select cast(published_date as date) as published_day, topic_theme, count(*) as articles from themes group by all""",
    *oracle.KEPT_CTES, THEME_CTE))
def topic_evolution(spark, sf):
    return news.value_counts(news.with_published_parts(themed(spark, sf)), "published_day", "topic_theme")


@query("topic_model")
def topic_model(spark, sf):
    return topics.topic_table(modeled(spark, sf))


def modeled(spark, sf):
    """Every kept article with the theme and cluster of the fitted topic model; fitted and stored once."""
    return layers.stored(spark, "topics", [f"{sf}/documents.parquet"], lambda: topics.topic_model(kept(spark, sf), td.THEMES))


@query("modeled_topic_counts")
def modeled_topic_counts(spark, sf):
    return news.value_counts(modeled(spark, sf), "topic_theme")


@query("modeled_topic_evolution")
def modeled_topic_evolution(spark, sf):
    return news.value_counts(news.with_published_parts(modeled(spark, sf)), "published_day", "topic_theme")


# ---- trends -----------------------------------------------------------------

TRENDS_CTE = """
daily_scores as (
  select cast(published_date as date) as date, avg(sentiment_score) as avg_sentiment, count(article_id) as article_count
  from scores group by cast(published_date as date)),
returns as (select date + interval '266' month as date, avg(roe) as roe from silver group by date),
momentum as (
  select *, avg(avg_sentiment) over (order by date rows between 6 preceding and current row) as sentiment_momentum,
         coalesce(stddev_samp(avg_sentiment) over (order by date rows between 6 preceding and current row), 0e0) as sentiment_volatility
  from daily_scores),
priced as (
  select m.*, coalesce(sentiment_momentum - lag(sentiment_momentum) over (order by m.date), 0e0) as sentiment_acceleration,
         coalesce(last_value(r.roe ignore nulls) over (order by m.date rows between unbounded preceding and current row),
                  first_value(r.roe ignore nulls) over (order by m.date rows between current row and unbounded following), 0e0) as roe
  from momentum m left join returns r on r.date = m.date),
trends as (
  select *, price_momentum - sentiment_momentum as divergence
  from (select *, avg(roe) over (order by date rows between 6 preceding and current row) as price_momentum from priced))"""
TREND_REALS = ["avg_sentiment", "sentiment_momentum", "sentiment_volatility", "sentiment_acceleration", "divergence", "roe",
               "price_momentum"]


def shifted_silver(spark, sf):
    """The trade years lie before the articles; moved by 266 months they end within them."""
    return silver(spark, sf).withColumn("date", F.add_months("date", 266))


def all_trends(spark, sf):
    return trends.sentiment_trends(scores(spark, sf), shifted_silver(spark, sf))


def _trend_query(name, columns, build):
    body = ", ".join(f"{real(c)} as {c}" if c in TREND_REALS else c for c in columns)

    @query(name, oracle.sql(f"select {body} from trends", *oracle.TRADE_CTES, *oracle.NEWS_CTES, TRENDS_CTE))
    def run(spark, sf):
        return steady(build(spark, sf).select(*columns), real=TREND_REALS)


_trend_query("daily_sentiment", ["date", "avg_sentiment", "article_count"],
             lambda s, sf: trends.daily_sentiment(scores(s, sf)))
_trend_query("sentiment_momentum", ["date", "sentiment_momentum"],
             lambda s, sf: trends.sentiment_momentum(trends.daily_sentiment(scores(s, sf))))
_trend_query("sentiment_volatility", ["date", "sentiment_volatility"],
             lambda s, sf: trends.sentiment_volatility(trends.daily_sentiment(scores(s, sf))))
_trend_query("sentiment_acceleration", ["date", "sentiment_acceleration"],
             lambda s, sf: trends.sentiment_acceleration(trends.sentiment_momentum(trends.daily_sentiment(scores(s, sf)))))
_trend_query("trend_returns_join", ["date", "avg_sentiment", "roe"],
             lambda s, sf: trends.trend_returns_join(trends.daily_sentiment(scores(s, sf)), shifted_silver(s, sf)))
_trend_query("price_divergence", ["date", "roe", "price_momentum", "divergence"], all_trends)
_trend_query("sentiment_trends", ["date", "article_count", *TREND_REALS], all_trends)


@query("daily_brief", oracle.sql(f"""
select date, {real('sentiment_momentum')} as sentiment_momentum, {real('sentiment_volatility')} as sentiment_volatility,
       {real('sentiment_acceleration')} as sentiment_acceleration, {real('divergence')} as divergence,
       case when sentiment_momentum > 0.4 then 'Highly Bullish' when sentiment_momentum < -0.4 then 'Highly Bearish'
            else 'Neutral Consolidation' end as status,
       (select market_regime from steady_daily order by date desc limit 1) as market_regime,
       (select string_agg(topic_theme || ':' || articles, ', ' order by articles desc, topic_theme) from (
          select topic_theme, count(*) as articles from themes group by topic_theme
          order by articles desc, topic_theme limit 3)) as top_topics,
       (select string_agg(title, ', ' order by market_impact_score desc, article_id) from (
          select * from impact where market_impact_score >= 50 order by market_impact_score desc, article_id limit 5)) as alerts,
       abs(divergence) > 0.15 as divergence_warning
from trends order by date desc limit 1""",
    *oracle.TRADE_CTES, *oracle.NEWS_CTES, TRENDS_CTE, DAILY_CTE, STEADY_CTE, THEME_CTE, *IMPACT_CTES))
def daily_brief(spark, sf):
    return flat_brief(spark, sf, themed(spark, sf))


@query("modeled_brief")
def modeled_brief(spark, sf):
    """The brief with the themes of the fitted topic model."""
    return flat_brief(spark, sf, modeled(spark, sf))


def flat_brief(spark, sf, themes):
    brief = trends.daily_brief(
        all_trends(spark, sf), ruled_days(spark, sf), impact(spark, sf), news.value_counts(themes, "topic_theme"))
    flat = brief.withColumns({
        "top_topics": F.array_join(F.transform("top_topics", lambda t: F.concat(t["topic_theme"], F.lit(":"), t["articles"])), ", "),
        "alerts": F.array_join(F.transform("alerts", lambda a: a["title"]), ", "),
    })
    return steady(flat, real=["sentiment_momentum", "sentiment_volatility", "sentiment_acceleration", "divergence"])
