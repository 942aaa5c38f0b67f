"""Article cleaning, lexicon sentiment, entities and market impact.

Dictionaries are small by contract (tens of entries) and are folded into the
expressions, so scoring an article needs no join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tradewinds import vocab
from tradewinds.functions import text as x
from tradewinds.functions.trade import published_day, published_hour, published_time


def article_ids(articles: DataFrame) -> DataFrame:
    """id = md5(url); a URL seen again replaces the earlier article (latest publication wins)."""
    named = articles.drop("article_id").withColumn("article_id", F.md5("url"))
    newest = F.max_by(F.struct(*named.columns), F.struct("published_date", "title", "content"))
    return named.groupBy("article_id").agg(newest.alias("r")).select("r.*")


def clean_articles(articles: DataFrame) -> DataFrame:
    cleaned = articles.withColumns({"title_clean": x.clean_text("title"), "content_clean": x.clean_text("content")})
    return cleaned.withColumn("tokens", x.content_tokens("content_clean"))


# ---- sentiment --------------------------------------------------------------

def lexicon_join(tokenized: DataFrame, lexicon: DataFrame) -> DataFrame:
    """One row per token occurrence found in a dictionary table of (token, weight).

    The optimizer broadcasts the dictionary when it is small and shuffles
    otherwise, so this is the form for dictionaries too large for an expression.
    """
    return tokenized.select("article_id", F.explode("tokens").alias("token")).join(lexicon, "token")


def lexicon_sentiment(tokenized: DataFrame, lexicon: dict[str, float] | None = None) -> DataFrame:
    """Add mean lexicon weight clipped to [-1, 1], its confidence, and the class."""
    weights = x.token_weights("tokens", lexicon if lexicon is not None else vocab.LEXICON)
    scored = tokenized.withColumn("_w", weights).withColumn("_n", F.size("_w"))
    mean = x.array_sum(F.col("_w")) / F.col("_n")
    out = scored.withColumns({
        "sentiment_score": F.when(F.col("_n") == 0, 0.0).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), mean))),
        "confidence_score": F.when(F.col("_n") == 0, 1.0).otherwise(
            F.greatest(F.lit(0.5), F.least(F.lit(1.0), F.col("_n") * 0.15 + 0.5))),
    }).drop("_w", "_n")
    return out.withColumn("sentiment_class", x.sentiment_label("sentiment_score"))


def batch_sentiment(tokenized: DataFrame, scorer: Callable[[pd.Series], pd.DataFrame]) -> DataFrame:
    """Score with a caller's batch model: texts in, ``sentiment_score, confidence_score`` out, per Arrow batch."""
    keep = ["article_id", "title", "source", "published_date"]
    fields = tokenized.select(*keep).schema
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = scorer(batch["content_clean"])
            yield batch[keep].assign(sentiment_score=scores["sentiment_score"].to_numpy(),
                                     confidence_score=scores["confidence_score"].to_numpy())

    scored = tokenized.select(*keep, "content_clean").mapInPandas(
        run, f"{schema}, sentiment_score double, confidence_score double")
    return scored.withColumn("sentiment_class", x.sentiment_label("sentiment_score"))


def score_table(scored: DataFrame) -> DataFrame:
    return scored.select("article_id", "title", "sentiment_score", "confidence_score", "sentiment_class", "source",
                         "published_date")


def sentiment_overview(scores: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    share = lambda label: F.coalesce(F.try_divide(F.count_if(F.col("sentiment_class") == label), total), F.lit(0.0))
    return scores.agg(
        total.alias("total_articles"),
        share("Bullish").alias("bullish_ratio"),
        share("Bearish").alias("bearish_ratio"),
        share("Neutral").alias("neutral_ratio"),
        F.avg("sentiment_score").alias("average_sentiment_score"),
    ).withColumn("market_sentiment_bias", x.sentiment_label("average_sentiment_score"))


def value_counts(df: DataFrame, *cols: str, name: str = "articles") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def with_label(df: DataFrame, labels: DataFrame, key: str, label: str, default) -> DataFrame:
    """Attach the label of each row's ``key`` from a table (key, label), ``default`` where it has none or a null one."""
    named = labels.select(F.col(key).alias("_label_key"), F.col(label).alias("_label"))
    return df.join(named, F.col(key) == F.col("_label_key"), "left").withColumn(label, F.coalesce("_label", F.lit(default))).drop("_label_key", "_label")


# ---- entities ---------------------------------------------------------------

EntityRow = tuple[str, str, str]


def entity_dictionary(keywords: dict[str, list[str]] | None = None, names: dict[str, str] | None = None) -> list[EntityRow]:
    """(keyword, display name, type) rows; a keyword without a display name is capitalised."""
    keywords = keywords if keywords is not None else vocab.ENTITY_KEYWORDS
    names = names if names is not None else vocab.ENTITY_NAMES
    return [(k, names.get(k, k.capitalize()), kind) for kind, words in keywords.items() for k in words]


def entity_array(text, dictionary: Sequence[EntityRow]) -> Column:
    """Distinct {entity, entity_type} structs whose keyword occurs in the text as a whole word."""
    by_keyword: dict[str, list[tuple[str, str]]] = {}
    for keyword, entity, kind in dictionary:
        by_keyword.setdefault(keyword, []).append((entity, kind))
    pairs = [c for k, found in by_keyword.items() for c in (
        F.lit(k), F.array(*[F.struct(F.lit(e).alias("entity"), F.lit(t).alias("entity_type")) for e, t in found]))]
    table = F.create_map(*pairs)
    hits = x.keyword_hits(text, list(by_keyword))
    return F.array_distinct(F.flatten(F.transform(hits, lambda k: F.element_at(table, k))))


def extract_entities(cleaned: DataFrame, dictionary: Sequence[EntityRow] | None = None) -> DataFrame:
    rows = list(dictionary) if dictionary is not None else entity_dictionary()
    return cleaned.withColumn("extracted_entities", entity_array("content_clean", rows))


def entity_rows(extracted: DataFrame) -> DataFrame:
    return extracted.select("article_id", "published_date", F.explode("extracted_entities").alias("e")).select(
        "article_id", "e.entity", "e.entity_type", "published_date")


def entity_sentiment_join(entities: DataFrame, scores: DataFrame) -> DataFrame:
    """Attach the article's sentiment, 0.0 where it was not scored."""
    return entities.join(scores.select("article_id", "sentiment_score"), "article_id", "left").select(
        "article_id", "entity", "entity_type",
        F.coalesce("sentiment_score", F.lit(0.0)).alias("sentiment_association"), "published_date")


def entity_frequency(entities: DataFrame) -> DataFrame:
    return value_counts(entities, "entity", "entity_type", name="frequency")


def entity_sentiment(entities: DataFrame) -> DataFrame:
    return entities.groupBy("entity").agg(F.avg("sentiment_association").alias("sentiment_association"))


def top_counts(counts: DataFrame, by: str, n: int, *ties: str) -> DataFrame:
    return counts.orderBy(F.desc(by), *ties).limit(n)


def entity_extremes(sentiment: DataFrame, n: int = 10) -> DataFrame:
    """The n highest and the n lowest entities; an entity may appear in both."""
    score = "sentiment_association"
    high = sentiment.orderBy(F.desc(score), "entity").limit(n)
    low = sentiment.orderBy(F.asc(score), F.desc("entity")).limit(n)
    return high.unionByName(low)


# ---- impact -----------------------------------------------------------------

def impact_score(scored: DataFrame, credibility: dict[str, float] | None = None,
                 keywords: dict[str, float] | None = None) -> DataFrame:
    """Sentiment strength, source credibility, keyword relevance and hour band combined into 0-100 and a class."""
    credibility = credibility if credibility is not None else vocab.SOURCE_CREDIBILITY
    keywords = keywords if keywords is not None else vocab.CRITICAL_KEYWORDS
    trust = F.lit(vocab.DEFAULT_CREDIBILITY)
    for source, value in credibility.items():
        trust = F.when(F.col("source") == source, value).otherwise(trust)
    hour = published_hour()
    engagement = F.when(hour.between(13, 19), 95.0).when(hour.between(8, 12), 75.0).otherwise(50.0)
    relevance = F.least(F.lit(100.0), F.greatest(F.lit(0.0), x.array_sum(x.token_weights("tokens", keywords)) * 20.0))
    score = (0.35 * (F.abs(F.coalesce("sentiment_score", F.lit(0.0))) * 100.0) + 0.25 * trust
             + 0.20 * relevance + 0.20 * engagement)
    out = scored.withColumn("market_impact_score", F.least(F.lit(100.0), F.greatest(F.lit(0.0), score)))
    s = F.col("market_impact_score")
    label = (F.when(s >= 75, "Critical Impact").when(s >= 50, "High Impact").when(s >= 25, "Medium Impact")
             .otherwise("Low Impact"))
    return out.withColumn("market_impact_class", label).select(
        "article_id", "title", F.coalesce("sentiment_score", F.lit(0.0)).alias("sentiment_score"),
        "market_impact_score", "market_impact_class", "source", "published_date")


def high_impact_articles(impact: DataFrame, floor: float = 50.0) -> DataFrame:
    return impact.where(F.col("market_impact_score") >= floor).orderBy(F.desc("market_impact_score")).select(
        "title", "market_impact_score", "market_impact_class", "sentiment_score", "source")


def latest_news(articles: DataFrame, n: int = 20) -> DataFrame:
    return articles.orderBy(published_time().desc(), "article_id").limit(n)


def with_published_parts(articles: DataFrame) -> DataFrame:
    return articles.withColumns({"published_hour": published_hour(), "published_day": published_day()})
