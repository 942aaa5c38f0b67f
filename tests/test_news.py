import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tradewinds.operators import near_dup, news, topics, trends
from tradewinds.plans import testdata as td

SF = "/root/testdata/sf0.001"


def greedy(rows, threshold=0.70):
    """Keep-first by id, comparing every article with all kept ones."""
    kept = []
    for i, tokens in sorted(rows):
        s = set(tokens)
        if not any(s and k and len(s & k) / len(s | k) > threshold for _, k in kept):
            kept.append((i, s))
    return {i for i, _ in kept}


def make(spark, rows):
    return spark.createDataFrame(rows, "article_id long, tokens array<string>")


def kept_ids(df):
    return {r["article_id"] for r in near_dup.drop_near_duplicates(df).collect()}


def test_documents_against_brute_force(spark):
    docs = news.clean_articles(td.articles(spark, SF)).select("article_id", "tokens")
    expected = greedy([(r["article_id"], r["tokens"]) for r in docs.collect()])
    assert kept_ids(docs) == expected


def test_chain_keeps_the_far_end(spark):
    a = [f"t{i}" for i in range(10)]
    b = a[1:] + ["x1"]
    c = b[2:] + ["x2", "x3"]
    rows = [(1, a), (2, b), (3, c)]
    assert greedy(rows) == {1, 3}
    assert kept_ids(make(spark, rows)) == {1, 3}


def test_a_long_chain_is_followed_to_its_end(spark):
    """Each story resembles the one before and after only: every other one stays."""
    rows = [(i, [f"t{j}" for j in range(2 * i, 2 * i + 20)]) for i in range(25)]
    assert greedy(rows) == set(range(0, 25, 2))
    assert kept_ids(make(spark, rows)) == set(range(0, 25, 2))


def test_a_family_of_ten_thousand(spark, monkeypatch):
    """Ten thousand different edits of one story: one stays, and their fifty million pairs are never compared."""
    rng = random.Random(11)
    story = [f"w{i}" for i in range(30)]
    rows = [(i, rng.sample(story, 29) + [f"e{i}"]) for i in range(10_000)]
    rows += [(20_000 + i, [f"x{rng.randrange(400)}" for _ in range(15)]) for i in range(300)]
    counted = []
    scored = near_dup._scored
    monkeypatch.setattr(near_dup, "_scored", lambda c, s, t: (counted.append(c.count()), scored(c, s, t))[1])
    gone = near_dup.dropped_articles(make(spark, rows)).collect()
    assert {r["article_id"] for r in gone if r["article_id"] < 20_000} == set(range(1, 10_000))
    assert all(r["kept_id"] == 0 and r["jaccard"] > 0.7 for r in gone if r["article_id"] < 20_000)
    assert sum(counted) < 100_000


def test_the_kept_article_is_named(spark):
    a = [f"t{i}" for i in range(10)]
    rows = [(1, a), (2, a), (3, a[:9]), (4, ["other"]), (5, []), (6, [])]
    gone = {r["article_id"]: (r["kept_id"], r["jaccard"]) for r in near_dup.dropped_articles(make(spark, rows)).collect()}
    assert gone == {2: (1, 1.0), 3: (1, 0.9)}


def test_exactly_at_the_threshold_is_kept(spark):
    a = [f"t{i}" for i in range(10)]
    assert kept_ids(make(spark, [(1, a), (2, a[:7])])) == {1, 2}
    assert kept_ids(make(spark, [(1, a), (2, a[:8])])) == {1}


def test_empty_sets_and_copies(spark):
    rows = [(1, []), (2, []), (3, ["a", "b"]), (4, ["b", "a", "a"]), (5, ["a", "b"]), (6, [""])]
    df = make(spark, rows)
    assert kept_ids(df) == greedy(rows) == {1, 2, 3, 6}
    pairs = near_dup.jaccard_self_join(df).collect()
    assert pairs == []  # one set with three copies has no pair with another set


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_families_of_near_copies(spark, seed):
    """A third of the articles are slight edits of one story; small vocabulary makes chance overlaps."""
    rng = random.Random(seed)
    story = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(240):
        if i % 3 == 0:
            tokens = [w for w in story if rng.random() > 0.12] + [f"e{rng.randrange(30)}"]
        else:
            tokens = [f"v{rng.randrange(60)}" for _ in range(rng.randrange(1, 25))]
        rows.append((i, tokens))
    expected = greedy(rows)
    df = make(spark, rows)
    assert kept_ids(df) == expected


def test_pairs_against_brute_force(spark):
    rng = random.Random(7)
    rows = [(i, [f"v{rng.randrange(12)}" for _ in range(rng.randrange(1, 10))]) for i in range(120)]
    first = {}
    for i, tokens in rows:
        first.setdefault(frozenset(tokens), i)
    sets = sorted((i, s) for s, i in first.items())
    brute = {(i, j): len(a & b) / len(a | b) for n, (i, a) in enumerate(sets) for j, b in sets[n + 1:]
             if len(a & b) / len(a | b) > 0.7}
    got = {(r["first"], r["second"]): r["jaccard"] for r in near_dup.jaccard_self_join(make(spark, rows)).collect()}
    assert got.keys() == brute.keys() and all(got[k] == pytest.approx(v) for k, v in brute.items())


def test_every_copy_is_in_its_pairs(spark):
    """All pairs of articles, not of token sets: copies pair with each other and with everything that their set resembles."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(12)]
    rows = [(i, rng.sample(base, rng.randrange(6, 13))) for i in rng.sample(range(1000), 90)] + [(2000, []), (2001, [])]
    size = {}
    for _, t in rows:
        size[frozenset(t)] = size.get(frozenset(t), 0) + 1
    assert max(size.values()) > 3
    sets = sorted((i, frozenset(t)) for i, t in rows if t)
    brute = {(i, j): (len(a & b) / len(a | b), size[a], size[b]) for n, (i, a) in enumerate(sets) for j, b in sets[n + 1:]
             if len(a & b) / len(a | b) > 0.7}
    got = near_dup.article_pairs(make(spark, rows)).collect()
    assert len(got) == len(brute) and any(v[0] == 1 for v in brute.values())
    assert {(r["first"], r["second"]): (r["jaccard"], r["first_copies"], r["second_copies"]) for r in got} == brute


def test_only_likely_pairs_are_verified(spark, monkeypatch):
    """Sets that share rare tokens but are far from similar are ruled out by their sketches, not by their tokens."""
    counted = []
    scored = near_dup._scored
    monkeypatch.setattr(near_dup, "_scored", lambda c, s, t: (counted.append(c.count()), scored(c, s, t))[1])
    rng = random.Random(5)
    rows = [(i, [f"r{i % 10}"] + rng.sample([f"w{j}" for j in range(3000)], 60 + 5 * (i % 4))) for i in range(200)]
    assert kept_ids(make(spark, rows)) == set(range(200))
    assert sum(counted) < 20


def test_sets_that_share_early_tokens_meet_in_similar_slices_only(spark, monkeypatch):
    """Nearly all pairs of these sets share some of their first tokens; none of them is written as a candidate."""
    counted = []
    likely = near_dup._likely
    monkeypatch.setattr(near_dup, "_likely", lambda c, s, t: (counted.append(c.count()), likely(c, s, t))[1])
    rng = random.Random(9)
    rows = [(i, rng.sample([f"w{j}" for j in range(1500)], 180 + 10 * (i % 5))) for i in range(300)]
    assert kept_ids(make(spark, rows)) == set(range(300))
    assert sum(counted) < 100


def test_articles_are_tokenised_once_for_their_sets(spark):
    text = near_dup.article_sets(news.clean_articles(td.articles(spark, SF)))._jdf.queryExecution().executedPlan().toString()
    assert text.count("regexp_extract_all(") == 1


def test_families_of_all_sizes_in_many_rounds(spark, monkeypatch):
    """Sets of all classes and their guests; few are met in a round, and a token goes on in the next batch."""
    monkeypatch.setattr(near_dup, "FIRST", 1)
    monkeypatch.setattr(near_dup, "GROWTH", 2)
    monkeypatch.setattr(near_dup, "TOGETHER", 300)
    rng = random.Random(4)
    rows = [(i, rng.sample([f"v{j}" for j in range(12)], rng.randrange(1, 8))) for i in range(60)]
    for i in range(60, 400):
        size, change = 40 * 2 ** (i % 6), 0.02 + 0.03 * (i % 5)
        rows.append((i, [f"f{size}_{j}" for j in range(size) if rng.random() > change] + [f"x{rng.randrange(900)}" for _ in range(rng.randrange(1 + size // 8))]))
    assert kept_ids(make(spark, rows)) == greedy(rows)
    sets = [(i, frozenset(t)) for i, t in rows]
    brute = {(i, j) for n, (i, a) in enumerate(sets) for j, b in sets[n + 1:] if len(a & b) / len(a | b) > 0.7}
    assert {(r["first"], r["second"]) for r in near_dup.article_pairs(make(spark, rows)).collect()} == brute


def test_frequent_tokens_make_no_rows(spark):
    """Sets that share only tokens too far back for a similar pair are not even counted, however many hold them."""
    common = [f"c{j}" for j in range(76)]
    df = make(spark, [(i, [f"own{i}_{j}" for j in range(24)] + common) for i in range(60)])
    sets = near_dup.article_sets(df)
    prefix = near_dup.prefixes(near_dup.signatures(sets, near_dup.copies_of(sets), 0.7))
    sides = prefix.alias("a").join(prefix.alias("b"), (F.col("a.token") == F.col("b.token")) & (F.col("a.id") < F.col("b.id")) & near_dup._may_match(0.7))
    assert sides.count() == 0
    assert kept_ids(df) == set(range(60))


def test_article_ids_upsert(spark):
    raw = spark.createDataFrame(
        [("old", "c", "u1", "2026-01-01"), ("new", "c", "u1", "2026-01-02"), ("x", "c", "u2", "2026-01-01")],
        "title string, content string, url string, published_date string")
    out = {r["url"]: r for r in news.article_ids(raw).collect()}
    assert out["u1"]["title"] == "new" and len(out) == 2 and len(out["u1"]["article_id"]) == 32


def articles(spark):
    rows = [
        ("a", "T1", "SEC approval of the BlackRock ETF drives a Bitcoin rally, btc inflow growth", "CoinDesk", "2026-05-25T14:00:00Z"),
        ("b", "T2", "Hack and exploit panic: exchange hacked, fraud lawsuit", "Other", "2026-05-25T03:00:00Z"),
        ("c", "T3", "Nothing here", "Other", "not a date"),
    ]
    df = spark.createDataFrame(rows, "article_id string, title string, content string, source string, published_date string")
    return news.clean_articles(df)


def test_lexicon_and_impact(spark):
    scored = news.lexicon_sentiment(articles(spark))
    rows = {r["article_id"]: r for r in scored.collect()}
    # approval 1, rally .5, inflow .5, growth 1
    assert rows["a"]["sentiment_score"] == pytest.approx(0.75) and rows["a"]["confidence_score"] == 1.0
    # the stem of "hacked" is "hack": hack, exploit, panic, hack, fraud, lawsuit
    assert rows["b"]["sentiment_score"] == -1.0 and rows["b"]["sentiment_class"] == "Bearish"
    assert (rows["c"]["sentiment_score"], rows["c"]["confidence_score"], rows["c"]["sentiment_class"]) == (0.0, 1.0, "Neutral")
    impact = {r["article_id"]: r for r in news.impact_score(scored).collect()}
    # keywords sec 1, blackrock .9, etf 1, inflow none
    assert impact["a"]["market_impact_score"] == pytest.approx(.35 * 75 + .25 * 90 + .2 * min(100, 2.9 * 20) + .2 * 95)
    assert impact["b"]["market_impact_score"] == pytest.approx(.35 * 100 + .25 * 60 + .2 * 60 + .2 * 50)
    assert impact["c"]["market_impact_score"] == pytest.approx(.25 * 60 + .2 * 75)  # unreadable time counts as noon
    assert impact["c"]["market_impact_class"] == "Medium Impact"


def test_entities(spark):
    found = news.entity_rows(news.extract_entities(articles(spark))).collect()
    got = {(r["article_id"], r["entity"], r["entity_type"]) for r in found}
    assert got == {
        ("a", "Bitcoin (BTC)", "Coin"), ("a", "BlackRock", "Institution"),
        ("a", "SEC (Securities and Exchange Commission)", "Regulator"),
        ("a", "SEC (Securities and Exchange Commission)", "Institution")}
    assert len(found) == 4  # btc and bitcoin are one entity


def test_batch_scorer_hook(spark):
    def scorer(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"sentiment_score": texts.str.len() * 0.0 + 0.5, "confidence_score": 0.9})

    out = news.batch_sentiment(articles(spark), scorer).collect()
    assert len(out) == 3 and {r["sentiment_class"] for r in out} == {"Bullish"}


def test_overview_of_nothing(spark):
    scores = news.score_table(news.lexicon_sentiment(articles(spark))).limit(0)
    row = news.sentiment_overview(scores).first()
    assert row["total_articles"] == 0 and row["bullish_ratio"] == 0.0 and row["market_sentiment_bias"] == "Neutral"


def test_trends_by_hand(spark):
    scores = spark.createDataFrame(
        [("a", "2026-01-01T01:00:00Z", 0.2), ("b", "2026-01-01T02:00:00Z", 0.4), ("c", "2026-01-02T01:00:00Z", -0.1)],
        "article_id string, published_date string, sentiment_score double")
    silver = spark.createDataFrame([("2026-01-02", 0.05), ("2026-01-02", 0.15)], "date string, roe double").withColumn("date", F.to_date("date"))
    one, two = trends.sentiment_trends(scores, silver).orderBy("date").collect()
    assert one["sentiment_momentum"] == pytest.approx(0.3) and one["sentiment_volatility"] == 0.0 and one["sentiment_acceleration"] == 0.0
    assert one["roe"] == pytest.approx(0.1)  # backward fill
    assert two["sentiment_momentum"] == pytest.approx(0.1) and two["sentiment_acceleration"] == pytest.approx(-0.2)
    assert two["divergence"] == pytest.approx(0.0)


def test_topic_model_labels_every_article(spark):
    docs = td.articles(spark, SF)
    out = topics.topic_table(topics.topic_model(news.clean_articles(docs), td.THEMES)).collect()
    assert len(out) == docs.count()
    assert {r["topic_cluster_id"] for r in out} <= {0, 1, 2, 3}
    assert {r["topic_theme"] for r in out} <= {*td.THEMES, "Macroeconomic Events"}
    assert len({(r["topic_cluster_id"], r["topic_theme"]) for r in out}) == len({r["topic_cluster_id"] for r in out})


def test_token_sets_are_stored_as_places_in_a_dictionary(spark):
    from tradewinds.session import cut_lineage

    # half of the tokens are frequent, the others come from more than 1 MB of hashes
    number = lambda i: F.xxhash64("id", i).bitwiseAND(F.lit((1 << 40) - 1)) % F.when(i % 2 == 0, 500).otherwise(200_000)
    rows = spark.range(120_000, numPartitions=1).select("id", F.transform(F.sequence(F.lit(0), F.lit(29)), lambda i: F.xxhash64(number(i))).alias("tokens"))
    sizes = []
    for options in ({}, near_dup.DICTIONARY):
        files = cut_lineage(rows, **options).inputFiles()
        sizes.append(sum(os.path.getsize(f.removeprefix("file:").replace("///", "/")) for f in files))
    assert sizes[1] < 0.6 * sizes[0]


def test_the_kept_articles_are_stored_without_their_raw_text(spark):
    from tradewinds.plans import news_queries

    kept_articles = news_queries.kept(spark, "/root/testdata/sf0.001")
    assert not {"content", "title_clean"} & set(kept_articles.columns) and {"title", "content_clean", "tokens", "source", "author", "published_date"} <= set(kept_articles.columns)
