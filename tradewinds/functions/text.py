"""Text column builders: cleaning, tokens, set overlap, dictionary weights. All run in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from tradewinds import vocab
from tradewinds.functions.trade import as_col


def clean_text(text) -> Column:
    """Non-ASCII runs, then tags, then URLs become a blank."""
    c = F.regexp_replace(as_col(text), vocab.NON_ASCII_PATTERN, " ")
    c = F.regexp_replace(c, vocab.TAG_PATTERN, " ")
    return F.regexp_replace(c, vocab.URL_PATTERN, " ")


def tokenize(text) -> Column:
    return F.regexp_extract_all(F.lower(as_col(text)), F.lit(vocab.TOKEN_PATTERN), F.lit(0))


def remove_stop_words(tokens, stop_words=None) -> Column:
    words = list(stop_words if stop_words is not None else vocab.STOP_WORDS)
    return F.filter(as_col(tokens), lambda t: (F.length(t) > 1) & ~t.isin(words))


def light_stem(tokens) -> Column:
    """Drop a plural ``s`` (not ``ss``), else a final ``ed``, else a final ``ing``."""

    def stem(t):
        size = F.length(t)
        return (
            F.when(t.endswith("s") & ~t.endswith("ss"), F.substring(t, F.lit(1), size - 1))
            .when(t.endswith("ed"), F.substring(t, F.lit(1), size - 2))
            .when(t.endswith("ing"), F.substring(t, F.lit(1), size - 3))
            .otherwise(t)
        )

    return F.transform(as_col(tokens), stem)


def content_tokens(clean) -> Column:
    return light_stem(remove_stop_words(tokenize(clean)))


def jaccard(a, b) -> Column:
    left, right = as_col(a), as_col(b)
    both = F.size(F.array_intersect(left, right))
    return F.when((F.size(left) == 0) | (F.size(right) == 0), 0.0).otherwise(
        both / F.size(F.array_union(left, right))
    )


def token_weights(tokens, weights: dict[str, float]) -> Column:
    """Array of the weights of the tokens found in a small dictionary, repeats included.

    The membership test is a hash-set lookup; only the hits reach the map.
    """
    if not weights:
        return F.array().cast("array<double>")
    pairs = [F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))]
    table = F.create_map(*pairs)
    hits = F.filter(as_col(tokens), lambda t: t.isin(list(weights)))
    return F.transform(hits, lambda t: F.element_at(table, t))


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def keyword_hits(text, keywords: list[str]) -> Column:
    """Distinct keywords that occur in the text between word boundaries.

    Keywords made of word characters only match whole words, of which at most
    one keyword can sit at a place, so one alternation finds them all in one
    pass. Phrases (blank or punctuation inside) may overlap other keywords and
    take a literal pattern each.
    """
    plain = [k for k in keywords if re.fullmatch(r"\w+", k, re.ASCII)]
    phrases = [k for k in keywords if k not in plain]
    lowered = F.lower(as_col(text))
    if plain:
        hits = F.array_distinct(F.regexp_extract_all(lowered, F.lit(r"\b(?:" + "|".join(plain) + r")\b"), F.lit(0)))
    else:
        hits = F.array().cast("array<string>")
    for phrase in phrases:
        found = lowered.rlike(r"\b" + re.escape(phrase) + r"\b")
        hits = F.when(found, F.array_append(hits, F.lit(phrase))).otherwise(hits)
    return hits


def theme_of_words(words, themes: dict[str, list[str]] | None = None, default: str | None = None) -> Column:
    """Theme sharing most keywords with the word list; the earlier theme wins a tie."""
    themes = themes or vocab.THEMES
    default = default or vocab.DEFAULT_THEME
    scored = F.array(*[
        F.struct(
            F.size(F.array_intersect(as_col(words), F.array(*[F.lit(k) for k in keys]))).alias("matches"),
            F.lit(-i).alias("priority"),
            F.lit(theme).alias("theme"),
        )
        for i, (theme, keys) in enumerate(themes.items())
    ])
    best = F.array_max(scored)
    return F.when(best["matches"] > 0, best["theme"]).otherwise(default)


def sentiment_label(score, cut: float = 0.15) -> Column:
    s = as_col(score)
    return F.when(s > cut, "Bullish").when(s < -cut, "Bearish").otherwise("Neutral")
