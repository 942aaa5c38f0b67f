import random
from collections import Counter

import numpy as np
import pytest

from tradewinds.llm import toxicity
from tradewinds.llm.queries import op6_toxicity


def test_block_max_search_is_exact():
    rng = np.random.default_rng(4)
    n_terms, vectors = 60, []
    for i in range(500):
        terms = np.unique(rng.zipf(1.4, size=rng.integers(0, 9)) % n_terms)
        weights = rng.random(len(terms)) + 0.1
        vectors.append((terms, weights / np.sqrt((weights ** 2).sum()) if len(terms) else weights))
    index = toxicity.ExampleIndex(vectors, rng.random(500) < 0.5, list(range(500)), n_terms)
    dense = np.zeros((500, n_terms))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    dense = dense[index.ids]
    for t, w in vectors[:150]:
        query = np.zeros(n_terms)
        query[t] = w
        scores = dense @ query
        want = sorted(((-round(s, 9), i) for i, s in enumerate(scores) if s > 0))[:7]
        got = index.nearest(t, w, 7)
        assert [round(s, 9) for s, _ in got] == [-s for s, _ in want]
        assert all(abs(scores[i] - s) < 1e-9 for s, i in got)


@pytest.fixture
def odd(spark):
    rng = random.Random(1)
    mild, foul = "green river stone window paper lamp", "gremlin blasted rotter"
    rows = [(i, " ".join(rng.choices(mild.split(), k=12)) + (" " + rng.choice(foul.split()) * 1 if i % 4 == 0 else ""), "en", 1.0, None) for i in range(200)]
    rows += [(900, None, None, None, None), (901, "", None, None, None), (902, "Gremlin! " * 30_000, None, None, None), (903, "12 34 ?!", None, None, None),
             (None, "a rotter", None, None, None), (904, "green", None, None, None), (904, "green", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, id string")
    labels = spark.createDataFrame([(i, None, int(i % 4 == 0)) for i in range(200)] + [(901, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_odd_rows(odd):
    docs, labels = odd
    model = toxicity.train(docs, labels, docs)
    got = {}
    for r in toxicity.score(docs, model).collect():
        got.setdefault(r.id, []).append(r)
    assert all(got[i][0].predicted == int(i % 4 == 0) for i in range(200))
    assert [got[i][0].predicted for i in (900, 901, 902, 903, None, 904)] == [0, 0, 1, 0, 1, 0] and len(got[904]) == 2
    assert got[900][0].evidence == [] and got[902][0].evidence[0].toxic == 1
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({i: len(r) for i, r in got.items() if not r[0].predicted})
    assert toxicity.score(docs.limit(0), model).count() == 0
    empty = toxicity.train(docs.limit(0), labels, docs)
    assert {r.predicted for r in toxicity.score(docs, empty).collect()} <= {0, 1}


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op6_toxicity(spark, sf).collect()
    held = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and truth.get(r.doc_id) is not None]
    hits, said, there = sum(t and p for t, p in held), sum(p for _, p in held), sum(t for t, _ in held)
    assert hits / said > 0.88 and hits / there > 0.7
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
