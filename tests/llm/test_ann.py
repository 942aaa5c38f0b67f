from collections import defaultdict

import numpy as np
import pytest

from tradewinds.llm import ann
from tradewinds.llm.queries import op1_hnsw


def brute(rows, queries, k):
    out = {}
    for q, v in queries:
        scored = sorted(((-float(np.dot(np.array(v), np.array(w))), i) for i, w in rows if i != q and len(w) == len(v)))
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_recall_on_embeddings(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect() if r.embedding is not None]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    got = defaultdict(list)
    for r in op1_hnsw(spark, sf).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    vectors = dict(rows)
    hits = 0
    for q, found in got.items():
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True) and q not in dict(found)
        assert all(abs(s - np.dot(np.array(vectors[q]), np.array(vectors[i]))) < 1e-12 for i, s in found)
        hits += len({i for i, _ in found} & {i for i, _ in want[q]})
    assert set(got) == set(want) and all(len(f) == 20 for f in got.values())
    assert hits / (20 * len(want)) >= 0.95


def test_many_shards_uneven_norms():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 12)) * rng.lognormal(0, 0.7, size=(1500, 1))
    graph = ann.SmallWorld(x)
    found = graph.search(x[:100], 10)
    true = np.argsort(-(x[:100] @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found.tolist(), true.tolist())]) > 0.9


@pytest.fixture
def odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(20, [1.0, 0.0], 1, "a"), (1, [1.0, 0.0], 1, "a"), (2, [0.0, 0.0], 1, "a"), (3, None, 1, "a"), (4, [None, 1.0], 1, "a"),
            (5, [nan, 1.0], 1, "a"), (6, [inf, 1.0], 1, "a"), (7, [0.5, 0.5], None, None), (8, [], 1, "a"), (None, [1.0, 1.0], 1, "a"),
            (9, [1.0, 2.0, 3.0], 1, "a"), (40, [-1.0, 0.0, 0.0], 1, "a"), (7, [0.5, 0.5], None, None), (60, None, 1, "a")]
    rows += [(100 + i, [2.0, 0.0], 1, "a") for i in range(40)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, shard string")


@pytest.mark.parametrize("shard_rows", [4, 1000])
def test_odd_vectors(odd, shard_rows):
    got = ann.nearest(odd, odd.where("vec_id % 20 = 0"), 20, shard_rows=shard_rows)
    rows = [tuple(r) for r in got.orderBy("query_id", "rank").collect()]
    of = {q: [r[2] for r in rows if r[0] == q] for q in (20, 40, 100, 120)}
    assert of[20] == list(range(100, 120)) and of[40] == [9]
    assert of[100] == list(range(101, 121)) and of[120] == [i for i in range(100, 121) if i != 120]
    assert {r[0] for r in rows} == set(of)
    few = ann.nearest(odd.where("vec_id < 100"), odd.where("vec_id = 20"), 20, shard_rows=shard_rows)
    assert [tuple(r) for r in few.orderBy("rank").collect()] == [(20, 1, 1, 1.0), (20, 2, 7, 0.5), (20, 3, 7, 0.5)]
    assert ann.nearest(odd.limit(0), odd, 20).count() == 0 and ann.nearest(odd, odd.limit(0), 20).count() == 0
