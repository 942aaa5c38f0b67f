import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tradewinds.llm import jaccard_join
from tradewinds.llm.components import components
from tradewinds.llm.queries import op4_parity_sketch_join


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for (i, a), (j, b) in combinations(sets, 2):
        if a and b and i is not None and j is not None and 100 * len(a & b) >= percent * len(a | b):
            x, y = find(i), find(j)
            parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def family(seed, n=220):
    """Texts of many sizes with copies, edits of every strength, chains of edits, and a passage that many share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=30)
    texts = []
    while len(texts) < n:
        size = rng.choice([0, 1, 2, 3, 4, 9, 12, 20, 40, 90, 200, 600])
        base = rng.choices(vocabulary, k=size)
        if rng.random() < 0.3:
            base += passage
        for _ in range(rng.choice([1, 1, 2, 6, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 5, len(copy) // 40])):
                if copy:
                    copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy).upper() if rng.random() < 0.1 else "\t".join(copy))
            if rng.random() < 0.5:
                base = copy
    ids = rng.sample(range(1, 10 * n), n)
    return list(zip(ids, texts[:n]))


@pytest.mark.parametrize("k,percent,seed", [(3, 90, 1), (5, 80, 2), (3, 80, 3), (2, 95, 4)])
def test_components_equal_brute_force(spark, k, percent, seed):
    rows = family(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in jaccard_join.near_duplicates(df, k, percent).collect()), key=str)
    assert got == brute(rows, k, percent)


def test_every_linked_pair_shares_a_cell():
    for percent in (80, 90):
        bands = jaccard_join.Bands(percent)
        for seed in range(6):
            rows = family(seed + 10, 150)
            run, text = jaccard_join.text_sets(pa.array([t for _, t in rows]), 3)
            keys, ids = jaccard_join.sketch_rows(run, text, np.array([i for i, _ in rows]), bands)
            of = {}
            for key, i in zip(keys.tolist(), ids.tolist()):
                of.setdefault(i, set()).add(key)
            sets = [(i, shingles(t, 3)) for i, t in rows]
            for (i, a), (j, b) in combinations(sets, 2):
                if a and a != b and 100 * len(a & b) >= percent * len(a | b):
                    assert of[i] & of[j]


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None, "x", 1), (2, "", None, None), (3, " \n", "x", 1), (4, "One two", "x", 1), (5, "one\ttwo", "x", 1), (6, "one two three", "x", 1),
            (7, long, "x", 1), (8, long + " more", "x", 1), (9, "a b c", "x", 1), (9, "a b c", "x", 1), (None, "a b c", None, None), (10, "A b c", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, id int")
    got = sorted((tuple(r) for r in jaccard_join.near_duplicates(df, 3, 90).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 29998, 7), (8, 29999, 7), (9, 1, 9), (9, 1, 9),
                          (None, 1, None), (10, 1, 9)], key=str)
    kept = jaccard_join.keep_one(df, 3, 90)
    assert kept.columns == df.columns and sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 2, 3, 4, 6, 7, 9, 9]
    assert jaccard_join.near_duplicates(df.limit(0)).count() == 0


def test_components_of_long_chains(spark):
    rng = random.Random(1)
    nodes = rng.sample(range(1000), 300)
    links = list(zip(nodes[:200], nodes[1:200])) + [(nodes[200], x) for x in nodes[201:]] + [(5000, 5000)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{n: min(nodes[:200]) for n in nodes[:200]}, **{n: min(nodes[200:]) for n in nodes[200:]}}


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in op4_parity_sketch_join(spark, sf).collect()), key=str)
    assert got == brute(rows, 3, 90)


def test_cells_with_the_same_members_stay_once(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(5000)]
    rows = []
    for i in range(30):  # pairs of long texts that share most of some 60 cells
        base = rng.choices(vocabulary, k=600)
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[:-1] + ["end"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cells = jaccard_join.buckets(df, 3, 90, "doc_id", "text").collect()
    members = {}
    for r in cells:
        members.setdefault(r.key, set()).add(r.id)
        assert r.leader == min(r.id, r.id ^ 1)
    assert {frozenset(m) for m in members.values()} == {frozenset((2 * i, 2 * i + 1)) for i in range(30)}
    assert len(cells) < 6 * len(rows)  # once, and what goes over the edges of batches


def test_links_beside_refuted_ones_are_found(spark, monkeypatch):
    """All members of the only cell look alike by their sketches; none is linked with the least one, two are with each other."""
    rng = random.Random(9)
    words = [[f"{d}w{i}" for i in range(200)] for d in "abc"]
    near = list(words[1])
    near[rng.randrange(200)] = "other"
    rows = [(i + 1, " ".join(w)) for i, w in enumerate([words[0], words[1], words[2], near])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sketches = jaccard_join.parity_sketches
    monkeypatch.setattr(jaccard_join, "parity_sketches", lambda *a: sketches(*a).selectExpr("id", "n", f"cast(repeat('0', {jaccard_join.SKETCH_BITS // 8}) as binary) as sketch"))
    monkeypatch.setattr(jaccard_join, "buckets", lambda *a: spark.createDataFrame([(7, i, 1) for i in range(1, 5)], "key long, id long, leader long"))
    got = sorted(tuple(r) for r in jaccard_join.near_duplicates(df, 3, 90).collect())
    assert got == brute(rows, 3, 90) and got[3] == (4, 198, 2)
