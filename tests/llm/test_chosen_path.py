import random

import numpy as np
import pytest

from tradewinds.llm import chosen_path as cp


def shingles(text, k):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def brute(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows if i is not None}
    least = {i: i for i in sets}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:] if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while True:
        before = dict(least)
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
        if least == before:
            return {(i, len(sets[i]), least[i]) for i in ids}


def family(pick, base, n, edits):
    """Copies of a text with a few words changed."""
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(pick.randint(0, edits)):
            words[pick.randrange(len(words))] = f"n{pick.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


def made(seed):
    pick = random.Random(seed)
    texts = []
    for size in (40, 12, 5):
        base = [f"w{pick.randrange(500)}" for _ in range(120)]
        texts += family(pick, base, size, 4)
    shared = [f"c{i}" for i in range(90)]  # a template that many documents share without being near copies
    texts += [" ".join(shared + [f"t{pick.randrange(10 ** 6)}" for _ in range(30)]) for _ in range(60)]
    texts += [" ".join(f"w{pick.randrange(500)}" for _ in range(pick.randint(0, 80))) for _ in range(60)]
    texts += texts[:15] + ["", " \t\n", None, "Two Words", "two words", "one", "A b c d e", "a B c d e"]
    pick.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("options", [{}, {"small": 4, "depth": 2}, {"weight": 2000, "depth": 1}])
def test_like_brute_force(spark, options):
    rows = made(4)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, signature string, component_id int").repartition(4)
    got = {tuple(r) for r in cp.near_duplicates(df, 5, 85, **options).collect()}
    assert got == brute(rows, 5, 85)


def test_a_large_family_is_one_component_without_its_pairs(spark, monkeypatch):
    pick = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = list(enumerate(family(pick, base, 1500, 3) + [" ".join(base)] * 1500))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    counted = []
    confirm = cp.confirmed
    monkeypatch.setattr(cp, "confirmed", lambda rows, percent: (counted.append(confirm(rows, percent).count()), confirm(rows, percent))[1])
    found = cp.near_duplicates(df, 5, 85)
    assert found.where("component_id = 0").count() == 3000
    assert counted[0] < 20 * 1500  # a family of 1500 has a million pairs


def test_repeated_and_null_ids_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(3, text), (3, "other words here"), (1, text + " more"), (None, text), (8, "other words here")], "doc_id long, text string")
    got = sorted((tuple(r) for r in cp.near_duplicates(df).collect()), key=str)
    assert got == sorted([(3, 46, 1), (3, 1, 1), (1, 47, 1), (None, 46, None), (8, 1, 1)], key=str)
    assert sorted(str(r.doc_id) for r in cp.keep_one(df).collect()) == ["1", "None"]
    assert cp.near_duplicates(df.limit(0)).count() == 0


def test_parameters():
    assert cp.trees(85, 0.999999) == 4
    assert cp.trees(85, 0.9) < cp.trees(60, 0.9)


def test_components_within_a_node_like_all_pairs():
    pick = random.Random(9)
    for _ in range(30):
        sets = [np.array(sorted(pick.sample(range(60), pick.randint(1, 12))), dtype=np.uint64) for _ in range(25)]
        links = [(i, j) for i in range(25) for j in range(i) if (c := len(np.intersect1d(sets[i], sets[j]))) and 100 * c >= 40 * (len(sets[i]) + len(sets[j]) - c)]
        root = list(range(25))
        for _ in range(25):
            for i, j in links:
                root[i] = root[j] = min(root[i], root[j])
        assert cp.node_components(np.array([len(x) for x in sets]), sets, 40).tolist() == root
