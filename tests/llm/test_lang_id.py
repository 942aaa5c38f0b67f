import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tradewinds.llm import lang_id
from tradewinds.llm.queries import op2_ppm_language


def grams(texts):
    counts = Counter()
    for lang, text in texts:
        b = text.encode()
        for i in range(len(b) - lang_id.ORDER):
            counts[lang, int.from_bytes(b[i:i + lang_id.ORDER + 1], "big")] += 1
    return (np.array([k[0] for k in counts], dtype=object), np.array([k[1] for k in counts], dtype=np.int64), np.array(list(counts.values()), dtype=float))


class Slow:
    """Prediction by partial matching as a plain walk down one language's tree."""

    def __init__(self, texts):
        self.tree = defaultdict(Counter)
        for text in texts:
            b = text.encode()
            for i in range(lang_id.ORDER, len(b)):
                for k in range(lang_id.ORDER + 1):
                    self.tree[b[i - k:i]][b[i]] += 1

    def bits(self, text):
        b, out = text.encode(), 0.0
        for i, byte in enumerate(b):
            k = min(i, lang_id.ORDER)
            while True:
                seen = self.tree.get(b[i - k:i]) if k >= 0 else None
                if k < 0:
                    out += 8
                    break
                if seen:
                    mass = sum(seen.values()) + len(seen)
                    if byte in seen:
                        out -= math.log2(seen[byte] / mass)
                        break
                    out -= math.log2(len(seen) / mass)
                k -= 1
        return out


def test_code_lengths_equal_a_plain_walk():
    texts = {"aa": ["the cat sat on the mat", "a cat", "that hat!"], "bb": ["der hut ist gut", "größe und mut", "ab"]}
    trees = lang_id.ContextTrees(*grams([(l, t) for l, ts in texts.items() for t in ts]))
    queries = ["the hut", "", "größer", "日本", "x", "cat cat cat", "\x00the"]
    data = "".join(queries).encode()
    offsets = np.cumsum([0, *(len(q.encode()) for q in queries)])
    got = trees.code_lengths(np.frombuffer(data, dtype=np.uint8), offsets)
    for i, lang in enumerate(trees.languages):
        slow = Slow(texts[lang])
        assert np.allclose(got[:, i], [slow.bits(q) for q in queries], rtol=1e-4)


@pytest.fixture
def odd(spark):
    rows = [(1, "the cat and the dog", "en", "x", 0.5), (2, "der hund und die katze", "de", None, None), (3, None, "en", "x", 1.0), (4, "", "de", "x", 1.0),
            (5, "1234 !? \n", None, "x", 1.0), (6, "the dog", None, None, None), (None, "der hund", None, None, None), (1, "the cat and the dog", "en", "x", 0.5),
            (7, "und die " * 50_000, None, "x", 0.0), (8, "é", None, "x", 0.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double")


def test_odd_rows(odd):
    got = sorted(((r.id, r.lang_pred, r.score) for r in lang_id.identify(odd, lang_id.train(odd)).collect()), key=str)
    assert [g[1] for g in got] == ["en", "en", "de", "und", "und", "und", "en", "de", got[-2][1], "de"]
    assert got[-1][0] is None and got[-2][1] in ("de", "en") and all(0 <= g[2] <= 1 for g in got)
    assert lang_id.identify(odd.limit(0), lang_id.train(odd)).count() == 0
    nothing = lang_id.identify(odd, lang_id.train(odd.limit(0))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_training_is_bounded(odd):
    assert list(lang_id.train(odd, rows=1).languages) == ["de", "en"]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op2_ppm_language(spark, sf).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
