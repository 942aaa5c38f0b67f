import hashlib
import random

import pytest

from tradewinds.llm import repeats
from tradewinds.llm.queries import op10_suffix_array_dedup
from tradewinds.llm.suffix_array import suffix_array


def test_suffix_array():
    rng = random.Random(1)
    for t in range(1500):
        text = bytes(rng.choice(b"ab" if t % 2 else b"ab\xffcd") for _ in range(rng.randrange(0, 60)))
        if t % 5 == 0:
            text = text[:5] * 8
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:]), text


def brute(rows, length=repeats.LENGTH):
    """id -> (kept bytes, spans), by looking up every string of ``length`` bytes in order."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            s = raw[i:i + length]
            if s in seen:
                gone[i:i + length] = b"\x01" * length
            seen.add(s)
        spans = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[doc] = (bytes(b for b, g in zip(raw, gone) if not g), spans)
    return out


def hard(seed):
    """Texts that share passages at all offsets, overlapping repeats, runs of one letter, copies with edits."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    common = [prose(n) for n in (12, 20, 30, 60, 100)]
    texts = ["", "a" * 99, "a" * 100, "a" * 101, "a" * 350, "ab" * 300, "aab" * 100, "\x00" * 250, "x\x00" * 90]
    for _ in range(90):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts.append(rng.choice([prose(rng.randrange(1, 60)), rng.choice(common), rng.choice(common)[rng.randrange(9):]]))
        texts.append(rng.choice([" ", "", "\n"]).join(parts))
    for t in rng.sample(texts[9:], 30):
        t = list(t)
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = rng.choice("xyzß")
        texts.append("".join(t))
    ids = rng.sample(range(-50, 5000), len(texts))
    return list(zip(ids, texts))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = hard(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (bytes(r.kept), len(r.spans)) for r in repeats.remove_repeats(df).collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    for doc in want:
        assert got[doc] == want[doc], doc


def test_odd_rows(spark):
    pick = random.Random(5)
    p = "".join(pick.choice("abcdefgh ") for _ in range(240))
    rows = [(3, p, "x", b"1"), (1, p[:150], None, None), (2, None, "x", None), (None, p, "x", None), (4, "", "", None), (5, p * 400, "x", None), (3, p, "x", b"1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, kept binary")
    out = repeats.remove_repeats(df)
    assert out.columns == ["doc_id", "text", "n_bytes", "n_removed", "spans", "kept"]
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed) for r in out.collect()), key=str)
    # document 3 comes twice and is one document; its bytes before 150 are in document 1, document 5 repeats both and itself
    assert got[:5] == [(1, 150, 0), (2, 0, 0), (3, 240, 150), (3, 240, 150), (4, 0, 0)] and got[6] == (None, 240, 0)
    assert repeats.remove_repeats(df.limit(0)).count() == 0
    assert brute([(3, p), (1, p[:150]), (5, p * 400)])[5][0] == bytes(next(r.kept for r in out.collect() if r.doc_id == 5))


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    want = brute([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])
    for r in op10_suffix_array_dedup(spark, sf).collect():
        kept, spans = want[r.doc_id]
        assert (r.n_bytes - r.n_removed, r.n_spans, r.kept_sha256) == (len(kept), spans, hashlib.sha256(kept).hexdigest())
