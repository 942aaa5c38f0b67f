import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tradewinds.llm import bpe, packing
from tradewinds.llm.queries import op7_nnls_packing, op9_bpe

SF = "/root/testdata/sf0.001"
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\n\n \n a", "don't we'll I'VE", "<|endoftext|>a<|endoftext|>", "x<|endoftext|", "a" * 5000, "ab" * 3000 + " " * 700,
       "äöüß ÉÈ ñ́ é Å   \x1c\x85 ok", "İΣΑΣ Σ", "日本語 text ١٢٣ ½ 𝔘𝔫𝔦 👍🏽", "՘࢏꟎ x", "!!!'s ...'t 1234 a1b2",
       "tab\tand\rreturn\x0bvt", " line  　wide", "<|startoftext|> Hi <|ENDOFTEXT|>", "\x00\x01\x7f"]


def noise(n, seed):
    rng = random.Random(seed)
    pool = "aebt \n\t.,'!0123ABsß éñ<|>" + "".join(map(chr, range(0x100, 0x370))) + "‐’“€ "
    return ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_encode_equals_library():
    ours, library = bpe.Encoder(BYTE), Tokenizer.from_file(BYTE)
    for text in ODD + noise(800, 1):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == want, text[:60]


def test_short_and_long_words_agree():
    v, rng = bpe.load_vocabulary(BYTE), random.Random(5)
    for _ in range(400):
        word = "".join(rng.choice("aehinrst ") for _ in range(rng.randrange(1, 60))).encode()
        parts = [v["byte_ids"][b] for b in word]
        assert bpe.merge_short(list(parts), v["ranks"], v["made"]) == bpe.merge_long(parts, v["ranks"], v["made"])


def test_word_tokenizer_equals_library():
    ours, library = packing.WordTokenizer(WORD), Tokenizer.from_file(WORD)
    texts = ODD + noise(800, 2)
    for text, packed in zip(texts, ours.encode(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text[:60]


@pytest.fixture
def odd(spark):
    rows = [(i, t, None, "s", i) for i, t in enumerate(ODD)] + [(None, None, None, None, None), (3, ODD[3], None, "s", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, offset string, len int")


def test_encode_decode_odd_rows(odd):
    library = Tokenizer.from_file(BYTE)
    out = bpe.decode(bpe.encode(odd.drop("ids"), BYTE), BYTE).collect()
    assert len(out) == len(ODD) + 2
    for r in out:
        text = ODD[r.doc_id] if r.doc_id is not None else ""
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == want and r.n_tokens == len(want)
        assert r.decoded == library.decode(want, skip_special_tokens=False) == text
    assert bpe.decode(bpe.encode(odd.limit(0), BYTE), BYTE).count() == 0
    assert bpe.encode(odd, BYTE).columns == ["doc_id", "offset", "len", "ids", "n_tokens"]


def test_bpe_documents(spark):
    library = Tokenizer.from_file(BYTE)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op9_bpe(spark, SF).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def check_packing(rows, ids_of, window):
    """Every id in exactly one piece, sequences gapless and within the window; the share of padding."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(docs) == set(ids_of)
    for doc, parts in docs.items():
        ids, at = ids_of[doc], 0
        for p in sorted(parts, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            at += p.length
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:at], "<u4").tobytes())
        assert at == len(ids)
    padding = 0
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding / max(1, len(sequences) * window)


def test_packing_documents(spark):
    library = Tokenizer.from_file(WORD)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids_of = {d: [*library.encode(t, add_special_tokens=False).ids, 1] for d, t in texts.items()}
    assert check_packing(op7_nnls_packing(spark, SF).collect(), ids_of, 2048) < 0.02


def test_words_are_split_like_the_library():
    """Letter classes, contractions, long words and special tokens; all texts of a slice are split at once."""
    rng = random.Random(3)
    texts = ["", "'s", "''s a'start 'rex 'llama don't I'VE we'll they're 'd'm't", "x²y 3¼12 Ⱥ İ", "<|startoftext|> <| a", "a" * 700 + " b",
             "=" * 600, "a\x85b\xa0c\x00d\x1c", "ÉtÉ —…'€5", "'", "a'", " \n\t "]
    texts += ["".join(rng.choice("abslrvemtd'' ''\"-. 12²éÉ\nLSTRV") for _ in range(rng.randrange(60))) for _ in range(500)]
    library, tokenizer = Tokenizer.from_file(WORD), packing.WordTokenizer(WORD)
    for packed, text in zip(tokenizer.encode(texts), texts, strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_remembered_words_stay_small(monkeypatch):
    """A remembered word costs some numbers, not objects."""
    tokenizer = packing.WordTokenizer(WORD)
    assert tokenizer.encode(["one two two", "two three"]) == tokenizer.encode(["one two two", "two three"])
    assert len(tokenizer.known) == len(tokenizer.begin) == len(tokenizer.size) == 3
    monkeypatch.setattr(packing, "REMEMBERED", 2)
    tokenizer.encode(["four"])
    assert len(tokenizer.known) == 1


def test_packing_odd_rows(odd):
    out = packing.pack(packing.cut(odd, WORD, window=16), window=16)
    rows = out.collect()
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
    assert sum(r.start == 0 for r in rows) == len(ODD) + 2
    at = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert at[r.sequence_id] == r.offset
        at[r.sequence_id] += r.length
    assert max(at.values()) <= 16
    assert packing.pack(packing.cut(odd.limit(0), WORD)).count() == 0


def test_plan_uses_up_the_histogram():
    rng = random.Random(2)
    for sizes in ([rng.randrange(1, 129) for _ in range(3000)], [100] * 50 + [20] * 70, [1], []):
        counts, used = Counter(sizes), Counter()
        for parts, times in packing.make_plan(dict(counts), 128):
            assert sum(parts) <= 128 and times > 0
            for length in parts:
                used[length] += times
        assert used == counts


def test_solve_is_least_squares():
    counts = {6: 10, 4: 7, 2: 9}
    x = packing.solve([(6, 4), (4, 4, 2), (6, 2, 2)], counts, sweeps=500)
    a = np.array([[1, 0, 1], [1, 2, 0], [0, 1, 2]], dtype=float)
    grad = a.T @ (a @ x - np.array([10, 7, 9]))
    assert (x >= 0).all() and (grad > -0.6).all() and (np.abs(grad[x > 0.3]) < 0.6).all()
