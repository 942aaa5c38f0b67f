"""Byte-level BPE encoding and decoding with contiguous rank arrays."""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from tradewinds.llm.common import pieces

#: The pattern that byte-level tokenizers of this kind split texts by (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A word with more bytes is merged with a heap instead of repeated scans.
SHORT_WORD = 128
#: Words remembered within a task before the memory is emptied.
REMEMBERED = 400_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: printable bytes for themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def load_vocabulary(path: str) -> dict:
    """Reads a tokenizers file: ids of single bytes, merges ``(left, right) -> rank``, id made by each rank, bytes of
    each id, and special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters, ids = byte_letters(), spec["model"]["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    table = {i: bytes(letters[c] for c in token) for token, i in ids.items()} | {i: t.encode() for t, i in special.items()}
    return {
        "byte_ids": [ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])],
        "ranks": {(ids[a], ids[b]): r for r, (a, b) in enumerate(merges)},
        "made": [ids[a + b] for a, b in merges],
        "bytes": [table.get(i, b"") for i in range(max(table) + 1)],
        "special": special,
    }


def merge_short(parts: list[int], ranks: dict, made: list[int]) -> list[int]:
    """Merge a short word in place.

    ``parts`` and the ranks of adjacent parts are contiguous arrays. Scan for
    the least rank (the first of equals), delete the boundary behind it, and
    refresh the ranks to its left and right, until no pair has a rank.
    """
    none = len(made)
    near = [ranks.get(pair, none) for pair in zip(parts, parts[1:])]
    while near:
        least = min(near)
        if least == none:
            break
        i = near.index(least)
        parts[i] = made[least]
        del parts[i + 1], near[i]
        if i < len(near):
            near[i] = ranks.get((parts[i], parts[i + 1]), none)
        if i:
            near[i - 1] = ranks.get((parts[i - 1], parts[i]), none)
    return parts


def merge_long(parts: list[int], ranks: dict, made: list[int]) -> list[int]:
    """The same merges for a long word, in n log n: a heap of ranked boundaries over linked parts."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[pair], i, *pair) for i, pair in enumerate(zip(parts, parts[1:])) if pair in ranks]
    heapq.heapify(heap)
    parts = [*parts, -1]
    while heap:
        rank, i, left, right = heapq.heappop(heap)
        j = after[i]
        if parts[i] != left or j >= n or parts[j] != right:
            continue
        parts[i], parts[j] = made[rank], -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            pair = (parts[i], parts[after[i]])
            if pair in ranks:
                heapq.heappush(heap, (ranks[pair], i, *pair))
        if before[i] >= 0:
            pair = (parts[before[i]], parts[i])
            if pair in ranks:
                heapq.heappush(heap, (ranks[pair], before[i], *pair))
    return [p for p in parts[:n] if p >= 0]


class Encoder:
    """Encodes texts to ids, remembering the ids of words it has met."""

    def __init__(self, path: str):
        self.path, self.vocabulary = path, load_vocabulary(path)
        self.words = regex.compile(PATTERN)
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.vocabulary["special"])) + ")") if self.vocabulary["special"] else None
        # the library's tables of letters and digits are of another Unicode version; below this point both agree
        self.rare = regex.compile(r"[^\u0000-\u036f\u2010-\u2027\u20ac]")
        self.splitter = None
        self.known: dict[str, bytes] = {}

    def _split(self, text: str) -> list[str]:
        if not self.rare.search(text):
            return self.words.findall(text)
        if self.splitter is None:
            from tokenizers import Tokenizer
            self.splitter = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def word(self, word: str) -> list[int]:
        """The ids of one word."""
        v = self.vocabulary
        parts = list(map(v["byte_ids"].__getitem__, word.encode()))
        return (merge_short if len(parts) <= SHORT_WORD else merge_long)(parts, v["ranks"], v["made"])

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if self.special and (chunks := self.special.split(text))[1:]:
            ids = self.vocabulary["special"]
            return b"".join(ids[c].to_bytes(4, "little") if c in ids else self.encode_plain(c) for c in chunks if c)
        return self.encode_plain(text)

    def encode_plain(self, text: str) -> bytes:
        split = self._split(text)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        for word in set(split).difference(self.known):
            self.known[word] = b"".join(i.to_bytes(4, "little") for i in self.word(word))
        return b"".join(map(self.known.__getitem__, split))


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` without its text, with the token ids of every whole text as ``ids_col`` and their number as ``n_tokens``.

    Ids are packed as little-endian unsigned 32-bit integers. A null text counts
    as empty and has no ids. Special tokens in a text become their ids. Columns
    of ``df`` that are called like a new one are replaced; the others stay, rows
    that repeat too. ``path`` is the vocabulary file, present on every executor.
    """
    rest = [f for f in df.schema if f.name not in (text_col, ids_col, "n_tokens")]
    schema = StructType([*rest, StructField(ids_col, BinaryType()), StructField("n_tokens", LongType())])

    def run(batches):
        encoder = Encoder(path)
        for batch in batches:
            texts = batch.column(0)
            for start, part in pieces(texts):
                ids = [encoder.encode(t) for t in part.to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    *(c.slice(start, len(part)) for c in batch.columns[1:]), pa.array(ids, pa.binary()),
                    pa.array([len(i) // 4 for i in ids], pa.int64())], schema.names)

    return df.select(F.col(text_col).alias("__text"), *(F.col(f"`{f.name}`") for f in rest)).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of packed ids as ``text_col``; null ids give an empty text, bytes that are no UTF-8 U+FFFD."""
    rest = [f for f in df.schema if f.name != text_col]
    schema = StructType([*rest, StructField(text_col, StringType())])

    def run(batches):
        table = load_vocabulary(path)["bytes"]
        for batch in batches:
            ids = pc.fill_null(batch.column(0), b"")
            ends, at = np.cumsum(np.asarray(pc.binary_length(ids), dtype=np.int64)), 0
            while at < len(ids):
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (2 << 20), side="right")))
                texts = [b"".join(map(table.__getitem__, np.frombuffer(x, dtype="<u4").tolist())).decode("utf-8", "replace")
                         for x in ids.slice(at, stop - at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(c.slice(at, stop - at) for c in batch.columns[1:]), pa.array(texts, pa.string())],
                                                 schema.names)
                at = stop

    return df.select(F.col(ids_col).alias("__packed"), *(F.col(f"`{f.name}`") for f in rest)).mapInArrow(run, schema)
