"""Packing token pieces into fixed windows: a non-negative least squares plan over the histogram of lengths."""

from __future__ import annotations

import os
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tradewinds.llm.common import codes, mix, pieces, powers, tidy

#: Tokens of a sequence, and the id that ends a document.
WINDOW, END_ID = 2048, 1
#: Words remembered within a task before the memory is emptied.
REMEMBERED = 400_000
#: Text bytes that are split at a time (a longer text stands alone).
SLICE_BYTES = 1 << 18
#: Combinations of the plan: partners tried for each length in combinations of three and four.
PARTNERS = 4
#: Sweeps of the least-squares solver.
SWEEPS = 25


class WordTokenizer:
    """Ids of a lower-casing word tokenizer, each word encoded by the tokenizers library once.

    Texts of common letters, which need no normalising but lower case, are split
    here, all texts of a slice at once, and their distinct words encoded together. Texts with other letters, with
    special tokens or with longer words than ``LONG`` go to the library whole. Words are compared by 64-bit hashes.
    """

    #: How this kind of tokenizer splits (fixed value): ``_split`` does the same by the class of each letter.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    #: Letters with a class (lower-case forms of common ones reach beyond these), and the longest word that is compared by its hash.
    LETTERS, LONG = 0x3000, 512

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        every = "".join(map(chr, range(self.LETTERS)))
        self.kind = np.full(self.LETTERS, 3, dtype=np.uint8)  # 0 separates, 1 is a letter, 2 a number, 3 anything else
        for value, pattern in ((0, r"\s"), (1, r"\p{L}"), (2, r"\p{N}")):
            self.kind[[m.start() for m in regex.finditer(pattern, every)]] = value
        self.common = np.zeros(self.LETTERS, dtype=bool)
        self.common[[m.start() for m in regex.finditer(r"[\u0000-\u012f\u0131-\u02ff\u2010-\u2027\u20ac]", every)]] = True
        self.codes, self.powers = codes(3, self.LETTERS), powers(self.LONG)
        size = self.library.get_vocab_size()
        self.ends = np.array([(self.library.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self._forget()

    def _forget(self) -> None:
        """Hashes of the words seen, sorted; where in ``ids`` those of each begin, and how many there are."""
        self.known, self.begin, self.size = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype="<u4")

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        found, begins, sizes, n = [self.ids], [], [], len(self.ids)
        for at in range(0, len(words), 2000):
            part = words[at:at + 2000]
            ids = self._library(" ".join(part))
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):
                raise ValueError("a word did not end in one word-end token")
            found.append(ids)
            begins.append(np.r_[0, stops[:-1]] + n)
            sizes.append(np.diff(stops, prepend=0))
            n += len(ids)
        if words:
            place = np.searchsorted(self.known, hashes)
            self.known = np.insert(self.known, place, hashes)
            self.begin, self.size = np.insert(self.begin, place, np.concatenate(begins)), np.insert(self.size, place, np.concatenate(sizes))
            self.ids = np.concatenate(found)

    def _rare(self, texts: list[str], stop: np.ndarray) -> np.ndarray:
        """Numbers of the texts that hold other than common letters, or what may begin a special token."""
        letter = np.frombuffer("\n".join(texts).encode("utf-32-le"), dtype="<u4")
        odd = ~self.common[np.minimum(letter, self.LETTERS - 1)]
        odd[:-1] |= (letter[:-1] == ord("<")) & (letter[1:] == ord("|"))
        return np.unique(np.searchsorted(stop, np.flatnonzero(odd), side="right"))

    def _split(self, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, class of every letter) of the words of lower-cased texts that end in two separators."""
        kind = self.kind[letter]
        start = kind != 0
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        quote = np.flatnonzero((letter[:-1] == ord("'")) & start[:-1] & (kind[1:] == 1))
        one, two = letter[quote + 1], letter[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        start[quote[short | long] + 1] = False
        after = np.r_[quote[short] + 2, quote[long] + 3]
        start[after] |= kind[after] == 1
        cut = np.flatnonzero(start | (kind == 0))
        first = start[cut]
        return cut[first], np.append(cut[1:], len(letter))[first], kind

    def _hashes(self, letter: np.ndarray, start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> np.ndarray:
        at = np.arange(len(letter))
        begin = np.zeros(len(letter), dtype=np.int64)
        begin[start] = start
        value = self.codes[letter]
        value[kind == 0] = 0
        value *= self.powers[np.where(kind != 0, at - np.maximum.accumulate(begin), 0)]
        return mix(np.add.reduceat(value, start) + (end - start).astype(np.uint64))

    def _common(self, texts: list[str]) -> list[bytes | None]:
        """The same for texts of common letters; None for one with a longer word than is compared by its hash."""
        text = "\n".join(texts).lower() + "\n\n"
        stop = np.cumsum([len(t) + 1 for t in texts])
        letter = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        start, end, kind = self._split(letter)
        owner = np.searchsorted(stop, start, side="right")
        long = np.unique(owner[end - start > self.LONG])
        if len(long):
            gone = set(long.tolist())
            rest = iter(self._common([t for i, t in enumerate(texts) if i not in gone]) if len(gone) < len(texts) else [])
            return [None if i in gone else next(rest) for i in range(len(texts))]
        if not len(start):
            return [b""] * len(texts)
        if len(self.known) > REMEMBERED:
            self._forget()
        distinct, where, number = np.unique(self._hashes(letter, start, end, kind), return_index=True, return_inverse=True)
        new = np.ones(len(distinct), dtype=bool)
        if len(self.known):
            new = self.known[np.minimum(np.searchsorted(self.known, distinct), len(self.known) - 1)] != distinct
        self._learn(distinct[new], [text[i:j] for i, j in zip(start[where[new]].tolist(), end[where[new]].tolist(), strict=True)])
        place = np.searchsorted(self.known, distinct)[number]
        size = self.size[place]
        total = np.r_[0, np.cumsum(size)]
        ids = self.ids[np.repeat(self.begin[place] - total[:-1], size) + np.arange(total[-1])]
        bounds = total[np.searchsorted(owner, np.arange(len(texts) + 1))].tolist()
        return [ids[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian unsigned 32-bit ids of each text."""
        out: list[bytes | None] = [None] * len(texts)
        rare = set(self._rare(texts, np.cumsum([len(t) + 1 for t in texts])).tolist())
        common = [i for i in range(len(texts)) if i not in rare]
        for i, packed in zip(common, self._common([texts[i] for i in common]) if common else [], strict=True):
            out[i] = packed
        return [self._library(text).tobytes() if packed is None else packed for text, packed in zip(texts, out, strict=True)]


def cut(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of every whole document: ``id, start, length, doc_tokens, ids``.

    A document is its text's ids and then ``end_id``, so an empty or null text
    has one id. It is cut every ``window`` ids; the last piece is what remains.
    ``ids`` are packed little-endian unsigned 32-bit integers.
    """
    schema = StructType([StructField("id", df.schema[id_col].dataType), *(StructField(n, LongType()) for n in ("start", "length", "doc_tokens")),
                         StructField("ids", BinaryType())])
    end = end_id.to_bytes(4, "little")

    def run(batches):
        tokenizer = WordTokenizer(path)
        for batch in batches:
            for first, part in pieces(batch.column(1), SLICE_BYTES):
                rows, starts, totals, ids = [], [], [], []
                for i, packed in enumerate(tokenizer.encode(part.to_pylist())):
                    packed += end
                    for at in range(0, len(packed), 4 * window):
                        rows.append(first + i)
                        starts.append(at // 4)
                        totals.append(len(packed) // 4)
                        ids.append(packed[at:at + 4 * window])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()),
                    pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(totals, pa.int64()), pa.array(ids, pa.binary())], schema.names)

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), schema)


def combinations(counts: dict[int, int], window: int = WINDOW, partners: int = PARTNERS) -> list[tuple[int, ...]]:
    """Shallow combinations of present lengths that fill a window: all of one and two parts, and for each length those
    of three and four parts with its most frequent partners, spread over small and large lengths."""
    have = set(counts)
    found = {(window,)} & {(x,) for x in have}
    found |= {(window - b, b) for b in have if window - b in have and 2 * b <= window}
    order = sorted(have, key=lambda x: (-counts[x], x))
    spread = []
    for lo in range(0, window, max(1, window // partners)):
        spread += [x for x in order if lo < x <= lo + window // partners][:partners]
    for a in have:
        for b in spread:
            c = window - a - b
            if c in have:
                found.add(tuple(sorted((a, b, c), reverse=True)))
        for b in spread[:partners]:
            for c in spread[:partners]:
                d = window - a - b - c
                if d in have:
                    found.add(tuple(sorted((a, b, c, d), reverse=True)))
    return sorted(found, reverse=True)


def solve(columns: list[tuple[int, ...]], counts: dict[int, int], sweeps: int = SWEEPS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - h|^2, h the histogram of lengths, by cyclic coordinate descent."""
    left = {k: float(v) for k, v in counts.items()}
    parts = [list(Counter(c).items()) for c in columns]
    norms = [float(sum(m * m for _, m in p)) for p in parts]
    x = [0.0] * len(columns)
    for _ in range(sweeps):
        moved = 0.0
        for j, p in enumerate(parts):
            step = sum(m * left[length] for length, m in p) / norms[j]
            step = max(step, -x[j])
            if step:
                x[j] += step
                moved = max(moved, abs(step))
                for length, m in p:
                    left[length] -= m * step
        if moved < 0.25:
            break
    return np.array(x)


def make_plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how often) that use up the histogram.

    Solved counts are rounded down within what is there; what is left is packed
    greedily: the longest piece, then again and again the longest that fits,
    repeated as often as the pieces last.
    """
    left = {k: v for k, v in counts.items() if v > 0}
    plan = []
    columns = combinations(left, window)
    for column, x in sorted(zip(columns, solve(columns, left), strict=True), key=lambda c: -c[1]):
        parts = Counter(column)
        times = min(int(x), *(left[length] // m for length, m in parts.items()))
        if times > 0:
            plan.append((column, times))
            for length, m in parts.items():
                left[length] -= m * times
    free = sorted((k for k, v in left.items() if v), reverse=True)
    while free:
        room, taken = window, []
        used: Counter = Counter()
        for length in free:
            n = min(room // length, left[length])
            if n:
                taken += [length] * n
                used[length] = n
                room -= n * length
        times = min(left[length] // m for length, m in used.items())
        plan.append((tuple(taken), times))
        for length, m in used.items():
            left[length] -= m * times
        free = [k for k in free if left[k]]
    return plan


def pack(rows: DataFrame, length_col: str = "length", order: tuple[str, ...] = ("id", "start"), window: int = WINDOW) -> DataFrame:
    """``rows`` (pieces of 1 to ``window`` ids) with ``sequence_id`` and ``offset``, gapless within a sequence.

    The histogram has at most ``window`` entries however many pieces there are;
    the plan is made from it on the driver. The pieces of one length are
    numbered in ``order`` within salted runs, so that a hot length is spread
    over many tasks, and the r-th of them takes the r-th place that the plan
    has for its length. No pieces give no sequences.
    """
    spark = rows.sparkSession
    counts = {r[0]: r[1] for r in rows.groupBy(length_col).count().collect()}
    salts = max(16, sum(counts.values()) // 50_000)
    places: list[tuple[int, int, int, int, int]] = []
    filled: Counter = Counter()
    sequence = 0
    for parts, times in make_plan(counts, window):
        offset = 0
        for length in parts:
            places.append((length, filled[length], filled[length] + times, sequence, offset))
            filled[length] += times
            offset += length
        sequence += times
    table = spark.createDataFrame(places, "len long, first long, stop long, first_sequence long, offset long")
    salted = rows.withColumn("__salt", F.expr(f"pmod(xxhash64({', '.join(f'`{c}`' for c in order)}), {salts})"))
    runs = salted.groupBy(F.col(length_col).alias("__len"), F.col("__salt").alias("__run")).count()
    runs = runs.selectExpr("__len", "__run", "sum(count) over (partition by __len order by __run) - count as __before")
    by = ", ".join(f"`{c}`" for c in order)
    ranked = salted.withColumn("__rank", F.expr(f"row_number() over (partition by `{length_col}`, __salt order by {by}) - 1"))
    ranked = ranked.join(runs, (F.col(length_col) == F.col("__len")) & (F.col("__salt") == F.col("__run"))).withColumn(
        "__rank", F.col("__rank") + F.col("__before"))
    # at most one row per part of each combination in the plan, whose number is bounded by the window
    placed = ranked.join(F.broadcast(table), (F.col(length_col) == F.col("len")) & (F.col("__rank") >= F.col("first")) & (F.col("__rank") < F.col("stop")))
    return placed.withColumn("sequence_id", F.expr("first_sequence + __rank - first")).select(
        *(c for c in rows.columns if c not in ("sequence_id", "offset")), "sequence_id", "offset")
