"""Language identification by prediction by partial matching: the language whose frozen model codes a text shortest."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from tradewinds.llm.common import bounded_sample, pieces, utf8

#: Texts learned from at most, for each language; the longest context in bytes.
TRAIN_ROWS, ORDER = 2000, 3


def count_grams(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang, gram, n``: how often each run of ORDER + 1 bytes occurs in the texts of a language."""

    def run(batches):
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                for _, part in pieces(batch.column(0).filter(pa.array(langs == lang))):
                    data, offsets = utf8(part)
                    if len(data) <= ORDER:
                        continue
                    gram = np.zeros(len(data) - ORDER, dtype=np.int64)
                    for i in range(ORDER + 1):
                        gram = gram << 8 | data[i:len(data) - ORDER + i]
                    owner = np.searchsorted(offsets, np.arange(len(data)), side="right")
                    values, n = np.unique(gram[owner[:len(gram)] == owner[ORDER:]], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values), pa.string()), pa.array(values), pa.array(n.astype(np.int64))],
                                                     ["lang", "gram", "n"])

    counted = df.select(text_col, lang_col).mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class ContextTrees:
    """Context trees of all languages with frozen statistics, laid out for vectorised coding.

    A language's tree holds, for contexts of 0 to ORDER bytes, how often each
    byte followed. A byte is coded in the longest context its language knows:
    seen there, with n / (total + distinct); else after an escape of
    distinct / (total + distinct) in the context one byte shorter, at last as
    one of 256 equal bytes. As statistics are frozen, the code length depends on
    the context and the byte alone and stands in ``bits[state, byte, language]``,
    a state being a context that any language knows.
    """

    def __init__(self, languages: np.ndarray, grams: np.ndarray, counts: np.ndarray):
        self.languages, lang = np.unique(languages.astype(str), return_inverse=True)
        columns = [(grams >> 8 * (ORDER - i)) & 255 for i in range(ORDER + 1)]
        alphabet = np.unique(np.concatenate(columns))
        self.size = len(alphabet) + 1  # the last symbol is any other byte
        self.symbol = np.full(256, self.size - 1, dtype=np.int32)
        self.symbol[alphabet] = np.arange(len(alphabet))
        symbols = [self.symbol[c].astype(np.int64) for c in columns]
        n_lang = max(len(self.languages), 1)
        rows = [np.full((1, self.size, n_lang), 1 / 256)]  # order -1
        keys: list[np.ndarray] = []
        for order in range(ORDER + 1):
            context = np.zeros(len(grams), dtype=np.int64)
            for s in symbols[ORDER - order:ORDER]:
                context = context * self.size + s
            known, place = np.unique(context, return_inverse=True)
            if order == 0 and not len(known):
                known = np.zeros(1, dtype=np.int64)
            lower = rows[-1][np.searchsorted(keys[-1], known % self.size ** (order - 1))] if order else np.repeat(rows[-1], len(known), axis=0)
            count = np.zeros(len(known) * self.size * n_lang)
            if len(grams):
                np.add.at(count, (place * self.size + symbols[ORDER]) * n_lang + lang, counts)
            count = count.reshape(len(known), self.size, n_lang)
            total, distinct = count.sum(axis=1, keepdims=True), (count > 0).sum(axis=1, keepdims=True)
            mass = np.maximum(total + distinct, 1)
            coded = np.where(count > 0, count / mass, np.where(total > 0, distinct / mass, 1.0) * lower)
            rows.append(coded)
            keys.append(known)
        self.bits = -np.log2(np.concatenate(rows[1:])).astype(np.float32).reshape(-1, n_lang)
        table = np.zeros(self.size ** ORDER, dtype=np.int32)
        every, base = np.arange(len(table)), 0
        for order in range(ORDER + 1):
            if len(keys[order]):
                short = every % self.size ** order
                at = np.minimum(np.searchsorted(keys[order], short), len(keys[order]) - 1)
                hit = keys[order][at] == short
                table[hit] = base + at[hit]
                base += len(keys[order])
        self.state = table

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text under each language."""
        out = np.zeros((len(offsets) - 1, self.bits.shape[1]))
        if not len(data):
            return out
        other = self.size - 1
        symbol = self.symbol[data]
        padded = np.concatenate([np.full(ORDER, other, dtype=np.int32), symbol])
        place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
        context = np.zeros(len(data), dtype=np.int32)
        for back in range(ORDER, 0, -1):  # before a text's first byte any context is unknown
            context = context * self.size + np.where(place >= back, padded[ORDER - back:len(padded) - back], other)
        cost = self.bits[self.state[context] * self.size + symbol]
        full = np.diff(offsets) > 0
        out[full] = np.add.reduceat(cost, offsets[:-1][full], axis=0, dtype=np.float64)
        return out


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", rows: int = TRAIN_ROWS) -> ContextTrees:
    """Trees of the languages in ``lang_col``, from up to ``rows`` whole texts of each.

    Rows without text or language teach nothing; without any row there are no
    languages. The counts come to the driver; the sample bounds them.
    """
    labelled = df.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    chosen = bounded_sample(labelled.select("id", "lang"), "lang", rows, "id")
    found = count_grams(labelled.join(chosen.distinct(), ["id", "lang"], "left_semi"), "text", "lang").toArrow()
    return ContextTrees(np.array(found["lang"].to_pylist(), dtype=object), np.asarray(found["gram"], dtype=np.int64), np.asarray(found["n"], dtype=np.float64))


def _has_letter(text: bytes) -> bool:
    lowered = text.lower()
    return lowered != text.upper() or any(c.isalpha() for c in text.decode())


def identify(df: DataFrame, trees: ContextTrees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score, bits``: the language that codes the whole text in fewest bits.

    ``score`` is that language's share of 2^-bits over all languages; equal
    lengths go to the first language by name. ``bits`` has the code length under
    each language, in order of name. A null text, one without letters, or any
    text when nothing was learned gives ``und`` with score 0. Repeated rows give
    repeated rows, an empty table none; other columns are not read.
    """
    schema = StructType([StructField("id", df.schema[id_col].dataType), StructField("lang_pred", StringType()),
                         StructField("score", DoubleType()), StructField("bits", ArrayType(DoubleType()))])
    shared = df.sparkSession.sparkContext.broadcast(vars(trees))  # plain arrays; their size follows the training sample, not the table
    names = schema.names

    def run(batches):
        model = ContextTrees.__new__(ContextTrees)
        vars(model).update(shared.value)
        for batch in batches:
            valid = batch.column(1).is_valid().to_pylist()
            for start, part in pieces(batch.column(1)):
                data, offsets = utf8(part)
                bits = model.code_lengths(data, offsets)
                best = bits.argmin(axis=1)
                share = 1 / np.exp2(np.minimum(bits.min(axis=1, keepdims=True) - bits, 0)).sum(axis=1)
                raw = data.tobytes()
                known = [len(model.languages) > 0 and valid[start + i] and _has_letter(raw[offsets[i]:offsets[i + 1]]) for i in range(len(part))]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(start, len(part)),
                    pa.array([str(model.languages[b]) if k else "und" for b, k in zip(best, known)], pa.string()),
                    pa.array([float(s) if k else 0.0 for s, k in zip(share, known)], pa.float64()),
                    pa.array(list(bits[:, :len(model.languages)]), pa.list_(pa.float64()))], names)

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
