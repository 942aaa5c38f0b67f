"""Exact duplicate removal with cuckoo-filter indexes of live digests."""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tradewinds.llm.common import SPACES, tidy
from tradewinds.session import cut_lineage


class CuckooIndex:
    """A cuckoo filter over the digests that are alive, with the full keys stored beside each bucket.

    A bucket holds four 16-bit tags. A tag that is found is verified against
    the key stored with it, so lookups are exact. When an insertion cannot find
    room by moving tags, the table doubles and is rebuilt from the stored keys.
    """

    SLOTS, KICKS = 4, 200

    def __init__(self, buckets: int = 256):
        self.mask = buckets - 1
        self.buckets: list[list[tuple[int, bytes, object]]] = [[] for _ in range(buckets)]
        self.live = 0
        self._random = random.Random(7)

    @staticmethod
    def _tag(key: bytes) -> int:
        return int.from_bytes(key[8:10], "little") or 1

    def _first(self, key: bytes) -> int:
        return int.from_bytes(key[:8], "little") & self.mask

    def _other(self, place: int, tag: int) -> int:
        return (place ^ (tag * 0x5BD1E995)) & self.mask

    def find(self, key: bytes):
        """What is stored under the key, or None."""
        tag, place = self._tag(key), self._first(key)
        for at in (place, self._other(place, tag)):
            for known, stored, value in self.buckets[at]:
                if known == tag and stored == key:
                    return value
        return None

    def insert(self, key: bytes, value: object) -> None:
        """Add a key that is not in the index."""
        entry, place = (self._tag(key), key, value), self._first(key)
        self.live += 1
        for at in (place, self._other(place, entry[0])):
            if len(self.buckets[at]) < self.SLOTS:
                self.buckets[at].append(entry)
                return
        for _ in range(self.KICKS):
            bucket = self.buckets[place]
            moved = self._random.randrange(self.SLOTS)
            bucket[moved], entry = entry, bucket[moved]
            place = self._other(place, entry[0])
            if len(self.buckets[place]) < self.SLOTS:
                self.buckets[place].append(entry)
                return
        self._grow(entry)

    def delete(self, key: bytes) -> bool:
        """Remove a live key; False if it is not in the index."""
        tag, place = self._tag(key), self._first(key)
        for at in (place, self._other(place, tag)):
            for i, (known, stored, _) in enumerate(self.buckets[at]):
                if known == tag and stored == key:
                    del self.buckets[at][i]
                    self.live -= 1
                    return True
        return False

    def _grow(self, homeless: tuple[int, bytes, object]) -> None:
        entries = [*self.items(), homeless[1:]]
        self.__init__(2 * len(self.buckets))
        for key, value in entries:
            self.insert(key, value)

    def items(self) -> Iterator[tuple[bytes, object]]:
        for bucket in self.buckets:
            for _, key, value in bucket:
                yield key, value


def _digest(text: bytes | None) -> tuple[bytes, int]:
    """SHA-256 of the text without ASCII white space, and the code points of the text as it is."""
    text = text or b""
    chars = len(text) - int(np.count_nonzero((np.frombuffer(text, dtype=np.uint8) & 0xC0) == 0x80))
    return hashlib.sha256(text.translate(None, SPACES)).digest(), chars


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``digest`` (of the normalised text) and ``chars`` of every row."""
    schema = StructType([StructField("id", df.schema[id_col].dataType), StructField("digest", BinaryType()),
                         StructField("chars", LongType())])

    def run(batches):
        for batch in batches:
            made = [_digest(x.as_buffer().to_pybytes() if x.is_valid else None) for x in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([d for d, _ in made], pa.binary()),
                                              pa.array([n for _, n in made], pa.int64())], ["id", "digest", "chars"])

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), schema)


def survivors(rows: DataFrame) -> DataFrame:
    """One row per digest: ``digest, chars, id`` of the row that stays, ``members``, and ``repeats`` of that very row.

    ``rows`` holds ``id, digest, chars, members, repeats``. Each task keeps a
    cuckoo index of its live digests; a better row deletes the one it replaces.
    """

    def better(new, old):  # more code points, then the smaller id; a null id comes last
        return (-new[0], new[1] is None, new[1]) < (-old[0], old[1] is None, old[1])

    def run(batches):
        index = CuckooIndex()
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for ident, digest, chars, members, repeats in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                old = index.find(digest)
                new = (chars, ident, members, repeats)
                if old is None:
                    index.insert(digest, new)
                    continue
                index.delete(digest)
                if old[:2] == new[:2]:
                    kept = (*old[:2], old[2] + members, old[3] + repeats)
                else:
                    best = new if better(new, old) else old
                    kept = (*best[:2], old[2] + members, best[3])
                index.insert(digest, kept)
        if index.live:
            found = list(index.items())
            for at in range(0, len(found), 10_000):
                part = found[at:at + 10_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([v[1] for _, v in part], kind), pa.array([k for k, _ in part], pa.binary()),
                    *(pa.array([v[i] for _, v in part], pa.int64()) for i in (0, 2, 3))],
                    ["id", "digest", "chars", "members", "repeats"])

    return rows.mapInArrow(tidy(run), rows.schema)


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's group of equal texts: ``id, keep_id, group_size, kept, repeats, chars, text_sha256``.

    Texts are equal when they are identical without ASCII white space. The row
    with most code points in its own text stays, then the smallest id. A null
    or empty text, or one of white space only, counts as the empty text; a null
    id loses ties against any other. Rows that repeat both id and text are one
    document: all are marked kept, and ``repeats`` (above 1 only then) says how
    many there are. An empty table gives no rows. Other columns are not read.

    Identity is equality of SHA-256 digests. Each task first merges its own
    rows in a cuckoo index, so that a digest of a third of all rows costs one
    row per task in the shuffle; buckets of digests are merged likewise.
    """
    rows = cut_lineage(digests(df, id_col, text_col))
    ones = rows.withColumns({"members": F.lit(1).cast("long"), "repeats": F.lit(1).cast("long")})
    best = survivors(survivors(ones).repartition("digest")).select(
        "digest", F.col("id").alias("keep_id"), F.col("members").alias("group_size"), "repeats")
    return rows.join(best, "digest").select(
        "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "repeats", "chars",
        F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns as they are, without those whose text equals that of a row that stays.

    Of rows that repeat both id and text one stays.
    """
    found = exact_dedup(df, id_col, text_col).where("kept").select(
        F.col("id").alias("__id"), F.col("chars").alias("__chars"), F.col("repeats").alias("__repeats"),
        F.col("text_sha256").alias("__sha")).distinct()
    staying = df.join(found, F.col(id_col).eqNullSafe(F.col("__id")), "inner")
    # an id that repeats with other texts is told apart by the digest
    staying = staying.where(F.expr(
        f"sha2(cast(translate(coalesce(`{text_col}`, ''), ' \\t\\n' || char(11) || char(12) || '\\r', '') as binary), 256) = __sha"
        f" and char_length(coalesce(`{text_col}`, '')) = __chars"))
    names = df.columns
    single = staying.where("__repeats = 1").select(*names)
    several = staying.where("__repeats > 1").dropDuplicates(["__sha", "__chars"]).select(*names)
    return single.unionByName(several)
