"""Near-duplicate documents by a parity-sketch join on word shingles."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradewinds.llm.common import codes, mix, pieces, presence, shingle_hashes, slot, tidy, utf8, word_hashes, words
from tradewinds.llm.components import components
from tradewinds.session import cut_lineage

#: Near duplicates unless a caller says otherwise: shingles of five words, 80 of 100 in common.
SHINGLE_WORDS, PERCENT = 5, 80

#: Bits of the parity sketch that pairs must pass before their sets are fetched.
SKETCH_BITS = 2048

_CELL = codes(3)


def text_sets(part: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, (hash, number of the text), ordered by text and hash."""
    data, offsets = utf8(part)
    low, start, end, owner = words(data, offsets)
    run, text = shingle_hashes(word_hashes(low, start, end), owner, len(part), k)
    order = np.lexsort((run, text))
    run, text = run[order], text[order]
    new = np.ones(len(run), dtype=bool)
    new[1:] = (run[1:] != run[:-1]) | (text[1:] != text[:-1])
    return run[new], text[new]


class Bands:
    """Size bands and their sketches for one threshold.

    Sets of sizes a <= b with 100 |A n B| >= percent |A u B| differ in at most
    D(a, b) = (a + b)(100 - percent) / (100 + percent) members, and a >= b
    percent / 100. A band covers sizes up to ``1 / threshold`` times its least,
    so a set's partners are in its own band, the next, or the one before. The
    sketch of a band has more cells than sets of the band can differ in
    members. A member toggles (XOR) its bits in the one cell it hashes to, so
    sets differ in no more cells than members: some cell is equal (pigeonhole).
    """

    def __init__(self, percent: int):
        self.percent = percent
        self.tops: list[int] = []
        top = 0
        while top < 1 << 40:
            top = max(top + 1, (top + 1) * 100 // percent)
            self.tops.append(top)
        self.ends = np.array(self.tops, dtype=np.int64)

    def differing(self, a, b):
        """Most members in which linked sets of sizes a and b can differ."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def cells(self, band: int) -> int:
        least = self.differing(self.tops[band], self.tops[band]) + 1
        return int(least + math.isqrt(int(least)) // 2 + least // 30)


def sketch_rows(run: np.ndarray, text: np.ndarray, ids: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(cell key, id) of all sets, each in its own band and in the next.

    Empty cells are left out for a set that has more filled cells than it can
    differ in: of its filled cells one is equal in any partner. Sets that are
    too small to differ have no rows; their partners are equal sets.
    """
    count = np.bincount(text, minlength=len(ids))
    home = np.searchsorted(bands.ends, count)
    keys, owners = [], []
    for shift in (0, 1):
        band = home + shift
        top = np.minimum(bands.ends[band], count * 100 // bands.percent)
        most = bands.differing(count, np.maximum(top, count))
        asks = (count > 0) & (most > 0) & (top >= (bands.ends[band - 1] + 1 if shift else 0))
        for b in np.unique(band[asks]).tolist():
            sets = np.flatnonzero(asks & (band == b))
            n_cells = bands.cells(b)
            slot = np.full(len(ids), -1, dtype=np.int64)
            slot[sets] = np.arange(len(sets))
            mine = slot[text] >= 0
            member = run[mine]
            place = slot[text[mine]] * n_cells + (member % np.uint64(n_cells)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            place, member = place[order], mix(member[order] + np.uint64(0x632BE59BD9B4E019))
            first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.zeros(0, dtype=np.int64)
            value, at = np.bitwise_xor.reduceat(member, first), place[first]
            filled = np.bincount(at // n_cells, minlength=len(sets))
            few = np.flatnonzero(filled <= most[sets])
            if len(few):  # these keep their empty cells
                empty = np.setdiff1d((few[:, None] * n_cells + np.arange(n_cells)).ravel(), at)
                at, value = np.append(at, empty), np.append(value, np.zeros(len(empty), dtype=np.uint64))
            keys.append(mix(value ^ mix((at % n_cells).astype(np.uint64) * np.uint64(1 << 20) + np.uint64(b + 1))))
            owners.append(sets[at // n_cells])
    if not keys:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(keys).view(np.int64), ids[np.concatenate(owners)]


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def summaries(df: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """``id, n_shingles, key_a, key_b`` of every row; the keys are 128 bits that equal sets share (null: no words)."""

    def run(batches):
        for batch in batches:
            for start, part in pieces(batch.column(1)):
                run_, text = text_sets(part, k)
                count = np.bincount(text, minlength=len(part))
                sums = [np.zeros(len(part), dtype=np.uint64) for _ in range(2)]
                for i, total in enumerate(sums):
                    np.add.at(total, text, mix(run_ + _CELL[i]))
                none = count == 0
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(part)), pa.array(count),
                                                  *(pa.array(mix(s).view(np.int64), mask=none) for s in sums)], ["id", "n_shingles", "key_a", "key_b"])

    return _texts(df, id_col, text_col).mapInArrow(tidy(run), "id long, n_shingles long, key_a long, key_b long")


def buckets(df: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``key, id, leader``: the documents that share a cell key with another one; ``leader`` is the key's least id.

    Two similar documents share most of their cells. Keys with the same members
    tell the same, so a key is renamed to the hash of its members and stays once.
    Keys that go over the edge of a batch keep their name: they only repeat what
    others tell. Members of different keys that came under one name would be
    compared once more than needed.
    """

    def make(batches):
        bands, met = Bands(percent), set()
        for batch in batches:
            for start, part in pieces(batch.column(1)):
                ids = batch.column(0).slice(start, len(part))
                run, text = text_sets(part, k)
                sums = np.zeros(len(part), dtype=np.uint64)
                np.add.at(sums, text, mix(run + _CELL[0]))
                fresh = np.zeros(len(part), dtype=bool)
                for i, s in enumerate(sums.tolist()):  # of equal sets in a task one is enough
                    if s not in met:
                        met.add(s)
                        fresh[i] = ids[i].is_valid
                mine = fresh[text]
                keys, owners = sketch_rows(run[mine], text[mine], np.asarray(ids.fill_null(0), dtype=np.int64), bands)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(owners)], ["key", "id"])

    def gather(batches):
        """Runs of equal keys, named by their members; the rows come sorted by key and id, the last run waits for the next batch."""
        open_key, leader, alone = None, None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, ids = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            first = np.r_[True, keys[1:] != keys[:-1]]
            start = np.flatnonzero(first)
            size = np.diff(np.append(start, len(keys)))
            lead = ids[start]
            name = mix(np.add.reduceat(mix(ids.view(np.uint64) + _CELL[7]), start) + size.astype(np.uint64)).view(np.int64)
            name[-1] = keys[-1]
            out_keys, out_ids, out_lead = [], [], []
            joined = open_key is not None and keys[0] == open_key
            if joined:
                lead[0], name[0] = leader, open_key
                if alone:
                    out_keys.append([open_key])
                    out_ids.append([leader])
                    out_lead.append([leader])
            shared = size > 1
            shared[0] |= joined
            rows = np.repeat(shared, size)
            out_keys.append(np.repeat(name, size)[rows])
            out_ids.append(ids[rows])
            out_lead.append(np.repeat(lead, size)[rows])
            if len(start) == 1 and joined:
                alone = False
            else:
                alone = size[-1] == 1 and not (len(start) == 1 and joined)
            # a last run of one row is told when its second row comes
            open_key, leader = keys[-1], lead[-1]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (out_keys, out_ids, out_lead)], ["key", "id", "leader"])

    made = _texts(df, id_col, text_col).mapInArrow(tidy(make), "key long, id long")
    return made.repartition("key").sortWithinPartitions("key", "id").mapInArrow(tidy(gather), "key long, id long, leader long").distinct()


def parity_sketches(df: DataFrame, wanted: np.ndarray, k: int, id_col: str, text_col: str) -> DataFrame:
    """``id, n, sketch``: set size and parity sketch of the documents in the presence filter.

    Every member toggles one of SKETCH_BITS bits, so two sketches differ in at
    most as many bits as their sets differ in members.
    """

    def fill(run, text, n_texts):
        place, packed = (mix(run + _CELL[5]) % np.uint64(SKETCH_BITS)).astype(np.int64), []
        for at in range(0, n_texts, 1000):
            mine = slice(*np.searchsorted(text, [at, at + 1000]))
            bits = np.bincount((text[mine] - at) * SKETCH_BITS + place[mine], minlength=min(1000, n_texts - at) * SKETCH_BITS)
            packed += [x.tobytes() for x in np.packbits((bits & 1).astype(bool).reshape(-1, SKETCH_BITS), axis=1)]
        return {"n": pa.array(np.bincount(text, minlength=n_texts)), "sketch": pa.array(packed, pa.binary())}

    return _computed(df, wanted, k, id_col, text_col, fill, "n long, sketch binary")


def shingle_sets(df: DataFrame, wanted: np.ndarray, k: int, id_col: str, text_col: str) -> DataFrame:
    """``id, members``: the sorted 64-bit hashes of the sets of the documents in the presence filter."""

    def fill(run, text, n_texts):
        cut, raw = [0, *(8 * np.cumsum(np.bincount(text, minlength=n_texts))).tolist()], run.tobytes()
        return {"members": pa.array([raw[a:b] for a, b in zip(cut, cut[1:])], pa.binary())}

    return _computed(df, wanted, k, id_col, text_col, fill, "members binary")


def _computed(df: DataFrame, wanted: np.ndarray, k: int, id_col: str, text_col: str, fill, columns: str) -> DataFrame:
    """What ``fill`` makes of the sets of the documents whose slot is in the presence filter; other texts are passed over."""
    shared = df.sparkSession.sparkContext.broadcast(np.packbits(wanted))  # FILTER_SLOTS bits at most

    def run(batches):
        present = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            batch = batch.filter(pa.array(present[np.asarray(batch.column(2))]))
            for start, part in pieces(batch.column(1)):
                made = fill(*text_sets(part, k), len(part))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(part)), *made.values()], ["id", *made])

    rows = _texts(df, id_col, text_col).where("id is not null").withColumn("slot", slot("id"))
    return rows.mapInArrow(tidy(run), "id long, " + columns)


def _bits(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(-1, SKETCH_BITS // 64)


def sieve(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a, b``) that their sizes and parity sketches do not rule out."""
    both = pairs.join(sketches.selectExpr("id as a", "n as na", "sketch as sa"), "a").join(sketches.selectExpr("id as b", "n as nb", "sketch as sb"), "b")

    def run(batches):
        bands = Bands(percent)
        for batch in batches:
            a, b, na, nb = (np.asarray(batch.column(i)) for i in range(4))
            apart = np.bitwise_count(_bits(batch.column(4)) ^ _bits(batch.column(5))).sum(axis=1)
            fine = (apart <= bands.differing(na, nb)) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
            yield pa.RecordBatch.from_arrays([pa.array(a[fine]), pa.array(b[fine])], ["a", "b"])

    return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(tidy(run), "a long, b long").distinct()


def verify(pairs: DataFrame, df: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs (``a, b``) that are linked, with their number of ``common`` shingles and of shingles in ``either``."""
    ends = pairs.selectExpr("a as id").unionByName(pairs.selectExpr("b as id"))
    sets = cut_lineage(shingle_sets(df, presence(ends), k, id_col, text_col))
    both = pairs.join(sets.selectExpr("id as a", "members as ma"), "a").join(sets.selectExpr("id as b", "members as mb"), "b")

    def run(batches):
        for batch in batches:
            a, b = (np.asarray(batch.column(i)) for i in (0, 1))
            common, either = np.zeros(len(a), dtype=np.int64), np.zeros(len(a), dtype=np.int64)
            for i in range(len(a)):
                x, y = (np.frombuffer(batch.column(c)[i].as_py(), dtype=np.uint64) for c in (2, 3))
                common[i] = len(np.intersect1d(x, y, assume_unique=True))
                either[i] = len(x) + len(y) - common[i]
            linked = (100 * common >= percent * either) & (common > 0)
            yield pa.RecordBatch.from_arrays([pa.array(v[linked]) for v in (a, b, common, either)], ["a", "b", "common", "either"])

    return both.select("a", "b", "ma", "mb").mapInArrow(tidy(run), "a long, b long, common long, either long")


def open_pairs(cells: DataFrame, known: DataFrame, sketches: DataFrame, percent: int, spanning: bool) -> DataFrame:
    """Pairs (``a, b``) that share a ``key``, are in different components so far, and pass the sieve.

    With ``spanning`` only as many of each key as would make its components one
    if all of them are links; else all of them. A key without a row has no such
    pair at all. The members of a key are compared within a task, so a group of
    many similar but unlinked documents makes no rows.
    """
    placed = cells.select("key", "id").join(known.withColumnRenamed("node", "id"), "id", "left").selectExpr("key", "id", "coalesce(component, id) as component")
    mixed = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    rows = cut_lineage(placed.join(mixed, "key")).join(sketches, "id").select("key", "id", "component", "n", "sketch")

    def compare(table: pa.Table):
        bands = Bands(percent)
        key, ids, component, n = (np.asarray(table.column(i)) for i in range(4))
        bits = _bits(table.column(4))
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        left, right, within = [], [], []
        for lo, hi in zip(first.tolist(), np.append(first[1:], len(key)).tolist()):
            root = component[lo:hi].copy()
            for i in range(lo, hi - 1):
                rest = np.flatnonzero(root[i + 1 - lo:] != root[i - lo]) + i + 1
                if not len(rest):
                    continue
                rest = rest[100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i])]
                apart = np.bitwise_count(bits[rest] ^ bits[i]).sum(axis=1)
                rest = rest[(apart <= bands.differing(n[rest], n[i])) & (ids[rest] != ids[i])]
                if spanning and len(rest):
                    joined, one = np.unique(root[rest - lo], return_index=True)
                    rest = rest[one]
                    root[np.isin(root, joined)] = root[i - lo]
                left += [ids[i]] * len(rest)
                right.append(ids[rest])
                within += [key[lo]] * len(rest)
        a, b = np.array(left, dtype=np.int64), np.concatenate(right or [np.zeros(0, dtype=np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b)), pa.array(np.array(within, dtype=np.int64))], ["a", "b", "key"])

    def run(batches):
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.asarray(batch.column(0))
            last = int(np.searchsorted(keys, keys[-1]))  # rows are sorted by key; the last one may go on in the next batch
            if last:
                yield compare(pa.Table.from_batches([*waiting, batch.slice(0, last)]).combine_chunks())
                waiting = []
            waiting.append(batch.slice(last))
        if waiting:
            yield compare(pa.Table.from_batches(waiting).combine_chunks())

    return rows.repartition("key").sortWithinPartitions("key", "id").mapInArrow(tidy(run), "a long, b long, key long")


def near_duplicates(df: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id`` of every row: the least id reachable by links between documents.

    A document's set is its distinct shingles of k lower-cased words; a text of
    fewer words has its whole sequence as the only shingle, a null, empty or
    blank text has none and is linked with nothing. Sets are linked when
    100 * common >= percent * either. Ids must be integers; rows that share an
    id are one document with several texts; a null id is linked with nothing
    and its own (null) component. An empty table gives no rows. Shingles are
    compared as 64-bit hashes, equal sets by 128 bits.

    Links are found without listing the pairs of a group. Within a cell key
    every member is compared with the least one; verified links give first
    components. Keys whose members are then in one component need no more. In
    the others, members of different components are compared by their parity
    sketches: first as many pairs are verified as would join the components, then,
    in the keys that had such pairs, all that are still open.
    """
    ids = cut_lineage(summaries(df, k, id_col, text_col))
    equal = ids.where("key_a is not null and id is not null").groupBy("key_a", "key_b").agg(F.min("id").alias("first"))
    same = ids.join(equal, ["key_a", "key_b"]).where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    same = cut_lineage(same.distinct())
    cells = cut_lineage(buckets(df, k, percent, id_col, text_col))
    links = same

    def linked(links: DataFrame, pairs: DataFrame) -> DataFrame:
        return links if pairs.isEmpty() else cut_lineage(links.unionByName(verify(pairs, df, k, percent, id_col, text_col).select("a", "b")))

    if not cells.isEmpty():
        sketches = cut_lineage(parity_sketches(df, presence(cells), k, id_col, text_col))
        pairs = cells.where("id <> leader").select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct()
        tested = cut_lineage(sieve(pairs, sketches, percent))
        links = linked(links, tested)
        first = cut_lineage(open_pairs(cells, components(links), sketches, percent, True))
        if not first.isEmpty():
            fresh = cut_lineage(first.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"))
            links = linked(links, fresh)
            again = cut_lineage(cells.join(first.select("key").distinct(), "key", "left_semi"))
            found = open_pairs(again, components(links), sketches, percent, False).select("a", "b").distinct()
            links = linked(links, cut_lineage(found.join(tested.unionByName(fresh), ["a", "b"], "left_anti")))
    groups = components(links).withColumnRenamed("node", "id")
    return ids.join(groups, "id", "left").selectExpr("id", "n_shingles", "coalesce(component, id) as component_id")


def keep_one(df: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns as they are, of which one document of every component stays, that of the least id."""
    found = near_duplicates(df, k, percent, id_col, text_col).where("id <> component_id").select(F.col("id").alias(id_col)).distinct()
    dropped = cut_lineage(found.select(F.col(id_col).cast(df.schema[id_col].dataType)))
    return df.join(dropped, id_col, "left_anti").select(*(F.col(f"`{c}`") for c in df.columns))
