"""Near-duplicate documents by a chosen-path set similarity join.

Documents with equal sets collapse to one. The others grow trees: a node's
documents branch by the value of a min-hash position that the node chooses, so
documents stay together with the probability of their similarity. Small nodes
are compared exhaustively on the full sets, larger ones branch on. Independent
trees repeat this until a linked pair misses all of them with less than ``1 - recall``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradewinds.llm.common import codes, mix, pieces, presence
from tradewinds.llm.components import components
from tradewinds.llm.jaccard_join import shingle_sets, text_sets
from tradewinds.session import cut_lineage

#: Near duplicates unless a caller says otherwise: shingles of five words, 80 of 100 in common.
SHINGLE_WORDS, PERCENT = 5, 80

#: Positions of a min-hash signature.
POSITIONS = 64

#: Probability that a linked pair meets in a node of two levels.
RECALL = 0.999999

#: Documents and set members (8 bytes each) of a node that one task compares, and levels until larger ones are cut in blocks.
SMALL, WEIGHT, DEPTH = 4000, 2_000_000, 6

_A, _B, _PATH, _KEY = codes(11) | np.uint64(1), codes(12), codes(13), codes(14)


def signatures(df: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, key_a, key_b, signature`` of every row: 128 bits that equal sets share, and POSITIONS min-hashes of 32 bits.

    A text without words has no keys and no signature.
    """

    def run(batches):
        for batch in batches:
            for start, part in pieces(batch.column(1)):
                members, text = text_sets(part, k)
                count = np.bincount(text, minlength=len(part))
                filled = np.flatnonzero(count)
                first = (np.cumsum(count) - count)[filled]
                least = np.zeros((len(part), POSITIONS), dtype=np.uint32)
                sums = np.zeros((2, len(part)), dtype=np.uint64)
                if len(filled):
                    for i in range(POSITIONS):
                        least[filled, i] = np.minimum.reduceat(((members * _A[i] + _B[i]) >> np.uint64(32)).astype(np.uint32), first)
                    for i in range(2):
                        sums[i, filled] = np.add.reduceat(mix(members + _KEY[i]), first)
                none = count == 0
                raw = least.tobytes()
                width = 4 * POSITIONS
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(start, len(part)), pa.array(count.astype(np.int64)),
                    *(pa.array(mix(s).view(np.int64), mask=none) for s in sums),
                    pa.array([None if e else raw[i * width:(i + 1) * width] for i, e in enumerate(none.tolist())], pa.binary())],
                    ["id", "n_shingles", "key_a", "key_b", "signature"])

    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "id long, n_shingles long, key_a long, key_b long, signature binary")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, POSITIONS)


def _child(node: np.ndarray, place: np.ndarray, value: np.ndarray) -> np.ndarray:
    return mix(node * np.uint64(0x9E3779B97F4A7C15) + mix((place.astype(np.uint64) << np.uint64(32)) | value.astype(np.uint64)))


def _branch(node: np.ndarray, least: np.ndarray, nth: int) -> np.ndarray:
    """Each document's child in its node's nth branch; the position is the node's choice."""
    place = (mix(node + _PATH[nth + 1]) % np.uint64(POSITIONS)).astype(np.int64)
    return _child(node, place, least[np.arange(len(node)), place])


def trees(percent: int, recall: float) -> int:
    """Trees of two levels of two branches that a linked pair survives somewhere with the wanted probability."""
    meets = percent / 100
    stays = meets
    for _ in range(2):
        stays = 1 - (1 - meets * (stays if _ else 1)) ** 2
    return max(1, math.ceil(math.log(1 - recall) / math.log(max(1 - stays, 1e-12))))


def planted(sets: DataFrame, n_trees: int) -> DataFrame:
    """``node, id``: the second level of every tree. ``sets`` holds ``id, signature``."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            least, ids = _matrix(batch.column(1)), batch.column(0)
            for tree in range(n_trees):
                root = np.full(len(ids), codes(15, n_trees)[tree])
                for first in range(2):
                    node = _branch(root, least, first)
                    for second in range(2):
                        yield pa.RecordBatch.from_arrays([pa.array(_branch(node, least, second).view(np.int64)), ids], ["node", "id"])

    return sets.select("id", "signature").mapInArrow(run, "node long, id long")


def grown(rows: DataFrame, percent: int) -> DataFrame:
    """``node, id`` one level down; ``rows`` holds ``node, id, signature``. A node has 100 / percent branches on average."""

    def run(batches):
        often = np.uint64(int((100 / percent - 1) * 2 ** 32))
        for batch in batches:
            node, least, ids = np.asarray(batch.column(0)).view(np.uint64), _matrix(batch.column(2)), batch.column(1)
            if not len(ids):
                continue
            yield pa.RecordBatch.from_arrays([pa.array(_branch(node, least, 0).view(np.int64)), ids], ["node", "id"])
            again = (mix(node + _PATH[0]) >> np.uint64(32)) < often
            if again.any():
                yield pa.RecordBatch.from_arrays([pa.array(_branch(node[again], least[again], 1).view(np.int64)), ids.filter(pa.array(again))], ["node", "id"])

    return rows.select("node", "id", "signature").mapInArrow(run, "node long, id long")


def met(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, id, size, weight``: the nodes of two documents and more, with their documents and set members."""
    sizes = rows.join(sets.select("id", "n_shingles"), "id").groupBy("node").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n_shingles").alias("weight")).where("size > 1")
    return rows.join(sizes, "node").select("node", "id", "size", "weight")


def _blocks(rows: DataFrame, small: int, weight: int) -> DataFrame:
    """Every two blocks of a large node as a node of its own: all its pairs of documents meet in one."""
    parts = F.expr(f"cast(greatest(ceil(2 * size / {small}), ceil(2 * weight / {weight})) as int)")
    placed = rows.withColumn("mine", F.pmod(F.xxhash64("id", "node"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return placed.select(F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other")).alias("node"), "id")


def node_components(count: np.ndarray, members: list[np.ndarray], percent: int) -> np.ndarray:
    """The least position that each set of a node reaches by links; ``members`` are the sets.

    A set is compared with all that no earlier one reached, as rows of bits
    over the members that occur twice: every link of the node is respected.
    """
    flat = np.concatenate(members)
    values, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    place = np.cumsum(shared) - 1
    owner = np.repeat(np.arange(len(members)), count)
    keep = shared[column]
    bits = np.zeros((len(members), (int(shared.sum()) + 63) // 64 * 64), dtype=bool)
    bits[owner[keep], place[column[keep]]] = True
    rows = np.packbits(bits, axis=1).view(np.uint64) if bits.shape[1] else np.zeros((len(members), 1), dtype=np.uint64)
    del bits
    root = np.full(len(members), -1, dtype=np.int64)
    for first in range(len(members)):
        if root[first] >= 0:
            continue
        root[first] = first
        reached = [first]
        while reached:
            x = reached.pop()
            rest = np.flatnonzero(root < 0)
            if not len(rest):
                break
            common = np.bitwise_count(rows[rest] & rows[x]).sum(axis=1, dtype=np.int64)
            near = rest[(common > 0) & (100 * common >= percent * (count[rest] + count[x] - common))]
            root[near] = first
            reached += near.tolist()
    return root


def confirmed(rows: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` that join what is linked within a node: no more than it has documents. ``rows`` holds ``node, id, members``."""

    def links(batch):
        node, ids = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        sets = [np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in batch.column(2)]
        count = np.array([len(v) for v in sets], dtype=np.int64)
        first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        left, right = [], []
        for lo, hi in zip(first.tolist(), np.append(first[1:], len(node)).tolist()):
            if hi - lo > 1:
                root = node_components(count[lo:hi], sets[lo:hi], percent)
                other = np.flatnonzero(root != np.arange(hi - lo))
                left.append(ids[lo + other])
                right.append(ids[lo + root[other]])
        none = [np.zeros(0, dtype=np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(left or none)), pa.array(np.concatenate(right or none))], ["a", "b"])

    def run(batches):
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes = np.asarray(batch.column(0))
            last = int(np.searchsorted(nodes, nodes[-1]))  # sorted by node; the last one may go on in the next batch
            if last:
                yield links(pa.Table.from_batches([*waiting, batch.slice(0, last)]).combine_chunks().to_batches()[0])
                waiting = []
            waiting.append(batch.slice(last))
        if waiting:
            yield links(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])

    dealt = rows.select("node", "id", "members").repartition("node").sortWithinPartitions("node", "id")
    return dealt.mapInArrow(run, "a long, b long").where("a <> b").distinct()


def near_duplicates(df: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
                    recall: float = RECALL, small: int = SMALL, weight: int = WEIGHT, depth: int = DEPTH) -> DataFrame:
    """``id, n_shingles, component_id`` of every row: the least id reachable by links between documents.

    A document's set is its distinct shingles of k lower-cased words; a text of
    fewer words has its whole sequence as the only shingle; a null, empty or
    blank text has none and is linked with nothing. Sets are linked when
    100 * common >= percent * either. Rows that share an id are one document
    with several texts; a null id is linked with nothing and keeps a null
    component. An empty table gives no rows. Shingles are compared as 64-bit
    hashes, equal sets by 128 bits.

    All links between the documents of a small node are found on their full
    sets, but handed on as a spanning forest: a family of copies costs as many
    links as members. A node of more than ``small`` documents or ``weight`` set
    members branches on; what ``depth`` levels leave so large is compared in blocks.
    """
    every = cut_lineage(signatures(df, k, id_col, text_col))
    filled = every.where("key_a is not null and id is not null")
    first = filled.groupBy("key_a", "key_b").agg(F.min_by(F.struct("n_shingles", "signature"), "id").alias("s"), F.min("id").alias("id"))
    sets = cut_lineage(first.select("key_a", "key_b", "id", "s.n_shingles", "s.signature"))
    same = filled.select("id", "key_a", "key_b").join(sets.select("key_a", "key_b", F.col("id").alias("first")), ["key_a", "key_b"])
    links = same.where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b")).distinct()

    fits = (F.col("size") <= small) & ((F.col("weight") <= weight) | (F.col("size") == 2))
    nodes, compared = cut_lineage(met(planted(sets, trees(percent, recall)), sets)), None
    for level in range(depth + 1):
        part = nodes.where(fits).select("node", "id")
        compared = part if compared is None else compared.unionByName(part)
        large = nodes.where(~fits)
        if large.isEmpty():
            break
        if level == depth:
            compared = compared.unionByName(_blocks(large, small, weight))
        else:
            nodes = cut_lineage(met(grown(large.join(sets.select("id", "signature"), "id"), percent), sets))
    # nodes of the same documents tell the same: one of them is enough
    alike = compared.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(id))").alias("s"), F.expr("bit_xor(xxhash64(id, 7))").alias("t"))
    single = alike.groupBy("n", "s", "t").agg(F.min("node").alias("node")).select("node")
    compared = cut_lineage(compared.join(single, "node"))
    if not compared.isEmpty():
        members = shingle_sets(df, presence(compared), k, id_col, text_col)
        links = links.unionByName(confirmed(compared.join(members, "id"), percent))
    groups = components(links).withColumnRenamed("node", "id")
    return every.join(groups, "id", "left").selectExpr("id", "n_shingles", "coalesce(component, id) as component_id")


def keep_one(df: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns as they are, of which one document of every component stays, that of the least id.

    A null id stays; an empty table stays empty.
    """
    found = near_duplicates(df, k, percent, id_col, text_col).where("id <> component_id").select("id").distinct()
    dropped = cut_lineage(found.select(F.col("id").cast(df.schema[id_col].dataType).alias("__dropped")))
    return df.join(dropped, F.col(f"`{id_col}`") == F.col("__dropped"), "left_anti")
