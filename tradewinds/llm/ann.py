"""Nearest neighbours by inner product: a navigable small-world graph per shard, results of all shards merged."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradewinds.llm.common import codes
from tradewinds.session import cut_lineage

#: Vectors of a shard, fewer if they are so wide that a shard exceeds SHARD_BYTES; queries of a block.
SHARD_ROWS, SHARD_BYTES, BLOCK_ROWS = 8192, 32 << 20, 2048
#: Links of a node above the ground layer (twice as many there), beams of building and of searching.
LINKS, EF_BUILD, EF_SEARCH = 16, 64, 96


class SmallWorld:
    """A hierarchical navigable small-world graph in flat arrays.

    Nodes are ordered by falling level, so layer l holds the nodes 0 to
    ``len(links[l]) - 1`` and ``links[l]`` is their neighbour array (-1: none).
    Vectors are extended by one component to equal norms; nearness between
    nodes is then a metric and nearness to a query its inner product.
    """

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray] | None = None, batch: int = 256):
        norms = (vectors * vectors).sum(axis=1)
        rest = np.sqrt(np.maximum(norms.max(initial=0.0) - norms, 0.0))
        scale = 1.0 / max(float(np.sqrt(norms.max(initial=0.0))), 1e-300)
        self.scale = scale
        self.points = (np.column_stack([vectors, rest]) * scale).astype(np.float32)
        n = len(vectors)
        if links is not None:
            self.links = links
            return
        draw = (codes(11, n) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
        sizes = [n]
        while (upper := int(np.count_nonzero(draw < float(LINKS) ** -len(sizes)))) > 0 and upper < sizes[-1]:
            sizes.append(upper)
        self.links = [np.full((size, LINKS * (1 if layer else 2)), -1, dtype=np.int32) for layer, size in enumerate(sizes)]
        start = 1
        while start < n:
            stop = min(n, start + min(batch, max(1, start)))
            self._insert(start, stop)
            start = stop

    def _beam(self, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, ef: int, size: int, wide: int = 4):
        """The ``ef`` best nodes found for every query, all queries advancing together; nodes from ``size`` on are not there yet."""
        n_q = len(queries)
        ids = np.full((n_q, ef), -1, dtype=np.int32)
        near = np.full((n_q, ef), -np.inf, dtype=np.float32)
        open_ = np.zeros((n_q, ef), dtype=bool)
        seen = np.zeros((n_q, size + 1), dtype=bool)  # the last column takes the missing neighbours
        seen[:, size] = True
        width = min(entry.shape[1], ef)
        first = entry[:, :width]
        ids[:, :width] = first
        near[:, :width] = np.where(first >= 0, np.einsum("qd,qkd->qk", queries, self.points[first]), -np.inf)
        open_[:, :width] = first >= 0
        np.put_along_axis(seen, np.where(first >= 0, first, size).astype(np.int64), True, axis=1)
        while True:
            rows = np.flatnonzero(open_.any(axis=1))
            if not len(rows):
                return ids, near
            chosen = np.argpartition(np.where(open_[rows], -near[rows], np.inf), min(wide, ef - 1), axis=1)[:, :wide]
            live = np.take_along_axis(open_[rows], chosen, axis=1)
            nodes = np.where(live, np.take_along_axis(ids[rows], chosen, axis=1), -1)
            open_[rows[:, None], chosen] = False
            around = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(len(rows), -1)
            around = np.where((around >= 0) & (around < size), around, size)
            around.sort(axis=1)
            fresh = ~seen[rows[:, None], around]
            fresh[:, 1:] &= around[:, 1:] != around[:, :-1]
            seen[rows[:, None], around] = True
            r, c = np.nonzero(fresh)
            score = np.full(around.shape, -np.inf, dtype=np.float32)
            score[r, c] = np.einsum("nd,nd->n", queries[rows[r]], self.points[around[r, c]])
            both = np.concatenate([near[rows], score], axis=1)
            best = np.argpartition(-both, ef - 1, axis=1)[:, :ef]
            near[rows] = np.take_along_axis(both, best, axis=1)
            ids[rows] = np.take_along_axis(np.concatenate([ids[rows], around.astype(np.int32)], axis=1), best, axis=1)
            open_[rows] = np.take_along_axis(np.concatenate([open_[rows], fresh], axis=1), best, axis=1)
            lost = np.isneginf(near[rows])
            ids[rows] = np.where(lost, -1, ids[rows])
            open_[rows] &= ~lost

    def _select(self, nodes: np.ndarray, candidates: np.ndarray, keep: int) -> np.ndarray:
        """Up to ``keep`` spread-out neighbours of each node: nearest first, skipping one that is nearer to a chosen one
        than to the node; free places are filled with the nearest skipped."""
        known = candidates >= 0
        near = np.where(known, np.einsum("nd,nkd->nk", self.points[nodes], self.points[candidates]), -np.inf)
        order = np.argsort(-near, axis=1, kind="stable")
        candidates, near = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(near, order, axis=1)
        known = np.isfinite(near)
        among = self.points[candidates]
        between = among @ among.transpose(0, 2, 1)
        chosen = np.zeros(candidates.shape, dtype=bool)
        count = np.zeros(len(nodes), dtype=int)
        for j in range(candidates.shape[1]):
            closest = np.where(chosen, between[:, j], -np.inf).max(axis=1)
            take = known[:, j] & (closest < near[:, j]) & (count < keep)
            chosen[:, j] = take
            count += take
        rank = np.where(chosen, 0, np.where(known, 1, 2)) * (candidates.shape[1] + 1) + np.arange(candidates.shape[1])
        pick = np.argsort(rank, axis=1)[:, :keep]
        out = np.full((len(nodes), keep), -1, dtype=np.int32)
        out[:, :pick.shape[1]] = np.where(np.take_along_axis(known, pick, axis=1), np.take_along_axis(candidates, pick, axis=1), -1)
        return out

    def _insert(self, start: int, stop: int) -> None:
        entry = np.zeros((stop - start, 1), dtype=np.int32)
        for layer in range(len(self.links) - 1, -1, -1):
            links = self.links[layer]
            nodes = np.arange(start, min(stop, len(links)))
            size = min(start, len(links))
            ids, near = self._beam(links, self.points[start:stop], entry, EF_BUILD if len(nodes) else 4, size)
            entry = np.take_along_axis(ids, np.argsort(-near, axis=1)[:, :8], axis=1)
            if not len(nodes):
                continue
            fellow = self.points[nodes] @ self.points[nodes].T
            np.fill_diagonal(fellow, -np.inf)
            top = min(16, len(nodes))
            mates = np.argpartition(-fellow, top - 1, axis=1)[:, :top]
            mates = np.where(np.isfinite(np.take_along_axis(fellow, mates, axis=1)), mates + start, -1).astype(np.int32)
            links[nodes] = self._select(nodes, np.concatenate([ids[:len(nodes)], mates], axis=1), links.shape[1])
            self._link_back(links, nodes)

    def _link_back(self, links: np.ndarray, nodes: np.ndarray) -> None:
        source = np.repeat(nodes, links.shape[1])
        target = links[nodes].ravel()
        fine = target >= 0
        source, target = source[fine], target[fine]
        new = ~(links[target] == source[:, None]).any(axis=1)
        source, target = source[new], target[new]
        order = np.lexsort((-np.einsum("nd,nd->n", self.points[source], self.points[target]), target))
        source, target = source[order], target[order]
        owners, first, count = np.unique(target, return_index=True, return_counts=True)
        width = links.shape[1]
        place = np.arange(len(target)) - np.repeat(first, count)
        inside = place < width
        wide = np.full((len(owners), 2 * width), -1, dtype=np.int32)
        wide[:, :width] = links[owners]
        wide[np.repeat(np.arange(len(owners)), count)[inside], width + place[inside]] = source[inside]
        full = (wide >= 0).sum(axis=1) > width
        slack = wide[~full]
        slack = np.take_along_axis(slack, np.argsort(slack < 0, axis=1, kind="stable"), axis=1)
        links[owners[~full]] = slack[:, :width]
        for at in range(0, int(full.sum()), 512):
            part = np.flatnonzero(full)[at:at + 512]
            links[owners[part]] = self._select(owners[part], wide[part][:, (wide[part] >= 0).any(axis=0)], width)

    def search(self, queries: np.ndarray, k: int, ef: int = EF_SEARCH) -> np.ndarray:
        """Up to k nodes (-1: none) for each query, best first."""
        if not len(self.points):
            return np.full((len(queries), k), -1, dtype=np.int32)
        longest = np.sqrt((queries * queries).sum(axis=1, keepdims=True))
        unit = (np.column_stack([queries / np.maximum(longest, 1e-300), np.zeros(len(queries))])).astype(np.float32)
        entry = np.zeros((len(queries), 1), dtype=np.int32)
        for layer in range(len(self.links) - 1, -1, -1):
            ids, near = self._beam(self.links[layer], unit, entry, max(ef, k) if layer == 0 else 8, len(self.links[layer]))
            entry = np.take_along_axis(ids, np.argsort(-near, axis=1), axis=1)
        return entry[:, :k]


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, dim, vector`` of rows that can take part: an id, and a vector of finite components that are not all zero."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).where(
        "id is not null and vector is not null and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        " and exists(vector, x -> x <> 0)")
    return rows.select("id", F.size("vector").alias("dim"), "vector")


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def build_shards(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard: ``dim, shard``, its distinct vectors, the ids that have each, and its neighbour arrays.

    Rows are dealt to shards by a hash of their id, vectors of another length
    to shards of their own. Equal vectors of a shard are one node.
    """
    sizes = {r[0]: r[1] for r in rows.groupBy("dim").count().collect()}  # one entry per vector length
    schema = "dim int, shard int, shards int, vectors binary, ids binary, firsts binary, layers array<binary>"
    if not sizes:
        return rows.sparkSession.createDataFrame([], schema)
    shards = F.create_map(*(F.lit(x) for d, n in sizes.items() for x in (d, -(-n // max(1, min(shard_rows, SHARD_BYTES // (8 * d)))))))

    def build(table: pa.Table) -> pa.Table:
        dim, shard, count = (table.column(c)[0].as_py() for c in ("dim", "shard", "shards"))
        ids, vectors = np.asarray(table.column("id").combine_chunks()), _matrix(table.column("vector"), dim)
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        new = np.ones(len(ids), dtype=bool)
        new[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
        firsts = np.flatnonzero(new)
        mixed = np.argsort(codes(17, len(firsts)))  # similar vectors must not come in one batch
        counts = np.diff(np.append(firsts, len(ids)))[mixed]
        member = np.concatenate([np.arange(f, f + c) for f, c in zip(firsts[mixed], counts)])
        nodes = vectors[firsts[mixed]]
        graph = SmallWorld(nodes)
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()), "shards": pa.array([count], pa.int32()),
            "vectors": pa.array([nodes.tobytes()], pa.binary()), "ids": pa.array([ids[member].tobytes()], pa.binary()),
            "firsts": pa.array([np.cumsum(np.append(0, counts)).tobytes()], pa.binary()),
            "layers": pa.array([[x.tobytes() for x in graph.links]], pa.list_(pa.binary()))})

    dealt = rows.withColumn("shards", shards[F.col("dim")].cast("int")).withColumn("shard", F.expr("pmod(xxhash64(id), shards)").cast("int"))
    return dealt.groupBy("dim", "shard").applyInArrow(build, schema)


def search(index: DataFrame, queries: DataFrame, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, vec_id, score``: the k best of every shard for every query of its length, the query's own id left out.

    Queries go to the shards in blocks; each block meets each shard once.
    """
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / block_rows)).cast("int")
    per_dim = queries.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).select("dim", n_blocks.alias("blocks"))
    visits = index.select("dim", "shard").join(per_dim, "dim").select("dim", "shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    grouped = queries.join(F.broadcast(per_dim), "dim").withColumn("block", F.expr("pmod(xxhash64(id), blocks)").cast("int")).groupBy("dim", "block").agg(
        F.collect_list(F.struct("id", "vector")).alias("rows"))  # a block holds about block_rows queries, not more with more data
    work = visits.join(grouped, ["dim", "block"]).join(index.drop("shards"), ["dim", "shard"])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                dim = row["dim"].as_py()
                ids = np.frombuffer(row["ids"].as_py(), dtype=np.int64)
                firsts = np.frombuffer(row["firsts"].as_py(), dtype=np.int64)
                vectors = np.frombuffer(row["vectors"].as_py(), dtype=np.float64).reshape(-1, dim)
                links = [np.frombuffer(b, dtype=np.int32).reshape(-1, LINKS * (1 if layer else 2)) for layer, b in enumerate(row["layers"].as_py())]
                graph = SmallWorld(vectors, links)
                asked = row["rows"].values
                q_ids, q = np.asarray(asked.field(0)), _matrix(asked.field(1), dim)
                for at in range(0, len(q), 256):
                    found = graph.search(q[at:at + 256], k + 1)
                    out = []
                    for query, vector, nodes in zip(q_ids[at:at + 256].tolist(), q[at:at + 256], found):
                        nodes = nodes[nodes >= 0]
                        scores = vectors[nodes] @ vector
                        for node, score in zip(nodes.tolist(), scores.tolist()):
                            # members of a node are in order of id, so k + 1 of them are enough whichever is the query's own
                            out += [(query, m, score) for m in ids[firsts[node]:min(firsts[node + 1], firsts[node] + k + 1)].tolist() if m != query]
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                                                      pa.array([x[2] for x in out], pa.float64())], ["query_id", "vec_id", "score"])

    return work.mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The k rows of ``df`` with the largest inner product for each row of ``queries``: ``query_id, rank, vec_id, score``.

    Scores are exact in double precision; which rows are found is approximate.
    Equal scores go to the smaller id. Rows whose id is null or whose vector is
    null, zero, or holds null or non-finite components take no part on either
    side; rows with the query's own id are not its neighbours; an id that is
    stored more than once can be found as often, and asks once, with its least vector. Vectors of different lengths
    never meet. Empty tables give no rows; other columns are not read.
    """
    index = cut_lineage(build_shards(usable(df, id_col, vector_col), shard_rows))
    asked = usable(queries, id_col, vector_col).groupBy("id").agg(F.min(F.struct("dim", "vector")).alias("v")).select("id", "v.*")
    found = search(index, asked, k)
    ranked = found.withColumn("rank", F.expr("cast(row_number() over (partition by query_id order by score desc, vec_id) as int)"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
