"""A Merkle manifest of a table: a tree for every group of rows, one over their roots, and a proof for every row."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructField, StructType

from tradewinds.session import cut_lineage

#: Levels that one stored node row spans: a task builds the subtrees of runs of 2^STRIDE nodes.
STRIDE = 10

_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def field(column: str) -> Column:
    """A value as it enters a leaf: its UTF-8 length, a colon and the value; a dash for null."""
    text = F.col(f"`{column}`").cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def digest(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*fields).cast("binary"), 256))


def fold(start: str, path: str) -> str:
    """SQL: the hash reached from ``start`` (hex text) over the steps of ``path``, each empty (alone), L or R and the sibling."""
    return f"""aggregate({path}, {start}, (h, s) -> case
        when octet_length(s) = 0 then sha2(cast(h as binary), 256)
        when substring(s, 1, 1) = X'4C' then sha2(cast(concat(lower(hex(substring(s, 2))), h) as binary), 256)
        else sha2(cast(concat(h, lower(hex(substring(s, 2)))) as binary), 256) end)"""


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Adds ``pos``, the place of each row in its group from 0, and ``n``, the rows of the group.

    Rows are dealt out in ranges of (group, order), so a large group spans many
    tasks; places within a task and the rows of the group in earlier tasks add
    up. The table of (task, group) counts is no longer than tasks and groups.
    """
    keys = [group, *order, "__seq"]
    dealt = rows.withColumn("__seq", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = cut_lineage(dealt.drop("__seq").withColumn("__at", F.monotonically_increasing_id())
                        .withColumn("__part", F.shiftright("__at", 33)))
    parts = dealt.groupBy(group, "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col(group).alias("__g"), F.col("__part").alias("__p"), "__first", F.sum("__rows").over(whole).alias("n"),
                         F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"))
    both = dealt.join(parts, (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g")))
    return both.withColumn("pos", F.col("__at") - F.col("__first") + F.col("__before")).drop(
        "__at", "__part", "__g", "__p", "__first", "__before")


def with_paths(nodes: DataFrame, stride: int = STRIDE) -> DataFrame:
    """Adds ``path``: the siblings of each node on its way up ``stride`` levels, or to the root of its group if that is nearer.

    ``nodes`` holds ``g, pos, n, hash`` and any other columns. A task meets runs
    of 2^stride neighbours, never a whole group.
    """
    cut = nodes.withColumn("__run", F.expr(f"shiftright(pos, {stride})"))
    cut = cut.repartition("g", "__run").sortWithinPartitions("g", "__run", "pos").drop("__run")
    names = cut.columns

    def climb(hashes: list[bytes], levels: int) -> list[list[bytes]]:
        steps: list[list[bytes]] = []
        row = [h.hex() for h in hashes]
        for _ in range(levels):
            raw = [bytes.fromhex(h) for h in row]
            steps.append([b"" if i ^ 1 >= len(raw) else (b"L" if i & 1 else b"R") + raw[i ^ 1] for i in range(len(raw))])
            row = [hashlib.sha256("".join(row[i:i + 2]).encode()).hexdigest() for i in range(0, len(row), 2)]
        return [[steps[k][i >> k] for k in range(levels)] for i in range(len(hashes))]

    def finish(batches):
        rows = pa.Table.from_batches(batches)
        n = rows.column("n")[0].as_py()
        levels = min(stride, (n - 1).bit_length())
        path = pa.array(climb(rows.column("hash").to_pylist(), levels), pa.list_(pa.binary()))
        yield from rows.append_column("path", path).combine_chunks().to_batches()

    def run(batches):
        waiting, key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column(names.index("g")).to_pylist()
            runs = [p >> stride for p in batch.column(names.index("pos")).to_pylist()]
            start = 0
            for i in range(len(groups) + 1):
                here = (groups[i], runs[i]) if i < len(groups) else None
                if i < len(groups) and here == key:
                    continue
                if i > start:
                    waiting.append(batch.slice(start, i - start))
                if here is not None:
                    if waiting:
                        yield from finish(waiting)
                    waiting, key, start = [], here, i
        if waiting:
            yield from finish(waiting)

    return cut.mapInArrow(run, StructType([*nodes.schema.fields, StructField("path", ArrayType(BinaryType()))]))


def ascend(nodes: DataFrame, stage: int, stride: int) -> tuple[list[DataFrame], DataFrame, int]:
    """Builds all levels above ``nodes`` (``g, pos, n, hash``): stored node rows by stage, the root of every group, the next stage."""
    stages, roots = [], None
    while True:
        level = cut_lineage(with_paths(nodes, stride).withColumn("stage", F.lit(stage)))
        stages.append(level)
        stage += 1
        tops = level.where(f"pos % {1 << stride} = 0").select(
            "g", F.expr(f"shiftright(pos, {stride})").alias("pos"), F.expr(f"shiftright(n - 1, {stride}) + 1").alias("n"),
            F.unhex(F.expr(fold("lower(hex(hash))", "path"))).alias("hash"))
        tops = cut_lineage(tops)
        done = tops.where("n = 1").select("g", "hash")
        roots = done if roots is None else roots.unionByName(done)
        nodes = tops.where("n > 1")
        if nodes.isEmpty():
            return stages, roots, stage


def _linked(level: DataFrame, stride: int, top: int) -> DataFrame:
    """Node rows with the row they lead to: the run's root one stage up, or the group's place in the top tree."""
    inside = F.col("n") > (1 << stride)
    return level.withColumns({
        "to_stage": F.when(inside, F.col("stage") + 1).otherwise(F.lit(top)),
        "to_g": F.when(inside, F.col("g")).otherwise(F.lit(0).cast("long")),
        "to_pos": F.when(inside, F.expr(f"shiftright(pos, {stride})")).otherwise(F.col("g"))})


def manifest(df: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id",
             group_col: str = "lang", changed: dict[str, Column] | None = None, stride: int = STRIDE) -> DataFrame:
    """A leaf, its proof and the check of that proof for every row: ``id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A leaf hashes the ``fields``, each with its length, a dash for null. Within
    a value of ``group_col`` leaves ascend by id (null first), and pairs of
    neighbours become their hash until one is left; a neighbourless last one is
    hashed alone. The groups' roots, ordered by group (null first, bytewise),
    likewise give the root. ``changed`` replaces fields in the copy whose proof
    is checked: ``folded_root`` starts from that copy's leaf.

    Rows that repeat an id are ordered by their leaf; equal rows are leaves of
    their own. A null text, id or group is a dash in the leaf; an empty text
    has length 0. An empty table gives no rows. Columns not named are not read.

    Levels are stored as node rows that lead to their parent ``stride`` levels
    up and hold the siblings between; a recursive query takes every leaf up
    these rows, appends the siblings and folds the hash, in as many rounds as
    there are stages (2^stride leaves a stage), not levels.
    """
    spark = df.sparkSession
    found = {c: f"__changed_{c}" for c in changed or {}}
    rows = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys((*fields, id_col, group_col))],
                     *[e.alias(found[c]) for c, e in (changed or {}).items()])
    leaves = rows.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{group_col}`").cast("string").alias("grp"),
        digest([field(c) for c in fields]).alias("hash"), digest([field(found.get(c, c)) for c in fields]).alias("found"))
    placed = cut_lineage(numbered(leaves, "grp", ["id", "hash"]))
    groups = numbered(placed.where("pos = 0").select("grp").withColumn("all", F.lit(0)), "all", ["grp"])
    groups = cut_lineage(groups.select(F.col("grp").alias("name"), F.col("pos").alias("g"), F.col("n").alias("groups")))
    placed = placed.join(groups.select("name", "g"), F.col("grp").eqNullSafe(F.col("name"))).drop("grp", "name")
    stages, subroots, top = ascend(placed, 0, stride)
    subroots = cut_lineage(subroots.withColumnRenamed("hash", "subroot").join(groups.select("g", "groups"), "g"))
    above, root, _ = ascend(subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("pos"), F.col("groups").alias("n"),
                                            F.col("subroot").alias("hash")), top, stride)
    first = root.first()
    root_hex = first["hash"].hex() if first else None

    links = ["stage", "g", "pos", "to_stage", "to_g", "to_pos", "path"]
    nodes = None
    for level in stages[1:]:
        part = _linked(level, stride, top).select(*links)
        nodes = part if nodes is None else nodes.unionByName(part)
    for level in above:
        inside = F.col("n") > (1 << stride)
        part = level.withColumns({
            "to_stage": F.when(inside, F.col("stage") + 1), "to_g": F.when(inside, F.col("g")),
            "to_pos": F.when(inside, F.expr(f"shiftright(pos, {stride})"))}).select(*links)
        nodes = part if nodes is None else nodes.unionByName(part)
    climbed = _climb(spark, _linked(stages[0], stride, top), cut_lineage(nodes))
    siblings = F.expr("array_join(transform(filter(proof, s -> octet_length(s) > 0), s -> lower(hex(substring(s, 2)))), '')")
    return climbed.join(subroots.select(F.col("g").alias("__g"), "subroot"), F.col("g") == F.col("__g")).select(
        "id", F.lower(F.hex("hash")).alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"), F.lit(root_hex).cast("string").alias("root"),
        F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), F.col("folded").alias("folded_root"),
        (F.col("folded") == F.lit(root_hex)).alias("verified"))


def _climb(spark: SparkSession, leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every leaf at the root: ``id, g, hash, proof, folded``. One recursive query; its rows are stored."""
    before = spark.conf.get(_ROW_LIMIT, None)
    spark.conf.set(_ROW_LIMIT, "-1")  # the built-in limit is a guard against endless recursion, the links here end
    try:
        found = spark.sql(f"""
            with recursive climb(id, g, hash, stage, node_g, node, proof, folded) as (
                select id, g, hash, to_stage, to_g, to_pos, path, {fold("lower(hex(found))", "path")} from {{leaves}}
                union all
                select c.id, c.g, c.hash, n.to_stage, n.to_g, n.to_pos, concat(c.proof, n.path), {fold("c.folded", "n.path")}
                from climb c join {{nodes}} n on c.stage = n.stage and c.node_g = n.g and c.node = n.pos)
            select id, g, hash, proof, folded from climb where stage is null""", leaves=leaves, nodes=nodes)
        return cut_lineage(found)
    finally:
        if before is None:
            spark.conf.unset(_ROW_LIMIT)
        else:
            spark.conf.set(_ROW_LIMIT, before)
