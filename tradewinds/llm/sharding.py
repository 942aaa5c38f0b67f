"""Shards of bounded bytes by extendible hashing, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tradewinds.session import cut_lineage

#: Bits of the hash that a shard's address can use, and the bits decided in one pass.
HASH_BITS, STEP = 60, 12
#: Production limit of a shard.
SHARD_BYTES = 64 << 20
#: Equal keys are dealt over so many runs when their rows alone exceed a shard.
SALTS = 64


def key_hash(column: str) -> str:
    """SQL: the first 60 bits of the MD5 of a value written as text (null: of the empty text)."""
    return f"cast(conv(substr(md5(cast(coalesce(cast(`{column}` as string), '') as binary)), 1, 15), 16, 10) as long)"


def _leaf(limit: int) -> str:
    """A bucket that needs no further bit: it fits, or no bit can divide it."""
    return f"(bytes <= {limit} or least_hash = most_hash)"


def extendible_shards(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """The shard of every row: ``id, n_bytes, shard, depth, shard_bytes, shard_rows``.

    A bucket is addressed by the leading ``depth`` bits of the key's hash; it
    splits on one more bit only while its texts exceed ``limit`` bytes. ``shard``
    is the address in binary digits (empty at depth 0). Rows of one key that
    alone exceed the limit cannot be divided by its hash; they are dealt over
    pages of the bucket (``address/page``) of at most ``limit`` bytes. A text
    longer than the limit is a page of its own. Null texts have 0 bytes, null
    keys count as the empty text, an empty table has no shards. Other columns
    are not read.

    Bucket sizes come from sums per hash prefix, ``STEP`` bits at a time; only
    rows of buckets still too large are summed again. A hot bucket is pre-summed
    in every task, and the directory has at most one entry per prefix.
    """
    rows = cut_lineage(df.select(
        F.col(id_col).alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        F.expr(key_hash(id_col)).alias("hash"), F.monotonically_increasing_id().alias("row")))
    left, done, found = rows, 0, []
    while True:
        bits = min(STEP, HASH_BITS - done)
        cell = F.shiftright("hash", HASH_BITS - done - bits)
        cells = left.groupBy(cell.alias("cell")).agg(
            F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("n"),
            F.min("hash").alias("least_hash"), F.max("hash").alias("most_hash"))
        levels = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("level")).withColumn(
            "prefix", F.expr(f"shiftright(cell, {bits} - level)"))
        sizes = levels.groupBy("level", "prefix").agg(
            *(F.expr(f"{f}({c}) as {c}") for f, c in (("sum", "bytes"), ("sum", "n"), ("min", "least_hash"), ("max", "most_hash"))))
        leaves = sizes.where(_leaf(limit)).select("level", "prefix", "bytes", "n")
        # the leaf of a cell is its shortest prefix that needs no further bit
        directory = cut_lineage(levels.select("cell", "level", "prefix").join(leaves, ["level", "prefix"], "left").groupBy("cell").agg(
            F.min_by(F.struct("level", "prefix", "bytes", "n"), F.when(F.col("n").isNotNull(), F.col("level"))).alias("leaf")).coalesce(8))
        placed = left.withColumn("cell", cell).join(directory, "cell", "left")
        found.append(placed.where("leaf.n is not null").select(
            "id", "n_bytes", "hash", "row", (F.lit(done) + F.col("leaf.level")).alias("depth"),
            F.col("leaf.bytes").alias("shard_bytes"), F.col("leaf.n").alias("shard_rows")))
        done += bits
        if done >= HASH_BITS or directory.where("leaf.n is null").isEmpty():
            break
        left = placed.where("leaf.n is null").select(rows.columns)
    addressed = reduce(DataFrame.unionByName, found).withColumn(
        "shard", F.expr(f"left(lpad(bin(hash), {HASH_BITS}, '0'), depth)"))
    whole = addressed.where(f"shard_bytes <= {limit} or shard_rows = 1")
    return whole.unionByName(_pages(addressed.where(f"shard_bytes > {limit} and shard_rows > 1"), limit)).select(
        "id", "n_bytes", "shard", "depth", "shard_bytes", "shard_rows")


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of buckets that no bit divides, dealt over pages that fit.

    Small rows (up to half the limit) are summed in order within runs of equal
    salt and cut at half the limit; so a page holds at most the limit. Larger
    rows are a page each.
    """
    run = F.when(F.col("n_bytes") * 2 > limit, F.concat(F.lit("r"), F.col("row"))).otherwise(
        F.concat(F.lit("s"), F.pmod("row", F.lit(SALTS))))
    before = "coalesce(sum(n_bytes) over (partition by shard, run order by row rows between unbounded preceding and 1 preceding), 0)"
    paged = rows.withColumn("run", run).withColumn("page", F.expr(f"floor({before} / {max(limit // 2, 1)})"))
    paged = paged.withColumn("shard", F.concat_ws("/", "shard", F.concat_ws("-", "run", "page")))
    sizes = paged.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_rows"))
    return paged.drop("shard_bytes", "shard_rows", "run", "page").join(sizes, "shard")


def shards_sql(limit: int = SHARD_BYTES) -> str:
    """The same shards in DuckDB SQL, for keys whose rows fit a shard."""
    return f"""
    with r as (select doc_id, coalesce(strlen(text), 0)::bigint n_bytes,
                      ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint h from documents),
    l as (select r.*, d.d, h >> ({HASH_BITS} - d.d) p from r, (select unnest(range(0, {HASH_BITS + 1})) d) d),
    s as (select d, p, sum(n_bytes)::bigint shard_bytes, count(*) shard_rows, min(h) a, max(h) b from l group by d, p),
    f as (select l.doc_id, l.n_bytes, l.h, min(l.d) depth from l join s using (d, p)
          where s.shard_bytes <= {limit} or s.a = s.b group by 1, 2, 3)
    select f.doc_id, f.n_bytes, left(lpad(bin(f.h), {HASH_BITS}, '0'), f.depth::int) shard, f.depth::bigint depth,
           s.shard_bytes, s.shard_rows
    from f join s on s.d = f.depth and s.p = f.h >> ({HASH_BITS} - f.depth)"""
