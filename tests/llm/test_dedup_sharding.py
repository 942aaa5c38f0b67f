import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tradewinds.llm import sharding
from tradewinds.llm.exact_dedup import CuckooIndex, exact_dedup, keep_one

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, digest string, id int"


def test_cuckoo_index_grows_and_deletes():
    rng, index, known = random.Random(3), CuckooIndex(2), {}
    for step in range(6000):
        key = hashlib.sha256(str(rng.randrange(2500)).encode()).digest()
        if key in known and rng.random() < 0.4:
            assert index.delete(key)
            del known[key]
        elif key not in known:
            assert index.find(key) is None and not index.delete(key)
            index.insert(key, step)
            known[key] = step
        else:
            assert index.find(key) == known[key]
    assert dict(index.items()) == known and index.live == len(known)


@pytest.fixture
def odd(spark):
    """Nulls everywhere, empty and long texts, repeated rows and ids, clashing column names."""
    rows = [(1, "a b", "en", "s", 3, "x", 1), (2, "ab", None, None, None, None, None), (3, " a\tb ", "en", "s", 5, "x", 2),
            (4, None, None, None, None, None, None), (5, "", "", "", 0, "", 0), (6, "\n\x0b", "en", "s", 2, "y", 3),
            (7, "ß" * 200_000, "de", "s", 200_000, "z", 4), (8, "ß" * 200_000, "de", "s", 200_000, "z", 4),
            (9, "twice", "en", "s", 5, "q", 5), (9, "twice", "en", "s", 5, "q", 5), (9, "other", "en", "s", 5, "q", 5),
            (None, "twice", "en", "s", 5, "q", 5), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, COLUMNS)


def brute(rows):
    groups = {}
    for r in rows:
        norm = "".join(c for c in r.text or "" if c not in " \t\n\x0b\x0c\r")
        groups.setdefault(hashlib.sha256(norm.encode()).hexdigest(), []).append(r)
    out = []
    for sha, members in groups.items():
        best = min(members, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        out += [(r.doc_id, best.doc_id, len(members), r.doc_id == best.doc_id, sha) for r in members]
    return sorted(out, key=str)


def test_exact_dedup_odd_rows(odd):
    got = [(r.id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup(odd).collect()]
    assert sorted(got, key=str) == brute(odd.collect())
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id, (r.text or "")[:5]) for r in kept.collect()) == [(3, " a\tb "), (6, "\n\x0b"), (7, "ß" * 5), (9, "other"), (9, "twice")]
    assert keep_one(odd.limit(0)).count() == 0 and exact_dedup(odd.limit(0)).count() == 0


def test_exact_dedup_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = [(r.id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup(docs).collect()]
    assert sorted(got, key=str) == brute(docs.collect())
    assert keep_one(docs).count() == sum(g[3] for g in got)


@pytest.mark.parametrize("limit", [10, 20_000, 100_000, sharding.SHARD_BYTES])
def test_shards_equal_sql(spark, limit):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sharding.extendible_shards(docs, limit=limit).collect()
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(sharding.shards_sql(limit)).fetchall()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_shards_of_one_hot_key(spark, odd):
    rows = spark.range(3000).select(F.lit(5).alias("doc_id"), F.when(F.col("id") % 7 > 0, F.repeat(F.lit("x"), (F.col("id") % 40).cast("int"))).alias("text"))
    rows = rows.unionByName(spark.createDataFrame([(1, "y" * 500), (2, "z")], "doc_id int, text string"))
    got = sharding.extendible_shards(rows, limit=300).collect()
    total = {}
    for r in got:
        total.setdefault(r.shard, []).append(r)
    assert len(got) == 3002
    for members in total.values():
        size = sum(r.n_bytes for r in members)
        assert all(r.shard_bytes == size and r.shard_rows == len(members) for r in members)
        assert size <= 300 or len(members) == 1
    assert len(total) < 64 * 3 + 3000 * 20 / 150
    assert sharding.extendible_shards(odd, limit=5).count() == 13
    assert sharding.extendible_shards(odd.limit(0)).count() == 0


def test_shards_are_native(spark):
    plan = sharding.extendible_shards(spark.read.parquet(f"{SF}/documents.parquet"), limit=20_000)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
