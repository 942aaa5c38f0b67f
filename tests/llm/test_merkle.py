import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tradewinds.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, pos long, path string, g string"


def changed():
    return {"n_chars": F.expr("n_chars + if(crc32(cast(cast(doc_id as string) as binary)) % 7 = 0, 1, 0)")}


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, n_chars):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], n_chars, row[1])))


def levels(row):
    out = [row]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def expected(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    order = sorted(by_lang, key=lambda k: (k is not None, (k or "").encode()))
    for k in order:
        by_lang[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
    trees = {k: levels([leaf(r, r[4]) for r in by_lang[k]]) for k in order}
    top = levels([trees[k][-1][0] for k in order])
    out = []
    for place, k in enumerate(order):
        for i, r in enumerate(by_lang[k]):
            bad = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            now, siblings = leaf(r, r[4] + 1 if bad else r[4]), []
            for tree, at in ((trees[k], i), (top, place)):
                for row in tree[:-1]:
                    pair = row[at - at % 2:at - at % 2 + 2]
                    siblings += [x for j, x in enumerate(pair) if j != at % 2]
                    pair[at % 2] = now
                    now, at = h(*pair), at // 2
            out.append((r[0], leaf(r, r[4]), trees[k][-1][0], top[-1][0], h(*siblings), now, now == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("stride", [1, 2, 10])
def test_like_brute_force(spark, stride):
    rows = [(i * 3, f"täxt {i}" if i % 5 else "", ["en", "fr", None, "é", "only"][min(i % 7, 3) if i else 4], "s", i if i % 4 else None, "x", 1, "y", "z")
            for i in range(41)]
    rows += [(None, None, None, None, None, None, None, None, None), (9, "again", "fr", "s", 2, None, None, None, None)]
    rows += [(9, "again", "fr", "s", 2, None, None, None, None)] * 2  # equal rows are leaves of their own
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in merkle.manifest(df, changed=changed(), stride=stride).collect()), key=str)
    assert got == expected(rows)
    assert any(not r[-1] for r in got)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "1000000"


def test_small_tables(spark):
    df = spark.createDataFrame([(1, "t", "en", "s", 1, "", 0, "", "")], SCHEMA)
    row = merkle.manifest(df).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified
    assert row.proof_sha256 == h()
    assert merkle.manifest(df.limit(0)).count() == 0


def test_a_change_in_any_field_is_noticed(spark):
    df = spark.createDataFrame([(i, "t" * i, "en", "s", i, "", 0, "", "") for i in range(9)], SCHEMA)
    for column in ("text", "source", "lang"):
        found = merkle.manifest(df, changed={column: F.expr(f"if(doc_id = 4, 'other', {column})")})
        assert [r.id for r in found.where("not verified").collect()] == [4]
