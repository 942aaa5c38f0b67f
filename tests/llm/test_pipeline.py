import math
import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from test_jaccard_join import brute as near_groups
from test_repeats import brute as without_repeats
from tradewinds.llm import queries, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id % 10 = 0").withColumn("doc_id", F.col("doc_id") + 100_000)).cache()
    rows = {r.doc_id: r for r in docs.collect()}
    model = queries.toxicity_model(spark, docs, SF)
    index = toxicity.ExampleIndex(model["vectors"], model["labels"], model["ids"], len(model["numbers"]))

    def toxic(text):
        vote = index.vote(index.nearest(*toxicity.unit(toxicity.term_counts(text or "", model["numbers"]), model["idf"]), toxicity.NEIGHBOURS), model["base"])
        return 1 / (1 + math.exp(-(model["slope"] * math.log(vote / (1 - vote)) + model["intercept"]))) >= toxicity.THRESHOLD

    clean = {i: r.text for i, r in rows.items() if not toxic(r.text)}
    groups = {}
    for i, t in clean.items():
        groups.setdefault("".join(c for c in t if c not in " \t\n\x0b\x0c\r"), []).append(i)
    single = {i: clean[i] for g in groups.values() for i in [min(g, key=lambda i: (-len(clean[i]), i))]}
    near = {i: single[i] for i, _, component in near_groups(list(single.items()), 5, 80) if i == component}
    cut = {i: kept.decode("utf-8", "ignore") for i, (kept, _) in without_repeats(list(near.items())).items()}

    wanted = [clean, single, near, cut]
    for (name, stage), want in zip(corpus_pipeline.STAGES, wanted):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        path = f"{spark.conf.get('spark.checkpoint.dir')}/{name}"
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        got = {r.doc_id: r for r in docs.collect()}
        assert {i: r.text for i, r in got.items()} == want, name
        assert all(r.n_chars == len(r.text) for r in got.values()), name
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in cut.items()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    total = Counter()
    for r in packed:
        total[r.doc_id] += r.length
    assert total == tokens
    spark.catalog.clearCache()


def test_pipeline_takes_empty_and_odd_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(900_001, None, None, None, None), (900_002, "", "en", "x", 0), (None, None, None, None, None)], docs.schema)
    for table, n in ((docs.limit(0), 0), (odd, 1)):
        out = table
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, SF)
        assert out.count() == n


def test_columns_that_clash_with_results_come_back_as_they_were(spark):
    pick = random.Random(2)
    passage = "".join(pick.choice("abcdefgh ") for _ in range(300))
    rows = [(1, passage, "a", 7, None), (2, "x" + passage, "b", 8, b"z"), (3, None, "c", 9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_bytes int, kept binary")
    out = corpus_pipeline.cut_repeats(spark, df, "")
    assert out.schema == df.schema
    got = {r.doc_id: (r.spans, r.n_bytes, r.kept) for r in out.collect()}
    assert got == {1: ("a", 7, None), 2: ("b", 8, bytearray(b"z")), 3: ("c", 9, None)}
    assert {r.doc_id: r.text for r in out.collect()} == {1: passage, 2: "x", 3: None}
