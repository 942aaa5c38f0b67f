"""Toxicity from the nearest labelled examples by exact TF-IDF cosine over block-max inverted indexes."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from tradewinds.llm.common import bounded_sample, pieces, tidy
from tradewinds.session import cut_lineage

#: Labelled examples of each class at most, terms of the index at most, examples of a block, and neighbours that vote.
EXAMPLES, TERMS, BLOCK, NEIGHBOURS = 2000, 4096, 64, 15
#: A term joins the index if it is in so many examples and its G statistic against the label is at least this.
LEAST_EXAMPLES, LEAST_G = 3, 15.0
#: Similarity that the base rate weighs in a vote, and the score from which a text counts as toxic.
PRIOR_WEIGHT, THRESHOLD = 1.0, 0.7

_WORD = regex.compile(r"\p{L}+")


def term_counts(text: str, numbers: dict[str, int]) -> Counter:
    """How often each indexed term (a lower-case word) occurs in a whole text."""
    return Counter(numbers[w] for w in _WORD.findall(text.lower()) if w in numbers)


class ExampleIndex:
    """An inverted index over unit TF-IDF vectors of labelled examples, with each term's maximum weight per block.

    A query takes blocks by falling upper bound (the sum of its weights times
    the block maxima) and stops when no further block can hold a better
    neighbour, so the neighbours are exact.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, ids: list, n_terms: int):
        # examples with the same strongest term stand together, which keeps block maxima apart
        strongest = [int(t[np.argmax(w)]) if len(t) else -1 for t, w in vectors]
        order = sorted(range(len(vectors)), key=lambda i: (strongest[i], i))
        self.labels, self.ids = labels[order], [ids[i] for i in order]
        self.blocks = -(-len(order) // BLOCK)
        terms = np.concatenate([vectors[i][0] for i in order] or [np.zeros(0, dtype=np.int64)]).astype(np.int64)
        weights = np.concatenate([vectors[i][1] for i in order] or [np.zeros(0)])
        example = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order])
        key = terms * max(self.blocks, 1) + example // BLOCK
        by = np.argsort(key, kind="stable")
        self.example, self.weight = example[by], weights[by]
        self.pointer = np.searchsorted(key[by], np.arange(n_terms * max(self.blocks, 1) + 1)).reshape(-1)
        self.most = np.zeros(n_terms * max(self.blocks, 1))
        np.maximum.at(self.most, key, weights)
        self.most = self.most.reshape(n_terms, max(self.blocks, 1))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> list[tuple[float, int]]:
        """The k most similar examples, (similarity, number), leaving out those of similarity 0; ties to the lower number."""
        if not len(terms) or not self.blocks:
            return []
        bound = weights @ self.most[terms]
        order = np.argsort(-bound, kind="stable")
        best: list[tuple[float, int]] = []
        at, step = 0, 1
        while at < len(order) and bound[order[at]] > 0 and not (len(best) == k and bound[order[at]] < -best[-1][0] - 1e-12):
            blocks = np.sort(order[at:at + step])  # ever more blocks at a time, as bounds come closer to each other
            at, step = at + step, 2 * step
            lists = (terms[:, None] * self.blocks + blocks).ravel()
            begin, size = self.pointer[lists], self.pointer[lists + 1] - self.pointer[lists]
            ends = np.cumsum(size)
            place = np.arange(ends[-1]) + np.repeat(begin - ends + size, size)
            value = self.weight[place] * np.repeat(np.repeat(weights, len(blocks)), size)
            found = self.example[place]
            row = np.searchsorted(blocks, found // BLOCK)
            scores = np.bincount(row * BLOCK + found % BLOCK, weights=value, minlength=len(blocks) * BLOCK)
            if 0 <= without and without // BLOCK in blocks:
                scores[np.searchsorted(blocks, without // BLOCK) * BLOCK + without % BLOCK] = 0
            floor = max(np.partition(scores, len(scores) - k)[-k], -best[-1][0] if len(best) == k else 0.0) if len(scores) > k else 0.0
            near = np.flatnonzero((scores > 0) & (scores >= floor))
            number = blocks[near // BLOCK] * BLOCK + near % BLOCK
            best = sorted([*best, *((-s, i) for s, i in zip(scores[near].tolist(), number.tolist()))])[:k]
        return [(-s, i) for s, i in best]

    def vote(self, neighbours: list[tuple[float, int]], base: float) -> float:
        """The similarity-weighted share of toxic neighbours, with the base rate as a neighbour of weight PRIOR_WEIGHT."""
        total = sum(s for s, _ in neighbours)
        toxic = sum(s for s, i in neighbours if self.labels[i])
        return (toxic + PRIOR_WEIGHT * base) / (total + PRIOR_WEIGHT)


def unit(counts: Counter, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A unit vector of (1 + log tf) * idf."""
    terms = np.array(sorted(counts), dtype=np.int64)
    weights = np.array([1 + np.log(counts[t]) for t in terms.tolist()]) * idf[terms] if len(terms) else np.zeros(0)
    norm = float(np.sqrt((weights * weights).sum()))
    return (terms, weights / norm) if norm > 0 else (terms[:0], weights[:0])


def choose_terms(texts: list[str], labels: list[int]) -> dict[str, int]:
    """The terms whose presence tells the classes of the examples apart, by the G statistic, strongest first."""
    n = np.array([labels.count(0), labels.count(1)], dtype=float)
    seen = (Counter(), Counter())
    for text, label in zip(texts, labels):
        seen[label].update(set(_WORD.findall(text.lower())))
    names = [t for t in seen[0].keys() | seen[1].keys() if seen[0][t] + seen[1][t] >= LEAST_EXAMPLES]
    if not names or not n.all():
        return {}
    has = np.array([[seen[0][t], seen[1][t]] for t in names], dtype=float)
    table = np.stack([has, n - has], axis=1)
    expected = table.sum(axis=2, keepdims=True) * n / n.sum()
    g = 2 * (table * np.log(np.maximum(table, 1e-300) / np.maximum(expected, 1e-300))).sum(axis=(1, 2))
    strong = sorted((-x, t) for x, t in zip(g.tolist(), names) if x >= LEAST_G)[:TERMS]
    return {t: i for i, (_, t) in enumerate(strong)}


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic calibration, lightly regularised, by Newton's method."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        r, w = weight * (p - y), np.maximum(weight * p * (1 - p), 1e-9)
        grad = np.array([(r * x).sum() + 0.1 * (a - 1), r.sum() + 0.001 * b])
        hess = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.001]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def train(docs: DataFrame, labels: DataFrame, corpus: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          examples: int = EXAMPLES) -> dict:
    """A model from up to ``examples`` labelled texts of each class; ``labels`` holds ``id_col`` and ``label_col`` (0 or 1).

    Document frequencies are counted over all texts of ``corpus``. Votes are
    calibrated on the examples, each judged by the others, with weights that
    restore the class shares of all labels. Null labels and texts teach nothing.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    known = cut_lineage(texts.select("id").join(
        labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where("label in (0, 1)").distinct(), "id"))
    shares = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    # bounded by the parameter: at most twice ``examples`` rows are sent out, and come to the driver with their texts
    chosen = bounded_sample(known, "label", examples, "id").distinct()
    rows = texts.join(F.broadcast(chosen), "id").dropDuplicates(["id", "label"]).collect()
    rows = sorted(rows, key=lambda r: (str(r.id), r.label))
    texts, marks = [r.text for r in rows], [int(r.label) for r in rows]
    numbers = choose_terms(texts, marks)
    n_docs, df = document_frequencies(corpus, numbers, text_col)
    idf = np.log((1 + n_docs) / (1 + df)) + 1
    vectors = [unit(term_counts(t, numbers), idf) for t in texts]
    total = sum(shares.values())
    model = {"numbers": numbers, "idf": idf, "vectors": vectors, "labels": np.array(marks, dtype=bool), "ids": [r.id for r in rows],
             "base": (shares.get(1, 0) + 0.5) / (total + 1.0), "slope": 1.0, "intercept": 0.0}
    if len(set(marks)) == 2:
        index = ExampleIndex(vectors, model["labels"], model["ids"], len(numbers))
        place = {ident: i for i, ident in enumerate(index.ids)}
        votes = np.array([index.vote(index.nearest(*v, NEIGHBOURS, place[r.id]), model["base"]) for r, v in zip(rows, vectors)])
        y = np.array(marks, dtype=float)
        weight = np.where(y == 1, shares[1] / max(y.sum(), 1), shares[0] / max((1 - y).sum(), 1))
        model["slope"], model["intercept"] = fit_logistic(np.log(votes / (1 - votes)), y, weight * len(y) / weight.sum())
    return model


def document_frequencies(corpus: DataFrame, numbers: dict[str, int], text_col: str = "text") -> tuple[int, np.ndarray]:
    """The number of texts, and in how many each indexed term occurs, over all rows; each task sends one row per term."""
    size = len(numbers)

    def run(batches):
        counts = np.zeros(size + 1, dtype=np.int64)
        for batch in batches:
            for _, part in pieces(batch.column(0)):
                counts[size] += len(part)
                for text in part.to_pylist():
                    found = numbers.keys() & set(_WORD.findall(text.lower()))
                    if found:
                        counts[[numbers[w] for w in found]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1)), pa.array(counts)], ["term", "n"])

    out = np.zeros(size + 1)
    for r in corpus.select(text_col).mapInArrow(tidy(run), "term long, n long").groupBy("term").agg(F.sum("n")).collect():
        out[r[0]] = r[1]
    return int(out[size]), out[:size]


def score(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score, predicted, evidence`` of every whole text.

    ``score`` is the calibrated vote of the nearest examples, higher the likelier
    toxic; ``predicted`` is 1 from THRESHOLD on; ``evidence`` lists the
    neighbours with their similarity and label, nearest first. A text that
    shares no term with any example (a null or empty text too) gets the
    calibrated base rate and no evidence. A document that is itself an example
    is found as its own neighbour. Repeated rows give repeated rows, an empty
    table none; other columns are not read.
    """
    kind = df.schema[id_col].dataType
    evidence = StructType([StructField("id", kind), StructField("similarity", DoubleType()), StructField("toxic", IntegerType())])
    schema = StructType([StructField("id", kind), StructField("score", DoubleType()), StructField("predicted", IntegerType()),
                         StructField("evidence", ArrayType(evidence))])
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by EXAMPLES and TERMS
    names = schema.names

    def run(batches):
        m = shared.value
        index = ExampleIndex(m["vectors"], m["labels"], m["ids"], len(m["numbers"]))

        def judge(text: str) -> tuple[float, list]:
            near = index.nearest(*unit(term_counts(text, m["numbers"]), m["idf"]), NEIGHBOURS)
            vote = index.vote(near, m["base"])
            logit = m["slope"] * np.log(vote / (1 - vote)) + m["intercept"]
            return float(1 / (1 + np.exp(-logit))), [{"id": index.ids[i], "similarity": s, "toxic": int(index.labels[i])} for s, i in near]

        for batch in batches:
            for start, part in pieces(batch.column(1)):
                out = [judge(t) for t in part.to_pylist()]
                ids = batch.column(0).slice(start, len(part))
                detail = pa.struct([("id", ids.type), ("similarity", pa.float64()), ("toxic", pa.int32())])
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array([s for s, _ in out], pa.float64()), pa.array([int(s >= THRESHOLD) for s, _ in out], pa.int32()),
                    pa.array([e for _, e in out], pa.list_(detail))], names)

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), schema)


def keep_clean(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns as they are, whose text the model does not take for toxic."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def run(batches):
        m = shared.value
        index = ExampleIndex(m["vectors"], m["labels"], m["ids"], len(m["numbers"]))
        for batch in batches:
            for start, part in pieces(batch.column(at)):
                votes = np.array([index.vote(index.nearest(*unit(term_counts(t, m["numbers"]), m["idf"]), NEIGHBOURS), m["base"]) for t in part.to_pylist()])
                logit = m["slope"] * np.log(votes / (1 - votes)) + m["intercept"]
                yield batch.slice(start, len(part)).filter(pa.array(1 / (1 + np.exp(-logit)) < THRESHOLD))

    return df.mapInArrow(tidy(run), df.schema)
