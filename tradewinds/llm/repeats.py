"""Removal of byte strings that occurred before, found with suffix arrays over groups of anchored passages."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tradewinds.llm.common import _BASE, _BYTE, mix, pieces, presence, slot, tidy, utf8
from tradewinds.llm.suffix_array import suffix_array
from tradewinds.session import cut_lineage

#: Bytes of a string that counts as repeated, and of the gram that anchors it.
LENGTH, GRAM = 100, 20

#: Bytes of texts that a task works through at a time; some ten 8-byte numbers stand for each.
PIECE = 1 << 19


def block_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of every run of ``length`` bytes (of those that do not fit at the end: nothing useful)."""
    out, step, done = None, _BYTE[data], 0
    power, size = _BASE, 1
    with np.errstate(over="ignore"):
        while length:
            if length & 1:  # join the run so far with the next one of this size
                moved = np.zeros_like(step)
                moved[:len(step) - done] = step[done:]
                out = moved if out is None else out * power + moved
                done += size
            length >>= 1
            if length:
                moved = np.zeros_like(step)
                moved[:max(len(step) - size, 0)] = step[size:]
                step, power, size = step * power + moved, power * power, 2 * size
    return mix(out)


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """The runs of LENGTH-byte strings of each text that have the same anchor.

    A string's anchor is the gram in it with the least hash (the first of
    equals), so equal strings have equal anchors at equal places. Returns, for
    every run: text, first start, number of starts, place of the anchor behind the
    first start, hash of the anchor, hash of the passage the run covers.
    """
    n = len(data)
    if n < LENGTH:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4)) + tuple(np.zeros(0, dtype=np.uint64) for _ in range(2))
    gram = block_hashes(data, GRAM)[:n - GRAM + 1]
    width = LENGTH - GRAM + 1
    least, where, size = gram, np.arange(len(gram), dtype=np.int32), 1
    while size < width:
        shift = min(size, width - size)
        left = least[:-shift] <= least[shift:]
        least, where = np.where(left, least[:-shift], least[shift:]), np.where(left, where[:-shift], where[shift:])
        size += shift
    start = np.arange(len(where))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(where)]
    inside = start + LENGTH <= offsets[1:][text]
    start, text, where = start[inside], text[inside], where[inside]
    if not len(start):
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4)) + tuple(np.zeros(0, dtype=np.uint64) for _ in range(2))
    first = np.flatnonzero(np.r_[True, (where[1:] != where[:-1]) | (text[1:] != text[:-1])])
    count = np.diff(np.append(first, len(start)))
    begin, owner, anchor = start[first], text[first], where[first].astype(np.int64)
    stop = begin + count - 1 + LENGTH
    half = block_hashes(data, 64)
    with np.errstate(over="ignore"):
        whole = mix(half[begin] + mix(half[np.minimum(begin + 64, stop - 64)] + mix(half[stop - 64] + mix(((stop - begin) * 256 + anchor - begin).astype(np.uint64)))))
    return owner, begin - offsets[owner], count, anchor - begin, gram[anchor], whole


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(v, dtype=np.int64)) for v in columns.values()], list(columns))


def _joined(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching intervals of a document made one."""
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    if not len(doc):
        return doc, start, stop
    # running maximum of the ends within a document: documents are set apart by an offset
    number = np.cumsum(np.r_[0, doc[1:] != doc[:-1]])
    far = np.maximum.accumulate(stop + number * (np.int64(1) << 40)) - number * (np.int64(1) << 40)
    new = np.r_[True, (number[1:] != number[:-1]) | (start[1:] > far[:-1])]
    first = np.flatnonzero(new)
    return doc[first], start[first], far[np.append(first[1:], len(doc)) - 1]


def anchored(df: DataFrame) -> DataFrame:
    """``gram, whole, doc, pos`` of the passages of all texts, and removals found within a batch (``pos`` below 0).

    ``pos`` holds first start, number of starts and anchor place. Of equal
    passages of a batch only the first goes on; the others repeat it, whatever
    lies elsewhere, so a passage of a third of all rows is sent once per batch.
    """

    def run(batches):
        for batch in batches:
            ids = np.asarray(batch.column(0))
            parts = []
            for begin, part in pieces(batch.column(1), PIECE):
                owner, start, count, place, gram, whole = passages(*utf8(part))
                parts.append((gram.view(np.int64), whole.view(np.int64), ids[begin + owner], start << 16 | count << 8 | place))
            if not parts:
                continue
            gram, whole, doc, pos = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((pos, doc, whole, gram))
            gram, whole, doc, pos = gram[order], whole[order], doc[order], pos[order]
            fresh = np.r_[True, (np.diff(gram) != 0) | (np.diff(whole) != 0) | (np.diff(doc) != 0) | (np.diff(pos) != 0)][:len(gram)]
            gram, whole, doc, pos = gram[fresh], whole[fresh], doc[fresh], pos[fresh]  # rows that repeat a document repeat its places
            first = np.r_[True, (gram[1:] != gram[:-1]) | (whole[1:] != whole[:-1])][:len(gram)]
            d, s, e = _joined(doc[~first], pos[~first] >> 16, (pos[~first] >> 16) + ((pos[~first] >> 8) & 255) - 1 + LENGTH)
            for at in range(0, int(first.sum()), 50_000):
                rows = np.flatnonzero(first)[at:at + 50_000]
                yield _batch({"gram": gram[rows], "whole": whole[rows], "doc": doc[rows], "pos": pos[rows]})
            yield _batch({"gram": d, "whole": e, "doc": d, "pos": -1 - s})  # removals travel along, dealt out by document

    return df.select("id", "text").mapInArrow(tidy(run), "gram long, whole long, doc long, pos long")


def compared(rows: DataFrame) -> DataFrame:
    """``gram, doc, start, stop, place`` of what the passages of one anchor tell.

    A passage that equals an earlier one is removed (``place`` is -1). The first
    of each kind is kept; if its anchor has other passages too, it is handed on
    to be searched with them (``place`` is the anchor's, ``stop`` the end of the passage).
    """

    def run(batches):
        gram_open = whole_open = doc_open = pos_open = None
        held = None  # the only kind so far of the open anchor, not yet handed on
        for batch in batches:
            gram, whole, doc, pos = (np.asarray(c) for c in batch.columns)
            told = pos < 0
            yield _batch({"gram": gram[told], "doc": doc[told], "start": -1 - pos[told], "stop": whole[told], "place": np.full(told.sum(), -1)})
            gram, whole, doc, pos = gram[~told], whole[~told], doc[~told], pos[~told]
            if not len(gram):
                continue
            same = gram_open is not None and (gram[0], whole[0], doc[0], pos[0]) == (gram_open, whole_open, doc_open, pos_open)
            fresh = np.r_[not same, (np.diff(gram) != 0) | (np.diff(whole) != 0) | (np.diff(doc) != 0) | (np.diff(pos) != 0)]
            gram, whole, doc, pos = gram[fresh], whole[fresh], doc[fresh], pos[fresh]
            if not len(gram):
                continue
            start, stop, place = pos >> 16, (pos >> 16) + ((pos >> 8) & 255) - 1 + LENGTH, pos & 255
            new_gram = np.r_[gram_open is None or gram[0] != gram_open, gram[1:] != gram[:-1]]
            new_kind = new_gram | np.r_[whole_open is None or whole[0] != whole_open, whole[1:] != whole[:-1]]
            yield _batch({"gram": gram[~new_kind], "doc": doc[~new_kind], "start": start[~new_kind], "stop": stop[~new_kind], "place": np.full((~new_kind).sum(), -1)})
            rows = np.flatnonzero(new_kind)
            run_of = np.cumsum(new_gram)[rows]  # 0: the anchor that was open
            kinds = np.bincount(run_of, minlength=int(new_gram.sum()) + 1)
            many = kinds > 1
            many[0] = kinds[0] > 0  # with the one held there are several
            if kinds[0] and held is not None:
                yield _batch(held)
                held = None
            ready = rows[many[run_of]]
            yield _batch({"gram": gram[ready], "doc": doc[ready], "start": start[ready], "stop": stop[ready], "place": place[ready]})
            if new_gram.any():
                last = rows[-1]
                held = None if many[-1] else {k: [v[last]] for k, v in (("gram", gram), ("doc", doc), ("start", start), ("stop", stop), ("place", place))}
            gram_open, whole_open, doc_open, pos_open = gram[-1], whole[-1], doc[-1], pos[-1]

    sorted_ = rows.repartition("gram").sortWithinPartitions("gram", "whole", "doc", "pos")
    return sorted_.mapInArrow(tidy(run), "gram long, doc long, start long, stop long, place long")


def _longest_shared(group: np.ndarray, strings: list[bytes]) -> np.ndarray:
    """For each string, the longest prefix it shares with another one of its group (or more, if it holds NUL bytes)."""
    width = max(max(map(len, strings), default=0), 1)
    size = np.array([len(s) for s in strings])
    table = np.zeros((len(strings), width + 4), dtype=np.uint8)
    table[:, :4] = group.astype(">u4").view(np.uint8).reshape(-1, 4)
    inside = np.arange(width) < size[:, None]
    table[:, 4:][inside] = np.frombuffer(b"".join(strings), dtype=np.uint8)
    order = np.argsort(table.view(f"S{width + 4}").ravel(), kind="stable")
    table, size = table[order], size[order]
    same = table[1:] == table[:-1]
    shared = np.where(same.all(axis=1), width + 4, same.argmin(axis=1)) - 4
    shared = np.maximum(np.minimum(shared, np.minimum(size[1:], size[:-1])), -1)
    best = np.full(len(strings), -1, dtype=np.int64)
    best[1:] = shared
    best[:-1] = np.maximum(best[:-1], shared)
    out = np.empty_like(best)
    out[order] = best
    return out


def repeated_starts(strings: list[bytes]) -> list[np.ndarray]:
    """For strings in order of their first occurrence: where in each an LENGTH-byte string starts that an earlier string
    holds, or the same one before.

    One suffix array of all strings brings equal starts together; within a
    run of equal LENGTH-byte prefixes the first in order is kept.
    """
    text = b"\xff".join(strings)
    ends = np.cumsum([len(s) + 1 for s in strings])
    begins = ends - np.array([len(s) + 1 for s in strings])
    whole = np.zeros(len(text), dtype=bool)
    for a, s in zip(begins.tolist(), strings):
        whole[a:a + max(len(s) - LENGTH + 1, 0)] = True
    order = np.array(suffix_array(text), dtype=np.int64)
    order = order[whole[order]]
    data, again = np.frombuffer(text, dtype=np.uint8), np.zeros(len(text), dtype=bool)
    head = np.arange(LENGTH)
    equal = np.zeros(len(order), dtype=bool)
    for at in range(1, len(order), 20_000):
        part = order[at - 1:at + 20_000]
        rows = data[part[:, None] + head]
        equal[at:at + len(part) - 1] = (rows[1:] == rows[:-1]).all(axis=1)
    kind = np.cumsum(~equal)
    by = np.lexsort((order, kind))
    first = np.r_[True, kind[by][1:] != kind[by][:-1]][:len(by)]
    again[order[by[~first]]] = True
    return [np.flatnonzero(again[a:a + len(s)]) for a, s in zip(begins.tolist(), strings)]


def searched(rows: DataFrame) -> DataFrame:
    """``doc, start, stop`` to remove, from ``gram, doc, start, place, passage`` of anchors with several passages.

    A passage is first cut to what it can share with another of its anchor
    around the anchor; if fewer than LENGTH bytes are left, it repeats nothing.
    """

    def resolve(gram, doc, start, place, texts):
        order = np.lexsort((start, doc, gram))
        gram, doc, start, place = (x[order] for x in (gram, doc, start, place))
        texts = [texts[i] for i in order.tolist()]
        fresh = [i for i in range(len(texts)) if not i or texts[i] != texts[i - 1] or (gram[i], doc[i], start[i]) != (gram[i - 1], doc[i - 1], start[i - 1])]
        if len(fresh) < len(texts):  # rows that repeat a document
            gram, doc, start, place, texts = gram[fresh], doc[fresh], start[fresh], place[fresh], [texts[i] for i in fresh]
        group = np.cumsum(np.r_[0, gram[1:] != gram[:-1]])
        after = _longest_shared(group, [t[p:] for t, p in zip(texts, place.tolist())])
        ahead = _longest_shared(group, [t[:p][::-1] for t, p in zip(texts, place.tolist())])
        hopeful = np.flatnonzero((after >= 0) & (ahead >= 0) & (after + ahead >= LENGTH))
        out = []
        cuts = np.flatnonzero(np.r_[True, group[hopeful][1:] != group[hopeful][:-1]])[:len(hopeful)]
        for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(hopeful)).tolist()):
            seen: dict[bytes, int] = {}
            kept, where = [], []
            for i in hopeful[a:b].tolist():
                lo = int(place[i] - ahead[i])
                text = texts[i][lo:int(place[i] + after[i])]
                if text in seen:  # equal to an earlier one as a whole
                    out.append((doc[i], start[i] + lo, start[i] + lo + len(text)))
                else:
                    seen[text] = i
                    kept.append(text)
                    where.append((i, lo))
            if len(kept) < 2 and (not kept or len(kept[0]) <= LENGTH):
                continue
            for (i, lo), starts in zip(where, repeated_starts(kept)):
                if len(starts):
                    runs = np.flatnonzero(np.r_[True, starts[1:] > starts[:-1] + 1])
                    for x, y in zip(starts[runs].tolist(), starts[np.append(runs[1:], len(starts)) - 1].tolist()):
                        out.append((doc[i], start[i] + lo + x, start[i] + lo + y + LENGTH))
        return _batch(dict(zip(("doc", "start", "stop"), np.array(out, dtype=np.int64).reshape(-1, 3).T)))

    def run(batches):
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            grams = np.asarray(batch.column(0))
            if not len(grams):
                continue
            last = int(np.searchsorted(grams, grams[-1]))  # rows are sorted by gram; its last one may go on in the next batch
            if last and (table := pa.Table.from_batches([*waiting, batch.slice(0, last)])):
                yield resolve(*(np.asarray(table.column(c)) for c in range(4)), table.column(4).to_pylist())
                waiting = []
            waiting.append(batch.slice(last))
        if waiting:
            table = pa.Table.from_batches(waiting)
            yield resolve(*(np.asarray(table.column(c)) for c in range(4)), table.column(4).to_pylist())

    return rows.repartition("gram").sortWithinPartitions("gram").mapInArrow(tidy(run), "doc long, start long, stop long")


def _split(df: DataFrame, slots: np.ndarray, hit: bool) -> DataFrame:
    """Rows whose ``slot`` is in the presence filter, or those whose is not."""
    shared = df.sparkSession.sparkContext.broadcast(np.packbits(slots))  # FILTER_SLOTS bits at most

    def run(batches):
        present = np.unpackbits(shared.value).astype(bool)
        at = None
        for batch in batches:
            at = batch.schema.get_field_index("__slot")
            yield batch.filter(pa.array(present[np.asarray(batch.column(at).fill_null(0))] == hit))

    return df.mapInArrow(tidy(run), df.schema)


def fetch(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the passages to be searched: ``gram, doc, start, place, passage``."""
    per_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("gram", "start", "stop", "place")).alias("parts"))  # as many as its bytes allow
    texts = _split(df.withColumn("__slot", slot("id")), presence(wanted, "doc"), True)
    rows = texts.join(per_doc, F.col("id") == F.col("doc")).select("doc", "text", "parts")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py().encode()
                parts = batch.column(2)[i].values
                gram, start, stop, place = (np.asarray(parts.field(k)) for k in range(4))
                fits = stop <= len(text)  # an id that repeats with another text
                cut = [text[a:b] for a, b in zip(start[fits].tolist(), stop[fits].tolist())]
                n = len(cut)
                yield pa.RecordBatch.from_arrays([pa.array(gram[fits]), pa.array(np.full(n, batch.column(0)[i].as_py(), dtype=np.int64)), pa.array(start[fits]),
                                                  pa.array(place[fits]), pa.array(cut, pa.binary())], ["gram", "doc", "start", "place", "passage"])

    return rows.mapInArrow(tidy(run), "gram long, doc long, start long, place long, passage binary")


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, start, stop``: bytes of texts that lie in a LENGTH-byte string which starts earlier too, as intervals that may overlap.

    Earlier means in a document of smaller id, or before in the same document.
    Every string is judged on the input. Ids must be integers; a row with a null
    id takes no part; rows that share an id count as one document at the same places.

    Strings are compared only where they can be equal, those with the same
    anchor gram. Equal passages around an anchor are settled by their hashes;
    different ones of one anchor by a suffix array of their bytes.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("id is not null")
    told = cut_lineage(compared(anchored(docs)))
    found = searched(fetch(docs, told.where("place >= 0").select("gram", "doc", "start", "stop", "place")))
    return told.where("place < 0").select("doc", "start", "stop").unionByName(found)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ``df`` and ``n_bytes, n_removed, spans, kept`` of every row.

    ``spans`` lists the maximal removed runs, ``kept`` the bytes that are left
    (of a null text none). Nothing is removed from texts shorter than LENGTH
    bytes. An empty table gives no rows.
    """
    removed = cut_lineage(repeats(df, id_col, text_col))
    per_doc = removed.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("__spans")).withColumnRenamed("doc", "__doc")
    kinds = {"n_bytes": LongType(), "n_removed": LongType(), "spans": ArrayType(StructType([StructField("start", LongType()), StructField("stop", LongType())])), "kept": BinaryType()}
    rest = [f for f in df.schema if f.name not in kinds]
    schema = StructType([*rest, *(StructField(k, v) for k, v in kinds.items())])
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    width = len(rest)

    def run(batches):
        for batch in batches:
            texts, found = batch.column(width), batch.column(width + 1)
            for first, part in pieces(texts, PIECE):
                sizes, gone, spans, kept = [], [], [], []
                for i, text in enumerate(part.to_pylist()):
                    raw = text.encode()
                    pairs = found[first + i].values
                    if pairs is None or not len(pairs):
                        cuts = []
                    else:
                        start, stop = np.asarray(pairs.field(0)), np.minimum(np.asarray(pairs.field(1)), len(raw))
                        fits = start < stop
                        _, a, b = _joined(np.zeros(int(fits.sum()), dtype=np.int64), start[fits], stop[fits])
                        cuts = list(zip(a.tolist(), b.tolist()))
                    edges = [0, *(x for cut in cuts for x in cut), len(raw)]
                    kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])) if cuts else raw)
                    sizes.append(len(raw))
                    gone.append(len(raw) - len(kept[-1]))
                    spans.append([{"start": a, "stop": b} for a, b in cuts])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(first, len(part)) for c in range(width)), pa.array(sizes, pa.int64()),
                                                  pa.array(gone, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())], schema.names)

    columns = [F.col(f"`{f.name}`") for f in rest]
    rows = df.select(*columns, F.coalesce(F.col(text_col), F.lit("")).alias("__text"), F.col(id_col).cast("long").alias("__id")).withColumn("__slot", slot("__id"))
    slots = presence(removed, "doc")
    touched = _split(rows, slots, True).join(per_doc, F.col("__id") == F.col("__doc"), "left").select(*columns, "__text", "__spans")
    plain = _split(rows, slots, False).select(*columns, "__text", F.lit(None).cast("array<struct<start:long,stop:long>>").alias("__spans"))
    return touched.mapInArrow(tidy(run), schema).unionByName(plain.mapInArrow(tidy(run), schema))
