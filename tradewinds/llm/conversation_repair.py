"""Cheapest repair of conversations: weighted CYK parsing of their turns under a repair grammar.

A well-formed conversation is empty, or an optional system turn followed by
user and assistant turns in pairs: ``(s?(ua)+)?``. Its grammar in Chomsky normal
form has a symbol [pq] for every two states p, q of that expression. Binary
rules are [pq] -> [pr][rq]; a turn derives [pq] at the price of keeping,
re-roling or deleting it; the insertion closure derives [pq] from nothing. A
span's cell holds the least (cost, audit) of each symbol. As the language is
regular, every split of a span gives the same cells, so spans are combined from
their halves, shortest first, and a long conversation's spans come from
different tasks.

Equal costs never leave one audit the beginning of another within a cell: what
follows would be insertions only, at a price. So the least audit of a span is
part of the least audit of any longer one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Prices of the edits; a truncated turn that is not deleted costs BROKEN more.
REROLE, DELETE, INSERT, BROKEN = 1, 2, 5, 5

BLANKS = " \t\n\x0b\x0c\r"
ROLES = {"s": "system", "u": "user", "a": "assistant"}

Cells = dict[tuple[int, int], tuple[int, str]]

#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STEP = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_ASSISTANT, "u"): _USER, (_USER, "a"): _ASSISTANT}


def joined(left: Cells, right: Cells) -> Cells:
    """Cells of two neighbouring spans taken as one."""
    out: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(4):
            more = right.get((r, q))
            if more is None:
                continue
            total = cost + more[0]
            best = out.get((p, q))
            if best is None or total < best[0] or (total == best[0] and audit + more[1] < best[1]):
                out[p, q] = (total, audit + more[1])
    return out


def _closure() -> Cells:
    out: Cells = {(p, p): (0, "") for p in range(4)}
    one = {**out, **{(p, q): (INSERT, "I") for (p, role), q in _STEP.items() if role != "s"}}
    while (more := joined(out, one)) != out:
        out = more
    return out


INSERTED = _closure()


def turn_cells(code: str) -> Cells:
    """One turn, insertions before it included. Codes: s, u, a or o (other role), capital when truncated, x when it must go."""
    out: Cells = {(p, p): (DELETE, "D") for p in range(4)}
    if code != "x":
        extra = BROKEN if code.isupper() else 0
        for (p, role), q in _STEP.items():
            kept = role == code.lower()
            if kept or role != "s":
                out[p, q] = min(out.get((p, q), (1 << 40, "")), (extra, "K") if kept else (REROLE + extra, "R"))
    return joined(INSERTED, out)


@lru_cache(maxsize=1 << 15)
def _short(codes: str) -> Cells:
    if len(codes) == 1:
        return turn_cells(codes)
    half = len(codes) // 2
    return joined(_short(codes[:half]), _short(codes[half:]))


def span_cells(codes: str) -> Cells:
    """Cells of a run of turns, built from spans of 8, then of 16, and so on."""
    if not codes:
        return {(p, p): (0, "") for p in range(4)}
    row = [_short(codes[i:i + 8]) for i in range(0, len(codes), 8)]
    while len(row) > 1:
        row = [joined(*row[i:i + 2]) if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)]
    return row[0]


def cheapest(cells: Cells) -> tuple[int, str]:
    """Least (cost, audit) of a whole conversation."""
    whole = joined(cells, INSERTED)
    return min(whole[_START, q] for q in (_START, _ASSISTANT) if (_START, q) in whole)


def edits(audit: str) -> Iterator[tuple[str, str | None]]:
    """(edit, initial of the role that the turn has afterwards) for every letter; deleted turns have none.

    A repaired conversation of an odd number of turns starts with a kept system turn.
    """
    kept = len(audit) - audit.count("D")
    place = -(kept % 2)
    for letter in audit:
        if letter == "D":
            yield letter, None
        else:
            yield letter, "s" if place < 0 else "ua"[place % 2]
            place += 1


def turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
          copies: str = "1") -> DataFrame:
    """``conv, turn, role, text, copies, digest``: turns ready for repair; null role or text becomes one space.

    ``copies`` is SQL for how often a turn stands; 0 only says that its conversation exists.
    """
    named = df.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                      F.expr(f"coalesce(cast(`{role_col}` as string), ' ')").alias("role"),
                      F.expr(f"coalesce(cast(`{text_col}` as string), ' ')").alias("text"), F.expr(copies).cast("long").alias("copies"))
    return named.withColumn("digest", F.unhex(F.md5(F.concat(F.octet_length("role"), F.lit(":"), "role", "text").cast("binary"))))


def coded(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, digest, copies, code, again, initial``: what parsing needs of each turn, without its text.

    Equal turns of one number become a row of several copies; ``again`` tells
    that role and text stood earlier in the conversation. The first place of a
    text is an aggregate joined back, so a text that fills a conversation meets
    no single task.
    """
    trimmed = rows.withColumn("__end", F.expr(f"trim(trailing '{BLANKS}' from text)"))
    narrow = trimmed.select(
        "conv", "turn", "role", "digest", "copies", F.expr("case when substring(role, 1, 1) in ('s', 'u', 'a') then substring(role, 1, 1) else 'o' end").alias("initial"),
        F.expr("case when __end = '' then 'blank' when right(__end, 1) in ('.', '!', '?') then 'fine' else 'truncated' end").alias("state"))
    merged = narrow.groupBy("conv", "turn", "role", "digest", "initial", "state").agg(F.sum("copies").alias("copies"))
    first = merged.where("copies > 0").groupBy("conv", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("k"), "turn")).alias("first"))
    first = first.select(F.col("conv").alias("__c"), F.col("digest").alias("__d"), F.col("first.turn").alias("__t"))
    both = merged.join(first, F.col("conv").eqNullSafe(F.col("__c")) & (F.col("digest") == F.col("__d")), "left")
    return both.select("conv", "turn", "role", "digest", "copies", "initial", "state", (~F.col("turn").eqNullSafe(F.col("__t"))).alias("again"))


def _part_schema(conv) -> StructType:
    longs = ("part", "blank", "duplicate", "truncated", "illegal", "low", "high", "distinct")
    return StructType([StructField("conv", conv), *(StructField(c, LongType()) for c in longs), StructField("first", StringType()),
                       StructField("last", StringType()), StructField("cells", StringType())])


def parsed(rows: DataFrame) -> DataFrame:
    """One row per conversation and task that held some of its turns: counts and cells of that span.

    Turns are dealt out in ranges of (conversation, turn), so a long one spans many tasks.
    """
    schema = _part_schema(rows.schema["conv"].dataType)

    def run(batches):
        part = TaskContext.get().partitionId()
        done: list[tuple] = []
        key, span = None, None
        for batch in batches:
            for conv, turn, copies, initial, state, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if span is None or conv != key:
                    if span is not None:
                        done.append(span.row(key, part))
                        if len(done) == 1000:
                            yield _batch(done, schema)
                            done = []
                    key, span = conv, Span()
                if copies:
                    span.add(turn, copies, initial, state, again)
        if span is not None:
            done.append(span.row(key, part))
        if done:
            yield _batch(done, schema)

    order = ["conv", "turn", "role", "digest"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("conv", "turn", "copies", "initial", "state", "again").mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    target = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, target.field(i).type) for i, c in enumerate(zip(*rows, strict=True))], schema=target)


class Span:
    """Counts and codes of neighbouring turns of one conversation, and how two such spans become one."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = None
        self.first = self.last = ""
        self.codes: list[str] = []
        self.cells: Cells | None = None

    def add(self, turn: int | None, copies: int, initial: str, state: str, again: bool) -> None:
        self._turns(turn, turn, 0 if turn is None else 1)
        self._meet(initial, initial, 0)
        self.illegal += (copies - 1) * (initial * 2 not in ("su", "ua", "au"))
        if state == "blank":
            self.blank += copies
            self.codes.append("x" * copies)
            return
        repeats = copies if again else copies - 1
        self.duplicate += repeats
        if not again:
            self.truncated += state == "truncated"
            self.codes.append(initial.upper() if state == "truncated" else initial)
        self.codes.append("x" * repeats)

    def _turns(self, low, high, distinct) -> None:
        if low is not None:
            self.distinct += distinct - (self.high == low)
            self.low, self.high = low if self.low is None else self.low, high

    def _meet(self, first: str, last: str, inside: int) -> None:
        if self.last and first:
            self.illegal += self.last + first not in ("su", "ua", "au")
        self.illegal += inside
        self.first = self.first or first
        self.last = last or self.last

    def row(self, conv, part: int) -> tuple:
        cells = span_cells("".join(self.codes))
        text = "\n".join(f"{p}{q} {cost} {audit}" for (p, q), (cost, audit) in cells.items())
        return (conv, part, self.blank, self.duplicate, self.truncated, self.illegal, self.low, self.high, self.distinct, self.first, self.last, text)

    def extend(self, blank, duplicate, truncated, illegal, low, high, distinct, first, last, text) -> None:
        """The span that follows in the conversation, as ``row`` wrote it."""
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        self._turns(low, high, distinct)
        self._meet(first, last, illegal)
        cells = {(int(k[0]), int(k[1])): (int(cost), audit) for k, cost, audit in (line.split(" ") for line in text.split("\n"))}
        self.cells = cells if self.cells is None else joined(self.cells, cells)

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct


def _repair(rows: DataFrame, schema: StructType, outcome) -> DataFrame:
    """Streams each conversation's parts, then its turns in order, through ``outcome(conv, span, turns)``.

    ``turns`` yields (edit, role, text) and is read as it comes: a conversation's texts are never held together.
    """
    parts = parsed(coded(rows))
    names = [f.name for f in parts.schema.fields]
    empty = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in parts.schema.fields}
    texts = rows.where("copies > 0")
    order = ["turn", "role", "digest"]
    one = parts.select(*names, *[F.lit(None).cast(rows.schema[c].dataType).alias(f"__{c}") for c in (*order, "text", "copies")])
    two = texts.select(F.col("conv"), *[empty[c] for c in names[1:]], *[F.col(c).alias(f"__{c}") for c in (*order, "text", "copies")])
    both = one.unionByName(two).withColumn("__text_row", F.col("part").isNull())
    sorted_rows = both.repartition("conv").sortWithinPartitions("conv", "__text_row", "part", *[f"__{c}" for c in order])

    def stream(batches):
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def run(batches):
        rows_ = stream(batches)
        head = next(rows_, None)
        waiting, size = [], 0

        def texts_of(conv, audit):
            nonlocal head
            steps = edits(audit)
            while head is not None and head[0] == conv:
                role, text = head[len(names) + 1], head[len(names) + 3]
                for _ in range(head[len(names) + 4]):
                    for letter, initial in steps:
                        if letter == "I":
                            yield letter, ROLES[initial], ""
                        else:
                            yield letter, ROLES[initial] if letter == "R" else role, text
                            break
                head = next(rows_, None)
            for letter, initial in steps:
                yield letter, ROLES[initial], ""

        while head is not None:
            conv, span = head[0], Span()
            while head is not None and head[0] == conv and head[1] is not None:
                span.extend(*head[2:len(names)])
                head = next(rows_, None)
            cost, audit = cheapest(span.cells)
            for row, weight in outcome(conv, span, cost, audit, texts_of(conv, audit)):
                waiting.append(row)
                size += weight
                if len(waiting) == 2000 or size > 4 << 20:
                    yield _batch(waiting, schema)
                    waiting, size = [], 0
        if waiting:
            yield _batch(waiting, schema)

    return sorted_rows.select(*names, *[f"__{c}" for c in (*order, "text", "copies")]).mapInArrow(run, schema)


def reports(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    ``rows`` comes from ``turns``. A conversation's turns are taken by number
    (null first; ties by role, then by a digest of role and text). The first
    fault of a turn counts: blank (only ASCII white space), duplicate (role and
    text stood earlier), truncated (does not end in ``.``, ``!`` or ``?``).
    ``audit`` holds the edits' initials: Keep, Rerole, Delete, Insert.
    ``repaired_sha256`` hashes the lines ``role:text`` of the repaired turns.
    A null conversation id is a conversation; one whose turns all have 0 copies
    gets zeros, an empty audit and the hash of nothing. An empty table gives no
    rows; columns not named in ``turns`` are not read.
    """
    kind = rows.schema["conv"].dataType
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = StructType([StructField("conv", kind), *(StructField(c, LongType()) for c in longs), StructField("audit", StringType()),
                         StructField("repaired_sha256", StringType())])

    def outcome(conv, span, cost, audit, repaired):
        digest, any_ = hashlib.sha256(), False
        for letter, role, text in repaired:
            if letter != "D":
                digest.update((("\n" if any_ else "") + role + ":" + text).encode())
                any_ = True
        yield (conv, span.gaps, span.blank, span.duplicate, span.truncated, span.illegal, cost, audit, digest.hexdigest()), len(audit)

    return _repair(rows, schema, outcome)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv, nth`` (from 0), ``edit, role, text``, deleted turns left out."""
    kind = rows.schema["conv"].dataType
    schema = StructType([StructField("conv", kind), StructField("nth", LongType()), StructField("edit", StringType()),
                         StructField("role", StringType()), StructField("text", StringType())])

    def outcome(conv, span, cost, audit, repaired):
        nth = 0
        for letter, role, text in repaired:
            if letter != "D":
                yield (conv, nth, letter, role, text), len(text)
                nth += 1

    return _repair(rows, schema, outcome)


def damaged(df: DataFrame) -> DataFrame:
    """``turns`` of a table ``conv_id, turn, role, text`` after damage by a hash of id and turn: some turns are lost,
    emptied, stripped of their sentence ends, repeated, or given to the user; lost ones keep their place with 0 copies."""
    hit = "crc32(cast(concat(coalesce(cast(conv_id as string), ' '), ':', coalesce(cast(turn as string), ' ')) as binary)) % 20"
    rows = df.select("conv_id", "turn", F.expr("coalesce(role, ' ')").alias("role"), F.expr("coalesce(text, ' ')").alias("text"), F.expr(hit).alias("hit"))
    rows = rows.withColumns({
        "text": F.expr("case hit when 1 then '' when 2 then translate(text, '.!?', '') else text end"),
        "role": F.expr("case hit when 4 then 'user' else role end")})
    return turns(rows, copies="case hit when 0 then 0 when 3 then 2 else 1 end")
