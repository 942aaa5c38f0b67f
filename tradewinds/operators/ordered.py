"""Ordered scans in two levels, without ever holding a long series in one task.

A series is cut into spans of its first order column (days of a time, ranges
of a number). Windows run inside a (key, span) cell; a span is summed up by an
associative summary of one row; windows over the summaries of a key, of which
there are as many as spans and not as many as rows, give what lies before each
span; and that carry-in is joined back by cell. Everything is one lazy plan:
nothing is measured first, and the layout is the same at every size. Rows are
shuffled by cell once: the join finds them where the window left them.

Computations over neighbouring rows use the running row number, which cuts a
series into blocks of equally many rows, whatever its spread in time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

ORDER = ("ts", "fill_seq")

#: Span of a time column, and the number of ranges of a number between 0 and 1.
SPAN = "day"
RANGES = 4096

#: Rows of a series that one task scans together with their neighbours.
BLOCK_ROWS = 1 << 16

BLOCK = "_block"
NTH = "_nth"
CELL = ["_cell", "_cell_check"]
_BEFORE = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, 0)


def span_of(df: DataFrame, column: str, span: str = SPAN) -> Column:
    """A coarse value that never falls while the column rises; null stays null and comes first, like the column's."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc(span, c)
    if isinstance(kind, T.DateType):
        return F.date_trunc(span, c.cast("timestamp"))
    if isinstance(kind, T.StringType):
        return F.substring(c, 1, 2)
    if isinstance(kind, T.IntegralType):
        # ranges of the logarithm: some thousands for any 64-bit number
        size = F.floor(F.ln(F.abs(c.cast("double")) + 1) * 512)
        return F.when(c < 0, -size).otherwise(size)
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        # numbers outside 0 to 1 share the outermost ranges
        return F.floor(F.least(F.greatest(c.cast("double"), F.lit(0.0)), F.lit(1.0)) * RANGES)
    raise ValueError(f"no spans for {column}: {kind.simpleString()}")


def cell_of(columns: Sequence[Column]) -> dict[str, Column]:
    """Two 64-bit hashes that name a cell. They are never null, so plain equality joins cells, nulls in keys included."""
    parts = [p for c in columns for p in (c, c.isNull())]
    return {CELL[0]: F.xxhash64(*parts), CELL[1]: F.xxhash64(F.lit("check"), *parts)}


def cells(df: DataFrame, keys: Sequence[str], order: Sequence[str], span: str = SPAN) -> DataFrame:
    spanned = df.withColumn("_span", span_of(df, order[0], span))
    return spanned.withColumns(cell_of([*map(F.col, keys), F.col("_span")]))


def _within(order: Sequence[str]) -> Window:
    return Window.partitionBy(*CELL).orderBy(*order).rowsBetween(*_SO_FAR)


def _across(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys).orderBy("_span").rowsBetween(*_BEFORE)


_TOTAL = {"count": lambda c: F.count(F.lit(1)), "sum": F.sum, "max": F.max, "product": F.product}
_AGAIN = {"count": F.sum, "sum": F.sum, "max": F.max, "product": F.product}
_MERGE = {
    "count": lambda local, carry: local + F.coalesce(carry, F.lit(0)),
    "sum": lambda local, carry: F.when(carry.isNull(), local).otherwise(F.coalesce(local, F.lit(0)) + carry),
    "max": lambda local, carry: F.greatest(local, carry),
    "product": lambda local, carry: F.when(carry.isNull(), local).otherwise(F.coalesce(local, F.lit(1.0)) * carry),
}


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], specs: dict[str, tuple[str, Column | None]],
            span: str = SPAN) -> DataFrame:
    """Inclusive running aggregates over each series.

    ``specs`` maps an output column to ``(kind, expression)`` with kind one of
    ``count``, ``sum``, ``max``, ``product``.
    """
    placed = cells(df, keys, order, span)
    local = placed.withColumns({name: _TOTAL[kind](expr).over(_within(order)) for name, (kind, expr) in specs.items()})
    summary = placed.groupBy(*keys, "_span", *CELL).agg(*[_TOTAL[kind](expr).alias(name) for name, (kind, expr) in specs.items()])
    carry = summary.select(*CELL, *[_AGAIN[kind](F.col(name)).over(_across(keys)).alias(f"_in_{name}") for name, (kind, _) in specs.items()])
    joined = local.join(carry, CELL, "left")
    return joined.withColumns({name: _MERGE[kind](F.col(name), F.col(f"_in_{name}")) for name, (kind, _) in specs.items()}).select(
        *df.columns, *[name for name in specs if name not in df.columns])


def blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int = BLOCK_ROWS, span: str = SPAN) -> DataFrame:
    """Adds ``_block``: every ``rows`` rows of a series in order are a block."""
    numbered = running(df, keys, order, {NTH: ("count", None)}, span)
    return numbered.withColumn(BLOCK, F.expr(f"({NTH} - 1) div {rows}")).drop(NTH)


def bounded_frame(df: DataFrame, keys: Sequence[str], order: Sequence[str], reach: int,
                  compute: Callable[[DataFrame, list[str]], DataFrame], rows: int = BLOCK_ROWS, span: str = SPAN) -> DataFrame:
    """Apply a window computation that looks at most ``reach`` rows back or ahead.

    ``compute(rows, partition_columns)`` adds its window columns; the rows carry
    their number in the series as ``_nth``. Each block also gets copies of the
    ``reach`` rows on either side, which go afterwards.
    """
    numbered = running(df, keys, order, {NTH: ("count", None)}, span)
    near = F.expr(f"sequence(greatest(0, {NTH} - 1 - {reach}) div {rows}, ({NTH} - 1 + {reach}) div {rows})")
    copied = numbered.withColumn("_home", F.expr(f"({NTH} - 1) div {rows}")).withColumn(BLOCK, F.explode(near))
    done = compute(copied, [*keys, BLOCK])
    return done.where(F.col("_home") == F.col(BLOCK)).drop("_home", BLOCK, NTH)


def asof(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, order: str, columns: dict[str, str], span: str = SPAN) -> DataFrame:
    """Every left row with the last right row of its series from before its time: new name to right column, NULL where there is none.

    One ordered scan over both tables in place of a join on a range. At equal
    times left rows come first, so a row never sees what happens at its own
    moment; of right rows at one time the last by ``order`` counts.
    """
    seen = F.struct(F.col(time).alias("t"), F.col(order).alias("o"), *[F.col(c).alias(name) for name, c in columns.items()])
    marked = left.select(*keys, F.col(time).alias("_t"), F.lit(0).alias("_side"), F.struct(*left.columns).alias("_row"))
    told = right.select(*keys, F.col(time).alias("_t"), F.lit(1).alias("_side"), seen.alias("_seen"))
    both = marked.unionByName(told, allowMissingColumns=True)
    last = running(both, keys, ["_t", "_side"], {"_last": ("max", F.col("_seen"))}, span)
    return last.where("_side = 0").select("_row.*", *[F.col(f"_last.{name}").alias(name) for name in columns])


def drawdown_curve(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, span: str = SPAN) -> DataFrame:
    """Running total, running peak and their difference; the peak starts at the first total."""
    def scan(rows: DataFrame) -> DataFrame:
        within = _within(order)
        return rows.withColumn("cumulative", F.sum(value).over(within)).withColumn("peak", F.max("cumulative").over(within))

    placed = cells(df, keys, order, span)
    narrow = scan(placed.select(*dict.fromkeys((*keys, *order, value)), "_span", *CELL))
    before = _across(keys)
    carry = (
        narrow.groupBy(*keys, "_span", *CELL).agg(F.sum(value).alias("_total"), F.max("cumulative").alias("_high"))
        .withColumn("_total_in", F.sum("_total").over(before))
        .withColumn("_peak_in", F.max(F.col("_high") + F.coalesce("_total_in", F.lit(0.0))).over(before))
        .select(*CELL, "_total_in", "_peak_in"))
    shift = F.coalesce("_total_in", F.lit(0.0))
    joined = scan(placed).join(carry, CELL, "left").withColumn("peak", F.greatest(F.col("peak") + shift, F.col("_peak_in"))).withColumn(
        "cumulative", F.col("cumulative") + shift)
    return joined.withColumn("drawdown", F.col("cumulative") - F.col("peak")).select(*df.columns, "cumulative", "peak", "drawdown")


def drawdown_states(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str], span: str = SPAN) -> DataFrame:
    """One mergeable state per series, span and value: ``_total, _high, _low, _dd``.

    Total of the span; highest and lowest running total in it; deepest fall
    inside it. ``merged_drawdowns`` makes the falls of whole series of them.
    """
    within, names = _within(order), list(values)
    needed = df.select(*dict.fromkeys((*keys, *order, *values.values())))
    local = cells(needed, keys, order, span)
    local = local.withColumns({f"_c_{n}": F.sum(values[n]).over(within) for n in names})
    local = local.withColumns({f"_p_{n}": F.max(f"_c_{n}").over(within) for n in names})
    return local.groupBy(*keys, "_span", *CELL).agg(*[
        e for n in names for e in (
            F.sum(values[n]).alias(f"_total_{n}"), F.max(f"_c_{n}").alias(f"_high_{n}"),
            F.min(f"_c_{n}").alias(f"_low_{n}"), F.min(F.col(f"_c_{n}") - F.col(f"_p_{n}")).alias(f"_dd_{n}"))]).drop(*CELL)


def merged_drawdowns(states: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Deepest fall of each series; falls over spans are the spans' lows below the highest peak before them."""
    before = _across(keys)
    for n in names:
        states = states.withColumn("_before", F.coalesce(F.sum(f"_total_{n}").over(before), F.lit(0.0)))
        states = states.withColumn("_peak", F.max(F.col(f"_high_{n}") + F.col("_before")).over(before))
        states = states.withColumn(f"_dd_{n}", F.least(f"_dd_{n}", F.col(f"_low_{n}") + F.col("_before") - F.col("_peak")))
    return states.groupBy(*keys).agg(*[F.coalesce(F.min(f"_dd_{n}"), F.lit(0.0)).alias(n) for n in names])


def max_drawdown(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str], span: str = SPAN) -> DataFrame:
    """Deepest fall below the running peak per series, for several value columns at once (output name to column)."""
    return merged_drawdowns(drawdown_states(df, keys, order, values, span), keys, list(values))
