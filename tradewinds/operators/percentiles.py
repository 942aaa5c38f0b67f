"""Exact percentiles by rank search over value ranges.

The built-in ``percentile`` keeps every distinct value of a group in one
buffer. Here values are counted by coarse ranges, the range that holds a wanted
rank is counted again in finer ones, and only the values of the finest range
are looked at one by one. Counts combine before the shuffle, a group of any
size spreads over its ranges, and the search is part of the lazy plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewinds.operators.ordered import CELL, cell_of

#: Coarse ranges per power of e, and finer ranges in each coarse one.
PER_E = 32
FINE = 1024


def _coarse(v: Column) -> Column:
    """A range number that never falls while the value rises; relative width 1 / PER_E. NaN comes last."""
    size = F.least(F.greatest(F.floor(F.ln(F.abs(v)) * PER_E), F.lit(-40_000)), F.lit(40_000)) + 50_000
    return F.when(F.isnan(v), F.lit(200_000)).when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size)


def _at_rank(counted: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Of rows that each stand for ``_c`` values of sum ``_s``, in the order of ``by``: those that hold the wanted rank.

    ``_rank`` becomes the rank inside the row; ``_n_below`` and ``_s_below`` grow by what lies before it.
    """
    so_far = Window.partitionBy(*keys, "_i").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumns({"_to": F.sum("_c").over(so_far), "_sum_to": F.sum("_s").over(so_far)})
    return placed.where((F.col("_to") - F.col("_c") <= F.col("_rank")) & (F.col("_rank") < F.col("_to"))).withColumns({
        "_rank": F.col("_rank") - (F.col("_to") - F.col("_c")), "_n_below": F.col("_n_below") + F.col("_to") - F.col("_c"),
        "_s_below": F.col("_s_below") + F.col("_sum_to") - F.col("_s")}).drop("_to", "_sum_to", by)


def exact_percentiles(df: DataFrame, keys: Sequence[str], column: str, wanted: dict[str, float],
                      tails: dict[str, str] | None = None) -> DataFrame:
    """One row per group: ``keys`` and the percentiles (name to share), interpolated between neighbours. Nulls do not count.

    ``tails`` adds the mean of the values at or below a percentile (name to the
    percentile's name): the counts on the way to its rank hold their sums too.
    """
    keys = list(keys)
    tally = [F.count(F.lit(1)).alias("_c"), F.sum("_v").alias("_s"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    carried = [*keys, "_i", "_rank", "_last", "_n_below", "_s_below"]
    rows = df.select(*keys, F.col(column).cast("double").alias("_v")).where("_v is not null").withColumn("_range", _coarse(F.col("_v")))
    rows = rows.withColumns(cell_of([*map(F.col, keys), F.col("_range")]))
    coarse = rows.groupBy(*keys, "_range", *CELL).agg(*tally)
    coarse = coarse.withColumns({"_last": F.sum("_c").over(Window.partitionBy(*keys)) - 1, "_n_below": F.lit(0).cast("long"), "_s_below": F.lit(0.0)})
    ranks = [F.struct(F.lit(2 * i + up).alias("_i"), step(F.lit(float(p)) * F.col("_last")).alias("_rank"))
             for i, p in enumerate(wanted.values()) for up, step in enumerate((F.floor, F.ceil))]
    found = _at_rank(coarse.withColumn("_r", F.explode(F.array(*ranks))).select("*", "_r._i", "_r._rank").drop("_r"), keys, "_range")
    values = rows.select(*CELL, "_v")

    width = F.col("_hi") - F.col("_lo")
    finer = F.when(width > 0, F.least(F.floor((F.col("_v") - F.col("_lo")) / width * FINE), F.lit(FINE - 1))).otherwise(0)
    inside = found.join(values, CELL).withColumn("_fine", finer)
    found = _at_rank(inside.groupBy(*carried, *CELL, "_fine").agg(*tally), keys, "_fine")

    inside = found.join(values, CELL).where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
    single = inside.groupBy(*carried, "_v").agg(*tally[:2]).withColumns({"_value": F.col("_v"), "_n_here": F.col("_c"), "_s_here": F.col("_s")})
    found = _at_rank(single, keys, "_v")

    def at(target: int, value: Column) -> Column:
        return F.max(F.when(F.col("_i") == target, value))

    out, names = [], list(wanted)
    for i, (name, p) in enumerate(wanted.items()):
        low, high, place = at(2 * i, F.col("_value")), at(2 * i + 1, F.col("_value")), F.lit(float(p)) * F.max("_last")
        out.append(F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place))).alias(name))
    for name, of in (tails or {}).items():
        # a percentile between two values has the lower one and all before it below
        mean = (F.col("_s_below") + F.col("_s_here")) / (F.col("_n_below") + F.col("_n_here"))
        out.append(at(2 * names.index(of), mean).alias(name))
    return found.groupBy(*keys).agg(*out)


def agg_with_percentiles(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], percentiles: dict[str, tuple[str, float]],
                         tails: dict[str, str] | None = None) -> DataFrame:
    """``groupBy(keys).agg(...)`` plus exact percentile columns ``name -> (column, share)`` and means of their ``tails``."""
    out = df.groupBy(*keys).agg(*aggs)
    for column in dict.fromkeys(c for c, _ in percentiles.values()):
        wanted = {name: p for name, (c, p) in percentiles.items() if c == column}
        part = exact_percentiles(df, keys, column, wanted, {t: of for t, of in (tails or {}).items() if of in wanted})
        renamed = part.withColumnsRenamed({k: f"_k_{k}" for k in keys})
        out = out.join(renamed, same_keys(out, renamed, keys), "left").drop(*[f"_k_{k}" for k in keys])
    return out


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of ``keys`` with the columns ``_k_<key>`` of the right side."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"_k_{k}"])
    return cond
