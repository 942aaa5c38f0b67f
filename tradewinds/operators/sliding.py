"""Risk ratios over the last n rows of each series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewinds.functions import risk as r
from tradewinds.operators.ordered import BLOCK_ROWS, ORDER, NTH, bounded_frame


def _with_tail_mean(rows: DataFrame, values: str, share: float, out: str) -> DataFrame:
    """Adds the mean of the values at or below the interpolated percentile of a short array column.

    The sorted array and its tail are columns of their own: inside one
    expression they would be made again for every element that reads them.
    """
    rows = rows.withColumn("_sorted", F.sort_array(values))
    place = F.lit(float(share)) * (F.size("_sorted") - 1)
    low, high = F.element_at("_sorted", (F.floor(place) + 1).cast("int")), F.element_at("_sorted", (F.ceil(place) + 1).cast("int"))
    cut = low + (high - low) * (place - F.floor(place))
    rows = rows.withColumn("_cut", cut).withColumn("_tail", F.filter("_sorted", lambda v: v <= F.col("_cut")))
    return rows.withColumn(out, F.aggregate("_tail", F.lit(0.0), lambda a, v: a + v) / F.size("_tail")).drop("_sorted", "_cut", "_tail")


def _sliding_drawdown(rows: DataFrame, part: Sequence[str], order: Sequence[str], value: str, n: int, out: str) -> DataFrame:
    """Deepest fall of the running total within the last n rows, in constant work per row.

    Every n rows are a stretch. A frame is a suffix of one stretch and a prefix
    of the next. The fall inside each of them, and the high and low of their
    totals, come from scans of a stretch in either direction; the fall over the
    seam is the prefix's low below the suffix's high.
    """
    stretch = Window.partitionBy(*part, "_stretch").orderBy(*order)
    so_far, onward = stretch.rowsBetween(Window.unboundedPreceding, 0), stretch.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("_stretch", F.expr(f"({NTH} - 1) div {n}")).withColumn("_cum", F.sum(value).over(so_far))
    rows = rows.withColumns({
        "_peak": F.max("_cum").over(so_far), "_pre_low": F.min("_cum").over(so_far), "_later_low": F.min("_cum").over(onward),
        "_suf_high": F.max("_cum").over(onward) - F.col("_cum") + F.col(value), "_suf_total": F.last("_cum").over(onward) - F.col("_cum") + F.col(value)})
    rows = rows.withColumns({
        "_pre_fall": F.min(F.col("_cum") - F.col("_peak")).over(so_far), "_suf_fall": F.min(F.col("_later_low") - F.col("_cum")).over(onward)})
    first = F.lag(F.struct("_stretch", "_suf_high", "_suf_total", "_suf_fall"), n - 1).over(Window.partitionBy(*part).orderBy(*order))
    rows = rows.withColumn("_first", first)
    seam = F.col("_first._suf_total") + F.col("_pre_low") - F.col("_first._suf_high")
    fall = F.when(F.col("_first._stretch") == F.col("_stretch"), F.col("_pre_fall")).otherwise(F.least("_first._suf_fall", "_pre_fall", seam))
    return rows.withColumn(out, F.when(F.col("_first").isNotNull(), fall)).drop(
        "_stretch", "_cum", "_peak", "_pre_low", "_later_low", "_suf_high", "_suf_total", "_pre_fall", "_suf_fall", "_first")


def sliding_risk(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER, roe: str = "roe", pnl: str = "closed_pnl",
                 n: int = 30, alpha: float = 0.95, rows: int = BLOCK_ROWS) -> DataFrame:
    """Volatility, downside deviation, Sharpe, Sortino, drawdown and expected shortfall of the last ``n`` rows; NULL for the first n-1.

    ``pnl`` and ``roe`` must not be NULL. Ratios are annualised like their
    whole-series forms; the drawdown is that of the running ROE within the frame.
    """
    tail = r.tail_probability(alpha)

    def compute(trades: DataFrame, part: list[str]) -> DataFrame:
        frame = Window.partitionBy(*part).orderBy(*order).rowsBetween(1 - n, 0)
        x = F.col(roe)
        below = F.when(x < 0, x)
        size, falls = F.count(x).over(frame), F.count(below).over(frame)
        out = trades.withColumns({
            "_full": size == n, "_mean": F.avg(x).over(frame), "_vol": F.coalesce(F.stddev_samp(x).over(frame), F.lit(0.0)),
            "_down": F.when((size >= 2) & (falls >= 2), F.sqrt(F.sum(below * below).over(frame) / (size - 1))).otherwise(0.0),
            "_values": F.collect_list(F.col(pnl)).over(frame)})
        out = _with_tail_mean(out, "_values", tail, "_shortfall").drop("_values")
        out = _sliding_drawdown(out, part, order, roe, n, "sliding_max_drawdown")
        full = F.col("_full")
        year = F.sqrt(F.lit(365.0))
        return out.withColumns({
            "sliding_volatility": F.when(full, F.col("_vol")), "sliding_downside": F.when(full, F.col("_down")),
            "sliding_sharpe": F.when(full, F.when(F.col("_vol") > 0, F.col("_mean") / F.col("_vol") * year).otherwise(0.0)),
            "sliding_sortino": F.when(full, F.when(F.col("_down") > 0, F.col("_mean") / F.col("_down") * year).otherwise(0.0)),
            "sliding_shortfall": F.when(full, F.col("_shortfall")),
        }).drop("_full", "_mean", "_vol", "_down", "_shortfall")

    return bounded_frame(df, keys, order, n - 1, compute, rows)
