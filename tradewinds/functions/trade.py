"""Scalar column builders for the trade table."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, functions as F

from tradewinds import vocab


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fill_time(text) -> Column:
    """Parse ``dd-MM-yyyy HH:mm``; NULL when the text does not match."""
    return F.try_to_timestamp(as_col(text), F.lit(vocab.FILL_TIME_FORMAT))


def trade_direction(label) -> Column:
    c = as_col(label)
    return (
        F.when(c.isin(vocab.LONG_LABELS), "Long")
        .when(c.isin(vocab.SHORT_LABELS), "Short")
        .otherwise("Other")
    )


def hash_uniform(text: str) -> Column:
    """A uniform number in [0, 1) from the first 32 bits of md5 of a SQL string expression; equal in any engine."""
    return F.expr(f"cast(conv(substring(md5({text}), 1, 8), 16, 10) as bigint) / 4294967296D")


def leverage_uniform(trade_id="trade_id", ts="ts") -> Column:
    """The uniform number that fixes a trade's leverage; the time stands in for a missing id."""
    return hash_uniform(
        f"coalesce(cast({trade_id} as string), date_format({ts}, '{vocab.FILL_TIME_FORMAT}'), 'nan')")


def leverage_for(u: str, size: str = "size_usd") -> Column:
    """Weighted leverage choice of the size tier at the uniform number in column ``u``.

    ``u`` is a column name, so the hash is computed once per row.
    """

    def pick(choices, weights):
        bounds = [round(b, 10) for b in accumulate(weights)][:-1]
        cases = " ".join(f"when {u} < {bound}D then {choice}" for bound, choice in zip(bounds, choices))
        return f"case {cases} else {choices[-1]} end"

    tiers = [(floor, pick(choices, weights)) for floor, choices, weights in vocab.LEVERAGE_TIERS]
    cases = " ".join(f"when {size} > {floor} then {case}" for floor, case in tiers if floor is not None)
    return F.expr(f"case {cases} else {tiers[-1][1]} end")


def leverage_bucket(leverage: str = "leverage") -> Column:
    cases = " ".join(f"when {leverage} <= {top} then '{label}'" for top, label in vocab.LEVERAGE_BUCKETS if top)
    return F.expr(f"case {cases} else '{vocab.LEVERAGE_BUCKETS[-1][1]}' end")


def pnl_pct(pnl="closed_pnl", size="size_usd") -> Column:
    return F.when(as_col(size) > 0, as_col(pnl) / as_col(size)).otherwise(0.0)


def is_closing(pnl="closed_pnl") -> Column:
    return F.coalesce(as_col(pnl) != 0, F.lit(False))


def win_flag(pnl="closed_pnl") -> Column:
    return F.when(as_col(pnl) > 0, 1).otherwise(0)


def class_rank(col="sentiment_class", order=None) -> Column:
    """Sort key of an ordered category; labels outside the list come last."""
    order = order or vocab.CLASS_ORDER
    position = F.array_position(F.array(*[F.lit(v) for v in order]), as_col(col))
    return F.when(position > 0, position).otherwise(len(order) + 1)


def published_time(col="published_date") -> Column:
    """Article time as a timestamp whether it arrives as text or already typed."""
    return F.try_to_timestamp(as_col(col).cast("string"))


def published_hour(col="published_date", default: int = 12) -> Column:
    return F.coalesce(F.hour(published_time(col)), F.lit(default))


def published_day(col="published_date") -> Column:
    return F.to_date(published_time(col))
