"""Position sizing and regime rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tradewinds.functions.trade import as_col


def kelly_fraction(win_rate, avg_win, avg_loss) -> Column:
    """Half-Kelly clipped to [0, 0.5]; 0 when the win/loss ratio is undefined or zero."""
    p = as_col(win_rate)
    ratio = F.abs(F.try_divide(as_col(avg_win), as_col(avg_loss)))
    half = (p - F.try_divide(1 - p, ratio)) * 0.5
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(0.5), half))
    return F.when(F.coalesce(ratio, F.lit(0.0)) == 0, 0.0).otherwise(clipped)


def size_fixed_fractional(capital, risk: float = 0.02) -> Column:
    return as_col(capital) * risk


def size_vol_adjusted(capital, vol, target_risk: float = 1000.0) -> Column:
    v = as_col(vol)
    scaled = F.greatest(F.lit(0.0), F.least(F.try_divide(F.lit(target_risk), v), as_col(capital) * 0.5))
    return F.when(v <= 0, target_risk).otherwise(scaled)


def sentiment_multiplier(score) -> Column:
    s = as_col(score)
    return (
        F.when(s < 25, 2.0)
        .when(s < 45, 1.25)
        .when(s > 75, 0.25)
        .when(s > 55, 0.75)
        .otherwise(1.0)
    )


def size_sentiment_adjusted(base, score) -> Column:
    return as_col(base) * sentiment_multiplier(score)


def regime_rule(score="sentiment_score", vol="rolling_volatility", roe="avg_roe") -> Column:
    s, v, r = as_col(score), as_col(vol), as_col(roe)
    turbulent = (v > 0.15) | ((s < 20) & (r < -0.05)) | ((s > 80) & (r > 0.05))
    return (
        F.when(turbulent, "High Volatility / Turbulence")
        .when((s >= 55) & (r >= -0.01), "Bull Market")
        .when((s <= 40) & (r < 0.01), "Bear Market")
        .otherwise("Sideways Market")
    )
