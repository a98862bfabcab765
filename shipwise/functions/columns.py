"""Scalar column helpers, all built from JVM-side functions.

Rounding rule: the reference rounds half-to-even on binary floats, Spark's
``round`` rounds half-up on the decimal text and DuckDB differs again; every
rounded output here uses ``floor(x * 10^d + 0.5) / 10^d`` so that both the
engine and the SQL oracle compute the very same double.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, digits: int) -> Column:
    """floor(x * 10^d + 0.5) / 10^d on doubles."""
    scale = float(10 ** digits)
    return (F.floor(col(c).cast("double") * F.lit(scale) + F.lit(0.5)).cast("double")
            / F.lit(scale))


def to_cents(c) -> Column:
    """Half-up cents of a decimal or double as BIGINT (exact for decimals)."""
    c = col(c)
    return F.floor(c * F.lit(100) + F.lit(Decimal("0.5"))).cast("bigint")


def cents_to_money(c) -> Column:
    return col(c).cast("double") / F.lit(100.0)


def clip_lower(c, lower=0) -> Column:
    """``clip(lower=…)`` that keeps NULL as NULL (``greatest`` would not)."""
    c = col(c)
    return F.when(c < F.lit(lower), F.lit(lower)).otherwise(c)


def text_or_missing(c, missing: str = "nan") -> Column:
    """Text cast as the reference does it: missing becomes the word 'nan'."""
    return F.coalesce(col(c).cast("string"), F.lit(missing))


def weekday_monday0(c) -> Column:
    """Day of week with Monday = 0 … Sunday = 6."""
    return F.weekday(col(c)).cast("int")


def is_weekend(c) -> Column:
    return weekday_monday0(c).isin(5, 6).cast("int")


def safe_ratio(num, den) -> Column:
    """num / den as double, NULL when den is 0 or NULL."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def js_round(c) -> Column:
    """``Math.round`` of JavaScript: floor(x + 0.5)."""
    return F.floor(col(c).cast("double") + F.lit(0.5)).cast("bigint")


def pad_label(c, width: int = 4) -> Column:
    """``String(x).padStart(width, '0')``: pads, never cuts longer ids."""
    s = col(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def risk_band(c, high: float = 0.66, medium: float = 0.33) -> Column:
    c = col(c)
    return (F.when(c > F.lit(high), F.lit("high"))
            .when(c > F.lit(medium), F.lit("medium"))
            .otherwise(F.lit("low")))


def hex_unit(c, start: int) -> Column:
    """Eight hex characters of ``c`` read as an unsigned int / 2^32."""
    return (F.conv(F.substring(col(c), start, 8), 16, 10).cast("double")
            / F.lit(4294967296.0))


def seeded_hash(seed, key) -> Column:
    """md5 of 'seed|key': a reproducible, engine-independent random order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), col(key).cast("string")))
