"""Scalar column builders shared by the operators.

All of them are plain ``pyspark.sql.functions`` expressions, so they stay
inside whole-stage codegen.  ANSI mode is on, so every division goes through
:func:`safe_div` and every NaN is turned into a null right where it appears.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


def is_finite(c) -> Column:
    c = col(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(INF))


def finite_or_null(c) -> Column:
    c = col(c)
    return F.when(is_finite(c), c)


def safe_div(num, den) -> Column:
    """``num / den`` with a zero (or null) denominator giving null."""
    den = col(den)
    return col(num) / F.nullif(den, F.lit(0.0))


def safe_log(c) -> Column:
    """Natural log; non-positive input gives null (numpy would give -inf/NaN)."""
    c = col(c)
    return F.when(c > 0, F.log(c))


def var_to_vol(c) -> Column:
    """``sqrt(max(x, 0))``; null stays null."""
    return F.sqrt(F.greatest(col(c), F.lit(0.0)))


def guarded_corr(cov, std_a, std_b, zero_value=None) -> Column:
    """Pearson correlation from population moments.

    ``F.corr`` raises on a constant column under ANSI mode, so the moments
    are combined here with an explicit guard.  ``zero_value`` is what a zero
    denominator yields (0.0 for autocorrelation, null for pearson_r).
    """
    denom = col(std_a) * col(std_b)
    value = col(cov) / F.nullif(denom, F.lit(0.0))
    fallback = F.lit(zero_value).cast("double") if zero_value is not None else F.lit(None).cast("double")
    return F.when(denom > 0, value).otherwise(fallback)


def stock_id_normalised(c) -> Column:
    """``7`` / ``7.0`` / ``"7"`` / ``"stock_7"`` -> ``"stock_7"``."""
    c = col(c)
    text = c.cast("string")
    as_int = F.regexp_replace(text, r"^(-?\d+)\.0+$", "$1")
    return F.when(text.startswith("stock_"), text).otherwise(F.concat(F.lit("stock_"), as_int))


def stock_number(c, missing: int = 1_000_000_000) -> Column:
    """Numeric part of ``stock_<n>`` for natural ordering; others sort last."""
    digits = F.regexp_extract(col(c).cast("string"), r"^(?:stock_)?(\d+)$", 1)
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("bigint"), F.lit(missing).cast("bigint"))


def stock_label(c) -> Column:
    """``stock_12`` -> ``Stock 12``; other strings pass through."""
    n = F.regexp_extract(col(c), r"^stock_(\d+)$", 1)
    return F.when(n != "", F.concat(F.lit("Stock "), n)).otherwise(col(c))


def round_doubles(df, digits: int = 6):
    """Round every double column (used only where a query is compared)."""
    exprs = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            exprs.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)
