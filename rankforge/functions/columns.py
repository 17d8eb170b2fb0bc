"""Small column builders shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullif_zero(c: str | Column) -> Column:
    """``NULLIF(c, 0)``: Spark 4 is ANSI, a zero divisor would raise."""
    c = as_col(c)
    return F.when(c != 0, c)


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / NULLIF(den, 0)`` as double; NULL when either side is NULL."""
    return as_col(num).cast("double") / nullif_zero(as_col(den)).cast("double")


def safe_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson r over the rows where both sides are present, as an aggregate;
    NULL (not an ANSI error) when a side is constant over those rows or there
    are fewer than two of them."""
    x, y = as_col(x).cast("double"), as_col(y).cast("double")
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def round6(c: str | Column, digits: int = 6) -> Column:
    return F.round(as_col(c), digits)


def md5_key(c: str | Column) -> Column:
    """Surrogate key: hex md5 of the trimmed UTF-8 value."""
    return F.md5(F.trim(as_col(c).cast("string")).cast("binary"))


def is_integer_text(c: str | Column) -> Column:
    """True when a string is a plain integer (optionally signed)."""
    return as_col(c).rlike(r"^[+-]?[0-9]+$")


def equal_width_bin(v: str | Column, lo: Column, hi: Column, bins: int) -> Column:
    """0-based equal-width bin; values at ``hi`` fall in the last bin and
    a zero-width range puts everything in bin 0."""
    v = as_col(v).cast("double")
    width = (hi - lo) / F.lit(float(bins))
    idx = F.floor((v - lo) / width).cast("bigint")
    return F.when(v.isNull() | F.isnan(v), F.lit(None).cast("bigint")) \
        .when(hi == lo, F.lit(0).cast("bigint")) \
        .otherwise(F.least(idx, F.lit(bins - 1).cast("bigint")))


def sanitize_name(value: str) -> str:
    """Column-name form of a category value: lower case, non-alphanumerics to '_'."""
    return re.sub(r"[^0-9a-z]+", "_", str(value).strip().lower()).strip("_")


def unpivot_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str],
                 var: str = "column", val: str = "value",
                 cast: str | None = None) -> DataFrame:
    """Wide to long in one narrow projection (no shuffle)."""
    src = df
    if cast is not None:
        src = df.select(*ids, *[F.col(c).cast(cast).alias(c) for c in cols])
    return src.unpivot(list(ids), list(cols), var, val)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL, keeping one copy of each key."""
    if not keys:
        raise ValueError("null_safe_join needs at least one key")
    r = right
    renamed = {k: f"__r_{k}" for k in keys}
    for k, nk in renamed.items():
        r = r.withColumnRenamed(k, nk)
    cond = None
    for k, nk in renamed.items():
        c = left[k].eqNullSafe(r[nk])
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    if how in ("full", "full_outer", "outer", "right", "right_outer"):
        for k, nk in renamed.items():
            out = out.withColumn(k, F.coalesce(left[k], F.col(nk)))
    return out.drop(*renamed.values())
