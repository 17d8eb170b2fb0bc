"""Totals, ratio metrics, ordering and two-metric relations (A1-A5).

Column names default to the canonical entity-field model
``(entity, country, region, field, docs, citations, ...)`` and can be
passed for any other table. Sums stay exact (decimal in, decimal summed)
and are cast to double only in the output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.functions.columns import equal_width_bin, ratio, safe_corr
from rankforge.operators.ranking import top_k as _top_k


def stats_by(df: DataFrame, by: Sequence[str], entity: str = "entity",
             docs: str = "docs", citations: str = "citations") -> DataFrame:
    """A1/A2: per group ``n_entities, docs, citations, cpp`` with
    ``cpp = sum(citations) / sum(docs)`` (ratio of sums)."""
    g = df.groupBy(*by).agg(
        F.count_distinct(entity).alias("n_entities"),
        F.sum(docs).alias("__d"),
        F.sum(citations).alias("__c"),
    )
    return g.select(
        *by,
        F.col("n_entities").cast("bigint").alias("n_entities"),
        F.col("__d").cast("bigint").alias(docs),
        F.col("__c").cast("double").alias(citations),
        ratio("__c", "__d").alias("cpp"),
    )


def ratio_metric(df: DataFrame, num: str, den: str, by: Sequence[str],
                 out: str = "ratio") -> DataFrame:
    """A3: ``sum(num) / nullif(sum(den), 0)`` per group over rows where both
    are present (ratio of sums, not mean of ratios)."""
    both = df.filter(F.col(num).isNotNull() & F.col(den).isNotNull())
    g = both.groupBy(*by).agg(F.sum(num).alias("__n"), F.sum(den).alias("__d"))
    return g.select(*by, F.col("__n").cast("double").alias(num),
                    F.col("__d").cast("double").alias(den), ratio("__n", "__d").alias(out))


def sort_by(df: DataFrame, metric: str, ties: Sequence[str] = (), ascending: bool = False) -> DataFrame:
    """A4: global order by metric (NULL last), then tie columns (range shuffle)."""
    m = F.col(metric)
    first = m.asc_nulls_last() if ascending else m.desc_nulls_last()
    return df.orderBy(first, *[F.col(t).asc_nulls_last() for t in ties])


def top_k(df: DataFrame, metric: str, k: int, ties: Sequence[str], out: str = "rk",
          ascending: bool = False) -> DataFrame:
    """A4 top-k form (``TakeOrderedAndProject``: k rows per partition)."""
    return _top_k(df, metric, k, ties, out, ascending)


def pair_relation(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """A5: pairs with both values present: ``n, r, slope, intercept`` of the
    least-squares line ``y = slope * x + intercept``."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    both = df.filter(xs.isNotNull() & ys.isNotNull())
    aggs = [F.count(F.lit(1)).cast("bigint").alias("n"), safe_corr(xs, ys).alias("r"),
            F.regr_slope(ys, xs).alias("slope"), F.regr_intercept(ys, xs).alias("intercept")]
    return both.groupBy(*by).agg(*aggs) if by else both.agg(*aggs)


def grid_bins(df: DataFrame, x: str, y: str, nx: int, ny: int) -> DataFrame:
    """A5 grid: counts per equal-width cell ``(ix, iy)`` of two metrics.
    Bounds come from one scalar-subquery aggregate (no join)."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    both = df.filter(xs.isNotNull() & ys.isNotNull() & ~F.isnan(xs) & ~F.isnan(ys))
    lo_x, hi_x = both.agg(F.min(xs)).scalar(), both.agg(F.max(xs)).scalar()
    lo_y, hi_y = both.agg(F.min(ys)).scalar(), both.agg(F.max(ys)).scalar()
    cells = both.select(equal_width_bin(xs, lo_x, hi_x, nx).alias("ix"),
                        equal_width_bin(ys, lo_y, hi_y, ny).alias("iy"))
    return cells.groupBy("ix", "iy").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
