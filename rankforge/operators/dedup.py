"""First row per key (shared by F1 and K2).

Key sizes come from one partial aggregate. Keys up to ``max_key_rows``
rows take one window (``row_number`` per key: a single shuffle and sort).
Hot keys take the aggregate path: ``min`` of a struct led by the order
columns picks the first row, and partial aggregation combines the key
map-side, so no task sorts a whole hot key. The other rows of repeated keys are found by joining the
repeated keys back (AQE splits a hot key on that join); exact copies of
the kept row are re-emitted from counts per (key, task partition), so
first + rest = input as a multiset and no task re-emits a whole hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions.columns import null_safe_join
from rankforge.functions.joins import broadcast_if_small
from rankforge.operators.ranking import MAX_GROUP_ROWS
from rankforge.session import materialize


def _order_field(df: DataFrame, c: str, asc: bool):
    """Ascending sort fields for ``c``: whether it is missing, then its value
    (descending: mirrored). A NULL comes last in either direction; whole
    numbers are mirrored by their complement, which cannot overflow."""
    if asc:
        return [F.col(c).isNull(), F.col(c)]
    dt = df.schema[c].dataType
    if isinstance(dt, T.IntegralType):
        v = F.bitwise_not(F.col(c))
    elif isinstance(dt, (T.FloatType, T.DoubleType)):
        return [F.col(c).isNull(), ~F.isnan(c), -F.col(c)]  # NaN is the largest value
    elif isinstance(dt, T.NumericType):
        v = -F.col(c)
    elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        v = F.bitwise_not(F.unix_micros(F.col(c).cast("timestamp")))
    elif isinstance(dt, T.DateType):
        v = F.bitwise_not(F.unix_date(F.col(c)))
    else:
        v = None
    if v is not None:
        return [F.col(c).isNull(), v]
    raise ValueError(f"descending order needs a numeric, date or timestamp column, {c} is not")


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[tuple[str, bool]] = (),
                  max_key_rows: int = MAX_GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """``(first, rest)``: one row per key (first by ``order`` then by all
    other columns), and every other row of that key."""
    key = list(key)
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    hot = materialize(sizes.filter(F.col("__n") > max_key_rows).select(*key), "hot-keys")
    if hot.limit(1).count() == 0:
        return _by_window(df, key, order)
    hk = broadcast_if_small(hot, written=True)
    cond = [df[k].eqNullSafe(hk[k]) for k in key]
    cold_first, cold_rest = _by_window(df.join(hk, cond, "left_anti"), key, order)
    hot_first, hot_rest = _by_aggregate(df.join(hk, cond, "left_semi"), key, order)
    return cold_first.unionByName(hot_first), cold_rest.unionByName(hot_rest)


def _sort_fields(df: DataFrame, key: list[str], order) -> list:
    rest_cols = [c for c in df.columns if c not in key]
    return [f for c, asc in order for f in _order_field(df, c, asc)] + [F.col(c) for c in rest_cols]


def _by_window(df: DataFrame, key: list[str], order) -> tuple[DataFrame, DataFrame]:
    """Same total order as the struct minimum: every field ascending, NULLs first."""
    w = Window.partitionBy(*key).orderBy(*[f.asc_nulls_first() for f in _sort_fields(df, key, order)])
    x = df.withColumn("__i", F.row_number().over(w))
    return x.filter(F.col("__i") == 1).drop("__i"), x.filter(F.col("__i") > 1).drop("__i")


def _by_aggregate(df: DataFrame, key: list[str], order) -> tuple[DataFrame, DataFrame]:
    cols = df.columns
    rest_cols = [c for c in cols if c not in key]
    fields = [f.alias(f"__o_{i}") for i, f in enumerate(f for c, asc in order for f in _order_field(df, c, asc))]
    fields += [F.col(c).alias(f"__r_{c}") for c in rest_cols]
    kept = df.groupBy(*key).agg(F.min(F.struct(*fields)).alias("__s"), F.count(F.lit(1)).alias("__n"))
    first = kept.select(*key, *[F.col(f"__s.__r_{c}").alias(c) for c in rest_cols]).select(*cols)
    dup = kept.filter(F.col("__n") > 1).drop("__n")
    cand = null_safe_join(df, dup, key, "inner")
    same = F.lit(True)
    for c in rest_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"__s.__r_{c}"))
    differ = cand.filter(~same).select(*cols)
    # exact copies of the kept row: all but one are "rest". They are counted
    # per (key, task partition), so a key with millions of identical rows is
    # re-emitted by many tasks, each at most its own partition's share.
    eq = cand.filter(same).select(*key, "__s").withColumn("__p", F.spark_partition_id())
    per = eq.groupBy(*key, "__p").agg(F.count(F.lit(1)).alias("__k"), F.first("__s").alias("__s"))
    first_part = Window.partitionBy(*key).orderBy("__p")  # at most one row per partition and key
    per = per.withColumn("__k", F.when(F.row_number().over(first_part) == 1, F.col("__k") - 1)
                         .otherwise(F.col("__k")))
    copies = per.filter(F.col("__k") > 0).select(
        *key, "__s", F.explode(F.sequence(F.lit(1), F.col("__k").cast("int"))).alias("__i"))
    copies = copies.select(*key, *[F.col(f"__s.__r_{c}").alias(c) for c in rest_cols]).select(*cols)
    return first, differ.unionByName(copies)
