"""Keyed record maintenance: query, add, delete, update (K1-K4).

Batch re-expression of an add / delete / query / update record manager:
each operation is a join on the key, so it scales with the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.operators.dedup import first_per_key


def lookup(base: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """K1: rows of ``base`` whose key is in ``keys`` (left semi join):
    repeated keys never repeat rows, a NULL key never matches."""
    return base.join(keys.select(*on), list(on), "left_semi")


def delete_keys(base: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """K3: rows of ``base`` whose key is not in ``keys`` (left anti join).
    Base rows with a NULL key stay."""
    on = list(on)
    k = keys.select(*on).dropna()
    return base.join(k, on, "left_anti")


def insert_new(base: DataFrame, rows: DataFrame, on: Sequence[str],
               order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """K2: append rows with a new key; the first by ``order`` (then by the
    other columns) wins inside the batch. Returns ``(result, refused)``;
    refused rows carry ``reason`` = ``null_key``, ``exists`` or ``repeat``.
    Existing keys are removed with an anti join; the first row per new key
    is an aggregate, so a hot key in the batch is combined map-side."""
    on, order = list(on), list(order)
    nk = F.lit(False)
    for c in on:
        nk = nk | F.col(c).isNull()
    null_rows = rows.filter(nk)
    keyed = rows.filter(~nk)
    existing = base.select(*on).dropna()
    exists = keyed.join(existing, on, "left_semi")
    fresh = keyed.join(existing, on, "left_anti")
    first, rest = first_per_key(fresh, on, [(c, True) for c in order])
    cols = rows.columns
    refused = (null_rows.withColumn("reason", F.lit("null_key"))
               .unionByName(exists.withColumn("reason", F.lit("exists")))
               .unionByName(rest.withColumn("reason", F.lit("repeat"))))
    return base.unionByName(first.select(*base.columns)), refused.select(*cols, "reason")


def apply_changes(base: DataFrame, changes: DataFrame, on: Sequence[str], seq_col: str = "seq",
                  op_col: str = "op", partial: bool = False, check_ties: bool = True) -> DataFrame:
    """K4: apply a change batch, the latest change per key (by ``seq_col``)
    wins. ``D`` removes the row, ``U`` / ``I`` set the given columns (a U on a
    missing key inserts; a D on a missing key does nothing). With
    ``partial=True`` a NULL in a change column keeps the old value. A change
    without a ``seq_col`` has no place in the order and is refused. Base rows
    with a NULL key part match no change and pass through as they are.

    The latest change per key comes from ``first_per_key`` (a window for
    keys with few changes, an aggregate for hot keys, so a key with
    millions of changes never lands in one task); then one full outer
    join on the key."""
    on = list(on)
    vals = [c for c in base.columns if c not in on]
    if changes.filter(F.col(seq_col).isNull()).limit(1).count():
        raise ValueError(f"a change has no {seq_col}")
    if check_ties:
        tie = changes.groupBy(*on, seq_col).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1)
        if tie.count():
            raise ValueError(f"two changes share one {seq_col} for a key")
    ch = changes.select(*on, seq_col, op_col, *vals)
    last, _ = first_per_key(ch, on, [(seq_col, False)])
    last = last.select(*on, F.col(op_col).alias("__op"), *[F.col(c).alias(f"__n_{c}") for c in vals])
    unkeyed = F.lit(False)
    for c in on:
        unkeyed = unkeyed | F.col(c).isNull()
    # rows without a key would all meet in one task of the join
    j = base.filter(~unkeyed).join(last, on, "full")
    j = j.filter(F.col("__op").isNull() | (F.upper(F.col("__op")) != "D"))
    changed = F.col("__op").isNotNull()
    out = []
    for c in vals:
        new = F.col(f"__n_{c}")
        if partial:
            new = F.coalesce(new, F.col(c))
        out.append(F.when(changed, new).otherwise(F.col(c)).cast(base.schema[c].dataType).alias(c))
    return j.select(*on, *out).select(*base.columns).unionByName(base.filter(unkeyed))
