"""Ranks inside groups and over whole tables (Q6, Q7) and exact quantiles.

A plain ranking window sorts each group in one task, and a window without
``partitionBy`` sorts the whole table in one task. Ranks here stay exact
but no task sorts more than a bounded number of rows:

* group sizes come from one partial aggregate; groups up to
  ``max_group_rows`` rows are ranked with a plain window (one task each);
* larger ("hot") groups, and the whole table when there is no group, are
  split into value buckets:

  1. approximate quantile bounds of the metric per hot group (partial
     aggregate, combined map-side), at most ``BOUNDS_BUDGET`` numbers in all;
  2. bucket = number of bounds on the "better" side of the value, so equal
     values always share a bucket and buckets follow the rank order: a binary
     search of whole Arrow batches in the bounds, which travel with the
     function, so the plan is the same for 100 buckets and for 4,096 (up to
     ``FEW_BUCKETS`` of a whole table: comparisons in generated code);
  3. rows per (group, bucket) -> offset = rows in better buckets (a table
     of hot groups x buckets rows, never data rows);
  4. rank = offset + rank() over (group, bucket).

The bounds only balance work; any bounds give the same, exact ranks. Where
buckets can't split a group (``row_number`` and ``ntile`` inside one hot value,
or more than ``MAX_BUCKETS`` buckets or ``BOUNDS_BUDGET`` bounds), its rows are
range-partitioned and sorted over the cluster with their position as last tie,
and ranks are differences of positions.
Small tables (group sizes, bucket counts) are written once and broadcast only
after their rows and bytes are checked; otherwise they are shuffle-joined.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions.columns import null_safe_join
from rankforge.functions.joins import broadcast_if_small
from rankforge.session import materialize

AUTO = "auto"
DEFAULT_BUCKETS = AUTO
MIN_BUCKETS = 32             # buckets of a whole-table rank, at least
MAX_GROUP_ROWS = 2_000_000   # rows one window task may sort
BUCKET_ROWS = 500_000        # target rows per bucket of a split group
FEW_BUCKETS = 64             # up to here the bounds of one group are compared in generated code
MAX_BUCKETS = 4096           # buckets of one group, at most; past it: positions
BOUNDS_BUDGET = 1_000_000    # bound values (doubles, 8 MB) of all groups together; past it: positions
QUANTILE_ACCURACY = 10000
METHODS = ("rank", "dense_rank", "row_number", "percent_rank", "ntile")


def _order(metric: str, ascending: bool, ties: Sequence[str]) -> list[Column]:
    m = F.col(metric)
    first = m.asc_nulls_last() if ascending else m.desc_nulls_last()
    return [first] + [F.col(t).asc_nulls_last() for t in ties]


def _check(method: str, ties: Sequence[str], n_tiles: int | None) -> None:
    if method not in METHODS:
        raise ValueError(f"unknown rank method {method!r}; use one of {METHODS}")
    if method in ("row_number", "ntile") and not ties:
        raise ValueError(f"{method} needs tie columns so that the order is unique")
    if method == "ntile" and (n_tiles is None or n_tiles < 1):
        raise ValueError("ntile needs n_tiles >= 1")


def _spec(method) -> tuple[str, int | None]:
    if isinstance(method, tuple):
        return method[0], method[1]
    return method, None


def rank_within(df: DataFrame, by: Sequence[str], metric: str, method: str = "rank",
                ascending: bool = False, ties: Sequence[str] = (), out: str = "rank",
                buckets=DEFAULT_BUCKETS, n_tiles: int | None = None,
                total_col: str | None = None, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Add ``out`` = the row's rank inside its group (Q6), or over the whole
    table when ``by`` is empty (Q7). NULL metrics come last and tie.

    ``buckets``: ``'auto'`` splits only groups above ``max_group_rows``;
    ``None`` uses plain windows (many small groups known in advance); an
    integer splits every group into that many value buckets.
    ``total_col`` also emits the group's row count.
    """
    m = (method, n_tiles) if method == "ntile" else method
    return rank_columns(df, by, metric, {out: m}, ascending, ties, buckets, total_col, max_group_rows)


def rank_columns(df: DataFrame, by: Sequence[str], metric: str, outputs: dict,
                 ascending: bool = False, ties: Sequence[str] = (), buckets=DEFAULT_BUCKETS,
                 total_col: str | None = None, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Several rank columns in one pass: ``outputs`` maps a column name to
    a method (``'rank'``, ``'dense_rank'``, ``'row_number'``,
    ``'percent_rank'``) or ``('ntile', n)``. Sizes, bounds, buckets and
    counts are shared by all of them."""
    by, ties = list(by), list(ties)
    specs = [(out, *_spec(m)) for out, m in outputs.items()]
    for _, method, n in specs:
        _check(method, ties, n)
    if buckets == AUTO:
        return _auto(df, by, metric, specs, ascending, ties, total_col, max_group_rows)
    if not by and not buckets:
        buckets = MIN_BUCKETS  # never rank a whole table in one partition
    if buckets and buckets > 1:
        if buckets > MAX_BUCKETS or not _has_number(df, metric) or (by and df.select(*by).distinct().count() * buckets > BOUNDS_BUDGET):
            return _by_position(df, by, metric, specs, ascending, ties, total_col)
        return _split(df, by, metric, specs, ascending, ties, int(buckets), total_col, hot=None)
    return _plain(df, by, metric, specs, ascending, ties, total_col)


def _plain(df, by, metric, specs, ascending, ties, total_col):
    w = Window.partitionBy(*by).orderBy(*_order(metric, ascending, []))
    wt = Window.partitionBy(*by).orderBy(*_order(metric, ascending, ties))
    res = df
    for out, method, n in specs:
        fn = {
            "rank": lambda: F.rank().over(w), "dense_rank": lambda: F.dense_rank().over(w),
            "row_number": lambda: F.row_number().over(wt),
            "percent_rank": lambda: F.percent_rank().over(w), "ntile": lambda: F.ntile(n).over(wt),
        }[method]()
        res = res.withColumn(out, fn.cast("double" if method == "percent_rank" else "bigint"))
    if total_col:
        res = res.withColumn(total_col, F.count(F.lit(1)).over(Window.partitionBy(*by)).cast("bigint"))
    return res


def _auto(df, by, metric, specs, ascending, ties, total_col, max_group_rows):
    """Plain windows for groups that fit one task, value buckets for the rest."""
    if not by:
        n = df.agg(F.count(F.lit(1))).first()[0]
        b = max(MIN_BUCKETS, math.ceil(n / BUCKET_ROWS))
        if b > MAX_BUCKETS or not _has_number(df, metric) or (n > max_group_rows and _needs_order(specs)):
            return _by_position(df, by, metric, specs, ascending, ties, total_col)
        return _split(df, by, metric, specs, ascending, ties, b, total_col, hot=None)
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__gn"))
    hot = materialize(sizes.filter(F.col("__gn") > max_group_rows), "hot-groups")
    top = hot.agg(F.max("__gn"), F.count(F.lit(1))).first()
    if not top[1]:
        return _plain(df, by, metric, specs, ascending, ties, total_col)
    # buckets follow the largest group; no bounds array is ever copied into data rows
    b = max(2, math.ceil(top[0] / BUCKET_ROWS))
    if b > MAX_BUCKETS or b * top[1] > BOUNDS_BUDGET or _needs_order(specs) or not _has_number(df, metric):
        hk = broadcast_if_small(hot.select(*by), written=True)
        cond = [df[k].eqNullSafe(hk[k]) for k in by]
        cold = _plain(df.join(hk, cond, "left_anti"), by, metric, specs, ascending, ties, total_col)
        return cold.unionByName(_by_position(df.join(hk, cond, "left_semi"), by, metric, specs, ascending, ties, total_col))
    return _split(df, by, metric, specs, ascending, ties, b, total_col, hot=hot.select(*by))


def _needs_order(specs) -> bool:
    """Whether a method orders equal values too, so that one hot value can't be spread."""
    return any(method in ("row_number", "ntile") for _, method, _ in specs)


def positions(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` plus its 0-based place in the order: a cluster-wide sort, written
    once, and the row counts of the partitions before (one row each)."""
    tie = "__at"
    s = df.withColumn(tie, F.monotonically_increasing_id()).orderBy(*order, tie)
    s = materialize(s.withColumn(tie, F.monotonically_increasing_id()), "positions")
    part = F.shiftright(F.col(tie), 33)
    n = s.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("__k"))
    n = n.select("__p", (F.sum("__k").over(Window.orderBy("__p")) - F.col("__k")).alias("__o"))
    s = s.withColumn("__p", part).join(F.broadcast(n), "__p")
    return s.withColumn(name, F.col("__o") + F.col(tie) - F.shiftleft(F.col("__p"), 33)).drop(tie, "__p", "__o")


def _ntile(rn: Column, tot: Column, n_tiles: int) -> Column:
    """Same split as SQL NTILE: the first N % n tiles get one extra row."""
    q = F.floor(tot / F.lit(n_tiles)).cast("bigint")
    r = (tot % F.lit(n_tiles)).cast("bigint")
    big = r * (q + 1)
    return F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1) \
        .otherwise(r + F.floor((rn - 1 - big) / F.greatest(q, F.lit(1))) + 1).cast("bigint")


def _by_position(df, by, metric, specs, ascending, ties, total_col):
    """Every rank from row positions: no group, value or run of equal rows meets in one task."""
    methods = {s[1] for s in specs}
    keys = [F.col(k).asc_nulls_first() for k in by]
    x = positions(df, [*keys, *_order(metric, ascending, ties)], "__pos")

    if by:
        group = x.groupBy(*by).agg(F.min("__pos").alias("__start"), F.count(F.lit(1)).alias("__tot"))
        x = null_safe_join(x, group, by, "inner")
    else:
        x = x.withColumns({"__start": F.lit(0), "__tot": x.agg(F.count(F.lit(1))).scalar()})
    if methods & {"rank", "dense_rank", "percent_rank"}:
        v = x.groupBy(*by, metric).agg(F.min("__pos").alias("__first"))
        if "dense_rank" in methods:
            v = positions(v, [*keys, *_order(metric, ascending, [])], "__vpos")
            v = null_safe_join(v, v.groupBy(*by).agg(F.min("__vpos").alias("__vlow")), by, "inner") if by else v.withColumn("__vlow", F.lit(0))
            v = v.withColumn("__dense", F.col("__vpos") - F.col("__vlow") + 1).drop("__vpos", "__vlow")
        x = null_safe_join(x, v, [*by, metric], "inner")
    rn, tot = F.col("__pos") - F.col("__start") + 1, F.col("__tot")
    for out, method, n_tiles in specs:
        if method == "row_number":
            val = rn.cast("bigint")
        elif method == "ntile":
            val = _ntile(rn, tot, n_tiles)
        elif method == "dense_rank":
            val = F.col("__dense").cast("bigint")
        else:
            val = (F.col("__first") - F.col("__start") + 1).cast("bigint")
            if method == "percent_rank":
                val = F.when(tot > 1, (val - 1).cast("double") / (tot - 1).cast("double")).otherwise(F.lit(0.0))
        x = x.withColumn(out, val)
    if total_col:
        x = x.withColumn(total_col, tot.cast("bigint"))
    return x.drop("__pos", "__start", "__tot", "__first", "__dense")


def _has_number(df: DataFrame, c: str) -> bool:
    """Whether ``_number`` applies; other types (text) are ranked by position."""
    return isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _number(df: DataFrame, c: str) -> Column:
    """An orderable column as a double that keeps its order (equal values stay equal)."""
    dt = df.schema[c].dataType
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    return F.col(c).cast("double")


def _bounds(num: str, buckets: int) -> Column:
    """The ``buckets - 1`` inner quantiles of a double column, approximately."""
    probs = ", ".join(f"{i / buckets!r}D" for i in range(1, buckets))
    # rank error of the bounds ~ rows / accuracy: keep it well under a bucket
    return F.expr(f"percentile_approx({num}, array({probs}), {max(QUANTILE_ACCURACY, 4 * buckets)})")


def _bucket(num: str, group: str, bounds: dict[int, list[float]], buckets: int, ascending: bool) -> Column:
    """The row's bucket: how many of its group's sorted bounds lie on the better side of the value.

    NULL values go to the last bucket, ``buckets``; rows of a group without
    bounds (group NULL, or all values NULL) that have a value go to bucket 0.
    One vectorised binary search per Arrow batch and group; for one group and
    ``FEW_BUCKETS`` at most, plain comparisons."""
    held = {g: np.sort(np.array(b, dtype=np.float64)) for g, b in bounds.items() if b is not None}
    last = buckets - 1
    if len(bounds) <= 1 and buckets <= FEW_BUCKETS:
        # one group and few bounds: that many comparisons in generated code
        v, first = F.col(num), F.lit(0)
        for b in next(iter(held.values()), np.zeros(0)).tolist():
            first = first + F.when(F.lit(b) < v, 1).otherwise(0)
        return F.when(v.isNull(), buckets).otherwise(first if ascending else F.lit(last) - first).cast("int")

    @F.arrow_udf("int")
    def find(v: pa.Array, g: pa.Array) -> pa.Array:
        value = v.to_numpy(zero_copy_only=False)
        missing = np.asarray(v.is_null())
        own = np.asarray(g.fill_null(-1))
        out = np.zeros(len(value), dtype=np.int32)
        for k in np.unique(own).tolist():
            if k in held:
                rows = own == k
                first = np.searchsorted(held[k], value[rows], side="left")
                out[rows] = first if ascending else last - first
        out[missing] = buckets
        return pa.array(out)

    return find(F.col(num), F.col(group))


def _split(df, by, metric, specs, ascending, ties, buckets, total_col, hot):
    """Rank with value buckets. ``hot`` = the groups to split (None: all);
    the other groups keep a single bucket 0 and offset 0."""
    m = F.col(metric)
    methods = {s[1] for s in specs}
    if hot is not None or by:
        keys = materialize(df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")) if hot is None else hot, "split-groups")
        groups = materialize(keys.select(*by, F.monotonically_increasing_id().alias("__g")), "split-groups")
        x = null_safe_join(df, broadcast_if_small(groups, written=True), by, "left")
    else:
        x = df.withColumn("__g", F.lit(0).cast("long"))
    x = x.withColumn("__num", _number(df, metric))
    # at most BOUNDS_BUDGET numbers in all; a group whose metric is NULL throughout has no bounds, but is split all the same
    found = x.filter(F.col("__g").isNotNull()).groupBy("__g").agg(_bounds("__num", buckets).alias("b")).collect()
    bounds = {r["__g"]: r["b"] for r in found}
    x = x.withColumn("__s", F.col("__g").isNotNull())
    x = x.withColumn("__b", F.when(F.col("__s"), _bucket("__num", "__g", bounds, buckets, ascending)).otherwise(F.lit(0)))
    x = x.drop("__g", "__num")

    aggs = [F.count(F.lit(1)).alias("__n"), F.min(m).alias("__mn"), F.max(m).alias("__mx")]
    if "dense_rank" in methods:
        aggs.append(F.count_distinct(m).alias("__dn"))
    counts = x.filter("__s").groupBy(*by, "__b").agg(*aggs)
    before = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    counts = counts.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    counts = counts.withColumn("__tot", F.sum("__n").over(whole))
    if "dense_rank" in methods:
        dn = F.when(F.col("__b") == buckets, F.lit(1)).otherwise(F.col("__dn"))
        counts = counts.withColumn("__dn", dn)
        counts = counts.withColumn("__doff", F.coalesce(F.sum("__dn").over(before), F.lit(0)))
    # a bucket holding one value (or the NULLs) ties throughout: rank = offset + 1
    counts = counts.withColumn("__one", (F.col("__b") == buckets) | (F.col("__mn") == F.col("__mx")))
    counts = counts.drop("__n", "__dn", "__mn", "__mx")
    # split groups x (buckets + 1) rows, written once and broadcast under the size check
    x = null_safe_join(x, broadcast_if_small(counts, "bucket-counts"), by + ["__b"], "left")

    one = F.coalesce(F.col("__one"), F.lit(False))
    part = by + ["__b"]
    if not methods & {"row_number", "ntile"}:
        # such a bucket needs no order, so it is spread by row position: one hot
        # value (say a third of the rows NULL, or equal rows) never lands in one task
        x = x.withColumn("__sub", F.pmod(F.monotonically_increasing_id(), F.lit(buckets)))
        x = x.withColumn("__sub", F.when(one, F.col("__sub")).otherwise(F.lit(0)))
        part = part + ["__sub"]
    w = Window.partitionBy(*part).orderBy(*_order(metric, ascending, []))
    wt = Window.partitionBy(*part).orderBy(*_order(metric, ascending, ties))
    off = F.coalesce(F.col("__off"), F.lit(0))
    need_tot = total_col or methods & {"percent_rank", "ntile"}
    if need_tot:
        # a group that was not split is exactly its one (group, 0) partition
        x = x.withColumn("__tot", F.coalesce(F.col("__tot"), F.count(F.lit(1)).over(Window.partitionBy(*part))))
    tot = F.col("__tot")
    for out, method, n_tiles in specs:
        if method == "rank":
            val = (off + F.when(one, F.lit(1)).otherwise(F.rank().over(w))).cast("bigint")
        elif method == "dense_rank":
            val = (F.coalesce(F.col("__doff"), F.lit(0))
                   + F.when(one, F.lit(1)).otherwise(F.dense_rank().over(w))).cast("bigint")
        elif method == "row_number":
            val = (off + F.row_number().over(wt)).cast("bigint")
        elif method == "percent_rank":
            r = off + F.when(one, F.lit(1)).otherwise(F.rank().over(w))
            val = F.when(tot > 1, (r - 1).cast("double") / (tot - 1).cast("double")).otherwise(F.lit(0.0))
        else:
            val = _ntile(off + F.row_number().over(wt), tot, n_tiles)
        x = x.withColumn(out, val)
    if total_col:
        x = x.withColumn(total_col, tot.cast("bigint"))
    return x.drop("__b", "__s", "__off", "__doff", "__tot", "__one", "__sub")


def global_rank(df: DataFrame, metric: str, method: str = "rank", ascending: bool = False,
                ties: Sequence[str] = (), out: str = "rank",
                buckets=DEFAULT_BUCKETS) -> DataFrame:
    """Q7: rank over the whole table without a one-partition window."""
    return rank_within(df, [], metric, method, ascending, ties, out, buckets)


def top_k_per_group(df: DataFrame, by: Sequence[str], metric: str, k: int,
                    ties: Sequence[str], out: str = "rk", ascending: bool = False) -> DataFrame:
    """First ``k`` rows per group (``row_number <= k``). Spark plans this as
    a partial ``WindowGroupLimit`` before the shuffle, so a hot group ships
    at most k rows per map task."""
    w = Window.partitionBy(*by).orderBy(*_order(metric, ascending, ties))
    return df.withColumn(out, F.row_number().over(w).cast("bigint")).filter(F.col(out) <= k)


def top_k(df: DataFrame, metric: str, k: int, ties: Sequence[str], out: str = "rk",
          ascending: bool = False) -> DataFrame:
    """First ``k`` rows of the whole table (``TakeOrderedAndProject``), numbered 1..k."""
    head = df.orderBy(*_order(metric, ascending, ties)).limit(k)
    # at most k rows remain, so one small window is bounded by k
    w = Window.orderBy(*_order(metric, ascending, ties))
    return head.withColumn(out, F.row_number().over(w).cast("bigint"))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    by: Sequence[str] = (), names: Sequence[str] | None = None,
                    buckets=DEFAULT_BUCKETS) -> DataFrame:
    """Exact quantiles (linear interpolation, as ``percentile`` /
    ``quantile_cont``) per group: ``by..., n, <names>...`` as doubles.

    No value map per group and no full sort: values are put in buckets by
    approximate bounds, bucket counts give each bucket's first position, and
    only the buckets that hold a wanted position are sorted (a bucket with a
    single value needs no sort at all). With ``'auto'`` this path is taken
    once a group outgrows one task; smaller groups, and ``buckets=None``,
    rank their rows with one window per group."""
    by = list(by)
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    base = df.select(*by, F.col(value).cast("double").alias("__v")).filter(
        F.col("__v").isNotNull() & ~F.isnan("__v"))
    if buckets is None:
        return _quantiles_from_ranks(base, by, probs, names)
    if buckets == AUTO:
        sizes = base.groupBy(*by).agg(F.count(F.lit(1)).alias("n")) if by else base.agg(F.count(F.lit(1)).alias("n"))
        top, n_groups = sizes.agg(F.max("n"), F.count(F.lit(1))).first()
        if not top or top <= MAX_GROUP_ROWS:
            # every group fits one task: one sort per group is cheapest
            return _quantiles_from_ranks(base, by, probs, names)
        buckets = max(MIN_BUCKETS, math.ceil(top / BUCKET_ROWS))
        if buckets > MAX_BUCKETS or buckets * n_groups > BOUNDS_BUDGET:
            return _quantiles_from_ranks(base, by, probs, names,
                                         _by_position(base, by, "__v", [("__r", "rank", None)], True, [], "__t"))
    elif buckets > MAX_BUCKETS or (by and base.select(*by).distinct().count() * buckets > BOUNDS_BUDGET):
        return _quantiles_from_ranks(base, by, probs, names, _by_position(base, by, "__v", [("__r", "rank", None)], True, [], "__t"))
    return _quantiles_targeted(base, by, probs, names, int(buckets))


def _quantiles_from_ranks(base, by, probs, names, ranked=None):
    if ranked is None:
        ranked = rank_within(base, by, "__v", "rank", ascending=True, out="__r", buckets=None, total_col="__t")
    aggs = [F.max("__t").alias("n")]
    pos0 = F.col("__r") - 1  # 0-based first position of the row's value
    for p, name in zip(probs, names):
        h = (F.col("__t") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        aggs.append(F.max(F.when(pos0 <= lo, F.col("__v"))).alias(f"__lo_{name}"))
        aggs.append(F.max(F.when(pos0 <= hi, F.col("__v"))).alias(f"__hi_{name}"))
        aggs.append(F.max(h - lo).alias(f"__f_{name}"))
    g = ranked.groupBy(*by).agg(*aggs) if by else ranked.agg(*aggs)
    cols = [F.col(c) for c in by] + [F.col("n").cast("bigint").alias("n")]
    for name in names:
        lo_v, hi_v, frac = F.col(f"__lo_{name}"), F.col(f"__hi_{name}"), F.col(f"__f_{name}")
        cols.append((lo_v + (hi_v - lo_v) * frac).alias(name))
    return g.select(*cols)


def _quantiles_targeted(base, by, probs, names, buckets):
    v = F.col("__v")
    if by:
        groups = materialize(base.select(*by).distinct().withColumn("__g", F.monotonically_increasing_id()), "quantile-groups")
        x = null_safe_join(base, broadcast_if_small(groups, written=True), by, "inner")
    else:
        x = base.withColumn("__g", F.lit(0).cast("long"))
    bounds = {r["__g"]: r["b"] for r in x.groupBy("__g").agg(_bounds("__v", buckets).alias("b")).collect()}  # at most BOUNDS_BUDGET numbers
    x = x.withColumn("__b", _bucket("__v", "__g", bounds, buckets, True)).drop("__g")

    # per bucket: rows, value range, first position (groups x buckets rows, kept once)
    counts = x.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__c"), F.min(v).alias("__mn"),
                                       F.max(v).alias("__mx"))
    before = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialize(counts.withColumn("__off", F.coalesce(F.sum("__c").over(before), F.lit(0)))
                         .withColumn("__n", F.sum("__c").over(Window.partitionBy(*by))), "bucket-counts")

    # wanted positions: floor and ceil of (n - 1) * p, kept by the bucket that holds them
    items = []
    for i, p in enumerate(probs):
        h = (F.col("__n") - 1).cast("double") * F.lit(float(p))
        for which, pos in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            items.append(F.struct(F.lit(i).alias("q"), F.lit(which).alias("w"),
                                  pos.cast("bigint").alias("pos"), (h - F.floor(h)).alias("frac")))
    t = counts.select(*by, "__b", "__off", "__c", "__mn", "__mx", "__n",
                      F.explode(F.array(*items)).alias("__t")).select(
        *by, "__b", "__off", "__c", "__mn", "__mx", "__n", "__t.*")
    t = t.filter((F.col("pos") >= F.col("__off")) & (F.col("pos") < F.col("__off") + F.col("__c")))
    direct = t.filter(F.col("__mn") == F.col("__mx")).select(
        *by, "q", "w", "frac", "__n", F.col("__mn").alias("val"))
    need = t.filter(F.col("__mn") != F.col("__mx")).select(
        *by, "__b", "q", "w", "frac", "__n", (F.col("pos") - F.col("__off")).alias("__lpos"))

    # sort only the buckets that hold a wanted position (at most 2 per quantile and group)
    need = broadcast_if_small(need, "wanted-buckets")
    nbj = broadcast_if_small(need.select(*by, "__b").distinct(), "wanted-buckets")
    sel = x.join(nbj, [x[k].eqNullSafe(nbj[k]) for k in by + ["__b"]], "left_semi")
    ranked = sel.withColumn("__p0", F.rank().over(Window.partitionBy(*by, "__b").orderBy(v.asc())) - 1)
    j = null_safe_join(ranked, need, by + ["__b"], "inner")
    vals = j.filter(F.col("__p0") <= F.col("__lpos")).groupBy(*by, "q", "w").agg(
        F.max(v).alias("val"), F.first("frac").alias("frac"), F.first("__n").alias("__n"))

    allv = direct.unionByName(vals)
    aggs = [F.max("__n").cast("bigint").alias("n")]
    for i, name in enumerate(names):
        q = F.col("q") == i
        aggs += [F.max(F.when(q & (F.col("w") == "lo"), F.col("val"))).alias(f"__lo_{name}"),
                 F.max(F.when(q & (F.col("w") == "hi"), F.col("val"))).alias(f"__hi_{name}"),
                 F.max(F.when(q, F.col("frac"))).alias(f"__f_{name}")]
    g = allv.groupBy(*by).agg(*aggs) if by else allv.agg(*aggs)
    cols = [F.col(c) for c in by] + ["n"]
    for name in names:
        lo_v, hi_v, frac = F.col(f"__lo_{name}"), F.col(f"__hi_{name}"), F.col(f"__f_{name}")
        cols.append((lo_v + (hi_v - lo_v) * frac).alias(name))
    return g.select(*cols)
