"""Missing values, single-table statistics and record cleaning.

Every statistic over many columns is one aggregate job whose one-row
result is unpivoted to long form; no per-column jobs are launched."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions.columns import equal_width_bin, is_integer_text, null_safe_join, safe_corr
from rankforge.functions.joins import broadcast_if_small, join_back
from rankforge.operators.dedup import first_per_key
from rankforge.operators.names import normalize_names
from rankforge.operators.ranking import exact_quantiles
from rankforge.session import materialize

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _missing(df: DataFrame, c: str, treat_blank: bool) -> Column:
    x = F.col(c)
    cond = x.isNull()
    if treat_blank:
        dt = df.schema[c].dataType
        if isinstance(dt, T.StringType):
            cond = cond | (F.trim(x) == "")
        elif isinstance(dt, (T.FloatType, T.DoubleType)):
            cond = cond | F.isnan(x)
    return cond


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None,
                    treat_blank: bool = False) -> DataFrame:
    """``column, n_rows, n_missing, pct_missing`` for each column."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.sum(F.when(_missing(df, c, treat_blank), 1).otherwise(0)).cast("bigint").alias(c)
             for c in cols]
    one = df.agg(*aggs)
    long = one.unpivot(["__rows"], cols, "column", "n_missing")
    n = F.col("__rows").cast("bigint")
    return long.select("column", n.alias("n_rows"), F.col("n_missing"),
                       F.when(n > 0, F.col("n_missing").cast("double") * F.lit(100.0) / n.cast("double"))
                       .alias("pct_missing"))


def _mode_by(df: DataFrame, c: str, by: list[str]) -> DataFrame:
    """Most frequent non-null value per group, ties to the smallest value.
    A count per (group, value) first, then one aggregate per group."""
    counts = df.filter(F.col(c).isNotNull()).groupBy(*by, c).agg(F.count(F.lit(1)).alias("__k"))
    best = F.min(F.struct((-F.col("__k")).alias("k"), F.col(c).alias("v")))
    g = counts.groupBy(*by).agg(best.alias("__m")) if by else counts.agg(best.alias("__m"))
    return g.select(*by, F.col("__m.v").alias(c))


def _fills(df: DataFrame, spec: dict, by: list[str]) -> dict:
    """Fill value of each column: one frame per column, one row per group
    (or one row when ``by`` is empty)."""
    out = {}
    means = [c for c, how in spec.items() if how == "mean"]
    if means:
        aggs = []
        for c in means:
            x = F.col(c).cast("double")
            x = F.when(~F.isnan(x), x)  # NaN is no value of a mean, as it is none of a median
            aggs += [F.avg(x).alias(c), F.sum(x).alias(f"__sum_{c}"), F.count(x).alias(f"__cnt_{c}")]
        g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
        out.update({c: g.select(*by, c, f"__sum_{c}", f"__cnt_{c}") for c in means})
    for c, how in spec.items():
        if how == "median":
            out[c] = exact_quantiles(df, c, [0.5], by, names=[c]).drop("n")
        elif how == "mode":
            out[c] = _mode_by(df, c, by)
        elif how != "mean" and not (isinstance(how, tuple) and how[0] == "constant"):
            raise ValueError(f"unknown fill strategy {how!r} for {c}")
    return out


def impute(df: DataFrame, spec: dict, by: Sequence[str] | None = None,
           flag: bool = True) -> DataFrame:
    """Fill NULLs per column with ``'mean'``, ``'median'``, ``'mode'`` or
    ``('constant', value)``, per group when ``by`` is given. A group without
    any value falls back to the global fill (a scalar subquery). Mean and
    median fills are double; ``<col>_was_missing`` flags filled rows.
    Group fills are one row per group and are joined back on the group. The
    columns that the fills need are written once; ``df`` itself is read once more."""
    by = list(by or [])
    out = df
    if flag:
        out = out.select("*", *[F.col(c).isNull().alias(f"{c}_was_missing") for c in spec])
    needed = dict.fromkeys([*by, *[c for c, how in spec.items() if not isinstance(how, tuple)]])
    narrow = materialize(df.select(*needed), "to-fill") if any(c not in by for c in needed) else df
    grp = _fills(narrow, spec, by) if by else {}
    # global means come from the per-group sums (no second scan of the data)
    derived = {c for c, how in spec.items() if how == "mean" and c in grp}
    glob = _fills(narrow, {c: h for c, h in spec.items() if c not in derived}, [])
    for c in derived:
        glob[c] = grp[c].agg((F.sum(f"__sum_{c}") / F.sum(f"__cnt_{c}")).alias(c))
    if grp:
        frames = [f.select(*by, F.col(c).alias(f"__g_{c}")) for c, f in grp.items()]
        g = frames[0]
        for f in frames[1:]:
            g = null_safe_join(g, f, by, "full")
        out = join_back(out, g, by, "left")
    for c, how in spec.items():
        target = df.schema[c].dataType
        if isinstance(how, tuple):
            val = F.coalesce(F.col(c), F.lit(how[1]).cast(target))
        else:
            cast = "double" if how in ("mean", "median") else target
            parts = [F.col(c).cast(cast)]
            if c in grp:
                parts.append(F.col(f"__g_{c}").cast(cast))
            parts.append(glob[c].select(F.col(c).cast(cast)).scalar())
            val = F.coalesce(*parts)
        out = out.withColumn(c, val)
    return out.drop(*[f"__g_{c}" for c in grp])


def numeric_summary(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """``column, n, mean, sd, min, q1, median, q3, max`` per column
    (sample sd; quartiles by linear interpolation). ``exact=False`` uses
    ``percentile_approx``. A column without any value has n = 0 and NULLs."""
    long = df.select([F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), "column", "value").filter(F.col("value").isNotNull() & ~F.isnan("value"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")  # one row per column
    base = long.groupBy("column").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    if exact:
        q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["column"], names=["q1", "median", "q3"])
    else:
        pa = F.percentile_approx("value", [0.25, 0.5, 0.75], 10000)
        q = long.groupBy("column").agg(F.count(F.lit(1)).alias("n"), pa.alias("__q")).select(
            "column", "n", F.col("__q")[0].alias("q1"), F.col("__q")[1].alias("median"),
            F.col("__q")[2].alias("q3"))
    res = names.join(base.join(q, "column"), "column", "left")
    return res.select("column", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"), "mean", "sd", "min",
                      "q1", "median", "q3", "max")


def histogram(df: DataFrame, col: str, bins: int, by: Sequence[str] | None = None,
              fill: bool = False) -> DataFrame:
    """C4: equal-width histogram ``[by...,] bin, lo, hi, n`` (0-based bins).
    Bounds are per group when ``by`` is given, else global (scalar
    subqueries, no join). NULL and NaN are left out."""
    by = list(by or [])
    v = F.col(col).cast("double")
    vals = df.select(*by, v.alias("__v")).filter(F.col("__v").isNotNull() & ~F.isnan("__v"))
    if by:
        bounds = vals.groupBy(*by).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
        vals = join_back(vals, bounds, by)
        lo, hi = F.col("__lo"), F.col("__hi")
    else:
        lo, hi = vals.agg(F.min("__v")).scalar(), vals.agg(F.max("__v")).scalar()
        vals = vals.withColumn("__lo", lo).withColumn("__hi", hi)
        lo, hi = F.col("__lo"), F.col("__hi")
    binned = vals.withColumn("bin", equal_width_bin("__v", lo, hi, bins))
    counts = binned.groupBy(*by, "bin").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                            F.first("__lo").alias("__lo"), F.first("__hi").alias("__hi"))
    if fill:
        # every (group, bin) pair: bins are generated per group, no join
        keys = counts.select(*by, "__lo", "__hi").distinct()
        full = keys.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))))
        counts = null_safe_join(full, counts.drop("__lo", "__hi"), by + ["bin"], "left") \
            .withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))
    w = (F.col("__hi") - F.col("__lo")) / F.lit(float(bins))
    return counts.select(*by, "bin", (F.col("__lo") + F.col("bin").cast("double") * w).alias("lo"),
                         (F.col("__lo") + (F.col("bin") + 1).cast("double") * w).alias("hi"), "n")


def boxplot_stats(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """``by..., q1, median, q3, lo_whisker, hi_whisker, n_outliers`` with
    fences at 1.5 x IQR; whiskers are the extreme values inside the fences."""
    by = list(by)
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], by, names=["q1", "median", "q3"]).drop("n")
    vals = df.select(*by, F.col(col).cast("double").alias("__v")).filter(
        F.col("__v").isNotNull() & ~F.isnan("__v"))
    j = join_back(vals, q, by)
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - F.lit(1.5) * iqr, F.col("q3") + F.lit(1.5) * iqr
    inside = (F.col("__v") >= lo_f) & (F.col("__v") <= hi_f)
    g = j.groupBy(*by).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("__v"))).alias("lo_whisker"),
        F.max(F.when(inside, F.col("__v"))).alias("hi_whisker"),
        F.sum(F.when(inside, 0).otherwise(1)).cast("bigint").alias("n_outliers"))
    return g


#: Pairs that one aggregate of ready-made functions settles.
PAIRS_PER_JOB = 60
#: Rows whose means shift the columns before they are multiplied; any shift gives the same r, up to rounding.
SHIFT_ROWS = 1000
#: Of n * sum(x^2) - sum(x)^2 relative to n * sum(x^2): below this a column may be constant over the pair's rows.
CLOSE = 1e-9


def _columns_matrix(b: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values with 0 where there is none, 1 where there is one) of an array column without NULL arrays."""
    flat = b.column(0).flatten()
    there = np.asarray(flat.is_valid()).reshape(-1, k)
    return np.where(there, flat.to_numpy(zero_copy_only=False).reshape(-1, k), 0.0), there.astype(np.float64)


def _gram(x: DataFrame, k: int, shift: np.ndarray) -> DataFrame:
    """(a, stats: array of k structs): n, sums, squares and products of column a with each column over their common rows.

    A task multiplies its rows with their masks block by block and sends k rows; rows of one column are then added up."""
    names = ["n", "sa", "sb", "saa", "sbb", "sab", "odd", "lo", "hi"]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((7, k, k))
        lo, hi = np.full(k, np.inf), np.full(k, -np.inf)
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                v, m = _columns_matrix(b.slice(at, 4096), k)
                odd = ~np.isfinite(v)
                if odd.any():  # r is NaN over rows that hold one
                    o = odd.astype(np.float64)
                    total[6] += o.T @ m + m.T @ o
                    v = np.where(odd, 0.0, v)
                there = m > 0
                lo = np.minimum(lo, np.where(there, v, np.inf).min(axis=0, initial=np.inf))
                hi = np.maximum(hi, np.where(there, v, -np.inf).max(axis=0, initial=-np.inf))
                v = (v - shift) * m
                q = v * v
                for i, (left, right) in enumerate(((m, m), (v, m), (m, v), (q, m), (m, q), (v, v))):
                    total[i] += left.T @ right
        rows = [np.arange(k), *[list(t) for t in total], lo, hi]
        yield pa.RecordBatch.from_arrays([pa.array(rows[0]), *[pa.array(r, pa.list_(pa.float64())) for r in rows[1:8]], pa.array(lo), pa.array(hi)],
                                         names=["a", *names])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            mats = [b.column(i).flatten().to_numpy().reshape(-1, k) for i in range(1, 8)]
            for r, (a, lo, hi) in enumerate(zip(*(b.column(i).to_pylist() for i in (0, 8, 9)))):
                own = held.setdefault(a, [np.zeros((7, k)), np.inf, -np.inf])
                for i in range(7):
                    own[0][i] += mats[i][r]
                own[1], own[2] = min(own[1], lo), max(own[2], hi)
        cols = [list(held), *[[o[0][i] for o in held.values()] for i in range(7)], [o[1] for o in held.values()], [o[2] for o in held.values()]]
        types = [pa.int64(), *[pa.list_(pa.float64())] * 7, pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["a", *names])

    schema = "a long, " + ", ".join(f"{n} array<double>" for n in names[:7]) + ", lo double, hi double"
    return x.mapInArrow(blocks, schema).repartition("a").mapInArrow(add, schema)


def _pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(col_a, col_b, r) of some pairs, by one aggregate."""
    aggs = [(F.when(F.stddev_samp(F.col(a).cast("double")) > 0, F.lit(1.0)) if a == b else safe_corr(a, b)).alias(f"p{i}") for i, (a, b) in enumerate(pairs)]
    long = df.agg(*aggs).unpivot([], [f"p{i}" for i in range(len(pairs))], "p", "r")
    i = F.substring("p", 2, 9).cast("int")
    return long.select(F.array(*[F.lit(a) for a, _ in pairs])[i].alias("col_a"), F.array(*[F.lit(b) for _, b in pairs])[i].alias("col_b"), "r")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for each pair ``a <= b`` (in the given order), long form.

    Every pair is taken over the rows where both values are present, however
    many columns there are; ``a = b`` gives 1 unless the column is constant
    (NULL). Up to ``PAIRS_PER_JOB`` pairs are one aggregate of ready-made
    functions. For more, one scan: each task multiplies blocks of its rows with their masks
    of present values, and the k rows of products are added by column. A pair
    with a column that can't be told from a constant one there (beside columns
    constant throughout, which are) is settled by an exact aggregate."""
    cols = list(cols)
    k = len(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    if len(pairs) <= PAIRS_PER_JOB:
        return _pairs(df, pairs)
    x = df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))
    mean = x.limit(SHIFT_ROWS).select(F.posexplode("x").alias("i", "v")).where(F.col("v").isNotNull() & (F.abs("v") < float("inf"))) \
        .groupBy("i").agg(F.avg("v").alias("m")).collect()  # one row per column
    shift = np.zeros(k)
    for r in mean:
        shift[r["i"]] = r["m"]
    gram = materialize(_gram(x, k, shift), "gram")
    every = F.arrays_zip(*[F.col(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab", "odd")])
    pair = gram.select("a", (F.col("lo") == F.col("hi")).alias("flat"), F.posexplode(every).alias("b", "s")).where("b >= a").select("a", "b", "flat", "s.*")
    flat = gram.select(F.col("a").alias("b"), (F.col("lo") == F.col("hi")).alias("flat_b"))  # one row per column
    pair = pair.join(broadcast_if_small(flat, "flat"), "b")
    va, vb = F.col("n") * F.col("saa") - F.col("sa") ** 2, F.col("n") * F.col("sbb") - F.col("sb") ** 2
    none = (F.col("n") < 2) | F.col("flat") | F.col("flat_b")
    close = ~none & (F.col("odd") == 0) & ((va <= CLOSE * F.col("n") * F.col("saa")) | (vb <= CLOSE * F.col("n") * F.col("sbb")))
    r = F.when(F.col("odd") > 0, F.lit(float("nan"))).when(none, None).when(F.col("a") == F.col("b"), 1.0) \
        .otherwise(F.try_divide(F.col("n") * F.col("sab") - F.col("sa") * F.col("sb"), F.sqrt(F.greatest(va, F.lit(0.0))) * F.sqrt(F.greatest(vb, F.lit(0.0)))))
    pair = materialize(pair.select("a", "b", close.alias("close"), r.alias("r")), "pairs")
    name = F.array(*[F.lit(c) for c in cols])
    out = pair.where("NOT close").select(name[F.col("a").cast("int")].alias("col_a"), name[F.col("b").cast("int")].alias("col_b"), "r")
    # columns constant over the rows of the pair, or nearly: few; the list is at most k * (k + 1) / 2 pairs of numbers
    left = [(cols[t["a"]], cols[t["b"]]) for t in pair.where("close").select("a", "b").collect()]
    for at in range(0, len(left), PAIRS_PER_JOB):
        out = out.unionByName(_pairs(df, left[at: at + PAIRS_PER_JOB]))
    return out


def clean_records(df: DataFrame, key: Sequence[str], casts: dict | None = None,
                  order: Sequence[tuple[str, bool]] = (), null_tokens: Sequence[str] = ("", "NULL", "N/A", "-"),
                  names: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """trim strings, turn null tokens into NULL, cast (integers only when
    the text is a plain integer; thousands commas removed), drop rows without
    a key or with a bad value, keep one row per key: the first by ``order``
    (``(column, ascending)`` pairs), then by all remaining columns.

    Returns ``(clean, dropped)``; ``dropped`` has a ``reason`` of
    ``null_key``, ``bad_value`` or ``repeat`` and the values as they came in,
    text and type; clean + dropped = input. A row that a rule of ``order``
    can't place (NULL there) comes after those it can.
    Keeping the first row is an aggregate (``min`` of a struct), so a hot
    key is combined map-side instead of being sorted in one task. What a value
    was before is carried only where it changed.

    ``names`` maps a text column to an edit distance (0, 1 or 2): the column
    gets ``<column>_canonical``, ``<column>_id`` and ``<column>_label`` of
    ``names.normalize_names`` in the clean rows."""
    key, casts = list(key), dict(casts or {})
    cols = df.columns
    x, before = df, {}
    for f in df.schema.fields:
        if f.name in casts:
            before[f.name] = F.col(f"__raw_{f.name}")
            x = x.withColumn(f"__raw_{f.name}", F.col(f.name))
        if isinstance(f.dataType, T.StringType):
            raw, t = F.col(f.name), F.trim(F.col(f.name))
            clean = F.when(t.isin(*null_tokens), F.lit(None)).otherwise(t)
            if f.name not in casts:
                before[f.name] = F.coalesce(f"__raw_{f.name}", f.name)
                x = x.withColumn(f"__raw_{f.name}", F.when(~raw.eqNullSafe(clean), raw))
            x = x.withColumn(f.name, clean)
    bad = F.lit(False)
    for c, target in casts.items():
        raw = F.regexp_replace(F.col(c).cast("string"), ",", "")
        if target in ("int", "bigint", "smallint", "tinyint"):
            val = F.when(is_integer_text(raw), raw.try_cast(target))
        else:
            val = raw.try_cast(target)
        bad = bad | (F.col(c).isNotNull() & val.isNull())
        x = x.withColumn(f"__c_{c}", val)
    null_key = F.lit(False)
    for k in key:
        kc = F.col(f"__c_{k}") if k in casts else F.col(k)
        null_key = null_key | kc.isNull()
    x = x.withColumn("__reason", F.when(null_key, "null_key").when(bad, "bad_value"))
    for c in casts:
        x = x.withColumn(c, F.col(f"__c_{c}")).drop(f"__c_{c}")
    rejected = x.filter(F.col("__reason").isNotNull()).withColumnRenamed("__reason", "reason")
    good = x.filter(F.col("__reason").isNull()).drop("__reason")

    clean, rest = first_per_key(good, key, order)
    as_given = [before[c].alias(c) if c in before else F.col(c) for c in cols]
    dropped = rejected.select(*as_given, "reason").unionByName(rest.select(*as_given, F.lit("repeat").alias("reason")))
    clean = clean.select(*cols)
    for c, distance in (names or {}).items():
        clean = normalize_names(clean, c, distance, out=c)
    return clean, dropped
