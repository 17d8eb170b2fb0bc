"""Entity summaries, profiles and feature builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.columns import null_safe_join, ratio, sanitize_name, unpivot_long
from rankforge.functions.joins import join_back
from rankforge.operators.cleaning import histogram
from rankforge.operators.encoding import frequency_index, one_hot, with_index
from rankforge.operators.ranking import DEFAULT_BUCKETS, rank_within
from rankforge.session import materialize

DEFAULT_MAX_FIELDS = 200


def entity_summary(df: DataFrame, entity: str = "entity", field: str = "field",
                   docs: str = "docs", metric: str = "citations", rank: str = "rank") -> DataFrame:
    """one row per entity over its fields (sample sd of ranks)."""
    g = df.groupBy(entity).agg(
        F.count_distinct(field).cast("bigint").alias("n_fields"),
        F.sum(docs).alias("__d"), F.sum(metric).alias("__c"),
        F.min(rank).cast("bigint").alias("best_rank"),
        F.avg(rank).alias("mean_rank"),
        F.stddev_samp(rank).alias("sd_rank"))
    return g.select(entity, "n_fields", F.col("__d").cast("bigint").alias(docs),
                    F.col("__c").cast("double").alias(metric), ratio("__c", "__d").alias("cpp"),
                    "best_rank", "mean_rank", "sd_rank")


def field_profile(df: DataFrame, entity_id=None, entity: str = "entity", field: str = "field",
                  metric: str = "citations", buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """per (entity, field): share of the entity's total, percent rank in
    the field (0 = best) and the gap to the field mean. Totals and means are
    aggregates joined back (one row per entity / per field), not windows. NULL
    is an entity and a field like any other; no row is lost."""
    ent = df.groupBy(entity).agg(F.sum(metric).alias("__et"))
    fld = df.groupBy(field).agg(F.sum(metric).alias("__fs"), F.count(F.lit(1)).alias("__fn"))
    r = rank_within(df.select(entity, field, metric), [field], metric, "percent_rank",
                    out="pct_rank", buckets=buckets)
    if entity_id is not None:
        r = r.filter(F.col(entity) == F.lit(entity_id))
    j = join_back(join_back(r, ent, [entity]), fld, [field])
    return j.select(entity, field,
                    ratio(F.col(metric).cast("double"), F.col("__et").cast("double")).alias("share_of_entity"),
                    "pct_rank",
                    (F.col(metric).cast("double") - F.col("__fs").cast("double") / F.col("__fn").cast("double"))
                    .alias("gap_to_mean"))


def entity_strengths(df: DataFrame, entity_id=None, k: int = 3, entity: str = "entity",
                     field: str = "field", metric: str = "citations", rank: str = "rank") -> DataFrame:
    """the k best and k worst fields of an entity (or of every entity
    when ``entity_id`` is None) by rank; ties: larger share first for best,
    smaller for worst, then field. The shares come from totals joined back, and
    the windows keep k rows of an entity per task before the shuffle, so an
    entity with very many rows isn't gathered."""
    e = df
    if entity_id is not None:
        e = e.filter(F.col(entity) == F.lit(entity_id))
    e = e.select(entity, field, rank, metric)
    per = Window.partitionBy(entity)
    e = join_back(e, e.groupBy(entity).agg(F.sum(metric).alias("__total")), [entity])
    e = e.withColumn("share", ratio(F.col(metric).cast("double"), F.col("__total").cast("double")))
    wb = per.orderBy(F.col(rank).asc(), F.col("share").desc(), F.col(field).asc())
    ww = per.orderBy(F.col(rank).desc(), F.col("share").asc(), F.col(field).asc())
    best = e.withColumn("__i", F.row_number().over(wb)).filter(F.col("__i") <= k) \
        .withColumn("kind", F.lit("best"))
    worst = e.withColumn("__i", F.row_number().over(ww)).filter(F.col("__i") <= k) \
        .withColumn("kind", F.lit("worst"))
    cols = ([entity] if entity_id is None else []) + ["kind", field, F.col(rank).cast("bigint").alias(rank), "share"]
    return best.select(*cols).unionByName(worst.select(*cols))


def log_features(df: DataFrame, cols: Sequence[str], prefix: str = "log1p_") -> DataFrame:
    """``log1p(col)`` for skewed columns; NULL for values <= -1."""
    return df.select("*", *[F.when(F.col(c) > -1, F.log1p(F.col(c).cast("double"))).alias(prefix + c)
                            for c in cols])


def ratio_features(df: DataFrame, specs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``name = num / den`` as double; NULL when den is 0 or NULL."""
    return df.select("*", *[ratio(n, d).alias(name) for n, d, name in specs])


def category_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column, value, n, share`` over several columns in one job.
    NULL is its own value with a NULL share; share = n / non-null rows."""
    long = unpivot_long(df, [], cols, "column", "value", cast="string")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    nonnull = long.groupBy("column").agg(F.count("value").alias("__nn"))  # one row per column
    j = counts.join(nonnull, "column")
    return j.select("column", "value", "n",
                    F.when(F.col("value").isNotNull(), ratio("n", "__nn")).alias("share"))


def numeric_distributions(df: DataFrame, cols: Sequence[str], bins: int) -> DataFrame:
    """F8: equal-width histograms of many numeric columns in long form:
    ``column, bin, lo, hi, n`` (one scan for bounds, one for counts)."""
    long = unpivot_long(df, [], cols, "column", "value", cast="double")
    return histogram(long, "value", bins, by=["column"])


def encode_categories(train: DataFrame, df: DataFrame, cols: Sequence[str], method: str = "target",
                      target: str | None = None, smoothing: float = 10.0) -> DataFrame:
    """category encodings fitted on ``train`` only, applied to ``df``.

    ``'target'``: smoothed target mean ``(sum_y + s*mu) / (n + s)`` per value,
    ``mu`` = train mean; unseen or NULL values get ``mu``. ``'index'`` numbers
    the values from 0 up, most frequent first, ties by value (unseen and NULL:
    the number after the last); ``'onehot'`` adds a sparse vector with a slot
    for each number. The dictionary is a table, joined back. Vectors learned
    from a table of values: ``encoding.learned_vectors``."""
    cols = list(cols)
    if method == "target":
        if target is None:
            raise ValueError("target encoding needs a target column")
        mu = train.agg(F.avg(F.col(target).cast("double"))).scalar()
        out = df
        for c in cols:
            st = train.filter(F.col(c).isNotNull()).groupBy(c).agg(
                F.sum(F.col(target).cast("double")).alias("__sy"), F.count(F.lit(1)).alias("__n"))
            enc = st.select(c, ((F.col("__sy") + F.lit(smoothing) * mu) /
                                (F.col("__n").cast("double") + F.lit(smoothing))).alias(f"{c}_te"))
            out = join_back(out, enc, [c], "left").withColumn(f"{c}_te", F.coalesce(F.col(f"{c}_te"), mu))
        return out
    if method not in ("index", "onehot"):
        raise ValueError(f"unknown encoding {method!r}")
    out = df
    for c in cols:
        dictionary = materialize(frequency_index(train, c), "dictionary")
        size = dictionary.count()
        out = with_index(out, dictionary, size, c, f"{c}_idx")
        if method == "onehot":
            out = one_hot(out, f"{c}_idx", f"{c}_vec", size)
    return out


def field_values(df: DataFrame, field: str, max_fields: int = DEFAULT_MAX_FIELDS) -> list:
    """The distinct non-null values of a field, refused above ``max_fields``
    (at most max_fields + 1 values ever reach the driver)."""
    vals = [r[0] for r in df.select(field).filter(F.col(field).isNotNull()).distinct()
            .limit(max_fields + 1).collect()]
    if len(vals) > max_fields:
        raise ValueError(f"more than {max_fields} values in {field}; pass an explicit list")
    return sorted(vals)


def profile_matrix(df: DataFrame, entity: str = "entity", field: str = "field",
                   value: str = "citations", fields: Sequence | None = None,
                   max_fields: int = DEFAULT_MAX_FIELDS, strict: bool = True, null_field: str | None = None) -> DataFrame:
    """one row per entity, one column ``f_<field>`` per field with the
    summed value (0 when absent). The pivot always gets an explicit value
    list, so Spark plans one aggregate and the width is bounded. With an
    explicit list and ``strict``, a field value outside it raises (one
    bounded check job) instead of being dropped silently. Values without a
    field go to the column ``null_field`` if one is named; else they raise
    when ``strict``."""
    if null_field is None and strict and df.filter(F.col(field).isNull() & F.col(value).isNotNull()).limit(1).count():
        raise ValueError(f"{value} without a {field}: name a null_field for it")
    if fields is not None and strict:
        extra = df.select(field).filter(F.col(field).isNotNull() & ~F.col(field).isin(*list(fields))).limit(1)
        found = extra.collect()
        if found:
            raise ValueError(f"field value {found[0][0]!r} is not in the given field list")
    fields = list(fields) if fields is not None else field_values(df, field, max_fields)
    if len(fields) > max_fields:
        raise ValueError(f"{len(fields)} fields exceed max_fields={max_fields}")
    names = [f"f_{sanitize_name(v)}" for v in fields]
    if len({*names, null_field}) != len(names) + 1:
        raise ValueError("field values collide after sanitising")
    p = df.groupBy(entity).pivot(field, fields).agg(F.sum(value))
    out = p.select(entity, *[F.coalesce(F.col(f"`{v}`").cast("double"), F.lit(0.0)).alias(n)
                             for v, n in zip(fields, names)])
    if null_field is None:
        return out
    rest = df.groupBy(entity).agg(F.coalesce(F.sum(F.when(F.col(field).isNull(), F.col(value))).cast("double"), F.lit(0.0)).alias(null_field))
    return null_safe_join(out, rest, [entity])
