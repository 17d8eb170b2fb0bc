"""Ranking reports over an entity-field table (Q1-Q5)."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions.columns import ratio
from rankforge.operators.ranking import DEFAULT_BUCKETS, rank_within, top_k_per_group
from rankforge.session import materialize


def ranked(df: DataFrame, field: str = "field", metric: str = "citations", out: str = "rank",
           buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Rank every entity inside its field by ``metric`` (ties share a rank)."""
    return rank_within(df, [field], metric, "rank", out=out, buckets=buckets)


def entity_rankings(df: DataFrame, entity_id, entity: str = "entity", field: str = "field",
                    metric: str = "citations", docs: str = "docs",
                    buckets=DEFAULT_BUCKETS, max_rows: int = 100_000,
                    with_entity: bool = False) -> DataFrame:
    """Q1: one entity's rank in every field (``rank`` semantics: 1 + rows of
    the field with a larger metric; NULL metrics last).

    The entity's own rows (one per field) are few, so they are broadcast
    (after a row-count check) and every other row only adds to a count of
    better rows in its field: one scan and a partial aggregate, no sort of
    the table. If the entity has several rows in one field (each would meet
    every row of the field), or above ``max_rows`` own rows, all rows are
    ranked first and filtered after."""
    ent = [F.col("__e").alias(entity)] if with_entity else []
    own = df.filter(F.col(entity) == F.lit(entity_id)).select(
        F.col(entity).alias("__e"), F.col(field).alias("__f"), F.col(metric).alias("__m"),
        F.col(docs).alias("__d"))
    size = own.groupBy("__f").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    if (size[0] or 0) > max_rows or (size[1] or 0) > 1:
        r = ranked(df, field, metric, "rank", buckets).filter(F.col(entity) == F.lit(entity_id))
        return r.select(*([entity] if with_entity else []), field, "rank",
                        F.col(docs).cast("bigint").alias(docs),
                        F.col(metric).cast("double").alias(metric), ratio(metric, docs).alias("cpp"))
    # tell the entity's rows apart (ids only group the join output of this job)
    own = own.withColumn("__id", F.monotonically_increasing_id())
    o = F.broadcast(own)
    m = F.col(metric)
    better = F.when(F.col("__m").isNull(), m.isNotNull()).otherwise(m > F.col("__m"))
    counts = (df.select(field, metric).join(o, df[field].eqNullSafe(o["__f"]))
              .groupBy("__id", "__e", "__f", "__m", "__d")
              .agg(F.sum(F.when(better, 1).otherwise(0)).alias("__better")))
    return counts.select(*ent, F.col("__f").alias(field), (F.col("__better") + 1).cast("bigint").alias("rank"),
                         F.col("__d").cast("bigint").alias(docs), F.col("__m").cast("double").alias(metric),
                         ratio("__m", "__d").alias("cpp"))


def country_performance(df: DataFrame, country_id, cutoffs: Sequence[int] = (10,),
                        entity: str = "entity", country: str = "country", field: str = "field",
                        metric: str = "citations",
                        buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """Q2: one country's entities per field: count, best and mean rank, how
    many are in the top k for each cutoff, and their summed metric."""
    r = ranked(df, field, metric, "rank", buckets).filter(F.col(country) == F.lit(country_id))
    aggs = [F.count_distinct(entity).cast("bigint").alias("n_entities"),
            F.min("rank").cast("bigint").alias("best_rank"),
            F.avg("rank").alias("mean_rank")]
    aggs += [F.sum(F.when(F.col("rank") <= k, 1).otherwise(0)).cast("bigint").alias(f"n_top_{k}")
             for k in cutoffs]
    aggs.append(F.sum(metric).cast("double").alias(metric))
    return r.groupBy(field).agg(*aggs)


def global_overview(df: DataFrame, entity: str = "entity", country: str = "country",
                    field: str = "field", docs: str = "docs", metric: str = "citations",
                    approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """Q3: one row of global totals. ``approx=True`` uses HyperLogLog counts."""
    def distinct(c):
        return F.approx_count_distinct(c, rsd) if approx else F.count_distinct(c)
    g = df.agg(distinct(entity).alias("n_entities"), distinct(country).alias("n_countries"),
               distinct(field).alias("n_fields"), F.sum(docs).alias("__d"), F.sum(metric).alias("__c"))
    return g.select(F.col("n_entities").cast("bigint"), F.col("n_countries").cast("bigint"),
                    F.col("n_fields").cast("bigint"), F.col("__d").cast("bigint").alias(docs),
                    F.col("__c").cast("double").alias(metric), ratio("__c", "__d").alias("cpp"))


def multi_dim(df: DataFrame, dims: Sequence[str], mode="rollup", docs: str = "docs",
              metric: str = "citations", gid: str = "gid") -> DataFrame:
    """Q4: totals with subtotals. ``mode`` is ``'rollup'``, ``'cube'`` or a
    list of grouping sets (lists of dimension names). ``gid`` is
    ``grouping_id`` with the first dimension as the highest bit, which tells
    a subtotal NULL from a data NULL."""
    dims = list(dims)
    if mode == "rollup":
        g = df.rollup(*dims)
    elif mode == "cube":
        g = df.cube(*dims)
    else:
        sets = [[F.col(c) for c in s] for s in mode]
        g = df.groupingSets(sets, *dims)
    out = g.agg(F.grouping_id(*dims).cast("bigint").alias(gid),
                F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                F.sum(docs).cast("bigint").alias(docs),
                F.sum(metric).alias("__c"))
    return out.select(*dims, gid, "n_rows", docs, F.col("__c").cast("double").alias(metric))


def multi_dim_lattice(df: DataFrame, dims: Sequence[str], mode="cube", distinct: str | None = None, docs: str = "docs",
                      metric: str = "citations", gid: str = "gid") -> DataFrame:
    """Q4 from one pass over the rows: the finest grouping is computed once, and
    every other grouping set from the smallest set already computed that has
    its dimensions, so no row is multiplied.

    ``distinct`` names a whole-number column whose distinct non-NULL values are
    counted exactly per set, as ``n_<distinct>``: the values are kept as bitmaps
    per block of 32,768 numbers, which are united when a dimension is dropped.
    Other columns as ``multi_dim``; the totals row is there if a row is."""
    dims = list(dims)
    if mode == "rollup":
        sets = [dims[:i] for i in range(len(dims), -1, -1)]
    elif mode == "cube":
        sets = [list(s) for n in range(len(dims), -1, -1) for s in combinations(dims, n)]
    else:
        sets = [[c for c in dims if c in s] for s in sorted(mode, key=len, reverse=True)]
    block = ["__block"] if distinct else []
    x = df
    if distinct:
        if not isinstance(df.schema[distinct].dataType, T.IntegralType):
            raise ValueError(f"{distinct} must be a whole number: number its values first")
        v = F.col(distinct).cast("bigint")
        x = x.withColumns({"__block": F.bitmap_bucket_number(v), "__bit": F.bitmap_bit_position(v)})
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.sum(docs).alias("__d"), F.sum(metric).alias("__c")]
    finest = materialize(x.groupBy(*dims, *block).agg(*aggs, *([F.bitmap_construct_agg("__bit").alias("__bits")] if distinct else [])), "lattice")
    done = {tuple(dims): (finest.count(), finest)}
    out = None
    for s in sets:
        if tuple(s) not in done:
            _, parent = min((d for have, d in done.items() if set(s) <= set(have)), key=lambda d: d[0])
            sums = [F.sum(c).alias(c) for c in ("n_rows", "__d", "__c")] + ([F.bitmap_or_agg("__bits").alias("__bits")] if distinct else [])
            keys = [*s, *block] or [F.lit(0).alias("__all")]
            child = materialize(parent.groupBy(*keys).agg(*sums), "lattice")
            done[tuple(s)] = (child.count(), child)
        own = done[tuple(s)][1]
        total = [F.sum("n_rows").cast("bigint").alias("n_rows"), F.sum("__d").cast("bigint").alias(docs), F.sum("__c").cast("double").alias(metric)]
        if distinct:
            total.append(F.sum(F.bitmap_count("__bits")).cast("bigint").alias(f"n_{distinct}"))
        flat = own.groupBy(*([*s] or [F.lit(0).alias("__all")])).agg(*total)
        bits = sum(1 << (len(dims) - 1 - i) for i, c in enumerate(dims) if c not in s)
        flat = flat.select(*[F.col(c) if c in s else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in dims], F.lit(bits).cast("bigint").alias(gid),
                           "n_rows", docs, metric, *([f"n_{distinct}"] if distinct else []))
        out = flat if out is None else out.unionByName(flat)
    return out


def top_regions(df: DataFrame, k: int = 3, by: Sequence[str] = (), region: str = "region",
                metric: str = "citations") -> DataFrame:
    """Q5: regions by summed metric, the first k overall or per ``by`` group,
    ties by region name. Aggregation first, so the window sees one row per
    (group, region)."""
    by = list(by)
    g = df.groupBy(*by, region).agg(F.sum(metric).alias("__m"))
    g = g.select(*by, region, F.col("__m").cast("double").alias(metric))
    return top_k_per_group(g, by, metric, k, ties=[region], out="rk")
