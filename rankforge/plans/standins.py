"""Stand-in tables (the only code that names driver tables).

EF ("entity-field"): suppliers as entities, part types as fields,
lineitem rows as documents and extended price as citations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.functions.columns import ratio
from rankforge.operators.ranking import DEFAULT_BUCKETS, rank_within
from rankforge.session import materialize

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def entity_field(spark: SparkSession, sf_dir: str, with_rank: bool = True,
                 buckets=DEFAULT_BUCKETS) -> DataFrame:
    """EF: one row per (supplier, part type), ranked by citations in its type.

    lineitem joins part on the part key (AQE broadcasts part when it is
    small, else both sides shuffle on the key and a hot part key is split by
    the skew-join rule), then one aggregate per (supplier, type) that is
    combined map-side before its shuffle. Pre-aggregating lineitem per
    (supplier, part) first would not shrink the join input, since such pairs
    rarely repeat, and would add a full shuffle. The supplier-side
    dimensions are joined after the aggregate, on far fewer rows."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_partkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("px"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    by_type = (li.join(part, li.l_partkey == part.p_partkey)
               .groupBy("l_suppkey", "p_type")
               .agg(F.count(F.lit(1)).alias("docs"), F.sum("px").alias("citations")))
    geo = (table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
           .join(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"),
                 F.col("s_nationkey") == F.col("n_nationkey"))
           .join(table(spark, sf_dir, "region").select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    ef = by_type.join(geo, by_type.l_suppkey == geo.s_suppkey).select(
        F.col("s_suppkey").alias("entity"), F.col("s_nationkey").alias("country"),
        F.col("r_name").alias("region"), F.col("p_type").alias("field"),
        F.col("docs").cast("bigint").alias("docs"), F.col("citations"),
        ratio("citations", "docs").alias("cpp"))
    if not with_rank:
        return ef
    # the rank engine reads its input for the group sizes and again for the ranks: lineitem is joined once
    return rank_within(materialize(ef, "ef"), ["field"], "citations", "rank", out="rank", buckets=buckets)


def entity_field_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EF-wide (bench): customers as entities, part brands as fields."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("px"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
         .join(part, F.col("l_partkey") == part.p_partkey))
    g = j.groupBy("o_custkey", "p_brand").agg(F.count(F.lit(1)).alias("docs"),
                                              F.sum("px").alias("citations"))
    geo = cust.join(nation, cust.c_nationkey == nation.n_nationkey).join(
        region, F.col("n_regionkey") == region.r_regionkey)
    return g.join(geo, g.o_custkey == geo.c_custkey).select(
        F.col("o_custkey").alias("entity"), F.col("c_nationkey").alias("country"),
        F.col("r_name").alias("region"), F.col("p_brand").alias("field"),
        F.col("docs").cast("bigint").alias("docs"), "citations",
        ratio("citations", "docs").alias("cpp"))


def documents_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents LEFT JOIN labels: the source of missing values."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id", "left")
