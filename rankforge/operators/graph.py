"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.session import materialize


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return r[0], r[1]


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v: any ordered type) -> (node, root): the smallest node reachable.

    Every round hangs the larger neighbours of a node on its smallest one, then
    the smaller ones (alternating stars), so the rounds grow with the logarithm
    of the graph and no list of neighbours is built. Each round is written and
    read again. Loops and repeated links are harmless; nodes without a link to
    another are not returned."""
    e = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "links")
    before, now = None, _mark(e)
    while now != before and now[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, now = now, _mark(e)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
