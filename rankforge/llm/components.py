"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import materialize, release

#: Edges a task of a round writes, about: a small graph isn't dealt out over many files.
EDGES = 100_000


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: long) -> (node, root): root is the smallest node reachable.

    Alternating large-star and small-star: every round hangs each node's
    larger neighbours on its smallest one, so the rounds grow with the
    logarithm of the graph. The minimum per node combines before the shuffle
    and the joins on a hot node can be split; no neighbour list is built.
    Each round is written to the shared folder and replaces the one before.
    Loops and repeated edges are harmless; nodes without an edge are not
    returned."""
    e = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .where("u != v").distinct(), "edges")
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        small = materialize(small.coalesce(mark[0] // EDGES + 1), "edges")
        release(edges.sparkSession, e)
        now = _mark(small)
        e, mark, same = small, now, now == mark
        if same:
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
