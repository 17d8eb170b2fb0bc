"""Mixing sources to target weights by capped water-filling (columns and SQL functions only).

Sizes are words. ``share`` of the whole size is dealt to the sources by
weight; a source whose part exceeds ``max_epochs`` times its size is clamped
there and the excess is dealt again to the others by weight, until none is
above. A source's documents are then all repeated ``floor(target / size)``
times, and the rest of the target is filled with a seeded sample: documents
in the order of a hash of their id, up to the target.

Nothing sorts a whole source. Sizes are summed per (source, hash bucket), the
bucket holding the cut is found on those sums, and only its rows (1 / 4096 of
a source) are summed per hash value. What reaches the document rows is one
small row per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.common import materialize, number_rows, small_side, temp_name, word_count

#: The sample order is a 60-bit hash; its leading 12 bits are the bucket.
BUCKET_SHIFT = 48
SEED = "17"


def sample_hash(doc_id: str, text: str, seed: str = SEED) -> Column:
    """60 bits of the MD5 of seed and id (a NULL id: of the text's MD5)."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("#"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), key)), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, source: str, weights: Sequence[float], share: float, max_epochs: float) -> DataFrame:
    """(source, source_size) -> plus target: capped water-filling over the sources.

    Sources by code point, NULL last, weigh ``weights`` in turn. A round sends
    one row of sums to the driver; each round but the last clamps a source."""
    place = temp_name("i")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col(place) % len(weights) + 1).cast("int"))
    t = number_rows(sizes, [F.col(source).asc_nulls_last()], place)
    t = materialize(t.select(source, "source_size", w.alias("w"), (F.col("source_size") * F.lit(float(max_epochs))).alias("cap")), "sources")
    total = (t.agg(F.sum("source_size")).first()[0] or 0) * float(share)
    level, clamped = None, F.lit(False)
    while True:
        r = t.select("w", "cap", clamped.alias("c")).agg(
            F.sum(F.when(F.col("c"), F.col("cap"))), F.sum(F.when(~F.col("c"), F.col("w"))), F.count(F.when(F.col("c"), 1))).first()
        if not r[1]:  # every source stands at its cap
            return t.select(source, "source_size", F.col("cap").alias("target"))
        now = (total - (r[0] or 0.0)) / r[1]
        if level is not None and now == level:
            return t.select(source, "source_size", F.when(clamped, F.col("cap")).otherwise(F.col("w") * F.lit(level)).alias("target"))
        level = now
        clamped = F.col("w") * F.lit(level) > F.col("cap")


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: str = SEED) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, repeats, taken``.

    ``repeats`` is how often the mix takes the document, ``taken`` its words
    with repeats. A source's taken words miss its target by half a document
    at most, where all rows of an id count as one document: rows that repeat an
    id (or have none and the same text) share its sample hash and are taken
    alike, so a source of one id misses it by up to half the source.
    NULL text: size 0. NULL source: a source of its own, last. A source
    without words has target 0 and its documents are left out. Empty table:
    empty result. Other columns are not read."""
    base = materialize(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                                   word_count(F.col(text)).alias("size"), sample_hash(doc_id, text, seed).alias("h")), "sizes")
    plan = small_side(_plan(base, weights, share, max_epochs))
    reps = (F.col("p.whole") + F.when(F.col("d.h") <= F.col("p.cut"), 1).otherwise(0)).cast("long")
    return (base.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
            .select("d.doc_id", "d.size", "p.source_size", "p.target", reps.alias("repeats"), (F.col("d.size") * reps).alias("taken")))


def _plan(base: DataFrame, weights, share, max_epochs) -> DataFrame:
    """One row per source: source_size, target, whole repetitions, last hash of the sampled rest."""
    bucket = F.shiftright("h", BUCKET_SHIFT)
    buckets = materialize(base.groupBy("source", bucket.alias("b")).agg(F.sum("size").alias("n")), "buckets")
    t = source_targets(buckets.groupBy("source").agg(F.sum("n").alias("source_size")), "source", weights, share, max_epochs)
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long")
    t = materialize(t.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * size), "targets")
    before = F.sum("n").over(Window.partitionBy("source").orderBy("b")) - F.col("n")  # 4096 sums a source at most
    side = small_side(t.select(F.col("source").alias("s"), "rest"))
    edge = (buckets.withColumn("before", before).join(side, F.col("source").eqNullSafe(F.col("s")))
            .where("before < rest and rest <= before + n").select("s", "b", "before", "rest"))
    edge = small_side(materialize(edge, "edge"))
    rows = (base.join(edge, F.col("source").eqNullSafe(F.col("s")) & (bucket == F.col("b")))
            .groupBy("s", "before", "rest", "h").agg(F.sum("size").alias("n")))
    upto = F.sum("n").over(Window.partitionBy("s").orderBy("h"))  # the rows of one bucket
    cut = (rows.withColumn("mid", F.col("before") + upto - F.col("n") / 2)
           .groupBy("s").agg(F.coalesce(F.max(F.when(F.col("mid") <= F.col("rest"), F.col("h"))), F.min("h") - 1).alias("cut")))
    out = t.join(small_side(materialize(cut, "cut")), F.col("source").eqNullSafe(F.col("s")), "left")
    return materialize(out.select("source", "source_size", "target", "whole", F.coalesce("cut", F.lit(-1)).alias("cut")), "plan")


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED,
                    weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its ``repeats``, columns unchanged."""
    base = materialize(docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                                   sample_hash(doc_id, text, seed).alias("h")), "sizes")
    plan = small_side(_plan(base, weights, share, max_epochs))
    h, n, p = temp_name("h"), temp_name("n"), temp_name("p")
    side = plan.select(F.col("source").alias(p), F.col("whole").alias(n), F.col("cut").alias(f"{n}c"))
    reps = (F.col(n) + F.when(F.col(h) <= F.col(f"{n}c"), 1).otherwise(0)).cast("int")
    return (docs.withColumn(h, sample_hash(doc_id, text, seed)).join(side, F.col(source).eqNullSafe(F.col(p)))
            .withColumn(n, F.explode(F.array_repeat(F.lit(1), reps))).select(*docs.columns))
