"""Line dedup by site-relative frequency (columns and SQL functions only).

A line is boilerplate of a host if the pages of the host that hold it, divided
by the host's pages, exceed ``ratio``; such lines are dropped from the host's
pages. At least ``min_pages`` pages must hold it, so small hosts keep theirs.

Counts are per (host, line) and combine before the shuffle, so a line that
stands on every page of a hot host is one row per task. A host's boilerplate
lines number at most (lines a page) / ratio; they travel to its pages as one
array, and the text itself is never shuffled while those arrays stay within
the broadcast bound (past it, a join by host that AQE can split).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import WORD, materialize, small_side, temp_name

RATIO, MIN_PAGES = 0.08, 5


def line_key(line: Column) -> Column:
    """What stands for a line: its MD5."""
    return F.md5(line.cast("binary"))


def boilerplate_lines(docs: DataFrame, text: str, host: str, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line_md5, n_pages, host_pages): lines with a word on more than ``ratio`` of the host's pages."""
    d = docs.select(F.col(host).alias("host"), F.col(text).alias("text"))
    lines = F.array_distinct(F.transform(F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD)), line_key))
    seen = d.select("host", F.explode(lines).alias("line_md5")).groupBy("host", "line_md5").agg(F.count("*").alias("n_pages"))
    often = materialize(seen.where(F.col("n_pages") >= min_pages), "lines")
    hosts = materialize(d.groupBy("host").agg(F.count("*").alias("host_pages")), "hosts")
    side = small_side(hosts.withColumnRenamed("host", "h"))
    return (often.join(side, F.col("host").eqNullSafe(F.col("h")))
            .where(F.col("n_pages") > F.col("host_pages") * F.lit(ratio)).select("host", "line_md5", "n_pages", "host_pages"))


def drop_boilerplate(docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` without the boilerplate lines of their host, plus ``n_lines`` and ``n_dropped``.

    A page counts a line once, however often it repeats it; all its repeats
    are dropped. Lines without a word are kept. The page total of a host has
    all its rows, NULL texts too. NULL host: a host of its own. NULL text
    stays NULL (0 lines); a text that loses all its lines becomes empty.
    Repeated rows count each. Input columns named like an output are replaced."""
    bad = (boilerplate_lines(docs, text, host, ratio, min_pages)
           .groupBy("host").agg(F.collect_list("line_md5").alias("bad")))  # at most lines-a-page / ratio each
    bad = small_side(materialize(bad, "boilerplate"))
    h, b, ls, kept = (temp_name(x) for x in ("h", "bad", "lines", "kept"))
    side = bad.select(F.col("host").alias(h), F.col("bad").alias(b))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    found = docs.select(*names).join(side, F.col(host).eqNullSafe(F.col(h)), "left")
    split = F.split(text, "\n", -1)
    keep = F.filter(split, lambda x: ~F.array_contains(F.col(b), line_key(x)))
    found = found.withColumn(kept, F.when(F.col(b).isNull(), split).otherwise(keep))
    n = F.coalesce(F.size(split), F.lit(0)).cast("long")
    n = F.when(F.col(text).isNull(), F.lit(0).cast("long")).otherwise(n)
    left = F.when(F.col(text).isNull(), F.lit(0).cast("long")).otherwise(F.size(kept).cast("long"))
    out = found.select(*[F.when(F.col(b).isNull(), F.col(c)).otherwise(F.array_join(kept, "\n")).alias(c) if c == text else F.col(c)
                         for c in names], n.alias("n_lines"), (n - left).alias("n_dropped"))
    return out
