"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.session import materialize, scratch_path

__all__ = ["free_memory", "join_spread", "materialize", "new_folder", "number_rows", "release", "scratch_path", "small_side", "temp_name", "word_count"]

#: Java / RE2 class of a word: anything but blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Sides up to this many rows and bytes are broadcast; larger ones go through a shuffle join.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20


def temp_name(stem: str) -> str:
    """A column name no input can hold."""
    return f"_{stem}_{uuid.uuid4().hex[:8]}"


def word_count(text: Column) -> Column:
    """Words of a text (NULL: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def small_side(df: DataFrame, row_bytes: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it is proven small.

    ``df`` should be materialised: its rows are counted up to the bound.
    ``row_bytes`` is the fixed width of a row; None measures the strings."""
    n = df.limit(BROADCAST_ROWS + 1).count()
    if n > BROADCAST_ROWS:
        return df
    if row_bytes is None:
        width = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
        total = df.agg(F.sum(width * 4 + 16 * len(df.columns))).first()[0] or 0
    else:
        total = n * row_bytes
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def join_spread(rows: DataFrame, side: DataFrame, key: str, weight: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``side`` (one row per ``key``), where a key may hold any share of ``rows``.

    ``weight`` is the column of ``side`` that says how many of ``rows`` have
    the key. Keys on over 1/1024 of the rows, so at most 1024 of them, are
    broadcast if their bytes are within the bound (else AQE splits them);
    all other rows meet in a shuffle by key. ``side`` should be materialised."""
    total, top = side.agg(F.sum(weight), F.max(weight)).first()
    often = F.col(weight) * 1024 > (total or 0)
    hot, mark = side.where(often), temp_name("hot")
    if not total or top * 1024 <= total or small_side(hot) is hot:
        return rows.join(side, key, how)
    met = rows.join(F.broadcast(hot.withColumn(mark, F.lit(True))), key, "left")
    done = met.where(mark).drop(mark)
    others = met.where(F.col(mark).isNull()).select(rows.columns).join(side.where(~often), key, how)
    return done.unionByName(others)


def number_rows(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """``df`` plus ``name``: its 0-based place in the order, without a one-task sort.

    Rows are range-partitioned and sorted, written once, and each partition's
    offset is the number of rows in the partitions before it."""
    mid, pid, off = temp_name("mid"), temp_name("pid"), temp_name("off")
    placed = materialize(df.orderBy(*order).withColumn(mid, F.monotonically_increasing_id()), "ordered")
    part = F.shiftright(F.col(mid), 33)
    sizes = placed.groupBy(part.alias(pid)).agg(F.count("*").alias("n"))
    # one row per partition of the sort: bounded by the partition count, not by the data
    offsets = sizes.select(pid, (F.sum("n").over(Window.orderBy(pid)) - F.col("n")).alias(off))
    return (placed.withColumn(pid, part).join(F.broadcast(offsets), pid)
            .withColumn(name, F.col(off) + F.col(mid) - F.shiftleft(F.col(pid), 33)).drop(mid, pid, off))


def new_folder(spark, name: str) -> str:
    """The URI of a new, empty folder under the shared checkpoint folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, name))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    return files.makeQualified(path).toString()


def release(spark, *tables: DataFrame) -> None:
    """Delete materialised tables that are no longer needed, and let Spark drop the shuffle files of finished steps."""
    for t in tables:
        for f in {x.rpartition("/")[0] for x in t.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark._jvm.System.gc()  # the context cleaner follows the driver's garbage collection


def free_memory() -> None:
    """Give freed memory of a Python worker back to the system: workers live on from job to job."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)
