"""Whitening of quantised embeddings with weighted multiplicities.

Rows with the same quantised vector are one row of the fit: vectors are grouped
(counts combine before the shuffle), each distinct vector weighs its count or
one, sums are exact integers, and the covariance is a weighted product of
centred blocks, one d x d block per task, added by row of the block. Each
distinct vector is whitened once and joined back to the rows it stands for.
Only d x d numbers reach the driver. Vectors that make up over 1/1024 of all
rows (1024 at most) are joined back by broadcast, so one vector on a third of
the rows meets no single task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import join_spread, materialize

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Entries beyond this have no 64-bit quantised form.
LARGEST = float(1 << 56)
#: Bits of a limb: sums of limbs over a batch stay within 64 bits.
LIMB = 21


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(vec_id, x: array<long>): floor(scale * entry) + offset of every vector that is whole and finite.

    Vectors that are NULL, empty, hold NULL, NaN or infinite entries or entries
    of 2 ** 56 and more are left out, and so are vectors of another length than
    the most frequent one (the smaller of equals)."""
    v = F.col(embedding)

    def usable(c):  # NaN is larger than all numbers
        return F.abs(c.cast("double")) < LARGEST

    whole = (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & usable(c))
    rows = vectors.where(F.coalesce(whole, F.lit(False))).select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("v"))
    length = rows.groupBy(F.size("v").alias("k")).count().orderBy(F.desc("count"), "k").first()
    rows = rows.where(F.size("v") == (length[0] if length else 0))
    # filters may run in any order, so the expression itself stays within 64 bits
    return rows.select("vec_id", F.transform("v", lambda c: F.when(usable(c), F.floor(c.cast("double") * scale).cast("long") + offset)).alias("x"))


def _block(b: pa.RecordBatch, column: str, dtype) -> np.ndarray:
    """The arrays of a list column as rows of a matrix."""
    lists = b.column(b.schema.get_field_index(column))
    return lists.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(b.num_rows, -1)


def _sums(fit: DataFrame, weight: str | None) -> tuple[int, list[int]]:
    """(total weight, weighted sum of each dimension), exact: added in limbs of ``LIMB`` bits."""
    low = (1 << LIMB) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 4096):
                part = b.slice(a, 4096)
                x = _block(part, "x", np.int64)
                w = part.column(part.schema.get_field_index(weight)).to_numpy() if weight else np.ones(len(x), dtype=np.int64)
                for k in (0, LIMB, 2 * LIMB):
                    limb = x >> k if k == 2 * LIMB else (x >> k) & low
                    for j in (0, LIMB, 2 * LIMB) if weight else (0,):
                        s = (limb * (w >> j & low)[:, None]).sum(axis=0)
                        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(s))), pa.array(np.full(len(s), k + j)), pa.array(s)], names=["i", "shift", "s"])

    n = fit.agg(F.sum(weight) if weight else F.count("*")).first()[0] or 0
    parts = fit.mapInArrow(run, "i long, shift long, s long").groupBy("i", "shift").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    sums = [0] * (max((r["i"] for r in parts), default=-1) + 1)
    for r in parts:  # at most 9 per dimension
        sums[r["i"]] += int(r["s"]) << r["shift"]
    return n, sums


def _centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """x - mean: the whole part exactly, then the fraction."""
    return (x - whole).astype(np.float64) - rest


def _covariance(fit: DataFrame, column: str, whole: np.ndarray, rest: np.ndarray, weight: str | None, n: int) -> np.ndarray:
    """Weighted covariance (divisor n) of the arrays of ``column`` around whole + rest.

    One block per task; rows of the blocks are added in the order of the tasks, so reruns on the same partitions agree."""
    d = len(whole)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for b in batches:
            if b.num_rows:
                z = _centred(_block(b, column, whole.dtype), whole, rest)
                w = b.column(b.schema.get_field_index(weight)).to_numpy() if weight else None
                total += z.T @ (z * w[:, None] if weight else z)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(np.full(d, TaskContext.get().partitionId())),
                                          pa.array(list(total), pa.list_(pa.float64()))], names=["i", "task", "v"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            v = _block(b, "v", np.float64) if b.num_rows else []
            for i, row in zip(b.column(0).to_pylist(), v):
                held[i] = held[i] + row if i in held else row.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.list_(pa.float64()))], names=["i", "v"])

    parts = fit.mapInArrow(blocks, "i long, task long, v array<double>").repartition("i").sortWithinPartitions("i", "task")
    out = np.zeros((d, d))
    for r in parts.mapInArrow(add, "i long, v array<double>").collect():  # d rows of d numbers
        out[r["i"]] = r["v"]
    return (out + out.T) / (2 * n)


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS,
           weights: str = "one", scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Per kept row: ``vec_id, n, deviation, whitened, explained, identity_error``.

    ``whitened`` and ``explained`` are arrays over the first ``components``
    eigenvectors (all dimensions if fewer) of the covariance of the quantised
    vectors, by falling eigenvalue; the largest entry of each eigenvector is
    positive. ``weights``: every distinct vector weighs ``'one'`` or its
    ``'count'`` of rows in the fit; ``n`` is the total weight. ``deviation``
    is the exact sum over dimensions of (n x - S) ** 2 (NULL beyond 64 bits).
    ``identity_error``: largest entry of |covariance of whitened - identity|.

    Rows that ``quantised`` leaves out are not returned. Components without
    variance (an eigenvalue at rounding level; one distinct vector has no
    other) have whitened NULL and explained 0, and don't count for
    ``identity_error``. Repeated rows and NULL ids are returned each; other
    columns are not read. Empty table: empty result."""
    if weights not in ("one", "count"):
        raise ValueError(f"weights must be 'one' or 'count', not {weights!r}")
    spark, weight = vectors.sparkSession, "m" if weights == "count" else None
    rows = quantised(vectors, vec_id, embedding, scale, offset)
    fit = materialize(rows.groupBy("x").agg(F.count("*").alias("m")), "distinct-vectors")
    n, sums = _sums(fit, weight)
    if not n:
        return spark.createDataFrame([], "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double") \
            .withColumn("vec_id", F.col("vec_id").cast(rows.schema["vec_id"].dataType))
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n / n for s in sums])
    cov = _covariance(fit, "x", whole, rest, weight, n)
    values, axes = np.linalg.eigh(cov)
    d, k = len(values), min(components, len(values))
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    real = int((values > max(values[0], 0.0) * d * 16 * np.finfo(float).eps).sum())
    explained = [float(e / np.trace(cov)) if i < real else 0.0 for i, e in enumerate(values)]
    project = axes[:, :real] / np.sqrt(values[:real])
    left = np.array([s % n for s in sums], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _block(b, "x", np.int64)
            y = pa.array(list(_centred(x, whole, rest) @ project), pa.list_(pa.float64()))
            z = x - whole
            if d * (n * (float(np.abs(z).max()) + 1)) ** 2 < 2.0 ** 62:
                off = ((n * z - left) ** 2).sum(axis=1).tolist()
            else:
                off = [sum((n * a - r) ** 2 for a, r in zip(row, left.tolist())) for row in z.tolist()]
            off = pa.array([v if v < 1 << 63 else None for v in off], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), off, y], names=["x", "m", "deviation", "y"])

    white = materialize(fit.select("x", "m").mapInArrow(run, "x array<long>, m long, deviation long, y array<double>"), "whitened")
    part = white.select(F.posexplode("y").alias("i", "v"), (F.col("m") if weight else F.lit(1)).alias("w")).groupBy("i").agg(F.sum(F.col("v") * F.col("w")).alias("s"))
    mean = np.zeros(real)
    for r in part.collect():  # one per component
        mean[r["i"]] = r["s"] / n
    error = float(np.abs(_covariance(white, "y", np.zeros(real), mean, weight, n) - np.eye(real)).max()) if real else 0.0
    out = join_spread(rows, white, "x", "m")
    pad = F.array_repeat(F.lit(None).cast("double"), k - real)
    return out.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", F.concat("y", pad).alias("whitened"),
                      F.lit(explained).cast("array<double>").alias("explained"), F.lit(error).alias("identity_error"))
