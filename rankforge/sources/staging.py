"""Bulk load through a string staging table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions.columns import is_integer_text

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMS = _INTS + (T.FloatType, T.DoubleType, T.DecimalType)


def string_stage(df: DataFrame) -> DataFrame:
    """Every column as a string, as a raw file would land."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def staged(raw: DataFrame, schema: T.StructType, required: tuple = ()) -> DataFrame:
    """S6 in one frame: the raw text columns, ``typed`` (a struct in
    ``schema``), ``reason`` and ``status`` (``accepted`` / ``rejected``).

    Empty strings are NULL. A row is accepted when every non-empty value
    casts (integers only as plain digits; thousands commas are removed from
    numbers) and no ``required`` column is NULL; otherwise ``reason`` is
    ``bad_value:<col>`` or ``required:<col>`` for the first failing column
    in schema order. Narrow: no shuffle."""
    cast_cols, checks = [], []
    for f in schema.fields:
        s = F.trim(F.col(f.name).cast("string"))
        s = F.when(s != "", s)
        if isinstance(f.dataType, _NUMS):
            s = F.regexp_replace(s, ",", "")
        if isinstance(f.dataType, _INTS):
            v = F.when(is_integer_text(s), s.try_cast(f.dataType))
        else:
            v = s.try_cast(f.dataType)
        cast_cols.append(v.alias(f.name))
        checks.append(F.when(s.isNotNull() & v.isNull(), F.lit(f"bad_value:{f.name}")))
        if f.name in required:
            checks.append(F.when(s.isNull(), F.lit(f"required:{f.name}")))
    reason = F.coalesce(*checks)
    return raw.select(*[F.col(c) for c in raw.columns], F.struct(*cast_cols).alias("typed"),
                      reason.alias("reason"),
                      F.when(reason.isNull(), F.lit("accepted")).otherwise(F.lit("rejected")).alias("status"))


def stage_and_cast(raw: DataFrame, schema: T.StructType, required: tuple = ()
                   ) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)`` as two lazy frames over ``staged``;
    rejected rows keep their raw text plus ``reason``. Each frame re-reads
    the input; to produce both in one pass use ``write_staged``."""
    x = staged(raw, schema, required)
    accepted = x.filter(F.col("status") == "accepted").select("typed.*")
    rejected = x.filter(F.col("status") == "rejected").select(*raw.columns, "reason")
    return accepted, rejected


def write_staged(raw: DataFrame, schema: T.StructType, path: str, required: tuple = (),
                 mode: str = "errorifexists") -> None:
    """One pass over the input: the staged table is written once, partitioned
    by ``status``, so the casts run once per row and both outcomes land
    together (readers prune to one partition with ``read_staged``)."""
    staged(raw, schema, required).write.mode(mode).partitionBy("status").parquet(path)


def read_staged(spark, path: str, schema: T.StructType, status: str = "accepted") -> DataFrame:
    """The accepted rows (typed, in ``schema``) or the rejected rows (raw
    text + ``reason``) of tables written by ``write_staged``."""
    t = spark.read.parquet(path).filter(F.col("status") == status)
    if status == "accepted":
        return t.select("typed.*").select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    return t.select(*[f.name for f in schema.fields], "reason")
