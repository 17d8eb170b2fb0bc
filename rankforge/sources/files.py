"""CSV and JSON sources and sinks.

Readers always take an explicit schema (no inference pass over the data)
and check CSV headers against it (``enforceSchema=False``), because a
positional bind would silently swap columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def _with_corrupt(schema: T.StructType, corrupt: str | None) -> T.StructType:
    if not corrupt:
        return schema
    return T.StructType(list(schema.fields) + [T.StructField(corrupt, T.StringType(), True)])


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType, corrupt: str | None = CORRUPT,
                   multiline: bool = False, **options) -> DataFrame:
    """One typed CSV table. Short, long or badly typed rows keep their
    text in ``corrupt``; a header that does not match the schema raises."""
    r = (spark.read.schema(_with_corrupt(schema, corrupt)).option("header", True)
         .option("enforceSchema", False).option("mode", "PERMISSIVE").option("multiLine", multiline))
    if corrupt:
        r = r.option("columnNameOfCorruptRecord", corrupt)
    for k, v in options.items():
        r = r.option(k, v)
    return r.csv(path)


def read_csv_glob(spark: SparkSession, pattern: str, schema: T.StructType, tag_regex: str,
                  tag_col: str = "tag", corrupt: str | None = CORRUPT, **options) -> DataFrame:
    """All CSV files matched by ``pattern`` as one table, plus ``tag_col``
    = first group of ``tag_regex`` on the (decoded) file path; NULL when the
    path does not match. Partition inference from folder names is off so
    that only the declared schema appears."""
    df = read_csv_table(spark, pattern, schema, corrupt, recursiveFileLookup=True, **options)
    # percent escapes only: a plus sign in a path is a plus sign
    path = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    tag = F.regexp_extract(path, tag_regex, 1)
    out = df.withColumn(tag_col, F.when(tag != "", tag))
    cols = [f.name for f in schema.fields] + [tag_col] + ([corrupt] if corrupt else [])
    return out.select(*cols)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType,
                      multiline: bool = False) -> DataFrame:
    """S3: JSON records, one per line or (``multiline=True``) one array per
    file. A field missing in a record is NULL."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def write_csv(df: DataFrame, path: str, sort_by: Sequence[str] | None = None,
              descending: bool = False, partition_by: Sequence[str] | None = None,
              mode: str = "errorifexists") -> None:
    """CSV with header; globally sorted (range shuffle) only when asked.
    NULL and the empty string read back as one value (a CSV limit)."""
    out = df
    if sort_by:
        cols = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c in sort_by]
        out = out.orderBy(*cols)
    w = out.write.mode(mode).option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def export_meta(df: DataFrame) -> DataFrame:
    """S5 sidecar: ``column, type, n_rows, n_missing, min, max`` (min and max
    as strings, NULL for arrays, maps and structs), from one aggregate."""
    n = F.count(F.lit(1))
    rows = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        simple = not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        lo = F.min(c).cast("string") if simple else F.lit(None).cast("string")
        hi = F.max(c).cast("string") if simple else F.lit(None).cast("string")
        rows.append(F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                             n.cast("bigint").alias("n_rows"), (n - F.count(c)).cast("bigint").alias("n_missing"),
                             lo.alias("min"), hi.alias("max")))
    return df.agg(F.array(*rows).alias("__m")).select(F.inline("__m"))


_META = T.StructType([T.StructField(n, T.LongType() if n.startswith("n_") else T.StringType())
                      for n in ("column", "type", "n_rows", "n_missing", "min", "max")])


def export_json(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write records as line-delimited JSON and the metadata sidecar next
    to it (``<path>/_meta``, one JSON row per column); returns the sidecar frame
    read back from storage. The counts, minima and maxima are collected by the
    write itself (an ``Observation``), so the input is computed and read once
    and the data isn't read back."""
    spark, seen, n = df.sparkSession, Observation(), F.count(F.lit(1))
    metrics = [n.alias("n")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        metrics.append(F.count(c).alias(f"n_{i}"))
        if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            metrics += [F.min(c).cast("string").alias(f"min_{i}"), F.max(c).cast("string").alias(f"max_{i}")]
    df.observe(seen, *metrics).write.mode(mode).json(f"{path}/data")
    m = seen.get
    rows = [(f.name, f.dataType.simpleString(), m["n"], m["n"] - m[f"n_{i}"], m.get(f"min_{i}"), m.get(f"max_{i}")) for i, f in enumerate(df.schema.fields)]
    spark.createDataFrame(rows, _META).coalesce(1).write.mode(mode).json(f"{path}/_meta")
    return spark.read.schema(_META).json(f"{path}/_meta")
