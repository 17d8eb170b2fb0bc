"""Keyed records as a hash-partitioned table (K4): a change batch rewrites only the partitions that its keys fall in.

Layout of a store:

    <path>/v<version>/__part=<p>/...parquet   the rows of partition p, as some version wrote them
    <path>/_versions/<version>.json           number of partitions, key, schema, and per partition the versions that hold it

A version is visible once its manifest stands under its final name. The
manifest is written beside it and renamed, which fails if the name is taken:
of two writers that start from one version the second one is refused and its
folders are never read."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.operators.records import apply_changes
from rankforge.session import file_system

PARTS = 64


def _part(df: DataFrame, on: Sequence[str], parts: int) -> Column:
    """A row's partition, by its key. Rows without a whole key match no change; they are spread by all columns."""
    keyed = F.lit(True)
    for c in on:
        keyed = keyed & F.col(c).isNotNull()
    by_key = F.xxhash64(*[F.col(c).cast("string") for c in on])
    return F.pmod(F.when(keyed, by_key).otherwise(F.xxhash64(*df.columns)), F.lit(parts)).cast("int")


def _write(df: DataFrame, path: str, version: int, on: Sequence[str], parts: int) -> None:
    # rows of a partition come together; AQE splits a large one over tasks and puts small ones in one
    df.withColumn("__part", _part(df, on, parts)).hint("rebalance", "__part").write.partitionBy("__part").parquet(f"{path}/v{version}")


def _publish(spark: SparkSession, path: str, version: int, manifest: dict) -> None:
    files, target = file_system(spark, f"{path}/_versions/{version:08d}.json")
    _, own = file_system(spark, f"{path}/_versions/.{version:08d}.{uuid.uuid4().hex}")
    out = files.create(own, False)
    out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    out.close()
    if files.exists(target) or not files.rename(own, target):
        files.delete(own, False)
        raise RuntimeError(f"version {version} of {path} exists already: another writer was first")


def _manifest(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict]:
    files, folder = file_system(spark, f"{path}/_versions")
    names = sorted(s.getPath().getName() for s in files.listStatus(folder) if not s.getPath().getName().startswith("."))
    name = names[-1] if version is None else f"{version:08d}.json"
    text = spark.read.text(f"{path}/_versions/{name}", wholetext=True).first()[0]
    return int(name.split(".")[0]), json.loads(text)


def _held(spark: SparkSession, path: str, version: int) -> set[int]:
    """The partitions that a version wrote rows of."""
    files, folder = file_system(spark, f"{path}/v{version}")
    if not files.exists(folder):
        return set()
    return {int(s.getPath().getName().removeprefix("__part=")) for s in files.listStatus(folder) if s.getPath().getName().startswith("__part=")}


def create_store(df: DataFrame, path: str, on: Sequence[str], parts: int = PARTS) -> None:
    """Write ``df`` as version 0 of a store keyed by ``on``."""
    spark = df.sparkSession
    _write(df, path, 0, on, parts)
    held = {str(p): [0] for p in _held(spark, path, 0)}
    _publish(spark, path, 0, {"parts": parts, "on": list(on), "schema": df.schema.json(), "held": held})


def _read(spark: SparkSession, path: str, manifest: dict, only: set[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(manifest["schema"]))
    # one folder per partition, and more only where rows without a key were added since
    folders = [f"{path}/v{v}/__part={p}" for p, vs in manifest["held"].items() for v in vs if only is None or int(p) in only]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_store(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the store: its latest version, or an earlier one."""
    return _read(spark, path, _manifest(spark, path, version)[1])


def change_store(changes: DataFrame, path: str, seq_col: str = "seq", op_col: str = "op", partial: bool = False,
                 check_ties: bool = True) -> int:
    """K4 on a store: apply a change batch (as ``records.apply_changes``) and publish the next version; returns its number.

    Only the partitions that a key of the batch falls in are read and written
    anew; the files of all others stay as they are and serve both versions.
    Rows that the batch adds without a whole key join the partitions they fall
    in. An empty batch leaves the data as it is. Two writers at once: one is refused."""
    spark = changes.sparkSession
    version, manifest = _manifest(spark, path)
    on, parts = manifest["on"], manifest["parts"]
    keyed = changes.dropna(subset=on)
    touched = {r[0] for r in keyed.select(_part(keyed, on, parts)).distinct().collect()}  # ``parts`` numbers at most
    new = version + 1
    base = _read(spark, path, manifest, touched)
    _write(apply_changes(base, changes, on, seq_col, op_col, partial, check_ties), path, new, on, parts)
    held = {p: vs for p, vs in manifest["held"].items() if int(p) not in touched}
    for p in _held(spark, path, new):
        held[str(p)] = [*held.get(str(p), []), new]
    _publish(spark, path, new, {**manifest, "held": held})
    return new


def drop_versions(spark: SparkSession, path: str) -> None:
    """Delete what only earlier versions use: their manifests and the partitions that the latest one doesn't read."""
    latest, manifest = _manifest(spark, path)
    keep = {(v, int(p)) for p, vs in manifest["held"].items() for v in vs}
    for version in range(latest):
        files, old = file_system(spark, f"{path}/_versions/{version:08d}.json")
        files.delete(old, False)
        for p in _held(spark, path, version):
            if (version, p) not in keep:
                files.delete(file_system(spark, f"{path}/v{version}/__part={p}")[1], True)
