"""Continuous import of arriving CSV downloads (S6 as a stream).

A folder receives raw CSV files (for example one download per field); a
Structured Streaming file source reads them as strings, each micro-batch
is staged (checked casts) and written once per batch, partitioned by
accepted / rejected. The stream's checkpoint makes the import
exactly-once per file and lets it resume after a failure; with
``availableNow`` it processes what is there and stops, like a batch import.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rankforge.sources.staging import read_staged, write_staged


def string_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def read_imported(spark: SparkSession, table_path: str, schema: T.StructType,
                  status: str = "accepted") -> DataFrame:
    """Accepted (typed) or rejected (raw text + reason) rows of all
    micro-batches of an import."""
    return read_staged(spark, table_path, schema, status)


def import_stream(spark: SparkSession, source_dir: str, schema: T.StructType, table_path: str,
                  checkpoint: str, required: tuple = (),
                  available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the import; returns the ``StreamingQuery`` (already finished
    when ``available_now`` and awaited by the caller)."""
    reader = (spark.readStream.schema(string_schema(schema)).option("header", True)
              .option("enforceSchema", False))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(source_dir)

    def load(batch: DataFrame, batch_id: int) -> None:
        # one folder per micro-batch, overwritten if the batch is replayed after
        # a failure: the sink stays exactly-once without a transactional table.
        # One write per batch: casts run once, both outcomes land by status.
        write_staged(batch, schema, f"{table_path}/batch={batch_id}", required, mode="overwrite")

    w = raw.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
