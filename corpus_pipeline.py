"""The corpus pipeline: documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's ``docs``. All but the last keep
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm import lines, mixing, packing, quality, simhash
from rankforge.llm.common import materialize
from rankforge.llm.queries import small_batches, table, tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_chars(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars`` counted anew after its text has changed."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose their failing lines."""
    small_batches(spark)
    return _with_chars(quality.clean_documents(docs.select(*COLUMNS)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on more than the ratio of a source's documents are dropped from them."""
    return _with_chars(lines.drop_boilerplate(docs.select(*COLUMNS)))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    small_batches(spark)
    return simhash.first_of_each(docs.select(*COLUMNS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 4096 ids."""
    small_batches(spark)
    # executors that have run the stages before have less room for the encoder
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), memory=50_000, slice_chars=1 << 19, rows_at_once=256)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_dedup", simhash_dedup),
          ("source_mix", source_mix), ("packing", pack_sequences)]

#: The fingerprints (XXH64) and the tokenizer have no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
