"""Scratch folders come from the session's checkpoint setting; materialized
tables keep their schema and cut lineage."""

from pyspark.sql import functions as F

from conftest import rows
from rankforge.plans.audit import plan_text
from rankforge.session import checkpoint_root, materialize, scratch_path


def test_scratch_under_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root) and b.startswith(root) and a != b


def test_materialize_round_trip(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") * 1.25).cast("decimal(18,2)").alias("d"))
    m = materialize(df.filter("id % 2 = 0"), "t")
    assert [(f.name, f.dataType) for f in m.schema] == [(f.name, f.dataType) for f in df.schema]
    assert rows(m) == rows(df.filter("id % 2 = 0"))
    assert "Range" not in plan_text(m)  # read back from the table, not recomputed
