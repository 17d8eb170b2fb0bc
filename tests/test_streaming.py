"""Continuous CSV import: each file once, checked casts, restart from the checkpoint."""

import os

from pyspark.sql import types as T

from rankforge.session import scratch_path
from rankforge.streaming import import_stream, read_imported

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("score", T.DoubleType())])


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_import_stream_once_per_file(spark):
    root = scratch_path(spark, "stream-test")
    src = f"{root}/in"
    _write(src, "a.csv", "id,name,score\n1,ann,2.5\n2,bob,x\n")
    args = (spark, src, SCHEMA, f"{root}/staged", f"{root}/ckpt")
    import_stream(*args, required=("id",)).awaitTermination()
    assert read_imported(spark, f"{root}/staged", SCHEMA).count() == 1
    _write(src, "b.csv", "id,name,score\n3,cy,1\n,dan,4\n")
    import_stream(*args, required=("id",)).awaitTermination()  # restart: only b.csv is new
    ok = sorted(r["id"] for r in read_imported(spark, f"{root}/staged", SCHEMA).collect())
    assert ok == [1, 3]
    reasons = sorted(r["reason"] for r in read_imported(spark, f"{root}/staged", SCHEMA, "rejected").collect())
    assert reasons == ["bad_value:score", "required:id"]
