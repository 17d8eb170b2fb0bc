"""Round trips through a fresh scratch folder per run."""

import json
import os

import pytest
from pyspark.sql import types as T

from conftest import rows
from rankforge import sources as S
from rankforge.session import scratch_path

SCHEMA = T.StructType([T.StructField("rank", T.IntegerType()), T.StructField("institution", T.StringType()),
                       T.StructField("country", T.StringType()), T.StructField("documents", T.LongType()),
                       T.StructField("citations", T.LongType())])


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_csv_glob_tags_and_corrupt_rows(spark):
    root = scratch_path(spark, "glob")
    hdr = "rank,institution,country,documents,citations\n"
    _write(root, "by_field_A.csv", hdr + '1,"Uni, East",CN,10,100\n2,West,US,5,x\n')
    _write(root, "by_field_B.csv", hdr + "1,North,DE,7,70\n3,South\n")
    df = S.read_csv_glob(spark, f"{root}/by_field_*.csv", SCHEMA, r"by_field_([A-Z]+)\.csv", "field").cache()
    got = {(r["field"], r["institution"]): r for r in df.collect()}
    assert got[("A", "Uni, East")]["citations"] == 100 and got[("A", "Uni, East")]["_corrupt"] is None
    assert got[("A", "West")]["_corrupt"] is not None
    assert got[("B", "South")]["_corrupt"] is not None
    assert df.count() == 4


def test_csv_header_mismatch_raises(spark):
    root = scratch_path(spark, "swapped")
    _write(root, "c.csv", "institution,rank,country,documents,citations\nA,1,CN,1,1\n")
    with pytest.raises(Exception):
        S.read_csv_table(spark, root, SCHEMA).collect()


def test_json_records_array_and_lines(spark):
    root = scratch_path(spark, "json")
    recs = [{"id": 1, "name": "a", "room": "r1", "phone": "1"}, {"id": 1, "name": "b"}, {"id": None, "name": "c"}]
    _write(root + "/arr", "s.json", json.dumps(recs))
    _write(root + "/lines", "s.json", "\n".join(json.dumps(r) for r in recs))
    schema = "id bigint, name string, room string, phone string"
    a = S.read_json_records(spark, root + "/arr", T._parse_datatype_string(schema), multiline=True)
    b = S.read_json_records(spark, root + "/lines", T._parse_datatype_string(schema))
    assert rows(a) == rows(b) and len(rows(a)) == 3
    assert (1, "b", None, None) in rows(a)


def test_write_csv_sorted_round_trip(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    path = scratch_path(spark, "sorted")
    S.write_csv(df, path, sort_by=["k"])
    back = S.read_csv_table(spark, path, df.schema, corrupt=None)
    assert rows(back) == rows(df)


def test_export_meta(spark):
    df = spark.createDataFrame([(1, None, [1.0]), (5, "x", None)], "a int, b string, c array<double>")
    meta = {r["column"]: r for r in S.export_meta(df).collect()}
    assert (meta["a"]["min"], meta["a"]["max"], meta["b"]["n_missing"]) == ("1", "5", 1)
    assert meta["c"]["min"] is None and meta["c"]["type"] == "array<double>"
    path = scratch_path(spark, "export")
    back = S.export_json(df, path)
    assert back.count() == 3


def test_stage_and_cast(spark):
    raw = spark.createDataFrame([(" 1", "1,234", "2.5"), ("2", "7x", "1"), ("", "3", "x"), ("1.5", "4", "2")],
                                "a string, b string, c string")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
                           T.StructField("c", T.DoubleType())])
    ok, bad = S.stage_and_cast(raw, schema, required=("a",))
    assert rows(ok) == [(1, 1234, 2.5)]
    assert sorted(r["reason"] for r in bad.collect()) == ["bad_value:a", "bad_value:b", "required:a"]


def test_write_staged_one_pass(spark):
    raw = spark.createDataFrame([("1", "2.5"), ("x", "1"), ("", "3")], "a string, c string")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("c", T.DoubleType())])
    path = scratch_path(spark, "staged")
    S.write_staged(raw, schema, path, required=("a",))
    assert rows(S.read_staged(spark, path, schema)) == [(1, 2.5)]
    assert sorted(r["reason"] for r in S.read_staged(spark, path, schema, "rejected").collect()) == [
        "bad_value:a", "required:a"]
