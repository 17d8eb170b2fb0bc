"""M1-M5 on a small star: stage -> dimensions -> facts, then checks."""

import hashlib

import pytest

from conftest import rows
from rankforge.operators import warehouse as W


@pytest.fixture(scope="module")
def stage(spark):
    return spark.createDataFrame(
        [("U1", "CN", "Math", 10, 100), ("U1", "US", "Physics", 5, 20), ("U2", "DE", "Math", 3, 9),
         ("U3", "FR", "Alchemy", 1, 1), ("U2", "DE", "Math", 3, 9)],
        "institution string, country string, field string, docs bigint, citations bigint")


def test_spec_errors_raise():
    with pytest.raises(ValueError):
        W.TableSpec("t", {"a": "int"}, primary_key=("b",))
    with pytest.raises(ValueError):
        W.TableSpec("t", {"a": "int"}, ranges={"a": (5, 1)})


def test_seed_dimension_md5(spark, stage):
    d = {r["value"]: r["key"] for r in W.seed_dimension(stage, "field").collect()}
    assert set(d) == {"Math", "Physics", "Alchemy"}
    assert d["Math"] == hashlib.md5(b"Math").hexdigest()


def test_migrate_dimension_reports_conflicts(spark, stage):
    dim = {r["institution"]: r for r in W.migrate_dimension(stage, ["institution"], ["country"], ["field"]).collect()}
    assert dim["U1"]["n_variants"] == 2 and dim["U1"]["country"] == "CN"
    assert dim["U2"]["n_variants"] == 1


def test_facts_orphans_and_verify(spark, stage):
    fields = spark.createDataFrame([("Math",), ("Physics",)], "f string")
    fdim = W.seed_dimension(fields, "f")
    idim = W.migrate_dimension(stage, ["institution"], ["country"], ["field"])
    facts, orphans = W.migrate_facts(stage, [("inst", idim, "institution", "institution", "key"),
                                             ("field", fdim, "field", "value", "key")], ["docs", "citations"])
    assert facts.count() == 4
    assert rows(orphans, ["institution", "missing_dim"]) == [("U3", "field")]
    spec = W.TableSpec("facts", {"inst_key": "string", "field_key": "string", "docs": "bigint",
                                 "citations": "bigint"}, primary_key=("inst_key", "field_key"),
                       required=("inst_key",), ranges={"docs": (0, 8)})
    res = {(r["check"], r["table"]): r["n_violations"] for r in
           W.verify({"facts": facts, "stage": stage, "orphans": orphans}, [spec],
                    [("stage", "stage", ["facts", "orphans"])]).collect()}
    assert res[("pk_dup", "facts")] == 1          # U2/Math staged twice
    assert res[("out_of_range", "facts")] == 1    # docs 10 > 8
    assert res[("required_null", "facts")] == 0
    assert res[("rows", "stage")] == 0
