"""K1-K4 on a small keyed table."""

import pytest

from conftest import rows
from rankforge.operators import records as R


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame([(1, "ann", "r1"), (2, "bob", "r2"), (3, "cy", "r3"), (None, "nul", "r0")],
                                 "id bigint, name string, room string")


def test_lookup_semi_join(spark, base):
    keys = spark.createDataFrame([(1,), (1,), (3,), (None,)], "id bigint")
    assert rows(R.lookup(base, keys, ["id"]), ["id"]) == [(1,), (3,)]


def test_delete_keeps_null_key(spark, base):
    keys = spark.createDataFrame([(2,), (None,)], "id bigint")
    assert rows(R.delete_keys(base, keys, ["id"]), ["id"]) == [(1,), (3,), (None,)]


def test_insert_new_reasons(spark, base):
    batch = spark.createDataFrame([(2, "dup", "x"), (4, "dan", "r4"), (4, "dan2", "r5"), (None, "n", "r")],
                                  "id bigint, name string, room string")
    result, refused = R.insert_new(base, batch, ["id"], order=["name"])
    assert (4, "dan", "r4") in rows(result)
    assert sorted(r["reason"] for r in refused.collect()) == ["exists", "null_key", "repeat"]


def test_apply_changes_last_wins_and_idempotent(spark, base):
    ch = spark.createDataFrame(
        [(1, "ann2", None, 5, "U"), (1, None, "r9", 7, "U"), (2, None, None, 3, "D"), (5, "eve", "r5", 1, "I"),
         (6, None, None, 2, "D")], "id bigint, name string, room string, seq bigint, op string")
    full = R.apply_changes(base.filter("id is not null"), ch, ["id"])
    assert rows(full) == [(1, None, "r9"), (3, "cy", "r3"), (5, "eve", "r5")]
    part = R.apply_changes(base.filter("id is not null"), ch, ["id"], partial=True)
    assert rows(part) == [(1, "ann", "r9"), (3, "cy", "r3"), (5, "eve", "r5")]
    again = R.apply_changes(part, ch, ["id"], partial=True)
    assert rows(again) == rows(part)


def test_apply_changes_equal_seq_raises(spark, base):
    ch = spark.createDataFrame([(1, "a", "b", 1, "U"), (1, "c", "d", 1, "U")],
                               "id bigint, name string, room string, seq bigint, op string")
    with pytest.raises(ValueError):
        R.apply_changes(base, ch, ["id"])


def test_apply_changes_timestamp_sequence(spark, base):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    ch = spark.createDataFrame([(1, "late", "r1", t0 + dt.timedelta(hours=2), "U"),
                                (1, "early", "r1", t0, "U")],
                               "id bigint, name string, room string, seq timestamp, op string")
    got = {r["id"]: r["name"] for r in R.apply_changes(base.filter("id is not null"), ch, ["id"]).collect()}
    assert got[1] == "late"
