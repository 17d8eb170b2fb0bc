"""F2-F10 on a small entity-field table."""

import math

import pytest

from conftest import rows
from rankforge.operators import features as Fe
from rankforge.operators.reports import ranked


@pytest.fixture(scope="module")
def ef(spark):
    data = [(1, "math", 10, 100.0), (1, "bio", 5, 10.0), (2, "math", 4, 100.0), (2, "bio", 8, 80.0),
            (3, "math", 1, 5.0), (3, "chem", 2, 0.0)]
    df = spark.createDataFrame(data, "entity bigint, field string, docs bigint, citations double")
    return ranked(df)


def test_entity_summary(spark, ef):
    s = {r["entity"]: r for r in Fe.entity_summary(ef).collect()}
    assert s[1]["n_fields"] == 2 and s[1]["best_rank"] == 1 and s[1]["cpp"] == pytest.approx(110 / 15)
    assert s[3]["sd_rank"] == pytest.approx(math.sqrt(((3 - 2) ** 2 + (1 - 2) ** 2) / 1))


def test_field_profile_shares_sum_to_one(spark, ef):
    p = Fe.field_profile(ef.drop("rank"), buckets=None)
    tot = {}
    for r in p.collect():
        if r["share_of_entity"] is not None:
            tot[r["entity"]] = tot.get(r["entity"], 0) + r["share_of_entity"]
    assert all(v == pytest.approx(1.0) for v in tot.values())
    pr = {(r["entity"], r["field"]): r["pct_rank"] for r in p.collect()}
    assert pr[(1, "math")] == 0.0 and pr[(3, "math")] == 1.0


def test_entity_strengths_best_and_worst(spark, ef):
    s = rows(Fe.entity_strengths(ef, 3, 1), ["kind", "field"])
    assert s == [("best", "chem"), ("worst", "math")]


def test_log_and_ratio_features(spark):
    df = spark.createDataFrame([(0.0, 0.0), (-1.0, 2.0), (math.e - 1, 4.0)], "x double, y double")
    r = Fe.ratio_features(Fe.log_features(df, ["x"]), [("y", "x", "y_per_x")]).collect()
    assert r[0]["log1p_x"] == 0.0 and r[1]["log1p_x"] is None
    assert r[2]["log1p_x"] == pytest.approx(1.0)
    assert r[0]["y_per_x"] is None and r[1]["y_per_x"] == -2.0


def test_category_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x")], "c1 string, c2 string")
    got = {(r["column"], r["value"]): (r["n"], r["share"]) for r in Fe.category_counts(df, ["c1", "c2"]).collect()}
    assert got[("c1", "a")] == (2, pytest.approx(2 / 3)) and got[("c2", None)] == (1, None)
    assert got[("c2", "x")] == (2, 1.0)


def test_numeric_distributions(spark):
    df = spark.createDataFrame([(float(i), float(i % 3)) for i in range(10)], "a double, b double")
    d = Fe.numeric_distributions(df, ["a", "b"], 5)
    per = {}
    for r in d.collect():
        per[r["column"]] = per.get(r["column"], 0) + r["n"]
    assert per == {"a": 10, "b": 10}


def test_target_encoding_uses_train_only(spark, ef):
    train = ef.filter("entity != 3")
    enc = {(r["entity"], r["field"]): r["field_te"] for r in
           Fe.encode_categories(train, ef, ["field"], "target", target="rank", smoothing=1.0).collect()}
    mu = sum(r["rank"] for r in train.collect()) / train.count()
    assert enc[(3, "chem")] == pytest.approx(mu)          # unseen in train
    assert enc[(1, "math")] == pytest.approx((1 + 1 + mu) / 3)  # ranks 1 and 1 (tie), smoothing 1


def test_profile_matrix(spark, ef):
    pm = {r["entity"]: r for r in Fe.profile_matrix(ef).collect()}
    assert pm[3]["f_bio"] == 0.0 and pm[2]["f_bio"] == 80.0
    with pytest.raises(ValueError):
        Fe.profile_matrix(ef, max_fields=2)


def test_index_and_onehot_fit_on_train(spark, ef):
    train = ef.filter("entity != 3")
    idx = Fe.encode_categories(train, ef, ["field"], "index")
    got = {r["field"]: r["field_idx"] for r in idx.select("field", "field_idx").distinct().collect()}
    assert got["chem"] == 2.0  # unseen in train: the extra 'keep' index
    oh = Fe.encode_categories(train, ef, ["field"], "onehot")
    slots = {r["field"]: int(r["field_vec"].indices[0]) for r in oh.select("field", "field_vec").collect()}
    assert slots["chem"] not in (slots["math"], slots["bio"]) and slots["math"] != slots["bio"]


def test_profile_matrix_unknown_field_raises(spark, ef):
    with pytest.raises(ValueError):
        Fe.profile_matrix(ef, fields=["math", "bio"])
    assert Fe.profile_matrix(ef, fields=["math", "bio"], strict=False).count() == 3


def test_entity_rankings_count_equals_rank_then_filter(spark):
    from rankforge.operators.reports import entity_rankings, ranked
    data = [(e, f, d, c) for e, f, d, c in [
        (1, "a", 1, 10.0), (2, "a", 1, 10.0), (3, "a", 1, 20.0), (4, "a", 1, None),
        (1, "b", 2, None), (2, "b", 2, 5.0), (3, "b", 2, None), (1, "c", 3, 1.0)]]
    df = spark.createDataFrame(data, "entity bigint, field string, docs bigint, citations double")
    for e in (1, 2, 4, 99):
        got = rows(entity_rankings(df, e), ["field", "rank"])
        exp = rows(ranked(df, buckets=None).filter(f"entity = {e}"), ["field", "rank"])
        assert got == exp, e
