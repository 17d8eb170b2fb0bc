"""P1-P7 on a tiny fit table: exact line, constant docs, unseen field."""

import math

import pytest
from pyspark.sql import functions as F

from rankforge.operators import prediction as P


@pytest.fixture(scope="module")
def fit(spark):
    data = []
    for e in range(1, 11):
        data.append((e, "line", e, int(round(10 - 2 * math.log1p(e)))))
        data.append((e, "flat", 3, e))
    data.append((99, "only_test", 5, 1))
    return spark.createDataFrame(data, "entity bigint, field string, docs bigint, rank bigint")


def test_split_is_by_key(spark, fit):
    train, test = P.split_by_key(fit, "entity", 5, 0)
    assert {r["entity"] for r in test.collect()} == {5, 10}
    assert train.count() + test.count() == fit.count()
    s = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    tr, te = P.split_by_key(s, "k", 2, 0)
    assert tr.count() + te.count() == 3 and None in [r["k"] for r in tr.collect()]


def test_fit_and_predict(spark, fit):
    train, test = P.split_by_key(fit, "entity", 5, 0)
    co = {r["field"]: r for r in P.fit_rank_linear(train).collect()}
    assert "flat" not in co  # constant docs: fewer than two distinct x
    assert co["line"]["n"] == 8
    pred = P.predict_ranks(P.fit_rank_linear(train), train, fit)
    got = {(r["entity"], r["field"]): r for r in pred.collect()}
    mu = sum(r["rank"] for r in train.collect()) / train.count()
    assert got[(99, "only_test")]["raw"] == pytest.approx(max(mu, 1.0))
    assert all(r["raw"] >= 1.0 for r in got.values())


def test_metrics_perfect_prediction(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0), (4.0, None)], "y double, p double")
    m = P.regression_metrics(df, "y", "p").first()
    assert (m["n"], m["n_missing"], m["mae"], m["rmse"], m["r2"]) == (3, 1, 0.0, 0.0, 1.0)


def test_residual_report_bands(spark):
    df = spark.createDataFrame([("f", 5, 4.0), ("f", 20, 25.0), ("f", 200, 150.0), ("f", 7, 8.0)],
                               "field string, rank bigint, raw double")
    r = {x["band"]: x for x in P.residual_report(df).collect()}
    assert set(r) == {"1-10", "11-50", ">100"}
    assert r["1-10"]["mean_error"] == 0.0 and r["1-10"]["mean_abs_error"] == 1.0


def test_compare_models_beats_baseline(spark, fit):
    df = fit.filter("field = 'line'").withColumn("field2", F.lit("x"))
    train, test = P.split_by_key(df, "entity", 5, 0)
    out = {r["model"]: r for r in P.compare_models(
        train, test, {"lin": {"cats": [], "nums": [], "log_nums": ["docs"], "algo": "linear"}}).collect()}
    assert out["lin"]["mae"] < out["baseline_mean"]["mae"]


@pytest.mark.parametrize("algo", ["linear", "forest", "gbt", "fm"])
def test_train_rank_model_algos(spark, fit, algo):
    train, test = P.split_by_key(fit, "entity", 5, 0)
    model = P.train_rank_model(train, ["field"], [], algo=algo, log_nums=["docs"])
    pred = model.transform(test.withColumn("rank", F.col("rank").cast("double")))
    assert pred.filter(F.col("prediction").isNull()).count() == 0 and pred.count() == test.count()
    names = [n for n, _ in P.feature_weights(model, train)]
    assert names[0] == "log1p_docs"
