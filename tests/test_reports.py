"""Q2-Q5 and A1-A5 on a small entity-field table with NULLs and ties."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rankforge.operators import citations as A
from rankforge.operators import reports as Q


@pytest.fixture(scope="module")
def ef(spark):
    data = [(1, 1, "EU", "math", 10, 100.0), (2, 1, "EU", "math", 5, 100.0), (3, 2, None, "math", 1, 50.0),
            (1, 1, "EU", "bio", 2, 30.0), (3, 2, None, "bio", 0, 0.0), (4, 3, "AS", "bio", 4, 40.0)]
    return spark.createDataFrame(data, "entity bigint, country int, region string, field string, "
                                       "docs bigint, citations double")


def test_country_performance(spark, ef):
    got = {r["field"]: r for r in Q.country_performance(ef, 1, [1, 2]).collect()}
    assert got["math"]["n_entities"] == 2 and got["math"]["best_rank"] == 1
    assert got["math"]["n_top_1"] == 2  # tie at the top: both rank 1
    assert got["bio"]["mean_rank"] == 2.0
    assert Q.country_performance(ef, 99).count() == 0


def test_global_overview_exact_and_approx(spark, ef):
    e = Q.global_overview(ef).first()
    assert (e["n_entities"], e["n_countries"], e["n_fields"], e["docs"]) == (4, 3, 2, 22)
    a = Q.global_overview(ef, approx=True).first()
    assert a["n_entities"] == 4


def test_multi_dim_tells_subtotal_null_from_data_null(spark, ef):
    r = Q.multi_dim(ef, ["region", "field"], "rollup").collect()
    data_null = [x for x in r if x["region"] is None and x["gid"] == 0]
    subtotal = [x for x in r if x["region"] is None and x["gid"] == 3]
    assert data_null and len(subtotal) == 1 and subtotal[0]["n_rows"] == 6
    sets = Q.multi_dim(ef, ["region", "field"], [["field"], []]).collect()
    assert sorted(x["gid"] for x in sets) == [2, 2, 3]


def test_top_regions(spark, ef):
    top = Q.top_regions(ef, 1, by=["field"]).collect()
    assert {(r["field"], r["region"]) for r in top} == {("math", "EU"), ("bio", "AS")}
    overall = Q.top_regions(ef, 5).orderBy("rk").collect()
    assert [r["rk"] for r in overall] == [1, 2, 3] and overall[0]["region"] == "EU"


def test_ratio_and_pair_relation(spark, ef):
    r = {x["field"]: x for x in A.ratio_metric(ef, "citations", "docs", ["field"]).collect()}
    assert r["math"]["ratio"] == pytest.approx(250 / 16)
    p = A.pair_relation(ef.withColumn("y", F.col("docs") * 2 + 1), "docs", "y").first()
    assert (p["n"], p["r"], p["slope"], p["intercept"]) == (6, pytest.approx(1.0), pytest.approx(2.0),
                                                          pytest.approx(1.0))
    flat = A.pair_relation(ef.withColumn("x", F.lit(1.0)), "x", "docs").first()
    assert flat["slope"] is None and flat["r"] is None


def test_sort_and_top_k_ties(spark, ef):
    s = [r["entity"] for r in A.sort_by(ef, "citations", ["entity", "field"]).collect()]
    assert s[:2] == [1, 2]
    t = A.top_k(ef, "citations", 3, ["entity", "field"]).orderBy("rk").collect()
    assert [(r["entity"], r["field"]) for r in t] == [(1, "math"), (2, "math"), (3, "math")]
