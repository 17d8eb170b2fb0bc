"""Property tests (hypothesis) and partition independence of exact operators."""

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from rankforge.operators import citations as A
from rankforge.operators import cleaning as C
from rankforge.operators import records as R
from rankforge.operators.clustering import kmeans_fixed_start
from rankforge.operators.dedup import first_per_key
from rankforge.operators.ranking import exact_quantiles, rank_columns

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
values = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.one_of(st.none(), st.integers(0, 6))),
                  min_size=1, max_size=60)


@SETTINGS
@given(data=values, buckets=st.sampled_from([2, 3, 5]))
def test_rank_matches_pandas(spark, data, buckets):
    rows_ = [(g, None if v is None else float(v), i) for i, (g, v) in enumerate(data)]
    df = spark.createDataFrame(rows_, "g string, v double, id bigint")
    got = rank_columns(df, ["g"], "v", {"rk": "rank", "drk": "dense_rank"}, buckets=buckets)
    pdf = pd.DataFrame(rows_, columns=["g", "v", "id"])
    pdf["rk"] = pdf.groupby("g")["v"].rank(method="min", ascending=False, na_option="bottom").astype(int)
    pdf["drk"] = pdf.groupby("g")["v"].rank(method="dense", ascending=False, na_option="bottom").astype(int)
    exp = sorted((r.id, r.rk, r.drk) for r in pdf.itertuples())
    assert sorted((r["id"], r["rk"], r["drk"]) for r in got.collect()) == exp


@SETTINGS
@given(data=values, bins=st.integers(1, 7))
def test_histogram_counts_sum_to_non_null(spark, data, bins):
    df = spark.createDataFrame([(g, None if v is None else float(v)) for g, v in data], "g string, v double")
    h = C.histogram(df, "v", bins).collect()
    assert sum(r["n"] for r in h) == sum(1 for _, v in data if v is not None)
    assert all(0 <= r["bin"] < bins for r in h)


@SETTINGS
@given(data=values)
def test_first_per_key_partitions_the_input(spark, data):
    df = spark.createDataFrame([(g, v, i % 3) for i, (g, v) in enumerate(data)], "g string, v int, w int")
    first, rest = first_per_key(df, ["g"], [("w", True)])
    assert first.count() == len({g for g, _ in data})
    assert rows(first.unionByName(rest)) == rows(df)
    # every key above 2 rows takes the aggregate (hot-key) path: same answer
    hf, hr = first_per_key(df, ["g"], [("w", True)], max_key_rows=2)
    assert rows(hf) == rows(first) and rows(hr) == rows(rest)


def test_apply_changes_is_idempotent(spark):
    base = spark.createDataFrame([(i, f"n{i}", float(i)) for i in range(20)], "k bigint, name string, v double")
    ch = spark.createDataFrame([(i % 7, None, float(100 + i), i, "U" if i % 5 else "D") for i in range(30)] +
                               [(100 + i, f"x{i}", 1.0, 50 + i, "I") for i in range(3)],
                               "k bigint, name string, v double, seq bigint, op string")
    once = R.apply_changes(base, ch, ["k"], partial=True)
    assert rows(R.apply_changes(once, ch, ["k"], partial=True)) == rows(once)


@pytest.mark.parametrize("n", [1, 4, 7])
def test_partition_independence(spark, n):
    src = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice")
    df = src.repartition(n)
    ref = src.coalesce(1)

    def outputs(d):
        s = A.stats_by(d.withColumn("c", F.col("l_extendedprice").cast("decimal(18,2)")),
                       ["l_suppkey"], entity="l_orderkey", docs="l_quantity", citations="c")
        q = exact_quantiles(d, "l_extendedprice", [0.25, 0.5], ["l_suppkey"], buckets=3)
        f, r = first_per_key(d, ["l_orderkey", "l_linenumber"], [("l_extendedprice", False)])
        pts = d.groupBy("l_suppkey").agg(F.count("*").cast("double").alias("x"),
                                         F.sum("l_quantity").alias("y"))
        km, _ = kmeans_fixed_start(pts, "l_suppkey", ["x", "y"], [[1.0, 1.0], [10.0, 200.0]], 3)
        return [rows(s), rows(q), rows(f), rows(r), rows(km)]

    assert outputs(df) == outputs(ref)


def test_first_per_key_hot_keys_not_broadcast(spark, monkeypatch):
    import rankforge.functions.joins as J
    import rankforge.operators.dedup as D
    monkeypatch.setattr(J, "BROADCAST_ROWS", 0)
    df = spark.createDataFrame([(i % 4, i % 7, i) for i in range(60)], "k int, v int, w int")
    f1, r1 = D.first_per_key(df, ["k"], [("v", False)], max_key_rows=5)
    f2, r2 = D.first_per_key(df, ["k"], [("v", False)])
    assert rows(f1) == rows(f2) and rows(r1) == rows(r2)
