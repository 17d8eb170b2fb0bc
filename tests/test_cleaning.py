"""C1-C6, F1 on hand-made frames: gaps, flat, ties."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from rankforge.operators import cleaning as C


@pytest.fixture(scope="module")
def gaps(spark):
    schema = T.StructType([T.StructField("g", T.StringType()), T.StructField("x", T.DoubleType()),
                           T.StructField("c", T.StringType())])
    data = [("a", 1.0, "p"), ("a", None, "q"), ("a", 3.0, " "), ("b", float("nan"), "p"),
            ("b", 4.0, None), ("b", 6.0, "q"), ("z", None, "r"), (None, 10.0, "p")]
    return spark.createDataFrame(data, schema)


def test_missing_profile(spark, gaps):
    got = {r["column"]: r for r in C.missing_profile(gaps).collect()}
    assert got["x"]["n_rows"] == 8 and got["x"]["n_missing"] == 2
    assert got["x"]["pct_missing"] == pytest.approx(25.0)
    blank = {r["column"]: r for r in C.missing_profile(gaps, treat_blank=True).collect()}
    assert blank["x"]["n_missing"] == 3 and blank["c"]["n_missing"] == 2


def test_missing_profile_empty_table(spark, gaps):
    got = C.missing_profile(gaps.limit(0)).collect()
    assert all(r["n_rows"] == 0 and r["pct_missing"] is None for r in got)


def test_impute_group_then_global_fallback(spark, gaps):
    df = gaps.filter(~F.isnan("x") | F.col("x").isNull())
    r = {(row["g"], row["x_was_missing"]): row["x"]
         for row in C.impute(df, {"x": "mean"}, by=["g"]).collect()}
    assert r[("a", True)] == pytest.approx(2.0)       # group mean of 1 and 3
    assert r[("z", True)] == pytest.approx((1 + 3 + 4 + 6 + 10) / 5)  # all-NULL group: global


def test_impute_median_mode_constant(spark, gaps):
    df = gaps.filter(~F.isnan("x") | F.col("x").isNull())
    med = C.impute(df, {"x": "median"}).filter("x_was_missing").select("x").distinct().collect()
    assert [r[0] for r in med] == [4.0]
    mode = C.impute(df, {"c": "mode"}).filter("c_was_missing").collect()
    assert mode[0]["c"] == "p"  # p appears 3 times
    const = C.impute(df, {"c": ("constant", "none")}).filter("c_was_missing").collect()
    assert const[0]["c"] == "none"


def test_mode_ties_take_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert C.impute(df, {"c": "mode"}).filter("c_was_missing").first()["c"] == "a"


def test_numeric_summary_flat_and_quartiles(spark):
    df = spark.createDataFrame([(5.0,)] * 4 + [(None,)], "x double")
    r = C.numeric_summary(df, ["x"]).first()
    assert (r["n"], r["mean"], r["sd"], r["q1"], r["median"], r["q3"]) == (4, 5.0, 0.0, 5.0, 5.0, 5.0)
    df2 = spark.createDataFrame([(float(i),) for i in range(1, 11)], "x double")
    r2 = C.numeric_summary(df2, ["x"]).first()
    assert (r2["q1"], r2["median"], r2["q3"]) == (3.25, 5.5, 7.75)


def test_histogram_counts_sum_and_flat(spark, gaps):
    h = C.histogram(gaps, "x", 3)
    assert sum(r["n"] for r in h.collect()) == 5  # NULL and NaN left out
    flat = C.histogram(spark.createDataFrame([(2.0,)] * 3, "x double"), "x", 4).collect()
    assert [(r["bin"], r["n"]) for r in flat] == [(0, 3)]
    filled = C.histogram(gaps, "x", 5, fill=True).collect()
    assert sorted(r["bin"] for r in filled) == [0, 1, 2, 3, 4]


def test_boxplot_outliers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([("g", v) for v in vals], "g string, v double")
    r = C.boxplot_stats(df, "v", ["g"]).first()
    assert r["n_outliers"] == 1 and r["hi_whisker"] == 5.0 and r["lo_whisker"] == 1.0


def test_correlation_matrix(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 4.0, 3.0), (3.0, 6.5, 3.0)], "a double, b double, c double")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in C.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "a")] == 1.0 and got[("c", "c")] is None and got[("a", "c")] is None
    assert got[("a", "b")] == pytest.approx(0.997949, abs=1e-5)
    assert len(got) == 6


def test_clean_records_reasons_and_totals(spark):
    raw = spark.createDataFrame(
        [(" 1", "a ", "1,234"), ("1", "b", "5"), ("2", "c", "x1"), (None, "d", "3"), ("N/A", "e", "4"),
         ("3", "f", "7"), ("3", "f", "7")], "id string, name string, n string")
    clean, dropped = C.clean_records(raw, ["id"], casts={"id": "bigint", "n": "bigint"}, order=[("n", False)])
    c = rows(clean)
    assert c == [(1, "a", 1234), (3, "f", 7)]
    reasons = sorted(r["reason"] for r in dropped.collect())
    assert reasons == ["bad_value", "null_key", "null_key", "repeat", "repeat"]
    assert clean.count() + dropped.count() == raw.count()


def test_correlation_is_over_pairs_whatever_the_width(spark):
    df = spark.createDataFrame([(float(i), None if i % 3 == 0 else 2.0 * i + 1, float(i * i % 7)) for i in range(30)],
                               "a double, b double, c double")
    r = {(x["col_a"], x["col_b"]): x["r"] for x in C.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert r["a", "b"] == pytest.approx(1.0)  # a line, half of it missing
    wide = df.select("a", "b", *[F.col("c").alias(f"c{i}") for i in range(29)])
    w = {(x["col_a"], x["col_b"]): x["r"] for x in C.correlation_matrix(wide, wide.columns).collect()}
    assert len(w) == 31 * 32 // 2 and w["a", "b"] == pytest.approx(1.0) and w["b", "c7"] == pytest.approx(r["b", "c"])


def test_dropped_records_keep_their_text(spark):
    df = spark.createDataFrame([("1", " 5 "), ("1", "x9"), (" ", "4"), ("2", None)], "k string, v string")
    clean, dropped = C.clean_records(df, ["k"], casts={"v": "int"})
    assert sorted((r.k, r.v) for r in clean.collect() if r.v is not None) == [("1", 5)]
    assert sorted(tuple(r) for r in dropped.collect()) == [(" ", "4", "null_key"), ("1", "x9", "bad_value")]


def test_summary_of_a_column_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    got = {r["column"]: r for r in C.numeric_summary(df, ["a", "b"]).collect()}
    assert got["b"]["n"] == 0 and got["b"]["median"] is None and got["a"]["n"] == 2


def test_mean_fill_leaves_out_nan(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", float("nan")), ("g", None)], "g string, x double")
    got = [r["x"] for r in C.impute(df, {"x": "mean"}, by=["g"]).collect() if r["x_was_missing"]]
    assert got == [1.0]
