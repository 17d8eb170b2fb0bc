"""Rank engine: every split mode equals plain windows, with ties, NULLs,
one-row groups and NULL group keys."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from rankforge.operators.ranking import exact_quantiles, rank_columns, rank_within, top_k, top_k_per_group

OUTS = {"rk": "rank", "drk": "dense_rank", "rn": "row_number", "prk": "percent_rank", "tile": ("ntile", 3)}


@pytest.fixture(scope="module")
def ties(spark):
    rnd = random.Random(7)
    data = []
    for i in range(400):
        g = rnd.choice(["a", "b", "c", None])
        v = rnd.choice([None, 1.0, 2.0, 2.0, 3.5, float(rnd.randint(0, 20))])
        data.append((g, v, i))
    data.append(("solo", 5.0, 1000))
    schema = T.StructType([T.StructField("g", T.StringType()), T.StructField("v", T.DoubleType()),
                           T.StructField("id", T.LongType())])
    return spark.createDataFrame(data, schema).repartition(5)


def _expected(df, by, ascending=False):
    return rank_columns(df, by, "v", OUTS, ascending=ascending, ties=["id"], buckets=None)


@pytest.mark.parametrize("mode", [{"buckets": 4}, {"buckets": 2}, {"buckets": "auto", "max_group_rows": 10}])
@pytest.mark.parametrize("ascending", [False, True])
def test_split_equals_plain(spark, ties, mode, ascending):
    got = rank_columns(ties, ["g"], "v", OUTS, ascending=ascending, ties=["id"], **mode)
    exp = _expected(ties, ["g"], ascending)
    cols = ["g", "id", "rk", "drk", "rn", "prk", "tile"]
    assert rows(got, cols) == rows(exp, cols)


def test_global_rank_equals_plain(spark, ties):
    got = rank_columns(ties, [], "v", {"rk": "rank", "drk": "dense_rank"})
    exp = ties.select("id", F.rank().over(__import__("pyspark.sql").sql.Window.orderBy(
        F.col("v").desc_nulls_last())).alias("rk"))
    assert rows(got, ["id", "rk"]) == rows(exp, ["id", "rk"])


def test_ranks_are_1_to_n_with_ties(spark, ties):
    r = rank_within(ties, ["g"], "v", "row_number", ties=["id"], buckets=3, out="rn")
    per = {}
    for g, rn in rows(r, ["g", "rn"]):
        per.setdefault(g, []).append(rn)
    for g, ns in per.items():
        assert sorted(ns) == list(range(1, len(ns) + 1)), g


def test_partition_independence(spark, ties):
    cols = ["g", "id", "rk", "drk", "rn"]
    outs = {k: OUTS[k] for k in ("rk", "drk", "rn")}
    base = rows(rank_columns(ties.coalesce(1), ["g"], "v", outs, ties=["id"], buckets=4), cols)
    for n in (4, 7):
        assert rows(rank_columns(ties.repartition(n), ["g"], "v", outs, ties=["id"], buckets=4), cols) == base


def test_row_number_needs_ties(spark, ties):
    with pytest.raises(ValueError):
        rank_within(ties, ["g"], "v", "row_number")


def test_exact_quantiles_match_percentile(spark, ties):
    q = exact_quantiles(ties, "v", [0.0, 0.25, 0.5, 0.9, 1.0], ["g"], names=["a", "b", "c", "d", "e"], buckets=3)
    exp = ties.filter(F.col("v").isNotNull()).groupBy("g").agg(
        F.count("v").alias("n"), F.percentile("v", [0.0, 0.25, 0.5, 0.9, 1.0]).alias("p"))
    exp = exp.select("g", "n", *[F.col("p")[i].alias(c) for i, c in enumerate("abcde")])
    got = {r["g"]: r for r in q.collect()}
    for r in exp.collect():
        for c in ["n", *"abcde"]:
            assert got[r["g"]][c] == pytest.approx(r[c], rel=1e-12), (r["g"], c)


def test_top_k_and_top_k_per_group(spark, ties):
    t = top_k(ties.filter(F.col("v").isNotNull()), "v", 5, ["id"])
    assert [r["rk"] for r in t.orderBy("rk").collect()] == [1, 2, 3, 4, 5]
    g = top_k_per_group(ties, ["g"], "v", 2, ["id"])
    counts = {r["g"]: r["count"] for r in g.groupBy("g").count().collect()}
    assert counts["solo"] == 1 and all(v <= 2 for v in counts.values())


def test_global_rank_window_is_partitioned(spark, ties, capsys):
    """The data-row window of a whole-table rank is partitioned by bucket."""
    rank_within(ties, [], "v").explain()
    plan = capsys.readouterr().out
    windows = [ln for ln in plan.splitlines() if "Window [" in ln and "rank(" in ln]
    assert windows and all("__b" in ln for ln in windows)


def test_hot_group_split_matches_duckdb(spark):
    """lineitem ranked inside l_returnflag (one flag holds about half of the
    rows) with a small task limit, so the hot groups take the bucket path."""
    import duckdb
    path = "/root/testdata/sf0.01/lineitem.parquet"
    li = spark.read.parquet(path).select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    got = rank_columns(li, ["l_returnflag"], "l_extendedprice", {"rk": "rank", "drk": "dense_rank"},
                       max_group_rows=5_000)
    exp = duckdb.sql(f"""SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice,
        RANK() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC) AS rk,
        DENSE_RANK() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC) AS drk
        FROM read_parquet('{path}')""").fetchall()
    cols = ["l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice", "rk", "drk"]
    assert rows(got, cols) == sorted(exp, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_hot_value_and_null_buckets_are_spread(spark):
    """A third of the rows NULL and a third on one value: ranks stay exact."""
    data = [(None if i % 3 == 0 else (5.0 if i % 3 == 1 else float(i)), i) for i in range(300)]
    df = spark.createDataFrame([("g", v, i) for v, i in data], "g string, v double, id bigint")
    outs = {"rk": "rank", "drk": "dense_rank", "prk": "percent_rank"}
    got = rank_columns(df, ["g"], "v", outs, buckets=4)
    exp = rank_columns(df, ["g"], "v", outs, buckets=None)
    assert rows(got, ["id", "rk", "drk", "prk"]) == rows(exp, ["id", "rk", "drk", "prk"])
    glob = rank_columns(df, [], "v", outs)
    assert rows(glob, ["id", "rk", "drk", "prk"]) == rows(exp, ["id", "rk", "drk", "prk"])


@pytest.mark.parametrize("buckets", [2, 4, "auto"])
def test_exact_quantiles_with_hot_value(spark, buckets):
    vals = [7.0] * 120 + [float(i) for i in range(60)] + [None] * 10
    df = spark.createDataFrame([("g" if i % 4 else "h", v) for i, v in enumerate(vals)], "k string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    exp = df.filter("v is not null").groupBy("k").agg(F.percentile("v", probs).alias("p")).collect()
    got = {r["k"]: r for r in exact_quantiles(df, "v", probs, ["k"], names=list("abcdefg"), buckets=buckets).collect()}
    for r in exp:
        for i, c in enumerate("abcdefg"):
            assert got[r["k"]][c] == pytest.approx(r["p"][i], rel=1e-12)
    glob = exact_quantiles(df, "v", [0.5], names=["m"], buckets=buckets).first()
    assert glob["m"] == pytest.approx(df.filter("v is not null").agg(F.percentile("v", 0.5)).first()[0])


def test_split_without_broadcast_small_tables(spark, ties, monkeypatch):
    """Budgets forced to tiny values: bounds and bucket counts take the
    shuffle-join path and the ranks stay exact."""
    import rankforge.functions.joins as J
    import rankforge.operators.ranking as R
    monkeypatch.setattr(R, "BOUNDS_BUDGET", 3)
    monkeypatch.setattr(J, "BROADCAST_ROWS", 2)
    outs = {"rk": "rank", "drk": "dense_rank", "rn": "row_number"}
    got = R.rank_columns(ties, ["g"], "v", outs, ties=["id"], max_group_rows=10)
    exp = R.rank_columns(ties, ["g"], "v", outs, ties=["id"], buckets=None)
    assert rows(got, ["id", "rk", "drk", "rn"]) == rows(exp, ["id", "rk", "drk", "rn"])
    q = R.exact_quantiles(ties, "v", [0.5], ["g"], names=["m"], buckets=4)
    e = R.exact_quantiles(ties, "v", [0.5], ["g"], names=["m"], buckets=None)
    assert rows(q) == rows(e)
