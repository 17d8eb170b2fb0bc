"""Rows with gaps: what is refused, what passes through, what is matched."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from rankforge import session
from rankforge.functions import joins
from rankforge.operators import cleaning as C
from rankforge.operators import clustering as U
from rankforge.operators import features as Fe
from rankforge.operators import prediction as P
from rankforge.operators import ranking
from rankforge.operators import records as R
from rankforge.operators import warehouse as W
from rankforge.operators.dedup import first_per_key
from rankforge.operators.ranking import rank_columns
from rankforge.plans import audit
from rankforge.sources import read_csv_glob


@pytest.mark.parametrize("hot", [10, 0])
def test_a_null_never_wins_an_order(spark, hot):
    df = spark.createDataFrame([("a", None, 1), ("a", 9, 2), ("a", -2 ** 63, 3), ("b", None, 4)], "k string, seq long, v int")
    for asc, want in ((False, 2), (True, 3)):
        first, rest = first_per_key(df, ["k"], [("seq", asc)], max_key_rows=hot)
        assert rows(first, ["k", "v"]) == [("a", want), ("b", 4)] and rest.count() == 2


def test_changes_need_a_sequence_and_unkeyed_rows_stay(spark):
    base = spark.createDataFrame([(1, "x"), (None, "y"), (None, "z")], "k long, v string")
    ch = spark.createDataFrame([(1, "n", 5, "U")], "k long, v string, seq long, op string")
    assert rows(R.apply_changes(base, ch, ["k"])) == [(1, "n"), (None, "y"), (None, "z")]
    with pytest.raises(ValueError):
        R.apply_changes(base, ch.withColumn("seq", F.lit(None).cast("long")), ["k"])


def test_composite_keys_are_trimmed_and_whole(spark):
    s = spark.createDataFrame([("a", "b", 1), ("a", "b ", 2), ("a", None, 3), (" ", "b", 4)], "x string, y string, v int")
    got = W.migrate_dimension(s, ["x", "y"], ["v"], ["v"]).collect()
    assert [(r.x, r.y, r.v, r.n_variants) for r in got] == [("a", "b", 1, 2)]


def test_padded_text_finds_its_dimension(spark):
    s = spark.createDataFrame([(" Math",), ("Math ",), (None,)], "f string")
    facts, orphans = W.migrate_facts(s, [("f", W.seed_dimension(s, "f"), "f", "value", "key")], [])
    assert facts.count() == 2 and orphans.count() == 1


def test_profiles_keep_null_keys(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (None, "a", 3.0), (1, None, 4.0)], "entity long, field string, citations double")
    assert Fe.field_profile(df).count() == 3
    with pytest.raises(ValueError):
        Fe.profile_matrix(df)
    got = Fe.profile_matrix(df, null_field="f_none")
    assert rows(got, ["entity", "f_a", "f_none"]) == [(1, 2.0, 4.0), (None, 3.0, 0.0)]


def test_fixed_start_refuses_gaps(spark):
    df = spark.createDataFrame([(1, 0.0), (2, None)], "id long, x double")
    with pytest.raises(ValueError):
        U.kmeans_fixed_start(df, "id", ["x"], [[0.0]], 1)


def test_no_prediction_without_docs(spark):
    train = spark.createDataFrame([("f", 1, 1), ("f", 3, 2)], "field string, docs long, rank long")
    df = spark.createDataFrame([(1, "f", 2, 1), (2, "f", None, 2), (3, "new", 2, 3)], "entity long, field string, docs long, rank long")
    got = {r.entity: r for r in P.predict_ranks(P.fit_rank_linear(train), train, df).collect()}
    assert got[2].raw is None and got[2].predicted_rank is None and got[3].raw == 1.5 and got[1].raw >= 1


def test_tags_decode_percent_escapes_only(spark, tmp_path):
    for name in ("by_C++.csv", "by_a b.csv", "by_50%.csv"):
        (tmp_path / name).write_text("v\n1\n")
    got = read_csv_glob(spark, str(tmp_path), spark.createDataFrame([], "v int").schema, r"by_(.*)\.csv$")
    assert sorted(r.tag for r in got.collect()) == ["50%", "C++", "a b"]


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda **_: pytest.fail("no local folder on a cluster"))
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())
    Session.conf = {"spark.checkpoint.dir": "hdfs://x/y/"}
    assert session.checkpoint_root(Session()) == "hdfs://x/y"


RANKS = {"r": "rank", "d": "dense_rank", "n": "row_number", "p": "percent_rank", "t": ("ntile", 3)}


@pytest.mark.parametrize("by", [["g"], []])
def test_ranks_from_positions_equal_plain_windows(spark, by):
    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(
        [("a", 5.0)] * 30 + [("a", None)] * 7 + [(None, float(k % 4)) for k in range(20)] + [("c", 1.0), ("b", None)])],
        "g string, v double, i int").repartition(5)
    want = rank_columns(df, by, "v", RANKS, ties=["i"], total_col="tot", buckets=None) if by else \
        rank_columns(df.withColumn("one", F.lit(1)), ["one"], "v", RANKS, ties=["i"], total_col="tot", buckets=None).drop("one")
    got = rank_columns(df, by, "v", RANKS, ties=["i"], total_col="tot", max_group_rows=10)
    assert sorted(got.columns) == sorted(want.columns) and rows(got, want.columns) == rows(want)


@pytest.fixture
def small_splits(spark):
    """Small inputs stay in many partitions, so that rows per task can be told."""
    own = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0",
           "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("values", [[7.0] * 4000, [None] * 4000, [7.0] * 2000 + [None] * 2000])
@pytest.mark.parametrize("methods", [{"r": "rank"}, {"n": "row_number"}])
def test_no_task_ranks_a_whole_hot_group(spark, small_splits, values, methods):
    df = spark.createDataFrame([("g", v, i % 3) for i, v in enumerate(values)], "g string, v double, t int").repartition(8)
    got = rank_columns(df, ["g"], "v", methods, ties=["t"], max_group_rows=500)
    per_task = [r[0] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*")).select("count(1)").collect()]
    assert sum(per_task) == 4000 and max(per_task) < 2000


def test_equal_rows_of_one_column_are_spread(spark, small_splits):
    df = spark.createDataFrame([(1.0,)] * 4000, "v double").repartition(8)
    got = rank_columns(df, [], "v", {"r": "rank"})
    per_task = got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    assert per_task < 2000 and got.where("r != 1").count() == 0


def test_quantiles_past_the_bounds_budget(spark, monkeypatch):
    df = spark.createDataFrame([(i % 3, float(i * 7 % 101)) for i in range(300)], "g int, v double")
    want = rows(ranking.exact_quantiles(df, "v", [0.25, 0.5], ["g"], buckets=None))
    monkeypatch.setattr(ranking, "MAX_GROUP_ROWS", 10)
    monkeypatch.setattr(ranking, "BOUNDS_BUDGET", 5)
    assert rows(ranking.exact_quantiles(df, "v", [0.25, 0.5], ["g"])) == want


@pytest.fixture
def no_guess(spark):
    """Spark broadcasts only what it is told to."""
    own = {"spark.sql.autoBroadcastJoinThreshold": "100", "spark.sql.adaptive.autoBroadcastJoinThreshold": "100"}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield
    for k in own:
        spark.conf.unset(k)


def test_small_aggregates_come_back_without_a_shuffle_of_the_data(spark, no_guess):
    df = spark.createDataFrame([("g" if i % 3 else None, float(i), i) for i in range(90)], "g string, v double, i long")
    part = spark.createDataFrame([("g",)], "g string")
    frames = [
        C.impute(df, {"v": "mean"}, by=["g"]), Fe.encode_categories(df, df, ["g"], "target", "v"),
        P.raw_prediction(P.fit_rank_linear(df, "i", "v", ["g"]), df, df, "i", "v", ["g"]),
        W.migrate_facts(df, [("g", W.seed_dimension(part, "g"), "g", "value", "key")], ["i"])[0]]
    for f in frames:
        plan = audit.plan_text(f)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, plan
    for f in (C.histogram(df, "v", 5, by=["g"]), C.boxplot_stats(df, "v", ["g"])):
        assert "SortMergeJoin" not in audit.plan_text(f)
    assert C.histogram(df, "v", 5, by=["g"]).agg(F.sum("n")).first()[0] == 90


def test_a_large_aggregate_is_not_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(i, "x" * 50) for i in range(50)], "k long, s string")
    assert "broadcast" in joins.broadcast_if_small(df)._jdf.queryExecution().analyzed().toString().lower()
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1000)
    assert "hint" not in joins.broadcast_if_small(df)._jdf.queryExecution().analyzed().toString().lower()


def test_many_centres(spark):
    rng = np.random.default_rng(1)
    centres, v = rng.normal(size=(1500, 8)), rng.normal(size=(60, 8))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(90, None), (91, [1.0])], "id long, v array<double>")
    got = {r.id: r for r in U.assign_clusters(df, "id", "v", centres.tolist()).collect()}
    want = ((v[:, None] - centres[None]) ** 2).sum(2)
    assert [got[i].cluster for i in range(60)] == want.argmin(1).tolist()
    assert got[7].distance == pytest.approx(want[7].min() ** 0.5) and got[90].cluster is None and got[91].distance is None
