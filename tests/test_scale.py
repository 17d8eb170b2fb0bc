"""Forms for large tables: rank buckets, names, wide correlations, lattices, sketches, stores, neighbours, dictionaries."""

import json
import math
import os
import random
import subprocess
import sys
import time
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01, rows
from rankforge import session
from rankforge.functions import joins
from rankforge.operators import cleaning as C
from rankforge.operators import clustering as U
from rankforge.operators import encoding as E
from rankforge.operators import graph
from rankforge.operators import keyed_store as K
from rankforge.operators import names as N
from rankforge.operators import prediction as P
from rankforge.operators import ranking as R
from rankforge.operators import records
from rankforge.operators import reports as Q
from rankforge.operators import sketches as S
from rankforge.operators import warehouse as W
from rankforge.session import scratch_path
from rankforge.sources import export_json


# ---- rank engine

@pytest.mark.parametrize("buckets", [32, 1024, 4096])
def test_planning_time_does_not_follow_the_buckets(spark, buckets):
    df = spark.range(5000).select("id", (F.col("id") * 7919 % 4999).cast("double").alias("v"), (F.col("id") % 2).alias("g"))
    for by in ([], ["g"]):
        ranked = R.rank_columns(df, by, "v", {"r": "rank"}, buckets=buckets)
        t = time.time()
        ranked._jdf.queryExecution().executedPlan()
        assert time.time() - t < 2
        plain = R.rank_columns(df, by, "v", {"r": "rank"}, buckets=None) if by else R.rank_columns(df, by, "v", {"r": "rank"}, buckets=2)
        assert rows(ranked) == rows(plain)


def test_ranks_of_other_types(spark):
    data = [(i, ["b", "a", None, "c"][i % 4], i % 3) for i in range(40)]
    df = spark.createDataFrame(data, "i int, t string, g int").withColumn("d", F.expr("date_add(DATE'2020-01-01', i % 7)")) \
        .withColumn("n", F.when(F.col("i") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("i") % 6)).withColumn("big", F.lit(1 << 60) + F.col("i") % 3)
    outs = {"r": "rank", "k": "dense_rank"}
    for metric, asc in (("t", True), ("d", False), ("n", False), ("n", True), ("big", False)):
        want = R.rank_columns(df, ["g"], metric, outs, ascending=asc, buckets=None)
        got = R.rank_columns(df, ["g"], metric, outs, ascending=asc, **({"max_group_rows": 5} if asc else {"buckets": 4}))
        assert rows(got, ["i", "r", "k"]) == rows(want, ["i", "r", "k"])


def test_too_many_bounds_go_by_position(spark, monkeypatch):
    monkeypatch.setattr(R, "BOUNDS_BUDGET", 8)
    df = spark.createDataFrame([(i % 5, float(i * 31 % 17)) for i in range(100)], "g int, v double")
    assert rows(R.rank_columns(df, ["g"], "v", {"r": "rank"}, buckets=4)) == rows(R.rank_columns(df, ["g"], "v", {"r": "rank"}, buckets=None))
    assert rows(R.exact_quantiles(df, "v", [0.5], ["g"], buckets=4)) == rows(R.exact_quantiles(df, "v", [0.5], ["g"], buckets=None))


def test_nan_is_largest_for_first_per_key(spark):
    from rankforge.operators.dedup import first_per_key
    df = spark.createDataFrame([(1, 5.0), (1, float("nan")), (1, None), (2, None), (2, -1.0)], "k int, v double")
    for limit in (100, 1):
        first, _ = first_per_key(df, ["k"], [("v", False)], max_key_rows=limit)
        assert {r.k: str(r.v) for r in first.collect()} == {1: "nan", 2: "-1.0"}


# ---- names

def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_canonical_name(spark):
    cases = {"  Université de  Montréal ": "universite de montreal", "O'Higgins–Univ.": "ohiggins univ", "AT&T": "at and t", "": None, " .- ": None, None: None,
             "Łódź Straße": "lodz strasse", unicodedata.normalize("NFD", "Åbo Ärlig"): "abo arlig", "東京 大学!": "東京 大学", "MIT\n2": "mit 2"}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "name string, want string")
    assert [tuple(r) for r in df.select(N.canonical_name("name"), "want").collect()] == [(v, v) for v in cases.values()]


@pytest.mark.parametrize("d", [1, 2])
def test_name_variants_equal_brute_force(spark, d):
    rng = random.Random(d)
    names = set()
    while len(names) < 120:
        base = rng.choice(["college of arts", "institut curie", "unit 12 north", "unit 13 north", "aaaaa", "abc"])
        t = list(base)
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(t))
            t[i: i + rng.randrange(2)] = [rng.choice("abcn")] * rng.randrange(2)
        names.add("".join(t).strip() or "x")
    got = {(r.u, r.v) for r in N.name_variants(spark.createDataFrame([(n,) for n in [*names, *list(names)[:9], None]], "canonical string"), max_distance=d).collect()}
    digits = {n: "".join(c if c.isdigit() else " " for c in n).split() for n in names}
    want = {(a, b) for a in names for b in names if a > b and len(a) >= 5 and len(b) >= 5 and digits[a] == digits[b] and _distance(a, b) <= d}
    assert got == want and len(want) > 20


def test_normalize_names(spark):
    given = ["Uni Köln"] * 5 + ["uni koln", "UNI KOLNN", "Uni Bonn", None, "", "unit 1 x", "unit 2 x"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(given)], "i int, name string")
    got = {r.i: r for r in N.normalize_names(df, "name", 1).collect()}
    assert len({got[i].name_id for i in range(7)}) == 1 and got[6].name_label == "Uni Köln" and got[6].name_canonical == "uni kolnn"
    assert got[7].name_id != got[0].name_id and got[8].name_id is None is got[9].name_label
    assert got[10].name_id != got[11].name_id
    assert len({r.name_id for r in N.normalize_names(df, "name").collect()}) == 6
    clean, _ = C.clean_records(df, ["i"], names={"name": 1})
    assert {r.i: r.name_id for r in clean.collect()} == {i: r.name_id for i, r in got.items()}
    with pytest.raises(ValueError):
        N.name_variants(df.withColumnRenamed("name", "canonical"), max_distance=3)


def test_no_block_of_all_pairs(spark):
    """A thousand names that share their first words meet only near ones."""
    letters = "bcdfghjklm"
    names = [f"university of {a}{b}{c}{a}{b}{c}" for a in letters for b in letters for c in letters]
    v = N.name_variants(spark.createDataFrame([(n,) for n in names], "canonical string"))
    assert v.count() == 0
    keyed = spark.createDataFrame([(n,) for n in names], "n string").select("n", F.explode(N._deletions(F.col("n"), 1)).alias("k"))
    assert keyed.groupBy("k").count().agg(F.max("count")).first()[0] <= 2


def test_components(spark):
    links = [("b", "a"), ("c", "b"), ("z", "y"), ("q", "q"), ("c", "b")] + [(f"n{i + 1:02}", f"n{i:02}") for i in range(30)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "u string, v string")).collect()}
    assert got == {**{x: "a" for x in "abc"}, "y": "y", "z": "y", **{f"n{i:02}": "n00" for i in range(31)}}
    assert graph.components(spark.createDataFrame([], "u string, v string")).count() == 0


# ---- wide correlations

def test_wide_correlations(spark):
    rng = np.random.default_rng(4)
    n, k = 300, 60
    x = rng.normal(size=(n, k)) * 10.0 ** rng.integers(-3, 6, size=k) + 1000 * rng.normal(size=k)
    x[:, 5] = 7.0
    x[:, 6] = x[:, 7] * -2
    gone = rng.random((n, k)) < 0.3
    gone[:, 9] = True
    gone[1:, 10] = True
    x[3, 11], gone[3, 11] = np.inf, False
    data = [[None if gone[i, j] else float(x[i, j]) for j in range(k)] for i in range(n)]
    cols = [f"c{j}" for j in range(k)]
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in cols)).repartition(4)
    got = {(r.col_a, r.col_b): r.r for r in C.correlation_matrix(df, cols).collect()}
    assert len(got) == k * (k + 1) // 2
    for i in range(k):
        for j in range(i, k):
            both = ~gone[:, i] & ~gone[:, j]
            a, b = x[both, i], x[both, j]
            r = got[f"c{i}", f"c{j}"]
            if not np.isfinite(a).all() or not np.isfinite(b).all():
                assert r is not None and np.isnan(r)
            elif len(a) < 2 or (a == a[0]).all() or (b == b[0]).all():
                assert r is None
            else:
                assert r == pytest.approx(1.0 if i == j else np.corrcoef(a, b)[0, 1], abs=1e-9)


@pytest.mark.parametrize("direct", [60, 0])
def test_nearly_constant_pairs_are_settled_exactly(spark, monkeypatch, direct):
    """Constant over the rows of the pair only: NULL, though not constant over all rows."""
    if not direct:  # through the blocks
        monkeypatch.setattr(C, "PAIRS_PER_JOB", 2)
    df = spark.createDataFrame([(5.0, 1.0, 1e9), (5.0, 2.0, 1e9 + 1e-3), (5.0, 3.0, 1e9), (6.0, None, 1e9 + 2e-3)], "a double, b double, c double")
    got = {(r.col_a, r.col_b): r.r for r in C.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] is None and got["a", "a"] == 1.0 and got["c", "c"] == 1.0
    assert got["b", "c"] == pytest.approx(0.0, abs=1e-3)
    assert {r.r for r in C.correlation_matrix(df.limit(0), ["a", "b", "c"]).collect()} <= {None}


# ---- contracts

def test_type_rows(spark):
    spec = W.TableSpec("t", {"k": "int", "v": "int", "w": "double"}, primary_key=("k",), required=("w",))
    text = spark.createDataFrame([("1", 1.0), ("x", 2.5), (None, None)], "k string, v double")
    got = {r["check"]: r.n_violations for r in W.conforms(text, spec).collect()}
    assert got == {"missing_column": 1, "wrong_type": 2, "bad_value": 2, "pk_dup": 1, "required_null": 3}
    fine = spark.createDataFrame([(1, 2, 3.0)], "k int, v int, w double")
    assert {r["check"]: r.n_violations for r in W.conforms(fine, spec).collect()} == {"pk_dup": 0, "required_null": 0}
    assert {r["check"] for r in W.verify({"t": fine}, [spec], schema=True).collect()} == {"missing_column", "wrong_type", "bad_value", "pk_dup", "required_null"}


# ---- lattice and sketches

@pytest.mark.parametrize("mode", ["rollup", "cube", [["a"], ["b", "a"], []]])
def test_lattice_equals_multi_dim(spark, mode):
    rng = random.Random(3)
    data = [(rng.choice(["x", "y", None]), rng.choice([1, 2]), rng.choice([None, *range(-3, 200_000, 1717)]), rng.randrange(9), float(rng.randrange(99))) for _ in range(400)]
    df = spark.createDataFrame(data, "a string, b int, e bigint, docs int, citations double")
    got = Q.multi_dim_lattice(df, ["a", "b"], mode, distinct="e")
    want = Q.multi_dim(df, ["a", "b"], mode)
    assert rows(got.drop("n_e")) == rows(want)
    for r in got.collect():
        own = {e for a, b, e, *_ in data if e is not None and (r.gid & 2 or a == r.a) and (r.gid & 1 or b == r.b)}
        assert r.n_e == len(own)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(Q.multi_dim_lattice(df, ["a", "b"], mode)) == rows(want)
    with pytest.raises(ValueError):
        Q.multi_dim_lattice(df, ["a"], distinct="citations")


def test_sketches(spark):
    df = spark.range(40_000).select((F.col("id") % 4).alias("g"), (F.col("id") % 7).alias("h"), (F.col("id") % 3000).alias("e"),
                                    F.when(F.col("id") % 4 != 3, (F.col("id") * 7919 % 40_000).cast("double")).alias("v"))
    t = S.sketch_table(df, ["g", "h"], ["e"], ["v"])
    one = S.answers(S.merged(t), (0.1, 0.5)).first()
    assert one.n_rows == 40_000 and one.v_n == 30_000 and abs(one.n_e - 3000) <= 150
    assert abs(one.v_q50 / 40_000 - 0.5) < 0.02 and abs(one.v_q10 / 40_000 - 0.1) < 0.02
    by = {r.g: r for r in S.answers(S.merged(t, ["g"])).collect()}
    assert by[3].v_n == 0 and by[3].v_q50 is None and by[0].n_rows == 10_000
    assert S.answers(S.merged(S.sketch_table(df.limit(0), ["g"], ["e"], ["v"]), ["g"])).count() == 0


# ---- partitioned records

def test_store_rewrites_only_touched_partitions(spark):
    base = spark.createDataFrame([(i if i % 10 else None, f"v{i}") for i in range(500)], "k bigint, v string")
    path = scratch_path(spark, "store")
    K.create_store(base, path, ["k"], parts=32)
    def files():
        return {r[0] for r in K.read_store(spark, path).select(F.input_file_name()).distinct().collect()}

    before = files()
    ch = spark.createDataFrame([(1, "new", 1, "U"), (1, "newer", 2, "U"), (2, None, 3, "D"), (10_001, "added", 4, "I"), (None, "lost", 5, "I")],
                               "k bigint, v string, seq int, op string")
    assert K.change_store(ch, path) == 1
    want = records.apply_changes(base, ch, ["k"])
    assert rows(K.read_store(spark, path)) == rows(want)
    after = files()
    folder = lambda f: f.rpartition("/")[0]
    assert len({folder(f) for f in before - after}) <= 3 and len({folder(f) for f in after - before}) <= 4
    assert len(before & after) >= 0.8 * len(before)
    assert rows(K.read_store(spark, path, 0)) == rows(base)
    with pytest.raises(RuntimeError):  # a second writer that started from version 0
        K._publish(spark, path, 1, {})
    K.drop_versions(spark, path)
    assert rows(K.read_store(spark, path)) == rows(want)
    assert K.change_store(ch.limit(0), path) == 2 and rows(K.read_store(spark, path)) == rows(want)


def test_store_can_empty_a_partition(spark):
    path = scratch_path(spark, "store")
    K.create_store(spark.createDataFrame([(1, "a")], "k int, v string"), path, ["k"], parts=4)
    K.change_store(spark.createDataFrame([(1, None, 1, "D")], "k int, v string, seq int, op string"), path)
    assert K.read_store(spark, path).count() == 0


# ---- neighbours

@pytest.mark.parametrize("cells", [1, 5, None])
def test_similar_all_equals_brute_force(spark, cells):
    rng = random.Random(9)
    pts = [(i, float(rng.randrange(12)), float(rng.randrange(12))) for i in range(90)] + [(200 + i, 3.0, 3.0) for i in range(40)]
    odd = [(900, None, 1.0), (901, float("nan"), 1.0)]
    df = spark.createDataFrame(pts + odd, "id int, x double, y double").repartition(3)
    got = defaultdict(list)
    for r in U.similar_all(df, "id", ["x", "y"], 4, cells).orderBy("rk").collect():
        got[r.id].append((round(r.distance, 9), r.neighbour))
    for i, x, y in pts:
        want = sorted((round(((x - a) ** 2 + (y - b) ** 2) ** 0.5, 9), j) for j, a, b in pts if j != i)[:4]
        assert got[i] == want
    assert len(got) == len(pts)


def test_similar_all_has_no_cross_join(spark):
    df = spark.createDataFrame([(i, float(i), float(i * i % 7)) for i in range(50)], "id int, x double, y double")
    plan = U.similar_all(df, "id", ["x", "y"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert U.similar_all(df.limit(0), "id", ["x", "y"], 3).count() == 0
    assert U.similar_all(df.limit(2), "id", ["x", "y"], 3).count() == 2


NEAR = """
import sys
from pyspark.sql import SparkSession, functions as F
from rankforge.operators import clustering as U
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", sys.argv[1] + "/scratch").config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + sys.argv[1] + "/log")
         .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false").getOrCreate())
df = spark.range(12_000, numPartitions=2).select("id", F.randn(1).alias("x")).withColumn("y", 3 * F.col("x") + F.randn(2))
assert U.similar_all(df, "id", ["x", "y"], 5).count() == 60_000
spark.stop()
"""


def test_similar_all_keeps_no_pairs_in_a_task(tmp_path):
    (tmp_path / "log").mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", NEAR, str(tmp_path)], cwd=root, check=True, timeout=300)
    events = [json.loads(x) for f in (tmp_path / "log").iterdir() for x in f.read_text().splitlines()]
    tasks = [e["Task Metrics"] for e in events if e["Event"] == "SparkListenerTaskEnd"]
    assert max(t["Peak Execution Memory"] for t in tasks) < 128 << 20  # all candidate pairs, sorted, took several times that


@pytest.mark.parametrize("cells", [60, None])
def test_similar_all_with_equal_values_and_far_points(spark, cells):
    rng = random.Random(4)
    pts = [(i, rng.choice((0.0, 1000.0)), float(rng.randrange(400)), rng.choice((0.0, 0.0, 0.0, rng.paretovariate(0.4)))) for i in range(600)]
    odd = [(901, float("nan"), 1.0, 1.0), (902, float("inf"), 1.0, 1.0), (903, 1.0, float("-inf"), 1.0)]
    df = spark.createDataFrame(pts + odd, "id int, x double, y double, z double").repartition(3)
    got = defaultdict(list)
    for r in U.similar_all(df, "id", ["x", "y", "z"], 3, cells).orderBy("rk").collect():
        got[r.id].append((r.distance, r.neighbour))
    place = {i: p for i, *p in pts}
    assert got == {i: sorted((math.sqrt(sum((a - b) * (a - b) for a, b in zip(p, o))), j) for j, o in place.items() if j != i)[:3] for i, p in place.items()}


# ---- dictionaries, vectors, weights

def test_dictionary_of_many_values(spark):
    df = spark.range(60_000).select(F.concat(F.lit("v"), (F.col("id") % 30_000).cast("string")).alias("c"), F.lit(1).alias("x"))
    train = df.limit(50_000)
    out = E.with_index(df, E.frequency_index(train, "c"), 30_000, "c", "i")
    assert out.select(F.count_distinct("i")).first()[0] <= 30_001
    vec = E.one_hot(out.limit(5), "i", "v", 30_000)
    assert vec.schema["v"].metadata == {} and {r.v.size for r in vec.collect()} == {30_001}


def test_encoder_stage_saves_and_loads(spark):
    data = [("a", 1.0, 3.0), ("b", 2.0, 5.0), ("a", 3.0, 6.0), (None, 4.0, 9.0), ("c", 5.0, 1.0), ("c", 6.0, 2.0), ("c", 0.0, 2.0)]
    df = spark.createDataFrame(data, "c string, x double, rank double")
    model = P.train_rank_model(df, ["c"], ["x"], algo="linear")
    assert [n for n, _ in P.feature_weights(model, df)] == ["x", "c_vec_c", "c_vec_a", "c_vec_b", "c_vec___unseen"]
    path = scratch_path(spark, "model")
    P.save_model(model, path)
    new = spark.createDataFrame([("zzz", 1.0), ("b", 1.0), (None, 1.0)], "c string, x double")
    got = [r.prediction for r in P.load_model(path).transform(new).orderBy(F.col("c").desc_nulls_last()).collect()]
    assert got == [r.prediction for r in model.transform(new).orderBy(F.col("c").desc_nulls_last()).collect()]
    assert got[0] == pytest.approx(got[2])


def test_learned_vectors(spark):
    a, b = [0.5, 2.0, 1.0, 1.5], [1.0, 0.2, 2.0]
    data = [(i, j, float(np.expm1(2 + x * y))) for i, x in enumerate(a) for j, y in enumerate(b) if (i, j) != (0, 2)]
    df = spark.createDataFrame(data, "r int, c int, v double")
    v = E.learned_vectors(df, "r", "c", "v", rank=2, reg=0.001, steps=20)
    got = E.reconstruction(df, df.unionByName(spark.createDataFrame([(9, 1, 1.0)], "r int, c int, v double")), v, "r", "c", "v").collect()
    assert max(abs(np.log1p(r.v) - np.log1p(r.expected)) for r in got if r.r != 9) < 0.2
    mean = np.mean([np.log1p(x) for *_, x in data])
    assert [np.log1p(r.expected) for r in got if r.r == 9] == [pytest.approx(mean)]
    assert E.with_vectors(df, v["c"], "c", "w", 2).columns == ["r", "c", "v", "w_0", "w_1"]


def test_permuted_deals_the_same_values(spark):
    df = spark.createDataFrame([(i, i * 10) for i in range(200)], "k int, v int").repartition(5)
    got = P.permuted(df, "v", ["k"]).collect()
    assert Counter(r.v for r in got) == Counter(range(0, 2000, 10)) and sum(r.v != 10 * r.k for r in got) > 150
    assert sorted(map(tuple, got)) == sorted(map(tuple, P.permuted(df.repartition(2), "v", ["k"]).collect()))


def test_export_is_one_pass_and_takes_empty_tables(spark):
    df = spark.createDataFrame([], "a int, b array<int>")
    meta = export_json(df, scratch_path(spark, "empty")).collect()
    assert [(r.column, r.n_rows, r.n_missing, r.min) for r in meta] == [("a", 0, 0, None), ("b", 0, 0, None)]


def test_lineitem_is_joined_once(spark):
    from rankforge.plans.catalog import _f2, _q2
    for build in (_q2, _f2):
        plan = build(spark, SF01)._jdf.queryExecution().optimizedPlan().toString()
        assert "l_partkey" not in plan  # what is left reads the written table


def test_broadcast_needs_few_bytes(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 10)
    df = spark.createDataFrame([(i, "x" * 50) for i in range(5)], "i int, t string")
    assert "hint" not in joins.broadcast_if_small(df, written=True)._jdf.queryExecution().analyzed().toString().lower()


def test_scratch_can_be_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_root", lambda _: str(tmp_path))
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    session.clear_scratch(spark)
    assert not (tmp_path / "rankforge-scratch").exists()
