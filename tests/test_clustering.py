"""U1-U6 on four tight groups of points."""

import math

import pytest
from pyspark.sql import functions as F

from rankforge.operators import clustering as U

CENTRES = [(0.0, 0.0), (10.0, 0.0), (0.0, 10.0), (10.0, 10.0)]


@pytest.fixture(scope="module")
def points(spark):
    data, i = [], 0
    for cx, cy in CENTRES:
        for dx, dy in [(0, 0), (0.5, 0), (0, 0.5), (-0.5, 0), (0, -0.5)]:
            data.append((i, cx + dx, cy + dy))
            i += 1
    data.append((i, 5.0, 0.0))  # halfway between two centres: ties go to the smaller number
    return spark.createDataFrame(data, "id bigint, x double, y double")


def test_fixed_start_converges_and_ties(spark, points):
    init = [[0.0, 0.0], [10.0, 0.0], [0.0, 10.0], [10.0, 10.0], [50.0, 50.0]]
    assigned, centres = U.kmeans_fixed_start(points, "id", ["x", "y"], init, 3)
    a = {r["id"]: r["cluster"] for r in assigned.collect()}
    assert a[20] in (0, 1)
    assert centres[4] == [50.0, 50.0]  # a centre that attracts no point keeps its place
    assert sum(1 for c in a.values() if c == 3) == 5


def test_each_point_nearest_centre(spark, points):
    centres = [list(c) for c in CENTRES]
    got = U.assign_to_centres(points, ["x", "y"], centres, dist="d").collect()
    for r in got:
        best = min(math.dist((r["x"], r["y"]), c) for c in centres)
        assert r["d"] == pytest.approx(best)


def test_assign_clusters_array(spark, points):
    arr = points.select("id", F.array("x", "y").alias("v"))
    got = {r["id"]: r for r in U.assign_clusters(arr, "id", "v", [[0.0, 0.0], [10.0, 10.0]]).collect()}
    assert got[0]["cluster"] == 0 and got[15]["cluster"] == 1 and got[0]["distance"] == 0.0


def test_kmeans_cluster_sizes_and_summary(spark, points):
    model, assigned = U.kmeans_cluster(points, "id", ["x", "y"], 4, seed=1)
    sizes = sorted((r["count"] for r in assigned.groupBy("cluster").count().collect()), reverse=True)
    assert sum(sizes) == 21
    s = U.cluster_summary(assigned.join(points, "id"), ["x", "y"]).collect()
    assert sum(r["share"] for r in s) == pytest.approx(1.0)


def test_similar_and_projection(spark, points):
    sim = U.similar_entities(points, "id", ["x", "y"], 0, k=4).orderBy("rk").collect()
    assert [r["rk"] for r in sim] == [1, 2, 3, 4] and all(r["distance"] == 0.5 for r in sim)
    proj = U.project_2d(points, "id", ["x", "y"]).collect()
    assert len(proj) == 21


def test_choose_k(spark, points):
    t = {r["k"]: r for r in U.choose_k(points, "id", ["x", "y"], [2, 4]).collect()}
    assert t[4]["cost"] < t[2]["cost"] and t[4]["silhouette"] > 0.5


def test_similar_absent_anchor_and_within(spark, points):
    assert U.similar_entities(points, "id", ["x", "y"], 12345, k=3).count() == 0
    withc = points.withColumn("c", (F.col("x") > 5).cast("int"))
    got = U.similar_entities(withc, "id", ["x", "y"], 0, k=10, within="c").collect()
    assert all(r["id"] < 5 or r["id"] in (10, 11, 12, 13, 14, 20) for r in got)
