"""Registered queries that hold fitted models and approximations against SQL:
closed forms where one exists, and rows of checks where none does."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.operators import cleaning as C
from rankforge.operators import clustering as U
from rankforge.operators import features as Fe
from rankforge.operators import prediction as P
from rankforge.operators import reports as Q
from rankforge.plans.catalog import (EF_FIELDS, EF_SQL, ENTITY, F_COLS, LI_NUM, N_FOLDS, TEST_FOLD, TRAIN_SQL,
                                     _p_parts, _profile, _u2, _u2_sql)
from rankforge.plans.registry import register
from rankforge.plans.standins import entity_field, table
from rankforge.session import materialize, scratch_path

PM_SQL = f"""{EF_SQL}, pm AS (SELECT entity, {", ".join(
    f"CAST(SUM(CASE WHEN field = '{v}' THEN citations ELSE 0 END) AS DOUBLE) AS f_{v.lower()}" for v in EF_FIELDS)} FROM ef GROUP BY entity)"""


def _checks(spark, rows):
    return spark.createDataFrame([(k, float(v)) for k, v in rows], "check string, value double")


@register("u1_kmeans_checks", f"""WITH {EF_SQL}
SELECT 'entities' AS "check", CAST(COUNT(DISTINCT entity) AS DOUBLE) AS value FROM ef
UNION ALL SELECT 'clusters', 4.0 UNION ALL SELECT 'sizes_out_of_order', 0.0 UNION ALL SELECT 'entities_twice', 0.0
UNION ALL SELECT 'nearer_to_another_centre', 0.0""")
def _u1(spark, d):
    from pyspark.ml.functions import vector_to_array
    pm = _profile(spark, d)
    model, assigned = U.kmeans_cluster(pm, "entity", F_COLS, 4, seed=42)
    assigned = materialize(assigned, "assigned")
    sizes = [r["n"] for r in assigned.groupBy("cluster").agg(F.count("*").alias("n")).orderBy("cluster").collect()]  # k rows
    centres = [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]
    z = model.transform(pm).select("entity", vector_to_array("__features").alias("z"), F.col("__c").alias("own"))
    best = U.assign_clusters(z.join(assigned, "entity").select("entity", "z"), "entity", "z", centres, out="best").join(z.select("entity", "own"), "entity")
    return _checks(spark, [
        ("entities", assigned.count()), ("clusters", len(sizes)), ("sizes_out_of_order", sum(a < b for a, b in zip(sizes, sizes[1:]))),
        ("entities_twice", assigned.count() - assigned.select("entity").distinct().count()),
        ("nearer_to_another_centre", best.where("best != own").count())])


@register("u4_cost_of_one_cluster", f"""WITH {PM_SQL}
SELECT 1 AS k, ROUND((COUNT(*) - 1) * ({" + ".join(f"CASE WHEN STDDEV_SAMP({c}) > 0 THEN 1.0 ELSE 0.0 END" for c in F_COLS)}), 3)::DOUBLE AS cost FROM pm""")
def _u4(spark, d):
    return U.choose_k(_profile(spark, d), "entity", F_COLS, [1]).select("k", F.round("cost", 3).alias("cost"))


@register("u5_similar_in_cluster", """{0}, a AS (SELECT * FROM {1} WHERE entity = {2}),
dd AS (SELECT p.entity, SQRT((p.x - a.x) * (p.x - a.x) + (p.y - a.y) * (p.y - a.y)) AS distance
       FROM {1} p, a WHERE p.entity <> a.entity AND p.j = a.j)
SELECT entity, ROUND(distance, 6) AS distance, rk FROM (SELECT entity, distance,
       CAST(ROW_NUMBER() OVER (ORDER BY distance, entity) AS BIGINT) AS rk FROM dd) t WHERE rk <= 5""".format(*_u2_sql(), ENTITY))
def _u5(spark, d):
    pts, assigned, _ = _u2(spark, d)
    r = U.similar_entities(pts.join(assigned, "entity"), "entity", ["x", "y"], ENTITY, 5, within="cluster")
    return r.withColumn("distance", F.round("distance", 6))


@register("u6_two_columns", """{0}, s AS (SELECT entity, j, (x - AVG(x) OVER ()) / STDDEV_SAMP(x) OVER () AS a,
  (y - AVG(y) OVER ()) / STDDEV_SAMP(y) OVER () AS b FROM {1}), r AS (SELECT SIGN(CORR(a, b)) AS r FROM s)
SELECT entity, j AS cluster, ROUND(ABS(a + r * b) / SQRT(2), 4) AS x, ROUND(ABS(a - r * b) / SQRT(2), 4) AS y FROM s, r""".format(*_u2_sql()))
def _u6(spark, d):
    pts, assigned, _ = _u2(spark, d)
    r = U.project_2d(pts.join(assigned, "entity"), "entity", ["x", "y"], keep=["cluster"])
    return r.select("entity", "cluster", F.round(F.abs("x"), 4).alias("x"), F.round(F.abs("y"), 4).alias("y"))


ONE_SQL = """lm AS (SELECT REGR_SLOPE(CAST(rank AS DOUBLE), LN(1 + CAST(docs AS DOUBLE))) AS slope,
  REGR_INTERCEPT(CAST(rank AS DOUBLE), LN(1 + CAST(docs AS DOUBLE))) AS intercept FROM tr)"""


def _one_feature(spark, d):
    _, train, test, _ = _p_parts(spark, d)
    return P.train_rank_model(train, [], [], algo="linear", log_nums=["docs"]), train, test


@register("p2_linear_closed_form", f"""WITH {EF_SQL}, {TRAIN_SQL}, {ONE_SQL}
SELECT 'log1p_docs' AS feature, ROUND(slope, 4) AS weight, ROUND(intercept, 4) AS intercept FROM lm""")
def _p2(spark, d):
    model, train, _ = _one_feature(spark, d)
    rows = [(f, w, float(model.stages[-1].intercept)) for f, w in P.feature_weights(model, train)]
    r = spark.createDataFrame(rows, "feature string, weight double, intercept double")
    return r.select("feature", F.round("weight", 4).alias("weight"), F.round("intercept", 4).alias("intercept"))


@register("p3_saved_model", f"""WITH {EF_SQL}, {TRAIN_SQL}, {ONE_SQL},
pr AS (SELECT entity, field, rank, GREATEST(slope * LN(1 + CAST(docs AS DOUBLE)) + intercept, 1.0) AS raw, docs
       FROM ef, lm WHERE entity % {N_FOLDS} = {TEST_FOLD})
SELECT entity, field, rank, ROUND(raw, 4) AS raw, CAST(RANK() OVER (PARTITION BY field ORDER BY raw) AS BIGINT) AS predicted_rank FROM pr""")
def _p3(spark, d):
    model, _, test = _one_feature(spark, d)
    path = scratch_path(spark, "rank-model")
    P.save_model(model, path)
    return P.predict_with_model(P.load_model(path), test).withColumn("raw", F.round("raw", 4))


@register("p6_exact_rows", f"""WITH {EF_SQL}, {TRAIN_SQL},
co AS (SELECT field, REGR_SLOPE(CAST(rank AS DOUBLE), LN(1 + CAST(docs AS DOUBLE))) AS slope,
       REGR_INTERCEPT(CAST(rank AS DOUBLE), LN(1 + CAST(docs AS DOUBLE))) AS intercept, AVG(CAST(rank AS DOUBLE)) AS mean,
       COUNT(DISTINCT LN(1 + CAST(docs AS DOUBLE))) AS dx FROM tr GROUP BY field),
mu AS (SELECT AVG(CAST(rank AS DOUBLE)) AS mu FROM tr),
pr AS (SELECT 'baseline_mean' AS model, CAST(rank AS DOUBLE) AS y, COALESCE(mean, mu) AS p
       FROM ef LEFT JOIN co ON ef.field = co.field, mu WHERE entity % {N_FOLDS} = {TEST_FOLD}
       UNION ALL SELECT 'p1_linear', CAST(rank AS DOUBLE),
         GREATEST(COALESCE(CASE WHEN dx >= 2 THEN slope * LN(1 + CAST(docs AS DOUBLE)) + intercept END, mu), 1.0)
       FROM ef LEFT JOIN co ON ef.field = co.field, mu WHERE entity % {N_FOLDS} = {TEST_FOLD})
SELECT model, COUNT(*) AS n, ROUND(AVG(ABS(y - p)), 6) AS mae, ROUND(SQRT(AVG((y - p) * (y - p))), 6) AS rmse FROM pr GROUP BY model""")
def _p6(spark, d):
    _, train, test, _ = _p_parts(spark, d)
    r = P.compare_models(train, test, {})
    return r.select("model", "n", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"))


@register("f9_index", f"""WITH {EF_SQL}, {TRAIN_SQL},
o AS (SELECT region, CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, region) - 1 AS DOUBLE) AS i FROM tr GROUP BY region)
SELECT entity, field, COALESCE(i, (SELECT CAST(COUNT(*) AS DOUBLE) FROM o)) AS region_idx FROM ef LEFT JOIN o ON ef.region = o.region""")
def _f9(spark, d):
    ef = materialize(entity_field(spark, d), "ef")
    train, _ = P.split_by_key(ef, "entity", N_FOLDS, TEST_FOLD)
    return Fe.encode_categories(train, ef, ["region"], "index").select("entity", "field", "region_idx")


@register("f9_one_hot", f"""WITH {EF_SQL}, {TRAIN_SQL},
o AS (SELECT region, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, region) - 1 AS i FROM tr GROUP BY region)
SELECT entity, field, slot, CAST(COALESCE(i, (SELECT COUNT(*) FROM o)) = slot AS INTEGER) AS hot
FROM ef LEFT JOIN o ON ef.region = o.region, (SELECT i AS slot FROM o UNION ALL SELECT COUNT(*) FROM o) s""")
def _f9h(spark, d):
    from pyspark.ml.functions import vector_to_array
    ef = materialize(entity_field(spark, d), "ef")
    train, _ = P.split_by_key(ef, "entity", N_FOLDS, TEST_FOLD)
    r = Fe.encode_categories(train, ef, ["region"], "onehot")
    size = train.select("region").distinct().count()
    return r.select("entity", "field", F.posexplode(F.slice(vector_to_array("region_vec"), 1, size + 1)).alias("slot", "hot")) \
        .select("entity", "field", F.col("slot").cast("bigint").alias("slot"), F.col("hot").cast("int").alias("hot"))


@register("q3_approx_within_error", """SELECT 'n_entities' AS measure, TRUE AS within
UNION ALL SELECT 'n_countries', TRUE UNION ALL SELECT 'n_fields', TRUE UNION ALL SELECT 'docs', TRUE UNION ALL SELECT 'citations', TRUE""")
def _q3(spark, d):
    ef = materialize(entity_field(spark, d, with_rank=False), "ef")
    names = ["n_entities", "n_countries", "n_fields", "docs", "citations"]
    one = Q.global_overview(ef, approx=True).select(*[F.col(c).cast("double").alias(f"a_{c}") for c in names])
    two = Q.global_overview(ef).select(*[F.col(c).cast("double").alias(c) for c in names])
    a, e = one.first(), two.first()  # one row each
    return spark.createDataFrame([(c, bool(abs(a[f"a_{c}"] - e[c]) <= 0.15 * e[c])) for c in names], "measure string, within boolean")


@register("c3_approx_within_error", "\nUNION ALL\n".join(f"""SELECT '{c}' AS "column", COUNT({c}) AS n, TRUE AS within FROM lineitem""" for c in LI_NUM))
def _c3(spark, d):
    li = table(spark, d, "lineitem").select(*LI_NUM)
    a = C.numeric_summary(li, LI_NUM, exact=False).select("column", "n", "q1", "median", "q3")
    # an approximate quantile is a value whose rank is off by n / 10000 at most
    want = {(r["column"], p): r[q] for r in a.collect() for q, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))}
    share = li.agg(*[F.avg((F.col(c) <= v).cast("double")).alias(f"{c}|{p}|le") for (c, p), v in want.items()],
                   *[F.avg((F.col(c) < v).cast("double")).alias(f"{c}|{p}|lt") for (c, p), v in want.items()]).first()
    ok = {c: all(share[f"{c}|{p}|lt"] - 0.001 <= p <= share[f"{c}|{p}|le"] + 0.001 for p in (0.25, 0.5, 0.75)) for c in LI_NUM}
    flag = spark.createDataFrame(list(ok.items()), T.StructType([T.StructField("column", T.StringType()), T.StructField("within", T.BooleanType())]))
    return a.select("column", "n").join(F.broadcast(flag), "column")
