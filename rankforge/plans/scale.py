"""Registered queries of the forms that large tables need: many rank buckets, names,
table contracts, lattices, stored sketches, partitioned records, neighbours of
every entity, learned vectors, folds and permuted weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.functions.joins import broadcast_if_small
from rankforge.operators import cleaning as C
from rankforge.operators import clustering as U
from rankforge.operators import encoding as E
from rankforge.operators import keyed_store as K
from rankforge.operators import names as N
from rankforge.operators import prediction as P
from rankforge.operators import reports as Q
from rankforge.operators import sketches as Sk
from rankforge.operators import warehouse as W
from rankforge.operators.ranking import global_rank, rank_within
from rankforge.plans.catalog import EF_SQL, LI_NUM, N_FOLDS, TEST_FOLD, TRAIN_SQL, _k4_changes, _p_parts, _u2_points, _u2_sql
from rankforge.plans.checks import ONE_SQL
from rankforge.plans.registry import REGISTRY, register
from rankforge.plans.standins import entity_field, table
from rankforge.session import materialize, scratch_path


@register("q7_rank_many_buckets", """SELECT l_orderkey, l_linenumber, l_extendedprice,
       CAST(RANK() OVER (ORDER BY l_extendedprice DESC) AS BIGINT) AS rank FROM lineitem""")
def _q7(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return global_rank(li, "l_extendedprice", buckets=1024)


@register("q6_rank_many_buckets", """SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice,
       CAST(DENSE_RANK() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS BIGINT) AS drk FROM lineitem""")
def _q6(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return rank_within(li, ["l_returnflag"], "l_extendedprice", "dense_rank", ascending=True, out="drk", buckets=512)


# ---- names -----------------------------------------------------------------

# spellings of the part names: case, blanks, marks, punctuation, a missing letter
NAMES_SQL = """s AS (SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN UPPER(p_name) WHEN 1 THEN '  ' || REPLACE(p_name, ' ', ' - ') || '. '
  WHEN 2 THEN REPLACE(p_name, 'e', 'é') WHEN 3 THEN SUBSTR(p_name, 1, LENGTH(p_name) - 1) WHEN 4 THEN REPLACE(p_name, ' ', ' & ')
  WHEN 5 THEN REPLACE(p_name, 'o', 'Ø') ELSE p_name END AS name FROM part),
w AS (SELECT p_partkey, name, NULLIF(TRIM(regexp_replace(regexp_replace(replace(replace(strip_accents(lower(name)), 'ø', 'o'), '&', ' and '),
  '[''’`]', '', 'g'), '[^\\p{L}\\p{N}]+', ' ', 'g')), '') AS canonical FROM s)"""


def _spellings(spark, d):
    p, k = table(spark, d, "part"), F.col("p_partkey") % 8
    name = F.col("p_name")
    return p.select("p_partkey", F.when(k == 0, F.upper(name)).when(k == 1, F.concat(F.lit("  "), F.replace(name, F.lit(" "), F.lit(" - ")), F.lit(". ")))
                    .when(k == 2, F.replace(name, F.lit("e"), F.lit("é"))).when(k == 3, F.expr("substring(p_name, 1, length(p_name) - 1)"))
                    .when(k == 4, F.replace(name, F.lit(" "), F.lit(" & "))).when(k == 5, F.replace(name, F.lit("o"), F.lit("Ø"))).otherwise(name).alias("name"))


@register("f1_names", f"""WITH {NAMES_SQL},
b AS (SELECT canonical, arg_min(name, (-k, name)) AS label FROM (SELECT canonical, name, COUNT(*) AS k FROM w GROUP BY 1, 2) GROUP BY 1)
SELECT p_partkey, w.canonical AS name_canonical, md5(w.canonical) AS name_id, label AS name_label FROM w JOIN b ON w.canonical = b.canonical""")
def _f1(spark, d):
    return N.normalize_names(_spellings(spark, d), "name").drop("name")


@register("f1_name_variants", f"""WITH RECURSIVE {NAMES_SQL},
n AS (SELECT canonical AS c, COUNT(*) AS k, regexp_replace(canonical, '[^\\p{{N}}]+', ' ', 'g') AS digits FROM w GROUP BY 1),
l AS (SELECT a.c AS u, b.c AS v FROM n a JOIN n b ON a.c <> b.c AND a.digits = b.digits AND length(a.c) >= 5 AND length(b.c) >= 5 AND levenshtein(a.c, b.c) <= 1),
r AS (SELECT c, c AS root FROM n UNION SELECT r.c, l.v FROM r JOIN l ON l.u = r.root),
g AS (SELECT c, MIN(root) AS root FROM r GROUP BY c),
best AS (SELECT root, arg_min(n.c, (-k, n.c)) AS best FROM g JOIN n ON n.c = g.c GROUP BY root)
SELECT p_partkey, canonical AS name_canonical, md5(best) AS name_id FROM w JOIN g ON g.c = w.canonical JOIN best ON best.root = g.root""")
def _f1v(spark, d):
    return N.normalize_names(_spellings(spark, d), "name", max_distance=1).select("p_partkey", "name_canonical", "name_id")


# ---- contracts ---------------------------------------------------------------

# lineitem as a text import left it: a price column of text with some bad values, one column absent
IMPORT_SPEC = W.TableSpec("import", {"l_orderkey": "bigint", "l_linenumber": "int", "l_extendedprice": "double", "l_quantity": "int", "l_comment": "string"},
                          primary_key=("l_orderkey", "l_linenumber"), required=("l_extendedprice", "l_comment"), ranges={"l_quantity": (1, 50)})


@register("m1_schema_rows", """SELECT 'missing_column' AS "check", 'import' AS "table", 1::BIGINT AS n_violations
UNION ALL SELECT 'wrong_type', 'import', 2
UNION ALL SELECT 'bad_value', 'import', COUNT(*) FROM lineitem WHERE l_orderkey % 7 = 0
UNION ALL SELECT 'pk_dup', 'import', COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1) t
UNION ALL SELECT 'required_null', 'import', COUNT(*) FROM lineitem
UNION ALL SELECT 'out_of_range', 'import', COUNT(*) FROM lineitem WHERE l_quantity < 1 OR l_quantity > 50
UNION ALL SELECT 'missing_column', 'orders', 0 UNION ALL SELECT 'wrong_type', 'orders', 0 UNION ALL SELECT 'bad_value', 'orders', 0
UNION ALL SELECT 'pk_dup', 'orders', COUNT(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING COUNT(*) > 1) t""")
def _m1(spark, d):
    price = F.col("l_extendedprice").cast("string")
    imported = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                                  F.when(F.col("l_orderkey") % 7 == 0, F.concat(price, F.lit("?"))).otherwise(price).alias("l_extendedprice"))
    orders = W.TableSpec("orders", {"o_orderkey": "bigint", "o_totalprice": "double"}, primary_key=("o_orderkey",))
    return W.verify({"import": imported, "orders": table(spark, d, "orders")}, [IMPORT_SPEC, orders], schema=True)


# ---- lattices and sketches -----------------------------------------------------

@register("q4_cube_distinct", f"""WITH {EF_SQL}
SELECT region, country, field, CAST(GROUPING(region, country, field) AS BIGINT) AS gid, COUNT(*) AS n_rows,
       CAST(SUM(docs) AS BIGINT) AS docs, CAST(SUM(citations) AS DOUBLE) AS citations, COUNT(DISTINCT entity) AS n_entity
FROM ef GROUP BY CUBE (region, country, field)""")
def _q4(spark, d):
    return Q.multi_dim_lattice(entity_field(spark, d, with_rank=False), ["region", "country", "field"], "cube", distinct="entity")


@register("q3_sketches_within_error", f"""WITH {EF_SQL}, x AS (SELECT region, COUNT(*) AS n_rows FROM ef GROUP BY region UNION ALL SELECT 'all', COUNT(*) FROM ef)
SELECT region, n_rows, TRUE AS entities, TRUE AS fields, TRUE AS median, TRUE AS upper FROM x""")
def _q3(spark, d):
    ef = materialize(entity_field(spark, d, with_rank=False).select("entity", "field", "region", F.col("citations").cast("double").alias("citations")), "ef")
    stored = materialize(Sk.sketch_table(ef, ["region", "field"], ["entity", "field"], ["citations"]), "sketches")
    out = None
    for name, by in ((F.col("region"), ["region"]), (F.lit("all"), [])):
        got = Sk.answers(Sk.merged(stored, by), (0.5, 0.9)).withColumn("__r", name)
        exact = ef.groupBy(name.alias("__r")).agg(F.count_distinct("entity").alias("e"), F.count_distinct("field").alias("f"))
        # a quantile is right if its rank is within 2 % of the place asked for
        x = ef.join(broadcast_if_small(got.select("__r", "citations_q50", "citations_q90")), name == F.col("__r"))
        ranks = x.groupBy("__r").agg(*[F.avg((F.col("citations") <= F.col(f"citations_q{q}")).cast("double")).alias(f"le{q}") for q in (50, 90)],
                                     *[F.avg((F.col("citations") < F.col(f"citations_q{q}")).cast("double")).alias(f"lt{q}") for q in (50, 90)])
        near = [(F.col(f"lt{q}") <= q / 100 + 0.02) & (F.col(f"le{q}") >= q / 100 - 0.02) for q in (50, 90)]
        rows = got.join(exact, "__r").join(ranks, "__r").select(
            F.col("__r").alias("region"), "n_rows", (F.abs(F.col("n_entity") - F.col("e")) <= 0.05 * F.col("e")).alias("entities"),
            (F.abs(F.col("n_field") - F.col("f")) <= 0.05 * F.col("f")).alias("fields"), near[0].alias("median"), near[1].alias("upper"))
        out = rows if out is None else out.unionByName(rows)
    return out


# ---- partitioned records --------------------------------------------------------

@register("k4_partitioned_store", REGISTRY["k4_apply_changes"].sql)
def _k4(spark, d):
    path = scratch_path(spark, "customers")
    K.create_store(table(spark, d, "customer"), path, ["c_custkey"], parts=16)
    K.change_store(_k4_changes(spark, d), path, partial=True)
    return K.read_store(spark, path)


# ---- neighbours of every entity ---------------------------------------------------

@register("u5_similar_all", """{0}, dd AS (SELECT a.entity, b.entity AS neighbour, SQRT((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS distance
  FROM p a JOIN p b ON a.entity <> b.entity)
SELECT entity, neighbour, ROUND(distance, 6) AS distance, rk FROM (SELECT *,
  CAST(ROW_NUMBER() OVER (PARTITION BY entity ORDER BY distance, neighbour) AS BIGINT) AS rk FROM dd) t WHERE rk <= 5""".format(_u2_sql()[0]))
def _u5(spark, d):
    return U.similar_all(_u2_points(spark, d), "entity", ["x", "y"], 5).withColumn("distance", F.round("distance", 6))


# ---- models held against closed forms ------------------------------------------------

@register("u6_signed", """{0}, s AS (SELECT entity, (x - AVG(x) OVER ()) / STDDEV_SAMP(x) OVER () AS a, (y - AVG(y) OVER ()) / STDDEV_SAMP(y) OVER () AS b FROM p),
r AS (SELECT SIGN(CORR(a, b)) AS r FROM s)
SELECT entity, ROUND((a + r * b) / SQRT(2), 4) AS x, ROUND((a - r * b) / SQRT(2), 4) AS y FROM s, r""".format(_u2_sql()[0]))
def _u6(spark, d):
    r = U.project_2d(_u2_points(spark, d), "entity", ["x", "y"])
    return r.select("entity", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


# a linear model on one category alone predicts the category's mean label
@register("p2_category_closed_form", f"""WITH {EF_SQL}, {TRAIN_SQL}, m AS (SELECT field, AVG(CAST(rank AS DOUBLE)) AS p FROM tr GROUP BY field)
SELECT entity, ef.field, ROUND(p, 2) AS prediction FROM ef JOIN m ON m.field = ef.field WHERE entity % {N_FOLDS} = {TEST_FOLD}""")
def _p2(spark, d):
    _, train, test, _ = _p_parts(spark, d)
    model = P.train_rank_model(train, ["field"], [], algo="linear")
    return model.transform(test).select("entity", "field", F.round("prediction", 2).alias("prediction"))


@register("p6_linear_row", f"""WITH {EF_SQL}, {TRAIN_SQL}, {ONE_SQL},
e AS (SELECT CAST(rank AS DOUBLE) AS y, slope * LN(1 + CAST(docs AS DOUBLE)) + intercept AS p FROM ef, lm WHERE entity % {N_FOLDS} = {TEST_FOLD})
SELECT 'linear_docs' AS model, COUNT(*) AS n, ROUND(AVG(ABS(y - p)), 4) AS mae, ROUND(SQRT(AVG((y - p) * (y - p))), 4) AS rmse,
       ROUND(1 - SUM((y - p) * (y - p)) / (VAR_POP(y) * COUNT(*)), 4) AS r2 FROM e""")
def _p6l(spark, d):
    _, train, test, _ = _p_parts(spark, d)
    r = P.compare_models(train, test, {"linear_docs": {"cats": [], "nums": [], "algo": "linear", "log_nums": ["docs"]}}, p1_x=None)
    return r.where("model = 'linear_docs'").select("model", "n", *[F.round(c, 4).alias(c) for c in ("mae", "rmse", "r2")])


@register("p6_learned_spec")
def _p6v(spark, d):
    """The field as a learned vector beside the field as a dictionary."""
    _, train, test, _ = _p_parts(spark, d)
    base = {"algo": "linear", "log_nums": ["docs"]}
    return P.compare_models(train, test, {"dictionary": {**base, "cats": ["field"], "nums": []},
                                          "learned": {**base, "cats": [], "learned": {"row": "entity", "col": "field", "value": "citations", "rank": 4}}})


# ---- learned vectors, folds, permuted weights ---------------------------------------

@register("f9_learned_vectors", f"""WITH {EF_SQL}, {TRAIN_SQL}
SELECT 'entities' AS "check", CAST(COUNT(DISTINCT entity) AS DOUBLE) AS value FROM tr
UNION ALL SELECT 'fields', CAST(COUNT(DISTINCT field) AS DOUBLE) FROM tr
UNION ALL SELECT 'worse_than_the_mean', 0.0 UNION ALL SELECT 'unseen_entity_of_the_test_rows', CAST(COUNT(DISTINCT entity) AS DOUBLE) FROM ef WHERE entity % {N_FOLDS} = {TEST_FOLD}""")
def _f9(spark, d):
    ef, train, test, _ = _p_parts(spark, d)
    train, test = materialize(train, "train"), materialize(test, "test")
    v = E.learned_vectors(train, "entity", "field", "citations", rank=4)
    x = E.reconstruction(train, train, v, "entity", "field", "citations")
    y = F.log1p(F.col("citations").cast("double"))
    err = x.agg(F.avg((y - F.log1p("expected")) ** 2).alias("e"), F.var_pop(y).alias("b")).first()
    rows = [("entities", v["entity"].count()), ("fields", v["field"].count()), ("worse_than_the_mean", float(err["e"] >= err["b"])),
            ("unseen_entity_of_the_test_rows", test.join(v["entity"], "entity", "left_anti").select("entity").distinct().count())]
    return spark.createDataFrame([(k, float(n)) for k, n in rows], "check string, value double")


@register("p6_cross_validated", f"""WITH {EF_SQL},
k AS (SELECT unnest(range(0, {N_FOLDS})) AS fold),
tr AS (SELECT fold, ef.* FROM ef, k WHERE entity % {N_FOLDS} <> fold),
co AS (SELECT fold, field, REGR_SLOPE(CAST(rank AS DOUBLE), LN(1 + CAST(docs AS DOUBLE))) AS slope,
       REGR_INTERCEPT(CAST(rank AS DOUBLE), LN(1 + CAST(docs AS DOUBLE))) AS intercept, AVG(CAST(rank AS DOUBLE)) AS mean,
       COUNT(DISTINCT LN(1 + CAST(docs AS DOUBLE))) AS dx FROM tr GROUP BY fold, field),
mu AS (SELECT fold, AVG(CAST(rank AS DOUBLE)) AS mu FROM tr GROUP BY fold),
te AS (SELECT entity % {N_FOLDS} AS fold, ef.field, CAST(rank AS DOUBLE) AS y, docs FROM ef),
pr AS (SELECT 'baseline_mean' AS model, te.fold, y, COALESCE(mean, mu) AS p FROM te LEFT JOIN co ON co.fold = te.fold AND co.field = te.field JOIN mu ON mu.fold = te.fold
       UNION ALL SELECT 'p1_linear', te.fold, y, GREATEST(COALESCE(CASE WHEN dx >= 2 THEN slope * LN(1 + CAST(docs AS DOUBLE)) + intercept END, mu), 1.0)
       FROM te LEFT JOIN co ON co.fold = te.fold AND co.field = te.field JOIN mu ON mu.fold = te.fold)
SELECT model, CAST(fold AS INTEGER) AS fold, COUNT(*) AS n, ROUND(AVG(ABS(y - p)), 6) AS mae, ROUND(SQRT(AVG((y - p) * (y - p))), 6) AS rmse FROM pr GROUP BY 1, 2""")
def _p6(spark, d):
    r = P.cross_validate(entity_field(spark, d), "entity", {}, N_FOLDS)
    return r.select("model", "fold", "n", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"))


@register("p5_permuted_weight", f"""WITH {EF_SQL}, {TRAIN_SQL}, {ONE_SQL},
te AS (SELECT CAST(rank AS DOUBLE) AS y, docs, ROW_NUMBER() OVER (ORDER BY entity, field) AS i,
         ROW_NUMBER() OVER (ORDER BY md5('42|' || entity::VARCHAR || '|' || field)) AS j FROM ef WHERE entity % {N_FOLDS} = {TEST_FOLD}),
pm AS (SELECT a.y, a.docs, b.docs AS other FROM te a JOIN te b ON a.i = b.j),
e AS (SELECT SQRT(AVG((y - slope * LN(1 + docs) - intercept) * (y - slope * LN(1 + docs) - intercept))) AS base,
  SQRT(AVG((y - slope * LN(1 + other) - intercept) * (y - slope * LN(1 + other) - intercept))) AS dealt FROM pm, lm)
SELECT NULL AS feature, ROUND(base, 4) AS rmse, 0.0::DOUBLE AS weight FROM e UNION ALL SELECT 'docs', ROUND(dealt, 4), ROUND(dealt - base, 4) FROM e""")
def _p5(spark, d):
    _, train, test, _ = _p_parts(spark, d)
    model = P.train_rank_model(train, [], [], algo="linear", log_nums=["docs"])
    r = P.permutation_weights(model, test, ["docs"], ["entity", "field"])
    return r.select("feature", F.round("rmse", 4).alias("rmse"), F.round("weight", 4).alias("weight"))


@register("p5_permuted_weights_all_models")
def _p5a(spark, d):
    """Linear, forest and factor models with the same columns, one of them learned: comparable weights."""
    _, train, test, _ = _p_parts(spark, d)
    vectors = E.learned_vectors(train, "entity", "field", "citations", 4)["field"]
    nums = [f"field_lv_{i}" for i in range(4)]
    train, test = (materialize(E.with_vectors(x, vectors, "field", "field_lv", 4), "rows") for x in (train, test))
    out = None
    for algo in ("linear", "forest", "fm"):
        model = P.train_rank_model(train, ["field"], nums, algo=algo, log_nums=["docs"])
        got = P.permutation_weights(model, test, ["docs", "field"], ["entity", "field"]).withColumn("model", F.lit(algo))
        out = got if out is None else out.unionByName(got)
    return out


@register("c6_correlation_all_numbers", "WITH x AS (SELECT " + ", ".join([*LI_NUM, *[f"{a} * {b} AS {a}_{b}" for a in LI_NUM for b in LI_NUM]]) + " FROM lineitem)\n" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, ROUND(" + (f"CASE WHEN STDDEV_SAMP({a}) > 0 THEN 1.0::DOUBLE END" if a == b else f"CORR({a}, {b})") + ", 5) AS r FROM x"
    for cols in [[*LI_NUM, *[f"{a}_{b}" for a in LI_NUM for b in LI_NUM]]] for i, a in enumerate(cols) for b in cols[i:]))
def _c6(spark, d):
    li = table(spark, d, "lineitem")
    wide = li.select(*LI_NUM, *[(F.col(a) * F.col(b)).alias(f"{a}_{b}") for a in LI_NUM for b in LI_NUM])
    return C.correlation_matrix(wide, wide.columns).withColumn("r", F.round("r", 5))
