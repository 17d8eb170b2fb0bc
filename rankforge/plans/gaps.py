"""Registered queries on data with gaps: NULLs, NaN, blanks, padded text, repeated keys.

The driver tables have none, so each query makes them from its tables the
same way in Spark and in SQL (every 5th, 7th, 11th key)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.operators import cleaning as C
from rankforge.operators import features as Fe
from rankforge.operators import prediction as P
from rankforge.operators import records as R
from rankforge.operators import reports as Q
from rankforge.operators import warehouse as W
from rankforge.plans.catalog import COEF_SQL, DL_SQL, EF_FIELDS, EF_SQL, N_FOLDS, TEST_FOLD, _k4_changes
from rankforge.plans.registry import REGISTRY, register
from rankforge.plans.standins import documents_labels, entity_field, table
from rankforge.session import materialize

GAP_COLS = ["n_chars", "quality", "toxic"]


def _c6_sql():
    parts = []
    for i, a in enumerate(GAP_COLS):
        for b in GAP_COLS[i:]:
            r = f"CASE WHEN STDDEV_SAMP({a}) > 0 THEN CAST(1.0 AS DOUBLE) END" if a == b else f"CORR({a}, {b})"
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, ROUND({r}, 6) AS r FROM d")
    return f"WITH {DL_SQL}\n" + "\nUNION ALL\n".join(parts)


@register("c6_correlation_gaps", _c6_sql())
def _c6(spark, d):
    return C.correlation_matrix(documents_labels(spark, d), GAP_COLS).withColumn("r", F.round("r", 6))


def _c3_sql():
    parts = [f"""SELECT '{c}' AS "column", COUNT({c}) AS n, ROUND(AVG({c}), 6) AS mean, MIN({c}) AS "min",
       ROUND(QUANTILE_CONT({c}, 0.5), 6) AS median, MAX({c}) AS "max" FROM x""" for c in (*GAP_COLS, "nothing")]
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in GAP_COLS)
    return f"WITH {DL_SQL}, x AS (SELECT {cols}, CAST(NULL AS DOUBLE) AS nothing FROM d)\n" + "\nUNION ALL\n".join(parts)


@register("c3_all_null_column", _c3_sql())
def _c3(spark, d):
    x = documents_labels(spark, d).withColumn("nothing", F.lit(None).cast("double"))
    r = C.numeric_summary(x, [*GAP_COLS, "nothing"])
    return r.select("column", "n", F.round("mean", 6).alias("mean"), "min", F.round("median", 6).alias("median"), "max")


@register("c2_impute_nan", f"""WITH {DL_SQL},
x AS (SELECT doc_id, source, CASE WHEN doc_id % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(toxic AS DOUBLE) END AS toxic FROM d),
v AS (SELECT source, CASE WHEN NOT isnan(toxic) THEN toxic END AS toxic FROM x),
g AS (SELECT source, AVG(toxic) AS gt FROM v GROUP BY source), a AS (SELECT AVG(toxic) AS at FROM v)
SELECT x.doc_id, ROUND(CASE WHEN isnan(x.toxic) THEN -1 ELSE COALESCE(x.toxic, g.gt, a.at) END, 6) AS toxic,
       x.toxic IS NULL AS toxic_was_missing
FROM x LEFT JOIN g ON x.source IS NOT DISTINCT FROM g.source, a""")
def _c2(spark, d):
    x = documents_labels(spark, d).withColumn("toxic", F.when(F.col("doc_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("toxic").cast("double")))
    r = C.impute(x, {"toxic": "mean"}, by=["source"])
    return r.select("doc_id", F.round(F.when(F.isnan("toxic"), -1.0).otherwise(F.col("toxic")), 6).alias("toxic"), "toxic_was_missing")


F1_STAGE_SQL = """s AS (SELECT CASE WHEN c_custkey % 11 = 0 THEN '-' ELSE CAST(c_custkey % 500 AS VARCHAR) END AS k, c_custkey,
  CASE WHEN c_custkey % 7 = 0 THEN 'x' || CAST(c_custkey AS VARCHAR) ELSE ' ' || CAST(c_nationkey AS VARCHAR) END AS v,
  CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS a FROM customer),
r AS (SELECT *, CASE WHEN k = '-' THEN 'null_key' WHEN v LIKE 'x%' THEN 'bad_value' END AS reason FROM s),
o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY a DESC NULLS LAST, c_custkey) AS i FROM r WHERE reason IS NULL)"""


def _f1(spark, d):
    c = table(spark, d, "customer")
    key = F.col("c_custkey")
    stage = c.select(F.when(key % 11 == 0, "-").otherwise((key % 500).cast("string")).alias("k"), key,
                     F.when(key % 7 == 0, F.concat(F.lit("x"), key.cast("string")))
                     .otherwise(F.concat(F.lit(" "), F.col("c_nationkey").cast("string"))).alias("v"),
                     F.when(key % 5 != 0, F.col("c_acctbal")).alias("a"))
    return C.clean_records(stage, ["k"], casts={"v": "int"}, order=[("a", False)])


@register("f1_dropped_raw_text", f"""WITH {F1_STAGE_SQL}
SELECT k, c_custkey, v, a, reason FROM r WHERE reason IS NOT NULL
UNION ALL SELECT k, c_custkey, v, a, 'repeat' AS reason FROM o WHERE i > 1""")
def _f1_dropped(spark, d):
    return _f1(spark, d)[1]


@register("f1_clean_null_order", f"""WITH {F1_STAGE_SQL}
SELECT k, c_custkey, CAST(TRIM(v) AS INTEGER) AS v, a FROM o WHERE i = 1""")
def _f1_clean(spark, d):
    return _f1(spark, d)[0]


@register("k4_unkeyed_base", "WITH kb AS (SELECT * FROM customer WHERE c_custkey % 13 <> 0),\n"
          + REGISTRY["k4_apply_changes"].sql.removeprefix("WITH ").replace("FROM customer b", "FROM kb b")
          + "\nUNION ALL SELECT NULL, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 13 = 0")
def _k4(spark, d):
    c = table(spark, d, "customer")
    base = c.withColumn("c_custkey", F.when(F.col("c_custkey") % 13 != 0, F.col("c_custkey")))
    return R.apply_changes(base, _k4_changes(spark, d), ["c_custkey"], "seq", "op", partial=True)


@register("m3_composite_key", """WITH s AS (SELECT CASE WHEN p_partkey % 7 = 0 THEN NULL
    WHEN p_partkey % 5 = 0 THEN p_brand || ' ' ELSE p_brand END AS b,
  CASE WHEN p_partkey % 11 = 0 THEN ' ' ELSE p_type END AS t, p_size, p_partkey FROM part),
k AS (SELECT TRIM(b) AS b, TRIM(t) AS t, p_size, p_partkey FROM s WHERE b IS NOT NULL AND TRIM(t) <> ''),
v AS (SELECT b, t, COUNT(DISTINCT p_size) AS n_variants FROM k GROUP BY b, t),
f AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY b, t ORDER BY p_partkey, p_size) AS i FROM k)
SELECT md5(f.b || chr(1) || f.t) AS key, f.b, f.t, p_size, n_variants FROM f JOIN v ON f.b = v.b AND f.t = v.t WHERE i = 1""")
def _m3(spark, d):
    key = F.col("p_partkey")
    s = table(spark, d, "part").select(
        F.when(key % 7 == 0, F.lit(None)).when(key % 5 == 0, F.concat("p_brand", F.lit(" "))).otherwise(F.col("p_brand")).alias("b"),
        F.when(key % 11 == 0, " ").otherwise(F.col("p_type")).alias("t"), "p_size", "p_partkey")
    return W.migrate_dimension(s, ["b", "t"], ["p_size"], ["p_partkey"])


@register("m4_padded_values", """WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN ' ' || p_type
    WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type || ' ' END AS t FROM part)
SELECT md5(TRIM(t)) AS type_key, p_partkey FROM x WHERE t IS NOT NULL""")
def _m4(spark, d):
    part, key = table(spark, d, "part"), F.col("p_partkey")
    x = part.select("p_partkey", F.when(key % 3 == 0, F.concat(F.lit(" "), "p_type")).when(key % 7 == 0, F.lit(None))
                    .otherwise(F.concat("p_type", F.lit(" "))).alias("t"))
    return W.migrate_facts(x, [("type", W.seed_dimension(part, "p_type"), "t", "value", "key")], ["p_partkey"])[0]


@register("q1_repeated_rows", f"""WITH {EF_SQL}, t AS (SELECT entity % 9 AS entity, field, docs, citations FROM ef)
SELECT field, rank, docs, CAST(citations AS DOUBLE) AS citations FROM (SELECT *,
  CAST(RANK() OVER (PARTITION BY field ORDER BY citations DESC) AS BIGINT) AS rank FROM t) x WHERE entity = 2""")
def _q1(spark, d):
    ef = materialize(entity_field(spark, d, with_rank=False), "ef").withColumn("entity", F.col("entity") % 9)
    return Q.entity_rankings(ef, 2).select("field", "rank", "docs", "citations")


EF_GAPS_SQL = f"""{EF_SQL}, eg AS (SELECT CASE WHEN entity % 11 <> 0 THEN entity END AS entity,
  CASE WHEN entity % 7 <> 0 THEN field END AS field, citations FROM ef)"""


def _ef_gaps(spark, d):
    ef = entity_field(spark, d, with_rank=False)
    return materialize(ef.select(F.when(F.col("entity") % 11 != 0, F.col("entity")).alias("entity"),
                                 F.when(F.col("entity") % 7 != 0, F.col("field")).alias("field"), "citations"), "ef")


@register("f3_null_entity_field", f"""WITH {EF_GAPS_SQL},
e AS (SELECT entity, SUM(citations) AS et FROM eg GROUP BY entity),
f AS (SELECT field, SUM(citations) AS fs, COUNT(*) AS fn FROM eg GROUP BY field)
SELECT eg.entity, eg.field, ROUND(CAST(citations AS DOUBLE) / NULLIF(CAST(et AS DOUBLE), 0), 6) AS share_of_entity,
       ROUND(PERCENT_RANK() OVER (PARTITION BY eg.field ORDER BY citations DESC), 6) AS pct_rank,
       ROUND(CAST(citations AS DOUBLE) - CAST(fs AS DOUBLE) / CAST(fn AS DOUBLE), 6) AS gap_to_mean
FROM eg JOIN e ON eg.entity IS NOT DISTINCT FROM e.entity JOIN f ON eg.field IS NOT DISTINCT FROM f.field""")
def _f3(spark, d):
    r = Fe.field_profile(_ef_gaps(spark, d))
    return r.select("entity", "field", *[F.round(c, 6).alias(c) for c in ("share_of_entity", "pct_rank", "gap_to_mean")])


@register("f10_null_field", f"""WITH {EF_GAPS_SQL}
SELECT entity, {", ".join(f"CAST(SUM(CASE WHEN field = '{v}' THEN citations ELSE 0 END) AS DOUBLE) AS f_{v.lower()}" for v in EF_FIELDS)},
       CAST(SUM(CASE WHEN field IS NULL THEN citations ELSE 0 END) AS DOUBLE) AS no_field
FROM eg GROUP BY entity""")
def _f10(spark, d):
    return Fe.profile_matrix(_ef_gaps(spark, d), fields=EF_FIELDS, null_field="no_field")


@register("p3_missing_docs", f"""WITH {EF_SQL},
eg AS (SELECT entity, field, rank, CASE WHEN entity % 7 <> 0 THEN docs END AS docs FROM ef),
tr AS (SELECT * FROM eg WHERE entity % {N_FOLDS} <> {TEST_FOLD} AND docs IS NOT NULL), {COEF_SQL},
pr AS (SELECT eg.entity, eg.field, eg.rank, CASE WHEN eg.docs IS NOT NULL THEN
         GREATEST(COALESCE(co.slope * LN(1 + CAST(eg.docs AS DOUBLE)) + co.intercept,
                           (SELECT AVG(CAST(rank AS DOUBLE)) FROM eg WHERE entity % {N_FOLDS} <> {TEST_FOLD})), 1.0) END AS raw
       FROM eg LEFT JOIN co ON eg.field = co.field)
SELECT entity, field, rank, ROUND(raw, 6) AS raw, CASE WHEN raw IS NOT NULL THEN
       CAST(RANK() OVER (PARTITION BY field ORDER BY raw NULLS LAST) AS BIGINT) END AS predicted_rank FROM pr""")
def _p3(spark, d):
    ef = materialize(entity_field(spark, d), "ef")
    ef = ef.withColumn("docs", F.when(F.col("entity") % 7 != 0, F.col("docs")))
    train, _ = P.split_by_key(ef, "entity", N_FOLDS, TEST_FOLD)
    return P.predict_ranks(P.fit_rank_linear(train), train, ef).withColumn("raw", F.round("raw", 6))
