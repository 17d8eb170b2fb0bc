"""Registered queries over the driver tables, each with its SQL twin.

The SQL is written from each operator's definition (window functions,
GROUP BY, joins), not from the Spark code, and runs unchanged in DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge import sources as S
from rankforge.operators import citations as A
from rankforge.operators import cleaning as C
from rankforge.operators import clustering as U
from rankforge.operators import features as Fe
from rankforge.operators import prediction as P
from rankforge.operators import records as R
from rankforge.operators import reports as Q
from rankforge.operators import warehouse as W
from rankforge.operators.ranking import global_rank, rank_columns
from rankforge.plans.registry import register
from rankforge.plans.standins import documents_labels, entity_field, table
from rankforge.session import materialize, scratch_path

# EF in SQL: suppliers x part types, ranked by citations inside each type.
EF_SQL = """ef AS (
  SELECT e.*, CAST(citations AS DOUBLE) / NULLIF(docs, 0) AS cpp,
         CAST(RANK() OVER (PARTITION BY field ORDER BY citations DESC) AS BIGINT) AS rank
  FROM (SELECT s_suppkey AS entity, s_nationkey AS country, r_name AS region, p_type AS field,
               COUNT(*) AS docs, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS citations
        FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
             JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
        GROUP BY s_suppkey, s_nationkey, r_name, p_type) e)"""

ENTITY = 7   # entity used by the one-entity reports
COUNTRY = 3  # country used by the one-country report (has suppliers at every scale)


def ef_out(df):
    """EF with the decimal metric cast to double for comparison."""
    return df.withColumn("citations", F.col("citations").cast("double"))


@register("ef_entity_field", f"""WITH {EF_SQL}
SELECT entity, country, region, field, docs, CAST(citations AS DOUBLE) AS citations, cpp, rank FROM ef""")
def _ef(spark, d):
    return ef_out(entity_field(spark, d))


# ---- A: citation statistics -------------------------------------------------

@register("a1_stats_by_field", f"""WITH {EF_SQL}
SELECT field, COUNT(DISTINCT entity) AS n_entities, CAST(SUM(docs) AS BIGINT) AS docs,
       CAST(SUM(citations) AS DOUBLE) AS citations,
       CAST(SUM(citations) AS DOUBLE) / NULLIF(SUM(docs), 0) AS cpp
FROM ef GROUP BY field""")
def _a1(spark, d):
    return A.stats_by(entity_field(spark, d, with_rank=False), ["field"])


@register("a2_stats_by_entity", f"""WITH {EF_SQL}
SELECT entity, COUNT(DISTINCT entity) AS n_entities, CAST(SUM(docs) AS BIGINT) AS docs,
       CAST(SUM(citations) AS DOUBLE) AS citations,
       CAST(SUM(citations) AS DOUBLE) / NULLIF(SUM(docs), 0) AS cpp
FROM ef GROUP BY entity""")
def _a2(spark, d):
    return A.stats_by(entity_field(spark, d, with_rank=False), ["entity"])


# ---- Q: ranking reports -----------------------------------------------------

@register("q1_entity_rankings", f"""WITH {EF_SQL}
SELECT field, rank, docs, CAST(citations AS DOUBLE) AS citations, cpp FROM ef WHERE entity = {ENTITY}""")
def _q1(spark, d):
    return Q.entity_rankings(entity_field(spark, d, with_rank=False), ENTITY)


@register("q2_country_performance", f"""WITH {EF_SQL}
SELECT field, COUNT(DISTINCT entity) AS n_entities, MIN(rank) AS best_rank, AVG(rank) AS mean_rank,
       CAST(SUM(CASE WHEN rank <= 10 THEN 1 ELSE 0 END) AS BIGINT) AS n_top_10,
       CAST(SUM(citations) AS DOUBLE) AS citations
FROM ef WHERE country = {COUNTRY} GROUP BY field""")
def _q2(spark, d):
    return Q.country_performance(materialize(entity_field(spark, d, with_rank=False), "ef"), COUNTRY, [10])


@register("q7_global_rank", """SELECT l_orderkey, l_linenumber, l_extendedprice,
       CAST(RANK() OVER (ORDER BY l_extendedprice DESC) AS BIGINT) AS rank FROM lineitem""")
def _q7(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return global_rank(li, "l_extendedprice")


@register("q6_rank_in_group", """SELECT c_custkey, c_nationkey, c_acctbal,
  CAST(RANK() OVER w AS BIGINT) AS rk,
  CAST(DENSE_RANK() OVER w AS BIGINT) AS drk,
  CAST(ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS BIGINT) AS rn,
  ROUND(PERCENT_RANK() OVER w, 6) AS prk,
  CAST(NTILE(4) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS BIGINT) AS tile
FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal DESC)""")
def _q6(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    c = rank_columns(c, ["c_nationkey"], "c_acctbal",
                     {"rk": "rank", "drk": "dense_rank", "rn": "row_number",
                      "prk": "percent_rank", "tile": ("ntile", 4)}, ties=["c_custkey"])
    return c.withColumn("prk", F.round("prk", 6))


# ---- A3-A5 ------------------------------------------------------------------

@register("a3_ratio_by_field", f"""WITH {EF_SQL}
SELECT field, CAST(SUM(citations) AS DOUBLE) AS citations, CAST(SUM(docs) AS DOUBLE) AS docs,
       CAST(SUM(citations) AS DOUBLE) / NULLIF(CAST(SUM(docs) AS DOUBLE), 0) AS ratio
FROM ef WHERE citations IS NOT NULL AND docs IS NOT NULL GROUP BY field""")
def _a3(spark, d):
    return A.ratio_metric(entity_field(spark, d, with_rank=False), "citations", "docs", ["field"])


@register("a4_sort_by_citations", f"""WITH {EF_SQL}
SELECT entity, field, CAST(citations AS DOUBLE) AS citations FROM ef""")
def _a4s(spark, d):
    ef = ef_out(entity_field(spark, d, with_rank=False))
    return A.sort_by(ef, "citations", ["entity", "field"]).select("entity", "field", "citations")


@register("a4_top_by_cpp", f"""WITH {EF_SQL}
SELECT * FROM (SELECT entity, field, cpp,
  CAST(ROW_NUMBER() OVER (ORDER BY cpp DESC NULLS LAST, entity, field) AS BIGINT) AS rk FROM ef) t
WHERE rk <= 10""")
def _a4t(spark, d):
    ef = entity_field(spark, d, with_rank=False).select("entity", "field", "cpp")
    return A.top_k(ef, "cpp", 10, ["entity", "field"])


@register("a5_pair_relation", f"""WITH {EF_SQL}
SELECT field, COUNT(*) AS n, ROUND(CORR(CAST(citations AS DOUBLE), CAST(docs AS DOUBLE)), 6) AS r,
       ROUND(REGR_SLOPE(CAST(citations AS DOUBLE), CAST(docs AS DOUBLE)), 6) AS slope,
       ROUND(REGR_INTERCEPT(CAST(citations AS DOUBLE), CAST(docs AS DOUBLE)), 6) AS intercept
FROM ef GROUP BY field""")
def _a5(spark, d):
    r = A.pair_relation(entity_field(spark, d, with_rank=False), "docs", "citations", ["field"])
    return r.select("field", "n", *[F.round(c, 6).alias(c) for c in ("r", "slope", "intercept")])


@register("a5_grid_bins", """WITH b AS (SELECT MIN(l_quantity) AS lx, MAX(l_quantity) AS hx,
                      MIN(l_extendedprice) AS ly, MAX(l_extendedprice) AS hy FROM lineitem)
SELECT CASE WHEN hx = lx THEN 0 ELSE LEAST(CAST(FLOOR((l_quantity - lx) / ((hx - lx) / 10.0)) AS BIGINT), 9) END AS ix,
       CASE WHEN hy = ly THEN 0 ELSE LEAST(CAST(FLOOR((l_extendedprice - ly) / ((hy - ly) / 10.0)) AS BIGINT), 9) END AS iy,
       COUNT(*) AS n
FROM lineitem, b GROUP BY 1, 2""")
def _a5g(spark, d):
    return A.grid_bins(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", 10, 10)


# ---- Q3-Q5 ------------------------------------------------------------------

@register("q3_global_overview", f"""WITH {EF_SQL}
SELECT COUNT(DISTINCT entity) AS n_entities, COUNT(DISTINCT country) AS n_countries,
       COUNT(DISTINCT field) AS n_fields, CAST(SUM(docs) AS BIGINT) AS docs,
       CAST(SUM(citations) AS DOUBLE) AS citations,
       CAST(SUM(citations) AS DOUBLE) / NULLIF(SUM(docs), 0) AS cpp FROM ef""")
def _q3(spark, d):
    return Q.global_overview(entity_field(spark, d, with_rank=False))


_Q4_SELECT = """SELECT region, country, field,
       CAST(GROUPING(region, country, field) AS BIGINT) AS gid, COUNT(*) AS n_rows,
       CAST(SUM(docs) AS BIGINT) AS docs, CAST(SUM(citations) AS DOUBLE) AS citations FROM ef"""


@register("q4_rollup", f"WITH {EF_SQL}\n{_Q4_SELECT} GROUP BY ROLLUP (region, country, field)")
def _q4r(spark, d):
    return Q.multi_dim(entity_field(spark, d, with_rank=False), ["region", "country", "field"], "rollup")


@register("q4_cube", f"WITH {EF_SQL}\n{_Q4_SELECT} GROUP BY CUBE (region, country, field)")
def _q4c(spark, d):
    return Q.multi_dim(entity_field(spark, d, with_rank=False), ["region", "country", "field"], "cube")


@register("q4_grouping_sets",
          f"WITH {EF_SQL}\n{_Q4_SELECT} GROUP BY GROUPING SETS ((region, field), (country), ())")
def _q4g(spark, d):
    return Q.multi_dim(entity_field(spark, d, with_rank=False), ["region", "country", "field"],
                       [["region", "field"], ["country"], []])


@register("q5_top_regions_by_field", f"""WITH {EF_SQL}
SELECT * FROM (SELECT field, region, CAST(SUM(citations) AS DOUBLE) AS citations,
  CAST(ROW_NUMBER() OVER (PARTITION BY field ORDER BY SUM(citations) DESC, region) AS BIGINT) AS rk
  FROM ef GROUP BY field, region) t WHERE rk <= 3""")
def _q5f(spark, d):
    return Q.top_regions(entity_field(spark, d, with_rank=False), 3, by=["field"])


@register("q5_top_regions", f"""WITH {EF_SQL}
SELECT * FROM (SELECT region, CAST(SUM(citations) AS DOUBLE) AS citations,
  CAST(ROW_NUMBER() OVER (ORDER BY SUM(citations) DESC, region) AS BIGINT) AS rk
  FROM ef GROUP BY region) t WHERE rk <= 3""")
def _q5(spark, d):
    return Q.top_regions(entity_field(spark, d, with_rank=False), 3)


# ---- C: cleaning and single-table analysis ----------------------------------

DL_SQL = """d AS (SELECT documents.doc_id, lang, source, n_chars, quality, toxic
       FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id)"""
DL_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]


def _c1_sql():
    counts = ", ".join(f"COUNT(*) - COUNT({c}) AS m_{c}" for c in DL_COLS)
    parts = [f"""SELECT '{c}' AS "column", n_rows, CAST(m_{c} AS BIGINT) AS n_missing,
       CAST(m_{c} AS DOUBLE) * 100.0 / CAST(n_rows AS DOUBLE) AS pct_missing FROM c""" for c in DL_COLS]
    return f"WITH {DL_SQL}, c AS (SELECT COUNT(*) AS n_rows, {counts} FROM d)\n" + "\nUNION ALL\n".join(parts)


@register("c1_missing_profile", _c1_sql())
def _c1(spark, d):
    return C.missing_profile(documents_labels(spark, d), DL_COLS)


@register("c2_impute", f"""WITH {DL_SQL},
g AS (SELECT source, MEDIAN(quality) AS gq, AVG(CAST(toxic AS DOUBLE)) AS gt FROM d GROUP BY source),
a AS (SELECT MEDIAN(quality) AS aq, AVG(CAST(toxic AS DOUBLE)) AS at FROM d)
SELECT d.doc_id, d.source, COALESCE(CAST(d.quality AS DOUBLE), g.gq, a.aq) AS quality,
       d.quality IS NULL AS quality_was_missing,
       ROUND(COALESCE(CAST(d.toxic AS DOUBLE), g.gt, a.at), 6) AS toxic,
       d.toxic IS NULL AS toxic_was_missing
FROM d LEFT JOIN g ON d.source IS NOT DISTINCT FROM g.source, a""")
def _c2(spark, d):
    r = C.impute(documents_labels(spark, d), {"quality": "median", "toxic": "mean"}, by=["source"])
    return r.select("doc_id", "source", "quality", "quality_was_missing",
                    F.round("toxic", 6).alias("toxic"), "toxic_was_missing")


LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _c3_sql():
    parts = [f"""SELECT '{c}' AS "column", COUNT({c}) AS n, ROUND(AVG({c}), 6) AS mean,
       ROUND(STDDEV_SAMP({c}), 6) AS sd, MIN({c}) AS "min", ROUND(QUANTILE_CONT({c}, 0.25), 6) AS q1,
       ROUND(QUANTILE_CONT({c}, 0.5), 6) AS median, ROUND(QUANTILE_CONT({c}, 0.75), 6) AS q3,
       MAX({c}) AS "max" FROM lineitem""" for c in LI_NUM]
    return "\nUNION ALL\n".join(parts)


@register("c3_numeric_summary", _c3_sql())
def _c3(spark, d):
    r = C.numeric_summary(table(spark, d, "lineitem"), LI_NUM)
    return r.select("column", "n", *[F.round(c, 6).alias(c) for c in ("mean", "sd")], "min",
                    *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")], "max")


@register("c4_histogram", """WITH b AS (SELECT MIN(value) AS vlo, MAX(value) AS vhi FROM events
                      WHERE value IS NOT NULL AND NOT isnan(value)),
x AS (SELECT CASE WHEN vhi = vlo THEN 0
                  ELSE LEAST(CAST(FLOOR((value - vlo) / ((vhi - vlo) / 20.0)) AS BIGINT), 19) END AS bin,
             vlo, vhi
      FROM events, b WHERE value IS NOT NULL AND NOT isnan(value))
SELECT bin, vlo + CAST(bin AS DOUBLE) * ((vhi - vlo) / 20.0) AS lo,
       vlo + CAST(bin + 1 AS DOUBLE) * ((vhi - vlo) / 20.0) AS hi, COUNT(*) AS n
FROM x GROUP BY bin, vlo, vhi""")
def _c4(spark, d):
    return C.histogram(table(spark, d, "events"), "value", 20)


@register("c5_boxplot", """WITH q AS (SELECT event_type, QUANTILE_CONT(value, 0.25) AS q1,
              QUANTILE_CONT(value, 0.5) AS median, QUANTILE_CONT(value, 0.75) AS q3
              FROM events WHERE value IS NOT NULL GROUP BY event_type),
j AS (SELECT e.event_type, e.value, q.q1, q.median, q.q3,
             q.q1 - 1.5 * (q.q3 - q.q1) AS lf, q.q3 + 1.5 * (q.q3 - q.q1) AS hf
      FROM events e JOIN q ON e.event_type = q.event_type WHERE e.value IS NOT NULL)
SELECT event_type, ROUND(ANY_VALUE(q1), 6) AS q1, ROUND(ANY_VALUE(median), 6) AS median,
       ROUND(ANY_VALUE(q3), 6) AS q3,
       MIN(CASE WHEN value >= lf AND value <= hf THEN value END) AS lo_whisker,
       MAX(CASE WHEN value >= lf AND value <= hf THEN value END) AS hi_whisker,
       CAST(SUM(CASE WHEN value >= lf AND value <= hf THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers
FROM j GROUP BY event_type""")
def _c5(spark, d):
    r = C.boxplot_stats(table(spark, d, "events"), "value", ["event_type"])
    return r.select("event_type", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")],
                    "lo_whisker", "hi_whisker", "n_outliers")


def _c6_sql():
    parts = []
    for i, a in enumerate(LI_NUM):
        for b in LI_NUM[i:]:
            r = (f"CASE WHEN STDDEV_SAMP({a}) > 0 THEN CAST(1.0 AS DOUBLE) END" if a == b
                 else f"CORR({a}, {b})")
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, ROUND({r}, 6) AS r FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@register("c6_correlation", _c6_sql())
def _c6(spark, d):
    r = C.correlation_matrix(table(spark, d, "lineitem"), LI_NUM)
    return r.withColumn("r", F.round("r", 6))


# ---- F1: clean records --------------------------------------------------------

LI_ORDER = ("l_extendedprice DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, "
            "l_tax, l_returnflag, l_linestatus, l_shipdate")


def _f1(spark, d):
    li = table(spark, d, "lineitem")
    return C.clean_records(li, ["l_orderkey", "l_linenumber"], order=[("l_extendedprice", False)])


@register("f1_clean_ok", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LI_ORDER}) AS rn
      FROM lineitem) t WHERE rn = 1""")
def _f1_ok(spark, d):
    clean, _ = _f1(spark, d)
    return clean.withColumn("l_shipdate", F.col("l_shipdate").cast("date").cast("string"))


@register("f1_clean_dropped", f"""SELECT l_orderkey, l_linenumber, l_extendedprice, 'repeat' AS reason
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LI_ORDER}) AS rn
      FROM lineitem) t WHERE rn > 1""")
def _f1_dropped(spark, d):
    _, dropped = _f1(spark, d)
    return dropped.select("l_orderkey", "l_linenumber", "l_extendedprice", "reason")


# ---- F2-F10: features and profiles -------------------------------------------

@register("f2_entity_summary", f"""WITH {EF_SQL}
SELECT entity, COUNT(DISTINCT field) AS n_fields, CAST(SUM(docs) AS BIGINT) AS docs,
       CAST(SUM(citations) AS DOUBLE) AS citations,
       CAST(SUM(citations) AS DOUBLE) / NULLIF(SUM(docs), 0) AS cpp,
       MIN(rank) AS best_rank, ROUND(AVG(rank), 6) AS mean_rank, ROUND(STDDEV_SAMP(rank), 6) AS sd_rank
FROM ef GROUP BY entity""")
def _f2(spark, d):
    r = Fe.entity_summary(entity_field(spark, d))
    return r.withColumn("mean_rank", F.round("mean_rank", 6)).withColumn("sd_rank", F.round("sd_rank", 6))


@register("f3_field_profile", f"""WITH {EF_SQL},
e AS (SELECT entity, SUM(citations) AS et FROM ef GROUP BY entity),
f AS (SELECT field, SUM(citations) AS fs, COUNT(*) AS fn FROM ef GROUP BY field)
SELECT ef.entity, ef.field,
       ROUND(CAST(citations AS DOUBLE) / NULLIF(CAST(et AS DOUBLE), 0), 6) AS share_of_entity,
       ROUND(PERCENT_RANK() OVER (PARTITION BY ef.field ORDER BY citations DESC), 6) AS pct_rank,
       ROUND(CAST(citations AS DOUBLE) - CAST(fs AS DOUBLE) / CAST(fn AS DOUBLE), 6) AS gap_to_mean
FROM ef JOIN e ON ef.entity = e.entity JOIN f ON ef.field = f.field""")
def _f3(spark, d):
    # the profile joins entity totals and field means back onto EF: write EF once
    r = Fe.field_profile(materialize(entity_field(spark, d, with_rank=False), "ef"))
    return r.select("entity", "field", *[F.round(c, 6).alias(c)
                                         for c in ("share_of_entity", "pct_rank", "gap_to_mean")])


@register("f4_entity_strengths", f"""WITH {EF_SQL},
e AS (SELECT field, rank, CAST(citations AS DOUBLE) / NULLIF(CAST(SUM(citations) OVER () AS DOUBLE), 0) AS share
      FROM ef WHERE entity = {ENTITY}),
b AS (SELECT 'best' AS kind, field, rank, share,
             ROW_NUMBER() OVER (ORDER BY rank, share DESC, field) AS i FROM e),
w AS (SELECT 'worst' AS kind, field, rank, share,
             ROW_NUMBER() OVER (ORDER BY rank DESC, share, field) AS i FROM e)
SELECT kind, field, rank, ROUND(share, 6) AS share FROM b WHERE i <= 2
UNION ALL SELECT kind, field, rank, ROUND(share, 6) AS share FROM w WHERE i <= 2""")
def _f4(spark, d):
    # one entity: its ranks come from counts of better rows (Q1), no table sort
    ef = materialize(entity_field(spark, d, with_rank=False), "ef")
    own = materialize(Q.entity_rankings(ef, ENTITY, with_entity=True), "own")  # one row per field
    r = Fe.entity_strengths(own, ENTITY, 2)
    return r.withColumn("share", F.round("share", 6))


@register("f5_log_features", """SELECT p_partkey, ROUND(LN(1 + p_retailprice), 6) AS log1p_p_retailprice
FROM part""")
def _f5(spark, d):
    r = Fe.log_features(table(spark, d, "part").select("p_partkey", "p_retailprice"), ["p_retailprice"])
    return r.select("p_partkey", F.round("log1p_p_retailprice", 6).alias("log1p_p_retailprice"))


@register("f6_ratio_features", """SELECT l_orderkey, l_linenumber, l_extendedprice / NULLIF(l_quantity, 0) AS unit_price,
       l_tax / NULLIF(l_discount, 0) AS tax_per_discount FROM lineitem""")
def _f6(spark, d):
    li = table(spark, d, "lineitem")
    r = Fe.ratio_features(li, [("l_extendedprice", "l_quantity", "unit_price"),
                               ("l_tax", "l_discount", "tax_per_discount")])
    return r.select("l_orderkey", "l_linenumber", "unit_price", "tax_per_discount")


@register("f7_category_counts", """WITH l AS (SELECT 'p_brand' AS "column", CAST(p_brand AS VARCHAR) AS value FROM part
                UNION ALL SELECT 'p_type', CAST(p_type AS VARCHAR) FROM part),
c AS (SELECT "column", value, COUNT(*) AS n FROM l GROUP BY 1, 2),
t AS (SELECT "column", COUNT(value) AS nn FROM l GROUP BY 1)
SELECT c."column", value, n,
       CASE WHEN value IS NOT NULL THEN CAST(n AS DOUBLE) / NULLIF(CAST(nn AS DOUBLE), 0) END AS share
FROM c JOIN t ON c."column" = t."column\"""")
def _f7(spark, d):
    return Fe.category_counts(table(spark, d, "part"), ["p_brand", "p_type"])


F8_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _f8_sql():
    long = "\nUNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM lineitem" for c in F8_COLS)
    return f"""WITH l AS ({long}),
b AS (SELECT "column", MIN(v) AS vlo, MAX(v) AS vhi FROM l WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY 1),
x AS (SELECT l."column", CASE WHEN vhi = vlo THEN 0
                  ELSE LEAST(CAST(FLOOR((v - vlo) / ((vhi - vlo) / 10.0)) AS BIGINT), 9) END AS bin, vlo, vhi
      FROM l JOIN b ON l."column" = b."column" WHERE v IS NOT NULL AND NOT isnan(v))
SELECT "column", bin, vlo + CAST(bin AS DOUBLE) * ((vhi - vlo) / 10.0) AS lo,
       vlo + CAST(bin + 1 AS DOUBLE) * ((vhi - vlo) / 10.0) AS hi, COUNT(*) AS n
FROM x GROUP BY "column", bin, vlo, vhi"""


@register("f8_numeric_distributions", _f8_sql())
def _f8(spark, d):
    return Fe.numeric_distributions(table(spark, d, "lineitem"), F8_COLS, 10)


N_FOLDS, TEST_FOLD = 5, 0


@register("f9_target_mean", f"""WITH {EF_SQL},
tr AS (SELECT * FROM ef WHERE entity % {N_FOLDS} <> {TEST_FOLD}),
mu AS (SELECT AVG(CAST(rank AS DOUBLE)) AS mu FROM tr),
st AS (SELECT field, SUM(CAST(rank AS DOUBLE)) AS sy, COUNT(*) AS n FROM tr GROUP BY field)
SELECT ef.entity, ef.field,
       ROUND(COALESCE((st.sy + 10.0 * mu.mu) / (CAST(st.n AS DOUBLE) + 10.0), mu.mu), 6) AS field_te
FROM ef LEFT JOIN st ON ef.field = st.field, mu""")
def _f9(spark, d):
    ef = materialize(entity_field(spark, d), "ef")
    train, _ = P.split_by_key(ef, "entity", N_FOLDS, TEST_FOLD)
    r = Fe.encode_categories(train, ef, ["field"], "target", target="rank", smoothing=10.0)
    return r.select("entity", "field", F.round("field_te", 6).alias("field_te"))


EF_FIELDS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@register("f10_profile_matrix", f"""WITH {EF_SQL}
SELECT entity, {", ".join(f"CAST(SUM(CASE WHEN field = '{v}' THEN citations ELSE 0 END) AS DOUBLE) AS f_{v.lower()}"
                          for v in EF_FIELDS)}
FROM ef GROUP BY entity""")
def _f10(spark, d):
    return Fe.profile_matrix(entity_field(spark, d, with_rank=False))


# ---- P: rank prediction --------------------------------------------------------

TRAIN_SQL = f"tr AS (SELECT * FROM ef WHERE entity % {N_FOLDS} <> {TEST_FOLD})"
COEF_SQL = """co AS (SELECT field, REGR_SLOPE(CAST(rank AS DOUBLE), LN(1 + CAST(docs AS DOUBLE))) AS slope,
              REGR_INTERCEPT(CAST(rank AS DOUBLE), LN(1 + CAST(docs AS DOUBLE))) AS intercept, COUNT(*) AS n
       FROM tr GROUP BY field HAVING COUNT(DISTINCT LN(1 + CAST(docs AS DOUBLE))) >= 2)"""
PRED_SQL = """pr AS (SELECT ef.entity, ef.field, ef.rank,
         GREATEST(COALESCE(co.slope * LN(1 + CAST(ef.docs AS DOUBLE)) + co.intercept,
                           (SELECT AVG(CAST(rank AS DOUBLE)) FROM tr)), 1.0) AS raw
       FROM ef LEFT JOIN co ON ef.field = co.field)"""


def _p_parts(spark, d):
    # EF feeds the split, the fit, the prediction and its re-rank: write it once
    ef = materialize(entity_field(spark, d), "ef")
    train, test = P.split_by_key(ef, "entity", N_FOLDS, TEST_FOLD)
    coefs = P.fit_rank_linear(train)
    return ef, train, test, coefs


@register("p7_split", f"""WITH {EF_SQL}
SELECT entity, field, entity % {N_FOLDS} = {TEST_FOLD} AS is_test FROM ef""")
def _p7(spark, d):
    ef = entity_field(spark, d, with_rank=False)
    return ef.select("entity", "field", P.is_test(ef, "entity", N_FOLDS, TEST_FOLD).alias("is_test"))


@register("p1_fit_rank_linear", f"""WITH {EF_SQL}, {TRAIN_SQL}, {COEF_SQL}
SELECT field, ROUND(slope, 6) AS slope, ROUND(intercept, 6) AS intercept, n FROM co""")
def _p1(spark, d):
    _, _, _, coefs = _p_parts(spark, d)
    return coefs.select("field", F.round("slope", 6).alias("slope"),
                        F.round("intercept", 6).alias("intercept"), "n")


@register("p3_predict_ranks", f"""WITH {EF_SQL}, {TRAIN_SQL}, {COEF_SQL}, {PRED_SQL}
SELECT entity, field, rank, ROUND(raw, 6) AS raw,
       CAST(RANK() OVER (PARTITION BY field ORDER BY raw) AS BIGINT) AS predicted_rank FROM pr""")
def _p3(spark, d):
    ef, train, _, coefs = _p_parts(spark, d)
    r = P.predict_ranks(coefs, train, ef)
    return r.withColumn("raw", F.round("raw", 6))


@register("p4_regression_metrics", f"""WITH {EF_SQL}, {TRAIN_SQL}, {COEF_SQL}, {PRED_SQL},
te AS (SELECT * FROM pr WHERE entity % {N_FOLDS} = {TEST_FOLD})
SELECT field, COUNT(*) AS n, CAST(0 AS BIGINT) AS n_missing,
       ROUND(AVG(ABS(rank - raw)), 6) AS mae, ROUND(SQRT(AVG((rank - raw) * (rank - raw))), 6) AS rmse,
       ROUND(CASE WHEN VAR_POP(CAST(rank AS DOUBLE)) * COUNT(*) > 0 THEN
             1 - SUM((rank - raw) * (rank - raw)) / (VAR_POP(CAST(rank AS DOUBLE)) * COUNT(*)) END, 6) AS r2
FROM te GROUP BY field""")
def _p4(spark, d):
    ef, train, test, coefs = _p_parts(spark, d)
    pred = P.raw_prediction(coefs, train, test)
    m = P.regression_metrics(pred, "rank", "raw", ["field"])
    return m.select("field", "n", "n_missing", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2")])


@register("p5_residual_report", f"""WITH {EF_SQL}, {TRAIN_SQL}, {COEF_SQL}, {PRED_SQL},
te AS (SELECT field, CASE WHEN rank BETWEEN 1 AND 10 THEN '1-10' WHEN rank BETWEEN 11 AND 50 THEN '11-50'
                          WHEN rank BETWEEN 51 AND 100 THEN '51-100' WHEN rank >= 101 THEN '>100' END AS band,
              CAST(rank AS DOUBLE) - raw AS e
       FROM pr WHERE entity % {N_FOLDS} = {TEST_FOLD})
SELECT field, band, COUNT(*) AS n, ROUND(AVG(e), 6) AS mean_error,
       ROUND(QUANTILE_CONT(e, 0.5), 6) AS median_error, ROUND(AVG(ABS(e)), 6) AS mean_abs_error
FROM te GROUP BY field, band""")
def _p5(spark, d):
    ef, train, test, coefs = _p_parts(spark, d)
    pred = P.raw_prediction(coefs, train, test)
    r = P.residual_report(pred, "rank", "raw", ["field"])
    return r.select("field", "band", "n", *[F.round(c, 6).alias(c)
                                            for c in ("mean_error", "median_error", "mean_abs_error")])


@register("p2_train_rank_model")
def _p2(spark, d):
    ef, train, test, _ = _p_parts(spark, d)
    model = P.train_rank_model(train, ["field", "region"], [], algo="gbt", log_nums=["docs", "cpp"])
    return model.transform(test.withColumn("rank", F.col("rank").cast("double"))) \
        .select("entity", "field", "rank", "prediction")


@register("p6_compare_models")
def _p6(spark, d):
    ef, train, test, _ = _p_parts(spark, d)
    specs = {a: {"cats": ["field"], "nums": [], "log_nums": ["docs", "cpp"], "algo": a} for a in ("linear", "forest", "gbt")}
    return P.compare_models(train, test, specs)


# ---- K: keyed record maintenance ---------------------------------------------

CUST = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
URGENT_SQL = "SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'"


def _urgent_keys(spark, d):
    o = table(spark, d, "orders")
    return o.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))


@register("k1_lookup", f"SELECT * FROM customer WHERE c_custkey IN ({URGENT_SQL})")
def _k1(spark, d):
    return R.lookup(table(spark, d, "customer"), _urgent_keys(spark, d), ["c_custkey"])


@register("k3_delete_keys", f"""SELECT * FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM ({URGENT_SQL}) k WHERE k.o_custkey = c.c_custkey)""")
def _k3(spark, d):
    return R.delete_keys(table(spark, d, "customer"), _urgent_keys(spark, d), ["c_custkey"])


K2_SQL = """base AS (SELECT * FROM customer WHERE c_nationkey < 13),
b AS (SELECT * FROM customer WHERE c_nationkey >= 10
      UNION ALL SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey >= 13),
x AS (SELECT b.*, c_custkey IN (SELECT c_custkey FROM base) AS ex,
             ROW_NUMBER() OVER (PARTITION BY c_custkey
                                ORDER BY c_acctbal, c_custkey, c_name, c_nationkey, c_mktsegment) AS i
      FROM b)"""


def _k2(spark, d):
    c = table(spark, d, "customer")
    base = c.filter(F.col("c_nationkey") < 13)
    batch = c.filter(F.col("c_nationkey") >= 10).unionByName(
        c.filter((F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") >= 13)))
    return R.insert_new(base, batch, ["c_custkey"], order=["c_acctbal", "c_custkey", "c_name",
                                                           "c_nationkey", "c_mktsegment"])


@register("k2_insert_ok", f"""WITH {K2_SQL}
SELECT * FROM base UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM x
WHERE c_custkey IS NOT NULL AND NOT ex AND i = 1""")
def _k2_ok(spark, d):
    return _k2(spark, d)[0]


@register("k2_insert_refused", f"""WITH {K2_SQL}
SELECT c_custkey, reason FROM (SELECT c_custkey, CASE WHEN c_custkey IS NULL THEN 'null_key' WHEN ex THEN 'exists'
                                   WHEN i > 1 THEN 'repeat' END AS reason FROM x) t
WHERE reason IS NOT NULL""")
def _k2_refused(spark, d):
    return _k2(spark, d)[1].select("c_custkey", "reason")


def _k4_changes(spark, d):
    o = table(spark, d, "orders")
    null_s, null_i = F.lit(None).cast("string"), F.lit(None).cast("int")
    upd = o.filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("c_custkey"), null_s.alias("c_name"), null_i.alias("c_nationkey"),
        F.col("o_totalprice").alias("c_acctbal"), null_s.alias("c_mktsegment"),
        F.col("o_orderkey").alias("seq"), F.lit("U").alias("op"))
    dele = o.filter((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F")).select(
        F.col("o_custkey").alias("c_custkey"), null_s.alias("c_name"), null_i.alias("c_nationkey"),
        F.lit(None).cast("double").alias("c_acctbal"), null_s.alias("c_mktsegment"),
        F.col("o_orderkey").alias("seq"), F.lit("D").alias("op"))
    ins = o.filter((F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "P")).select(
        (F.col("o_orderkey") + F.lit(1000000000)).alias("c_custkey"),
        F.concat(F.lit("new-"), F.col("o_orderkey").cast("string")).alias("c_name"),
        F.lit(0).alias("c_nationkey"), F.col("o_totalprice").alias("c_acctbal"),
        F.lit("NEW").alias("c_mktsegment"), F.col("o_orderkey").alias("seq"), F.lit("I").alias("op"))
    return upd.unionByName(dele).unionByName(ins)


@register("k4_apply_changes", """WITH ch AS (
  SELECT o_custkey AS c_custkey, CAST(NULL AS VARCHAR) AS c_name, CAST(NULL AS INTEGER) AS c_nationkey,
         o_totalprice AS c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment, o_orderkey AS seq, 'U' AS op
  FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT o_custkey, NULL, NULL, NULL, NULL, o_orderkey, 'D'
  FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F'
  UNION ALL
  SELECT o_orderkey + 1000000000, 'new-' || CAST(o_orderkey AS VARCHAR), 0, o_totalprice, 'NEW', o_orderkey, 'I'
  FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'P'),
l AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY c_custkey ORDER BY seq DESC) AS i FROM ch) t
      WHERE i = 1)
SELECT COALESCE(b.c_custkey, l.c_custkey) AS c_custkey,
       CASE WHEN l.op IS NOT NULL THEN COALESCE(l.c_name, b.c_name) ELSE b.c_name END AS c_name,
       CASE WHEN l.op IS NOT NULL THEN COALESCE(l.c_nationkey, b.c_nationkey) ELSE b.c_nationkey END AS c_nationkey,
       CASE WHEN l.op IS NOT NULL THEN COALESCE(l.c_acctbal, b.c_acctbal) ELSE b.c_acctbal END AS c_acctbal,
       CASE WHEN l.op IS NOT NULL THEN COALESCE(l.c_mktsegment, b.c_mktsegment) ELSE b.c_mktsegment END
         AS c_mktsegment
FROM customer b FULL OUTER JOIN l ON b.c_custkey = l.c_custkey
WHERE l.op IS NULL OR l.op <> 'D'""")
def _k4(spark, d):
    return R.apply_changes(table(spark, d, "customer"), _k4_changes(spark, d), ["c_custkey"],
                           "seq", "op", partial=True)


# ---- M: dimensions, facts, verification ---------------------------------------

@register("m2_seed_dimension", """SELECT DISTINCT md5(TRIM(p_type)) AS key, TRIM(p_type) AS value FROM part
WHERE p_type IS NOT NULL AND TRIM(p_type) <> ''""")
def _m2(spark, d):
    return W.seed_dimension(table(spark, d, "part"), "p_type")


@register("m3_migrate_dimension", """WITH v AS (SELECT p_brand, COUNT(*) AS n_variants
           FROM (SELECT DISTINCT p_brand, p_type, p_size FROM part) t GROUP BY p_brand),
f AS (SELECT * FROM (SELECT p_brand, p_type, p_size,
                     ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY p_partkey, p_type, p_size) AS i
                     FROM part) t WHERE i = 1)
SELECT md5(TRIM(CAST(f.p_brand AS VARCHAR))) AS key, f.p_brand, p_type, p_size, n_variants
FROM f JOIN v ON f.p_brand = v.p_brand""")
def _m3(spark, d):
    return W.migrate_dimension(table(spark, d, "part"), ["p_brand"], ["p_type", "p_size"], ["p_partkey"])


M4_DIMS_SQL = """fd AS (SELECT DISTINCT md5(TRIM(p_type)) AS key, TRIM(p_type) AS value FROM part
       WHERE p_type IS NOT NULL AND TRIM(p_type) <> ''),
ed AS (SELECT md5(TRIM(CAST(s_suppkey AS VARCHAR))) AS key, s_suppkey FROM supplier WHERE s_acctbal > 0),
st AS (SELECT ef.entity, ef.country, ef.field, ef.docs, ef.citations, ed.key AS entity_key, fd.key AS field_key
       FROM ef LEFT JOIN ed ON ef.entity = ed.s_suppkey LEFT JOIN fd ON ef.field = fd.value)"""


def _m4(spark, d):
    ef = materialize(entity_field(spark, d, with_rank=False).select(
        "entity", "country", "field", "docs", F.col("citations").cast("double").alias("citations")), "stage")
    fdim = W.seed_dimension(table(spark, d, "part"), "p_type")
    sup = table(spark, d, "supplier").filter(F.col("s_acctbal") > 0)
    edim = W.migrate_dimension(sup, ["s_suppkey"], ["s_name", "s_nationkey"], ["s_suppkey"])
    dims = [("entity", edim, "entity", "s_suppkey", "key"), ("field", fdim, "field", "value", "key")]
    return ef, W.migrate_facts(ef, dims, ["docs", "citations"])


@register("m4_facts", f"""WITH {EF_SQL}, {M4_DIMS_SQL}
SELECT entity_key, field_key, docs, CAST(citations AS DOUBLE) AS citations FROM st
WHERE entity_key IS NOT NULL AND field_key IS NOT NULL""")
def _m4_facts(spark, d):
    return _m4(spark, d)[1][0]


@register("m4_orphans", f"""WITH {EF_SQL}, {M4_DIMS_SQL}
SELECT entity, country, field, docs, CAST(citations AS DOUBLE) AS citations,
       CASE WHEN entity_key IS NULL THEN 'entity' ELSE 'field' END AS missing_dim FROM st
WHERE entity_key IS NULL OR field_key IS NULL""")
def _m4_orphans(spark, d):
    return _m4(spark, d)[1][1]


LI_SPEC = W.TableSpec(
    "lineitem",
    {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
     "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double"},
    primary_key=("l_orderkey", "l_linenumber"),
    required=("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"),
    foreign_keys=(W.ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)),
                  W.ForeignKey(("l_partkey",), "part", ("p_partkey",)),
                  W.ForeignKey(("l_suppkey",), "supplier", ("s_suppkey",))),
    ranges={"l_quantity": (1, 50), "l_discount": (0.0, 0.1), "l_tax": (0.0, 0.08)})
ORDERS_SPEC = W.TableSpec(
    "orders", {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"},
    primary_key=("o_orderkey",), required=("o_orderkey", "o_custkey"),
    foreign_keys=(W.ForeignKey(("o_custkey",), "customer", ("c_custkey",)),),
    ranges={"o_totalprice": (0.0, None)})


@register("m5_verify", f"""WITH {EF_SQL}, {M4_DIMS_SQL}
SELECT 'pk_dup' AS "check", 'lineitem' AS "table", CAST(COUNT(*) AS BIGINT) AS n_violations
  FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1) t
UNION ALL SELECT 'required_null', 'lineitem', CAST(COUNT(*) AS BIGINT) FROM lineitem
  WHERE l_orderkey IS NULL OR l_partkey IS NULL OR l_suppkey IS NULL OR l_quantity IS NULL OR l_extendedprice IS NULL
UNION ALL SELECT 'out_of_range', 'lineitem', CAST(COUNT(*) AS BIGINT) FROM lineitem
  WHERE l_quantity < 1 OR l_quantity > 50 OR l_discount < 0.0 OR l_discount > 0.1 OR l_tax < 0.0 OR l_tax > 0.08
UNION ALL SELECT 'fk_orphan', 'lineitem->orders', CAST(COUNT(*) AS BIGINT) FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'fk_orphan', 'lineitem->part', CAST(COUNT(*) AS BIGINT) FROM lineitem
  WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'fk_orphan', 'lineitem->supplier', CAST(COUNT(*) AS BIGINT) FROM lineitem
  WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'pk_dup', 'orders', CAST(COUNT(*) AS BIGINT)
  FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING COUNT(*) > 1) t
UNION ALL SELECT 'required_null', 'orders', CAST(COUNT(*) AS BIGINT) FROM orders
  WHERE o_orderkey IS NULL OR o_custkey IS NULL
UNION ALL SELECT 'out_of_range', 'orders', CAST(COUNT(*) AS BIGINT) FROM orders WHERE o_totalprice < 0.0
UNION ALL SELECT 'fk_orphan', 'orders->customer', CAST(COUNT(*) AS BIGINT) FROM orders
  WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'rows', 'ef_facts', CAST(ABS((SELECT COUNT(*) FROM ef)
  - (SELECT COUNT(*) FROM st WHERE entity_key IS NOT NULL AND field_key IS NOT NULL)
  - (SELECT COUNT(*) FROM st WHERE entity_key IS NULL OR field_key IS NULL)) AS BIGINT)""")
def _m5(spark, d):
    ef, (facts, orphans) = _m4(spark, d)
    tables = {n: table(spark, d, n) for n in ("lineitem", "orders", "part", "supplier", "customer")}
    tables.update({"ef": ef, "facts": facts, "orphans": orphans})
    return W.verify(tables, [LI_SPEC, ORDERS_SPEC], [("ef_facts", "ef", ["facts", "orphans"])])


# ---- S: sources and sinks (round trips through the shared scratch folder) ------

def _customer_schema():
    return T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                         T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType())])


@register("s1_read_csv_glob", """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       CAST(NULL AS VARCHAR) AS _corrupt FROM customer""")
def _s1(spark, d):
    path = scratch_path(spark, "by-segment")
    S.write_csv(table(spark, d, "customer"), path, partition_by=["c_mktsegment"])
    return S.read_csv_glob(spark, f"{path}/c_mktsegment=*/*.csv", _customer_schema(),
                           r"c_mktsegment=([^/]+)/", "c_mktsegment")


@register("s2_read_csv_table", "SELECT *, CAST(NULL AS VARCHAR) AS _corrupt FROM part")
def _s2(spark, d):
    part = table(spark, d, "part")
    path = scratch_path(spark, "part-csv")
    S.write_csv(part, path)
    return S.read_csv_table(spark, path, part.schema)


@register("s3_read_json_records", """SELECT vec_id, label, CAST(len(embedding) AS BIGINT) AS dims,
       CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[len(embedding)] AS DOUBLE) AS last,
       ROUND(SQRT(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS norm
FROM embeddings""")
def _s3(spark, d):
    emb = table(spark, d, "embeddings")
    path = scratch_path(spark, "embeddings-json")
    emb.write.json(path)
    back = S.read_json_records(spark, path, emb.schema)
    e = F.col("embedding")
    sq = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return back.select("vec_id", "label", F.size(e).cast("bigint").alias("dims"),
                       e[0].cast("double").alias("first"), F.element_at(e, -1).cast("double").alias("last"),
                       F.round(F.sqrt(sq), 6).alias("norm"))


@register("s4_write_csv", f"""WITH {EF_SQL}
SELECT entity, country, region, field, docs, CAST(citations AS DOUBLE) AS citations, cpp, rank FROM ef""")
def _s4(spark, d):
    ef = ef_out(entity_field(spark, d))
    path = scratch_path(spark, "ef-sorted")
    S.write_csv(ef, path, sort_by=["citations"], descending=True)
    return S.read_csv_table(spark, path, ef.schema, corrupt=None)


ORDERS_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


@register("s5_export_meta", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", '{t}' AS "type", COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS n_missing,
       CAST(MIN({c}) AS VARCHAR) AS "min", CAST(MAX({c}) AS VARCHAR) AS "max" FROM orders"""
    for c, t in ORDERS_TYPES))
def _s5(spark, d):
    orders = table(spark, d, "orders")
    path = scratch_path(spark, "orders-json")
    return S.export_json(orders, path)


def _s6(spark, d):
    o = table(spark, d, "orders")
    raw = S.string_stage(o)
    k = F.col("o_orderkey").cast("bigint") % 7
    raw = raw.withColumn("o_totalprice", F.when(k == 0, F.concat("o_totalprice", F.lit("x")))
                         .otherwise(F.col("o_totalprice")))
    raw = raw.withColumn("o_custkey", F.when(k == 3, F.concat(F.lit("c"), "o_custkey"))
                         .otherwise(F.col("o_custkey")))
    path = scratch_path(spark, "staged")
    S.write_staged(raw, o.schema, path, required=("o_orderkey",))  # every cast once, both outcomes in one pass
    return [S.read_staged(spark, path, o.schema, status) for status in ("accepted", "rejected")]


@register("s6_stage_ok", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders WHERE o_orderkey % 7 NOT IN (0, 3)""")
def _s6_ok(spark, d):
    ok, _ = _s6(spark, d)
    return ok.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@register("s6_stage_rejected", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CASE WHEN o_orderkey % 7 = 3 THEN 'bad_value:o_custkey' ELSE 'bad_value:o_totalprice' END AS reason
FROM orders WHERE o_orderkey % 7 IN (0, 3)""")
def _s6_rejected(spark, d):
    _, rejected = _s6(spark, d)
    return rejected.select("o_orderkey", "reason")


# ---- U: clustering -------------------------------------------------------------

U2_K, U2_STEPS = 4, 3


def _u2_points(spark, d):
    ef = entity_field(spark, d, with_rank=False)
    # the points feed every KMeans step: write them once
    return materialize(ef.groupBy("entity").agg(F.sum("docs").cast("double").alias("x"),
                                    (F.sum("citations").cast("double") / F.lit(1000.0)).alias("y")), "points")


def _u2(spark, d):
    pts = _u2_points(spark, d)
    init = [[r["x"], r["y"]] for r in pts.orderBy("entity").limit(U2_K).collect()]
    assigned, centres = U.kmeans_fixed_start(pts, "entity", ["x", "y"], init, U2_STEPS)
    return pts, assigned, centres


def _u2_sql():
    ctes = [f"""p AS (SELECT entity, CAST(SUM(docs) AS DOUBLE) AS x,
       CAST(SUM(citations) AS DOUBLE) / 1000.0 AS y FROM ef GROUP BY entity)""",
            f"""c0 AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY entity) - 1 AS INTEGER) AS j, x, y
       FROM (SELECT * FROM p ORDER BY entity LIMIT {U2_K}) t)"""]
    for s in range(1, U2_STEPS + 2):
        ctes.append(f"""a{s} AS (SELECT entity, x, y, j FROM (SELECT p.entity, p.x, p.y, c.j,
         ROW_NUMBER() OVER (PARTITION BY p.entity
                            ORDER BY (p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y), c.j) AS i
       FROM p, c{s - 1} c) t WHERE i = 1)""")
        if s <= U2_STEPS:
            ctes.append(f"""c{s} AS (SELECT c.j, COALESCE(m.x, c.x) AS x, COALESCE(m.y, c.y) AS y
       FROM c{s - 1} c LEFT JOIN (SELECT j, AVG(x) AS x, AVG(y) AS y FROM a{s} GROUP BY j) m ON c.j = m.j)""")
    return f"WITH {EF_SQL},\n" + ",\n".join(ctes), f"a{U2_STEPS + 1}"


@register("u2_kmeans_fixed", "{0}\nSELECT entity, j AS cluster FROM {1}".format(*_u2_sql()))
def _u2q(spark, d):
    return _u2(spark, d)[1]


@register("u4_cluster_summary", """{0}
SELECT j AS cluster, CAST(COUNT(*) AS BIGINT) AS size,
       ROUND(CAST(COUNT(*) AS DOUBLE) / CAST((SELECT COUNT(*) FROM p) AS DOUBLE), 6) AS share,
       ROUND(AVG(x), 6) AS mean_x, ROUND(STDDEV_SAMP(x), 6) AS sd_x,
       ROUND(AVG(y), 6) AS mean_y, ROUND(STDDEV_SAMP(y), 6) AS sd_y,
       ROUND(VAR_POP(x) * COUNT(*) + VAR_POP(y) * COUNT(*), 3) AS cost
FROM {1} GROUP BY j""".format(*_u2_sql()))
def _u4(spark, d):
    pts, assigned, _ = _u2(spark, d)
    s = U.cluster_summary(assigned.join(pts, "entity"), ["x", "y"])
    return s.select("cluster", "size", *[F.round(c, 6).alias(c) for c in
                                         ("share", "mean_x", "sd_x", "mean_y", "sd_y")],
                    F.round("cost", 3).alias("cost"))


@register("u3_assign_clusters", """WITH c AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY label) - 1 AS INTEGER) AS cluster,
                  arg_min(embedding, vec_id) AS ce FROM embeddings GROUP BY label),
d AS (SELECT e.vec_id, c.cluster,
             array_distance(CAST(e.embedding AS DOUBLE[64]), CAST(c.ce AS DOUBLE[64]))
               AS distance
      FROM embeddings e, c)
SELECT vec_id, cluster, ROUND(distance, 6) AS distance
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY distance, cluster) AS i FROM d) t WHERE i = 1""")
def _u3(spark, d):
    emb = table(spark, d, "embeddings")
    firsts = emb.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("ce"))
    rows = firsts.orderBy("label").collect()  # one row per label: the centres
    centres = [[float(x) for x in r["ce"]] for r in rows]
    r = U.assign_clusters(emb, "vec_id", "embedding", centres)
    return r.withColumn("distance", F.round("distance", 6))


def _profile(spark, d):
    return materialize(Fe.profile_matrix(entity_field(spark, d, with_rank=False), fields=EF_FIELDS), "profile")


F_COLS = [f"f_{v.lower()}" for v in EF_FIELDS]


@register("u5_similar_entities", f"""WITH {EF_SQL},
pm AS (SELECT entity, {", ".join(f"CAST(SUM(CASE WHEN field = '{v}' THEN citations ELSE 0 END) AS DOUBLE) AS f_{v.lower()}"
                                  for v in EF_FIELDS)} FROM ef GROUP BY entity),
a AS (SELECT * FROM pm WHERE entity = {ENTITY}),
dd AS (SELECT pm.entity, SQRT({" + ".join(f"(pm.{c} - a.{c}) * (pm.{c} - a.{c})" for c in F_COLS)}) AS distance
       FROM pm, a WHERE pm.entity <> {ENTITY})
SELECT entity, ROUND(distance, 6) AS distance, rk FROM (SELECT entity, distance,
       CAST(ROW_NUMBER() OVER (ORDER BY distance, entity) AS BIGINT) AS rk FROM dd) t WHERE rk <= 5""")
def _u5(spark, d):
    r = U.similar_entities(_profile(spark, d), "entity", F_COLS, ENTITY, 5)
    return r.withColumn("distance", F.round("distance", 6))


@register("u1_kmeans")
def _u1(spark, d):
    _, assigned = U.kmeans_cluster(_profile(spark, d), "entity", F_COLS, 4, seed=42)
    return assigned


@register("u4_choose_k")
def _u4k(spark, d):
    return U.choose_k(_profile(spark, d), "entity", F_COLS, [2, 3, 4, 5])


@register("u6_project_2d")
def _u6(spark, d):
    return U.project_2d(_profile(spark, d), "entity", F_COLS)


@register("p5_feature_weights")
def _p5w(spark, d):
    ef, train, _, _ = _p_parts(spark, d)
    model = P.train_rank_model(train, ["field"], [], algo="linear", log_nums=["docs", "cpp"])
    return spark.createDataFrame(P.feature_weights(model, train), "feature string, weight double")


# ---- streaming import of arriving CSV files ------------------------------------

@register("s6_stream_import_ok", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders WHERE o_orderkey % 7 NOT IN (0, 3)""")
def _s6_stream(spark, d):
    from rankforge.streaming import import_stream, read_imported
    o = table(spark, d, "orders")
    raw = S.string_stage(o)
    k = F.col("o_orderkey").cast("bigint") % 7
    raw = raw.withColumn("o_totalprice", F.when(k == 0, F.concat("o_totalprice", F.lit("x")))
                         .otherwise(F.col("o_totalprice")))
    raw = raw.withColumn("o_custkey", F.when(k == 3, F.concat(F.lit("c"), "o_custkey"))
                         .otherwise(F.col("o_custkey")))
    root = scratch_path(spark, "stream-import")
    # downloads arrive as one CSV file set per order priority
    S.write_csv(raw.withColumn("prio", F.col("o_orderpriority")), f"{root}/in", partition_by=["prio"])
    q = import_stream(spark, f"{root}/in/*", o.schema, f"{root}/staged", f"{root}/ckpt",
                      required=("o_orderkey",))
    q.awaitTermination()
    ok = read_imported(spark, f"{root}/staged", o.schema)
    return ok.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


# ---- further forms of the same operators ----------------------------------------

@register("c4_histogram_by_type_filled", """WITH b AS (SELECT event_type, MIN(value) AS vlo, MAX(value) AS vhi FROM events
                      WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY event_type),
x AS (SELECT e.event_type, CASE WHEN vhi = vlo THEN 0
                  ELSE LEAST(CAST(FLOOR((value - vlo) / ((vhi - vlo) / 40.0)) AS BIGINT), 39) END AS bin
      FROM events e JOIN b ON e.event_type = b.event_type WHERE value IS NOT NULL AND NOT isnan(value)),
c AS (SELECT event_type, bin, COUNT(*) AS n FROM x GROUP BY 1, 2),
g AS (SELECT b.event_type, vlo, vhi, CAST(s.bin AS BIGINT) AS bin FROM b, range(0, 40) s(bin))
SELECT g.event_type, g.bin, vlo + CAST(g.bin AS DOUBLE) * ((vhi - vlo) / 40.0) AS lo,
       vlo + CAST(g.bin + 1 AS DOUBLE) * ((vhi - vlo) / 40.0) AS hi, CAST(COALESCE(c.n, 0) AS BIGINT) AS n
FROM g LEFT JOIN c ON g.event_type = c.event_type AND g.bin = c.bin""")
def _c4f(spark, d):
    return C.histogram(table(spark, d, "events"), "value", 40, by=["event_type"], fill=True)


@register("c2_impute_mode_constant", f"""WITH {DL_SQL},
m AS (SELECT lang, quality FROM (SELECT lang, quality,
        ROW_NUMBER() OVER (PARTITION BY lang ORDER BY COUNT(*) DESC, quality) AS i
        FROM d WHERE quality IS NOT NULL GROUP BY lang, quality) t WHERE i = 1),
a AS (SELECT quality AS aq FROM (SELECT quality, COUNT(*) AS k FROM d WHERE quality IS NOT NULL
        GROUP BY quality ORDER BY k DESC, quality LIMIT 1) t)
SELECT d.doc_id, d.lang, COALESCE(d.quality, m.quality, a.aq) AS quality, d.quality IS NULL AS quality_was_missing,
       COALESCE(d.toxic, -1) AS toxic, d.toxic IS NULL AS toxic_was_missing
FROM d LEFT JOIN m ON d.lang IS NOT DISTINCT FROM m.lang, a""")
def _c2m(spark, d):
    r = C.impute(documents_labels(spark, d), {"quality": "mode", "toxic": ("constant", -1)}, by=["lang"])
    return r.select("doc_id", "lang", "quality", "quality_was_missing", "toxic", "toxic_was_missing")


@register("f4_strengths_all_entities", f"""WITH {EF_SQL},
e AS (SELECT entity, field, rank,
             CAST(citations AS DOUBLE) / NULLIF(CAST(SUM(citations) OVER (PARTITION BY entity) AS DOUBLE), 0) AS share
      FROM ef),
b AS (SELECT entity, 'best' AS kind, field, rank, share,
             ROW_NUMBER() OVER (PARTITION BY entity ORDER BY rank, share DESC, field) AS i FROM e),
w AS (SELECT entity, 'worst' AS kind, field, rank, share,
             ROW_NUMBER() OVER (PARTITION BY entity ORDER BY rank DESC, share, field) AS i FROM e)
SELECT entity, kind, field, rank, ROUND(share, 6) AS share FROM b WHERE i <= 2
UNION ALL SELECT entity, kind, field, rank, ROUND(share, 6) AS share FROM w WHERE i <= 2""")
def _f4all(spark, d):
    r = Fe.entity_strengths(materialize(entity_field(spark, d), "ef-ranked"), None, 2)  # read for totals, best and worst
    return r.withColumn("share", F.round("share", 6))


@register("k4_apply_changes_full", """WITH ch AS (
  SELECT o_custkey AS c_custkey, CAST(NULL AS VARCHAR) AS c_name, CAST(NULL AS INTEGER) AS c_nationkey,
         o_totalprice AS c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment, o_orderkey AS seq, 'U' AS op
  FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT o_custkey, NULL, NULL, NULL, NULL, o_orderkey, 'D'
  FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F'
  UNION ALL
  SELECT o_orderkey + 1000000000, 'new-' || CAST(o_orderkey AS VARCHAR), 0, o_totalprice, 'NEW', o_orderkey, 'I'
  FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'P'),
l AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY c_custkey ORDER BY seq DESC) AS i FROM ch) t
      WHERE i = 1)
SELECT COALESCE(b.c_custkey, l.c_custkey) AS c_custkey,
       CASE WHEN l.op IS NOT NULL THEN l.c_name ELSE b.c_name END AS c_name,
       CASE WHEN l.op IS NOT NULL THEN l.c_nationkey ELSE b.c_nationkey END AS c_nationkey,
       CASE WHEN l.op IS NOT NULL THEN l.c_acctbal ELSE b.c_acctbal END AS c_acctbal,
       CASE WHEN l.op IS NOT NULL THEN l.c_mktsegment ELSE b.c_mktsegment END AS c_mktsegment
FROM customer b FULL OUTER JOIN l ON b.c_custkey = l.c_custkey
WHERE l.op IS NULL OR l.op <> 'D'""")
def _k4full(spark, d):
    return R.apply_changes(table(spark, d, "customer"), _k4_changes(spark, d), ["c_custkey"], "seq", "op")


@register("q3_global_overview_approx")
def _q3a(spark, d):
    return Q.global_overview(entity_field(spark, d, with_rank=False), approx=True)


@register("c3_numeric_summary_approx")
def _c3a(spark, d):
    return C.numeric_summary(table(spark, d, "lineitem"), LI_NUM, exact=False)


@register("q6_rank_by_return_flag", """SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice,
       CAST(RANK() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC) AS BIGINT) AS rk,
       CAST(DENSE_RANK() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC) AS BIGINT) AS drk
FROM lineitem""")
def _q6flag(spark, d):
    """Three groups, one holding about half of all rows: the skewed case the
    rank engine splits once a group outgrows one task."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return rank_columns(li, ["l_returnflag"], "l_extendedprice", {"rk": "rank", "drk": "dense_rank"})
