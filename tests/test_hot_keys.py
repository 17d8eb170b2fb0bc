"""Hot keys on real rows: one key holds a third of lineitem (sf0.01). The
hot paths (forced with small limits) are checked against DuckDB brute force."""

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import rows
from rankforge.operators.dedup import first_per_key
from rankforge.operators.ranking import exact_quantiles, rank_columns

PATH = "/root/testdata/sf0.01/lineitem.parquet"
HOT = "CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END"


@pytest.fixture(scope="module")
def li(spark):
    return spark.read.parquet(PATH).select(
        F.expr(HOT).alias("k"), "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")


def _duck(sql):
    return duckdb.sql(sql.replace("LI", f"(SELECT {HOT} AS k, l_linenumber, l_partkey, l_extendedprice, "
                                        f"l_quantity FROM read_parquet('{PATH}'))")).fetchall()


def _sorted(rs):
    return sorted(rs, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_first_per_key_hot_key(spark, li):
    first, rest = first_per_key(li, ["k"], [("l_extendedprice", False)], max_key_rows=1000)
    exp = _duck("""SELECT k, l_linenumber, l_partkey, l_extendedprice, l_quantity FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY l_extendedprice DESC, l_linenumber,
               l_partkey, l_extendedprice, l_quantity) AS i FROM LI) t WHERE i = 1""")
    assert rows(first) == _sorted(exp)
    assert rest.count() + first.count() == li.count()


def test_rank_hot_group(spark, li):
    g = li.withColumn("g", (F.col("k") == 0).cast("int"))
    got = rank_columns(g, ["g"], "l_extendedprice", {"rk": "rank", "drk": "dense_rank"}, max_group_rows=2000)
    exp = _duck("""SELECT k, l_linenumber, l_partkey,
        RANK() OVER (PARTITION BY (k = 0) ORDER BY l_extendedprice DESC) AS rk,
        DENSE_RANK() OVER (PARTITION BY (k = 0) ORDER BY l_extendedprice DESC) AS drk FROM LI""")
    assert rows(got, ["k", "l_linenumber", "l_partkey", "rk", "drk"]) == _sorted(exp)


def test_quantiles_hot_group(spark, li):
    g = li.withColumn("g", (F.col("k") == 0).cast("int"))
    got = {r["g"]: r for r in exact_quantiles(g, "l_quantity", [0.1, 0.5, 0.9], ["g"],
                                              names=["a", "b", "c"], buckets=16).collect()}
    exp = _duck("""SELECT CAST(k = 0 AS INTEGER) AS g, QUANTILE_CONT(l_quantity, 0.1), QUANTILE_CONT(l_quantity, 0.5),
                   QUANTILE_CONT(l_quantity, 0.9) FROM LI GROUP BY 1""")
    for gval, a, b, c in exp:
        assert (got[gval]["a"], got[gval]["b"], got[gval]["c"]) == pytest.approx((a, b, c), rel=1e-12)
