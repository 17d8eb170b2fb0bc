"""Rank prediction: split, closed-form and pipeline models, batch
prediction, metrics, residual analysis, model comparison (P1-P7).

Labels (ranks) are computed over all entities before the split; every
statistic a model uses (coefficients, encodings, means) is fitted on
training rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions.columns import null_safe_join
from rankforge.functions.joins import join_back
from rankforge.operators.encoding import FrequencyEncoder, learned_vectors, with_vectors
from rankforge.operators.ranking import DEFAULT_BUCKETS, exact_quantiles, positions, rank_within
from rankforge.session import materialize


def fold_of(key: str | Column, n_folds: int, key_type: T.DataType | None = None) -> Column:
    """Deterministic fold of a key: ``pmod(key, n)`` for integers, else
    ``pmod`` of the first 15 hex digits of md5 of the text."""
    c = F.col(key) if isinstance(key, str) else key
    if isinstance(key_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.pmod(c, F.lit(n_folds))
    h = F.conv(F.substring(F.md5(c.cast("string").cast("binary")), 1, 15), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(n_folds))


def is_test(df: DataFrame, key: str, n_folds: int = 5, test_fold: int = 0) -> Column:
    """P7 flag: the row's key falls in the test fold (NULL key: train)."""
    f = fold_of(key, n_folds, df.schema[key].dataType)
    return F.coalesce(f == F.lit(test_fold), F.lit(False))


def split_by_key(df: DataFrame, key: str, n_folds: int = 5, test_fold: int = 0
                 ) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``; all rows of one key land on one side; a NULL
    key goes to train. Narrow filters, no shuffle."""
    flag = is_test(df, key, n_folds, test_fold)
    return df.filter(~flag), df.filter(flag)


def fit_rank_linear(train: DataFrame, x: str = "docs", y: str = "rank", by: Sequence[str] = ("field",),
                    log_x: bool = True) -> DataFrame:
    """Least squares of ``y`` on ``log1p(x)`` (or ``x``) per group:
    ``by..., slope, intercept, n``. Groups with fewer than two distinct x
    values get no row."""
    by = list(by)
    xs = F.log1p(F.col(x).cast("double")) if log_x else F.col(x).cast("double")
    t = train.select(*by, xs.alias("__x"), F.col(y).cast("double").alias("__y")).dropna(subset=["__x", "__y"])
    g = t.groupBy(*by).agg(F.regr_slope("__y", "__x").alias("slope"),
                           F.regr_intercept("__y", "__x").alias("intercept"),
                           F.count(F.lit(1)).cast("bigint").alias("n"),
                           F.count_distinct("__x").alias("__dx"))
    return g.filter(F.col("__dx") >= 2).drop("__dx")


def raw_prediction(coefs: DataFrame, train: DataFrame, df: DataFrame, x: str = "docs", y: str = "rank",
                   by: Sequence[str] = ("field",), log_x: bool = True) -> DataFrame:
    """``df`` plus ``raw``, the P1 prediction before any re-rank (see ``predict_ranks``)."""
    by = list(by)
    mu = train.agg(F.avg(F.col(y).cast("double"))).scalar()
    xs = F.log1p(F.col(x).cast("double")) if log_x else F.col(x).cast("double")
    j = join_back(df, coefs.select(*by, "slope", "intercept"), by, "left")
    raw = F.coalesce(F.col("slope") * xs + F.col("intercept"), mu)
    return j.withColumn("raw", F.when(xs.isNotNull(), F.greatest(raw, F.lit(1.0)))).drop("slope", "intercept")


def save_model(model, path: str) -> None:
    """Write a fitted pipeline under ``path``, in place of an earlier one."""
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def predict_with_model(model, df: DataFrame, y: str = "rank", by: Sequence[str] = ("field",), entity: str = "entity",
                       buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """P3 with a fitted (or loaded) pipeline: its prediction clamped to >= 1 as
    ``raw``, re-ranked ascending inside the group as ``predicted_rank``."""
    by = list(by)
    p = model.transform(df).withColumn("raw", F.when(F.col("prediction").isNotNull(), F.greatest("prediction", F.lit(1.0))))
    r = rank_within(p.select(entity, *by, y, "raw"), by, "raw", "rank", ascending=True, out="predicted_rank", buckets=buckets)
    return r.select(entity, *by, F.col(y).cast("bigint").alias(y), "raw",
                    F.when(F.col("raw").isNotNull(), F.col("predicted_rank")).alias("predicted_rank"))


def predict_ranks(coefs: DataFrame, train: DataFrame, df: DataFrame, x: str = "docs", y: str = "rank",
                  by: Sequence[str] = ("field",), entity: str = "entity", entity_id=None,
                  log_x: bool = True, buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """``raw = slope * f(x) + intercept`` clamped to >= 1; groups without
    coefficients fall back to the training mean of ``y``. A row without ``x``
    has no prediction (NULL raw and rank). ``predicted_rank`` re-ranks raw
    ascending inside the group (ties share a rank)."""
    by = list(by)
    j = raw_prediction(coefs, train, df, x, y, by, log_x)
    r = rank_within(j, by, "raw", "rank", ascending=True, out="predicted_rank", buckets=buckets)
    r = r.withColumn("predicted_rank", F.when(F.col("raw").isNotNull(), F.col("predicted_rank")))
    if entity_id is not None:
        r = r.filter(F.col(entity) == F.lit(entity_id))
    return r.select(entity, *by, F.col(y).cast("bigint").alias(y), "raw", "predicted_rank")


def regression_metrics(pred: DataFrame, label: str, prediction: str,
                       by: Sequence[str] = ()) -> DataFrame:
    """``by..., n, n_missing, mae, rmse, r2`` (rows with a NULL
    prediction are counted in ``n_missing`` and left out). Constant labels
    give a NULL r2."""
    by = list(by)
    yv, pv = F.col(label).cast("double"), F.col(prediction).cast("double")
    ok = yv.isNotNull() & pv.isNotNull()
    e = F.when(ok, yv - pv)
    aggs = [F.count(e).cast("bigint").alias("n"),
            F.sum(F.when(pv.isNull(), 1).otherwise(0)).cast("bigint").alias("n_missing"),
            F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
            F.sum(e * e).alias("__sse"), (F.var_pop(F.when(ok, yv)) * F.count(e)).alias("__sst")]
    g = pred.groupBy(*by).agg(*aggs) if by else pred.agg(*aggs)
    r2 = F.when(F.col("__sst") > 0, F.lit(1.0) - F.col("__sse") / F.col("__sst"))
    return g.select(*by, "n", "n_missing", "mae", "rmse", r2.alias("r2"))


BANDS = ((1, 10, "1-10"), (11, 50, "11-50"), (51, 100, "51-100"), (101, None, ">100"))


def rank_band(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    out = F.lit(None).cast("string")
    for lo, hi, name in reversed(BANDS):
        cond = c >= lo if hi is None else (c >= lo) & (c <= hi)
        out = F.when(cond, F.lit(name)).otherwise(out)
    return out


def residual_report(pred: DataFrame, label: str = "rank", prediction: str = "raw",
                    by: Sequence[str] = ("field",)) -> DataFrame:
    """P5: residuals ``e = label - prediction`` per group and rank band:
    ``by..., band, n, mean_error, median_error, mean_abs_error``."""
    by = list(by)
    x = pred.select(*by, rank_band(label).alias("band"),
                    (F.col(label).cast("double") - F.col(prediction).cast("double")).alias("__e")) \
        .filter(F.col("__e").isNotNull())
    g = x.groupBy(*by, "band").agg(F.avg("__e").alias("mean_error"),
                                   F.avg(F.abs("__e")).alias("mean_abs_error"))
    med = exact_quantiles(x, "__e", [0.5], by + ["band"], names=["median_error"])
    j = null_safe_join(g, med, by + ["band"], "inner")  # two aggregates
    return j.select(*by, "band", "n", "mean_error", "median_error", "mean_abs_error")


def train_rank_model(train: DataFrame, cats: Sequence[str], nums: Sequence[str], label: str = "rank",
                     algo: str = "linear", seed: int = 42, log_nums: Sequence[str] = ()):
    """Spark ML pipeline: index + one-hot encode categories (dictionaries
    that stay tables), log1p the named numeric columns, assemble, regress.
    ``algo`` is ``linear``, ``forest``, ``gbt`` or ``fm``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import SQLTransformer, VectorAssembler
    from pyspark.ml.regression import (FMRegressor, GBTRegressor, LinearRegression,
                                       RandomForestRegressor)
    cats, nums = list(cats), list(nums)
    stages = []
    if log_nums:
        expr = ", ".join(f"LN(1 + CAST(`{c}` AS DOUBLE)) AS `log1p_{c}`" for c in log_nums)
        stages.append(SQLTransformer(statement=f"SELECT *, {expr} FROM __THIS__"))
    feats = [f"log1p_{c}" for c in log_nums] + nums
    if cats:
        stages.append(FrequencyEncoder(cats))
        feats += [f"{c}_vec" for c in cats]
    stages.append(VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="error"))
    lab = F.col(label).cast("double")
    if algo == "linear":
        reg = LinearRegression(labelCol=label)
    elif algo == "forest":
        reg = RandomForestRegressor(labelCol=label, seed=seed, numTrees=50)
    elif algo == "gbt":
        reg = GBTRegressor(labelCol=label, seed=seed, maxIter=30)
    elif algo == "fm":
        reg = FMRegressor(labelCol=label, seed=seed)
    else:
        raise ValueError(f"unknown algo {algo!r}")
    stages.append(reg)
    return Pipeline(stages=stages).fit(train.withColumn(label, lab))


def feature_weights(model, df: DataFrame | None = None) -> list[tuple[str, float]]:
    """P5: (attribute name, weight) of a fitted pipeline's regressor:
    coefficients for linear models, importances for trees. Names come from
    the assembled vector's ML attributes when a frame is given (a
    zero-row transform, no data read)."""
    reg = model.stages[-1]
    if hasattr(reg, "coefficients"):
        w = reg.coefficients.toArray()
    elif hasattr(reg, "featureImportances"):
        w = reg.featureImportances.toArray()
    else:
        w = reg.linear.toArray()
    names = [f"f{i}" for i in range(len(w))]
    if df is not None:
        meta = model.transform(df.limit(0)).schema[reg.getFeaturesCol()].metadata.get("ml_attr", {})
        for group in meta.get("attrs", {}).values():
            for attr in group:
                if attr["idx"] < len(names):
                    names[attr["idx"]] = attr["name"]
    return list(zip(names, [float(v) for v in w]))


def compare_models(train: DataFrame, test: DataFrame, specs: dict, label: str = "rank",
                   by: str = "field", p1_x: str | None = "docs") -> DataFrame:
    """Each spec (``name -> kwargs of train_rank_model``) is trained on
    the same train rows and scored on the same test rows, next to the
    constant baseline "train mean per field" and the closed-form model of P1
    on ``p1_x``; ``model, n, mae, rmse, r2``. A failing spec raises. A spec
    may hold ``learned = {"row", "col", "value", "rank"}``: the vectors of
    ``col`` learned on the train rows enter as numeric columns."""
    frames = []
    mu = train.agg(F.avg(F.col(label).cast("double"))).scalar()
    base_means = train.groupBy(by).agg(F.avg(F.col(label).cast("double")).alias("prediction"))
    base = test.join(base_means, by, "left").withColumn("prediction", F.coalesce("prediction", mu))
    frames.append(regression_metrics(base, label, "prediction").withColumn("model", F.lit("baseline_mean")))
    if p1_x:
        p1 = raw_prediction(fit_rank_linear(train, p1_x, label, [by]), train, test, p1_x, label, [by])
        frames.append(regression_metrics(p1, label, "raw").withColumn("model", F.lit("p1_linear")))
    for name, kw in specs.items():
        kw, tr, te = dict(kw), train, test
        learned = kw.pop("learned", None)
        if learned:
            c, rank = learned["col"], learned.get("rank", 4)
            vectors = learned_vectors(train, learned["row"], c, learned["value"], rank)[c]
            tr, te = (with_vectors(x, vectors, c, f"{c}_lv", rank) for x in (train, test))
            kw["nums"] = [*kw.get("nums", ()), *[f"{c}_lv_{i}" for i in range(rank)]]
        model = train_rank_model(tr, label=label, **kw)
        pred = model.transform(te.withColumn(label, F.col(label).cast("double")))
        frames.append(regression_metrics(pred, label, "prediction").withColumn("model", F.lit(name)))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.select("model", "n", "mae", "rmse", "r2")


def cross_validate(df: DataFrame, key: str, specs: dict, n_folds: int = 5, label: str = "rank", by: str = "field",
                   p1_x: str | None = "docs") -> DataFrame:
    """P6 over every fold of P7: ``model, fold, n, mae, rmse, r2``.

    All rows of one key are in one fold; a NULL key is always trained on. The
    input is written once and serves every fold."""
    data = materialize(df, "folds")
    out = None
    for fold in range(n_folds):
        train, test = split_by_key(data, key, n_folds, fold)
        got = compare_models(train, test, specs, label, by, p1_x).withColumn("fold", F.lit(fold))
        out = got if out is None else out.unionByName(got)
    return out.select("model", "fold", "n", "mae", "rmse", "r2")


def permuted(df: DataFrame, col: str, key: Sequence[str], seed: int = 42) -> DataFrame:
    """``df`` with the values of ``col`` dealt anew: the i-th row by ``key`` gets the value of the i-th row by the MD5 of seed and key.

    ``key`` must tell rows apart. Both places come from cluster-wide sorts; the rows meet by place."""
    keys = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    rows = positions(df, [F.col(k).asc_nulls_first() for k in key], "__place")
    dealt = positions(df.select(F.col(col).alias("__new"), F.md5(keys.cast("binary")).alias("__h")), [F.col("__h")], "__place").select("__place", "__new")
    return rows.join(dealt, "__place").withColumn(col, F.col("__new")).select(*df.columns)


def permutation_weights(model, df: DataFrame, cols: Sequence[str], key: Sequence[str], label: str = "rank", seed: int = 42) -> DataFrame:
    """P5 for a fitted pipeline of any kind: ``feature, rmse, weight``.

    ``weight`` is by how much the RMSE on ``df`` grows when the column is dealt
    anew (``permuted``), so linear models, trees and factor models compare;
    ``feature`` NULL has the RMSE on the rows as they are, weight 0."""
    data = materialize(df, "to-permute")

    def rmse(x: DataFrame) -> DataFrame:
        e = F.col("prediction") - F.col(label).cast("double")
        return model.transform(x.withColumn(label, F.col(label).cast("double"))).agg(F.sqrt(F.avg(e * e)).alias("rmse"))

    base = materialize(rmse(data), "rmse")
    out = base.select(F.lit(None).cast("string").alias("feature"), "rmse", F.lit(0.0).alias("weight"))
    for c in cols:
        got = rmse(permuted(data, c, key, seed))
        out = out.unionByName(got.select(F.lit(c).alias("feature"), "rmse", (F.col("rmse") - base.select("rmse").scalar()).alias("weight")))
    return out
