"""Clustering of entities.

Centres are few (k x d numbers) and travel to the tasks with the function
that finds the nearest one; data rows never leave the executors."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.joins import broadcast_if_small
from rankforge.session import materialize

#: Differences a task holds at a time (rows x centres x coordinates).
BLOCK = 1 << 21


def _nearest(vector: Column, centres: Sequence[Sequence[float]]) -> Column:
    """struct(j, d): the nearest centre of an array and its squared distance,
    for any number of centres, in Arrow batches; ties go to the smaller j. A
    vector that is NULL, holds a NULL or has another length has no centre."""
    c = np.array([[float(x) for x in row] for row in centres], dtype=np.float64)
    if not c.size:
        raise ValueError("need at least one centre")
    step = max(1, BLOCK // c.size)

    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            rows = [np.asarray(v, dtype=np.float64) if v is not None and len(v) == c.shape[1] else np.full(c.shape[1], np.nan) for v in s]
            j, d = np.zeros(len(rows), dtype=np.int64), np.full(len(rows), np.nan)
            for i in range(0, len(rows), step):
                diff = np.stack(rows[i: i + step])[:, None, :] - c[None, :, :]
                sq = (diff * diff).sum(axis=2)
                j[i: i + step] = sq.argmin(axis=1)
                d[i: i + step] = sq.min(axis=1)
            gone = np.isnan(d)
            yield pd.DataFrame({"j": pd.Series(j, dtype="Int32").mask(gone), "d": pd.Series(d, dtype="Float64").mask(gone)})

    return F.pandas_udf(nearest, "j int, d double")(vector.cast("array<double>"))


def assign_to_centres(df: DataFrame, cols: Sequence[str], centres: Sequence[Sequence[float]],
                      out: str = "cluster", dist: str | None = None) -> DataFrame:
    """Nearest centre by squared Euclidean distance over numeric columns."""
    vector = F.array(*[F.col(c).cast("double") for c in cols])
    x = df.withColumn("__best", _nearest(vector, centres)).withColumn(out, F.col("__best.j"))
    if dist:
        x = x.withColumn(dist, F.sqrt(F.col("__best.d")))
    return x.drop("__best")


def kmeans_fixed_start(df: DataFrame, id_col: str, cols: Sequence[str],
                       init: Sequence[Sequence[float]], steps: int) -> tuple[DataFrame, list[list[float]]]:
    """Lloyd's KMeans from given centres for exactly ``steps`` updates,
    then a final assignment: ``(id, cluster)`` and the final centres.

    Each step is one aggregate job; only k centre rows come back. An empty
    cluster keeps its centre. NULL coordinates are refused: impute first. The
    ids and coordinates are written once and serve every step."""
    cols = list(cols)
    centres = [list(map(float, c)) for c in init]
    k = len(centres)
    data = materialize(df.select(id_col, *[F.col(c).cast("double").alias(c) for c in cols]), "kmeans")
    gap = F.lit(False)
    for c in cols:
        gap = gap | F.col(c).isNull()
    if data.filter(gap).limit(1).count():
        raise ValueError("a coordinate is NULL: impute it or drop its row first")
    for _ in range(steps):
        a = assign_to_centres(data, cols, centres)
        means = a.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in cols]).limit(k + 1).collect()
        for r in means:
            centres[r["cluster"]] = [float(r[c]) for c in cols]
    result = assign_to_centres(data, cols, centres).select(id_col, "cluster")
    return result, centres


def assign_clusters(df: DataFrame, id_col: str, vec_col: str, centres: Sequence[Sequence[float]],
                    out: str = "cluster") -> DataFrame:
    """Nearest of the given centres for an array column: ``id, cluster,
    distance`` (Euclidean, elements cast to double, ties to the smaller
    cluster number; NULL for a vector without a distance)."""
    return df.select(id_col, _nearest(F.col(vec_col), centres).alias("__b")).select(
        id_col, F.col("__b.j").alias(out), F.sqrt(F.col("__b.d")).alias("distance"))


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """z-scores from one global aggregate (scalar subqueries, no join);
    a constant column becomes 0."""
    stats = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols],
                   *[F.stddev_samp(F.col(c).cast("double")).alias(f"s_{c}") for c in cols])
    out = df
    for c in cols:
        m, s = stats.select(f"m_{c}").scalar(), stats.select(f"s_{c}").scalar()
        out = out.withColumn(c, F.when(s > 0, (F.col(c).cast("double") - m) / s).otherwise(F.lit(0.0)))
    return out


def kmeans_cluster(df: DataFrame, id_col: str, cols: Sequence[str], k: int, seed: int = 42,
                   max_iter: int = 20):
    """Spark ML KMeans on z-scored columns. Returns ``(model, assigned)``
    with clusters renumbered by size (largest first), then by the first
    centre coordinate. NULL rows are refused: impute first."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    cols = list(cols)
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=cols, outputCol="__raw", handleInvalid="error"),
        StandardScaler(inputCol="__raw", outputCol="__features", withMean=True, withStd=True),
        KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="__features", predictionCol="__c")])
    model = pipe.fit(df)
    pred = model.transform(df)
    centres = model.stages[-1].clusterCenters()
    sizes = {r["__c"]: r["n"] for r in pred.groupBy("__c").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(range(len(centres)), key=lambda j: (-sizes.get(j, 0), float(centres[j][0])))
    mapping = F.create_map(*[x for new, old in enumerate(order) for x in (F.lit(old), F.lit(new))])
    return model, pred.select(id_col, mapping[F.col("__c")].alias("cluster"))


def cluster_summary(assigned: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """U4: ``cluster, size, share, mean_<c>, sd_<c>..., cost`` with cost =
    sum of squared distances to the cluster mean."""
    cols = list(cols)
    total = assigned.agg(F.count(F.lit(1))).scalar()
    aggs = [F.count(F.lit(1)).cast("bigint").alias("size")]
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"mean_{c}"), F.stddev_samp(x).alias(f"sd_{c}"), F.var_pop(x).alias(f"__v_{c}")]
    g = assigned.groupBy(cluster).agg(*aggs)
    cost = None
    for c in cols:
        t = F.col(f"__v_{c}") * F.col("size")
        cost = t if cost is None else cost + t
    return g.select(cluster, "size", (F.col("size").cast("double") / total.cast("double")).alias("share"),
                    *[x for c in cols for x in (f"mean_{c}", f"sd_{c}")], cost.alias("cost"))


def choose_k(df: DataFrame, id_col: str, cols: Sequence[str], ks: Sequence[int], seed: int = 42) -> DataFrame:
    """U4: one KMeans per k: ``k, cost, silhouette, sizes`` (a small table;
    silhouette from ``ClusteringEvaluator``, NULL for k = 1)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    vec = VectorAssembler(inputCols=list(cols), outputCol="__raw").transform(df)
    vec = StandardScaler(inputCol="__raw", outputCol="features", withMean=True, withStd=True).fit(vec).transform(vec)
    vec = vec.select(id_col, "features").persist(StorageLevel.MEMORY_AND_DISK)
    rows = []
    for k in ks:
        if k == 1:  # one cluster: the squared distances to the mean, which is 0 after scaling
            z = vector_to_array(F.col("features"))
            cost, n = vec.agg(F.sum(F.aggregate(z, F.lit(0.0), lambda a, x: a + x * x)), F.count(F.lit(1))).first()
            rows.append((1, float(cost or 0.0), None, [n]))
            continue
        m = KMeans(k=k, seed=seed).fit(vec)
        pred = m.transform(vec)
        sil = ClusteringEvaluator().evaluate(pred) if k > 1 else None
        sizes = sorted(m.summary.clusterSizes, reverse=True)
        rows.append((int(k), float(m.summary.trainingCost), sil, sizes))
    vec.unpersist()
    spark = df.sparkSession
    return spark.createDataFrame(rows, "k int, cost double, silhouette double, sizes array<bigint>")


def similar_entities(df: DataFrame, id_col: str, cols: Sequence[str], anchor, k: int = 10,
                     within: str | None = None) -> DataFrame:
    """Entities nearest to ``anchor`` (Euclidean over ``cols``), the
    anchor left out, ties by id: ``id, distance, rk``. The anchor's row is
    fetched once (one row) and enters the distance as literals; ``within``
    restricts to the anchor's value of that column (e.g. its cluster). An
    absent anchor gives an empty result."""
    from rankforge.operators.ranking import top_k
    need = list(cols) + ([within] if within else [])
    found = df.filter(F.col(id_col) == F.lit(anchor)).select(*need).limit(2).collect()
    if len(found) > 1:
        raise ValueError(f"anchor {anchor!r} is not unique in {id_col}")
    x = df.filter(F.col(id_col) != F.lit(anchor))
    if not found:
        return top_k(x.select(id_col, F.lit(None).cast("double").alias("distance")).limit(0),
                     "distance", k, [id_col], out="rk", ascending=True)
    a = found[0]
    if within:
        x = x.filter(F.col(within) == F.lit(a[within]))
    sq = None
    for c in cols:
        d = F.col(c).cast("double") - F.lit(None if a[c] is None else float(a[c])).cast("double")
        sq = d * d if sq is None else sq + d * d
    x = x.select(id_col, F.sqrt(sq).alias("distance")).filter(F.col("distance").isNotNull())
    return top_k(x, "distance", k, [id_col], out="rk", ascending=True)


#: Points of a cell of ``similar_all``, about; and questions that are put to a cell at once.
CELL, ASKED = 1024, 4096
#: Parts that a cell is cut into at a level, at most.
FAN = 8


def _sum_of_squares(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [p * p for p in parts])


def _cut_cells(points: DataFrame, xs: Sequence[str], fan: int) -> DataFrame:
    """``points`` with every ``__cell`` cut into ``fan`` parts of about equal size (cell c: c * fan to c * fan + fan - 1).

    A cell is cut across its widest column, among those with enough different
    values; points on a cut are dealt out by hash to the parts on its sides, so
    that no part grows by equal values."""
    at = [i / fan for i in range(1, fan)]
    ways = [F.struct((2 * F.size(F.array_distinct(f"__c{i}")) >= fan - 1).alias("enough"), (F.element_at(f"__c{i}", -1) - F.col(f"__c{i}")[0]).alias("spread"),
                     F.lit(i).alias("i"), F.col(f"__c{i}").alias("cuts")) for i in range(len(xs))]
    cuts = points.groupBy("__cell").agg(*[F.percentile_approx(c, at, 200 * fan).alias(f"__c{i}") for i, c in enumerate(xs)])
    cuts = cuts.select("__cell", F.array_max(F.array(*ways)).alias("__cut"))
    x = points.join(broadcast_if_small(cuts, "cuts"), "__cell").withColumn("__x", F.array(*xs)[F.col("__cut.i")])
    low, high = (F.size(F.filter("__cut.cuts", f)) for f in (lambda c: c < F.col("__x"), lambda c: c <= F.col("__x")))
    part = low + F.pmod(F.xxhash64("__v", "__cell"), high - low + 1)
    return materialize(x.select("__v", *xs, (F.col("__cell") * fan + part).alias("__cell")), "cells")


def _distances():
    """The function that tasks compute distances with (made here, so that it travels with them)."""
    def distances(q: np.ndarray, p: np.ndarray):
        """(first row, distances of some rows of ``q`` to all of ``p``), squares added in the order of the columns."""
        step = max(1, BLOCK // max(1, len(p)))
        for i in range(0, len(q), step):
            sq = np.zeros((len(q[i: i + step]), len(p)))
            for c in range(q.shape[1]):
                diff = q[i: i + step, c, None] - p[None, :, c]
                sq += diff * diff
            yield i, np.sqrt(sq)

    return distances


def _reach(points: DataFrame, xs: Sequence[str], k: int) -> DataFrame:
    """(__q, __q<x>..., __reach, __cell 0): each point and its distance to the ``k``-th nearest of its own cell, infinite if there are fewer."""
    distances = _distances()

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        x = cell[list(xs)].to_numpy()
        reach = np.full(len(x), np.inf)
        if len(x) >= k:
            for i, d in distances(x, x):
                reach[i: i + len(d)] = np.partition(d, k - 1, axis=1)[:, k - 1]
        out = cell[["__v", *xs]].set_axis(["__q", *[f"__q{c}" for c in xs]], axis=1)
        return out.assign(__reach=reach, __cell=0)

    columns = ", ".join(f"__q{c} double" for c in xs)
    return points.groupBy("__cell").applyInPandas(run, f"__q long, {columns}, __reach double, __cell long")


def _nearest_of_cells(asked: DataFrame, points: DataFrame, xs: Sequence[str], k: int) -> DataFrame:
    """(__q, __v, __dist): of each question to a cell, the ``k`` nearest points there within its reach (ties by ``__v``)."""
    load = asked.groupBy("__cell").agg(F.ceil(F.count(F.lit(1)) / ASKED).cast("bigint").alias("__parts"))
    load = broadcast_if_small(load, "load")
    asked = asked.join(load, "__cell").withColumn("__part", F.pmod(F.xxhash64("__q"), F.col("__parts"))).drop("__parts")
    points = points.join(load, "__cell").withColumn("__part", F.explode(F.expr("sequence(0L, __parts - 1)"))).drop("__parts")

    distances = _distances()

    def run(asked: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        points = points.sort_values("__v")
        ids, p = points["__v"].to_numpy(), points[list(xs)].to_numpy()
        q, reach, names = asked[[f"__q{c}" for c in xs]].to_numpy(), asked["__reach"].to_numpy(), asked["__q"].to_numpy()
        found = []
        for i, d in distances(q, p):
            bound = reach[i: i + len(d)]
            if len(p) > k:
                bound = np.minimum(bound, np.partition(d, k - 1, axis=1)[:, k - 1])
            row, place = np.nonzero(d <= bound[:, None])
            dist = d[row, place]
            order = np.lexsort((place, dist, row))  # more than k only if the last are equally far
            row, place, dist = row[order], place[order], dist[order]
            kept = np.arange(len(row)) - np.searchsorted(row, row) < k
            found.append(pd.DataFrame({"__q": names[i + row[kept]], "__v": ids[place[kept]], "__dist": dist[kept]}))
        return pd.concat(found) if found else pd.DataFrame({"__q": [], "__v": [], "__dist": []})

    key = ["__cell", "__part"]
    return asked.groupBy(*key).cogroup(points.groupBy(*key)).applyInPandas(run, "__q long, __v long, __dist double")


def similar_all(df: DataFrame, id_col: str, cols: Sequence[str], k: int = 10, cells: int | None = None) -> DataFrame:
    """U5 for every entity: its ``k`` nearest others, exactly: ``id, neighbour, distance, rk`` (ties by id).

    The points are cut into cells of about ``CELL`` points, level by level. The
    k nearest in a point's own cell bound the distance of its k-th one; it then
    asks, down the levels, the cells whose box lies within that, and each gives
    its k nearest at most. No cross join takes place, no task sees more than a
    cell and ``ASKED`` questions at once, and the pairs of points compared
    aren't rows. Rows with the same coordinates are one point, which keeps its
    k + 1 smallest ids: more can't be needed, and a place that a third of all
    rows share costs one point. Rows with a coordinate that is NULL, NaN or
    infinite have no neighbours and are none. ``cells`` (about that many)
    changes the work, not the result."""
    cols = list(cols)
    x = df.select(F.col(id_col).alias("__id"), *[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(cols)])
    xs = [f"__x{i}" for i in range(len(cols))]
    x = x.where(reduce(lambda a, b: a & b, [F.abs(c) < float("inf") for c in xs]) & F.col("__id").isNotNull())
    place = Window.partitionBy(*xs).orderBy("__id")
    first = x.withColumn("__n", F.row_number().over(place)).where(F.col("__n") <= k + 1)
    points = first.groupBy(*xs).agg(F.array_sort(F.collect_list("__id")).alias("__ids"))
    # numbered in the order of their first ids, which decides between points equally far
    points = materialize(materialize(points, "places").orderBy(F.col("__ids")[0]).withColumn("__v", F.monotonically_increasing_id()), "points")
    n = points.count()
    none = x.select(F.col("__id").alias(id_col), F.col("__id").alias("neighbour"), F.lit(0.0).alias("distance"), F.lit(0).cast("bigint").alias("rk")).limit(0)
    if not n:
        return none
    wanted = min(n, cells or math.ceil(n / max(CELL, 8 * (k + 1))))
    levels = next(i for i in range(64) if FAN ** i >= wanted)
    fan = math.ceil(wanted ** (1 / levels)) if levels else 1
    placed = points.select("__v", *xs, F.lit(0).cast("bigint").alias("__cell"))
    for _ in range(levels):
        placed = _cut_cells(placed, xs, fan)
    asked = materialize(_reach(placed, xs, k + 1), "reach")
    sides = [f(c).alias(f"{s}{c}") for c in xs for f, s in ((F.min, "__low"), (F.max, "__high"))]
    boxes = materialize(placed.groupBy(F.col("__cell").alias("__box")).agg(*sides), "boxes") if levels else None
    for level in reversed(range(levels)):
        sides = [f(f"{s}{c}").alias(f"{s}{c}") for c in xs for f, s in ((F.min, "__low"), (F.max, "__high"))]
        here = boxes.groupBy(F.expr(f"__box div {fan ** level}").alias("__box")).agg(*sides).withColumn("__in", F.expr(f"__box div {fan}"))
        asked = asked.join(broadcast_if_small(here, "boxes"), F.col("__cell") == F.col("__in"))
        # added up as the distances are, so that a box is never farther than a point in it
        gap = F.sqrt(_sum_of_squares([F.greatest(F.col(f"__low{c}") - F.col(f"__q{c}"), F.col(f"__q{c}") - F.col(f"__high{c}"), F.lit(0.0)) for c in xs]))
        asked = asked.where(gap <= F.col("__reach")).select("__q", *[f"__q{c}" for c in xs], "__reach", F.col("__box").alias("__cell"))
    near = _nearest_of_cells(materialize(asked, "asked") if levels else asked, placed, xs, k + 1)
    near = near.groupBy("__q").agg(F.slice(F.array_sort(F.collect_list(F.struct("__dist", "__v"))), 1, k + 1).alias("__near"))
    near = materialize(near.select("__q", F.explode("__near").alias("__p")).select("__q", "__p.*"), "near").join(points.select("__v", "__ids"), "__v")
    # k + 1 points of k + 1 ids at most
    each = near.select("__q", F.explode(F.transform("__ids", lambda i: F.struct(F.col("__dist").alias("distance"), i.alias("neighbour")))).alias("__e"))
    lists = each.groupBy("__q").agg(F.slice(F.array_sort(F.collect_list("__e")), 1, k + 1).alias("__near"))
    lists = points.join(lists, F.col("__v") == F.col("__q")).select(*xs, "__near")
    own = x.join(broadcast_if_small(lists, "neighbours"), xs)
    others = F.slice(F.filter("__near", lambda e: e["neighbour"] != F.col("__id")), 1, k)
    return own.select(F.col("__id").alias(id_col), F.posexplode(others).alias("__k", "__e")).select(
        id_col, F.col("__e.neighbour").alias("neighbour"), F.col("__e.distance").alias("distance"), (F.col("__k") + 1).cast("bigint").alias("rk"))


def project_2d(df: DataFrame, id_col: str, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """First two principal components of the z-scored columns, each
    signed so that its largest absolute loading is positive (of loadings equal
    within 1e-9, the first column's)."""
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    cols = list(cols)
    if len(cols) < 2:
        raise ValueError("project_2d needs at least two columns")
    vec = VectorAssembler(inputCols=cols, outputCol="__raw").transform(df)
    vec = StandardScaler(inputCol="__raw", outputCol="__z", withMean=True, withStd=True).fit(vec).transform(vec)
    pca = PCA(k=2, inputCol="__z", outputCol="__p").fit(vec)
    pc = pca.pc.toArray()  # d x 2 loadings: small
    signs = []
    for j in range(2):
        col = pc[:, j]
        big = int(np.argmax(np.abs(col) >= np.abs(col).max() - 1e-9))
        signs.append(1.0 if col[big] >= 0 else -1.0)
    arr = vector_to_array(F.col("__p"))
    return pca.transform(vec).select(id_col, *keep, (arr[0] * signs[0]).alias("x"), (arr[1] * signs[1]).alias("y"))
