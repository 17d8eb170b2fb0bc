"""Embedding near-dedup with a forest of random-projection trees.

Every tree splits the unit vectors again and again by a random direction (the
difference of two of the node's sample vectors, of a few the one that spills
least) at the median; vectors within a margin of the cut go to both sides
(spill). A node whose sides would overlap by more than ``OVERLAP`` stays a leaf:
its vectors are too close to be told apart by a cut. The trees are fitted on a
bounded sample and then route every vector. Leaves that the sample was too small
to split (over ``AGAIN`` vectors) are split again, each by a tree of its own fitted
on a bounded sample of its vectors, until they are small or can't be cut; that work
is dealt out by leaf and parts of a leaf, and its trees never reach the driver.
Vectors that share
a leaf of any tree are compared in double precision; pairs at or above the
threshold are links, none below is. Links of all trees are united.

The margin is what two vectors at the threshold differ by along a random
direction. A leaf that holds more than ``TILE`` vectors is compared in tiles
of two blocks, so no task holds a whole large leaf and no pair of it is left
out. What leaves a tile is a row per vector (links counted, smallest vector
reached), so the pairs of a dense group are never written. Equal vectors are
one row throughout and are counted, not paired.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import materialize, small_side
from rankforge.llm.components import components

THRESHOLD = 0.95
TREES, LEAF, TILE = 8, 256, 1024
#: Most a split may add to the vectors of a node, as a share of them.
OVERLAP = 0.25
#: The trees are fitted on at most so many vectors; every vector is routed.
SAMPLE = 20_000
#: Leaves of more vectors are split again, by trees fitted on about so many of a leaf's vectors.
AGAIN, RESAMPLE = 4096, 4096
SEED = 11


class Tree:
    """Inner node i: ``axis[i]``, ``cut[i]``, ``child[i] = (left, right)``; a child < 0 is leaf ``-child - 1``."""

    def __init__(self, sample: np.ndarray, scale: float, leaf: int, margin: float, rng: np.random.Generator):
        axes, self.cut, self.child, self.leaves, self.margin = [], [], [], 0, margin
        todo = [(np.arange(len(sample)), None, 0)]
        while todo:
            rows, parent, side = todo.pop()
            split = self._split(sample[rows], rng, margin) if len(rows) * scale > leaf and len(rows) >= 8 else None
            if split is None:
                me = -(self.leaves + 1)
                self.leaves += 1
            else:
                axis, cut, p = split
                me = len(axes)
                axes.append(axis)
                self.cut.append(cut)
                self.child.append([0, 0])
                todo += [(rows[p <= cut + margin], me, 0), (rows[p >= cut - margin], me, 1)]
            if parent is not None:
                self.child[parent][side] = me
        self.axis = np.array(axes).reshape(len(axes), sample.shape[1])

    @staticmethod
    def _split(x: np.ndarray, rng: np.random.Generator, margin: float):
        best, least = None, OVERLAP * len(x)
        for _ in range(6):
            a, b = rng.choice(len(x), 2, replace=False)
            axis = x[a] - x[b]
            size = np.linalg.norm(axis)
            if size < 1e-9:
                continue
            p = x @ (axis / size)
            cut = float(np.median(p))
            spill = int((np.abs(p - cut) <= margin).sum())
            if spill <= least and p.min() < cut - margin and p.max() > cut + margin:
                best, least = (axis / size, cut, p), spill
        return best

    def route(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that each vector reaches."""
        rows, leaves, todo = [], [], [(0 if len(self.axis) else -1, np.arange(len(x)))]
        while todo:
            node, own = todo.pop()
            if not len(own):
                continue
            if node < 0:
                rows.append(own)
                leaves.append(np.full(len(own), -node - 1))
                continue
            p = x[own] @ self.axis[node]
            left, right = self.child[node]
            todo += [(left, own[p <= self.cut[node] + self.margin]), (right, own[p >= self.cut[node] - self.margin])]
        return np.concatenate(rows), np.concatenate(leaves)


def margin(dim: int, threshold: float) -> float:
    """Half of what two vectors at the threshold differ by along a random direction."""
    return 0.5 * np.sqrt(2 - 2 * threshold) / np.sqrt(dim)


def fit_forest(sample: np.ndarray, total: int, trees: int, leaf: int, threshold: float) -> list[Tree]:
    scale, spill = total / max(1, len(sample)), margin(sample.shape[1], threshold)
    return [Tree(sample, scale, leaf, spill, np.random.default_rng([SEED, t])) for t in range(trees)]


def _unit(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 1))
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _met_before(earlier: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Per pair of rows (i, j): do the two share one of their ``earlier`` leaves?"""
    (ui, at_i), (uj, at_j) = np.unique(i, return_inverse=True), np.unique(j, return_inverse=True)
    left, right = [earlier[r] for r in ui], [earlier[r] for r in uj]
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    if not len(both):
        return np.zeros(len(i), dtype=bool)

    def reached(lists: list[np.ndarray]) -> np.ndarray:
        flat, row = np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        known = np.isin(flat, both)
        m = np.zeros((len(lists), len(both)), dtype=np.float32)
        m[row[known], np.searchsorted(both, flat[known])] = 1
        return m

    return (reached(left) @ reached(right).T > 0)[at_i, at_j]


def _smallest_reachable(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Per row the smallest row that the links (i, j) lead to."""
    label = np.arange(n)
    while True:
        low, now = np.minimum(label[i], label[j]), label.copy()
        np.minimum.at(now, i, low)
        np.minimum.at(now, j, low)
        now = now[now]
        if (now == label).all():
            return label
        label = now


def split_again(vectors: DataFrame, routed: DataFrame, leaf: int, again: int, resample: int, margin_of) -> DataFrame:
    """(gid, dim, leaf: long) with every leaf of over ``again`` vectors split by a tree of its own, repeatedly.

    A leaf's tree is fitted on about ``resample`` of its vectors, in one task; the
    leaf's vectors are routed in parts of at most about ``again``, each beside a
    copy of the tree. A leaf whose tree has no cut stays whole (it is compared in
    tiles). A cut leaves at most ``(1 + OVERLAP) / 2`` of a sample on a side, so
    rounds end. New leaves are named by a hash of their leaf and place; should
    two share a name, their vectors are compared as one leaf."""
    def fit(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("gid")
        dim, at, n = key
        x = _unit(b["v"].to_numpy())
        tree = Tree(x, n / len(x), leaf, margin_of(dim), np.random.default_rng([SEED, at & 0xFFFFFFFF, (at >> 32) & 0xFFFFFFFF]))
        return pd.DataFrame({"dim": [dim], "leaf": [at], "n": [n], "tree": [pickle.dumps(tree)]}).head(int(tree.leaves > 1))

    def route(b: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        if not len(b):
            return pd.DataFrame({"gid": [], "dim": [], "leaf": [], "sub": []})
        row, sub = pickle.loads(trees["tree"].iloc[0]).route(_unit(b["v"].to_numpy()))
        return pd.DataFrame({"gid": b["gid"].to_numpy()[row], "dim": b["dim"].iloc[0], "leaf": b["leaf"].iloc[0], "sub": sub})

    done, at = [], ["dim", "leaf"]
    while True:
        wide = routed.groupBy(*at).agg(F.count("*").alias("n")).where(F.col("n") > again)
        wide = materialize(wide, "wide-leaves")
        if wide.isEmpty():
            return reduce(DataFrame.unionByName, done, routed)
        rows = routed.join(small_side(wide), at).join(vectors.select("gid", "v"), "gid")
        some = rows.where(F.pmod(F.xxhash64("gid", "leaf"), F.lit(1 << 30)) * F.col("n") < F.lit(resample * (1 << 30)))
        cuts = materialize(some.groupBy("dim", "leaf", "n").applyInPandas(fit, "dim int, leaf long, n long, tree binary"), "leaf-trees")
        split = small_side(materialize(cuts.select("dim", "leaf", "n"), "split-leaves"))
        done.append(routed.join(split, at, "left_anti"))
        parts = F.ceil(F.col("n") / F.lit(again)).cast("long")
        own = routed.join(split, at).join(vectors.select("gid", "v"), "gid").withColumn("part", F.pmod(F.xxhash64("gid"), parts))
        beside = cuts.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        keys = [*at, "part"]
        found = (own.select("gid", "dim", "leaf", "part", "v").groupBy(*keys).cogroup(beside.select(*keys, "tree").groupBy(*keys))
                 .applyInPandas(route, "gid long, dim int, leaf long, sub long"))
        routed = materialize(found.select("gid", "dim", F.xxhash64("leaf", "sub").alias("leaf")), "split")


def neighbours(vectors: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, leaf: int = LEAF, tile: int = TILE,
               sample_size: int = SAMPLE, again: int = AGAIN, resample: int = RESAMPLE) -> DataFrame:
    """Distinct valid vectors (gid: long, dim: int, copies: long, v: array<double>) ->
    rows (gid, n, root), one per vector and tile that finds links of it.

    ``n`` adds the copies of the vectors it is linked with there; a pair counts
    in the first leaf, over all trees, that holds both, so the sum of ``n`` per
    vector counts every link once. ``root`` is the smallest vector that the
    tile's links lead to: (gid, root) of all tiles connect what the links
    connect. A tile gives a row per vector, never its pairs."""
    sizes = {r["dim"]: r["n"] for r in vectors.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # distinct vector lengths
    forests = {}
    for dim, n in sizes.items():
        share = int(min(1.0, sample_size / n) * (1 << 32))
        some = vectors.where(F.col("dim") == dim).where(F.crc32(F.concat(F.lit("s"), F.col("gid").cast("string")).cast("binary")) < share)
        sample = some.select("v").limit(sample_size + sample_size // 10).toPandas()["v"]
        forests[dim] = fit_forest(_unit(sample), n, trees, leaf, threshold) if len(sample) else []

    def route(b: pd.DataFrame):
        """(dim, own rows, row, leaf): leaves numbered over all trees, by row and leaf."""
        for dim, own in b.groupby("dim"):
            found, first = [], 0
            for tree in forests.get(dim) or []:
                row, at = tree.route(_unit(own["v"].to_numpy()))
                found.append((row, at + first))
                first += tree.leaves
            if found:
                row, at = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((at, row))
                yield dim, own, row[order], at[order].astype(np.int32)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, _, _, at in route(b):
                where, n = np.unique(at, return_counts=True)
                yield pd.DataFrame({"dim": dim, "leaf": where, "n": n})

    # one row per leaf: bounded by the sample the trees were fitted on
    counts = vectors.mapInPandas(count, "dim int, leaf int, n long").groupBy("dim", "leaf").agg(F.sum("n").alias("n"))
    large = {(r["dim"], r["leaf"]): r["n"] for r in counts.where(F.col("n") > tile).collect()}
    blocks = {k: -(-n // tile) for k, n in large.items()}

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, own, row, at in route(b):
                gid, copies, v = (own[c].to_numpy() for c in ("gid", "copies", "v"))
                start = np.searchsorted(row, row)
                many = np.array([blocks.get((dim, x), 1) for x in at.tolist()])
                block = gid[row] % many
                for i in range(int(many.max())):  # a row meets block i in the tile of the two
                    for m in np.array_split(np.flatnonzero(many > i), trees):  # frames of about a tree
                        yield pd.DataFrame({"dim": dim, "leaf": at[m], "low": np.minimum(block[m], i), "high": np.maximum(block[m], i),
                                            "block": block[m], "earlier": [at[s:e] for s, e in zip(start[m], m)],
                                            "gid": gid[row[m]], "copies": copies[row[m]], "v": v[row[m]]})

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, own, row, at in route(b):
                yield pd.DataFrame({"gid": own["gid"].to_numpy()[row], "dim": dim, "leaf": at.astype(np.int64)})

    if max(large.values(), default=0) <= again:
        dealt = vectors.mapInPandas(deal, "dim int, leaf int, low long, high long, block long, earlier array<int>, gid long, copies long, v array<double>")
    else:
        routed = materialize(vectors.mapInPandas(leaves, "gid long, dim int, leaf long"), "leaves")
        routed = split_again(vectors, routed, leaf, again, resample, lambda dim: margin(dim, threshold))
        routed = materialize(routed, "final-leaves")
        many = routed.groupBy("dim", "leaf").agg(F.count("*").alias("n")).where(F.col("n") > tile)
        many = small_side(materialize(many.select("dim", "leaf", F.ceil(F.col("n") / F.lit(tile)).cast("long").alias("many")), "tiles"))
        every = routed.groupBy("gid").agg(F.array_sort(F.collect_list("leaf")).alias("all"))  # as many as the trees and their spill
        dealt = (vectors.join(every, "gid").select("gid", "dim", "copies", "v", "all", F.posexplode("all").alias("pos", "leaf"))
                 .join(many, ["dim", "leaf"], "left").withColumn("many", F.coalesce("many", F.lit(1).cast("long")))
                 .withColumn("block", F.pmod("gid", "many")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("many") - 1)))
                 .select("dim", "leaf", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block",
                         F.slice("all", F.lit(1), F.col("pos")).alias("earlier"), "gid", "copies", "v"))

    def compare(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("gid")
        x, gid, copies, block = _unit(b["v"].to_numpy()), b["gid"].to_numpy(), b["copies"].to_numpy(), b["block"].to_numpy()
        low, high = int(b["low"].iloc[0]), int(b["high"].iloc[0])
        p, q = np.flatnonzero(block == low), np.flatnonzero(block == high)
        i, j = np.nonzero(x[p] @ x[q].T >= threshold)
        i, j = p[i], q[j]
        if low == high:
            i, j = i[i < j], j[i < j]
        if len(i):
            new = ~_met_before(b["earlier"].tolist(), i, j)
            i, j = i[new], j[new]
        n = np.zeros(len(b), dtype=np.int64)
        np.add.at(n, i, copies[j])
        np.add.at(n, j, copies[i])
        root = gid[_smallest_reachable(len(b), i, j)]
        return pd.DataFrame({"gid": gid[n > 0], "n": n[n > 0], "root": root[n > 0]})

    found = dealt.groupBy("dim", "leaf", "low", "high").applyInPandas(compare, "gid long, n long, root long")
    return materialize(found, "links")


def near_duplicates(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD,
                    trees: int = TREES, leaf: int = LEAF, tile: int = TILE, sample_size: int = SAMPLE,
                    again: int = AGAIN, resample: int = RESAMPLE) -> DataFrame:
    """Per row ``vec_id, n_links, component_id, kept``.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest id reachable, ``kept`` says that it is the row's own. Vectors
    that are NULL, empty, zero or hold NULL or non-finite components link with
    nothing, nor do vectors of different lengths. Rows without an id link and
    count but never name a component. Repeated rows link with each other.
    Empty table: empty result; other columns are not read."""
    v = F.col(embedding).cast("array<double>")
    size = F.size(v)
    valid = F.coalesce((size > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                       & F.exists(v, lambda x: x != 0), F.lit(False))
    base = rows.select(F.col(vec_id).alias("vec_id"), F.when(valid, v).alias("v"))
    groups = (base.where("v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))
              .withColumn("gid", F.monotonically_increasing_id()).withColumn("dim", F.size("v")))
    groups = materialize(groups, "vectors")
    met = neighbours(groups.select("gid", "dim", "copies", "v"), threshold, trees, leaf, tile, sample_size, again, resample)
    linked = met.groupBy(F.col("gid").alias("u")).agg(F.sum("n").alias("others"))
    comp = components(met.select(F.col("gid").alias("u"), F.col("root").alias("v")))
    named = (groups.select("gid", "low", "copies", "v").join(comp, F.col("gid") == F.col("node"), "left")
             .join(linked, F.col("gid") == F.col("u"), "left")
             .select("v", "low", F.coalesce("root", "gid").alias("root"), (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    named = materialize(named, "named")
    least = materialize(named.groupBy("root").agg(F.min("low").alias("component_id")), "least")
    per = small_side(materialize(named.join(least, "root").select("v", "n_links", "component_id"), "per-vector"))
    got = base.where("v IS NOT NULL").join(per, "v").select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id")
    rest = base.where("v IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return got.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
