"""Whitening against numpy, and on odd tables."""

import math

import numpy as np
import pytest

from rankforge.llm import whitening
from rankforge.llm.queries import QUERIES, import_path

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    import_path(spark)


def brute(vectors, k=16, count=False):
    """{x: (deviation, whitened up to sign)}, n, explained."""
    xs = [tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(xs))
    w = [xs.count(x) if count else 1 for x in fit]
    n, a = sum(w), np.array(fit, dtype=object)
    s = [sum(int(m) * int(x) for m, x in zip(w, col)) for col in a.T]
    z = np.array([[float(x - si // n) - si % n / n for x, si in zip(row, s)] for row in a])
    cov = (z * np.array(w)[:, None]).T @ z / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    white = z @ v / np.sqrt(np.where(e > 1e-9, e, np.nan))
    dev = [sum((n * x - si) ** 2 for x, si in zip(row, s)) for row in a.tolist()]
    return xs, {x: (d, y) for x, d, y in zip(fit, dev, white)}, n, e / np.trace(cov)


@pytest.mark.parametrize("weights", ["one", "count"])
def test_equals_numpy(spark, weights):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(120, 6)) * [3, 2, 1, .7, .4, .2]
    vectors = [base[i].tolist() for i in [0] * 60 + list(range(120)) + [5, 5, 6]]
    odd = [None, [], [1.0] * 5, [float("nan")] * 6, [float("inf")] + [0.0] * 5, [None] + [0.0] * 5, [1e300] + [0.0] * 5]
    rows = [(i if i != 2 else None, v, "x", 1) for i, v in enumerate(vectors)] + [(1000 + i, v, "y", 2) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, m int").repartition(5)
    got = whitening.whiten(df, components=4, weights=weights).collect()
    xs, want, n, explained = brute(vectors, 4, weights == "count")
    assert sorted((r.vec_id is not None, r.vec_id or 0) for r in got) == sorted((i != 2, i if i != 2 else 0) for i in range(len(vectors)))
    signs = None
    for r in got:
        if r.vec_id is None:
            continue
        dev, y = want[xs[r.vec_id]]
        assert (r.n, r.deviation) == (n, dev) and r.identity_error < 1e-9
        assert np.allclose(r.explained, explained, rtol=1e-9)
        s = np.sign(np.array(r.whitened) * y)
        signs = s if signs is None else signs
        assert np.allclose(np.array(r.whitened), signs * y, atol=1e-8)


def test_degenerate_and_large(spark):
    def run(vectors, **kw):
        return whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id int, embedding array<double>"), **kw).orderBy("vec_id").collect()
    assert run([]) == []
    one = run([[1.0, 2.0]] * 3)
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, [None, None], [0.0, 0.0], 0.0)] * 3
    line = run([[float(i), 2.0 * i] for i in range(5)])  # one direction only
    assert all(r.whitened[1] is None and r.whitened[0] is not None and r.explained[1] == 0 for r in line)
    assert abs(np.var([r.whitened[0] for r in line]) - 1) < 1e-9
    far = run([[1e15, 0.0], [-1e15, 1.0], [0.0, 5.0]])
    assert [r.deviation for r in far] == [None, None, 331776]  # beyond 64 bits
    mid = run([[1e7, 0.0], [-1e7, 1.0], [0.0, 5.0]])
    assert [r.deviation for r in mid] == [brute([[1e7, 0.0], [-1e7, 1.0], [0.0, 5.0]])[1][x][0] for x in brute([[1e7, 0.0], [-1e7, 1.0], [0.0, 5.0]])[0]]
    with pytest.raises(ValueError):
        run([[1.0]], weights="x")


def test_query_equals_numpy(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    xs, want, n, explained = brute([r.embedding for r in rows])
    at = {r.vec_id: x for r, x in zip(rows, xs)}
    got = QUERIES["op12_whitening"](spark, SMALL).collect()
    assert len(got) == 16 * len(rows)
    signs = {}
    for r in got:
        dev, y = want[at[r.vec_id]]
        y = y[r.component - 1]
        assert (r.n, r.deviation) == (n, dev) and r.identity_error <= 1e-4
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-6
        s = signs.setdefault(r.component, 1 if abs(r.whitened - y) < abs(r.whitened + y) else -1)
        assert abs(r.whitened - s * y) < 1e-6
