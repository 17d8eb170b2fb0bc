"""The prefix trie against brute force, and on odd tables."""

import hashlib
import random
import zlib

import pytest

from rankforge.llm import prefix_trie as P
from rankforge.llm.queries import QUERIES, import_path

SMALL = "/root/testdata/sf0.001"
TABLE = "conv_id long, turn long, role string, text string, size string, last int"


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    import_path(spark)


def brute(rows, rebuild=True):
    turns = {}
    for c, t, r, x, *_ in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t, r or "", x or ""))
    turns = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in turns.items()}
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        paths[c] = tuple(turns.get(c - int(c % 100), [])[:h] + own[h:]) if rebuild else tuple(own)
    nodes = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            nodes.setdefault(p[:d], []).append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    stats = {}
    for p in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[p]) - 1) * len(p[-1][1]) if p else 0
        below = [stats[k] for k in kids.get(p, [])]
        stats[p] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else -1, len(m), len(kids.get(p, [])), *stats[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(paths[c]) == len(p)))).encode()).hexdigest()) for p, m in nodes.items())


def run(turns, **kw):
    nodes, ends = P.prefix_trie(turns, **kw)
    found = nodes.join(P.ends_digest(ends), "key", "left").collect()
    none = hashlib.sha256(b"").hexdigest()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256 or none) for r in found)


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 60), 100, 105, 199, 777, 1 << 55]:
        n = rng.choice([1, 2, 3, 4, 7, 12, 9 if c % 20 == 3 else 5])
        same = c % 3 == 0  # a third of the conversations share their turns
        for t in range(n):
            text = f"turn {t}" if same or rng.random() < .7 else rng.choice([None, "", "ñ日x", f"{c}"])
            rows.append((c, None if t == 0 and c % 2 else t, rng.choice(["user", None, ""]) if not same else "user", text, "s", 1))
    return rows + [(None, 1, "user", "lost", "s", 1)]


@pytest.mark.parametrize("steps,block", [(500_000, 256), (60, 4)])
def test_equals_brute_force(spark, steps, block):
    rows = conversations(steps)
    turns = P.turn_rows(spark.createDataFrame(rows, TABLE).repartition(4))
    assert run(P.rebuilt(turns), group_steps=steps, block=block) == brute(rows)
    assert run(P.as_recorded(turns), group_steps=steps, block=block) == brute(rows, rebuild=False)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], TABLE)
    nodes, ends = P.prefix_trie(P.rebuilt(P.turn_rows(empty)))
    assert nodes.count() == 0 == ends.count()
    # conversations of which nothing is left: their own turns are skipped and there is no base
    lone = [(c, 0, "user", "a", "s", 1) for c in range(101, 130)]
    got = run(P.rebuilt(P.turn_rows(spark.createDataFrame(lone, TABLE))))
    assert got == brute(lone) and any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in got)
    twice = [(5, 0, "user", "a", "s", 1)] * 2 + [(6, 0, "user", "a" * 100_000, "s", 1)]  # repeated rows count twice
    assert run(P.as_recorded(P.turn_rows(spark.createDataFrame(twice, TABLE)))) == brute(twice, rebuild=False)


def test_long_lists_of_ends(spark, monkeypatch):
    monkeypatch.setattr(P, "PIECE", 7)
    rows = [(c, 0, "user", "same", "s", 1) for c in range(2, 100)]
    got = run(P.as_recorded(P.turn_rows(spark.createDataFrame(rows, TABLE).repartition(6))))
    assert got == brute(rows, rebuild=False)


def test_block_bounds():
    edges = [P.block_bounds(b, 8) for b in range(1, 8)]
    assert edges == [(0, 1), (1, 2), (2, 4), (4, 8), (8, 16), (16, 24), (24, 32)]


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    df = QUERIES["op13_prefix_trie"](spark, SMALL)
    got = sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())
    assert got == brute(rows)
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"bigint", "string"}
