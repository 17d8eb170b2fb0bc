"""Each operator against a brute-force version, and on odd tables: NULLs, empty and long texts, ties, repeated rows, no rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rankforge.llm import components as C
from rankforge.llm import encode, forest, licenses, lines, mixing, packing, quality, simhash, suffixes, token_store, toxicity
from rankforge.llm.common import new_folder, number_rows
from rankforge.llm.queries import QUERIES, import_path, tokenizer_path

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, h string, tid string"


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    import_path(spark)


def frame(spark, texts, sources=None, ids=None):
    """Documents with columns whose names clash with the operators' own."""
    ids = ids if ids is not None else range(len(texts))
    sources = sources or ["a"] * len(texts)
    return spark.createDataFrame([(i, t, "en", s, 0, -1, "x", "y") for i, t, s in zip(ids, texts, sources)], DOCS)


def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


LONG = " ".join(f"w{i % 977}" for i in range(60_000)) + "."
ODD = [None, "", " \t\n", "one", "one two three", "a b c d e. f g h i j.", "a b c d e. f g h i j.", "ümlaut ÄÖ 日本 語。\nx", LONG, LONG + " end."]


# --- helpers

def test_number_rows_is_a_place_in_order(spark):
    rng = random.Random(1)
    vals = [rng.choice([None, 1, 2, 3]) for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v int").repartition(7)
    got = number_rows(df, [F.col("v").asc_nulls_last(), "i"], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(500))
    assert [r.i for r in got] == [i for i, _ in sorted(enumerate(vals), key=lambda x: (x[1] is None, x[1] or 0, x[0]))]


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(99, 98)],
    [(random.Random(i).randrange(60), random.Random(-i).randrange(60)) for i in range(45)]])
def test_components(spark, edges):
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in C.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


# --- 1 SimHash

def fingerprint_by_hand(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_by_hand(fps, ids):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[max(find(i), find(j))] = min(find(i), find(j))
    low = defaultdict(list)
    for i in range(len(fps)):
        if ids[i] is not None:
            low[find(i)].append(ids[i])
    return [min(low[find(i)], default=None) for i in range(len(fps))]


def test_golay_keys_meet_within_two_errors():
    of, patterns = simhash.golay_tables()
    assert sorted({int((p >= 0).sum()) for p in patterns}) == [1, 6]
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 23, 400)
    keys = defaultdict(set)
    for r, k in zip(*simhash.codeword_indices(words)):
        keys[r].add(int(k))
    for flips in ([], [0], [22], [3, 17], [11, 12]):
        other = words.copy()
        for f in flips:
            other ^= 1 << f
        row, key = simhash.codeword_indices(other)
        meet = {r for r, k in zip(row.tolist(), key.tolist()) if k in keys[r]}
        assert meet == set(range(400))


@pytest.mark.parametrize("z", [1, 2, 3])
def test_bucket_keys_lose_no_link(z):
    rng = np.random.default_rng(z)
    fp = rng.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 300, dtype=np.uint64)
    near = fp.copy()
    for i in range(len(fp)):
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            near[i] ^= np.uint64(1) << np.uint64(b)
    sets = []
    for x in (fp, near):
        s = defaultdict(set)
        for r, k in zip(*simhash.bucket_keys(x, z)):
            s[int(r)].add(int(k))
        sets.append(s)
    assert all(sets[0][i] & sets[1][i] for i in range(300))


@pytest.mark.parametrize("z", [None, 2])
def test_simhash_against_all_pairs(spark, z):
    rows = small_docs(spark).select("doc_id", "text").collect()
    fps = [fingerprint_by_hand(r.text) for r in rows]
    comp = groups_by_hand(fps, [r.doc_id for r in rows])
    got = {r.doc_id: (r.fp & (2 ** 64 - 1), r.component_id) for r in simhash.near_duplicates(small_docs(spark), z=z).collect()}
    assert got == {r.doc_id: (f, c) for r, f, c in zip(rows, fps, comp)}


def test_simhash_dense_group(spark):
    """Thousands of fingerprints within few bits of each other, chains too."""
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for _ in range(1500)} | {rng.getrandbits(64) for _ in range(200)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {r.node: r.root for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    want = groups_by_hand(fps, list(range(len(fps))))
    mine = defaultdict(set)
    for i, f in enumerate(signed):
        mine[got.get(f, f)].add(i)
    theirs = defaultdict(set)
    for i, c in enumerate(want):
        theirs[c].add(i)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_simhash_odd_rows(spark):
    ids = [5, 6, None, 8, 9, 10, 11, 12, 13, 13]
    df = frame(spark, ODD, ids=ids)
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(ODD)
    comp = groups_by_hand([fingerprint_by_hand(t) for t in ODD], ids)
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == sorted((str(i), str(c)) for i, c in zip(ids, comp))
    kept = simhash.first_of_each(df)
    assert kept.columns == df.columns
    # the id-less empty text goes with the others; of the rows that repeat 13 one stays
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c in comp if c is not None})
    assert simhash.near_duplicates(frame(spark, [])).count() == 0 == simhash.first_of_each(frame(spark, [])).count()


@pytest.mark.parametrize("rows, want", [
    ([(None, 0), (None, 1), (None, 2)], [(None, 0), (None, 1), (None, 2)]),  # unrelated texts without ids
    ([(None, 0), (None, 0), (None, 1), (None, 1)], [(None, 0), (None, 1)]),
    ([(None, 0), (7, 0), (None, 1), (None, 2)], [(7, 0), (None, 1), (None, 2)]),  # one of them is a copy of a row with an id
    ([(5, 0), (5, 1), (3, 1)], [(5, 0), (3, 1)]),  # an id that stands twice, one of its texts a copy
    ([(5, 0), (5, 1), (5, 1)], [(5, 0), (5, 1)]),
    ([(9, 0), (9, 1), (9, 2), (4, 2), (None, None), (None, 3), (2, None), (2, None)], [(9, 0), (9, 1), (4, 2), (None, 3), (2, None)]),
])
def test_simhash_keeps_rows_of_no_id_and_of_equal_ids(spark, rows, want):
    text = lambda k: None if k is None else " ".join(f"t{k}w{j}" for j in range(200))
    fps = [fingerprint_by_hand(text(k)) for k in (0, 1, 2, 3, None)]
    assert min(bin(a ^ b).count("1") for n, a in enumerate(fps) for b in fps[:n]) > 4
    df = frame(spark, [text(k) for _, k in rows], ids=[i for i, _ in rows])
    got = simhash.first_of_each(df)
    assert got.columns == df.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in got.collect()) == sorted((str(i), str(text(k))) for i, k in want)


def test_simhash_near_copies_of_one_id(spark):
    """Texts of one id that differ but link: one of them stays."""
    a, b = LONG, LONG + " end."
    got = simhash.first_of_each(frame(spark, [a, b, a, b], ids=[None, None, 8, 8])).collect()
    assert [r.doc_id for r in got] == [8] and got[0].text in (a, b)
    assert simhash.first_of_each(frame(spark, [a, b, a]).select("text", F.lit(None).cast("string").alias("doc_id"))).count() == 1


# --- 2 quality rules

def test_quality_odd_rows(spark):
    df = frame(spark, ODD)
    got = {r.doc_id: r for r in quality.quality_stats(df).collect()}
    assert [got[i].n_words for i in range(8)] == [0, 0, 0, 1, 3, 10, 10, 5]
    assert not any(got[i].kept for i in range(8)) and got[8].base_failed is True  # LONG repeats its windows
    assert got[0].size == -1 and "text" not in got[0].asDict()
    assert quality.quality_stats(frame(spark, [])).count() == 0


def test_quality_line_rules(spark):
    clean = "\n".join(" ".join(f"word{i}x{j}" for j in range(12)) + "." for i in range(6))
    texts = [clean, clean + "\nhome | about | news | shop | more.", clean + "\nAll Rights Reserved.\nhome login",
             clean + "\n" + "\n".join("###$$$ stuff%%% here&&&." for _ in range(30)), clean + "\n\n  \n"]
    got = [r.text for r in quality.clean_documents(frame(spark, texts)).orderBy("doc_id").collect()]
    assert got == [clean, clean, clean, clean + "\n\n  \n"]
    assert quality.line_fails("no sentence end here") == "punctuation"
    assert quality.line_fails("a | b | c | d and some more words to be here.") == "navigation"


def test_repeated_words_by_hand():
    rng = random.Random(2)
    for _ in range(200):
        w = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(14))]
        g = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        hit = {i + k for i in range(len(w) - 2) for k in range(3) if g[tuple(w[i:i + 3])] > 1}
        assert quality.repeated_words(w) == len(hit)


# --- 3 suffix order

def repeats_by_hand(texts, window):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[p:p + window] for d in data for p in range(len(d) - window + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - window + 1):
            if seen[d[p:p + window]] > 1:
                gone[p:p + window] = b"\1" * window
        left = bytes(x for x, g in zip(d, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("window,gram,rounds", [(200, 64, 3), (200, 64, 1), (40, 16, 2)])
def test_repeats_against_brute_force(spark, window, gram, rounds):
    rng = random.Random(window + rounds)
    word = lambda: "".join(rng.choice("abcdéf") for _ in range(rng.randrange(1, 9)))
    passage = [" ".join(word() for _ in range(n)) for n in (8, 30, 60, 200, 500)]
    texts = []
    for i in range(70):
        parts = [" ".join(word() for _ in range(rng.randrange(1, 60))) for _ in range(3)]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passage)
            a = rng.randrange(len(p))
            parts.insert(rng.randrange(len(parts)), rng.choice([p, p[a:], p[:a]]))
        texts.append(rng.choice(["", " "]).join(parts))
    texts += ["x" * 900, "x" * 199, "ab" * 400, "ab" * 100 + "c" + "ab" * 100, None, "", texts[3], texts[3], texts[9] + "tail", "é" * 300]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffixes.drop_repeats(frame(spark, texts), window=window, gram=gram, rounds=rounds).collect()}
    assert [got[i] for i in range(len(texts))] == repeats_by_hand(texts, window)


def test_repeats_on_documents_and_texts(spark):
    docs = small_docs(spark)
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in suffixes.drop_repeats(docs, with_text=True).collect()}
    for r, want in zip(rows, repeats_by_hand([r.text for r in rows], 200)):
        g = got[r.doc_id]
        assert (g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) == want
        assert hashlib.sha256(bytes(g.kept)).hexdigest() == g.kept_sha256
    assert suffixes.drop_repeats(frame(spark, [])).count() == 0


def test_parser_segments_agree(monkeypatch):
    rng = random.Random(8)
    data = "".join(rng.choice("ab c") for _ in range(5000)).encode() + b"z" * 700
    whole = suffixes.Parser().cells(data)
    monkeypatch.setattr(suffixes, "SEGMENT", 512)
    assert all((a == b).all() for a, b in zip(whole, suffixes.Parser().cells(data)))


# --- 4 embeddings

def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, gid string")


def links_by_hand(vecs):
    x = []
    for v in vecs:
        a = np.array([np.nan if c is None else c for c in (v if v is not None else [0.0])], dtype=np.float64)
        x.append(a / np.linalg.norm(a) if len(a) and np.isfinite(a).all() and a.any() else None)
    return [[j for j in range(len(x)) if j != i and x[i] is not None and x[j] is not None and len(x[i]) == len(x[j])
             and x[i] @ x[j] >= 0.95] for i in range(len(x))]


@pytest.mark.parametrize("tile,leaf", [(1024, 256), (16, 24)])
def test_embeddings_against_all_pairs(spark, tile, leaf):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    x = np.concatenate([centres[rng.integers(0, 40, 500)] + rng.normal(size=(500, 16)) * 0.18, rng.normal(size=(200, 16))]).astype(np.float32)
    vecs = [v.tolist() for v in x] + [x[0].tolist()] * 30
    df = vectors(spark, [(i, v, 0, "g") for i, v in enumerate(vecs)])
    got = {r.vec_id: r for r in forest.near_duplicates(df, tile=tile, leaf=leaf).collect()}
    want = links_by_hand(vecs)
    assert all(got[i].n_links <= len(want[i]) for i in range(len(vecs)))
    assert sum(got[i].n_links for i in range(len(vecs))) >= 0.9 * sum(map(len, want))


@pytest.mark.parametrize("tile", [1024, 32])
def test_dense_group_of_embeddings_leaves_no_pairs(spark, tile):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=12) * 3 + rng.normal(size=(400, 12)) * 0.05, rng.normal(size=(200, 12))])
    x = [*x.tolist(), x[3].tolist(), x[3].tolist()]
    rows = spark.createDataFrame([(i, 12, 1, v) for i, v in enumerate(x[:600])], "gid long, dim int, copies long, v array<double>")
    tiles = forest.neighbours(rows, tile=tile, leaf=64)
    assert tiles.count() < 600 * 400 / tile * 8 < 400 * 399 * 8 / 2
    want = links_by_hand(x)
    got = {r.vec_id: (r.n_links, r.component_id) for r in forest.near_duplicates(vectors(spark, [(i, v, 0, "g") for i, v in enumerate(x)]), tile=tile, leaf=64).collect()}
    assert [got[i] for i in range(400)] == [(len(want[i]), 0) for i in range(400)] and len(want[0]) == 401
    assert all(got[i][0] <= len(want[i]) for i in got)


@pytest.mark.parametrize("tile", [1024, 40])
def test_large_leaves_are_split_again_with_all_links(spark, tile):
    rng = np.random.default_rng(21)
    centres = rng.normal(size=(120, 16))
    x = np.concatenate([centres[rng.integers(0, 120, 900)] + rng.normal(size=(900, 16)) * 0.18, rng.normal(size=16) * 3 + rng.normal(size=(200, 16)) * 0.05])
    vecs = [v.tolist() for v in x.astype(np.float32)] + [x[0].astype(np.float32).tolist()] * 20
    df = vectors(spark, [(i, v, 0, "g") for i, v in enumerate(vecs)]).repartition(3)
    few = dict(tile=tile, leaf=32, sample_size=60, again=100, resample=80)  # first trees can't get below some 150 vectors a leaf
    got = {r.vec_id: r for r in forest.near_duplicates(df, **few).collect()}
    want = links_by_hand(vecs)
    assert sorted(got) == list(range(len(vecs)))
    assert all(got[i].n_links <= len(want[i]) for i in got)
    assert sum(g.n_links for g in got.values()) >= 0.9 * sum(map(len, want))
    assert [(got[i].n_links, got[i].component_id) for i in range(900, 1100)] == [(len(want[i]), 900) for i in range(900, 1100)]  # no cut fits: whole leaf


def test_split_again_keeps_every_vector_and_ends(spark):
    rng = np.random.default_rng(22)
    x = np.concatenate([rng.normal(size=(700, 8)), 5 + rng.normal(size=(300, 8)) * 0.001])
    df = spark.createDataFrame([(i, 8, v.tolist()) for i, v in enumerate(x)], "gid long, dim int, v array<double>")
    routed = spark.createDataFrame([(i, 8, t) for i in range(1000) for t in (0, 1)] + [(i, 8, 2) for i in range(50)], "gid long, dim int, leaf long")
    out = forest.split_again(df, routed, 32, 100, 90, lambda dim: 0.01).collect()
    leaves = {}
    for r in out:
        leaves.setdefault(r.leaf, set()).add(r.gid)
    assert leaves[2] == set(range(50))  # a small leaf is as it was
    sizes = {n: len(g) for n, g in leaves.items()}
    close = set(range(700, 1000))
    assert all(n <= 100 or len(close & leaves[k]) > 0.25 * n for k, n in sizes.items())  # only what no cut divides stays large
    for gid in range(1000):
        assert sum(gid in g for g in leaves.values()) >= 2 + (gid < 50)
    assert max(sizes.values()) >= 300


def test_met_before_and_reach_by_hand():
    earlier = [np.array(a, dtype=np.int32) for a in ([1, 4], [4], [], [7], [1, 7])]
    i, j = np.array([0, 0, 0, 1, 3]), np.array([1, 2, 4, 3, 4])
    assert forest._met_before(earlier, i, j).tolist() == [True, False, True, False, True]
    assert forest._smallest_reachable(6, np.array([4, 3, 1]), np.array([5, 4, 2])).tolist() == [0, 1, 1, 3, 3, 3]


def test_embeddings_odd_rows(spark):
    vecs = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, 2.0], [1.0, 2.0], [2.0, 4.0], [1.0], [1.0, 2.0, 0.0], [-1.0, -2.0]]
    ids = [*range(11), None]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in forest.near_duplicates(vectors(spark, [(i, v, 0, "g") for i, v in zip(ids, vecs)])).collect()}
    for i in (0, 1, 2, 3, 4, 5, 9, 10):
        assert got[i] == (0, i, True)
    assert [got[i] for i in (6, 7, 8)] == [(2, 6, True), (2, 6, False), (2, 6, False)]
    assert got[None][:2] == (0, None)
    assert forest.near_duplicates(vectors(spark, [])).count() == 0


# --- 5 line dedup

def test_lines_by_hand(spark):
    rng = random.Random(6)
    texts, hosts = [], []
    for i in range(90):
        hosts.append(rng.choice(["a", "b", None, "c"]))
        ls = [f"line {rng.randrange(400)}" for _ in range(rng.randrange(6))] + ["menu"] * (rng.random() < 0.6) + ["foot", "foot"] * (rng.random() < 0.1) + ["", " "]
        rng.shuffle(ls)
        texts.append(rng.choice(["\n".join(ls), "\n".join(ls), None, ""]) if i % 9 == 0 else "\n".join(ls))
    df = frame(spark, texts, hosts)
    pages = Counter(hosts)
    held = Counter((h, x) for t, h in zip(texts, hosts) for x in set((t or "").split("\n")) if x.strip())
    bad = {k for k, n in held.items() if n >= 5 and n > 0.08 * pages[k[0]]}
    got = {r.doc_id: r for r in lines.drop_boilerplate(df).collect()}
    for i, (t, h) in enumerate(zip(texts, hosts)):
        ls = t.split("\n") if t is not None else []
        keep = [x for x in ls if (h, x) not in bad]
        assert (got[i].text, got[i].n_lines, got[i].n_dropped) == (None if t is None else "\n".join(keep), len(ls), len(ls) - len(keep))
    assert any(b for b in bad) and got[0].size == -1
    assert lines.drop_boilerplate(frame(spark, [])).count() == 0


# --- 6 toxicity

def test_toxicity_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    found = toxicity.toxicity_scores(docs, labels)
    rows = found.join(labels, "doc_id").where("held_out").collect()
    hit = sum(r.predicted and r.toxic for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert hit >= 0.9 * sum(r.toxic for r in rows) and hit >= 0.95 * sum(r.predicted for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_toxicity_reads_no_held_out_label(spark):
    docs, labels = small_docs(spark), spark.read.parquet(f"{SMALL}/labels.parquet")
    other = labels.withColumn("toxic", F.when(toxicity.is_training(F.col("doc_id")), F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in toxicity.toxicity_scores(docs, x).collect()} for x in (labels, other))
    assert a == b


def test_toxicity_odd_rows(spark):
    texts = ODD + ["you idiot", "you moron, idiot"] * 30 + ["a fine day"] * 60
    df = frame(spark, texts)
    known = [(i, 1, int("idiot" in (t or ""))) for i, t in enumerate(texts)] + [(None, 1, 1), (3, None, None), (4, 1, 7)]
    labels = spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity_scores(df, labels).collect()}
    assert len(got) == len(texts) and all(got[i].predicted == int("idiot" in (t or "")) for i, t in enumerate(texts))
    assert {r.score for r in toxicity.toxicity_scores(df, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity_scores(frame(spark, []), labels).count() == 0


# --- 7 packing, 8 token files

@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_tokenizer(spark, name):
    enc = encode.Encoder(tokenizer_path(name))
    odd = ["", "  a  b", "a   b ", "x\n\ny", " lead", "trail ", "tab\tx y", "<|endoftext|> foo <|endoftext|>", "é ́x", "don't  I'll x's.\nY", "ÀÉ ﬁ Σας. İstanbul, ŉ. ab",
           "\0 a", "日本 語 12 3,4", "a \x1c b", "\n", " ", "A.b. C, d.\n\ne.\nF. g,", "a  b", "q. \nr", "<|startoftext|>", "１２. ３"]
    texts = odd + [r.text for r in small_docs(spark).select("text").collect()]
    ids, n = enc.encode(texts)
    want = [enc.tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert n.tolist() == list(map(len, want))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want
    encode.MEMORY, old = 300, encode.MEMORY  # forgets all the time
    try:
        again = encode.Encoder(tokenizer_path(name))
        assert (np.concatenate([again.encode([t])[0] for t in texts]) == ids).all()
    finally:
        encode.MEMORY = old


def check_packs(rows, texts, name, sequence):
    enc = encode.Encoder(tokenizer_path(name))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for i, t in texts.items():
        ids = np.append(enc.tok.encode(t or "", add_special_tokens=False).ids, 2).astype("<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert sorted(by_seq) == list(range(len(by_seq)))
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= sequence
    return sum(r.length for r in rows) / (sequence * len(by_seq))


def test_packing_round_trip(spark):
    docs = small_docs(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    path = tokenizer_path("word_bpe_49k.json")
    assert check_packs(packing.pack_documents(docs, path).collect(), texts, "word_bpe_49k.json", 4096) > 0.97
    check_packs(packing.pack_documents(docs, path, sequence=100).collect(), texts, "word_bpe_49k.json", 100)
    df = frame(spark, ODD, ids=[None, *range(1, len(ODD))])
    check_packs(packing.pack_documents(df, path).collect(), {(i or None): t for i, t in enumerate(ODD)}, "word_bpe_49k.json", 4096)
    twice = packing.pack_documents(df.unionByName(df), path, with_ids=True).collect()
    assert len(twice) == 2 * packing.pack_documents(df, path).count() and all(len(r.ids) == r.length for r in twice)
    assert packing.pack_documents(frame(spark, []), path).count() == 0


def test_plan_places_every_length_once():
    rng = random.Random(9)
    for _ in range(30):
        hist = {rng.randrange(1, 65): rng.randrange(1, 50) for _ in range(rng.randrange(1, 20))}
        packs = packing.plan_packs(hist, 64)
        placed = Counter()
        for n, p in packs:
            assert sum(p) <= 64 and n > 0
            for length in p:
                placed[length] += n
        assert placed == hist


def test_plan_fills_packs_of_a_frequent_length():
    def packs_of(hist):
        packs = packing.plan_packs(hist)
        placed = Counter()
        for n, p in packs:
            assert sum(p) <= 4096 and n > 0
            for length in p:
                placed[length] += n
        assert placed == hist
        return sum(n for n, _ in packs)

    assert packs_of({100: 1000}) == 25
    for length in (1, 30, 100, 1200, 1366, 2049, 4096):
        assert packs_of({length: 1001}) == -(-1001 // (4096 // length))
    rng = random.Random(12)
    for length in (100, 300, 600, 1200):  # a third of all pieces
        hist = Counter(min(4096, int(rng.lognormvariate(5.5, 1.3)) + 1) for _ in range(4000)) + Counter({length: 2000})
        assert sum(k * n for k, n in hist.items()) > 0.97 * 4096 * packs_of(hist)


def test_packing_a_frequent_length(spark):
    texts = {i: "one two three" if i % 3 else " ".join(["one two"] * (i % 40)) for i in range(300)}
    df = frame(spark, list(texts.values()))
    path = tokenizer_path("word_bpe_49k.json")
    assert check_packs(packing.pack_documents(df, path, sequence=100).collect(), texts, "word_bpe_49k.json", 100) > 0.9


def test_elias_fano():
    rng = random.Random(10)
    for n in (1, 2, 700, 1500):
        vals = np.cumsum([rng.choice([1, 1, 5, 300]) for _ in range(n)])
        ef = token_store.EliasFano.of(vals, int(vals[-1]))
        assert ef.all().tolist() == vals.tolist()
        assert all(ef[i] == vals[i] for i in range(0, n, 7))
        assert (ef.lower.nbytes + ef.upper.nbytes) * 8 <= n * (3 + np.log2(vals[-1] / n)) + 16


@pytest.mark.parametrize("shard_ids", [1 << 22, 500])
def test_token_files_round_trip(spark, shard_ids):
    texts = [*ODD, "<|endoftext|>", *[r.text for r in small_docs(spark).limit(40).collect()]]
    ids = [None, *range(-3, len(texts) - 4)]
    path = tokenizer_path("byte_bpe_50k.json")
    folder = new_folder(spark, "tokens")
    shards = token_store.write_store(frame(spark, texts, ids=ids), folder, path, shard_ids=shard_ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_store.read_store(spark, folder, shards).collect()}
    tok, at, want, arrays = encode.Encoder(path).tok, 0, {}, []
    for i, t in sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0])):
        a = np.append(tok.encode(t or "", add_special_tokens=False).ids, 0).astype("<u4")
        want[i] = (at, len(a), zlib.crc32(a.tobytes()))
        arrays.append(a)
        at += len(a)
    assert got == want
    seen = []
    for r in shards.orderBy("part", "shard").collect():
        s = token_store.Shard(open(folder.removeprefix("file:") + "/" + r.file, "rb").read())
        seen += [s.document(i).astype("<u4").tolist() for i in range(r.n_docs)]
    assert seen == [a.tolist() for a in arrays]
    empty = new_folder(spark, "tokens")
    none = token_store.write_store(frame(spark, []), empty, path)
    assert none.count() == 0 == token_store.read_store(spark, empty, none).count()


# --- 9 licenses

def test_base_phrases_by_hand(spark):
    texts = [*ODD, "MIT License; the mit, LICENSE. CC BY-NC 4.0", "gnu general public\nlicense version 3 mit license", "ccby cc  by", "Apache License, Version 2.0 apache-license"]
    got = {r.doc_id: r for r in licenses.scan_licenses(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = [(k, label) for p, label in licenses.PHRASES.items() for k in range(len(words)) if words[k:k + len(p.split())] == p.split()]
        r = got[i]
        assert (r.n_words, r.n_base) == (len(words), len(at))
        assert (r.first_word, r.last_word) == (min((k for k, _ in at), default=None), max((k for k, _ in at), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in at})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    assert licenses.scan_licenses(frame(spark, [])).count() == 0


def test_template_regions():
    a = licenses.Automaton("granted <<beginOptional>>free <<beginOptional>>of <<endOptional>>charge <<endOptional>>to <<var;words=1-3>> by us")
    for text, end in (("granted to you by us", 5), ("granted free charge to you by us", 7), ("granted free of charge to a b c by us", 10),
                      ("granted to by us", None), ("granted to a b c d by us", None), ("granted of charge to you by us", None), ("granted to you by", None)):
        assert a.match(text.split(), 0) == end
    with pytest.raises(ValueError):
        licenses.Automaton("<<beginOptional>>all<<endOptional>>")
    s = licenses.Scanner(licenses.TEMPLATES, licenses.PHRASES)
    labels = lambda t: {x[0] for x in s.scan(t)[1]}
    assert labels("This work is licensed under the GNU General Public License, version 3.") == {"gpl", "gpl-3.0", "gpl-notice"}
    assert labels("Licensed under the Apache License, Version 2.0.") == {"apache", "apache-2.0"}
    assert labels("Licensed under CC BY-NC 4.0.") == {"cc-by", "cc-by-nc-4.0"}
    assert labels("Released under the MIT License.") == {"mit", "mit-notice"}
    assert labels("Released under the permit License.") == set()


MIT = """Copyright (c) 2020, 2021 Ann Example and contributors

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
BSD_2 = """Copyright (c) 2020, Ann Example
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_3 = BSD_2.replace("distribution.\n", """distribution.
3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
""").replace("1. ", "* ").replace("2. R", "* R")
ISC = """Copyright 2020 Ann Example

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""


@pytest.mark.parametrize("label, text, notice", [
    ("mit-text", MIT, "mit-notice"), ("bsd-2-clause-text", BSD_2, "bsd-notice"), ("bsd-3-clause-text", BSD_3, "bsd-notice"), ("isc-text", ISC, None)])
def test_license_texts_by_hand(label, text, notice):
    s = licenses.Scanner(licenses.TEMPLATES, licenses.PHRASES)
    n = len(licenses.WORDS.findall(text.lower()))
    for t, lead in ((text, 0), ("def f(): pass\n" + text.upper().replace("\n", "\n# ") + "\nend", 3), (text.partition("\n\n")[2], 0)):
        found = s.scan(t)[1]
        whole = [x for x in found if x[0].endswith("-text")]
        assert {x[0] for x in whole} == {label} and notice in {None, *(x[0] for x in found)}
        assert min(x[1] for x in whole) == lead and (t != text or max(x[2] for x in whole) == n)
    assert not any(x[0].endswith("-text") for x in s.scan(text.replace("IS PROVIDED", "IS NOT PROVIDED"))[1])


@pytest.mark.parametrize("label, name", [
    ("apache-2.0", "Apache-2.0"), ("gpl-2.0", "GPL-2"), ("gpl-3.0", "GPL-3"), ("lgpl-2.1", "LGPL-2.1"), ("lgpl-3.0", "LGPL-3"), ("mpl-2.0", "MPL-2.0"), ("cc0-1.0", "CC0-1.0")])
def test_license_texts_of_the_system(label, name):
    try:
        text = open(f"/usr/share/common-licenses/{name}").read()
    except FileNotFoundError:
        pytest.skip("no license texts on this machine")
    n, found = licenses.Scanner(licenses.TEMPLATES, licenses.PHRASES).scan(text)
    assert {(x[0], x[1], x[2]) for x in found if x[0].endswith("-text") and x[1] == 0} == {(label + "-text", 0, n)}
    assert {x[0] for x in found if x[0].endswith("-text")} == {label + "-text"}


@pytest.mark.parametrize("label", sorted(licenses.TEXTS))
def test_license_texts_with_and_without_their_regions(label):
    template, a = licenses.TEXTS[label], licenses.Automaton(licenses.TEXTS[label])
    fill = lambda t: re.sub(r"<<var;words=(\d+)-(\d+)>>", lambda m: " x" * int(m[2]) + " ", t)
    for t in (fill(template), fill(licenses.Scanner._mandatory(template.replace("var;", "VAR;")).replace("VAR;", "var;"))):
        words = re.sub("<<[a-zA-Z]*>>", " ", t).split()
        assert a.match(words, 0) == len(words)
        assert a.match([*words[:30], *words[31:]], 0) != len(words) - 1 or words[30] == "x"


# --- 10 mixing

def test_mix_by_hand(spark):
    rng = random.Random(12)
    sources = [rng.choice(["b", "a", "é", None, "c", "tiny"]) for _ in range(400)]
    sources = ["tiny" if i in (3, 4) else ("a" if s == "tiny" else s) for i, s in enumerate(sources)]
    texts = [rng.choice([None, "", "x " * rng.randrange(1, 300)]) for _ in sources]
    got = {r.doc_id: r for r in mixing.mix_sources(frame(spark, texts, sources)).collect()}
    size = [len((t or "").split()) for t in texts]
    total = defaultdict(int)
    for s, n in zip(sources, size):
        total[s] += n
    names = sorted((s for s in total if s is not None), key=lambda s: s.encode()) + [None] * (None in total)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, clamped = {}, 1.5 * sum(size), set()
    while True:
        free = [s for s in names if s not in clamped]
        level = (left - sum(2 * total[s] for s in clamped)) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * total[s]}
        if not over:
            break
        clamped |= over
    target = {s: 2 * total[s] if s in clamped else weight[s] * level for s in names}
    taken = defaultdict(int)
    for i, s in enumerate(sources):
        r = got[i]
        assert (r.size, r.source_size) == (size[i], total[s]) and r.target == pytest.approx(target[s])
        assert r.taken == r.size * r.repeats <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 300 for s in names)
    again = {r.doc_id: r.taken for r in mixing.mix_sources(frame(spark, texts, sources).repartition(5)).collect()}
    assert again == {i: r.taken for i, r in got.items()}
    copies = Counter(r.doc_id for r in mixing.mixed_documents(frame(spark, texts, sources)).collect())
    assert {i: copies[i] for i in got} == {i: r.repeats for i, r in got.items()}
    assert mixing.mixed_documents(frame(spark, texts, sources)).columns == frame(spark, []).columns


def test_mix_odd_rows(spark):
    assert mixing.mix_sources(frame(spark, [])).count() == 0 == mixing.mixed_documents(frame(spark, [])).count()
    got = mixing.mix_sources(frame(spark, ODD, [None] * len(ODD), [None, 1, 1, *range(3, len(ODD))])).collect()
    assert len(got) == len(ODD) and all(r.taken <= 2 * r.size for r in got)
    assert {r.taken for r in mixing.mix_sources(frame(spark, [None, ""], ["a", "b"])).collect()} == {0}


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


# --- ids that doubles can't hold, files read by select, classifiers without a lexicon

BIG = [(1 << 60) + 1, None, (1 << 53) + 1, -(1 << 62) - 1]


def test_large_ids_stay_as_they_are(spark):
    texts = ["the mit license", None, "you are an idiot!! kill", "x y"]
    docs = frame(spark, texts, ids=BIG)
    assert {r.doc_id: r.n_base for r in licenses.scan_licenses(docs).collect()} == {BIG[0]: 1, None: 0, BIG[2]: 0, BIG[3]: 0}
    labels = spark.createDataFrame([(BIG[0], 0), (BIG[2], 1), (BIG[3], 1)], "doc_id long, toxic int")
    assert {r.doc_id for r in toxicity.toxicity_scores(docs, labels).collect()} == set(BIG)


def test_patterns_are_scored_without_a_lexicon(spark):
    texts = ["you are going to die!! kill", "a quiet text about gardens", "another calm page"] * 4
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(12)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels).collect()}
    assert min(got[i] for i in range(0, 12, 3)) > max(got[i] for i in range(12) if i % 3) + 0.2


def test_shards_keep_ascending_ids_in_little_room():
    rng = random.Random(5)
    for ids in ([], [None, None], [None, -(1 << 63), 0, 5, 5, (1 << 63) - 1], sorted(rng.randrange(1 << 40) for _ in range(20_000))):
        counts = np.array([1 + rng.randrange(3) for _ in ids], dtype=np.int64)
        tokens = np.arange(int(counts.sum())) % 999
        data = token_store.shard_bytes(ids, counts, tokens, 2)
        s = token_store.Shard(data)
        ends = np.cumsum(counts).tolist()
        some = range(s.n) if s.n < 100 else rng.sample(range(s.n), 300)
        assert list(s.ends.blocks()) == ends and [s.base + k for k in s.keys.blocks()] == [i for i in ids if i is not None]
        assert s.n == len(ids) and [s.doc_id(i) for i in some] == [ids[i] for i in some]
        assert [s.bounds(i) for i in some] == [(ends[i - 1] if i else 0, ends[i]) for i in some]
        if len(ids) > 1000:
            assert len(data) - 2 * len(tokens) < len(ids) * 8 / 1.5  # below a table of ids, let alone of offsets


def test_texts_that_share_a_hash_are_told_apart(spark, monkeypatch):
    a, b = "a" * 300 + "left" * 80, "b" * 300 + "right" * 80
    docs = frame(spark, [a, b, "short", a[:250] + "!"])
    want = sorted(map(tuple, suffixes.drop_repeats(docs).collect()))
    real = F.xxhash64

    def clash(*cols):  # all whole texts share one name at first
        return F.lit(7).cast("long") if isinstance(cols[0], str) and cols[0] == "data" else real(*cols)

    monkeypatch.setattr(suffixes.F, "xxhash64", clash)
    assert sorted(map(tuple, suffixes.drop_repeats(docs).collect())) == want


def test_suffix_classes_are_hashed_once(spark, monkeypatch):
    plans, step = {}, suffixes._step

    def record(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return step(df, name)

    monkeypatch.setattr(suffixes, "_step", record)
    text = "".join(chr(97 + i * i % 23) for i in range(700)) * 2
    assert suffixes.drop_repeats(frame(spark, [text, "x" + text[50:600], text[5:300] + "y" * 90])).count() == 3
    assert {"classes", "band-classes"} <= set(plans)  # bands were grouped three times
    assert not any("SortAggregate" in plans[name] for name in ("classes", "band-classes", "windows", "merged"))


def test_suffix_steps_in_small_frames(spark, monkeypatch):
    rng = random.Random(8)
    part = "".join(rng.choice("abcdef ") for _ in range(900))
    texts = [part[i * 37 % 200:] + f" tail {i} " + part[: 300 + i] for i in range(12)] + [part, part]
    want = sorted(map(tuple, suffixes.drop_repeats(frame(spark, texts)).collect()))
    monkeypatch.setattr(suffixes, "ENTRIES", 3)
    monkeypatch.setattr(suffixes, "TEXT_BYTES", 1000)
    assert sorted(map(tuple, suffixes.drop_repeats(frame(spark, texts)).collect())) == want


# --- packs filled by cutting pieces

@pytest.mark.parametrize("hist", [{2049: 1000}, {1366: 999}, {2100: 700, 900: 1}, {2100: 300, 900: 300}, {3000: 1}, {600: 5000, 4096: 10}, {4096: 7}])
def test_cut_pieces_fill_packs(hist):
    rows = packing.cut_to_fill(packing.plan_packs(hist))
    used, ids = Counter(), {(length, r): [] for length, n in hist.items() for r in range(n)}
    spans = defaultdict(list)
    for length, lo, hi, first, at, packs, delta, part in rows:
        for r in range(lo, hi):
            nth = r - lo
            seq, start = first + nth % packs, at + nth // packs * length
            spans[seq].append((start, start + part))
            ids[length, r].append((delta, delta + part))
            used[seq] += part
    assert set(used) == set(range(len(used)))
    for s in spans.values():  # gapless from 0
        s.sort()
        assert s[0][0] == 0 and all(a[1] == b[0] for a, b in zip(s, s[1:])) and s[-1][1] <= 4096
    for (length, _), parts in ids.items():
        parts.sort()
        assert parts[0][0] == 0 and parts[-1][1] == length and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    total = sum(length * n for length, n in hist.items())
    assert len(used) <= total / 4096 / 0.95 + 1


def test_checksums_join():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 50_000, 1000).astype("<u4")
    grains = np.array([zlib.crc32(ids[g: g + 64].tobytes()) for g in range(0, 1000, 64)], dtype="<u4").tobytes()
    cases = [(0, 64), (0, 1000), (64, 128), (128, 872), (960, 40), (0, 640)]
    got = packing.join_checksums([grains] * len(cases), np.array([a // 64 for a, _ in cases]), np.array([n for _, n in cases]))
    assert got.tolist() == [zlib.crc32(ids[a: a + n].tobytes()) for a, n in cases]


def test_packing_one_length_by_cuts(spark):
    texts = {i: " ".join(f"w{(i * 7 + k) % 50}" for k in range(400)) for i in range(60)}
    n = len(encode.Encoder(tokenizer_path("word_bpe_49k.json")).tok.encode(texts[0], add_special_tokens=False).ids) + 1
    df, path = frame(spark, list(texts.values())), tokenizer_path("word_bpe_49k.json")
    sequence = n * 2 - 5
    got = packing.pack_documents(df, path, sequence=sequence, with_ids=True).collect()
    assert check_packs(got, texts, "word_bpe_49k.json", sequence) > 0.75 and len(got) > len(texts)
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in got)


@pytest.mark.parametrize("line,rule", [
    ("Home. About. Contact", "punctuation"), ("www.site.com login register", "punctuation"), ("Home > Products > Shoes. Sale", "punctuation"),
    ("Home > Products > Shoes.", "navigation"), ("News · Sport · Weather!", "navigation"), ("«Она пришла домой и легла спать»", None), ('He said "no"', None),
    ("a line of wrapped prose, which goes on and on until the margin", None), ("a line of wrapped prose which goes on and on until the margin", "punctuation"),
    ("If a > b and b > c then, as everybody in this room already knows, a > c.", None), ("Todos los derechos reservados.", "boilerplate"), ("A sentence (in brackets.)", None)])
def test_line_rules(line, rule):
    assert quality.line_fails(line) == rule


def test_embedding_components_equal_brute_force_at_full_width(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(300, 64))
    near = [base[rng.integers(0, 40, 260)] + rng.normal(size=(260, 64)) * w for w in (0.1, 0.3)]
    x = np.concatenate([base, *near])[rng.permutation(820)]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int").repartition(5)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    root = list(range(len(x)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    close = x @ x.T >= 0.95
    for a, b in zip(*np.nonzero(close)):
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    got = {r.vec_id: (r.n_links, r.component_id) for r in forest.near_duplicates(df).collect()}
    assert sorted(got) == list(range(len(x)))
    assert all(got[i][0] <= close[i].sum() - 1 for i in got)
    assert sum(g[0] for g in got.values()) >= 0.9 * (close.sum() - len(x)) > 1000
    assert sum(got[i][1] == find(i) for i in got) >= 0.97 * len(x)
