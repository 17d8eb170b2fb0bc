"""Decontamination against brute force, and on odd tables."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from rankforge.llm import contamination
from rankforge.llm.queries import QUERIES, import_path

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    import_path(spark)


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(texts, items, window=10):
    wins = {}
    for item, t in items:
        w = words(t)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[i: i + window]), set()).add("" if item is None else str(item))
    out = []
    for t in texts:
        w, hit, own = words(t), set(), set()
        for size in {len(x) for x in wins}:
            for i in range(len(w) - size + 1):
                who = wins.get(tuple(w[i: i + size]))
                if who:
                    own |= who
                    hit |= set(range(i, i + size))
        out.append((len(w), len(hit), sorted(own)))
    return out


def random_tables(seed):
    rng = random.Random(seed)
    vocab = ["the", "The", "a1", "ñandú", "ÑANDÚ", "日本", "x", "don", "re"] + [f"w{i}" for i in range(20)]
    sep = [" ", ", ", "-", "\n", "'", "\x00", "__"]

    def make(n):
        return "".join(rng.choice(vocab) + rng.choice(sep) for _ in range(n))
    items = [(i % 9 if i < 11 else None, make(rng.choice([0, 1, 3, 10, 12, 30]))) for i in range(12)] + [(20, None), (21, "..."), (22, "x")]
    texts = [None, "", "...", "x", "X!", "The a1"] + [make(rng.randrange(60)) for _ in range(40)]
    for _ in range(25):
        item = rng.choice([t for _, t in items if t])
        texts.append(make(rng.randrange(5)) + item.upper().replace("Ñ", "ñ") * rng.randrange(1, 3) + make(3))
    return texts + texts[5:9], items


@pytest.mark.parametrize("pairs", [10 ** 6, 40])
def test_windows_equal_brute_force(spark, pairs):
    texts, items = random_tables(pairs)
    docs = spark.createDataFrame([((1 << 60) + 2 * i + 1 if i % 5 else None, t, i, [1], i) for i, t in enumerate(texts)], "doc_id long, text string, n_words long, items array<int>, row long")
    its = spark.createDataFrame(items, "item_id long, text string")
    got = contamination.contamination(docs.repartition(3), its, set_pairs=pairs).collect()
    want = brute(texts, items)
    key = lambda r: (r[0] is not None, r)
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got], key=key) == sorted(
        [((1 << 60) + 2 * i + 1 if i % 5 else None, *w) for i, w in enumerate(want)], key=key)
    plain = contamination.contamination(docs, its)
    assert sorted(map(str, plain.select("doc_id", "spans").collect())) == sorted(map(str, (r for r in [type(x)(doc_id=x.doc_id, spans=x.spans) for x in got])))


def test_removal(spark):
    item = "one two three four five six seven eight nine ten eleven"
    texts = [f"Señor ß, {item.upper()}! tail", f"{item} {item}", "clean text", None, "", "one two three"]
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id int, text string, n_hit string")
    its = spark.createDataFrame([(1, item)], "item_id int, text string")
    cut = {r.doc_id: r.text for r in contamination.decontaminate(docs, its).collect()}
    assert cut == {0: "Señor ß, ! tail", 1: "", 2: "clean text", 3: None, 4: "", 5: "one two three"}
    assert contamination.decontaminate(docs, its).columns == docs.columns
    assert {r.doc_id for r in contamination.decontaminate(docs, its, "documents").collect()} == {2, 3, 4, 5}
    with pytest.raises(ValueError):
        contamination.decontaminate(docs, its, "x")


def test_long_text_and_empty_tables(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    filler = "lorem ipsum dolor " * 700_000  # over two chunks
    docs = spark.createDataFrame([(1, filler + item + " " + filler)], "doc_id int, text string")
    its = spark.createDataFrame([(7, item)], "item_id int, text string")
    r = contamination.contamination(docs, its).first()
    assert (r.n_words, r.n_hit, r["items"]) == (4_200_010, 10, ["7"])
    assert contamination.contamination(docs.limit(0), its).count() == 0
    assert contamination.contamination(docs, its.limit(0)).first().n_hit == 0


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    want = {d.doc_id: (n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, (n, h, i) in zip(docs, brute([d.text for d in docs], items))}
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in QUERIES["op11_decontamination"](spark, SMALL).collect()}
    assert got == want and any(v[4] for v in want.values())
    assert QUERIES["op11_decontamination"](spark, SMALL).schema["n_items"].dataType.simpleString() == "bigint"


def test_nothing_is_shuffled(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = contamination.contamination(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet")).select(F.col("n_hit"))._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("== Physical Plan ==")[1]
